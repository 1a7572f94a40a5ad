"""License rules by hand."""

import re
import textwrap

import pytest
from helpers import clashing, docs

from kinrank.llm.licenses import RULES, SENTENCES, license_matches


def found(spark, rows):
    frame = license_matches(clashing(docs(spark, rows)))
    return sorted((r.doc_id, r.license, r.rule, r.n_matches) for r in frame.collect())


def test_rules_need_their_sentences_in_order(spark):
    header = [SENTENCES[i] for i in (2, 3, 4)]
    rows = [
        (1, "Some words. Released under the   MIT License.\nMore"),
        (2, ". ".join(header) + "."),
        (3, ". ".join([header[1], header[0], header[2]])),
        (4, f"{header[0]}.\nAn unknown sentence between!\n{header[1]}. {header[2]}"),
        (5, "LICENSED UNDER CC BY-NC 4.0. Licensed under CC BY-NC 4.0."),
        (6, "not licensed under the mit license agreement"),
    ]
    assert found(spark, rows) == [
        (1, "MIT", "mit-notice", 1),
        (2, "Apache-2.0", "apache-header", 1),
        (4, "Apache-2.0", "apache-header", 1),
        (5, "CC-BY-NC-4.0", "cc-by-nc-notice", 2),
    ]


# As the licences are published: paragraphs, one string each.
APACHE = [
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at",
    "http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
    'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
    "specific language governing permissions and limitations under the License.",
]
MIT = [
    "Copyright (c) 2020 Somebody",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
    "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
    "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.",
]
GPL = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.",
    "You should have received a copy of the GNU General Public License along with this program.  If not, see "
    "<https://www.gnu.org/licenses/>.",
]
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
]
CANONICAL = {
    "apache-notice": ["Licensed under the Apache License, Version 2.0"],
    "apache-header": APACHE,
    "apache-header-end": APACHE,
    "apache-spdx": ["SPDX-License-Identifier: Apache-2.0"],
    "mit-notice": ["Released under the MIT License."],
    "mit-licensed": ["Licensed under the MIT license."],
    "mit-text": MIT,
    "mit-spdx": ["SPDX-License-Identifier: MIT"],
    "gpl3-notice": ["This work is licensed under the GNU General Public License, version 3."],
    "gpl3-header": GPL,
    "gpl3-spdx": ["SPDX-License-Identifier: GPL-3.0-only"],
    "cc-by-nc-notice": ["Licensed under CC BY-NC 4.0."],
    "cc-by-nc-text": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ],
    "cc-by-notice": ["Licensed under CC BY 4.0."],
    "cc-by-text": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "bsd-2-clause": BSD,
    "all-rights-reserved": ["Copyright 2020 Somebody.", "All rights reserved."],
    "bsd-3-clause": [
        *BSD,
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "isc-text": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ],
    "gpl2-header": [GPL[0].replace("version 3", "version 2"), *GPL[1:]],
    "lgpl-header": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version."
    ],
    "agpl3-header": [GPL[0].replace("GNU General", "GNU Affero General"), *GPL[1:]],
    "mpl2-header": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ],
    "unlicense-text": ["This is free and unencumbered software released into the public domain."],
    "cc-by-sa-notice": ["Licensed under CC BY-SA 4.0."],
    "cc-by-sa-text": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "isc-spdx": ["SPDX-License-Identifier: ISC"],
    "bsd2-spdx": ["SPDX-License-Identifier: BSD-2-Clause"],
    "bsd3-spdx": ["SPDX-License-Identifier: BSD-3-Clause"],
    "gpl2-only-spdx": ["SPDX-License-Identifier: GPL-2.0-only"],
    "gpl2-or-later-spdx": ["SPDX-License-Identifier: GPL-2.0-or-later"],
    "gpl3-or-later-spdx": ["SPDX-License-Identifier: GPL-3.0-or-later"],
    "lgpl-spdx": ["SPDX-License-Identifier: LGPL-2.1-or-later"],
    "agpl3-spdx": ["SPDX-License-Identifier: AGPL-3.0-only"],
    "mpl2-spdx": ["SPDX-License-Identifier: MPL-2.0"],
    "cc0-spdx": ["SPDX-License-Identifier: CC0-1.0"],
    "mit-or-apache-spdx": ["SPDX-License-Identifier: MIT OR Apache-2.0"],
}


def layouts(paragraphs):
    """Wrapped at several widths, in comments, one line a paragraph, and all in one line."""
    yield "\n\n".join(paragraphs)
    yield " ".join(paragraphs)
    for width in (30, 60, 72, 80):
        wrapped = [textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in paragraphs]
        yield "\n\n".join(wrapped)
        yield "\r\n\r\n".join(wrapped).replace("\n", "\r\n").replace("\r\r", "\r")
        yield re.sub("^", " * ", "\n\n".join(wrapped), flags=re.M)
        yield re.sub("^", "# ", "\n\n".join(wrapped), flags=re.M)


def test_published_texts_match_in_any_layout(spark):
    assert CANONICAL.keys() == RULES.keys()
    texts = [(rule, text) for rule, paragraphs in CANONICAL.items() for text in layouts(paragraphs)]
    rows = [(i, f"Some words before.\n\n{text}\n\nAnd some behind.") for i, (_, text) in enumerate(texts)]
    hit = {(i, rule, n) for i, _, rule, n in found(spark, rows)}
    assert [text for i, (rule, text) in enumerate(texts) if (i, rule, 1) not in hit] == []


@pytest.mark.parametrize(
    "text",
    [
        "Released under the MIT.\nLicense",
        "Released under the\n\nMIT License",
        "Released under the\n#\n# MIT License",
        "It is not released under\nthe MIT License",
        "Released under the MIT\nLicense or another one",
    ],
)
def test_runs_end_where_sentences_and_paragraphs_do(spark, text):
    assert found(spark, [(1, text)]) == []


def test_the_longer_rule_matches_alone(spark):
    two, three = "\n\n".join(CANONICAL["bsd-2-clause"]), "\n\n".join(CANONICAL["bsd-3-clause"])
    rows = [(1, two), (2, three), (3, f"{three}\n\n{two}\n\n{two}")]
    assert found(spark, rows) == [
        (1, "BSD-2-Clause", "bsd-2-clause", 1),
        (2, "BSD-3-Clause", "bsd-3-clause", 1),
        (3, "BSD-2-Clause", "bsd-2-clause", 2),
        (3, "BSD-3-Clause", "bsd-3-clause", 1),
    ]


def test_licences_are_told_apart(spark):
    """No published text is reported as another licence."""
    rows = [(i, "\n\n".join(paragraphs)) for i, paragraphs in enumerate(CANONICAL.values())]
    names = [RULES[rule][0] for rule in CANONICAL]
    assert all(licence == names[i] for i, licence, _, _ in found(spark, rows))


def test_odd_inputs(spark):
    notice = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, "...!?"), (4, "x " * 50_000 + ". " + notice), (5, notice), (5, notice), (None, notice)]
    rows = found(spark, rows[:-1]) + found(spark, rows[-1:])
    assert [r[0] for r in rows] == [4, 5, 5, None]
    assert found(spark, []) == []


def test_rules_name_known_sentences():
    assert all(i in SENTENCES for _, ids in RULES.values() for i in ids)
    assert len(set(SENTENCES.values())) == len(SENTENCES)
