"""License scans by sentence rules.

A text is cut into pieces at line ends and sentence ends, each is normalised, and runs of
pieces that make up known licence sentences get their identifiers: a run may span line ends,
so that hard-wrapped texts match, but neither a blank line nor the end of a sentence. The
sequence of identifiers of a document is then matched against rules, which
are ordered sequences of identifiers. Everything happens inside the document's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.llm.tables import texts

# Sentences of public licences and notices, normalised.
SENTENCES = {
    1: "licensed under the apache license version 2 0",
    2: "licensed under the apache license version 2 0 the license",
    3: "you may not use this file except in compliance with the license",
    4: "you may obtain a copy of the license at",
    5: "http www apache org licenses license 2 0",
    6: "see the license for the specific language governing permissions and limitations under the license",
    7: "released under the mit license",
    8: "licensed under the mit license",
    9: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    10: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    11: "the software is provided as is without warranty of any kind",
    12: "this work is licensed under the gnu general public license version 3",
    13: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    14: "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    15: "you should have received a copy of the gnu general public license along with this program",
    16: "licensed under cc by nc 4 0",
    17: "licensed under cc by 4 0",
    18: "this work is licensed under a creative commons attribution 4 0 international license",
    19: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    20: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    21: "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    22: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    23: "spdx license identifier mit",
    24: "spdx license identifier apache 2 0",
    25: "spdx license identifier gpl 3 0 only",
    26: "all rights reserved",
    27: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    28: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    29: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    30: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    31: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    32: "this source code form is subject to the terms of the mozilla public license v",
    33: "this is free and unencumbered software released into the public domain",
    34: "licensed under cc by sa 4 0",
    35: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    36: "spdx license identifier isc",
    37: "spdx license identifier bsd 2 clause",
    38: "spdx license identifier bsd 3 clause",
    39: "spdx license identifier gpl 2 0 only",
    40: "spdx license identifier gpl 2 0 or later",
    41: "spdx license identifier gpl 3 0 or later",
    42: "spdx license identifier lgpl 2 1 or later",
    43: "spdx license identifier agpl 3 0 only",
    44: "spdx license identifier mpl 2 0",
    45: "spdx license identifier cc0 1 0",
    46: "spdx license identifier mit or apache 2 0",
}
_UNLESS = (
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed"
    " on an as is basis without warranties or conditions of any kind either express or implied"
)
_MIT_GRANT = (
    f"{SENTENCES[9]} including without limitation the rights to use copy modify merge publish distribute sublicense"
    " and or sell copies of the software and to permit persons to whom the software is furnished to do so"
    " subject to the following conditions"
)
_MIT_NOTICE = SENTENCES[10].replace("permission notice", "permission notice including the next paragraph")
_AT_HTTP = f"{SENTENCES[4]} {SENTENCES[5]}"
_AT_HTTPS = f"{SENTENCES[4]} https{SENTENCES[5].removeprefix('http')}"
# What the licences really say where it differs from one of the sentences:
# sentences that go on, and those that are one where a text is not wrapped -> identifiers.
WHOLE = {
    f"{SENTENCES[2]} {SENTENCES[3]}": (2, 3),
    _AT_HTTP: (4, 5),
    _AT_HTTPS: (4, 5),
    f"{_AT_HTTP} {_UNLESS}": (4, 5),
    f"{_AT_HTTPS} {_UNLESS}": (4, 5),
    f"https{SENTENCES[5].removeprefix('http')}": (5,),
    _MIT_GRANT: (9,),
    f"{_MIT_GRANT} {SENTENCES[10]}": (9, 10),
    _MIT_NOTICE: (10,),
    f"{_MIT_GRANT} {_MIT_NOTICE}": (9, 10),
    f"{SENTENCES[11]} express or implied including but not limited to the warranties of merchantability"
    " fitness for a particular purpose and noninfringement": (11,),
    # The number of a list's first item; or its items have marks that are no words.
    f"{SENTENCES[20]} 1": (20,),
    f"{SENTENCES[20]} {SENTENCES[21]}": (20, 21),
}
# Texts of so many words also match behind other words of their piece, such as a copyright
# line that was joined with them.
LONG = 12
# Rule -> (licence, sentences in order).
RULES = {
    "apache-notice": ("Apache-2.0", (1,)),
    "apache-header": ("Apache-2.0", (2, 3, 4)),
    "apache-header-end": ("Apache-2.0", (6,)),
    "apache-spdx": ("Apache-2.0", (24,)),
    "mit-notice": ("MIT", (7,)),
    "mit-licensed": ("MIT", (8,)),
    "mit-text": ("MIT", (9, 10, 11)),
    "mit-spdx": ("MIT", (23,)),
    "gpl3-notice": ("GPL-3.0", (12,)),
    "gpl3-header": ("GPL-3.0", (13, 14, 15)),
    "gpl3-spdx": ("GPL-3.0", (25,)),
    "cc-by-nc-notice": ("CC-BY-NC-4.0", (16,)),
    "cc-by-nc-text": ("CC-BY-NC-4.0", (19,)),
    "cc-by-notice": ("CC-BY-4.0", (17,)),
    "cc-by-text": ("CC-BY-4.0", (18,)),
    "bsd-2-clause": ("BSD-2-Clause", (20, 21, 22)),
    "all-rights-reserved": ("proprietary", (26,)),
    "bsd-3-clause": ("BSD-3-Clause", (20, 21, 22, 27)),
    "isc-text": ("ISC", (28,)),
    "gpl2-header": ("GPL-2.0", (29, 14, 15)),
    "lgpl-header": ("LGPL-2.1", (30,)),
    "agpl3-header": ("AGPL-3.0", (31,)),
    "mpl2-header": ("MPL-2.0", (32,)),
    "unlicense-text": ("Unlicense", (33,)),
    "cc-by-sa-notice": ("CC-BY-SA-4.0", (34,)),
    "cc-by-sa-text": ("CC-BY-SA-4.0", (35,)),
    "isc-spdx": ("ISC", (36,)),
    "bsd2-spdx": ("BSD-2-Clause", (37,)),
    "bsd3-spdx": ("BSD-3-Clause", (38,)),
    "gpl2-only-spdx": ("GPL-2.0", (39,)),
    "gpl2-or-later-spdx": ("GPL-2.0", (40,)),
    "gpl3-or-later-spdx": ("GPL-3.0", (41,)),
    "lgpl-spdx": ("LGPL-2.1", (42,)),
    "agpl3-spdx": ("AGPL-3.0", (43,)),
    "mpl2-spdx": ("MPL-2.0", (44,)),
    "cc0-spdx": ("CC0-1.0", (45,)),
    "mit-or-apache-spdx": ("MIT OR Apache-2.0", (46,)),
}


def _marks(ids) -> str:
    return "".join(f"<{i}>" for i in ids)


# Behind a piece: the end of a sentence, and of a line.
_STOP, _LINE = "\x01", "\n"


def pieces(text: Column) -> Column:
    """Normalised pieces, each between two marks of where it was cut: at line ends, and
    behind ``. ! ?``; ASCII letters and digits in lower case, all else one space."""
    cut = F.regexp_replace(F.translate(F.lower(text), _STOP, " "), r"[.!?][ \t\r\n]+", _STOP)
    clean = F.concat(F.lit(_LINE), F.regexp_replace(cut, rf"[^a-z0-9{_LINE}{_STOP}]+", " "), F.lit(_LINE))
    return F.regexp_replace(clean, rf" ?([{_LINE}{_STOP}]) ?", "$1")


def identifiers(
    text: Column, known: dict[int, str] = SENTENCES, whole: dict[str, tuple[int, ...]] | None = None
) -> Column:
    """The known sentences of a text, in order: '<7><12>'; of those that begin at one piece
    the longest. ``whole`` has further texts (None: ``WHOLE`` with the usual sentences)."""
    if whole is None:
        whole = WHOLE if known is SENTENCES else {}
    marks = {**{t: _marks(ids) for t, ids in whole.items()}, **{t: _marks([i]) for i, t in known.items()}}
    if not marks:
        return F.lit("")
    # Longest first; between two words of a sentence a line may end.
    ordered = sorted(marks, key=len, reverse=True)
    ways = lambda some: "|".join(t.replace(" ", f"[ {_LINE}]") for t in some)
    regex = rf"(?<=[{_LINE}{_STOP}])(?:{ways(ordered)})(?=[{_LINE}{_STOP}])"
    if inside := [t for t in ordered if t.count(" ") + 1 >= LONG]:
        regex += rf"|(?<= )(?:{ways(inside)})(?=[{_LINE}{_STOP}])"
    table = F.create_map(*[F.lit(x) for item in marks.items() for x in item])
    found = F.regexp_extract_all(pieces(text), F.lit(regex), F.lit(0))
    return F.array_join(F.transform(found, lambda s: F.element_at(table, F.translate(s, _LINE, " "))), "")


def _longer(rule: str, rules: dict) -> list[str]:
    """The sequences of other rules that contain this rule's, the longest first."""
    own = _marks(rules[rule][1])
    others = {_marks(ids) for _, ids in rules.values()} - {own}
    return sorted((m for m in others if own in m), key=lambda m: (-len(m), m))


def license_matches(
    docs: DataFrame,
    known: dict[int, str] = SENTENCES,
    rules: dict = RULES,
    whole: dict[str, tuple[int, ...]] | None = None,
) -> DataFrame:
    """One row per document and matched rule: ``doc_id, license, rule, n_sentences,
    n_matches``.

    A rule matches where its sentences follow each other among the document's known
    sentences (unknown ones may stand between); ``n_matches`` counts matches that do not
    overlap. Where a rule's sentences contain another rule's, the longer one matches alone: three
    clauses are not two and one. Null and empty texts match
    nothing; rows that repeat an id are scanned each for itself. Other columns are ignored.
    """
    table = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(licence).alias("license"),
                F.lit(len(ids)).alias("n_sentences"),
                F.lit(_marks(ids)).alias("marks"),
                F.array(*[F.lit(m) for m in _longer(name, rules)]).cast("array<string>").alias("longer"),
            )
            for name, (licence, ids) in rules.items()
        ]
    )
    with_ids = texts(docs).select("doc_id", identifiers(F.col("text"), known, whole).alias("ids")).filter("ids <> ''")
    left = lambda r: F.aggregate(r["longer"], F.col("ids"), lambda t, m: F.replace(t, m, F.lit("|")))
    found = F.filter(table, lambda r: F.instr(left(r), r["marks"]) > 0)
    matched = with_ids.withColumn("r", F.explode(found)).withColumn("left", left(F.col("r")))
    count = "(length(left) - length(replace(left, r.marks, ''))) div length(r.marks)"
    return matched.select(
        "doc_id", "r.license", "r.rule", "r.n_sentences", F.expr(count).cast("bigint").alias("n_matches")
    )


def oracle() -> str:
    """The scan in SQL of texts where each known sentence is one piece: neither wrapped nor
    one of ``WHOLE``."""
    known = ", ".join(f"('{s}', '<{i}>')" for i, s in SENTENCES.items())
    rules = ", ".join(f"('{n}', '{lic}', {len(ids)}, '{_marks(ids)}')" for n, (lic, ids) in RULES.items())
    longer = {name: _longer(name, RULES) for name in RULES}
    left = "ids"
    for name, marks in longer.items():
        for mark in marks:
            left = f"CASE WHEN rule = '{name}' THEN replace({left}, '{mark}', '|') ELSE {left} END"
    return f"""
WITH known(sentence, mark) AS (VALUES {known}),
rules(rule, license, n_sentences, marks) AS (VALUES {rules}),
cut AS (SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS part FROM (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)) AS parts
  FROM documents)),
clean AS (SELECT doc_id, pos, trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM cut),
ids AS (SELECT doc_id, string_agg(mark, '' ORDER BY pos) AS ids FROM clean JOIN known USING (sentence) GROUP BY doc_id)
SELECT doc_id, license, rule, n_sentences,
  CAST((length(rest) - length(replace(rest, marks, ''))) // length(marks) AS BIGINT) AS n_matches
FROM (SELECT *, {left} AS rest FROM ids, rules WHERE contains(ids, marks)) WHERE contains(rest, marks)"""
