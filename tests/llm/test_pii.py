"""Personal data against the plain expressions, and what contexts add."""

import hashlib
import random
import re

from helpers import clashing, docs

from kinrank.llm.pii import KINDS, personal_data


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


PLAIN = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def base(text):
    found = []
    for kind, (pattern, valid) in enumerate(PLAIN):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "") if valid(m.group())]
    return sorted(found)


def check(rows, result):
    left = list(result)
    for doc_id, text in rows:
        spans = base(text)
        joined = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        row = next(r for r in left if r.doc_id == doc_id and r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest())
        left.remove(row)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))
    assert not left


def test_base_spans_agree_with_the_plain_expressions(spark):
    draw = random.Random(3)
    signs, weights = "0123456789.+-@ a_é🙂()%\n", [3] * 10 + [6, 2, 3, 3, 3, 2, 1, 1, 1, 1, 1, 1, 1]
    rows = [(i, "".join(draw.choices(signs, weights, k=draw.randint(0, 80)))) for i in range(1500)]
    rows += [
        (5000, None),
        (5001, ""),
        (5002, "a@b.co_x@d.com 1.2.3.4.5.6.7.8 0001.2.3.255 256.1.1.1 🙂 +1 (743) 555-3824"),
        (5003, "5" * 20_000 + " " + "a." * 20_000 + "@" + "b." * 20_000 + "c"),
        (5004, "4111 1111 1111 1111 " * 300),
        (5004, "4111 1111 1111 1111 " * 300),
        (None, "4111111111111111"),
    ]
    check(rows, personal_data(clashing(docs(spark, rows))).collect())


def test_repeated_rows_have_the_spans_of_one(spark):
    mixed = "a 1.2.3.4 b"
    many = "x@y.co, 4111 1111 1111 1111 and +1 (743) 555-3824 or 9.8.7.6"
    rows = [(1, mixed)] * 2 + [(None, many)] * 3 + [(2, mixed), (2, many)]
    found = personal_data(docs(spark, rows)).collect()
    assert sorted(r.spans for r in found if r.doc_id == 1) == ["ip:2:9"] * 2
    check(rows, found)
    assert len({r.spans for r in found if r.doc_id is None}) == 1


def test_contexts_discover_what_patterns_miss(spark):
    mails = ["a1@b.co", "c2@d.org", "e3@f.net", "g4@h.com", "i5@j.com", "k6@l.com"]
    write = "Dear reader, contact person reachable via {} for all questions please".format
    rows = [(i, write(m)) for i, m in enumerate([*mails, "jane7.doe(at)mail.example"])]
    rows += [(50, "there were 1200 sheep"), (51, "and 1300 goats")]
    result = {r.doc_id: r for r in personal_data(docs(spark, rows)).collect()}
    assert result[6].spans == "email:42:51" and result[6].n_email == 0
    assert result[50].spans == "" and result[51].spans == ""
    check(rows, result.values())


def test_no_rows(spark):
    assert personal_data(docs(spark, [])).count() == 0
