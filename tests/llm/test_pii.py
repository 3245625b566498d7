import random
import re

import pytest

from vialis.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    def luhn(x):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(x[::-1])) % 10 == 0
    good = {
        "email": lambda x: True, "ip": lambda x: all(int(p) <= 255 for p in x.split(".")),
        "card": lambda x: 13 <= len(digits(x)) <= 19 and luhn(digits(x)), "phone": lambda x: 9 <= len(digits(x)) <= 15,
    }
    return [(k, *m.span()) for k in PATTERNS for m in re.finditer(PATTERNS[k], text) if good[k](m[0])]


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(4)
    pieces = ["a@b.c", "@", ".", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "+1 (017) 555-7713", "+", " ", "-", "x_y@d-e.f_g@h.i", "7", "é", "0" * 20,
              "000.0.0.0255", "%+-", "b.c.", "@@", "\n"]
    for _ in range(3000):
        text = "".join(r.choices(pieces, k=r.randint(1, 12)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "@" * 50_000, "1." * 100_000, "+1" + " " * 200_000])
def test_long_runs_take_linear_time(text):
    assert isinstance(pii.base_spans(text), list)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, kind string, _row int")


def test_contexts_find_unseen_identifiers(spark):
    r = random.Random(5)
    rows = [(i, f"w{'abcdefgh'[i % 8]} please dial +1 ({100 + i}) 555-{1000 + i} today word{'xyz'[i % 3]}") for i in range(60)]
    rows += [(i, f"invoice total {r.randint(10**5, 10**6)} due") for i in range(100, 140)]
    rows += [(200, "please dial 0171-5550-1234 today"), (201, "invoice total 555123 due")]
    got = {x["doc_id"]: x for x in pii.digest(pii.find(frame(spark, rows))).collect()}
    assert got[200]["spans"] == "phone:12:26" and got[200]["n_phone"] == 0 and got[200]["n_added"] == 1
    assert got[201]["n_added"] == 0 and all(got[i]["n_phone"] == 1 and got[i]["n_added"] == 0 for i in range(60))


def test_nulls_copies_and_empty(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (3, "a@b.cd"), (3, "a@b.cd"), (4, "no data here at all")]
    got = sorted((x["doc_id"] or 0, x["n_email"], x["spans"]) for x in pii.digest(pii.find(frame(spark, rows))).collect())
    assert got == [(0, 1, "email:0:6"), (1, 0, ""), (2, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6"), (4, 0, "")]
    assert pii.find(frame(spark, [])).count() == 0
