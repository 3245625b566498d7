import random

import pytest
from pyspark.sql import functions as F

from vialis.llm import line_dedup


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, token string, line int")


def brute(rows):
    lines = [(i, n, frozenset(w for w in part.lower().replace("\t", " ").split(" ") if w))
             for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)) if t is not None for n, part in enumerate(t.split("\n"))]
    gone = {}
    for k, (i, n, s) in enumerate(lines):
        if s and any(9 * len(s & o) >= 4 * (len(s) + len(o)) for _, _, o in lines[:k] if o):
            gone.setdefault(i, []).append(n)
    return {i: sorted(v) for i, v in gone.items()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(10)
    words = [f"w{int(r.paretovariate(0.6)) % 400}" for _ in range(3000)]
    base = r.sample(sorted(set(words)), 30)
    out = []
    for i in range(150):
        lines = [" ".join(r.choices(words, k=r.choice([1, 2, 5, 9, 12, 30]))) for _ in range(r.randint(1, 4))]
        near = list(base)
        for _ in range(r.randint(0, 3)):
            near[r.randrange(30)] = r.choice(words)
        out.append((i, "\n".join([*lines, " ".join(near), "", "A\tcommon  line of words"])))
    return out + [(500, None), (501, ""), (502, "\n\n"), (None, "a common line of words\nonly here once")]


def test_removed_lines_equal_all_pairs(spark, rows):
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    assert {i: v for i, v in got.items() if v} == brute(rows)


def test_text_without_them(spark):
    rows = [(1, "one two three\nfour"), (2, "Three two one\nfive\n"), (2, "Three two one\nfive\n"), (3, None)]
    table = frame(spark, rows)
    kept = line_dedup.deduplicated(table)
    assert kept.columns == table.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"] is not None) == [(1, "one two three\nfour"), (2, "five\n"), (2, "five\n")]


def test_empty(spark):
    assert line_dedup.removed_lines(frame(spark, [])).count() == 0


def test_prefixes_hold_the_rarest_words_of_a_large_vocabulary(spark):
    """Most of the 65,536 buckets are in use, so ranks lie on both sides of the middle."""
    docs = spark.range(60_000).selectExpr(
        "id AS doc_id", "concat_ws(' ', 'w' || id, 'w' || (id % 30000), 'w' || (id % 200), 'all') AS text")
    ranks = line_dedup.rarity(docs, "text")
    words = docs.selectExpr("explode(split(text, ' ')) AS w").groupBy("w").count()
    per_bucket = words.groupBy((F.xxhash64("w").bitwiseAND(F.lit(line_dedup.BUCKETS - 1))).alias("b")).agg(F.sum("count").alias("n"))
    assert per_bucket.count() > 36_000
    counts = {r["b"]: r["n"] for r in per_bucket.collect()}
    some = docs.filter("doc_id % 997 = 0").select("text", line_dedup.hashes(F.col("text")).alias("h"))
    for r in some.select("h", line_dedup.by_rarity(F.col("h"), ranks).alias("codes")).collect():
        by_hash = {(h >> 16) & ((1 << 48) - 1): counts[h & (line_dedup.BUCKETS - 1)] for h in r["h"]}
        order = [by_hash[c & ((1 << 48) - 1)] for c in r["codes"]]
        assert order == sorted(order)


def test_wanted_lines_are_read_by_document(spark):
    """A line that is not wanted does not move, whatever else is wanted; a document that stands twice gives its lines once."""
    docs = spark.createDataFrame([(i, i * 10, f"A {i}\nB\tB {i}\n") for i in [*range(300), 7]], "_d long, h long, _text string")
    wanted = docs.distinct().selectExpr("_d", "h", "1 AS line", "_d + 1000 AS id").filter("_d % 3 = 1")
    found = line_dedup._wanted_lines(docs, wanted)
    assert sorted(map(tuple, found.collect())) == [(i + 1000, f"b b {i}") for i in range(300) if i % 3 == 1]


def test_tokens_are_made_once_a_line(spark):
    """A filter on the tokens would be pushed below them and make all of them twice."""
    docs = frame(spark, [(1, "one two\n \t\nthree"), (2, None)])
    rows = line_dedup._worded(docs, "doc_id", "text", line_dedup.rarity(docs, "text"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1
    assert sorted((r["doc_id"], r["line"], len(r["tokens"])) for r in rows.collect()) == [(1, 0, 2), (1, 2, 1)]
