import math
import random

from pyspark.sql import functions as F

from vialis.llm import topk


def brute(rows, asked, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in good]
    out = []
    for q in {i for i, _ in ints if asked(i)}:
        scores = {(-sum(a * b for a, b in zip(x, y)), j) for i, x in ints if i == q for j, y in ints if j != q}
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, score int, length double")


def test_against_all_pairs_with_ties_nulls_and_odd_lengths(spark):
    r = random.Random(1)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 1.5]) for _ in range(6)]) for i in range(400)]
    rows += [(i, [0.25] * 6) for i in range(400, 600)]
    rows += [(600, None), (601, [None] * 6), (602, [math.nan] + [0.0] * 5), (603, [math.inf] * 6), (604, [1.0, 2.0]), (605, []),
             (None, [1.0] * 6), (0, rows[0][1]), (20, [9.0] * 6)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5, vectors_per_group=100, queries_per_group=10)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 20 == 0, 5)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    assert sorted(map(tuple, topk.top_k(frame(spark, rows), F.col("vec_id") >= 0).collect())) == brute(rows, lambda i: True, 10)
    assert topk.top_k(frame(spark, []), F.lit(True)).count() == 0
    assert topk.top_k(frame(spark, rows), F.lit(None).cast("boolean")).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [1e9 + i, -3e8 * i]) for i in range(12)]
    want = [(q, r, j, max(1 - 2**63, min(2**63 - 1, s))) for q, r, j, s in brute(rows, lambda i: i == 3, 4)]
    got = topk.top_k(frame(spark, rows), F.col("vec_id") == 3, k=4).collect()
    assert sorted(x["score"] for x in got) == sorted(x[3] for x in want)
