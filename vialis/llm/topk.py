"""Exact top-k inner products: norm order, rotated partial sums, residual bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import python_ready, written

SCALE = 1024
VECTORS_PER_GROUP = 8_192
QUERIES_PER_GROUP = 16_384
SEED_VECTORS = 1_024
CHUNK = 1_024
PAIRS = 50_000
EXACT = 2**52


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of floor(1024 * x) as doubles, short vectors filled with zeros."""
    lengths = vectors.map(len).to_numpy()
    out = np.zeros((len(vectors), width))
    if len(vectors):
        flat = np.concatenate([np.asarray(v, dtype=np.float64) for v in vectors]) if lengths.sum() else np.zeros(0)
        out[np.repeat(np.arange(len(vectors)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return np.floor(out * SCALE)


def _exact(q: np.ndarray, v: np.ndarray) -> bool:
    """Whether inner products of these rows stay whole numbers that a double holds."""
    return np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, q.shape[1]) < EXACT


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of paired rows; what a long cannot hold is set to its nearest end."""
    if _exact(q, v):
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    low, high = 1 - 2**63, 2**63 - 1
    pairs = zip(q, v, strict=True)
    return np.array([min(high, max(low, sum(int(a) * int(b) for a, b in zip(x, y, strict=True)))) for x, y in pairs], dtype=np.int64)


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.query = np.zeros(0, dtype=np.int64)
        self.score = np.zeros(0, dtype=np.int64)
        self.id = np.zeros(0, dtype=np.int64)
        self.least = np.full(n, -np.inf) if floor is None else floor.copy()

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, s, i = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, ~s, q))
        q, s, i = q[order], s[order], i[order]
        first = np.searchsorted(q, q, side="left")
        place = np.arange(len(q)) - first
        keep = place < self.k
        last = place == self.k - 1
        self.query, self.score, self.id = q[keep], s[keep], i[keep]
        self.least[q[last]] = np.maximum(self.least[q[last]], s[last].astype(np.float64))


def search(
    qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, rotation: np.ndarray, k: int,
    floor: np.ndarray | None = None,
) -> Best:
    """Best ``k`` of ``v`` for every row of ``q``.

    Vectors come in order of falling length, a chunk at a time. The first
    quarter of the rotated components gives a partial sum; the lengths of the
    rests bound what is missing (Cauchy-Schwarz). Only pairs whose bound
    reaches the query's k-th score so far are computed, in integers. A query
    for which the next length cannot reach it is done. Bounds carry a margin
    for rounding, so ties and exact results survive.
    """
    best = Best(len(q), k, floor)
    lengths = np.sqrt((v * v).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    vid, v, lengths = vid[order], v[order], lengths[order]
    own = np.sqrt((q * q).sum(axis=1))
    head = max(1, rotation.shape[1] // 4)
    turned_q = q @ rotation
    rest_q = np.sqrt((turned_q[:, head:] ** 2).sum(axis=1))
    live = np.arange(len(q))
    for at in range(0, len(v), CHUNK):
        part, ids, long = v[at:at + CHUNK], vid[at:at + CHUNK], lengths[at]
        margin = 1e-9 * own[live] * long + 1e-6
        live = live[own[live] * long + margin >= best.least[live]]
        if not len(live):
            break
        turned = part @ rotation
        rest = np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        bound = turned_q[live, :head] @ turned[:, :head].T + np.outer(rest_q[live], rest)
        reach = best.least[live] - (1e-9 * own[live] * long + 1e-6)
        open_pairs = (bound >= reach[:, None]) & (qid[live][:, None] != ids[None, :])
        if open_pairs.sum() > 0.1 * open_pairs.size and _exact(q[live], part):
            # Many pairs are left: one product of whole numbers in doubles, exact at this size, is cheaper than row by row.
            scores = q[live] @ part.T
            open_pairs &= scores >= best.least[live][:, None]
            a, b = np.nonzero(open_pairs)
            best.add(live[a], scores[a, b].astype(np.int64), ids[b])
            continue
        a, b = np.nonzero(open_pairs)
        for i in range(0, len(a), PAIRS):
            x, y = live[a[i:i + PAIRS]], b[i:i + PAIRS]
            best.add(x, _scores(q[x], part[y]), ids[y])
    return best


def rotation_of(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all integer vectors, strongest first.

    The products of components are summed in the tasks and by Spark; the driver
    gets width x width numbers, whatever the number of vectors.
    """
    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch["vector"], width) / SCALE
            total += m.T @ m
        i, j = np.indices((width, width))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": total.ravel()})

    rows = vectors.select("vector").mapInPandas(products, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((width, width))
    for r in rows.collect():
        gram[r["i"], r["j"]] = r["x"]
    gram = (gram + gram.T) / 2
    if not np.isfinite(gram).all():
        return np.eye(width)
    _, turned = np.linalg.eigh(gram)
    return turned[:, ::-1].copy()


def top_k(
    table: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
    vectors_per_group: int = VECTORS_PER_GROUP, queries_per_group: int = QUERIES_PER_GROUP,
) -> DataFrame:
    """The ``k`` highest inner products (query_id, rank, vec_id, score) for the rows that ``queries`` picks.

    Components become floor(1024 * x). All rows but the query's own are
    candidates; ties go to the smaller id.

    Vectors stand in range partitions of falling length, queries in groups. A
    group of queries meets a group of vectors only if some query's length times
    the group's greatest length reaches the query's k-th score among the longest
    vectors (a fixed number, the only rows broadcast). What meets is searched
    in one task of bounded size, and each task returns k rows per query at most.

    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without id. Shorter vectors count as filled up with zeros. Rows
    that repeat an id and its vector count once; rows that share an id but not
    the vector are each a candidate and each a query, of whose lists the best k
    are kept. With fewer than k candidates all are returned; an empty table gives
    none. Other columns are not used.
    """
    spark = table.sparkSession
    python_ready(spark)
    rows = table.select(
        table[vec_id].cast("bigint").alias("vec_id"), table[embedding].cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asked"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()
    lengthy = F.sqrt(F.aggregate(F.col("vector"), F.lit(0.0), lambda a, x: a + (F.abs(x) * SCALE + 1) ** 2))  # at least that of floor(1024 * x)
    rows = written(rows.withColumn("length", lengthy), "vectors")
    n, asked, width = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("asked"), 1)), F.max(F.size("vector"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n or not asked:
        return spark.createDataFrame([], schema)
    width = max(1, width)
    rotation = rotation_of(rows, width)

    groups = max(1, -(-n // vectors_per_group))
    spread = F.xxhash64("vec_id")
    placed = rows.repartitionByRange(groups, F.col("length").desc(), spread)
    placed = written(placed.withColumn("v_group", F.spark_partition_id()), "length-groups")
    longest = placed.orderBy(F.col("length").desc(), spread).limit(SEED_VECTORS).select("vec_id", "vector").toPandas()
    seeds = spark.sparkContext.broadcast((longest["vec_id"].to_numpy(), _matrix(longest["vector"], width)))

    def first_scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, v = seeds.value
        for batch in batches:
            found = search(batch["vec_id"].to_numpy(), _matrix(batch["vector"], width), ids, v, rotation, k)
            yield batch.assign(least=found.least)

    q_groups = max(1, -(-asked // queries_per_group))
    chosen = placed.filter("asked").select("vec_id", "vector", "length")
    started = chosen.mapInPandas(first_scores, "vec_id long, vector array<double>, length double, least double")
    started = written(started.withColumn("q_group", F.pmod(spread, F.lit(q_groups)).cast("int")), "queries")

    reach = placed.groupBy("v_group").agg(F.max("length").alias("longest"))
    # Groups, not rows: which vectors can reach which queries at all.
    need = started.withColumn("need", F.when(F.col("length") > 0, F.col("least") / F.col("length")).otherwise(
        F.when(F.col("least") > 0, float("inf")).otherwise(float("-inf"))))
    needs = need.groupBy("q_group").agg(F.min("need").alias("need"))
    meets = reach.join(needs, F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("need")).select("v_group", "q_group")
    meets = written(meets, "meetings")
    left = placed.select("vec_id", "vector", "v_group").join(meets, "v_group")
    right = started.select("vec_id", "vector", "least", "q_group").join(meets, "q_group")

    def meet(vectors: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        q_ids = asking["vec_id"].to_numpy()
        found = search(
            q_ids, _matrix(asking["vector"], width), vectors["vec_id"].to_numpy(), _matrix(vectors["vector"], width),
            rotation, k, asking["least"].to_numpy(dtype=np.float64),
        )
        return pd.DataFrame({"query_id": q_ids[found.query], "vec_id": found.id, "score": found.score})

    both = left.groupBy("v_group", "q_group").cogroup(right.groupBy("v_group", "q_group"))
    met = both.applyInPandas(meet, "query_id long, vec_id long, score long")

    first = met.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_set(F.struct(
        (-F.col("score")).alias("low"), "vec_id"))), 1, k).alias("best"))
    ranks = first.select("query_id", F.posexplode("best").alias("at", "b"))
    return ranks.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.low")).alias("score"),
    )
