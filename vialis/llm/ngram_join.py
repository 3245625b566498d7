"""Near copies by the Jaccard similarity of word n-grams: a MinHash LSH forest, prefixes of what it leaves apart, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vialis.llm.common import discard, other_rows, python_ready, wanted_rows, with_columns_from_text, written
from vialis.llm.components import components

MIX = np.uint64(0xD6E8FEB86659FD93)
STEP = np.uint64(0x9E3779B97F4A7C15)
CELLS = 1 << 18
# Exactness of sums that are held against the threshold.
NEARLY = 1e-6
MARK_BITS = 256
# Common n-grams stand in so many texts, and in one of so many of all texts, at least.
MANY = 32
RARE = 20_000
# Tokens are the upper bits of n-grams. A task adds up so many at a time; a part of them is that of so many characters of text.
TOKEN_BITS = 40
TOKENS_HELD = 1 << 21
PART_CHARS = 1 << 22


@dataclass(frozen=True)
class Rule:
    """Words of an n-gram, least similarity, trees of the forest, longest prefix, recall asked for at the least similarity.

    ``crowd`` is how many clusters may stay in a node before its prefix grows. ``doubt`` is how far below the similarity an
    estimate from the signature may lie before a pair is brought into one cluster, six standard deviations by default.
    A cluster of more than ``large`` sets is met as a whole.
    """

    n: int = 5
    similarity: float = 0.8
    trees: int = 40
    longest: int = 12
    recall: float = 0.9995
    rows_per_task: int = 512
    crowd: int = 4
    large: int = 64

    def recall_at(self, depth: int) -> float:
        """Share of the pairs at the least similarity that agree on ``depth`` values in some tree."""
        return 1 - (1 - self.similarity**depth) ** self.trees

    @property
    def depth(self) -> int:
        """The prefix length at which sparse nodes meet the recall; prefixes of crowded nodes are longer, up to ``longest``."""
        depth = self.longest
        while depth > 1 and self.recall_at(depth) < self.recall:
            depth -= 1
        return depth

    @property
    def doubt(self) -> float:
        n = self.trees * self.longest
        return 6 * (self.similarity * (1 - self.similarity) / n) ** 0.5

    def prefix(self, n: int) -> int:
        """First n-grams, in any one order, of which two similar sets share one."""
        return n - math.ceil(self.similarity * n - NEARLY) + 1

    def least_overlap(self, both: Column) -> Column:
        """Common n-grams that two sets need, of as many together."""
        return F.ceil(both * (self.similarity / (1 + self.similarity)) - NEARLY)


def grams(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of lower-case words; of all words where there are fewer; none without words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    codes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(n, len(words))
    count = len(words) - size + 1
    with np.errstate(over="ignore"):
        out = np.full(count, size, dtype=np.uint64)
        for i in range(size):
            out = (out ^ codes[i:i + count]) * STEP
            out ^= out >> np.uint64(32)
        out *= MIX
    out ^= out >> np.uint64(31)
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


def tokens_of(found: np.ndarray) -> np.ndarray:
    return found >> np.uint64(64 - TOKEN_BITS)


class Signer:
    """MinHash values of a gram set: one 32-bit permutation per value, the least image of the set under each."""

    def __init__(self, rule: Rule):
        r = np.random.default_rng(17)
        self.rule, self.size = rule, rule.trees * rule.longest
        self.times = (r.integers(0, 2**31, self.size, dtype=np.uint32) * np.uint32(2) + np.uint32(1))
        self.plus = r.integers(0, 2**32, self.size, dtype=np.uint32)

    def values(self, found: np.ndarray) -> np.ndarray:
        folded = (found ^ (found >> np.uint64(32))).astype(np.uint32)
        least = np.full(self.size, 0xFFFFFFFF, dtype=np.uint32)
        block = max(1, CELLS // self.size)
        for i in range(0, len(folded), block):
            images = folded[i:i + block, None] * self.times
            images ^= self.plus
            np.minimum(least, images.min(axis=0), out=least)
        return least

    def labels(self, least: np.ndarray) -> np.ndarray:
        """A 64-bit label of the shortest prefix in each tree."""
        prefix = least.reshape(self.rule.trees, self.rule.longest).astype(np.uint64)
        out = np.arange(1, self.rule.trees + 1, dtype=np.uint64) * MIX
        with np.errstate(over="ignore"):
            for i in range(self.rule.depth):
                out = (out ^ prefix[:, i]) * STEP
                out ^= out >> np.uint64(29)
        return out.view(np.int64)


def _parts_of(held: list[np.ndarray], bits: int) -> pa.RecordBatch:
    """Tokens of some texts by their upper ``bits``: the lower ones of those seen once, of those seen more often, and how often."""
    tokens, times = np.unique(np.concatenate(held), return_counts=True)
    low = (tokens & np.uint64((1 << TOKEN_BITS - bits) - 1)).astype(np.uint32)
    upper = tokens >> np.uint64(TOKEN_BITS - bits)
    starts = np.flatnonzero(np.r_[True, upper[1:] != upper[:-1]]) if len(tokens) else np.zeros(0, dtype=np.int64)
    out: dict[str, list] = {"part": upper[starts].astype(np.int32), "once": [], "more": [], "times": []}
    for i, j in zip(starts, [*starts[1:], len(tokens)], strict=False):
        single = times[i:j] == 1
        out["once"].append(low[i:j][single].tobytes())
        out["more"].append(low[i:j][~single].tobytes())
        out["times"].append(times[i:j][~single].astype(np.uint32).tobytes())
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(out.values(), kinds, strict=True)], names=[*out])


def common_grams(docs: DataFrame, text: str, rule: Rule) -> np.ndarray:
    """Tokens of the n-grams that many texts have, the rarest first.

    They only set the order in which prefixes are taken, and every order gives all pairs. All
    texts are counted, equal ones once; a task adds up what it has read and hands its tokens on packed, by their upper bits.
    The list has a bound: each text has few n-grams of one in ``RARE`` texts.
    """
    h = F.xxhash64(text)
    times = written(docs.groupBy(h.alias("_h")).agg(F.count(F.lit(1)).alias("n"), F.max(F.length(text)).alias("size")), "texts")
    texts, size = times.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    often = max(MANY, texts // RARE)
    bits = min(max((size // PART_CHARS).bit_length(), TOKEN_BITS - 32), TOKEN_BITS // 2)
    rows, twice = docs.select(h.alias("_h"), F.col(text).alias("_text")), times.filter("n > 1").select("_h")
    alone = other_rows(rows, twice, ["_h"]).select("_text")
    first = wanted_rows(rows, twice, ["_h"]).groupBy("_h").agg(F.any_value("_text").alias("_text")).select("_text")
    python_ready(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(tokens_of(grams(t, rule.n)))
                n += len(held[-1])
                if n >= TOKENS_HELD:
                    yield _parts_of(held, bits)
                    held, n = [], 0
        if held:
            yield _parts_of(held, bits)

    def summed(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        once, more, of_more = (np.frombuffer(b"".join(batch[c]), dtype=np.uint32) for c in ("once", "more", "times"))
        both = np.concatenate([once, more]).astype(np.uint64) << np.uint64(32)
        both |= np.concatenate([np.ones(len(once), dtype=np.uint32), of_more]).astype(np.uint64)
        both.sort()
        low, n = both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        n = np.add.reduceat(n, starts)
        token = low[starts] + (np.uint64(key[0]) << np.uint64(TOKEN_BITS - bits))
        return pd.DataFrame({"token": token[n >= often].astype(np.int64), "n": n[n >= often]})

    parts = alone.unionByName(first).mapInArrow(counted, "part int, once binary, more binary, times binary")
    counts = parts.groupBy("part").applyInPandas(summed, "token long, n long")
    found = counts.orderBy("n", "token").select("token").toArrow()["token"].to_numpy().astype(np.int64).view(np.uint64)
    discard(times)
    return found


def prefix_of(found: np.ndarray, common: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` grams of a sorted set: those that are not common by their hash, then the common ones, rarest first.

    ``common`` is sorted by hash, ``places`` are the places in the order of rarity.
    """
    if not len(common):
        return found[:size]
    at = np.minimum(np.searchsorted(common, found), len(common) - 1)
    here = common[at] == found
    first = found[~here][:size]
    if len(first) == size:
        return first
    rest = at[here]
    return np.concatenate([first, common[rest[np.argsort(places[rest])]][:size - len(first)]])


def mark_of(found: np.ndarray) -> bytes:
    """A power of two of bits, as many as grams at least; each gram turns one over, so sets differ in as many grams as bits at least."""
    bits = max(MARK_BITS, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two marks differ, the longer one folded to the length of the other."""
    a, b = sorted((np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)), key=len)
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def signed(docs: DataFrame, text: str, rule: Rule, order: Broadcast) -> DataFrame:
    """``docs`` without their text, with the key of the gram set (null without words), its size, labels, sketch, prefix and mark.

    The sketch is the low byte of each MinHash value. The prefix is of tokens.
    ``order`` holds the common ones.
    """
    made: list = []

    def work(texts: list[str | None]) -> dict[str, list]:
        if not made:
            places = np.argsort(order.value, kind="stable")
            made.extend([Signer(rule), order.value[places], places])
        signer, common, places = made
        out: dict[str, list] = {c: [] for c in ("key", "n", "labels", "sketch", "prefix", "mark")}
        for t in texts:
            found = grams(t, rule.n)
            row = [None] * len(out)
            if len(found):
                least = signer.values(found)
                first = prefix_of(tokens_of(found), common, places, rule.prefix(len(found)))
                row = [xxhash.xxh3_128_digest(found.tobytes()), len(found), signer.labels(least),
                       (least & np.uint32(255)).astype(np.uint8).tobytes(), first.astype(np.int64), mark_of(found)]
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        return out

    return with_columns_from_text(
        docs, text, "key binary, n int, labels array<bigint>, sketch binary, prefix array<bigint>, mark binary", work)


def _alike(pairs: DataFrame, reps: DataFrame, rule: Rule, least: float) -> DataFrame:
    """The pairs (a, b) whose sketches agree in a share of at least ``least``."""
    python_ready(reps.sparkSession)
    sketches = reps.select("id", "sketch")
    both = pairs.join(sketches.withColumnsRenamed({"id": "a", "sketch": "x"}), "a")
    both = both.join(sketches.withColumnsRenamed({"id": "b", "sketch": "y"}), "b").select("a", "b", "x", "y")

    @F.pandas_udf("boolean")
    def agree(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        left, right = (np.frombuffer(b"".join(s), dtype=np.uint8).reshape(len(s), -1) for s in (x, y))
        return pd.Series((left == right).mean(axis=1) >= least)

    return both.filter(agree("x", "y")).select("a", "b")


def _grown(heads: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """(node, id, root) of the sets in crowded nodes, each node with a prefix as long as it takes.

    ``heads`` holds (tree, label, id, root). The values after the shortest prefix stand in the sketch, as
    bytes. A set goes to the shortest prefix with ``crowd`` sets at most, or to the longest one.
    """
    more = rule.longest - rule.depth
    first = F.col("tree") * rule.longest + rule.depth + 1
    rest = heads.join(reps.select("id", "sketch"), "id").select(
        "tree", "label", "id", "root", F.substring("sketch", first, F.lit(more)).alias("rest"))
    # In the order of the values, a prefix is crowded if it is that of a row and of the row ``crowd`` places on.
    by_value = W.partitionBy("label").orderBy("rest", "id")
    there = F.lead("rest", rule.crowd).over(by_value)
    start = lambda c, k: F.substring(c, F.lit(1), F.lit(k))
    shared = sum((F.coalesce((start("rest", k) == start("_there", k)).cast("int"), F.lit(0)) for k in range(1, more + 1)), F.lit(0))
    placed = rest.withColumn("_there", there).withColumn("_shared", shared)
    crowded = F.max("_shared").over(by_value.rowsBetween(-rule.crowd, 0))
    placed = placed.withColumn("length", F.least(crowded + 1, F.lit(more)))
    prefix = F.substring("rest", F.lit(1), F.col("length"))
    node = F.xxhash64("label", "length", prefix)
    return placed.select(node.alias("node"), "id", "root")


def _merged(nodes: DataFrame, reps: DataFrame, rule: Rule, least: float) -> DataFrame:
    """(a, b): cluster a goes to cluster b, as sets in one node whose sketches agree ask for; a row per cluster and round.

    ``nodes`` is (node, id, root), a set for each cluster. In the first round each set is held against one other only, the
    least of the first ones of its nodes, so a large group becomes few clusters by a pair for each set.
    From then on each node's clusters are held against its first ``crowd``; those that agree join them
    and leave the node with them; what is left is held against the first of the rest, and so on.
    """
    found, nearest = [], True
    while True:
        first = W.partitionBy("node").orderBy("id")
        centres = written(nodes.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= rule.crowd).drop("_n"), "centres")
        other = centres.select("node", F.col("id").alias("a"), F.col("root").alias("_r"))
        met = nodes.join(other, "node").filter((F.col("a") < F.col("id")) & (F.col("root") != F.col("_r")))
        pairs = met.groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a")).select("a", "b") if nearest else met.select(
            "a", F.col("id").alias("b")).distinct()
        agreed = written(_alike(pairs, reps, rule, least), "agreed")
        roots = nodes.select("id", "root").distinct()
        joined = agreed.join(roots.withColumnsRenamed({"id": "a", "root": "ra"}), "a").join(
            roots.withColumnsRenamed({"id": "b", "root": "rb"}), "b")
        stars = components(joined.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        found.append(stars.select(F.col("node").alias("a"), F.col("root").alias("b")))
        joined = stars.select(F.col("node").alias("root"), F.col("root").alias("_to"))
        renamed = lambda df: df.join(joined, "root", "left").withColumn("root", F.coalesce("_to", "root")).drop("_to")  # noqa: E731, B023
        rest = renamed(nodes)
        if not nearest:
            rest = rest.join(renamed(centres).select("node", "root").distinct(), ["node", "root"], "left_anti")
        rest = rest.groupBy("node", "root").agg(F.min("id").alias("id"))
        several = rest.groupBy("node").agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1").select("node")
        nodes = written(rest.join(several, "node").select("node", "id", "root"), "nodes")
        discard(centres, agreed)
        nearest = False
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, found)


def likely(reps: DataFrame, rule: Rule) -> DataFrame:
    """(node, root): clusters of gram sets that the forest brings together and whose sketches agree.

    A node of the forest is a prefix of a tree's values. At the shortest prefix each set is held against one other first,
    the least of all first members of its nodes: in a group of near copies that
    is the same set for nearly all. Where a node still holds several clusters, their first members are held
    against each other; if there are more than ``crowd``, the prefix grows until no more are together
    (``_grown``). So a node with a third of all sets costs a row for each of them, not
    for each pair, and all pairs of a cluster are left to verification.
    """
    nodes = written(reps.select("id", F.posexplode("labels").alias("tree", "label")), "forest")
    first = nodes.groupBy("label").agg(F.min("id").alias("a"), F.max("id").alias("_z")).filter("a <> _z").drop("_z")
    met = written(nodes.join(first, "label"), "met")
    discard(nodes)
    bound = rule.similarity - rule.doubt
    nearest = met.groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a")).filter("a <> b").select("a", "b")
    edges = written(_alike(nearest, reps, rule, bound), "alike")
    clusters = components(edges)
    named = met.join(clusters, met["id"] == clusters["node"], "left").select("tree", "label", "id", F.coalesce("root", "id").alias("root"))
    heads = named.groupBy("tree", "label", "root").agg(F.min("id").alias("id"))
    sizes = heads.groupBy("label").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    heads = written(heads.join(sizes, "label"), "heads")
    small = heads.filter(F.col("size") <= rule.crowd).select(F.col("label").alias("node"), "id", "root")
    grown = _grown(heads.filter(F.col("size") > rule.crowd).select("tree", "label", "id", "root"), reps, rule)
    more = _merged(written(small.unionByName(grown), "nodes"), reps, rule, bound - rule.doubt)
    stars = clusters.select(F.col("node").alias("a"), F.col("root").alias("b"))
    found = components(stars.unionByName(more)) if more.limit(1).count() else clusters
    discard(met, heads, edges, *([clusters] if found is not clusters else []))
    return found


def _met_in_lists(reps: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): all pairs of sets in different clusters that may be similar by their prefixes, as edges of sets or clusters.

    Similar sets share a token of their prefixes, are nearly of one length and have enough n-grams left from the first
    common one on. A token is looked at if it stands in several clusters. A cluster of more than
    ``large`` sets is one row of a token's list, with the bounds of its sets.
    """
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    named = clusters.join(sizes, "root").select(F.col("node").alias("id"), "root", (F.col("size") > rule.large).alias("large"))
    placed = reps.select("id", "n", "prefix").join(named, "id", "left").select(
        "id", F.coalesce("root", "id").alias("root"), F.coalesce("large", F.lit(False)).alias("large"), "n", F.posexplode("prefix").alias("q", "token"))
    lists = W.partitionBy("token")
    mixed = placed.withColumn("_lo", F.min("root").over(lists)).withColumn("_hi", F.max("root").over(lists)).filter("_lo <> _hi")
    who = F.when(F.col("large"), F.col("root")).otherwise(F.col("id"))
    mixed = written(mixed.groupBy("token", "root", "large", who.alias("who")).agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("q")).alias("left")), "mixed")
    other = mixed.select("token", *[F.col(c).alias(f"_{c}") for c in mixed.columns if c != "token"])
    lengths = (F.col("hi") >= F.col("_lo") * rule.similarity - NEARLY) & (F.col("_hi") >= F.col("lo") * rule.similarity - NEARLY)
    enough = F.least("left", "_left") >= rule.least_overlap(F.col("lo") + F.col("_lo"))
    met = mixed.join(other, "token").filter((F.col("root") < F.col("_root")) & lengths & enough)
    whole = F.col("large") | F.col("_large")
    met = written(met.select(F.col("who").alias("a"), F.col("_who").alias("b"), whole.alias("whole")).distinct(), "met")
    python_ready(reps.sparkSession)
    marks = reps.select("id", "n", "mark")
    near = met.filter("not whole").join(marks.withColumnsRenamed({"id": "a", "n": "_n", "mark": "x"}), "a")
    near = near.join(marks.withColumnsRenamed({"id": "b", "mark": "y"}), "b")

    @F.pandas_udf("int")
    def apart(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([differing(a, b) for a, b in zip(x, y, strict=True)], dtype="int32")

    both = F.col("n") + F.col("_n")
    near = near.filter(apart("x", "y") <= both - 2 * rule.least_overlap(both)).select("a", "b")
    found = written(near.unionByName(met.filter("whole").select("a", "b")), "found")
    discard(mixed, met)
    return found


def complete(reps: DataFrame, clusters: DataFrame, rule: Rule) -> DataFrame:
    """(node, root): ``clusters`` joined until no two similar sets are in different ones."""
    more = _met_in_lists(reps, clusters, rule)
    if more.isEmpty():
        discard(more)
        return clusters
    found = components(more.unionByName(clusters.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    discard(more, clusters)
    return found


def intersections(sets: list[np.ndarray], heavy: int = 24, columns: int = 4096) -> np.ndarray:
    """Common grams of all pairs of sets: products of 0/1 columns for grams of many sets, counted pairs for the others."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.zeros((n, n), dtype=np.float32)
    wide = np.flatnonzero(count > heavy)
    place = np.full(len(count), -1, dtype=np.int64)
    place[wide] = np.arange(len(wide))
    at = place[code]
    for i in range(0, len(wide), columns):
        inside = (at >= i) & (at < i + columns)
        table = np.zeros((n, min(columns, len(wide) - i)), dtype=np.float32)
        table[owner[inside], at[inside] - i] = 1
        out += table @ table.T
    few = (count[code] > 1) & (at < 0)
    order = np.argsort(code[few], kind="stable")
    gram, row = code[few][order], owner[few][order]
    for k in range(1, heavy):
        same = gram[k:] == gram[:-k]
        if not same.any():
            break
        pairs = np.bincount(row[:-k][same] * n + row[k:][same], minlength=n * n).reshape(n, n)
        out += pairs + pairs.T
    return out


def links_of(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked documents of each set, and the first set of its linked group, over the pairs whose sides are equal or differ as asked.

    ``side`` is 0 for all sets of one block; two blocks are held against each
    other only, not within.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    common = intersections(sets).astype(np.float64)
    linked = common * (1 + similarity) >= similarity * (sizes[:, None] + sizes[None, :]) - NEARLY
    np.fill_diagonal(linked, False)
    if side.any():
        linked &= side[:, None] != side[None, :]
    root = np.arange(len(sets))
    reach = linked | np.eye(len(sets), dtype=bool)
    while True:
        lower = np.where(reach, root[None, :], len(sets)).min(axis=1)
        lower = lower[lower]
        if (lower == root).all():
            return linked @ copies, root
        root = lower


def _classified(docs: DataFrame, doc_id: str, text: str, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, _h, _g, key) and sets (key, root, copies, links), both written; _h and _g are the text's hashes."""
    hashed = docs.select(
        docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("_text"),
        F.xxhash64(docs[text]).alias("_h"), F.xxhash64(docs[text], F.lit(1)).alias("_g"),
    )
    order = docs.sparkSession.sparkContext.broadcast(common_grams(hashed, "_text", rule))
    rows = written(signed(hashed, "_text", rule, order), "signatures")
    reps = rows.filter("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("_h", "_g")).alias("text"),
        *[F.any_value(c).alias(c) for c in ("n", "labels", "sketch", "prefix", "mark")])
    reps = written(reps.withColumn("id", F.monotonically_increasing_id()), "sets")
    places = written(rows.select("doc_id", "_h", "_g", "key"), "places")
    discard(rows)
    order.unpersist()
    clusters = complete(reps, likely(reps, rule), rule)

    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    members = clusters.join(sizes, "root").withColumnRenamed("node", "id")
    parts = F.ceil(F.col("size") / rule.rows_per_task).cast("int")
    groups = max(1, -(-clusters.count() // rule.rows_per_task))
    members = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    members = members.join(reps.select("id", "copies", "text"), "id")
    wanted = written(members.select(
        "id", "root", "parts", "part", "copies", F.col("text._h").alias("_h"), F.col("text._g").alias("_g")), "members")
    texts = wanted_rows(hashed.select("_h", "_g", "_text"), wanted, ["_h", "_g"]).groupBy("id").agg(
        F.any_value("_text").alias("_text"), F.any_value("root").alias("root"), F.any_value("parts").alias("parts"),
        F.any_value("part").alias("part"), F.any_value("copies").alias("copies"))
    # Part i meets every part; a small cluster shares a task with others.
    met = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    single = F.col("parts") == 1
    met = met.select(
        "id", "_text", "copies", "part",
        F.when(single, F.pmod(F.xxhash64("root"), F.lit(groups)).cast("string")).otherwise(F.concat(F.lit("c"), "root")).alias("task"),
        F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
    )

    def verify(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("id", ignore_index=True)
        sets = [grams(t, rule.n) for t in batch["_text"]]
        side = (batch["part"] == key[2]).to_numpy().astype(int) if key[1] != key[2] else np.zeros(len(batch), dtype=int)
        links, root = links_of(sets, batch["copies"].to_numpy(), side, rule.similarity)
        return pd.DataFrame({"a": batch["id"], "b": batch["id"].to_numpy()[root], "links": links})

    verified = met.groupBy("task", "low", "high").applyInPandas(verify, "a long, b long, links long")
    verified = written(verified, "verified")
    links = verified.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    classes = components(verified.select("a", "b"))
    sets = reps.select("key", "id", "copies").join(classes.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
    sets = sets.select("key", F.coalesce("root", "id").alias("root"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    sets = written(sets, "classes")
    discard(reps, wanted, verified, clusters, classes)
    return places, sets


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Every row's class and links: doc_id, class_id, n_links.

    Two rows are linked if the Jaccard similarity of their word n-gram sets is at
    least ``rule.similarity``; a class is what links connect, named by its least
    doc_id; n_links counts the other rows a row is linked to, exact copies too.

    Equal sets are one set with a number of copies. Sets that share a matched
    prefix of their MinHash signature in a tree of the forest form clusters
    (``likely``); sets that it left apart meet by the prefix filter, which leaves out no similar pair (``complete``). All pairs inside a cluster are then verified exactly, in blocks
    of bounded size: a large cluster is cut into parts, and each two parts meet
    in a task that returns a row per set, never a row per pair. Only texts of
    clustered sets move.

    Rows without words (null, empty) are linked to nothing and are classes of
    their own, named by their doc_id. With fewer words than n all words make
    one n-gram. A class whose ids are all null has a null name. Repeated rows
    are copies. An empty table gives no rows. Other columns are not used.
    """
    rows, sets = _classified(docs, doc_id, text, rule)
    named = rows.join(sets, "key", "left").withColumn("_alone", F.col("key").isNull())
    names = named.filter(~F.col("_alone")).groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("class_id"))
    out = named.join(names, F.col("root") == F.col("_root"), "left")
    return out.select(
        "doc_id", F.when(F.col("_alone"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
    )


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``docs`` with one row of each class of near copies: the one with the least id, then the least text hash.

    Rows without words are all kept. An id comes before a null. Of repeated rows
    with equal id and text one stays. All columns pass through.
    """
    columns = docs.columns
    # A null id is 0 with a mark, so that keys are plain columns.
    whole = docs.select(
        F.coalesce(docs[doc_id], F.lit(0)).alias("_id"), docs[doc_id].isNull().alias("_none"), F.xxhash64(docs[text]).alias("_h"),
        F.xxhash64(docs[text], F.lit(1)).alias("_g"), F.struct(*[docs[c] for c in columns]).alias("_doc"))
    rows, sets = _classified(docs, doc_id, text, rule)
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("_h"), F.col("_g"))
    worded = rows.filter("key is not null").join(sets.select("key", "root"), "key")
    places = written(worded.groupBy("root", place.alias("place")).agg(F.count(F.lit(1)).alias("times")), "places")
    first = places.groupBy("root").agg(F.min("place").alias("first"))
    judged = places.join(first, "root").select("place.*", "times", (F.col("place") == F.col("first")).alias("stays"))
    judged = written(judged.filter(~F.col("stays") | (F.col("times") > 1)), "places")
    discard(rows, sets, places)
    keys = ["_id", "_none", "_h", "_g"]
    named = judged.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), "n", F.col("_h"), F.col("_g"), "stays").withColumnRenamed("n", "_none")
    kept = other_rows(whole, named, keys).select("_doc")
    once = wanted_rows(whole, named.filter("stays").drop("stays"), keys).dropDuplicates(keys).select("_doc")
    return kept.unionByName(once).select("_doc.*")
