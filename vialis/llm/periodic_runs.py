"""Periodic runs of words in texts, by uniting suffix classes in the order of falling common prefixes."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vialis.llm.common import python_ready

CHUNK = 512
WORDS_AT_ONCE = 200_000
FOUND = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

Tail = Callable[[int | None, int], tuple[int, int] | None]


@dataclass(frozen=True)
class Rule:
    """Least length of a run, in words and in periods."""

    words: int = 24
    periods: int = 3

    @property
    def prefix(self) -> int:
        """Least common prefix of a run's start and the place one period on.

        A run of length L and period q has L - q words there, and q is at
        most L / periods: shorter common prefixes can give no run.
        """
        return max(1, self.words - self.words // self.periods)

    def seeds(self, distance: np.ndarray | int, common: np.ndarray | int) -> np.ndarray | bool:
        return (distance + common >= self.words) & (common >= (self.periods - 1) * distance)


class Positions:
    """An ordered set of positions in chunks, so that adding one costs the same in large sets as in small ones."""

    def __init__(self, first: int):
        self.chunks = [[first]]
        self.heads = [first]
        self.size = 1

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Put a position in; its neighbours below and above."""
        at = max(0, bisect_left(self.heads, x) - 1)
        chunk = self.chunks[at]
        i = bisect_left(chunk, x)
        below = chunk[i - 1] if i else None
        above = chunk[i] if i < len(chunk) else self.heads[at + 1] if at + 1 < len(self.heads) else None
        chunk.insert(i, x)
        self.heads[at] = chunk[0]
        if len(chunk) > CHUNK:
            half = len(chunk) // 2
            self.chunks.insert(at + 1, chunk[half:])
            self.heads.insert(at + 1, chunk[half])
            del chunk[half:]
        self.size += 1
        return below, above

    def unite(self, other: Positions) -> Iterator[tuple[int, int]]:
        """Put another set in; the pairs of positions that were no neighbours in either set and are now."""
        last, added = None, list(other)
        for p, after in zip(added, [*added[1:], None], strict=True):
            below, above = self.add(p)
            if below is not None and below != last:
                yield below, p
            if above is not None and (after is None or above < after):
                yield p, above
            last = p

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk


def repeated(ids: np.ndarray, length: int) -> np.ndarray:
    """Positions whose next ``length`` ids may stand at another position, too: equal ones always do, by their hash."""
    if len(ids) < length:
        return np.zeros(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        base, done, out, step = np.uint64(0xD1342543DE82EF95), 0, np.zeros(len(ids) - length + 1, dtype=np.uint64), 1
        while length - done:
            if (length - done) & step:
                out = out * base + h[done:done + len(out)]
                done += step
            if done < length:
                h = h[:-step] * base + h[step:]
                base, step = base * base, step * 2
    order = np.argsort(out)
    equal = out[order[1:]] == out[order[:-1]]
    marks = np.zeros(len(out), dtype=bool)
    marks[order[1:][equal]] = True
    marks[order[:-1][equal]] = True
    return np.flatnonzero(marks)


def _dense(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1).astype(np.int64)


def ordered_suffixes(ids: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at the positions ``at`` whose first ``length`` ids repeat, in lexicographic order, and their common prefixes.

    Second come the lengths of the common prefixes of each suffix with the next
    one, those under ``length`` as 0. ``ids`` ends in ``2 * length`` ids that
    stand nowhere else. Ranks by the first ``length`` ids are doubled until all
    suffixes are told apart; a suffix that stands alone keeps its rank.
    """
    reach = np.unique(np.concatenate([at, np.minimum(at + length, len(ids) - length)]))
    windows = np.lib.stride_tricks.sliding_window_view(ids.astype(">u4"), length)
    names = np.ascontiguousarray(windows[reach]).view(f"V{4 * length}").reshape(-1)
    rank = np.full(len(ids), -1, dtype=np.int64)
    rank[reach] = _dense(names)
    levels, k = [], length
    open_ones = at
    while True:
        sizes = np.bincount(rank[open_ones]) if len(open_ones) else np.zeros(0, dtype=np.int64)
        open_ones = open_ones[sizes[rank[open_ones]] > 1] if len(open_ones) else open_ones
        levels.append((k, rank.copy()))
        if not len(open_ones):
            break
        second = np.zeros(len(reach), dtype=np.int64)
        inside = np.searchsorted(reach, open_ones)
        second[inside] = rank[open_ones + k] + 1
        rank[reach] = _dense(rank[reach] * (len(reach) + 1) + second)
        k *= 2
    order = at[np.argsort(rank[at], kind="stable")]
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(left), dtype=np.int64)
    for k, ranks in reversed(levels):
        same = ranks[left] == ranks[right]
        same &= ranks[left] >= 0
        common[same] += k
        left[same] += k
        right[same] += k
    near = np.flatnonzero(common)
    common[near] += (windows[left[near]] != windows[right[near]]).argmax(axis=1)
    return order, common


def runs_of(ids: np.ndarray, rule: Rule = Rule()) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal periodic runs of a sequence, sorted.

    A Kruskal pass: suffixes next to each other in lexicographic order are united by falling common
    prefix; each class is an ordered set of positions. Two positions i < j that become
    neighbours in a class united at common prefix c have no position between them that shares c ids
    with them. So if j - i is small against c, the j - i + c ids from i on have the smallest
    period j - i, and the next id ends it; if the id before i does not carry it on either,
    this is a run. Every run is met: its start and the place one period
    on become neighbours where their common prefix is reached.
    """
    length = rule.prefix
    ids = np.asarray(ids, dtype=np.int64)
    at = repeated(ids, length)
    if not len(at):
        return []
    end = int(ids.max()) + 1
    order, common = ordered_suffixes(np.concatenate([ids, np.arange(end, end + 2 * length)]), at, length)
    edges = np.flatnonzero(common >= length)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    places = order.tolist()
    parent = list(range(len(places)))
    classes: list[Positions | None] = [None] * len(places)
    found = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for e, c in zip(edges.tolist(), common[edges].tolist(), strict=True):
        a, b = root(e), root(e + 1)
        large, small = classes[a] or Positions(places[a]), classes[b] or Positions(places[b])
        if large.size < small.size:
            a, b, large, small = b, a, small, large
        parent[b], classes[a], classes[b] = a, large, None
        for i, j in large.unite(small):
            if rule.seeds(j - i, c) and (i == 0 or ids[i - 1] != ids[j - 1]):
                found.append((i, j - i + c, j - i))
    return sorted(found)


def planted_tail(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) where the words of a text of n words repeat with period p from word a on; None for a text that stays as it is.

    With h the crc32 of the id in decimal, texts with h % 10 = 0 are changed.
    """
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _chunks(texts: list[bytes | None], ids: list, tail: Tail | None) -> Iterator[tuple[list[list[bytes]], list[int], np.ndarray]]:
    """Texts as words, the number of words before each text, and one sequence of word numbers; equal words of one text have equal ones."""
    lists, starts, numbers = [], [0], []
    for text, doc_id in zip(texts, ids, strict=True):
        words = (text or b"").split()
        place = tail(doc_id, len(words)) if tail else None
        if place:
            a, p = place
            words = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
        seen = defaultdict(count(starts[-1]).__next__)
        numbers.extend(map(seen.__getitem__, words))
        lists.append(words)
        starts.append(len(numbers))
        if len(numbers) >= WORDS_AT_ONCE:
            yield lists, starts, np.array(numbers, dtype=np.int64)
            lists, starts, numbers = [], [0], []
    if lists:
        yield lists, starts, np.array(numbers, dtype=np.int64)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by blanks."""
    if runs:
        change = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        keep = np.cumsum(change[:-1]) == 0
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule(), tail: Tail | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row.

    Words stand between ASCII white space. A run is a stretch of words with smallest period q (words q
    apart are equal), at least ``words`` and ``periods * q`` long, that no neighbouring word
    carries on; ``runs`` is sorted by start, then period, words counted from 0. ``collapsed`` is the text without the words
    that some run holds after its first q, joined by single blanks. ``tail`` may make the end of a text periodic first.

    Whole texts are searched, each by itself; a task holds some 200,000 words at once, or one text if that is longer.
    A null or empty text has no words, no runs and an empty
    ``collapsed``; ids may be null or repeat: each row is judged by itself; an empty table gives no rows. Other columns are not used.
    """
    python_ready(docs.sparkSession)
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("binary").alias("text"))
    added = StructType.fromDDL(FOUND)
    types = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for lists, starts, numbers in _chunks(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist(), tail):
                runs = [[] for _ in lists]
                for start, length, period in runs_of(numbers, rule):
                    k = bisect_right(starts, start) - 1
                    runs[k].append((start - starts[k], length, period))
                text = pa.array([_collapsed(w, r) for w, r in zip(lists, runs, strict=True)], type=pa.binary()).view(pa.string())
                named = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in runs]
                columns = [batch.column("doc_id").slice(at, len(lists)), pa.array(map(len, lists), type=pa.int64()),
                           pa.array(named, type=types.field("runs").type), text]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *types.names])
                at += len(lists)

    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], *added.fields]))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run with the most periods and hashes of each row of ``find``.

    Of runs with equally many periods the first start counts, then the shortest period.
    """
    def order(x, y):
        return F.when(x["length"] * y["period"] > y["length"] * x["period"], -1).when(
            x["length"] * y["period"] < y["length"] * x["period"], 1).when(
            x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int")).otherwise(
            F.signum(x["period"] - y["period"]).cast("int"))

    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
