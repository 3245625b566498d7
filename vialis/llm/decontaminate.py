"""Benchmark passages in documents: shared q-grams in diagonal bands, then banded alignment."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import with_columns_from_text, written
from vialis.operators.ranking import running_total

LEAK = "struct<item_id:bigint,start:int,end:int,edits:int>"
BLOCK_CHARS = 2_000_000
AT_ONCE = 1_000_000
BITS = 22
PRIME = np.uint64(0x9E3779B97F4A7C15)
APART = np.uint32(0x1FFFFF)
#: Letters of scripts that put no space between words, as ranges of code points.
UNSPACED = ((0x0E00, 0x10A0), (0x1780, 0x1800), (0x2E80, 0x3130), (0x31A0, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x20000, 0x30000))


@dataclass(frozen=True)
class Rule:
    """Edits allowed per character of an item, q-gram length, fewest characters of an item that may be edited at all."""

    rate: float = 0.05
    q: int = 12
    shortest: int = 24

    def budget(self, m: int) -> int:
        """Edits allowed for ``m`` characters, so few that some q-gram has to be shared."""
        return max(0, min(int(self.rate * m), (m - self.q) // self.q))

    def shared(self, m: int) -> int:
        """q-grams that a match within the budget keeps at least (the q-gram lemma)."""
        return m + 1 - self.q - self.q * self.budget(m)


def _plain_table() -> np.ndarray:
    """Lower-case code point of each letter and digit, 0 for all other characters."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x30000):
        c = chr(point)
        if c.isalnum():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_PLAIN: list[np.ndarray] = []


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits in lower case with one 0 between words, and the place of each in ``text``."""
    if not _PLAIN:
        _PLAIN.append(_plain_table())
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = _PLAIN[0][points]
    keep = codes > 0
    keep[1:] |= keep[:-1] & (codes[1:] == 0)
    places = np.flatnonzero(keep)
    codes = codes[places]
    if len(codes) and codes[-1] == 0:
        codes, places = codes[:-1], places[:-1]
    return codes, places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q codes from each place on, built from hashes of 1, 2, 4 and so on."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    run, power, size = codes.astype(np.uint64), PRIME, 1
    out, have = None, 0
    with np.errstate(over="ignore"):
        while True:
            if q & size:
                if out is None:
                    out = run
                else:
                    out = out[:len(run) - have] * power + run[have:] if have else run
                have += size
            size *= 2
            if size > q:
                break
            run = run[:len(run) - size // 2] * power + run[size // 2:]
            power = power * power
        return out[:n] ^ (out[:n] >> np.uint64(29))


def rows_hashed(rows: np.ndarray) -> np.ndarray:
    """``gram_hashes`` of the whole of each row."""
    total = np.zeros(len(rows), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows.shape[1]):
            total = total * PRIME + rows[:, i]
    return total ^ (total >> np.uint64(29))


class Index:
    """q-grams of a bounded block of items, and the items too short for edits, by length."""

    def __init__(self, items: list[tuple[list[int], str]], rule: Rule):
        self.rule = rule
        coded = [(ids, plain(text)[0]) for ids, text in sorted(items)]
        long = [x for x in coded if len(x[1]) >= max(rule.shortest, rule.q)]
        self.ids = [ids for ids, _ in long]
        self.codes = [c for _, c in long]
        self._put_short([x for x in coded if 0 < len(x[1]) < max(rule.shortest, rule.q)])
        self.sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.width = np.array([2 * rule.budget(m) + 1 for m in self.sizes], dtype=np.int64)
        self.need = np.array([rule.shared(m) for m in self.sizes], dtype=np.int64)
        grams = [gram_hashes(c, rule.q) for c in self.codes]
        hashes = np.concatenate([*grams, np.zeros(0, dtype=np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, dtype=np.int64)]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], owner[order], place[order]
        self.seen = np.zeros(1 << BITS, dtype=bool)
        self.seen[self.hashes >> np.uint64(64 - BITS)] = True

    def _put_short(self, items: list[tuple[list[int], np.ndarray]]) -> None:
        """Short items by their number of characters: (hashes in order, ids, codes)."""
        self.short: dict[int, tuple[np.ndarray, list[list[int]], np.ndarray]] = {}
        for m in sorted({len(c) for _, c in items}):
            some = [x for x in items if len(x[1]) == m]
            codes = np.stack([c for _, c in some])
            hashes = rows_hashed(codes)
            order = np.argsort(hashes, kind="stable")
            self.short[m] = (hashes[order], [some[i][0] for i in order], codes[order])

    def short_places(self, codes: np.ndarray) -> list[tuple[int, int, list[int]]]:
        """(start, end, ids) of every short item that stands in ``codes`` as whole words, without overlaps of an item with itself.

        Next to a letter of a script without spaces a word may begin or end anywhere.
        """
        apart = (codes == 0) | (codes == APART)
        free = apart.copy()
        for a, b in UNSPACED:
            free |= (codes >= a) & (codes < b)
        edge = np.concatenate([[True], free[1:] | free[:-1], [True]])
        begins = np.flatnonzero(edge[:-1] & ~apart)
        out = []
        for m, (hashes, ids, known) in self.short.items():
            at = begins[begins + m <= len(codes)]
            at = at[edge[at + m] & ~apart[at + m - 1]]
            if not len(at):
                continue
            views = np.lib.stride_tricks.sliding_window_view(codes, m)
            sums = np.zeros(len(at), dtype=np.uint64)
            for i in range(0, len(at), 1 << 16):
                sums[i:i + (1 << 16)] = rows_hashed(views[at[i:i + (1 << 16)]])
            low = np.searchsorted(hashes, sums, side="left")
            many = np.searchsorted(hashes, sums, side="right") - low
            for spot in np.flatnonzero(many):
                start = int(at[spot])
                for k in range(int(low[spot]), int(low[spot] + many[spot])):
                    if (known[k] == views[start]).all():
                        out.append((m, k, start))
        found, upto = [], {}
        for m, k, start in sorted(out):
            if start >= upto.get((m, k), 0):
                upto[(m, k)] = start + m
                found.append((start, start + m, self.short[m][1][k]))
        return found

    def regions(self, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, first diagonal, last diagonal) of the bands that share enough q-grams.

        ``codes`` holds several texts, each from its start on. A match within the
        budget keeps its q-grams on neighbouring diagonals, no more than the
        item's width apart; bands are twice as wide and overlap by half, so one
        band holds them all.
        """
        hashes = gram_hashes(codes, self.rule.q)
        spots = np.flatnonzero(self.seen[hashes >> np.uint64(64 - BITS)])
        low = np.searchsorted(self.hashes, hashes[spots], side="left")
        many = np.searchsorted(self.hashes, hashes[spots], side="right") - low
        spots, low, many = spots[many > 0], low[many > 0], many[many > 0]
        if not len(spots):
            return []
        at = np.repeat(spots, many)
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        item, place = self.owner[entry], self.place[entry]
        text = np.searchsorted(starts, at, side="right") - 1
        diagonal = at - starts[text] - place
        band = np.floor_divide(diagonal, self.width[item])
        text, item, place = (np.concatenate([x, x]) for x in (text, item, place))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item, text))
        text, item, place, band = text[order], item[order], place[order], band[order]
        same_band = (np.diff(text) == 0) & (np.diff(item) == 0) & (np.diff(band) == 0)
        fresh = np.concatenate([[True], ~(same_band & (np.diff(place) == 0))])
        heads = np.flatnonzero(np.concatenate([[True], ~same_band]))
        counts = np.add.reduceat(fresh.astype(np.int64), heads)
        good = heads[counts >= self.need[item[heads]]]
        out: list[list[int]] = []
        for t, i, b in zip(text[good].tolist(), item[good].tolist(), band[good].tolist(), strict=True):
            w = int(self.width[i])
            if out and out[-1][0] == t and out[-1][1] == i and b * w <= out[-1][3] + 1:
                out[-1][3] = (b + 2) * w - 1
            else:
                out.append([t, i, b * w, (b + 2) * w - 1])
        return [tuple(x) for x in out]

    def aligned(self, text: np.ndarray, item: int, first: int, last: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the item's best place on these diagonals of a text; None beyond the budget.

        A row per character of the item over the band's diagonals. Costs carry
        their start, so the least is the cheapest, then leftmost place.
        """
        codes = self.codes[item]
        m, n = len(codes), len(text)
        lo, hi = max(0, first), min(n, last + m)
        whole, sought = text[lo:hi].tobytes(), codes.tobytes()
        at = whole.find(sought)
        while at >= 0 and at % 4:
            at = whole.find(sought, at + 1)
        if at >= 0:
            return 0, lo + at // 4, lo + at // 4 + m
        budget = self.rule.budget(m)
        if not budget:
            return None
        big = np.int64(1 << 32)
        far = np.int64(1 << 60)
        diagonals = np.arange(first - 1, last + 2, dtype=np.int64)
        steps = np.arange(len(diagonals), dtype=np.int64) * big
        cost = np.where((diagonals >= 0) & (diagonals <= n), np.maximum(diagonals, 0), far)
        padded = np.full(len(diagonals) + m + 1, APART, dtype=np.uint32)
        a, b = max(0, first - 1), min(n, first - 1 + len(padded))
        if a < b:
            padded[a - (first - 1):b - (first - 1)] = text[a:b]
        for i in range(m):
            ahead = np.append(cost[1:], far) + big
            cost = np.minimum(cost + np.where(padded[i:i + len(cost)] == codes[i], 0, big), ahead)
            ends = diagonals + i + 1
            cost[(ends < 0) | (ends > n)] = far
            cost = np.minimum(np.minimum.accumulate(cost - steps) + steps, far)
            if cost.min() >= (budget + 1) * big:
                return None
        best = int(cost.argmin())
        edits, start = divmod(int(cost[best]), int(big))
        return (edits, start, m + int(diagonals[best])) if edits <= budget else None

    def leaks(self, texts: list[str | None], every_id: bool = False) -> list[list[dict]]:
        """Places of items in each text, offsets in code points of the text; of equal items the first id or every one."""
        out: list[list[dict]] = [[] for _ in texts]
        group: list[tuple[int, np.ndarray, np.ndarray]] = []
        size = 0

        def put(t: int, ids: list[int], start: int, end: int, edits: int) -> None:
            row, _, places = group[t]
            for i in ids if every_id else ids[:1]:
                out[row].append({"item_id": i, "start": int(places[start]), "end": int(places[end - 1]) + 1, "edits": edits})

        def flush() -> None:
            nonlocal size
            if not group:
                return
            gap = np.full(1, APART, dtype=np.uint32)
            codes = np.concatenate([x for _, c, _ in group for x in (c, gap)])
            starts = np.concatenate([[0], np.cumsum([len(c) + 1 for _, c, _ in group])[:-1]])
            for t, item, first, last in self.regions(codes, starts):
                if found := self.aligned(group[t][1], item, first, last):
                    edits, start, end = found
                    put(t, self.ids[item], start, end, edits)
            if self.short:
                for start, end, ids in self.short_places(codes):
                    t = int(np.searchsorted(starts, start, side="right")) - 1
                    put(t, ids, start - int(starts[t]), end - int(starts[t]), 0)
            group.clear()
            size = 0

        for row, text in enumerate(texts):
            codes, places = plain(text) if text else (np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))
            if not len(codes):
                continue
            group.append((row, codes, places))
            size += len(codes)
            if size >= AT_ONCE:
                flush()
        flush()
        return out


def blocks_of(items: DataFrame, item_id: str, text: str, block_chars: int) -> tuple[DataFrame, int]:
    """Items that read differently, each with all ids in order and its block of about ``block_chars`` characters; the number of blocks."""
    def marked(texts: list[str | None]) -> dict[str, list]:
        codes = [plain(t)[0] for t in texts]
        return {"_reads": [hashlib.sha256(c.tobytes()).hexdigest() if len(c) else None for c in codes]}

    rows = items.select(
        items[item_id].cast("bigint").alias("item_id"), items[text].cast("string").alias("text"),
    ).filter("item_id is not null and text is not null")
    read = with_columns_from_text(rows, "text", "_reads string", marked, keep_text=True).filter("_reads is not null")
    rows = written(read.groupBy("_reads").agg(
        F.sort_array(F.collect_set("item_id")).alias("ids"), F.min_by("text", F.struct("item_id", "text")).alias("text"),
    ), "items")
    summed = running_total(rows, [], [F.col("ids")[0], F.col("_reads")], F.length("text"), alias="upto")
    numbered = written(summed.withColumn("block", F.floor((F.col("upto") - F.length("text")) / block_chars)), "blocks")
    last = numbered.agg(F.max("block")).first()[0]
    return numbered, 0 if last is None else last + 1


def with_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    rule: Rule = Rule(), block_chars: int = BLOCK_CHARS, keep_text: bool = True, every_id: bool = False,
) -> DataFrame:
    """``docs`` with ``leaks``: (item_id, start, end, edits) of every benchmark item in the row's text.

    Both sides are compared as letters and digits in lower case, with one space
    between words. An item is found where a passage of the text is within its
    edit budget. The items come in blocks of bounded size, each broadcast and
    matched in one pass over the texts, which stay where they are; nothing is
    shuffled. Items shorter than the rule's ``shortest`` characters are found
    where they stand as whole words, without edits. Items that read the same
    count as the one with the smallest id, or with ``every_id`` each of them has
    its leaks; of overlapping places of an item the best one is given.

    Null and empty texts have no leaks; items that are null, have a null id or
    no letter or digit are no evidence and are left out. Repeated rows get equal answers; without rows or without items the
    result is empty or has no leaks. A column called ``leaks`` is replaced; all
    others pass through.
    """
    kept = [c for c in docs.columns if c.lower() != "leaks" and (keep_text or c != text)]
    rows = docs.select(docs[text].alias("_text"), F.struct(*[docs[c] for c in kept]).alias("_doc"))
    return _marked(rows, items, item_id, item_text, rule, block_chars, every_id).select("_doc.*", "leaks")


def _marked(
    rows: DataFrame, items: DataFrame, item_id: str, item_text: str, rule: Rule, block_chars: int, every_id: bool = False,
) -> DataFrame:
    """Rows (_text, _doc) as rows (_doc, leaks)."""
    spark = rows.sparkSession
    numbered, n_blocks = blocks_of(items, item_id, item_text, block_chars)
    rows = rows.withColumn("leaks", F.array().cast(f"array<{LEAK}>"))
    for block in range(n_blocks):
        part = [(r["ids"], r["text"]) for r in numbered.filter(F.col("block") == block).select("ids", "text").collect()]
        shared = spark.sparkContext.broadcast(Index(part, rule))
        found = with_columns_from_text(
            rows, "_text", f"more array<{LEAK}>", lambda texts, shared=shared: {"more": shared.value.leaks(texts, every_id)},
            keep_text=block + 1 < n_blocks,
        )
        rows = found.withColumn("leaks", F.concat("leaks", "more")).drop("more")
    return rows.drop("_text")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item."""
    rows = docs.select(docs[text].alias("_text"), F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    marked = _marked(rows, items, "item_id", "text", rule, BLOCK_CHARS)
    return marked.filter(F.size("leaks") == 0).select("_doc.*")
