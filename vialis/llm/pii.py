"""Personal data: fixed patterns as seeds, and contexts learned from them that find unseen identifiers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import with_columns_from_text, written
from vialis.llm.spans import SPAN, Span, counted, joined, matches

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
SPACE = re.compile(r"\s")
LONGEST = 64


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the @ signs in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans by kind, then start; offsets are code points."""
    found = {"email": emails(text) if "@" in text else []}
    found["ip"] = matches(IP, text, lambda m: all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")))
    found["card"] = matches(CARD, text, lambda m: 13 <= len(d := _digits(m[0])) <= 19 and luhn(d))
    found["phone"] = matches(PHONE, text, lambda m: 9 <= len(_digits(m[0])) <= 15) if "+" in text else []
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def _word(token: str) -> str:
    if MARK.search(token):
        return "#"
    return re.sub(r"[\W_]+", "", token.lower())


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: one or two words before it, one after, and one on both sides."""
    before = [_word(t) for t in text[max(0, start - 60):start].split()[-2:]]
    after = [_word(t) for t in text[end:end + 40].split()[:1]]
    left, right = (before or [""])[-1], (after or [""])[0]
    out = []
    if left:
        out.append(f"l {left}")
        if len(before) == 2 and before[0]:
            out.append(f"ll {before[0]} {left}")
        if right:
            out.append(f"lr {left} {right}")
    if right:
        out.append(f"r {right}")
    return out


def candidates(text: str, base: list[Span]) -> list[tuple]:
    """(kind or None, start, end, instance, contexts) of the base spans and of other identifier-like tokens.

    Such a token has an @ sign or five digits and 6 to ``LONGEST`` characters,
    punctuation at its ends left off, and touches no base span.
    """
    out = [(k, s, e, text[s:e].lower(), contexts(text, s, e)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    nxt, at = 0, 0
    while m := MARK.search(text, at):
        start, stop = m.start(), SPACE.search(text, m.start())
        end = stop.start() if stop else len(text)
        while start > at and not text[start - 1].isspace():
            start -= 1
        at = end
        while start < end and not text[start].isalnum():
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        while nxt < len(taken) and taken[nxt][1] <= start:
            nxt += 1
        token = text[start:end]
        free = nxt == len(taken) or taken[nxt][0] >= end
        if free and 6 <= len(token) <= LONGEST and ("@" in token or sum(c in "0123456789" for c in token) >= 5):
            out.append((None, start, end, token.lower(), contexts(text, start, end)))
    return out


@dataclass(frozen=True)
class Trust:
    """When a pattern or an instance counts: seeds behind a pattern, its confidence, an instance's score, rounds."""

    support: float = 8.0
    confidence: float = 0.8
    score: float = 0.8
    rounds: int = 3


def _scored_patterns(seen: DataFrame, trust: Trust) -> tuple[DataFrame, DataFrame]:
    """Patterns (pattern, kind, confidence) and instances (instance, kind, score) that can be trusted.

    The graph has an edge per pattern and instance. In each round a pattern's
    confidence for a kind is the score of its instances of that kind against
    all its instances, two more counted as doubt; an instance that is no seed
    gets one minus the product of the doubts in its trusted patterns.
    """
    edges = written(seen.select(F.explode("contexts").alias("pattern"), "instance").distinct(), "edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = written(seen.filter(F.col("kind").isNotNull()).select("instance", "kind", F.lit(1.0).alias("score")).distinct(), "seeds")
    scores = seeds
    for _ in range(trust.rounds):
        mass = edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("mass"))
        patterns = mass.filter(F.col("mass") >= trust.support).join(sizes, "pattern").select(
            "pattern", "kind", (F.col("mass") / (F.col("n") + 2)).alias("confidence"),
        ).filter(F.col("confidence") >= trust.confidence)
        patterns = written(patterns, "patterns")
        doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        unseen = edges.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("score"))
        unseen = unseen.filter(F.col("score") >= trust.score).join(seeds.select("instance"), "instance", "left_anti")
        scores = written(seeds.unionByName(unseen), "scores")
    return patterns, scores.join(seeds, ["instance", "kind"], "left_anti")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", trust: Trust = Trust()) -> DataFrame:
    """Personal data of every row: doc_id, base (spans of the fixed patterns) and added (spans from contexts).

    The fixed patterns are the seeds. Their surrounding words become patterns;
    patterns and identifier-like tokens score each other in rounds of joins over
    the distinct (pattern, instance) edges. A token is added where it stands in a
    trusted pattern and its own score is high enough. Texts are read once;
    what moves are tokens and their contexts, counted in the tasks first.

    A null text is empty and has no spans, a null id is kept, repeated rows each
    get their spans, an empty table gives none. Other columns are not used.
    """
    def work(texts: list[str | None]) -> dict[str, list]:
        base = [base_spans(t) if t else [] for t in texts]
        as_rows = lambda found: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in found]
        names = ("kind", "start", "end", "instance", "contexts")
        seen = [[dict(zip(names, c, strict=True)) for c in candidates(t, b)] if t else [] for t, b in zip(texts, base, strict=True)]
        return {"base": [as_rows(b) for b in base], "seen": seen}

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("_text"))
    new = f"base array<{SPAN}>, seen array<struct<kind:string,start:int,end:int,instance:string,contexts:array<string>>>"
    scanned = with_columns_from_text(rows, "_text", new, work)
    scanned = written(scanned.withColumn("_row", F.monotonically_increasing_id()), "scanned")
    seen = scanned.filter(F.size("seen") > 0).select("_row", F.inline("seen"))
    patterns, found = _scored_patterns(seen, trust)
    at = seen.filter(F.col("kind").isNull()).select("_row", "start", "end", "instance", F.explode("contexts").alias("pattern"))
    added = at.join(patterns, "pattern").join(found, ["instance", "kind"]).select("_row", "kind", "start", "end").distinct()
    # One kind for a token: the first by name.
    added = added.groupBy("_row", "start", "end").agg(F.min("kind").alias("kind"))
    lists = added.groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    none = F.array().cast(f"array<{SPAN}>")
    return scanned.join(lists, "_row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""
    base = joined(F.col("base"), KINDS, by_start=False)
    return found.select(
        "doc_id", *[counted(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        joined(F.concat("base", "added"), KINDS, by_start=False).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )
