"""Spans in texts: what the finders of personal data and of secrets share."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[str, int, int]
SPAN = "struct<kind:string,start:int,end:int>"


def matches(pattern: re.Pattern, text: str, good: Callable[[re.Match], bool]) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap; those that fail ``good`` are dropped, nothing is tried again inside them."""
    return [m.span() for m in pattern.finditer(text) if good(m)]


def joined(spans: Column, order: Sequence[str], by_start: bool) -> Column:
    """``kind:start:end`` of all spans, comma-joined, by kind then start or by start then kind."""
    rank = lambda s: F.coalesce(F.array_position(F.array(*[F.lit(k) for k in order]), s["kind"]), F.lit(0))
    keys = (lambda s: [s["start"].alias("a"), rank(s).alias("b")]) if by_start else (lambda s: [rank(s).alias("a"), s["start"].alias("b")])
    sortable = F.array_sort(F.transform(spans, lambda s: F.struct(*keys(s), s["end"].alias("c"), s.alias("s"))))
    text = F.transform(sortable, lambda x: F.concat_ws(":", x["s"]["kind"], x["s"]["start"], x["s"]["end"]))
    return F.array_join(text, ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
