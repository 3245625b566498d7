"""Column checks, cleaning filters, one row per key, and quality counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.measures import is_valid_reading, without_sentinel


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that lists what is missing."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; present are {sorted(df.columns)}")
    return df


def fill_absent(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed null for every named column the frame lacks."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def clear_sentinels(df: DataFrame, columns: Sequence[str], sentinel: float = v.SENTINEL) -> DataFrame:
    """Null instead of the sentinel, in those of the columns that exist."""
    return df.withColumns({c: without_sentinel(F.col(c), sentinel) for c in columns if c in df.columns})


def valid_readings(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_valid_reading(F.col(column)))


def clean_ridership(df: DataFrame, day: str, line: str, hour: str, passengers: str) -> DataFrame:
    """Typed hourly counts: trimmed line, positive passengers, hour of the day in range."""
    typed = df.withColumns({
        day: F.col(day).try_cast("date"),
        line: F.trim(F.col(line)),
        hour: F.col(hour).try_cast("int"),
        passengers: F.col(passengers).try_cast("bigint"),
    })
    return typed.filter((F.col(passengers) > 0) & F.col(hour).between(0, 23))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """The row of each key that is first (or last) in ``order``; ties fall to the other columns.

    A null in the order comes last either way: an unreadable value never beats a
    readable one. The choice is an aggregate over structs, so every task keeps
    one row per key before the shuffle and a key with very many copies costs no
    more than any other; Spark plans it as a sort aggregate, which sorts the
    rows of a task and spills. Rows with a null in the key are no copies of each
    other: each gets a key part of its own and all of them stay, in the same pass.
    """
    rest = [c for c in df.columns if c not in keys]
    marks = [(o.isNull() != F.lit(last)).alias(f"_n{i}") for i, o in enumerate(order)]
    parts = [x for i, o in enumerate(order) for x in (marks[i], o.alias(f"_o{i}"))]
    entry = F.struct(*parts, *[F.col(c) for c in rest])
    known = F.lit(True)
    for k in keys:
        known &= F.col(k).isNotNull()
    own = F.when(~known, F.monotonically_increasing_id())
    pick = F.max if last else F.min
    kept = df.withColumns({"_own": own, "_e": entry}).groupBy(*keys, "_own").agg(pick("_e").alias("_e"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_e.{c}").alias(c) for c in df.columns])


def latest_per_entity(df: DataFrame, entity: Sequence[str], moment: str) -> DataFrame:
    """Newest row of each entity."""
    return one_per_key(df, entity, [F.col(moment)], last=True)


def counters(df: DataFrame, status: Column, alias: str = "status") -> DataFrame:
    """Rows per status: the quality counters of a cleaning step."""
    return df.groupBy(status.alias(alias)).agg(F.count(F.lit(1)).alias("n"))
