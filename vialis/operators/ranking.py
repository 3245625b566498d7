"""Positions in an order, ranks and top-k, without putting a large order into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vialis.session import settle


def running_total(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    weight: Column | None = None,
    alias: str = "position",
    settled: bool = False,
) -> DataFrame:
    """Running sum of ``weight`` (1 by default: the row number) along ``order`` in each group.

    ``order`` has to be total. The rows are cut into range partitions of equal
    size by (group, order), each numbered on its own, and every part starts from
    the total of the parts before it; that step sees one row per group and part,
    so no task holds a whole large group. ``settled`` says that ``df`` already is
    a settled frame.
    """
    weight = F.lit(1) if weight is None else weight
    rows = df.withColumn("_w", weight.cast("bigint"))
    rows = rows if settled else settle(rows)
    sliced = rows.repartitionByRange(*[F.col(g) for g in groups], *order)
    sliced = settle(sliced.withColumn("_slice", F.spark_partition_id()))
    before = W.partitionBy(*groups).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = sliced.groupBy(*groups, "_slice").agg(F.sum("_w").alias("_part")).select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_start"),
    )
    same_part = F.col("_slice") == F.col("_s")
    for g in groups:
        same_part &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    along = W.partitionBy(*groups, "_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = sliced.withColumn("_inside", F.sum("_w").over(along)).join(starts, same_part)
    return numbered.withColumn(alias, F.col("_start") + F.col("_inside")).select(
        *[c for c in df.columns if c != alias], alias
    )


def ranked(df: DataFrame, order: Sequence[Column], alias: str, groups: Sequence[str] = ()) -> DataFrame:
    """Row number as int, inside each group or over all rows. ``order`` ends in a unique column."""
    return running_total(df, groups, order, alias=alias).withColumn(alias, F.col(alias).cast("int"))


def top_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; tasks cut to ``k`` per group before the shuffle."""
    return (
        df.withColumn("_n", F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
        .filter(F.col("_n") <= k)
        .drop("_n")
    )


def first_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in an order: a top-k per task, then one merge of ``k`` rows each."""
    return df.orderBy(*order).limit(k)
