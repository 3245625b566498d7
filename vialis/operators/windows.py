"""Rolling sums and latest-value lookups over time, cut into time slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vialis.session import settle

MICROS = 1_000_000


def rolling_sum(
    df: DataFrame, entity: str, moment: str, value: str, seconds: int = 300, slice_seconds: int = 1800
) -> DataFrame:
    """Sum and count of the last ``seconds``, both ends included, at each instant of each entity.

    Readings of one instant are added up before the shuffle. An entity is then
    cut into time slices; a row also goes to the next slice when it can still
    count there, so each slice is complete and a busy entity spreads over many
    tasks. Those helper rows are dropped at the end.
    """
    if slice_seconds < seconds:
        raise ValueError("a slice has to be at least as long as the rolling range")
    micros = F.unix_micros(F.col(moment).cast("timestamp"))
    slot = lambda at: F.floor(at / (slice_seconds * MICROS))
    instants = df.groupBy(entity, moment).agg(
        F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n")
    ).withColumn("_t", micros)
    own, reach = slot(F.col("_t")), slot(F.col("_t") + seconds * MICROS)
    spread = instants.withColumn("_slot", F.explode(F.sequence(own, reach)))
    recent = W.partitionBy(entity, "_slot").orderBy("_t").rangeBetween(-seconds * MICROS, 0)
    return spread.select(
        entity, moment, "_t", "_slot",
        F.sum("_v").over(recent).alias("suma"),
        F.sum("_n").over(recent).alias("cuenta"),
    ).filter(F.col("_slot") == own).drop("_t", "_slot")


def latest_before(
    left: DataFrame,
    right: DataFrame,
    moment: str,
    value: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Left rows with the newest non-null right ``value`` at or before their ``moment``.

    ``left`` must not have a column named like ``value``. Both sides are stacked and cut into range partitions of equal size
    by group, time and side, so a slice follows the data: a busy hour, or
    instant, is many slices. Each slice is read in order; what the slices before it ended with comes from one row
    per slice.
    """
    known = right.filter(F.col(value).isNotNull()).select(*by, moment, value)
    # Several readings at one instant: the largest stands for it on any layout of the input.
    known = known.groupBy(*by, moment).agg(F.max(value).alias(value))
    own = F.xxhash64(*left.columns)
    stacked = left.withColumns({"_left": F.lit(1), "_own": own}).unionByName(
        known.withColumns({"_left": F.lit(0), "_own": F.lit(0).cast("bigint")}), allowMissingColumns=True)
    order = [*by, moment, "_left", "_own"]
    sliced = settle(stacked.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))

    # One entry per group and slice, no more than there are partitions: what a slice hands on.
    ends = sliced.groupBy(*by, "_slice").agg(F.max_by(value, F.when(F.col("_left") == 0, F.col(moment))).alias("_end"))
    listed = ends.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_slice", "_end"))).alias("_ends"))
    before = lambda x: F.filter("_ends", lambda e: (e["_slice"] < x["_slice"]) & e["_end"].isNotNull())
    carried = listed.select(*by, F.explode(F.transform("_ends", lambda x: F.struct(
        x["_slice"].alias("_slice"), F.try_element_at(before(x), F.lit(-1))["_end"].alias("_carry")))).alias("x"))
    carried = carried.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("x._slice").alias("_s"), "x._carry")

    inside = W.partitionBy(*by, "_slice").orderBy(moment, "_left").rowsBetween(W.unboundedPreceding, 0)
    read = sliced.withColumn("_in", F.last(value, ignorenulls=True).over(inside)).filter("_left = 1")
    same = F.col("_slice") == F.col("_s")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return read.drop(value).join(carried, same, "left").select(*left.columns, F.coalesce("_in", "_carry").alias(value))


def last_known(fields: Sequence[str], moment: Column | str) -> Column:
    """Aggregate: struct of the fields as the newest event of the group has them."""
    return F.max_by(F.struct(*fields), moment)
