"""Helpers of the text-collection operators: fixed rows, row sums in an order, code points."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vialis.session import scratch_folder, ship_package

ROWS_PER_PART = 20_000
BUCKETS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as zstd Parquet in the shared folder, read back: fixed rows, pruned columns, no lineage."""
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(t._scratch)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _near(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], buckets: int, how: str) -> DataFrame:
    """The rows whose keys fall into a hash bucket that keys of ``wanted`` fall into, or the other rows.

    The list of the buckets in use, no longer than ``buckets`` numbers, is
    broadcast; so rows that cannot meet ``wanted`` are told apart before anything moves.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    used = wanted.select(bucket.alias("_bucket")).distinct()
    return rows.withColumn("_bucket", bucket).join(F.broadcast(used), "_bucket", how).drop("_bucket")


def wanted_rows(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``rows`` joined with ``wanted`` on ``keys``; only rows that may match move."""
    return _near(rows, wanted, keys, buckets, "left_semi").join(wanted, list(keys))


def other_rows(rows: DataFrame, dropped: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``rows`` whose ``keys`` are not in ``dropped``; only rows that may match move."""
    far = _near(rows, dropped, keys, buckets, "left_anti")
    near = _near(rows, dropped, keys, buckets, "left_semi")
    return far.unionByName(near.join(dropped.select(*keys), list(keys), "left_anti").select(*rows.columns))


def python_ready(spark: SparkSession) -> None:
    """The package on the Python workers."""
    ship_package(spark)


def with_columns_from_text(
    rows: DataFrame, text: str, new: str, work: Callable[[list[str | None]], dict[str, list]], keep_text: bool = False,
) -> DataFrame:
    """``rows`` with the columns that ``work`` makes of a batch of texts (a null text is None).

    ``new`` is a schema string. All other columns pass through the task as
    Arrow data, untouched. Arrow batches bound what a task holds.
    """
    python_ready(rows.sparkSession)
    kept = rows.columns if keep_text else [c for c in rows.columns if c != text]
    added = StructType.fromDDL(new)
    schema = StructType([*[rows.schema[c] for c in kept], *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(added)
        for batch in batches:
            made = work(batch.column(text).to_pylist())
            arrays = [batch.column(c) for c in kept] + [pa.array(made[f.name], type=f.type) for f in types]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *types.names])

    return rows.mapInArrow(run, schema)


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that follows from the columns and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(2**53))


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of all columns, nulls being equal to each other."""
    condition = F.lit(True)
    for c in columns:
        condition &= left[c].eqNullSafe(right[c])
    return condition


def starts_in_seeded_order(
    rows: DataFrame, group: str, size: str, key: str, alias: str = "start", seed: int = 0, per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Sum of ``size`` over the rows before each row, in a seeded order inside each group.

    The order is that of a hash of ``key``, then of the key and the other
    columns. Each group is cut into hash ranges of about ``per_part`` rows, so a
    group with a third of all rows is many parts; a part starts from the total
    of the parts before it. ``rows`` has to be fixed (a written table).
    """
    columns = rows.columns
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(group, "_g")
    parts = F.ceil(F.col("_n") / per_part)
    hashed = rows.withColumn("_u", unit_hash(F.col(key), F.col(size), seed=seed))
    placed = hashed.join(counts, F.col(group).eqNullSafe(F.col("_g"))).withColumn(
        "_part", F.floor(F.col("_u") * parts)
    ).drop("_g", "_n")
    totals = placed.groupBy(group, "_part").agg(F.sum(size).alias("_total"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"),
    )
    inside = W.partitionBy(group, "_part").orderBy("_u", key, *[c for c in columns if c not in (key, group)]).rowsBetween(W.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = summed.join(totals, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.select(*columns, (F.col("_before") + F.col("_inside")).alias(alias))
