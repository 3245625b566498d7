"""Layered tables: audit columns, appends with a ledger of files, replaced tables, references."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis import vocabulary as v


AUDIT = (v.FILE_PATH, v.FILE_NAME, v.INGESTED_AT, v.SOURCE_ID, v.INGEST_DATE, v.LOAD)


def create_layers(spark: SparkSession, root: str | None = None, names: Sequence[str] = v.LAYERS) -> None:
    for name in names:
        place = f" LOCATION '{root}/{name}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def with_path(df: DataFrame) -> DataFrame:
    """The full path of the file each row was read from, before rows of several files are combined."""
    return df.withColumn(v.FILE_PATH, F.col("_metadata.file_path"))


def audited(df: DataFrame, source: str, path: str | None = None) -> DataFrame:
    """The audit columns. A row made of several files names them all, joined by semicolons."""
    if path is not None:
        df = df.withColumn(v.FILE_PATH, F.lit(path))
    elif v.FILE_PATH not in df.columns:
        df = with_path(df)
    names = F.transform(F.split(v.FILE_PATH, ";"), lambda p: F.substring_index(p, "/", -1))
    return df.withColumns({
        v.FILE_NAME: F.array_join(names, ";"),
        v.INGESTED_AT: F.date_trunc("second", F.current_timestamp()),
        v.SOURCE_ID: F.lit(source),
        v.INGEST_DATE: F.current_date(),
    })


LEDGER_SCHEMA = ("carga string, ruta string, bytes bigint, modificado timestamp, reemplaza array<string>, "
                 "anotado_en timestamp")


def ledger_of(table: str) -> str:
    """Name of the table that lists the files a bronze table was loaded from."""
    return f"{table}__cargas"


def _ledger(spark: SparkSession, table: str) -> DataFrame:
    """One row per file of each load in force: committed, and not replaced by a later one."""
    if not spark.catalog.tableExists(ledger_of(table)):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.table(ledger_of(table))
    replaced = rows.select(F.explode("reemplaza").alias("carga")).distinct()
    return rows.join(replaced, "carga", "left_anti")


def _commit(table: str, entries: DataFrame, load: str, replaces: Sequence[str]) -> None:
    """Put a load in force, and the loads it replaces out of force: one file, written at once or not at all."""
    rows = entries.select(
        F.lit(load).alias("carga"), "ruta", "bytes", "modificado",
        F.array(*[F.lit(r) for r in replaces]).cast("array<string>").alias("reemplaza"), F.current_timestamp().alias("anotado_en"))
    rows.coalesce(1).write.mode("append").saveAsTable(ledger_of(table))


def held(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a bronze table whose load is in force; those of a load that was cut off are not among them."""
    rows = spark.table(table)
    if v.LOAD not in rows.columns or not spark.catalog.tableExists(ledger_of(table)):
        return rows
    return rows.join(_ledger(spark, table).select(v.LOAD).distinct(), v.LOAD, "left_semi").select(*rows.columns)


def _drop_loads(spark: SparkSession, table: str) -> None:
    """Drop the partitions of loads that are not in force: cut off before their commit, or replaced."""
    if not spark.catalog.tableExists(table):
        return
    partitions = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    if not partitions:
        return
    good = {r[v.LOAD] for r in _ledger(spark, table).select(v.LOAD).distinct().collect()}
    for partition in partitions:
        values = dict(part.split("=", 1) for part in partition.split("/"))
        if values[v.LOAD] not in good:
            named = ", ".join(f"{k} = '{x}'" for k, x in values.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({named})")


def file_list(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Path, size and time of change of files; their contents are not read."""
    rows = spark.read.format("binaryFile").load(list(paths))
    return rows.select(F.col("path").alias("ruta"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modificado"))


def _there(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return [p for p in paths if _readable(spark, p)]


def _carried(rows: DataFrame, again: DataFrame) -> DataFrame:
    """The rows of replaced loads that no file of ``again`` makes anew: those with a file that is not read again."""
    paths = rows.select(v.FILE_PATH).distinct().withColumn("ruta", F.explode(F.split(v.FILE_PATH, ";")))
    kept = paths.join(again.select("ruta"), "ruta", "left_anti").select(v.FILE_PATH).distinct()
    return rows.join(kept, v.FILE_PATH, "left_semi").select(*rows.columns)


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 4) -> Iterator[None]:
    """Partitioned writes inside keep some files open instead of sorting a task's rows by partition first; a task with more partitions sorts."""
    before = spark.conf.get(OPEN_FILES, None)
    spark.conf.set(OPEN_FILES, str(files))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(OPEN_FILES)
        else:
            spark.conf.set(OPEN_FILES, before)


def _write(rows: DataFrame, table: str, load: str, partition: str, carried: DataFrame | None = None) -> int:
    """Append the rows of a load, in partitions of its own below the ingest day; the number of rows without the carried ones.

    Counts of stored rows come from file footers and, for the carried ones, one column of their old load. A load has few
    partitions, so its rows are not sorted: rows that repeat their paths shrink to a few bytes on the way to a task and
    would take it forty times as much memory there.
    """
    spark = rows.sparkSession
    out = rows if carried is None else rows.unionByName(carried.drop(v.LOAD), allowMissingColumns=True)
    out = out.withColumn(v.LOAD, F.lit(load))
    if spark.catalog.tableExists(table):
        out = out.select(*spark.table(table).columns)
    with unsorted_writes(spark):
        out.hint("rebalance", partition).write.mode("append").partitionBy(partition, v.LOAD).saveAsTable(table)
    stored = spark.table(table).filter(F.col(v.LOAD) == load).count()
    return stored - (0 if carried is None else carried.count())


def append_files(
    spark: SparkSession, paths: Sequence[str], table: str, source: str, read: Callable[[list[str]], DataFrame],
    partition: str = v.INGEST_DATE,
) -> int:
    """Append the files that a bronze table does not hold yet; returns the rows that ``read`` made.

    A ledger keeps full path, size and time of change of every file, so equal
    base names in other folders are other files. Each load has partitions of its
    own below the ingest day, and counts from its entry in the ledger on, which is one file. So a load that is
    cut off before that entry leaves partitions that the next load drops, and
    nothing else is touched.

    A file that changed is loaded in a new load that replaces the one it
    was in. The other rows of that load are carried over as they are, whether their files are still there or not. Where rows
    were made of several files, the files that are still there are read again,
    and rows with a file that is gone are carried over beside the new ones. One
    loader at a time writes a table.
    """
    _drop_loads(spark, table)
    known = _ledger(spark, table)
    entries = known.select("ruta", F.col("bytes").alias("_b"), F.col("modificado").alias("_m"), v.LOAD)
    state = file_list(spark, paths).join(entries, "ruta", "left")
    same = (F.col("bytes") == F.col("_b")) & (F.col("modificado") == F.col("_m"))
    todo = state.filter(~F.coalesce(same, F.lit(False))).select("ruta", "bytes", "modificado", v.LOAD).collect()
    if not todo:
        return 0
    listed = [(r["ruta"], r["bytes"], r["modificado"]) for r in todo]
    replaced = sorted({r[v.LOAD] for r in todo if r[v.LOAD] is not None})
    schema = "ruta string, bytes bigint, modificado timestamp"
    files, carried = spark.createDataFrame(listed, schema), None
    if replaced:
        old = spark.table(table).filter(F.col(v.LOAD).isin(replaced))
        others = known.filter(F.col(v.LOAD).isin(replaced)).join(files.select("ruta"), "ruta", "left_anti")
        if not old.filter(F.col(v.FILE_PATH).contains(";")).isEmpty():
            again = _there(spark, [r["ruta"] for r in others.collect()])
            if again:
                listed += [tuple(r) for r in file_list(spark, again).collect()]
                files = spark.createDataFrame(listed, schema)
                others = others.join(files.select("ruta"), "ruta", "left_anti")
        carried = _carried(old, files)
        files = files.unionByName(others.select("ruta", "bytes", "modificado"))
    load = uuid.uuid4().hex
    written = _write(audited(read([f[0] for f in listed]), source), table, load, partition, carried)
    _commit(table, files, load, replaced)
    if replaced:
        _drop_loads(spark, table)
    return written


def append_raw(df: DataFrame, table: str, source: str, delivery: str, partition: str = v.INGEST_DATE) -> int:
    """Append a frame as a named delivery; returns the rows written, none if the ledger has the name."""
    spark = df.sparkSession
    if not _ledger(spark, table).filter(F.col("ruta") == delivery).isEmpty():
        return 0
    _drop_loads(spark, table)
    load = uuid.uuid4().hex
    written = _write(audited(df, source, delivery), table, load, partition)
    _commit(table, spark.createDataFrame([(delivery, None, None)], "ruta string, bytes bigint, modificado timestamp"), load, [])
    return written


def replace_table(df: DataFrame, table: str, partition: str | None = None) -> None:
    """Replace a derived table, partitioned where it is large.

    Rows are rebalanced on the partition column first: few files per partition
    value, and a value with a large share of the rows is split over tasks.
    """
    if partition is None:
        df.write.mode("overwrite").saveAsTable(table)
    else:
        df.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).saveAsTable(table)


def with_table_columns(df: DataFrame, table: str) -> DataFrame:
    """``df`` with a null for each column that only the table has; columns that only ``df`` has are added to the table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return df
    held = spark.table(table).schema
    new = {f.name: f.dataType.simpleString() for f in df.schema if f.name not in held.names}
    if new:
        add_columns(spark, table, new)
        spark.catalog.refreshTable(table)
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in held if f.name not in df.columns})


def add_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    """New columns without a rewrite; rows written before read null."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{c} {t}' for c, t in columns.items())})")


REFERENCE_SCHEMA = ("linea string, franja_horaria string, p50 bigint, p75 bigint, p90 bigint, p95 bigint, "
                    "muestras bigint")


def load_reference(spark: SparkSession, table: str, export: str) -> DataFrame:
    """Percentiles per line and band from the gold table, or from its JSON export when that has no rows."""
    if spark.catalog.tableExists(table) and not spark.table(table).isEmpty():
        return spark.table(table)
    return spark.read.schema(REFERENCE_SCHEMA).json(export)


def _readable(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def load_risk_corridors(spark: SparkSession, export: str | None) -> DataFrame:
    """Risk corridors from the export, or the known ones when it is missing or empty."""
    if export is not None and _readable(spark, export):
        listed = spark.read.schema("corredores array<string>").json(export)
        named = listed.select(F.explode("corredores").alias("corredor")).select(F.trim("corredor").alias("corredor"))
        named = named.filter(F.col("corredor") != "").distinct()
        if not named.isEmpty():
            return named
    return known_corridors(spark)


def known_corridors(spark: SparkSession) -> DataFrame:
    listed = F.array(*[F.lit(c) for c in v.KNOWN_CORRIDORS])
    return spark.range(1).select(F.explode(listed).alias("corredor"))


def with_known_corridors(corridors: DataFrame) -> DataFrame:
    """Inferred and known corridors, each once."""
    return corridors.select("corredor").union(known_corridors(corridors.sparkSession)).distinct()
