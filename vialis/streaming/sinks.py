"""Running streams: append tables, the insert-once sink, bounded runs."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from vialis.functions.calendar import event_time
from vialis.functions.messages import AIR_SCHEMA, air_message, decode
from vialis.operators.quality import one_per_key
from vialis.session import TASK_ROWS

DAY = "_day"
TRIGGER = "30 seconds"


def air_rows(messages: DataFrame) -> DataFrame:
    """Typed readings with event time, ingest time and position in the topic.

    A message without a readable time gets the time it arrived.
    """
    rows = air_message(decode(messages.select("value", "partition", "offset"), AIR_SCHEMA, key="estacion_id"))
    return rows.select(
        "estacion_id", "estacion_nombre", "zona", "latitud", "longitud",
        event_time(F.col("timestamp"), F.current_timestamp()).alias("event_ts"), "pm25", "pm10",
        F.current_timestamp().alias("ingest_ts"),
        F.col("offset").alias("kafka_offset"), F.col("partition").alias("kafka_partition"),
    )


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, as the steps of ``stateful`` need it; others are as they were."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def append_table(df: DataFrame, table: str, checkpoint: str, every: str | None = TRIGGER) -> StreamingQuery:
    """Append a stream to a table; ``every=None`` takes what is there and stops."""
    watch_late_rows(df.sparkSession)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return _paced(writer, every).toTable(table)


def _paced(writer, every: str | None):
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def _stored_at(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path``, and what makes its paths."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def insert_absent(batch: DataFrame, path: str, keys: Sequence[str], moment: str) -> None:
    """Add the rows whose key the sink does not hold; the first writer of a key wins.

    The sink is partitioned by the day of ``moment``, which is part of the key,
    so a batch opens the day folders of its own days only, however long the sink
    has been filled. Of rows with one key in a batch the least by value stays.
    Rows are dealt by day before they are written, so a batch adds a file to a day for
    each ``TASK_ROWS`` of its rows, and not one for each task.
    """
    spark = batch.sparkSession
    fresh = one_per_key(batch, keys, []).withColumn(DAY, F.to_date(moment))
    sizes = {r[0]: r[1] for r in batch.groupBy(F.to_date(moment)).count().collect()}
    days = [f"{path}/{DAY}={d}" for d in sizes if d is not None]
    system, place = _stored_at(spark, path)
    held_days = [d for d in days if system.exists(place(d))]
    if held_days:
        held = spark.read.schema(fresh.schema).option("basePath", path).parquet(*held_days)
        fresh = fresh.join(held.select(*keys, DAY), [*keys, DAY], "left_anti").select(*fresh.columns)
    # A stream's session has no adaptive execution, which a rebalance would need.
    parts = -(-max(sizes.values(), default=1) // TASK_ROWS)
    dealt = fresh.repartition(DAY, F.pmod(F.xxhash64(*keys), F.lit(parts)))
    dealt.write.mode("append").partitionBy(DAY).parquet(path)


def write_once(
    df: DataFrame, path: str, keys: Sequence[str], moment: str, checkpoint: str, every: str | None = TRIGGER
) -> StreamingQuery:
    """Stream into the insert-once sink; a replayed batch or a fresh checkpoint adds no row twice.

    The sink's folder is there from the start, so it can be read before its first row.
    """
    system, place = _stored_at(df.sparkSession, path)
    system.mkdirs(place(path))

    def insert(batch: DataFrame, _: int) -> None:
        batch.persist()
        insert_absent(batch, path, keys, moment)
        batch.unpersist()

    watch_late_rows(df.sparkSession)
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(insert)
    return _paced(writer, every).start()


def read_once_sink(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The sink's rows. A sink without rows has no file that tells its columns: it needs the ``schema`` of what was written."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop(DAY)


def write_files(df: DataFrame, path: str, checkpoint: str, every: str | None = TRIGGER) -> StreamingQuery:
    watch_late_rows(df.sparkSession)
    writer = df.writeStream.format("parquet").outputMode("append").options(path=path, checkpointLocation=checkpoint)
    return _paced(writer, every).start()


BATCH = "_lote"


def write_with_late(
    df: DataFrame, path: str, late_path: str, flag: str, checkpoint: str, every: str | None = TRIGGER
) -> StreamingQuery:
    """Rows to one table, those with ``flag`` to another, both in one folder per micro-batch.

    A batch that is run again after a failure writes its folders anew. Both tables belong to one checkpoint.
    """
    def split(batch: DataFrame, number: int) -> None:
        batch.persist()
        for place, rows in ((path, batch.filter(~F.col(flag))), (late_path, batch.filter(flag))):
            rows.drop(flag).write.mode("overwrite").parquet(f"{place}/{BATCH}={number}")
        batch.unpersist()

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(split)
    with keyed_state(df.sparkSession):
        return _paced(writer, every).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def run_for(query: StreamingQuery, seconds: float | None = None) -> StreamingQuery:
    """Wait for the end of a stream, or stop it after ``seconds``."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
    return query


def wait_until(query: StreamingQuery, done: Callable[[], bool], seconds: float = 120.0, pause: float = 0.5) -> None:
    """Wait for a running stream until ``done``; its failure, or too long a wait, is an error."""
    end = time.monotonic() + seconds
    while not done():
        if query.awaitTermination(pause) or time.monotonic() > end:
            raise TimeoutError(f"stream {query.id} ended or took more than {seconds} s")


class LateRows(StreamingQueryListener):
    """Rows dropped behind the watermark per run, summed over all of its progresses."""

    def __init__(self):
        self.rows, self.batch, self.ended = defaultdict(int), {}, set()
        self.told = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self.told:
            self.rows[str(progress.runId)] += sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
            self.batch[str(progress.runId)] = progress.batchId
            self.told.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.told:
            self.ended.add(str(event.runId))
            self.told.notify_all()


_LATE: dict[str, LateRows] = {}


def watch_late_rows(spark: SparkSession) -> LateRows:
    """The session's counter of late rows; the first call has to come before the streams it is to count."""
    name = spark.sparkContext.applicationId
    if name not in _LATE:
        _LATE[name] = LateRows()
        spark.streams.addListener(_LATE[name])
    return _LATE[name]


def late_rows(query: StreamingQuery, wait: float = 30.0) -> int:
    """Rows dropped behind the watermark since the run began, up to its newest progress."""
    counter = watch_late_rows(SparkSession.active())
    run, newest = str(query.runId), query.lastProgress
    if newest is None:
        return 0
    with counter.told:
        counter.told.wait_for(lambda: counter.batch.get(run, -1) >= newest["batchId"] or run in counter.ended, wait)
        return counter.rows[run]
