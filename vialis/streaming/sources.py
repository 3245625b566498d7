"""Streams of JSON messages: Kafka where its connector is present, files otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic string, key string, value string, partition int, offset bigint, timestamp timestamp"


def open_stream(spark: SparkSession, kind: str, place: str, topics: Sequence[str] = (), **options) -> DataFrame:
    """Messages with ``topic, key, value, partition, offset``.

    ``kind`` is ``kafka`` (``place``: the bootstrap servers) or ``files``
    (``place``: a folder of JSON lines with the same fields). A new Kafka stream
    starts at the oldest message and fails where messages were lost; ``options``
    choose otherwise.
    """
    if kind == "kafka":
        stream = spark.readStream.format("kafka").options(**{
            "kafka.bootstrap.servers": place, "subscribe": ",".join(topics),
            "startingOffsets": "earliest", "failOnDataLoss": "true", **options,
        }).load()
        return stream.withColumns({c: F.col(c).cast("string") for c in ("key", "value")})
    if kind == "files":
        stream = spark.readStream.schema(MESSAGE_SCHEMA).options(**options).json(place)
        return of_topics(stream, topics) if topics else stream
    raise ValueError(f"unknown kind of stream {kind!r}")


def of_topics(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    return messages.filter(F.col("topic").isin(*topics))


def stream_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    """A Parquet file, or a folder of them, as a stream."""
    schema = spark.read.parquet(path).schema
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema).options(**options)
    if system.getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def as_messages(df: DataFrame, topic: str, key: str, moment: str) -> DataFrame:
    """Rows as keyed JSON messages."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*")).alias("value"),
        F.col(moment).cast("timestamp").alias("timestamp"),
    )


def publish(df: DataFrame, topic: str, key: str, moment: str, place: str, kind: str = "files") -> None:
    """Write a table as messages in time order, for a broker or for a replay from files.

    The order is by range partitions of the event time, so publishing scales
    with the cluster; file names keep that order for ``maxFilesPerTrigger``.
    """
    messages = as_messages(df, topic, key, moment)
    ordered = messages.orderBy("timestamp")
    if kind == "kafka":
        ordered.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", place).save()
    else:
        ordered.withColumns({
            "partition": F.spark_partition_id(),
            "offset": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }).write.mode("append").json(place)
