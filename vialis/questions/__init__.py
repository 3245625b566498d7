"""Registered queries: each operator on the given tables, beside the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from vialis.session import ship_package

TOPICS = ("incidents", "ridership", "readings", "places", "history", "stored", "live", "network", "model")


def _collect(kind: str) -> dict:
    found = {}
    for topic in TOPICS:
        found.update(getattr(import_module(f"vialis.questions.{topic}"), kind))
    return found


def _days_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every client shows alike."""
    days = [f.name for f in df.schema if f.dataType == DateType()]
    return df.withColumns({d: F.col(d).cast("string") for d in days}) if days else df


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def in_utc(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return _days_as_text(query(spark, sf_dir))
        return run
    return {name: in_utc(query) for name, query in _collect("QUERIES").items()}


def oracle_sql() -> dict[str, str]:
    return _collect("SQL")
