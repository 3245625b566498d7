"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis.functions.measures import rounded

PLACES = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a zoned time, as streams need it."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def shown(value: Column | str, places: int = PLACES) -> Column:
    return rounded(F.col(value) if isinstance(value, str) else value, places)


def with_shown(df: DataFrame, *columns: str, places: int = PLACES) -> DataFrame:
    return df.withColumns({c: shown(c, places) for c in columns})


def local_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def sql_shown(expression: str, places: int = PLACES) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(28,9)), {places}) AS DOUBLE)"


def sql_band(hour: str) -> str:
    return (f"CASE WHEN {hour} BETWEEN 5 AND 8 THEN 'punta_am' WHEN {hour} BETWEEN 9 AND 11 THEN 'valle_am' "
            f"WHEN {hour} BETWEEN 12 AND 13 THEN 'almuerzo' WHEN {hour} BETWEEN 14 AND 16 THEN 'valle_pm' "
            f"WHEN {hour} BETWEEN 17 AND 20 THEN 'punta_pm' ELSE 'nocturno' END")


def sql_corr(x: str, y: str) -> str:
    """Correlation over complete pairs, null where one side does not vary."""
    keep = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    return (f"CASE WHEN stddev_pop({x}) {keep} * stddev_pop({y}) {keep} = 0 THEN NULL "
            f"ELSE covar_pop({x}, {y}) / (stddev_pop({x}) {keep} * stddev_pop({y}) {keep}) END")


def sql_day_text(query: str, day: str = "fecha") -> str:
    """The query with its date as ISO text."""
    return f"SELECT * REPLACE (CAST({day} AS VARCHAR) AS {day}) FROM ({query})"
