"""Headline queries and the storage-format comparison; prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from vialis import questions
from vialis.session import clear_scratch, open_session, scratch_folder
from vialis.sources import files

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "severity_by_area_year", "composite_risk", "risk_corridors", "daily_then_monthly_corr", "demand_by_climate_bin",
    "band_percentiles", "band_percentiles_exact", "rolling_5min", "latest_reading_asof", "sensor_wide", "dedupe_latest",
    "mixed_schema_union", "area_of_point", "area_of_point_by_shuffle", "pseudonyms", "legacy_normalise", "rings", "bronze_append",
    "stream_tumbling_alert", "stream_sliding_stock", "stream_hybrid_alert", "stream_sink_once", "pagerank",
    "shortest_routes", "classify_metrics",
)
FORMATS = (
    ("csv", files.write_csv, lambda spark, schema, path: spark.read.schema(schema).csv(path, header=True)),
    ("parquet_snappy", lambda df, p: files.write_parquet(df, p, "snappy"), lambda spark, schema, path: spark.read.parquet(path)),
    ("parquet_zstd", lambda df, p: files.write_parquet(df, p, "zstd"), lambda spark, schema, path: spark.read.parquet(path)),
)
RUNS = 3


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored_bytes(spark, path: str) -> int:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def format_times(spark) -> tuple[dict[str, float], dict[str, int]]:
    """Write, full scan and filtered scan of ``lineitem`` per format, median of three; and the bytes stored."""
    rows = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").persist()
    rows.count()
    result, sizes = {}, {}
    for name, write, read in FORMATS:
        path = scratch_folder(spark, f"bench-{name}")
        stored = lambda: read(spark, rows.schema, path)
        actions = {
            "write": lambda: write(rows, path),
            "full_scan": lambda: drain(stored()),
            "predicate_scan": lambda: drain(stored().filter(F.col("l_returnflag") == "R")),
        }
        for step, action in actions.items():
            result[f"format_{name}_{step}"] = statistics.median(timed(action) for _ in range(RUNS))
        sizes[name] = stored_bytes(spark, path)
    rows.unpersist()
    return result, sizes


def main() -> None:
    only = set(sys.argv[1:])
    spark = open_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = questions.queries()
    times, sizes = {}, {}
    with contextlib.redirect_stdout(sys.stderr):
        drain(registered["deaths_per_year"](spark, SF_DIR))
        for name in HEADLINES:
            if only and name not in only:
                continue
            times[name] = timed(lambda: drain(registered[name](spark, SF_DIR)))
            print(name, round(times[name], 2))
        if not only or "formats" in only:
            measured, sizes = format_times(spark)
            times.update(measured)
    total = sum(times.values())
    clear_scratch(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, wall clock", "value": round(total, 3), "unit": "sec",
        "queries": {name: round(t, 3) for name, t in times.items()}, "bytes": sizes, "sf": SF_DIR.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
