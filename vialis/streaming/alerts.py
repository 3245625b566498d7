"""Window snapshots and alerts. The same functions serve batch and streaming frames.

Time columns are timestamps with the session's zone. On a stream the caller
gets append-mode results once the watermark passes the window; on a batch
frame the watermark has no effect and every window is returned.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.calendar import day_band
from vialis.functions.measures import air_class, air_class_short_window, rounded
from vialis.operators.windows import last_known
from vialis.session import settle


def windowed(
    df: DataFrame, keys: list[str], moment: str, size: str, slide: str | None, delay: str, aggregates: list[Column]
) -> DataFrame:
    """Aggregates per key and window; rows later than ``delay`` behind the newest event are dropped."""
    slot = F.window(moment, size, slide) if slide else F.window(moment, size)
    grouped = df.withWatermark(moment, delay).groupBy(slot.alias("window"), *keys)
    return grouped.agg(*aggregates)


def _bounds(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("ventana_inicio"), F.col("window.end").alias("ventana_fin"), *columns
    )


def arrived_now(df: DataFrame, alias: str = "llegada") -> DataFrame:
    """Arrival time as the event time, for windows over processing time."""
    return df.withColumn(alias, F.current_timestamp())


def air_alerts(
    readings: DataFrame, zone: str, moment: str, value: str, size: str = "10 minutes", delay: str = "10 minutes",
    limit: float = v.PM25_LIMIT, inclusive: bool = False, keep_non_positive: bool = False,
    classify: Callable[[Column], Column] = air_class,
) -> DataFrame:
    """Zones whose window average passes the limit, with a class. The limit itself counts if ``inclusive``."""
    usable = F.col(value).isNotNull() & (F.trim(F.col(zone).cast("string")) != "")
    if not keep_non_positive:
        usable &= F.col(value) > 0
    average = F.col("_avg")
    passed = average >= limit if inclusive else average > limit
    windows = windowed(readings.filter(usable), [zone], moment, size, None, delay, [
        F.avg(value).alias("_avg"), F.count(F.lit(1)).alias("lecturas_en_ventana"),
    ])
    return _bounds(
        windows.filter(passed), zone, rounded(average, 2).alias("pm25_promedio"), "lecturas_en_ventana",
        F.lit(v.AIR_ALERT).alias("tipo"), classify(average).alias("gravedad"), F.lit(float(limit)).alias("umbral"),
    )


def air_alerts_short_window(readings: DataFrame, zone: str, moment: str, value: str, **options) -> DataFrame:
    """One-minute variant: the limit counts, readings of zero or less too, two classes."""
    options = {"size": "1 minute", "delay": "1 minute", "inclusive": True, "keep_non_positive": True,
               "classify": air_class_short_window, **options}
    return air_alerts(readings, zone, moment, value, **options)


def bike_snapshots(
    stock: DataFrame, station: str, moment: str, bikes: str, about: list[str], size: str = "1 minute",
    slide: str = "30 seconds", delay: str = "1 minute", limit: int = v.BIKES_LIMIT,
) -> DataFrame:
    """Lowest, mean and last stock per sliding window, with the station as last seen in it."""
    windows = windowed(stock.filter(F.trim(F.col(station).cast("string")) != ""), [station], moment, size, slide, delay, [
        F.min(bikes).alias("bicicletas_min"), F.avg(bikes).alias("_avg"), F.count(F.lit(1)).alias("lecturas"),
        last_known([moment, bikes, *about], F.struct(moment, bikes, *about)).alias("_last"),
    ])
    low = F.col("bicicletas_min") <= limit
    return _bounds(
        windows, station, *[F.col(f"_last.{c}").alias(c) for c in about], "bicicletas_min",
        rounded(F.col("_avg"), 2).alias("bicicletas_avg"), F.col(f"_last.{bikes}").alias("bicicletas_ultimo"), "lecturas",
        F.when(low, F.lit(v.BIKE_ALERT)).otherwise(F.lit(v.BIKE_SNAPSHOT)).alias("tipo"),
        F.lit(limit).alias("umbral"),
    )


def _fixed(side: DataFrame, stream: DataFrame) -> DataFrame:
    """The static side of a join, computed once where the other side is a stream, not again in every micro-batch."""
    return settle(side) if stream.isStreaming else side


def corridor_snapshots(
    counts: DataFrame, corridor: str, moment: str, vehicles: str, risky: DataFrame, about: list[str] = (),
    minutes: int = 5, delay: str = "5 minutes", limit: float = v.VEHICLES_PER_MINUTE_LIMIT,
) -> DataFrame:
    """Traffic per corridor and window; an alert where a risk corridor reaches the limit per minute.

    ``about`` is taken from the newest event that has all of it, so a reading
    without a place does not hide one. ``risky`` has one column named like ``corridor``, each corridor once.
    """
    named = counts.filter(F.trim(F.col(corridor).cast("string")) != "")
    aggregates = [F.sum(vehicles).alias("intensidad_total"), F.avg(vehicles).alias("_avg"),
                  F.count(F.lit(1)).alias("lecturas")]
    if about:
        complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in about])
        aggregates.append(last_known(list(about), F.when(complete, F.struct(moment, *about))).alias("_last"))
    windows = windowed(named, [corridor], moment, f"{minutes} minutes", None, delay, aggregates)
    marked = windows.join(_fixed(risky.select(corridor, F.lit(True).alias("_risky")), counts), corridor, "left")
    is_risky = F.coalesce(F.col("_risky"), F.lit(False))
    per_minute = F.col("intensidad_total") / minutes
    return _bounds(
        marked, corridor, *[F.col(f"_last.{c}").alias(c) for c in about], "intensidad_total",
        rounded(F.col("_avg"), 2).alias("intensidad_promedio"), rounded(per_minute, 2).alias("intensidad_por_minuto"),
        "lecturas",
        F.when(is_risky & (per_minute >= limit), F.lit(v.CORRIDOR_ALERT)).otherwise(F.lit(v.CORRIDOR_SNAPSHOT)).alias("tipo"),
        is_risky.alias("alta_siniestralidad"), F.lit(limit).alias("umbral_por_minuto"),
    )


def line_snapshots(
    counts: DataFrame, line: str, moment: str, passengers: str, size: str = "5 minutes", delay: str = "5 minutes"
) -> DataFrame:
    windows = windowed(counts.filter(F.trim(F.col(line).cast("string")) != ""), [line], moment, size, None, delay, [
        F.sum(passengers).alias("pasajeros_acumulados"), F.count(F.lit(1)).alias("eventos_en_ventana"),
    ])
    return _bounds(windows, line, "pasajeros_acumulados", "eventos_en_ventana", F.lit(v.LINE_SNAPSHOT).alias("tipo"))


def hybrid_alerts(
    ridership: DataFrame, line: str, ridership_moment: str, passengers: str,
    weather: DataFrame, weather_moment: str, rain: str, pm25: str,
    reference: DataFrame, percentile: str = "p90", minutes: int = 5, slide: str | None = None,
    delay: str = "5 minutes", rain_limit: float = v.RAIN_LIMIT_MM, factor: float = v.RIDERSHIP_FACTOR,
    last_rain: bool = False,
) -> DataFrame:
    """Lines with few passengers while it rains: both streams against the percentiles of the gold layer.

    Ridership and rain are grouped into the same windows and joined on them,
    then met with the hourly reference of the line and band, scaled to the
    window. ``slide`` gives the rolling form: a window of the last ``minutes``
    closes every ``slide``. ``last_rain`` takes the newest reading in place of
    the sum. Band and windows follow the event time.
    """
    size = f"{minutes} minutes"
    windows = windowed(
        ridership.filter(F.trim(F.col(line).cast("string")) != ""), [line], ridership_moment, size, slide, delay,
        [F.sum(passengers).alias("_actual")],
    )
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(weather_moment, c)))
    wet = windowed(weather, [], weather_moment, size, slide, delay, [
        (newest(rain) if last_rain else F.sum(rain)).alias("_rain"), newest(pm25).alias("_pm25"),
    ]).filter(F.col("_rain") >= rain_limit)
    stats = reference.select(
        F.col("linea").alias("_line"), F.col("franja_horaria").alias("_band"),
        (F.col(percentile) * (minutes / 60)).alias("_expected"),
    ).filter(F.col("_expected") > 0)
    stats = _fixed(stats, ridership)
    both = windows.join(wet, "window").withColumn("franja_horaria", day_band(F.hour("window.start")))
    met = both.join(stats, (F.col(line) == F.col("_line")) & (F.col("franja_horaria") == F.col("_band")))
    ratio = F.col("_actual") / F.col("_expected")
    return _bounds(
        met.filter(ratio < factor), F.col(line).alias("linea"), "franja_horaria",
        F.col("_actual").alias("afluencia_5min_actual"),
        F.col("_expected").cast("bigint").alias("afluencia_5min_referencia"),
        rounded(ratio, 3).alias("ratio_vs_referencia"), F.lit(percentile).alias("percentil_referencia"),
        F.col("_rain").alias("lluvia_mm"), F.col("_pm25").alias("pm25_red"),
        F.lit(v.HYBRID_ALERT).alias("tipo"), F.lit(v.HYBRID_HYPOTHESIS).alias("hipotesis"),
        F.lit(factor).alias("factor_umbral"),
    )


def emitted(df: DataFrame) -> DataFrame:
    """The emission time, as the last column of a document."""
    return df.withColumn("emitido_en", F.current_timestamp())
