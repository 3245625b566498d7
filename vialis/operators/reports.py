"""Reports over gold tables and over stored alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.calendar import within_last
from vialis.functions.measures import correlation
from vialis.operators.ranking import first_rows


def correlations_per_line(monthly: DataFrame, line: str) -> DataFrame:
    """Mean of the monthly correlations and the months behind them."""
    return monthly.groupBy(line).agg(
        F.avg("corr_pm25_pasajeros").alias("corr_pm25_media"),
        F.avg("corr_precip_pasajeros").alias("corr_precip_media"),
        F.count(F.lit(1)).alias("meses_observados"),
    )


def area_history(severity: DataFrame, area: str) -> DataFrame:
    """Totals per area over all years."""
    return severity.groupBy(area).agg(
        F.sum("incidentes_total").alias("incidentes_totales"),
        F.sum("con_muertos").alias("total_muertos"),
        F.sum("con_heridos").alias("total_heridos"),
        F.avg("indice_severidad").alias("severidad_promedio"),
    )


def deadliest_areas(severity: DataFrame, area: str, k: int = 10) -> DataFrame:
    return first_rows(area_history(severity, area), [F.desc("total_muertos"), F.asc(area)], k)


def deaths_per_year(severity: DataFrame) -> DataFrame:
    return severity.groupBy("anio").agg(F.sum("con_muertos").alias("muertos_total"))


def deaths_and_air(monthly: DataFrame, severity: DataFrame) -> DataFrame:
    """Mean PM2.5 and deaths per year, for years known to both."""
    air = monthly.groupBy("anio").agg(F.avg("pm25_promedio_mes").alias("pm25_promedio_anual"))
    return air.join(deaths_per_year(severity), "anio")


def scalar_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation of two columns as one row."""
    return df.agg(correlation(F.col(x), F.col(y)).alias("correlacion"))


def rain_effect(daily: DataFrame) -> DataFrame:
    """Demand on days with and without rain."""
    return daily.groupBy("llovio").agg(
        F.avg("viajes").alias("viajes_promedio"),
        F.avg("viajes_relativos_pct").alias("pct_respecto_media"),
        F.count(F.lit(1)).alias("dias"),
    )


def rain_drop(daily: DataFrame) -> DataFrame:
    """How far demand falls on rainy days, in percent of the dry mean, as one row."""
    wet, dry = (F.avg(F.when(F.col("llovio") == flag, F.col("viajes"))) for flag in (1, 0))
    return daily.agg(((1 - F.try_divide(wet, dry)) * 100).alias("caida_pct"))


def demand_by_temperature(daily: DataFrame) -> DataFrame:
    known = daily.filter(F.col("bin_temperatura") != v.NO_DATA)
    return known.groupBy("bin_temperatura").agg(F.avg("viajes").alias("viajes_promedio"))


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *columns)


def latest_year_top(table: DataFrame, year: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of the latest year; the year is a one-row subquery."""
    latest = table.agg(F.max(year).alias("latest")).scalar()
    return first_rows(table.filter(F.col(year) == latest), order, k)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, counted in one job."""
    counts = [t.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(n).alias("tabla"), "filas")
              for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def search_alerts(
    alerts: DataFrame, now: Column, zone: str | None = None, severity: str | None = None,
    last: str | None = None, k: int = 30,
) -> DataFrame:
    """Alerts by zone, severity and age, newest window first."""
    found = alerts
    if zone is not None:
        found = found.filter(F.col("zona") == zone)
    if severity is not None:
        found = found.filter(F.col("gravedad") == severity)
    if last is not None:
        found = found.filter(within_last(F.col("emitido_en"), now, last))
    return first_rows(found, [F.desc("ventana_inicio"), F.asc("zona")], k)


def latest_documents(docs: DataFrame, key: str, k: int = 200) -> DataFrame:
    """The ``k`` newest documents by emission, ties by key."""
    return first_rows(docs, [F.desc("emitido_en"), F.asc(key)], k)


def recent_counts(docs: DataFrame, now: Column, last: str) -> DataFrame:
    """Documents per type emitted in the last minutes: the figures on top of a board."""
    recent = docs.filter(within_last(F.col("emitido_en"), now, last))
    return recent.groupBy("tipo").agg(F.count(F.lit(1)).alias("n"))


OTHER_LINES = "otras"


def series_by_line(snapshots: DataFrame, lines: list[str], line: str, value: str) -> DataFrame:
    """One column per listed line, one for all the others, and one row per window; zero where a line has none."""
    total = lambda keep, name: F.coalesce(F.sum(F.when(keep, F.col(value))), F.lit(0)).alias(name)
    listed = [total(F.col(line) == name, name) for name in lines]
    others = total(~F.coalesce(F.col(line).isin(list(lines)), F.lit(False)), OTHER_LINES)
    return snapshots.groupBy("ventana_inicio").agg(*listed, others)


def severity_by(severity: DataFrame, *keys: str) -> DataFrame:
    """Deaths, injuries and mean severity index per area, or per area and year."""
    return severity.groupBy(*keys).agg(
        F.sum("con_muertos").alias("muertos"),
        F.sum("con_heridos").alias("heridos"),
        F.avg("indice_severidad").alias("severidad_media"),
    )


def most_severe(severity: DataFrame, year: str, area: str, k: int = 10) -> DataFrame:
    """The area-years with the highest severity index."""
    order = [F.desc("indice_severidad"), F.asc(year), F.asc(area)]
    return first_rows(severity, order, k).select(year, area, "incidentes_total", "indice_severidad")


def most_central(ranking: DataFrame, k: int = 10) -> DataFrame:
    return first_rows(ranking, [F.asc("ranking")], k)


def rows_per_year(df: DataFrame, year: str = "anio") -> DataFrame:
    return df.groupBy(year).agg(F.count(F.lit(1)).alias("n"))
