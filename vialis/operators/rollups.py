"""Grouped measures: totals, pivots, correlations, percentiles, ratings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.measures import correlation, percent_from, severity_index
from vialis.operators.ranking import first_rows, running_total, top_per_group
from vialis.session import settle


def _sum(terms: Sequence[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def long_to_wide(
    df: DataFrame, keys: Sequence[str], variable: str, values: Sequence[str], reading: str
) -> DataFrame:
    """One column per listed variable, repeated readings averaged. No job looks for the values."""
    wide = df.groupBy(*keys).pivot(variable, list(values))
    return wide.agg(F.avg(reading))


def severity_table(
    df: DataFrame,
    keys: Sequence[str],
    severity: str,
    classes: Sequence[tuple[str, str, float]] = v.SEVERITIES,
    others: str | None = None,
) -> DataFrame:
    """Counts per severity as columns, their total and the weighted index.

    The first aggregate counts per key and severity before the shuffle; the
    pivot over the listed classes works on those counts. ``others`` names a
    column that counts the rows of no listed class, which are in no other figure.
    """
    counted = df.groupBy(*keys, severity).agg(F.count(F.lit(1)).alias("_n"))
    names = [name for _, name, _ in classes]
    wide = counted.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col(severity) == text, F.col("_n"))), F.lit(0)).alias(name)
        for text, name, _ in classes
    ], *([] if others is None else [F.coalesce(F.sum(F.when(
        ~F.coalesce(F.col(severity).isin([text for text, _, _ in classes]), F.lit(False)), F.col("_n"))), F.lit(0)).alias(others)]))
    return wide.withColumns({
        "incidentes_total": _sum([F.col(n) for n in names]),
        "indice_severidad": severity_index({n: F.col(n) for n in names}),
    })


def rank_severity(table: DataFrame, year: str, area: str) -> DataFrame:
    """Rank of each area inside its year, worst first, ties by area.

    The table has a row per area and year, so a year is as small as a map has areas.
    """
    order = W.partitionBy(year).orderBy(F.desc("indice_severidad"), F.asc(area))
    return table.withColumn("ranking_severidad", F.row_number().over(order))


def network_daily(df: DataFrame, moment: str, averages: dict[str, str], totals: dict[str, str]) -> DataFrame:
    """Daily averages and totals over the whole network; names map alias to column."""
    return df.groupBy(F.to_date(moment).alias("fecha")).agg(
        *[F.avg(c).alias(a) for a, c in averages.items()],
        *[F.sum(c).alias(a) for a, c in totals.items()],
    )


def line_daily(df: DataFrame, keys: Sequence[str], passengers: str, pm25: str, rain: str) -> DataFrame:
    """Daily passengers per line with the climate of the day, which is one value per day."""
    return df.groupBy(*keys).agg(
        F.sum(passengers).alias("pasajeros_dia"),
        F.avg(pm25).alias("pm25_dia"),
        F.max(rain).alias("precip_dia"),
    )


def line_monthly(daily: DataFrame, day: str, line: str) -> DataFrame:
    """Monthly ridership, climate and their correlations inside the month."""
    return daily.groupBy(F.year(day).alias("anio"), F.month(day).alias("mes"), F.col(line)).agg(
        F.sum("pasajeros_dia").alias("pasajeros_mes"),
        F.avg("pasajeros_dia").alias("pasajeros_promedio_dia"),
        F.avg("pm25_dia").alias("pm25_promedio_mes"),
        F.sum("precip_dia").alias("precipitacion_total_mes_mm"),
        correlation(F.col("pm25_dia"), F.col("pasajeros_dia")).alias("corr_pm25_pasajeros"),
        correlation(F.col("precip_dia"), F.col("pasajeros_dia")).alias("corr_precip_pasajeros"),
        F.count(F.lit(1)).alias("dias_observados"),
    )


def demand_by_bins(trips: DataFrame, keys: Sequence[str], minutes: str) -> DataFrame:
    """Trips and mean duration per day and climate bins, and the deviation from the mean day.

    The overall mean is a one-row subquery over the grouped rows, which are
    settled first: it needs fewer columns than the result, so Spark would plan
    it as a second pass over the trips.
    """
    daily = settle(trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("viajes"),
        F.avg(minutes).alias("duracion_promedio_min"),
    ))
    mean = daily.agg(F.avg("viajes").alias("media")).scalar()
    return daily.withColumn("viajes_relativos_pct", percent_from(F.col("viajes"), mean))


def volume_per_area(counts: DataFrame, area: str, vehicles: str, corridor: str) -> DataFrame:
    """Vehicles and distinct corridors per area, from one row per (area, corridor)."""
    per_corridor = counts.groupBy(area, corridor).agg(F.sum(vehicles).alias("_v"))
    return per_corridor.groupBy(area).agg(
        F.sum("_v").alias("vehiculos_total"),
        F.count(corridor).alias("corredores_distintos"),
    )


def approximate_corridors(counts: DataFrame, area: str, corridor: str, error: float = 0.05) -> DataFrame:
    """Distinct corridors per area as an estimate, for when the exact count is not needed."""
    return counts.groupBy(area).agg(
        F.approx_count_distinct(corridor, error).alias("corredores_aprox")
    )


def incidents_per_area(
    df: DataFrame, area: str, severity: str, dead: str = "Con muertos", injured: str = "Con heridos"
) -> DataFrame:
    return df.groupBy(area).agg(
        F.count(F.lit(1)).alias("incidentes_total"),
        F.count_if(F.col(severity) == dead).alias("con_muertos"),
        F.count_if(F.col(severity) == injured).alias("con_heridos"),
    )


def composite_risk(volume: DataFrame, incidents: DataFrame, area: str) -> DataFrame:
    """Rank by volume plus rank by severity for areas known to both; the lowest score is worst.

    Both sides have one row per area already, so plain windows number them: an order is as small as a map has areas.
    """
    joined = volume.join(incidents, on=area, how="inner")
    weight = F.col("con_muertos") * 5 + F.col("con_heridos")
    place = lambda *order: F.row_number().over(W.orderBy(*order, F.asc(area)))
    ranks = joined.withColumns({"rank_volumen": place(F.desc("vehiculos_total")), "rank_severidad": place(weight.desc())})
    return ranks.withColumn("score_riesgo", F.col("rank_volumen") + F.col("rank_severidad"))


POINTS = {"p50": 50, "p75": 75, "p90": 90, "p95": 95}


def _value_ranks(df: DataFrame, keys: Sequence[str], value: str, least_rows: int) -> DataFrame:
    """A row per group and value: its copies, the rows up to it, and the group's rows as ``muestras``.

    Equal values are counted together before the shuffle and the ranks come
    from :func:`running_total`, so a group may hold any share of the rows.
    """
    valued = df.filter(F.col(value).isNotNull())
    distinct = settle(valued.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_copies")))
    upto = running_total(distinct, keys, [F.asc(value)], F.col("_copies"), "_upto", settled=True)
    size = distinct.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum("_copies").alias("muestras"))
    size = size.filter(F.col("muestras") >= least_rows)
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return upto.join(size, same).drop(*[f"_k_{k}" for k in keys])


def _at_rank(value: str, rank: Column) -> Column:
    """The one value whose copies cover the rank."""
    return F.max(F.when((F.col("_upto") - F.col("_copies") < rank) & (rank <= F.col("_upto")), F.col(value)))


def percentiles(df: DataFrame, keys: Sequence[str], value: str, least_rows: int = 10) -> DataFrame:
    """Exact p50, p75, p90, p95 by group: the least value that this share of the rows does not exceed.

    Groups with too few rows are left out; so are rows without a value. Ranks are whole numbers, so no rounding moves them.
    """
    return _value_ranks(df, keys, value, least_rows).groupBy(*keys, "muestras").agg(*[
        _at_rank(value, F.floor((F.col("muestras") * percent + 99) / 100)).alias(name) for name, percent in POINTS.items()
    ]).select(*keys, *POINTS, "muestras")


def exclusive_percentiles(df: DataFrame, keys: Sequence[str], value: str, least_rows: int = 10) -> DataFrame:
    """Exact median, p75, p90, p95 by the (n + 1) p rule, cut to whole numbers."""
    placed = _value_ranks(df, keys, value, least_rows)

    # (n + 1) p falls on or after rank `low`, by `over` hundredths; the last two
    # ranks carry everything beyond them.
    split, aggregates = {}, []
    for name, percent in POINTS.items():
        target = (F.col("muestras") + 1) * percent
        low = F.least(F.floor(target / 100), F.col("muestras") - 1)
        split[name] = target - low * 100
        aggregates += [_at_rank(value, low).alias(f"{name}_low"), _at_rank(value, low + 1).alias(f"{name}_high")]
    parts = placed.groupBy(*keys, "muestras").agg(*aggregates)
    return parts.select(*keys, *[
        ((F.col(f"{name}_low") * (100 - over) + F.col(f"{name}_high") * over) / 100).cast("bigint").alias(name)
        for name, over in split.items()
    ], "muestras")


def area_ranking(df: DataFrame, area: str, severity: str, dead: str = "Con muertos",
                 injured: str = "Con heridos") -> DataFrame:
    """Score per area: 5 per deadly, 1 per injury incident and 0.1 for any other."""
    is_dead, is_injured = (F.coalesce(F.col(severity) == s, F.lit(False)) for s in (dead, injured))
    counted = df.groupBy(area).agg(
        F.count_if(is_dead).alias("muertos"),
        F.count_if(is_injured).alias("heridos"),
        F.count_if(~is_dead & ~is_injured).alias("danos"),
    )
    score = F.round(F.col("muertos") * 5.0 + F.col("heridos") * 1.0 + F.col("danos") * 0.1, 1)
    return counted.withColumn("score", score)


def street_counts(df: DataFrame, area: str, severity: str, address: str) -> DataFrame:
    """Incidents per area, severity and upper-case address: what both ranking steps need, in one pass."""
    street = F.upper(F.trim(F.col(address)))
    return df.groupBy(area, severity, street.alias("via")).agg(F.count(F.lit(1)).alias("n"))


def corridors_at_risk(counts: DataFrame, area: str, severity: str, areas: int, streets: int, dead: str, injured: str) -> DataFrame:
    """The most frequent addresses (area, via, n) of the areas with the highest score, from settled street counts."""
    is_dead, is_injured = (F.coalesce(F.col(severity) == s, F.lit(False)) for s in (dead, injured))
    score = F.sum(F.when(is_dead, F.col("n") * 50).when(is_injured, F.col("n") * 10).otherwise(F.col("n")))
    best = first_rows(counts.groupBy(area).agg(score.alias("_score")), [F.desc("_score"), F.asc(area)], areas).select(area)
    per_street = counts.filter(F.col("via") != "").join(best, area, "left_semi").groupBy(area, "via").agg(F.sum("n").alias("n"))
    return top_per_group(per_street, [area], [F.desc("n"), F.asc("via")], streets)


def frequent_streets(df: DataFrame, area: str, address: str, k: int = 25) -> DataFrame:
    """The ``k`` most frequent addresses of each area, upper case, ties by name."""
    street = F.upper(F.trim(F.col(address)))
    counted = df.withColumn("via", street).filter(F.col("via") != "").groupBy(area, "via").agg(
        F.count(F.lit(1)).alias("n")
    )
    return top_per_group(counted, [area], [F.desc("n"), F.asc("via")], k)
