"""Events as ridership and trips: the event type is the line, the value a count or a duration."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.calendar import day_band, is_weekend
from vialis.functions.measures import bin_label, is_plausible_trip, rain_flag, trip_class
from vialis.operators import quality, reports, reshape, rollups
from vialis.operators.windows import rolling_sum
from vialis.questions.base import events, local_times, sql_band, sql_corr, sql_day_text, sql_shown, table, with_shown

# Text formats the days of a wide sheet come in, by line.
SHEET_FORMATS = {"view": "dd.MM.yyyy", "click": "yyyy-MM-dd"}
SHEET_DEFAULT = "dd/MM/yyyy"


def hourly(spark, sf_dir):
    """Passengers per day, hour and line."""
    return events(spark, sf_dir).groupBy(
        F.to_date("ts").alias("fecha"), F.hour("ts").alias("hora"), F.col("event_type").alias("linea")
    ).agg(F.sum(F.col("value").cast("bigint")).alias("pasajeros"))


def climate(spark, sf_dir):
    """Daily means over the network: views as PM2.5, clicks as temperature, sign-ups as rain."""
    one = lambda kind: F.when(F.col("event_type") == kind, F.col("value"))
    wide = events(spark, sf_dir).withColumns({"pm25": one("view"), "temp": one("click"), "signups": one("signup")})
    daily = rollups.network_daily(
        wide, "ts", {"pm25_promedio_red": "pm25", "temperatura_promedio_c": "temp", "_signups": "signups"}, {"_all": "value"}
    )
    return daily.withColumn("precipitacion_total_mm", F.col("_signups") - 48.5).drop("_signups", "_all")


def ridership(spark, sf_dir):
    """Hourly ridership with the climate of its day and the parts of the calendar."""
    joined = hourly(spark, sf_dir).join(climate(spark, sf_dir), on="fecha", how="left")
    return joined.withColumns({
        "anio": F.year("fecha"), "dia_semana": F.dayofweek("fecha"), "es_finde": is_weekend(F.col("fecha")),
        "franja_horaria": day_band(F.col("hora")),
    })


def monthly(spark, sf_dir):
    daily = rollups.line_daily(
        ridership(spark, sf_dir), ["fecha", "linea"], "pasajeros", "pm25_promedio_red", "precipitacion_total_mm"
    )
    return rollups.line_monthly(daily, "fecha", "linea")


MONTHLY_SHOWN = ("pasajeros_promedio_dia", "pm25_promedio_mes", "precipitacion_total_mes_mm",
                 "corr_pm25_pasajeros", "corr_precip_pasajeros")


def daily_then_monthly_corr(spark, sf_dir):
    return with_shown(monthly(spark, sf_dir), *MONTHLY_SHOWN)


def corr_mean_per_line(spark, sf_dir):
    return with_shown(reports.correlations_per_line(monthly(spark, sf_dir), "linea"), "corr_pm25_media", "corr_precip_media")


def ridership_enriched(spark, sf_dir):
    return with_shown(ridership(spark, sf_dir), "pm25_promedio_red", "temperatura_promedio_c", "precipitacion_total_mm")


def observations(spark, sf_dir):
    """Single counts per line and band; counts of zero are no observation."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("linea"), day_band(F.hour("ts")).alias("franja_horaria"),
        F.col("value").cast("bigint").alias("pasajeros"),
    )
    return rows.filter(F.col("pasajeros") > 0)


def band_percentiles(spark, sf_dir):
    return rollups.percentiles(observations(spark, sf_dir), ["linea", "franja_horaria"], "pasajeros")


def band_percentiles_exact(spark, sf_dir):
    return rollups.exclusive_percentiles(observations(spark, sf_dir), ["linea", "franja_horaria"], "pasajeros")


def trips(spark, sf_dir):
    rows = events(spark, sf_dir).filter(F.col("ts").isNotNull() & is_plausible_trip(F.col("value")))
    return rows.select(
        "event_id", F.to_date("ts").alias("fecha"), F.col("value").alias("duracion_min"),
        trip_class(F.col("value")).alias("categoria_duracion"),
    )


def trips_by_class(spark, sf_dir):
    counted = trips(spark, sf_dir).groupBy("categoria_duracion").agg(
        F.count(F.lit(1)).alias("n"), F.avg("duracion_min").alias("media")
    )
    return with_shown(counted, "media")


def demand(spark, sf_dir):
    """Trips per day and climate bins; the climate has one row per day."""
    weather = climate(spark, sf_dir).select(
        "fecha", bin_label(F.col("temperatura_promedio_c"), v.TEMPERATURE_BIN).alias("bin_temperatura"),
        bin_label(F.col("pm25_promedio_red"), v.PM25_BIN).alias("bin_pm25"),
        rain_flag(F.col("precipitacion_total_mm")).alias("llovio"),
    )
    joined = trips(spark, sf_dir).join(weather, on="fecha", how="left")
    return rollups.demand_by_bins(joined, ["fecha", "bin_temperatura", "bin_pm25", "llovio"], "duracion_min")


def demand_by_climate_bin(spark, sf_dir):
    result = demand(spark, sf_dir).withColumn("anio", F.year("fecha"))
    return with_shown(result, "duracion_promedio_min", "viajes_relativos_pct")


def rain_effect(spark, sf_dir):
    return with_shown(reports.rain_effect(demand(spark, sf_dir)), "viajes_promedio", "pct_respecto_media")


def rain_drop(spark, sf_dir):
    return with_shown(reports.rain_drop(demand(spark, sf_dir)), "caida_pct")


def demand_by_temperature(spark, sf_dir):
    return with_shown(reports.demand_by_temperature(demand(spark, sf_dir)), "viajes_promedio")


def weekday_band_profile(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.dayofweek("ts").alias("dia_semana"), is_weekend(F.col("ts")).alias("es_finde"),
        day_band(F.hour("ts")).alias("franja_horaria"), F.month("ts").alias("mes"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("dia"), "value",
    )
    grouped = rows.groupBy("dia_semana", "es_finde", "franja_horaria", "mes").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("dia").alias("dias"), F.avg("value").alias("media")
    )
    return with_shown(grouped, "media")


def errors_per_hour(spark, sf_dir):
    rows = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return reports.frequencies(rows.select(F.hour("ts").alias("hora")), "hora")


def rolling_5min(spark, sf_dir):
    rolled = rolling_sum(events(spark, sf_dir), "event_type", "ts", "value")
    return local_times(with_shown(rolled, "suma"), "ts")


def ridership_clean(spark, sf_dir):
    """Counts as padded and partly unreadable text, cleaned back to numbers."""
    text = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("fecha"),
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("linea"),
        F.when(F.col("event_type") == "view", F.lit("24")).otherwise(F.hour("ts").cast("string")).alias("hora"),
        F.when(F.col("event_type") == "click", F.lit("n/d")).otherwise(
            F.floor("value").cast("string")).alias("pasajeros"),
    )
    return quality.clean_ridership(text, "fecha", "linea", "hora", "pasajeros")


def wide_sheet(spark, sf_dir):
    """One row per day and line, one text column per hour, and a total."""
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d"), "event_type", F.hour("ts").alias("h"))
    wide = rows.groupBy("d", "event_type").agg(
        *[F.nullif(F.count_if(F.col("h") == h), F.lit(0)).cast("string").alias(f"h{h}") for h in range(24)],
        F.count(F.lit(1)).cast("string").alias("Total general"),
    )
    day = F
    for line, fmt in SHEET_FORMATS.items():
        day = day.when(F.col("event_type") == line, F.date_format("d", fmt))
    return wide.withColumn("dia", day.otherwise(F.date_format("d", SHEET_DEFAULT)))


def wide_to_long(spark, sf_dir):
    return reshape.hours_to_rows(wide_sheet(spark, sf_dir), "dia", "event_type", {f"h{h}": h for h in range(24)})


def micro_events(spark, sf_dir):
    return local_times(reshape.spread_evenly(hourly(spark, sf_dir), "fecha", "hora", "linea", "pasajeros"), "timestamp")


QUERIES = {q.__name__: q for q in (
    daily_then_monthly_corr, corr_mean_per_line, ridership_enriched, band_percentiles, band_percentiles_exact,
    trips_by_class, demand_by_climate_bin, rain_effect, rain_drop, demand_by_temperature, weekday_band_profile,
    errors_per_hour, rolling_5min, ridership_clean, wide_to_long, micro_events,
)}

_HOURLY = """hourly AS (
    SELECT CAST(ts AS DATE) AS fecha, CAST(hour(ts) AS INTEGER) AS hora, event_type AS linea,
           CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS pasajeros FROM events GROUP BY 1, 2, 3)"""
_CLIMATE = """climate AS (
    SELECT CAST(ts AS DATE) AS fecha, avg(value) FILTER (event_type = 'view') AS pm25,
           avg(value) FILTER (event_type = 'click') AS temp,
           avg(value) FILTER (event_type = 'signup') - 48.5 AS rain FROM events GROUP BY 1)"""
_MONTHLY = f"""{_HOURLY}, {_CLIMATE}, daily AS (
    SELECT fecha, linea, sum(pasajeros) AS pax, any_value(pm25) AS pm25, any_value(rain) AS rain
    FROM hourly LEFT JOIN climate USING (fecha) GROUP BY 1, 2),
  monthly AS (
    SELECT CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, linea,
           CAST(sum(pax) AS BIGINT) AS pasajeros_mes, avg(pax) AS pasajeros_promedio_dia,
           avg(pm25) AS pm25_promedio_mes, sum(rain) AS precipitacion_total_mes_mm,
           {sql_corr('pm25', 'pax')} AS corr_pm25_pasajeros, {sql_corr('rain', 'pax')} AS corr_precip_pasajeros,
           count(*) AS dias_observados FROM daily GROUP BY ALL)"""
_OBSERVED = f"""observed AS (
    SELECT event_type AS linea, {sql_band('hour(ts)')} AS franja_horaria, CAST(trunc(value) AS BIGINT) AS pasajeros
    FROM events WHERE trunc(value) > 0)"""
_TRIPS = """trips AS (
    SELECT CAST(ts AS DATE) AS fecha, value AS duracion_min,
           CASE WHEN value < 10 THEN 'corta' WHEN value < 30 THEN 'media' ELSE 'larga' END AS categoria_duracion
    FROM events WHERE value BETWEEN 1 AND 240)"""


def _sql_bin(value: str, width: int) -> str:
    low = f"CAST(floor({value} / {width}) * {width} AS BIGINT)"
    return f"CASE WHEN {value} IS NULL THEN 'sin_dato' ELSE {low} || '-' || ({low} + {width}) END"


_DEMAND = f"""{_TRIPS}, {_CLIMATE}, counted AS (
    SELECT fecha, {_sql_bin('temp', 4)} AS bin_temperatura, {_sql_bin('pm25', 15)} AS bin_pm25,
           CASE WHEN rain > 1.0 THEN 1 ELSE 0 END AS llovio, count(*) AS viajes,
           avg(duracion_min) AS duracion_promedio_min
    FROM trips LEFT JOIN climate USING (fecha) GROUP BY ALL),
  demand AS (SELECT *, viajes / (SELECT avg(viajes) FROM counted) * 100.0 - 100.0 AS viajes_relativos_pct FROM counted)"""
_EXACT_POINTS = ", ".join(
    f"CAST(trunc((max(pasajeros) FILTER (r = low{p}) * (100 - over{p}) + max(pasajeros) FILTER (r = low{p} + 1) * over{p}) / 100.0) AS BIGINT) AS p{p}"
    for p in (50, 75, 90, 95)
)
_EXACT_SPLIT = ", ".join(f"(n + 1) * {p} - low{p} * 100 AS over{p}" for p in (50, 75, 90, 95))
_EXACT_LOW = ", ".join(f"least((n + 1) * {p} // 100, n - 1) AS low{p}" for p in (50, 75, 90, 95))

SQL = {
    "daily_then_monthly_corr": f"""WITH {_MONTHLY}
        SELECT anio, mes, linea, pasajeros_mes, {', '.join(f'{sql_shown(c)} AS {c}' for c in MONTHLY_SHOWN)},
               dias_observados FROM monthly""",
    "corr_mean_per_line": f"""WITH {_MONTHLY}
        SELECT linea, {sql_shown('avg(corr_pm25_pasajeros)')} AS corr_pm25_media,
               {sql_shown('avg(corr_precip_pasajeros)')} AS corr_precip_media, count(*) AS meses_observados
        FROM monthly GROUP BY linea""",
    "ridership_enriched": f"""WITH {_HOURLY}, {_CLIMATE}
        SELECT fecha, hora, linea, pasajeros, {sql_shown('pm25')} AS pm25_promedio_red,
               {sql_shown('temp')} AS temperatura_promedio_c, {sql_shown('rain')} AS precipitacion_total_mm,
               CAST(year(fecha) AS INTEGER) AS anio, CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana,
               CASE WHEN dayofweek(fecha) IN (0, 6) THEN 1 ELSE 0 END AS es_finde, {sql_band('hora')} AS franja_horaria
        FROM hourly LEFT JOIN climate USING (fecha)""",
    "band_percentiles": f"""WITH {_OBSERVED}
        SELECT linea, franja_horaria, quantile_disc(pasajeros, 0.50) AS p50, quantile_disc(pasajeros, 0.75) AS p75,
               quantile_disc(pasajeros, 0.90) AS p90, quantile_disc(pasajeros, 0.95) AS p95, count(*) AS muestras
        FROM observed GROUP BY 1, 2 HAVING count(*) >= 10""",
    "band_percentiles_exact": f"""WITH {_OBSERVED}, placed AS (
        SELECT *, row_number() OVER (PARTITION BY linea, franja_horaria ORDER BY pasajeros) AS r,
               count(*) OVER (PARTITION BY linea, franja_horaria) AS n FROM observed),
      lows AS (SELECT *, {_EXACT_LOW} FROM placed WHERE n >= 10),
      split AS (SELECT *, {_EXACT_SPLIT} FROM lows)
        SELECT linea, franja_horaria, {_EXACT_POINTS}, n AS muestras FROM split
        GROUP BY linea, franja_horaria, n, {', '.join(f'low{p}, over{p}' for p in (50, 75, 90, 95))}""",
    "trips_by_class": f"""WITH {_TRIPS}
        SELECT categoria_duracion, count(*) AS n, {sql_shown('avg(duracion_min)')} AS media FROM trips GROUP BY 1""",
    "demand_by_climate_bin": f"""WITH {_DEMAND}
        SELECT fecha, bin_temperatura, bin_pm25, llovio, viajes,
               {sql_shown('duracion_promedio_min')} AS duracion_promedio_min,
               {sql_shown('viajes_relativos_pct')} AS viajes_relativos_pct, CAST(year(fecha) AS INTEGER) AS anio
        FROM demand""",
    "rain_effect": f"""WITH {_DEMAND}
        SELECT llovio, {sql_shown('avg(viajes)')} AS viajes_promedio,
               {sql_shown('avg(viajes_relativos_pct)')} AS pct_respecto_media, count(*) AS dias FROM demand GROUP BY 1""",
    "rain_drop": f"""WITH {_DEMAND}
        SELECT {sql_shown('(1 - avg(viajes) FILTER (llovio = 1) / avg(viajes) FILTER (llovio = 0)) * 100')} AS caida_pct
        FROM demand""",
    "demand_by_temperature": f"""WITH {_DEMAND}
        SELECT bin_temperatura, {sql_shown('avg(viajes)')} AS viajes_promedio FROM demand
        WHERE bin_temperatura <> 'sin_dato' GROUP BY 1""",
    "weekday_band_profile": f"""
        SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dia_semana,
               CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS es_finde, {sql_band('hour(ts)')} AS franja_horaria,
               CAST(month(ts) AS INTEGER) AS mes, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS dias,
               {sql_shown('avg(value)')} AS media FROM events GROUP BY 1, 2, 3, 4""",
    "errors_per_hour": """
        SELECT CAST(hour(ts) AS INTEGER) AS hora, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1""",
    "rolling_5min": f"""
        SELECT DISTINCT event_type, ts, {sql_shown('sum(value) OVER recent')} AS suma, count(*) OVER recent AS cuenta
        FROM events WINDOW recent AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)""",
    "ridership_clean": """
        SELECT event_id, CAST(ts AS DATE) AS fecha, event_type AS linea, CAST(hour(ts) AS INTEGER) AS hora,
               CAST(floor(value) AS BIGINT) AS pasajeros
        FROM events WHERE event_type NOT IN ('view', 'click') AND floor(value) > 0""",
    "wide_to_long": """
        SELECT CAST(ts AS DATE) AS fecha, event_type AS linea, CAST(hour(ts) AS INTEGER) AS hora, count(*) AS pasajeros
        FROM events GROUP BY 1, 2, 3""",
    "micro_events": f"""WITH {_HOURLY}
        SELECT linea, CAST(fecha AS TIMESTAMP) + to_hours(hora) + to_minutes(5 * i) AS timestamp, hora,
               pasajeros // 12 + CASE WHEN i < pasajeros % 12 THEN 1 ELSE 0 END AS pasajeros_periodo,
               pasajeros AS pasajeros_hora_total
        FROM hourly, unnest(range(12)) AS parts(i) WHERE pasajeros > 0""",
}

for _name in ("ridership_enriched", "demand_by_climate_bin", "ridership_clean", "wide_to_long"):
    SQL[_name] = sql_day_text(SQL[_name])
