"""Streams over the events: each query runs a bounded stream to its end and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialis.functions.messages import LINE_SCHEMA, decode, has_key
from vialis.functions.measures import whole_or_zero
from vialis.questions import ridership
from vialis.questions.base import events, local_times, sql_band, sql_shown, with_shown
from vialis.questions.stored import layer
from vialis.session import scratch_folder
from vialis.streaming import alerts, sinks, stateful
from vialis.streaming.sources import of_topics, open_stream, publish, stream_parquet


def stream(spark, sf_dir) -> DataFrame:
    return stream_parquet(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def finished(spark, df: DataFrame, name: str) -> DataFrame:
    """Rows a stream writes until its input is used up."""
    path = scratch_folder(spark, name)
    sinks.run_for(sinks.write_files(df, path, f"{path}-estado", every=None))
    return spark.read.schema(df.schema).parquet(path)


def windows_shown(df: DataFrame, *averages: str) -> DataFrame:
    return local_times(with_shown(df, *averages, places=2) if averages else df, "ventana_inicio", "ventana_fin")


def as_air_messages(df: DataFrame) -> DataFrame:
    """Events as JSON air messages; sign-ups have no readable time and clicks no station."""
    value = F.to_json(F.struct(
        F.when(F.col("event_type") != "click", F.col("user_id").cast("string")).alias("estacion_id"),
        F.col("event_type").alias("zona"),
        F.when(F.col("event_type") == "signup", F.lit("ayer")).otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(F.col("value") < 1, F.lit("")).otherwise(F.col("value").cast("string")).alias("pm25"),
        F.get_json_object("props", "$.k").alias("pm10"),
    ))
    return df.select(value.alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


def stream_ingest(spark, sf_dir):
    """JSON messages typed and appended to a bronze table by a stream."""
    target = f"{layer(spark)}.lecturas_stream"
    rows = sinks.air_rows(as_air_messages(stream(spark, sf_dir)))
    sinks.run_for(sinks.append_table(rows, target, scratch_folder(spark, "estado"), every=None))
    stored = spark.table(target).withColumn("con_hora", F.col("event_ts").isNotNull())
    # A reading without a time of its own carries the arrival time, which no query can repeat.
    own = F.when(F.col("zona") != "signup", F.col("event_ts"))
    return local_times(stored.select(
        "kafka_offset", "estacion_id", "zona", "pm25", "pm10", "con_hora", own.alias("event_ts")), "event_ts")


def stream_tumbling_alert(spark, sf_dir):
    found = alerts.air_alerts(stream(spark, sf_dir), "event_type", "ts", "value")
    return windows_shown(finished(spark, found, "alertas"))


def stream_short_alert(spark, sf_dir):
    found = alerts.air_alerts_short_window(stream(spark, sf_dir), "event_type", "ts", "value")
    return windows_shown(finished(spark, found, "alertas"))


def arrival_windows(spark, sf_dir):
    """The short-window alert on arrival time, over a batch: all readings arrive at once."""
    arrived = alerts.arrived_now(events(spark, sf_dir))
    found = alerts.air_alerts_short_window(arrived, "event_type", "llegada", "value", limit=40.0)
    return with_shown(found, "pm25_promedio", places=2).drop("ventana_inicio", "ventana_fin")


def stream_sliding_stock(spark, sf_dir):
    stock = stream(spark, sf_dir).withColumn("bicis", F.col("value").cast("bigint"))
    found = alerts.bike_snapshots(stock, "user_id", "ts", "bicis", ["event_type", "event_id"])
    return windows_shown(finished(spark, found, "bicis"))


def risky_users(spark, sf_dir):
    """Users with the most errors stand for risk corridors."""
    errors = events(spark, sf_dir).filter(F.col("event_type") == "error").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return errors.orderBy(F.desc("n"), "user_id").limit(20).select("user_id")


def stream_corridor_alert(spark, sf_dir):
    counts = stream(spark, sf_dir).withColumn("vehiculos", F.col("value").cast("bigint"))
    found = alerts.corridor_snapshots(
        counts, "user_id", "ts", "vehiculos", risky_users(spark, sf_dir), about=["event_type"], limit=20)
    return windows_shown(finished(spark, found, "corredores"))


def stream_line_counts(spark, sf_dir):
    counts = stream(spark, sf_dir).withColumn("pax", F.col("value").cast("bigint"))
    return windows_shown(finished(spark, alerts.line_snapshots(counts, "event_type", "ts", "pax"), "lineas"))


def stream_replay(spark, sf_dir):
    """Ridership published as keyed JSON messages in time order, read back as a stream of two topics."""
    place = scratch_folder(spark, "mensajes")
    rows = events(spark, sf_dir)
    line = rows.select(
        F.when(F.col("event_type") == "click", F.lit(" ")).otherwise(F.col("event_type")).alias("linea"),
        F.col("ts").alias("timestamp"), F.hour("ts").alias("hora"),
        F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("value").cast("bigint").cast("string")).alias("pasajeros_periodo"))
    publish(line, "linea", "linea", "timestamp", place)
    publish(rows.select("event_id", "ts"), "otro", "event_id", "ts", place)
    both = open_stream(spark, "files", place, ["linea", "otro"])
    messages = decode(of_topics(both, ["linea"]).select("value"), LINE_SCHEMA)
    typed = has_key(messages, "linea").select(
        "linea", F.try_to_timestamp("timestamp").alias("ts"), whole_or_zero(F.col("pasajeros_periodo"), "bigint").alias("pax"))
    return windows_shown(finished(spark, alerts.line_snapshots(typed, "linea", "ts", "pax"), "lineas"))


def _hybrid(spark, sf_dir, source, **options):
    """Views as ridership, errors as rain, against the percentiles of the whole table."""
    reference = ridership.band_percentiles(spark, sf_dir).withColumn("p90", F.col("p90") * 12)
    seen = source(spark, sf_dir).withColumn("pax", F.col("value").cast("bigint"))
    wet = source(spark, sf_dir).filter(F.col("event_type") == "error").select(
        F.col("ts").alias("ts_lluvia"), (F.col("value") / 100).alias("lluvia"), F.col("value").alias("pm25"))
    return alerts.hybrid_alerts(seen, "event_type", "ts", "pax", wet, "ts_lluvia", "lluvia", "pm25", reference, **options)


def stream_hybrid_alert(spark, sf_dir):
    found = finished(spark, _hybrid(spark, sf_dir, stream), "hibridas")
    return local_times(with_shown(found, "lluvia_mm", "ratio_vs_referencia", places=3), "ventana_inicio", "ventana_fin")


def hybrid_rolling(spark, sf_dir):
    """The rolling form over the stored events: the last five minutes, every minute, newest rain reading."""
    found = _hybrid(spark, sf_dir, events, slide="1 minute", last_rain=True)
    return local_times(with_shown(found, "lluvia_mm", "ratio_vs_referencia", places=3), "ventana_inicio", "ventana_fin")


def _sides(spark, sf_dir):
    """Views as ridership, errors as rain, as streams."""
    seen = stream(spark, sf_dir).withColumn("pax", F.col("value").cast("bigint"))
    wet = stream(spark, sf_dir).filter(F.col("event_type") == "error").select(
        F.col("ts").alias("ts_lluvia"), (F.col("value") / 100).alias("lluvia"), F.col("value").alias("pm25"))
    return seen, wet


def stream_hybrid_rolling(spark, sf_dir):
    """The rolling hybrid alert at every event: the line's last five minutes and the newest rain, kept by a stream's own state."""
    reference = ridership.band_percentiles(spark, sf_dir).withColumn("p90", F.col("p90") * 12)
    seen, wet = _sides(spark, sf_dir)
    found = stateful.rolling_hybrid_alerts(seen, "event_type", "ts", "pax", wet, "ts_lluvia", "lluvia", "pm25", reference)
    with sinks.keyed_state(spark):
        rows = finished(spark, found, "hibridas-moviles")
    return local_times(with_shown(rows, "lluvia_mm", "ratio_vs_referencia", places=3), "momento", "ventana_inicio", "ventana_fin")


def stream_last_rain(spark, sf_dir):
    """Each event with the newest rain reading at or before it, both sides being streams."""
    seen, wet = _sides(spark, sf_dir)
    left = seen.filter(F.col("event_type") != "error").select("event_id", "event_type", "ts")
    found = stateful.with_last_reading(left, wet.withColumnRenamed("ts_lluvia", "ts"), "ts", "pm25")
    with sinks.keyed_state(spark):
        return local_times(finished(spark, found, "ultima-lluvia"), "ts")


def _deliveries(spark, sf_dir):
    """Events in deliveries of ten days, a seventh of them one delivery late."""
    late = F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    return events(spark, sf_dir).withColumn("lote", F.floor((F.dayofmonth("ts") - 1) / 10).cast("int") + late)


def stream_late_rows(spark, sf_dir):
    """Readings that came after the watermark had closed their window, over four deliveries to one stream."""
    path = scratch_folder(spark, "tardias")
    rows = _deliveries(spark, sf_dir)
    for lote in range(5):
        rows.filter(F.col("lote") == lote).drop("lote").write.mode("append").parquet(f"{path}/entrada")
        landed = spark.readStream.schema(rows.drop("lote").schema).parquet(f"{path}/entrada")
        found = stateful.means_and_late_rows(landed, "event_type", "ts", "value")
        sinks.run_for(sinks.write_with_late(found, f"{path}/medias", f"{path}/aparte", "tardia", f"{path}/estado", every=None))
    late = sinks.read_batches(spark, f"{path}/aparte").withColumnRenamed("pm25_promedio", "valor").drop("lecturas_en_ventana")
    return local_times(late, "ventana_inicio", "ventana_fin", "momento")


ARRIVAL_SECONDS = 4


def stream_arrival_windows(spark, sf_dir):
    """Two deliveries more than a window of arrival time apart: one mean per zone and delivery, ended by timers."""
    path = scratch_folder(spark, "llegadas")
    rows = events(spark, sf_dir).withColumn("lote", F.when(F.col("event_id") % 3 == 0, "a").otherwise("b"))
    zone = F.concat_ws("/", "lote", "event_type").alias("zona")
    landed = lambda: spark.readStream.schema("zona string, value double").parquet(f"{path}/entrada")
    rows.filter("false").select(zone, "value").write.parquet(f"{path}/entrada")
    found = stateful.arrival_means(landed(), "zona", "value", ARRIVAL_SECONDS)
    with sinks.keyed_state(spark):
        query = sinks.write_files(found, f"{path}/medias", f"{path}/estado", every="1 second")
    stored = lambda: spark.read.schema(found.schema).parquet(f"{path}/medias")
    try:
        for n, lote in enumerate("ab", start=1):
            batch = rows.filter(F.col("lote") == lote).select(zone, "value")
            batch.write.mode("append").parquet(f"{path}/entrada")
            expected = rows.filter(F.col("lote") <= lote).select(zone).distinct().count()
            sinks.wait_until(query, lambda expected=expected: stored().count() >= expected)
    finally:
        query.stop()
    parts = F.split("zona", "/")
    return with_shown(stored().select(
        parts[0].alias("lote"), parts[1].alias("event_type"), "pm25_promedio", "lecturas_en_ventana"), "pm25_promedio")


def stream_sink_once(spark, sf_dir):
    """The insert-once sink after two runs on one checkpoint and one on a fresh checkpoint."""
    path = scratch_folder(spark, "unico")
    keys = ["event_type", "ventana_inicio"]
    for state in ("a", "a", "b"):
        found = alerts.emitted(alerts.air_alerts(stream(spark, sf_dir), "event_type", "ts", "value"))
        sinks.run_for(sinks.write_once(found, path, keys, "ventana_inicio", f"{path}-estado-{state}", every=None))
    return windows_shown(sinks.read_once_sink(spark, path, found.schema).drop("emitido_en"))


QUERIES = {q.__name__: q for q in (
    stream_ingest, stream_tumbling_alert, stream_short_alert, arrival_windows, stream_sliding_stock, stream_corridor_alert,
    stream_line_counts, stream_replay, stream_hybrid_alert, hybrid_rolling, stream_sink_once,
    stream_hybrid_rolling, stream_last_rain, stream_late_rows, stream_arrival_windows,
)}

# A bounded stream closes the windows that end at or before the newest event, in milliseconds, minus the delay.
_CLOSED = "(SELECT date_trunc('milliseconds', max(ts)) FROM events{where}) - INTERVAL {delay} MINUTES"


def _sql_closed(delay: int, where: str = "") -> str:
    return _CLOSED.format(delay=delay, where=where)


def _sql_alerts(minutes: int, keep: str, passed: str, classes: str) -> str:
    return f"""SELECT * FROM (
        SELECT w AS ventana_inicio, w + INTERVAL {minutes} MINUTES AS ventana_fin, event_type, {sql_shown('a', 2)} AS pm25_promedio,
               n AS lecturas_en_ventana, 'ALERTA_PM25' AS tipo, {classes} AS gravedad, 75.0::DOUBLE AS umbral
        FROM (SELECT event_type, time_bucket(INTERVAL {minutes} MINUTES, ts) AS w, avg(value) AS a, count(*) AS n
              FROM events WHERE {keep} GROUP BY 1, 2) WHERE {passed})
        WHERE ventana_fin <= {_sql_closed(minutes, '' if keep == 'true' else f' WHERE {keep}')}"""


_LONG = _sql_alerts(10, "value > 0", "a > 75",
                    "CASE WHEN a >= 150 THEN 'critica' WHEN a >= 75 THEN 'moderada' ELSE 'leve' END")
_LINES = """SELECT w AS ventana_inicio, w + INTERVAL 5 MINUTES AS ventana_fin, {line}, pasajeros_acumulados, eventos_en_ventana,
               'snapshot_afluencia' AS tipo
        FROM (SELECT {line}, time_bucket(INTERVAL 5 MINUTES, ts) AS w, CAST(sum({pax}) AS BIGINT) AS pasajeros_acumulados,
                     count(*) AS eventos_en_ventana FROM {source} GROUP BY ALL)
        WHERE w + INTERVAL 5 MINUTES <= (SELECT date_trunc('milliseconds', max(ts)) FROM {source}) - INTERVAL 5 MINUTES"""
_PAX = "CAST(trunc(value) AS BIGINT)"


def _sql_hybrid(windows: str, rain: str, closed: str) -> str:
    return f"""WITH {ridership._OBSERVED}, ref AS (
        SELECT linea, franja_horaria, quantile_disc(pasajeros, 0.90) * 12 AS p90 FROM observed GROUP BY 1, 2 HAVING count(*) >= 10),
      placed AS (SELECT e.*, w.w FROM events e, {windows} AS w(w)),
      actual AS (SELECT event_type, w, CAST(sum({_PAX}) AS BIGINT) AS pax FROM placed GROUP BY 1, 2),
      wet AS (SELECT w, {rain} AS lluvia, arg_max(value, (ts, value)) AS pm25
              FROM placed WHERE event_type = 'error' GROUP BY 1)
        SELECT w AS ventana_inicio, w + INTERVAL 5 MINUTES AS ventana_fin, actual.event_type AS linea, franja_horaria,
               pax AS afluencia_5min_actual, CAST(trunc(p90 * (5 / 60)) AS BIGINT) AS afluencia_5min_referencia,
               {sql_shown('pax / (p90 * (5 / 60))', 3)} AS ratio_vs_referencia, 'p90' AS percentil_referencia,
               {sql_shown('lluvia', 3)} AS lluvia_mm, pm25 AS pm25_red, 'ALERTA_HIBRIDA' AS tipo,
               'afluencia_baja_durante_lluvia' AS hipotesis, 0.7::DOUBLE AS factor_umbral
        FROM actual JOIN wet USING (w) JOIN ref ON actual.event_type = ref.linea AND ref.franja_horaria = {sql_band('hour(w)')}
        WHERE lluvia >= 0.3 AND pax / (p90 * (5 / 60)) < 0.7 {closed}"""

# One watermark over both sides, which Spark unites before it is taken.
_BOTH_CLOSED = _sql_closed(5)

SQL = {
    "stream_ingest": """SELECT event_id AS kafka_offset, CAST(user_id AS VARCHAR) AS estacion_id, event_type AS zona,
        CASE WHEN value >= 1 THEN value END AS pm25, CAST(json_extract(props, '$.k') AS DOUBLE) AS pm10, true AS con_hora,
        CASE WHEN event_type <> 'signup' THEN ts END AS event_ts FROM events WHERE event_type <> 'click'""",
    "stream_tumbling_alert": _LONG,
    "stream_short_alert": _sql_alerts(1, "true", "a >= 75", "CASE WHEN a >= 100 THEN 'alta' ELSE 'moderada' END"),
    "arrival_windows": f"""SELECT event_type, {sql_shown('avg(value)', 2)} AS pm25_promedio, count(*) AS lecturas_en_ventana,
        'ALERTA_PM25' AS tipo, 'moderada' AS gravedad, 40.0::DOUBLE AS umbral FROM events GROUP BY 1 HAVING avg(value) >= 40""",
    "stream_sliding_stock": f"""WITH placed AS (
        SELECT *, {_PAX} AS bicis, unnest([time_bucket(INTERVAL 30 SECONDS, ts), time_bucket(INTERVAL 30 SECONDS, ts) - INTERVAL 30 SECONDS]) AS w
        FROM events)
        SELECT w AS ventana_inicio, w + INTERVAL 1 MINUTE AS ventana_fin, user_id, arg_max(event_type, (ts, bicis, event_type)) AS event_type,
               arg_max(event_id, (ts, bicis, event_type)) AS event_id, min(bicis) AS bicicletas_min, {sql_shown('avg(bicis)', 2)} AS bicicletas_avg,
               arg_max(bicis, (ts, bicis, event_type)) AS bicicletas_ultimo, count(*) AS lecturas,
               CASE WHEN min(bicis) <= 2 THEN 'ALERTA_DISPONIBILIDAD' ELSE 'snapshot_disponibilidad' END AS tipo, 2 AS umbral
        FROM placed GROUP BY w, user_id HAVING w + INTERVAL 1 MINUTE <= {_sql_closed(1)}""",
    "stream_corridor_alert": f"""WITH risky AS (
        SELECT user_id, true AS alta FROM events WHERE event_type = 'error' GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 20)
        SELECT w AS ventana_inicio, w + INTERVAL 5 MINUTES AS ventana_fin, user_id, event_type, t AS intensidad_total,
               {sql_shown('a', 2)} AS intensidad_promedio, {sql_shown('t / 5', 2)} AS intensidad_por_minuto, n AS lecturas,
               CASE WHEN alta AND t / 5 >= 20 THEN 'ALERTA_CORREDOR_RIESGO' ELSE 'snapshot_corredor' END AS tipo,
               coalesce(alta, false) AS alta_siniestralidad, 20 AS umbral_por_minuto
        FROM (SELECT user_id, time_bucket(INTERVAL 5 MINUTES, ts) AS w, CAST(sum({_PAX}) AS BIGINT) AS t, avg({_PAX}) AS a, count(*) AS n,
                     arg_max(event_type, (ts, event_type)) AS event_type FROM events GROUP BY 1, 2)
        LEFT JOIN risky USING (user_id) WHERE w + INTERVAL 5 MINUTES <= {_sql_closed(5)}""",
    "stream_line_counts": _LINES.format(line="event_type", pax=_PAX, source="events"),
    "stream_replay": "WITH lines AS (SELECT event_type AS linea, ts, CASE WHEN event_type = 'view' THEN 0 ELSE " + _PAX
        + " END AS pax FROM events WHERE event_type <> 'click') " + _LINES.format(line="linea", pax="pax", source="lines"),
    "stream_hybrid_alert": _sql_hybrid(
        "unnest([time_bucket(INTERVAL 5 MINUTES, ts)])", "sum(value / 100)",
        "AND w + INTERVAL 5 MINUTES <= least((SELECT date_trunc('milliseconds', max(ts)) FROM events), "
        "(SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_type = 'error')) - INTERVAL 5 MINUTES"),
    "hybrid_rolling": _sql_hybrid(
        "unnest([time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(i) for i in range(5)])",
        "arg_max(value / 100, (ts, value))", ""),
    "stream_sink_once": _LONG,
    "stream_hybrid_rolling": f"""WITH {ridership._OBSERVED}, ref AS (
        SELECT linea, franja_horaria, quantile_disc(pasajeros, 0.90) * 12 AS p90 FROM observed GROUP BY 1, 2 HAVING count(*) >= 10),
      rolled AS (
        SELECT DISTINCT event_type, ts, CAST(sum({_PAX}) OVER r AS BIGINT) AS pax, count(*) OVER r AS n FROM events
        WINDOW r AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW)),
      wet AS (SELECT ts, max(value) AS pm25 FROM events WHERE event_type = 'error' GROUP BY 1),
      met AS (SELECT rolled.*, pm25 FROM rolled ASOF JOIN wet ON rolled.ts >= wet.ts)
        SELECT event_type AS linea, franja_horaria, ts AS momento, date_trunc('minute', ts) AS ventana_inicio,
               date_trunc('minute', ts) + INTERVAL 5 MINUTES AS ventana_fin, pax AS afluencia_5min_actual, n AS eventos_en_ventana,
               CAST(trunc(p90 * (5 / 60)) AS BIGINT) AS afluencia_5min_referencia,
               {sql_shown('pax / (p90 * (5 / 60))', 3)} AS ratio_vs_referencia, 'p90' AS percentil_referencia,
               {sql_shown('pm25 / 100', 3)} AS lluvia_mm, pm25 AS pm25_red, 'ALERTA_HIBRIDA' AS tipo,
               'afluencia_baja_durante_lluvia' AS hipotesis, 0.7::DOUBLE AS factor_umbral
        FROM met JOIN ref ON event_type = ref.linea AND ref.franja_horaria = {sql_band('hour(ts)')}
        WHERE pm25 / 100 >= 0.3 AND pax / (p90 * (5 / 60)) < 0.7 AND ts <= {_BOTH_CLOSED}""",
    "stream_last_rain": f"""SELECT l.event_id, l.event_type, l.ts, r.pm25 FROM (SELECT * FROM events WHERE event_type <> 'error') l
        ASOF LEFT JOIN (SELECT ts, max(value) AS pm25 FROM events WHERE event_type = 'error' GROUP BY 1) r ON l.ts >= r.ts
        WHERE l.ts <= {_BOTH_CLOSED}""",
    "stream_late_rows": """WITH d AS (
        SELECT *, CAST((day(ts) - 1) // 10 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS lote,
               time_bucket(INTERVAL 10 MINUTES, ts) AS w FROM events),
      m AS (SELECT lote, max(max(ts)) OVER (ORDER BY lote ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM d GROUP BY 1)
        SELECT w AS ventana_inicio, w + INTERVAL 10 MINUTES AS ventana_fin, event_type, ts AS momento, value AS valor
        FROM d JOIN m USING (lote) WHERE w + INTERVAL 10 MINUTES <= date_trunc('milliseconds', newest) - INTERVAL 10 MINUTES""",
    "stream_arrival_windows": f"""SELECT CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'b' END AS lote, event_type,
        {sql_shown('avg(value)')} AS pm25_promedio, count(*) AS lecturas_en_ventana FROM events GROUP BY 1, 2""",
}
