"""The streaming jobs: JSON messages in, windows into an insert-once sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vialis.functions.calendar import event_time
from vialis.functions.measures import whole_or_zero
from vialis.functions.messages import AIR_SCHEMA, BIKE_SCHEMA, CORRIDOR_SCHEMA, LINE_SCHEMA, air_message, decode
from vialis.plans import DEFAULT, Layers
from vialis.streaming import alerts, sinks, stateful


def _timed(messages: DataFrame, schema: str, key: str) -> DataFrame:
    """Typed messages with an event time; without a readable one, the time of arrival."""
    fields = decode(messages.select("value"), schema, key=key)
    return fields.withColumn("ts", event_time(F.col("timestamp"), F.current_timestamp()))


def air_readings(messages: DataFrame) -> DataFrame:
    return air_message(_timed(messages, AIR_SCHEMA, "zona"))


def bike_stock(messages: DataFrame) -> DataFrame:
    return _timed(messages, BIKE_SCHEMA, "estacion_id").withColumn(
        "bicicletas_disponibles", whole_or_zero(F.col("bicicletas_disponibles")))


def corridor_counts(messages: DataFrame) -> DataFrame:
    return _timed(messages, CORRIDOR_SCHEMA, "corredor").withColumns({
        "corredor": F.trim("corredor"), "intensidad": whole_or_zero(F.col("intensidad"))})


def line_counts(messages: DataFrame) -> DataFrame:
    return _timed(messages, LINE_SCHEMA, "linea").withColumns({
        "linea": F.trim("linea"), "pasajeros_periodo": whole_or_zero(F.col("pasajeros_periodo"), "bigint")})


def _job(windows: DataFrame, key: str, sink: str, state: str, every: str | None) -> StreamingQuery:
    return sinks.write_once(alerts.emitted(windows), sink, [key, "ventana_inicio"], "ventana_inicio", state, every)


def run_air_alerts(messages: DataFrame, sink: str, state: str, every: str | None = sinks.TRIGGER, **options) -> StreamingQuery:
    return _job(alerts.air_alerts(air_readings(messages), "zona", "ts", "pm25", **options), "zona", sink, state, every)


def run_short_air_alerts(messages: DataFrame, sink: str, state: str, every: str | None = sinks.TRIGGER, **options) -> StreamingQuery:
    """One-minute windows over the arrival time."""
    arrived = alerts.arrived_now(air_readings(messages))
    return _job(alerts.air_alerts_short_window(arrived, "zona", "llegada", "pm25", **options), "zona", sink, state, every)


def run_arrival_air_alerts(messages: DataFrame, sink: str, state: str, every: str | None = sinks.TRIGGER, **options) -> StreamingQuery:
    """Windows of arrival time that a timer ends, whether or not more readings come."""
    found = stateful.arrival_alerts(air_readings(messages), "zona", "pm25", **options)
    with sinks.keyed_state(messages.sparkSession):
        return _job(found, "zona", sink, state, every)


def run_air_means(
    messages: DataFrame, sink: str, late: str, state: str, every: str | None = sinks.TRIGGER, **options
) -> StreamingQuery:
    """The mean of every zone and window, and a table of the readings that came after their window had closed."""
    found = stateful.means_and_late_rows(air_readings(messages), "zona", "ts", "pm25", **options)
    return sinks.write_with_late(alerts.emitted(found), sink, late, "tardia", state, every)


def run_bike_snapshots(messages: DataFrame, sink: str, state: str, every: str | None = sinks.TRIGGER, **options) -> StreamingQuery:
    about = ["nombre", "latitud", "longitud", "capacidad_anclajes"]
    windows = alerts.bike_snapshots(bike_stock(messages), "estacion_id", "ts", "bicicletas_disponibles", about, **options)
    return _job(windows, "estacion_id", sink, state, every)


def run_corridor_snapshots(
    messages: DataFrame, risky: DataFrame, sink: str, state: str, every: str | None = sinks.TRIGGER, **options
) -> StreamingQuery:
    windows = alerts.corridor_snapshots(
        corridor_counts(messages), "corredor", "ts", "intensidad", risky, ["latitud", "longitud"], **options)
    return _job(windows, "corredor", sink, state, every)


def run_line_snapshots(messages: DataFrame, sink: str, state: str, every: str | None = sinks.TRIGGER, **options) -> StreamingQuery:
    windows = alerts.line_snapshots(line_counts(messages), "linea", "ts", "pasajeros_periodo", **options)
    return _job(windows, "linea", sink, state, every)


def run_hybrid_alerts(
    lines: DataFrame, air: DataFrame, reference: DataFrame, sink: str, state: str,
    every: str | None = sinks.TRIGGER, rolling: bool = False, **options,
) -> StreamingQuery:
    """Both topics against the percentiles of the gold layer, in windows or, ``rolling``, at every event of a line."""
    weather = air_readings(air).select(
        F.col("ts").alias("ts_aire"), F.col("precipitacion_mm").alias("lluvia"), F.col("pm25").alias("pm25_aire"))
    sides = (line_counts(lines), "linea", "ts", "pasajeros_periodo", weather, "ts_aire", "lluvia", "pm25_aire", reference)
    if not rolling:
        return _job(alerts.hybrid_alerts(*sides, **options), "linea", sink, state, every)
    with sinks.keyed_state(lines.sparkSession):
        return _job(stateful.rolling_hybrid_alerts(*sides, **options), "linea", sink, state, every)


def run_air_ingest(messages: DataFrame, state: str, layers: Layers = DEFAULT, every: str | None = sinks.TRIGGER) -> StreamingQuery:
    return sinks.append_table(sinks.air_rows(messages), layers.raw("aire_stream"), state, every)
