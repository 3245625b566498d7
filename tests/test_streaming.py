import datetime as dt
import json

import pytest

from vialis.plans import live
from vialis.streaming import alerts, sinks
from vialis.streaming.sources import open_stream, publish

START = dt.datetime(2024, 1, 1, 10)


def at(minutes, seconds=0):
    return START + dt.timedelta(minutes=minutes, seconds=seconds)


def air(spark, data):
    return spark.createDataFrame([("A", at(m), x) for m, x in data], "zona string, ts timestamp, pm25 double")


READINGS = [(0, 70.0), (3, 80.0), (6, -1.0), (9, None)]


def test_limit_is_exclusive_by_default(spark):
    assert alerts.air_alerts(air(spark, READINGS), "zona", "ts", "pm25").isEmpty()
    found = alerts.air_alerts(air(spark, READINGS), "zona", "ts", "pm25", inclusive=True).collect()
    assert [(r["pm25_promedio"], r["lecturas_en_ventana"], r["gravedad"]) for r in found] == [(75.0, 2, "moderada")]
    variant = alerts.air_alerts(air(spark, READINGS), "zona", "ts", "pm25", inclusive=True, keep_non_positive=True, limit=40)
    assert [(r["pm25_promedio"], r["lecturas_en_ventana"]) for r in variant.collect()] == [(49.67, 3)]
    assert alerts.air_alerts_short_window(air(spark, [(0, 75.0)]), "zona", "ts", "pm25").first()["gravedad"] == "moderada"


def test_sliding_windows_hold_an_event_twice(spark):
    stock = spark.createDataFrame([("E1", at(0, 45), 5, "vieja"), ("E1", at(0, 50), 2, "nueva")], "e string, ts timestamp, b int, nombre string")
    found = alerts.bike_snapshots(stock, "e", "ts", "b", ["nombre"]).orderBy("ventana_inicio").collect()
    assert [r["ventana_inicio"] for r in found] == [at(0), at(0, 30)]
    assert {(r["bicicletas_min"], r["bicicletas_avg"], r["bicicletas_ultimo"], r["nombre"], r["tipo"]) for r in found} == {
        (2, 3.5, 2, "nueva", "ALERTA_DISPONIBILIDAD")}


def test_corridor_limit(spark):
    counts = spark.createDataFrame([("Calle 33", at(0), 400), ("Carrera 70", at(0), 399), ("Otra", at(0), 900), (" ", at(0), 1)], "corredor string, ts timestamp, n int")
    risky = spark.createDataFrame([("Calle 33",), ("Carrera 70",)], "corredor string")
    found = {r["corredor"]: (r["tipo"], r["intensidad_por_minuto"], r["alta_siniestralidad"]) for r in alerts.corridor_snapshots(counts, "corredor", "ts", "n", risky).collect()}
    assert found == {"Calle 33": ("ALERTA_CORREDOR_RIESGO", 80.0, True), "Carrera 70": ("snapshot_corredor", 79.8, True), "Otra": ("snapshot_corredor", 180.0, False)}


@pytest.mark.parametrize("passengers, rain, fires", [(69, 0.3, True), (70, 0.3, False), (69, 0.29, False)])
def test_hybrid_limits(spark, passengers, rain, fires):
    ridership = spark.createDataFrame([("A", at(1), passengers)], "linea string, ts timestamp, n bigint")
    weather = spark.createDataFrame([(at(2), rain, 20.0), (at(3), None, 30.0)], "t timestamp, r double, p double")
    reference = spark.createDataFrame([("A", "valle_am", 1, 2, 1200, 4, 10)], "linea string, franja_horaria string, p50 bigint, p75 bigint, p90 bigint, p95 bigint, muestras bigint")
    found = alerts.hybrid_alerts(ridership, "linea", "ts", "n", weather, "t", "r", "p", reference).collect()
    assert [(r["ratio_vs_referencia"], r["afluencia_5min_referencia"], r["lluvia_mm"], r["pm25_red"]) for r in found] == (
        [(0.69, 100, rain, 30.0)] if fires else [])


def messages(tmp_path, topic, values):
    folder = tmp_path / topic
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"topic": topic, "key": "k", "value": json.dumps(v) if isinstance(v, dict) else v, "partition": 0, "offset": i}) for i, v in enumerate(values)]
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(lines) + "\n")
    return str(folder)


def reading(minute, value, zone="A", **more):
    return {"estacion_id": "S1", "zona": zone, "timestamp": at(minute).isoformat(), "pm25": value, **more}


def test_late_readings_and_restarts(spark, tmp_path):
    """A closed window stays as first written; a restart goes on where the stream stopped."""
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    place = messages(tmp_path, "aire", [reading(0, "90"), reading(5, "100"), reading(45, "80"), reading(1, "95", zone=" "), "roto"])

    def run(checkpoint=state):
        return sinks.run_for(live.run_air_alerts(open_stream(spark, "files", place, ["aire"]), sink, checkpoint, every=None))

    run()
    first = sinks.read_once_sink(spark, sink).collect()
    assert [(r["zona"], r["ventana_inicio"], r["pm25_promedio"]) for r in first] == [("A", at(0), 95.0)]
    messages(tmp_path, "aire", [reading(2, "500"), reading(90, "80")])
    late = run()
    assert sinks.late_rows(late) == 1
    found = {r["ventana_inicio"]: r["pm25_promedio"] for r in sinks.read_once_sink(spark, sink).collect()}
    assert found == {at(0): 95.0, at(40): 80.0}
    # From the start again: the window that now holds the late reading is already there.
    run(str(tmp_path / "other"))
    again = {r["ventana_inicio"]: r["pm25_promedio"] for r in sinks.read_once_sink(spark, sink).collect()}
    assert again == found


def test_every_job_writes(spark, tmp_path, layers):
    bikes = [{"estacion_id": "E1", "nombre": "n", "latitud": 6.2, "longitud": -75.5, "capacidad_anclajes": 12, "bicicletas_disponibles": b, "timestamp": at(m).isoformat()} for m, b in ((0, 1), (10, 5))]
    cars = [{"corredor": "Calle 33", "latitud": 6.2, "longitud": -75.5, "timestamp": at(m).isoformat(), "intensidad": n} for m, n in ((0, 400), (30, ""))]
    lines = [{"linea": "A", "timestamp": at(m).isoformat(), "pasajeros_periodo": 10} for m in (0, 1, 30)]
    rain = [reading(m, 50, precipitacion_mm=0.5) for m in (0, 30)]
    reference = spark.createDataFrame([("A", "valle_am", 1, 2, 1200, 4, 10)], "linea string, franja_horaria string, p50 bigint, p75 bigint, p90 bigint, p95 bigint, muestras bigint")
    risky = spark.createDataFrame([("Calle 33",)], "corredor string")
    opened = lambda name, values: open_stream(spark, "files", messages(tmp_path, name, values), [name])
    jobs = {
        "bikes": lambda s, c: live.run_bike_snapshots(opened("bikes", bikes), s, c, every=None),
        "cars": lambda s, c: live.run_corridor_snapshots(opened("cars", cars), risky, s, c, every=None),
        "lines": lambda s, c: live.run_line_snapshots(opened("lines", lines), s, c, every=None),
        "hybrid": lambda s, c: live.run_hybrid_alerts(opened("l2", lines), opened("rain", rain), reference, s, c, every=None),
    }
    found = {}
    for name, start in jobs.items():
        sinks.run_for(start(str(tmp_path / f"{name}-sink"), str(tmp_path / f"{name}-state")))
        found[name] = sinks.read_once_sink(spark, str(tmp_path / f"{name}-sink")).collect()
    assert {(r["estacion_id"], r["capacidad_anclajes"], r["tipo"]) for r in found["bikes"]} == {("E1", 12, "ALERTA_DISPONIBILIDAD")}
    assert [(r["corredor"], r["tipo"], r["latitud"]) for r in found["cars"]] == [("Calle 33", "ALERTA_CORREDOR_RIESGO", 6.2)]
    assert [(r["linea"], r["pasajeros_acumulados"], r["eventos_en_ventana"]) for r in found["lines"]] == [("A", 20, 2)]
    assert [(r["linea"], r["ratio_vs_referencia"], r["lluvia_mm"]) for r in found["hybrid"]] == [("A", 0.2, 0.5)]
    ingest = live.run_air_ingest(opened("raw", rain), str(tmp_path / "raw-state"), layers, every=None)
    sinks.run_for(ingest)
    assert spark.table(layers.raw("aire_stream")).count() == 2


def test_publish_keeps_time_order(spark, tmp_path):
    frame = spark.createDataFrame([(f"k{i}", at(59 - i)) for i in range(60)], "k string, t timestamp")
    publish(frame, "tema", "k", "t", str(tmp_path / "m"))
    stored = spark.read.json(str(tmp_path / "m")).orderBy("partition", "offset").collect()
    assert [json.loads(r["value"])["k"] for r in stored] == [f"k{i}" for i in range(59, -1, -1)]
    with pytest.raises(ValueError):
        open_stream(spark, "cartas", "x")


def test_bounded_run_stops(spark, tmp_path):
    place = messages(tmp_path, "aire", [reading(0, "90")])
    query = live.run_air_alerts(open_stream(spark, "files", place), str(tmp_path / "s"), str(tmp_path / "c"), every="1 second")
    assert not sinks.run_for(query, 3).isActive


def test_a_batch_adds_one_file_to_a_day(spark, tmp_path):
    """A stream's session has no adaptive execution: without a deal by day every task would add a file to every day."""
    from pyspark.sql import functions as F

    rows = spark.range(600).select(
        F.col("id").alias("k"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 15 * 86_400).alias("ts"))
    sink = tmp_path / "sink"
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.insert_absent(rows.filter("k < 300"), str(sink), ["k", "ts"], "ts")
        assert len(list(sink.glob("_day=*"))) == len(list(sink.glob("_day=*/part-*"))) == 15
        sinks.insert_absent(rows, str(sink), ["k", "ts"], "ts")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(list(sink.glob("_day=*/part-*"))) == 30
    assert sorted(r["k"] for r in sinks.read_once_sink(spark, str(sink)).collect()) == list(range(600))


@pytest.mark.parametrize("value", [10.0, 90.0])
def test_a_sink_without_alerts_is_read_as_no_rows(spark, tmp_path, value):
    """Where no window passes the limit the sink gets no file that would tell its columns."""
    from vialis.questions import live as asked

    spark.createDataFrame([(i, at(20 * i), i, "view", value) for i in range(4)], "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(
        str(tmp_path / "events.parquet"))
    found = asked.stream_sink_once(spark, str(tmp_path))
    assert found.columns == asked.stream_tumbling_alert(spark, str(tmp_path)).columns
    assert [r["ventana_inicio"] for r in found.orderBy("ventana_inicio").collect()] == ([] if value < 75 else [at(0), at(20), at(40)])
