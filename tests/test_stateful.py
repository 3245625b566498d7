import datetime as dt

import pandas as pd
import pytest

from vialis.streaming import sinks, stateful

START = dt.datetime(2024, 1, 1, 10)


def at(minutes, seconds=0):
    return START + dt.timedelta(minutes=minutes, seconds=seconds)


class Feed:
    """A folder of Parquet files read as a stream; each run takes what has come and stops."""

    def __init__(self, spark, tmp_path, schema, name):
        self.spark, self.schema, self.path = spark, schema, str(tmp_path / name)
        self.put([])

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def rows_of(spark, df, tmp_path, name="out"):
    with sinks.keyed_state(spark):
        sinks.run_for(sinks.write_files(df, str(tmp_path / name), str(tmp_path / f"{name}-state"), every=None))
    return [tuple(r) for r in spark.read.schema(df.schema).parquet(str(tmp_path / name)).collect()]


def test_last_reading_in_event_time_order(spark, tmp_path):
    left = Feed(spark, tmp_path, "k int, ts timestamp, x double", "left")
    right = Feed(spark, tmp_path, "ts timestamp, r double", "right")
    joined = lambda: stateful.with_last_reading(left.stream(), right.stream(), "ts", "r", shards=3)
    right.put([(at(5), 1.0), (at(5), 3.0), (at(5), 2.0), (at(8), None), (at(2), 0.5)])
    left.put([(1, at(1), 0.1), (2, at(5), None), (3, at(9), 0.3), (3, at(9), 0.3), (4, at(12), 0.4), (9, at(40), 0.0)])
    assert sorted(rows_of(spark, joined(), tmp_path), key=str) == sorted([
        (1, at(1), 0.1, None), (2, at(5), None, 3.0), (3, at(9), 0.3, 3.0), (3, at(9), 0.3, 3.0), (4, at(12), 0.4, 3.0)], key=str)
    # What comes behind the watermark changes nothing; the last reading outlives the run.
    right.put([(at(10), 7.0), (at(36), 8.0)])
    left.put([(5, at(20), 0.5), (6, at(36), 0.6), (7, at(60), 0.7)])
    later = rows_of(spark, joined(), tmp_path)
    assert {(r[0], r[3]) for r in later if r[0] > 4} == {(6, 8.0), (9, 8.0)}


def test_rolling_alert_counts_both_ends(spark, tmp_path):
    rides = Feed(spark, tmp_path, "linea string, ts timestamp, n bigint", "rides")
    air = Feed(spark, tmp_path, "ts timestamp, r double, p double", "air")
    reference = spark.createDataFrame([("A", "valle_am", 1200)], "linea string, franja_horaria string, p90 bigint")
    rides.put([("A", at(0), 5), ("A", at(5), 7), ("A", at(5), 1), ("A", at(5, 1), 20), ("A", at(11), 70), ("A", at(12), 3),
               ("B", at(3), 1), (" ", at(3), 1), ("A", at(30), None), ("A", at(60), 1)])
    air.put([(at(0), 0.2, 9.0), (at(4), 0.3, None), (at(29), None, 11.0)])
    found = stateful.rolling_hybrid_alerts(rides.stream(), "linea", "ts", "n", air.stream(), "ts", "r", "p", reference, shards=2)
    got = {(r[2], r[5], r[6], r[8], r[10], r[11]) for r in rows_of(spark, found, tmp_path)}
    assert got == {
        (at(5), 13, 3, 0.13, 0.3, 9.0), (at(5, 1), 28, 3, 0.28, 0.3, 9.0),
        (at(30), 0, 1, 0.0, 0.3, 11.0)}


def test_windows_close_and_late_rows_are_kept(spark, tmp_path):
    feed = Feed(spark, tmp_path, "z string, ts timestamp, x double", "air")
    out, aside, state = (str(tmp_path / n) for n in ("means", "late", "state"))

    def run():
        found = stateful.means_and_late_rows(feed.stream(), "z", "ts", "x")
        sinks.run_for(sinks.write_with_late(found, out, aside, "tardia", state, every=None))

    feed.put([("A", at(1), 10.0), ("A", at(9), 20.0), ("A", at(12), 1.0), ("B", at(40), 5.0), (" ", at(1), 9.0), ("A", at(2), None)])
    run()
    feed.put([("A", at(3), 99.0), ("A", at(3), 99.0), ("B", at(12), 98.0), ("B", at(31), 7.0), ("B", at(70), 5.0)])
    run()
    means = {(r["z"], r["ventana_inicio"], r["pm25_promedio"], r["lecturas_en_ventana"]) for r in sinks.read_batches(spark, out).collect()}
    assert means == {("A", at(0), 15.0, 2), ("A", at(10), 1.0, 1), ("B", at(40), 5.0, 1), ("B", at(30), 7.0, 1)}
    late = sorted((r["z"], r["momento"], r["pm25_promedio"], r["ventana_inicio"], r["ventana_fin"]) for r in sinks.read_batches(spark, aside).collect())
    assert late == [("A", at(3), 99.0, at(0), at(10))] * 2 + [("B", at(12), 98.0, at(10), at(20))]


def test_arrival_windows_end_without_new_rows(spark, tmp_path):
    feed = Feed(spark, tmp_path, "z string, x double", "air")
    found = stateful.arrival_alerts(feed.stream(), "z", "x", seconds=3, limit=75.0)
    with sinks.keyed_state(spark):
        query = sinks.write_files(found, str(tmp_path / "out"), str(tmp_path / "state"), every="1 second")
    stored = lambda: spark.read.schema(found.schema).parquet(str(tmp_path / "out")).collect()
    try:
        feed.put([("A", 70.0), ("A", 80.0), ("B", 10.0)])
        sinks.wait_until(query, lambda: len(stored()) == 1)
        feed.put([("A", 200.0)])
        sinks.wait_until(query, lambda: len(stored()) == 2)
    finally:
        query.stop()
    rows = sorted(stored(), key=lambda r: r["ventana_inicio"])
    assert [(r["z"], r["pm25_promedio"], r["lecturas_en_ventana"], r["gravedad"]) for r in rows] == [("A", 75.0, 2, "moderada"), ("A", 200.0, 1, "alta")]
    assert all(r["ventana_fin"] - r["ventana_inicio"] == dt.timedelta(seconds=3) for r in rows)
    assert rows[0]["ventana_fin"] <= rows[1]["ventana_inicio"]


def test_waiting_has_an_end(spark, tmp_path):
    feed = Feed(spark, tmp_path, "z string, x double", "air")
    query = sinks.write_files(feed.stream(), str(tmp_path / "out"), str(tmp_path / "state"), every="1 second")
    with pytest.raises(TimeoutError):
        sinks.wait_until(query, lambda: False, seconds=2)
    query.stop()


class _Map(dict):
    """Map state of one key, in memory."""

    getValue, containsKey, updateValue, removeKey = dict.get, dict.__contains__, dict.__setitem__, dict.pop


class _Handle:
    def __init__(self):
        self.timers = []

    def getMapState(self, name, keys, values):
        return _Map()

    def getListState(self, name, schema):
        raise AssertionError("waiting rows in one list are loaded as a whole")

    def getValueState(self, name, schema):
        class Value:
            held = None
            exists = lambda self: self.held is not None
            get = lambda self: self.held

            def update(self, x):
                self.held = x
        return Value()

    def registerTimer(self, at):
        self.timers.append(at)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_waiting_rows_are_handed_on_slot_by_slot(monkeypatch):
    import random

    monkeypatch.setattr(stateful, "GATHERED_ROWS", 70)
    hour, most = 3600 * 1_000_000, []

    class Watched(stateful.LastReading):
        def advance(self, key, due):
            most.append(len(due))
            return super().advance(key, due)

    step, handle = Watched(), _Handle()
    step.init(handle)
    rows = [(h * hour + i * 60_000_000 + 1, stateful.ROW, f"{h}/{i}", None, None) for h in range(20) for i in range(10)]
    rows += [(h * hour + 5 * 60_000_000, stateful.LAST, None, float(h), None) for h in range(0, 20, 2)]
    random.Random(3).shuffle(rows)
    frame = pd.DataFrame(rows, columns=["at", "kind", "name", "a", "b"]).astype({"a": "float64", "b": "float64"})
    list(step.handleInputRows(("k",), iter([frame[:90], frame[90:]]), _Watermark(0)))
    found = []
    for passed in (3 * 3_600_000 + 250_000, 30 * 3_600_000):
        for out in step.handleExpiredTimer(("k",), _Watermark(passed), None):
            found += [(r, None if pd.isna(x) else x) for r, x in out.itertuples(index=False)]
    newest = lambda h, i: h // 2 * 2 if h % 2 or i >= 5 else (h - 2 if h else None)
    assert found == [(f"{h}/{i}", newest(h, i)) for h in range(20) for i in range(10)]
    assert max(most) <= 11 and not step.slots and not step.packs
