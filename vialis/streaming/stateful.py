"""Stream steps with state and timers of their own: rolling sums, the last reading, late rows, windows of arrival time.

They need the RocksDB state store: start them inside ``sinks.keyed_state``.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from vialis import vocabulary as v
from vialis.functions.calendar import day_band
from vialis.functions.measures import air_class_short_window, rounded
from vialis.session import settle, ship_package

SHARDS = 16
MICROS = 1_000_000
LAST, ROW = 0, 1
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
# Rows wait in slots of event time; a slot is what a key's task holds when it hands them on.
SLOT_MICROS = 3600 * MICROS
# Rows of a key that are gathered before they go to the state.
GATHERED_ROWS = 100_000
PENDING = pa.schema([("at", pa.int64()), ("kind", pa.int32()), ("name", pa.string()), ("a", pa.float64()), ("b", pa.float64())])


def _timed(rows: DataFrame, delay: str) -> DataFrame:
    """Rows with a time ``at`` in microseconds. The watermark follows a copy of it, so rows behind it still come in and can be told apart."""
    return rows.withColumn("_mark", F.timestamp_micros("at")).withWatermark("_mark", delay).drop("_mark")


def _micros(moment: str):
    return F.unix_micros(F.col(moment).cast("timestamp"))


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, PENDING) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> list[tuple]:
    with pa.ipc.open_stream(packed) as reader:
        rows = reader.read_all()
    return list(zip(*(c.to_pylist() for c in rows.columns))) if rows.num_rows else []


class InOrder(StatefulProcessor):
    """Keeps rows until the watermark has passed them and hands them on in event-time order.

    Rows that come in behind the watermark are dropped. Waiting rows lie in the state by slot of event time, packed, and are
    handed on slot by slot, so a task holds one slot of a key, however much waits. One timer stands at the oldest row that waits.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot bigint", "packs bigint")
        self.packs = handle.getMapState("packs", "slot bigint, n bigint", "packed binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        gathered, n, oldest = [], 0, None
        for part in rows:
            part = part[part["at"] > passed]
            if part.empty:
                continue
            first = int(part["at"].min())
            oldest = first if oldest is None else min(oldest, first)
            gathered.append(pa.Table.from_pandas(part[PENDING.names], PENDING, preserve_index=False))
            n += len(part)
            if n >= GATHERED_ROWS:
                self._keep(gathered)
                gathered, n = [], 0
        if gathered:
            self._keep(gathered)
        if oldest is not None:
            self._wait(oldest)
        yield from ()

    def _keep(self, tables: list[pa.Table]) -> None:
        """The rows into the state, one more pack for each slot they touch."""
        rows = pa.concat_tables(tables).sort_by("at")
        slots = rows["at"].to_numpy() // SLOT_MICROS
        starts = [0, *(1 + (slots[1:] != slots[:-1]).nonzero()[0]).tolist(), len(slots)]
        for start, end in zip(starts, starts[1:]):
            self._add(int(slots[start]), rows.slice(start, end - start))

    def _add(self, slot: int, rows: pa.Table) -> None:
        n = self.slots.getValue((slot,))[0] if self.slots.containsKey((slot,)) else 0
        self.packs.updateValue((slot, n), (_packed(rows),))
        self.slots.updateValue((slot,), (n + 1,))

    def _wait(self, oldest: int) -> None:
        self.handle.registerTimer(-(-oldest // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        for slot in sorted(k[0] for k in self.slots.keys()):
            if slot * SLOT_MICROS > passed:
                # No row of it is due; its start comes before its oldest row.
                self._wait(slot * SLOT_MICROS)
                return
            packs = self.slots.getValue((slot,))[0]
            rows = [r for n in range(packs) for r in _unpacked(bytes(self.packs.getValue((slot, n))[0]))]
            due, rest = [r for r in rows if r[0] <= passed], [r for r in rows if r[0] > passed]
            del rows
            if due:
                for n in range(packs):
                    self.packs.removeKey((slot, n))
                self.slots.removeKey((slot,))
                if rest:
                    self._add(slot, pa.table([list(c) for c in zip(*rest)], schema=PENDING))
                # At one instant readings come before rows, the largest reading last.
                due.sort(key=lambda r: (r[0], r[1], r[2] or "", float("-inf") if r[3] is None else r[3]))
                out = self.advance(key, due)
                if len(out):
                    yield out
            if rest:
                self._wait(min(r[0] for r in rest))
                return

    def advance(self, key, due: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


class LastReading(InOrder):
    """The newest reading that was there at each row: both values of it, each as last known."""

    def init(self, handle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "a double, b double")

    def known(self) -> tuple[float | None, float | None]:
        return tuple(self.last.get()) if self.last.exists() else (None, None)

    def readings(self, due: list[tuple]) -> Iterator[tuple[int, str, float | None, tuple]]:
        """The rows among ``due``, each with the readings known at its time."""
        a, b = self.known()
        instant = None
        for t, kind, name, x, y in due:
            if kind == LAST:
                # Several readings at one instant: the largest value stands for it.
                same = instant is not None and instant[0] == t
                best = lambda old, new: new if old is None else old if new is None else max(old, new)
                instant = (t, best(instant[1], x), best(instant[2], y)) if same else (t, x, y)
                a = instant[1] if instant[1] is not None else a
                b = instant[2] if instant[2] is not None else b
            else:
                yield t, name, x, (a, b)
        self.last.update((a, b))

    def advance(self, key, due: list[tuple]) -> pd.DataFrame:
        found = [(name, a) for _, name, _, (a, _) in self.readings(due)]
        return pd.DataFrame(found, columns=["row", "value"]).astype({"value": "float64"})


class RollingWithLast(LastReading):
    """Sum and count of each line's last ``seconds`` at each instant it has rows, both ends counted, with the newest readings."""

    def __init__(self, seconds: int):
        self.reach = seconds * MICROS

    def init(self, handle) -> None:
        super().init(handle)
        self.recent = handle.getListState("recent", "t bigint, name string, v double")

    def advance(self, key, due: list[tuple]) -> pd.DataFrame:
        held = defaultdict(deque)
        total = defaultdict(float)
        for t, name, x in (self.recent.get() if self.recent.exists() else ()):
            held[name].append((t, x))
            total[name] += x
        found: dict[tuple[str, int], tuple] = {}
        for t, name, x, known in self.readings(due):
            line = held[name]
            line.append((t, x or 0.0))
            total[name] += x or 0.0
            while line[0][0] < t - self.reach:
                total[name] -= line.popleft()[1]
            # The last row of an instant has all of it.
            found[name, t] = (total[name], len(line), *known)
        newest = due[-1][0]
        rest = [(t, name, x) for name, line in held.items() for t, x in line if t >= newest - self.reach]
        self.recent.put(rest) if rest else self.recent.clear()
        rows = [(name, t, *values) for (name, t), values in found.items()]
        kinds = {"suma": "float64", "a": "float64", "b": "float64"}
        return pd.DataFrame(rows, columns=["name", "at", "suma", "cuenta", "a", "b"]).astype(kinds)


def _shared(rows: DataFrame, readings: DataFrame, delay: str, shards: int) -> DataFrame:
    """Rows and readings keyed by shard. A row goes to the shard of its name; every shard gets all readings, as shared state.

    Readings are far fewer than rows, so sending them to all of a fixed number of shards costs little.
    """
    mine = rows.withColumns({"shard": F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int"), "kind": F.lit(ROW), "b": F.lit(None).cast("double")})
    theirs = readings.withColumns({
        "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), "kind": F.lit(LAST), "name": F.lit(None).cast("string")})
    return _timed(mine.unionByName(theirs), delay).groupBy("shard")


def with_last_reading(
    left: DataFrame, right: DataFrame, moment: str, value: str, delay: str = "5 minutes", shards: int = SHARDS,
) -> DataFrame:
    """Stream form of ``windows.latest_before``: left rows with the newest non-null right ``value`` at or before their ``moment``.

    Both sides are met in event-time order once the watermark has passed; rows that come behind it are dropped. The left
    rows are spread over ``shards``, each of which keeps the last reading.
    """
    ship_package(left.sparkSession)
    rows = left.select(F.to_json(F.struct("*"), EXACT_TIMES).alias("name"), _micros(moment).alias("at"), F.lit(None).cast("double").alias("a"))
    readings = right.filter(F.col(value).isNotNull()).select(
        _micros(moment).alias("at"), F.col(value).cast("double").alias("a"), F.lit(None).cast("double").alias("b"))
    met = _shared(rows, readings, delay, shards).transformWithStateInPandas(LastReading(), "row string, value double", "Append", "EventTime")
    return met.select(F.from_json("row", left.schema, EXACT_TIMES).alias("row"), "value").select(
        "row.*", F.col("value").cast(right.schema[value].dataType).alias(value))


def rolling_hybrid_alerts(
    ridership: DataFrame, line: str, ridership_moment: str, passengers: str,
    weather: DataFrame, weather_moment: str, rain: str, pm25: str,
    reference: DataFrame, percentile: str = "p90", minutes: int = 5, delay: str = "5 minutes",
    rain_limit: float = v.RAIN_LIMIT_MM, factor: float = v.RIDERSHIP_FACTOR, shards: int = SHARDS,
) -> DataFrame:
    """The hybrid alert at every ridership event: the line's last ``minutes`` against the newest rain reading and the reference.

    Lines are spread over ``shards`` by name; each shard keeps the last
    minutes of its lines and the last readings. Band and alert window follow the event time; the window is named by its
    minute, as ``sinks.write_once`` wants it for one alert per line and minute.
    """
    ship_package(ridership.sparkSession)
    named = ridership.filter(F.trim(F.col(line).cast("string")) != "")
    rows = named.select(F.col(line).cast("string").alias("name"), _micros(ridership_moment).alias("at"), F.col(passengers).cast("double").alias("a"))
    readings = weather.select(_micros(weather_moment).alias("at"), F.col(rain).cast("double").alias("a"), F.col(pm25).cast("double").alias("b"))
    rolled = _shared(rows, readings, delay, shards).transformWithStateInPandas(
        RollingWithLast(minutes * 60), "name string, at bigint, suma double, cuenta bigint, a double, b double", "Append", "EventTime")
    stats = settle(reference.select(
        F.col("linea").alias("name"), F.col("franja_horaria"), (F.col(percentile) * (minutes / 60)).alias("_expected"),
    ).filter(F.col("_expected") > 0))
    at = F.timestamp_micros("at")
    wet = rolled.filter(F.col("a") >= rain_limit).withColumns({"momento": at, "franja_horaria": day_band(F.hour(at))})
    ratio = F.col("suma") / F.col("_expected")
    start = F.date_trunc("minute", "momento")
    return wet.join(stats, ["name", "franja_horaria"]).filter(ratio < factor).select(
        F.col("name").alias("linea"), "franja_horaria", "momento", start.alias("ventana_inicio"),
        (start + F.make_dt_interval(mins=F.lit(minutes))).alias("ventana_fin"),
        F.col("suma").cast("bigint").alias("afluencia_5min_actual"), F.col("cuenta").alias("eventos_en_ventana"),
        F.col("_expected").cast("bigint").alias("afluencia_5min_referencia"), rounded(ratio, 3).alias("ratio_vs_referencia"),
        F.lit(percentile).alias("percentil_referencia"), F.col("a").alias("lluvia_mm"), F.col("b").alias("pm25_red"),
        F.lit(v.HYBRID_ALERT).alias("tipo"), F.lit(v.HYBRID_HYPOTHESIS).alias("hipotesis"), F.lit(factor).alias("factor_umbral"))


class WindowOrLate(StatefulProcessor):
    """One window of one zone: its mean once the watermark has passed its end, and the rows that come after that."""

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "suma double, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = key[2]
        closed = end <= timerValues.getCurrentWatermarkInMs() * 1000
        total, n = self.sums.get() if self.sums.exists() else (0.0, 0)
        for part in rows:
            if closed:
                late = part[["at", "value"]].reset_index(drop=True)
                yield pd.DataFrame({
                    "zone": key[0], "start": key[1], "end": end, "late": True, "at": late["at"], "value": late["value"], "n": 1})
            else:
                total, n = total + float(part["value"].sum()), n + len(part)
        if not closed:
            self.sums.update((total, n))
            self.handle.registerTimer(-(-end // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, n = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame({"zone": [key[0]], "start": [key[1]], "end": [key[2]], "late": [False], "at": [key[1]], "value": [total / n], "n": [n]})

    def close(self) -> None:
        pass


def means_and_late_rows(readings: DataFrame, zone: str, moment: str, value: str, minutes: int = 10, delay: str = "10 minutes") -> DataFrame:
    """Mean and count per zone and window when it closes, and every reading that came after its window had closed.

    A late reading has ``tardia`` true, its own time and value, and the window it belongs to. State is keyed by zone and window,
    so a busy zone's open windows are separate keys. Zones without a name and missing values are left out.
    """
    ship_package(readings.sparkSession)
    size = minutes * 60 * MICROS
    rows = readings.filter(F.col(value).isNotNull() & (F.trim(F.col(zone).cast("string")) != "")).select(
        F.col(zone).cast("string").alias("zone"), _micros(moment).alias("at"), F.col(value).cast("double").alias("value"))
    start = F.col("at") - F.pmod(F.col("at"), F.lit(size))
    placed = _timed(rows.withColumns({"start": start, "end": start + size}), delay)
    found = placed.groupBy("zone", "start", "end").transformWithStateInPandas(
        WindowOrLate(), "zone string, start bigint, end bigint, late boolean, at bigint, value double, n bigint", "Append", "EventTime")
    return found.select(
        F.timestamp_micros("start").alias("ventana_inicio"), F.timestamp_micros("end").alias("ventana_fin"), F.col("zone").alias(zone),
        F.timestamp_micros("at").alias("momento"), F.col("value").alias("pm25_promedio"), F.col("n").alias("lecturas_en_ventana"),
        F.col("late").alias("tardia"))


class ArrivalWindow(StatefulProcessor):
    """Sums of a zone in the current window of arrival time; a timer ends the window."""

    def __init__(self, millis: int):
        self.millis = millis

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "start bigint, suma double, n bigint")

    def _ended(self, key) -> Iterator[pd.DataFrame]:
        start, total, n = self.sums.get()
        self.sums.clear()
        yield pd.DataFrame({"zone": [key[0]], "start": [start], "mean": [total / n], "n": [n]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        start = now - now % self.millis
        if self.sums.exists() and self.sums.get()[0] != start:
            yield from self._ended(key)
        total, n = self.sums.get()[1:] if self.sums.exists() else (0.0, 0)
        for part in rows:
            total, n = total + float(part["value"].sum()), n + len(part)
        self.sums.update((start, total, n))
        self.handle.registerTimer(start + self.millis)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists() and self.sums.get()[0] + self.millis <= timerValues.getCurrentProcessingTimeInMs():
            yield from self._ended(key)

    def close(self) -> None:
        pass


def arrival_means(readings: DataFrame, zone: str, value: str, seconds: int = 60) -> DataFrame:
    """Mean and count per zone and window of arrival time, each emitted when a trigger comes after the window's end."""
    ship_package(readings.sparkSession)
    rows = readings.filter(F.col(value).isNotNull() & (F.trim(F.col(zone).cast("string")) != "")).select(
        F.col(zone).cast("string").alias("zone"), F.col(value).cast("double").alias("value"))
    found = rows.groupBy("zone").transformWithStateInPandas(
        ArrivalWindow(seconds * 1000), "zone string, start bigint, mean double, n bigint", "Append", "ProcessingTime")
    start = F.timestamp_millis("start")
    return found.select(
        start.alias("ventana_inicio"), (start + F.make_dt_interval(secs=F.lit(seconds))).alias("ventana_fin"), F.col("zone").alias(zone),
        F.col("mean").alias("pm25_promedio"), F.col("n").alias("lecturas_en_ventana"))


def arrival_alerts(readings: DataFrame, zone: str, value: str, seconds: int = 60, limit: float = v.PM25_LIMIT) -> DataFrame:
    """The one-minute variant of the air alert over arrival time: means at or above the limit."""
    mean = F.col("pm25_promedio")
    high = arrival_means(readings, zone, value, seconds).filter(mean >= limit)
    return high.withColumns({
        "gravedad": air_class_short_window(mean), "pm25_promedio": rounded(mean, 2), "tipo": F.lit(v.AIR_ALERT),
        "umbral": F.lit(float(limit))})
