import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from vialis.functions import calendar, geo, measures, messages, privacy, text


def test_day_bands(one):
    hours = [4, 5, 8, 9, 12, 14, 17, 20, 21, None]
    assert one(hours, "int", lambda X: calendar.day_band(X)) == [
        "nocturno", "punta_am", "punta_am", "valle_am", "almuerzo", "valle_pm", "punta_pm", "punta_pm", "nocturno", "nocturno"]


def test_days_in_every_format(one):
    texts = ["03.02.2024", "2024-02-03", "03/02/2024", "99.99.2024", "mañana", None]
    assert one(texts, "string", lambda X: calendar.parse_day(X)) == [dt.date(2024, 2, 3)] * 3 + [None] * 3


def test_legacy_moments(one):
    texts = ["31/12/2016 23:59:00", "2017-01-01T10:00:00.000Z", "x", "", "2017-01-01"]
    assert one(texts, "string", lambda X: calendar.canonical_moment(calendar.parse_legacy_moment(X))) == [
        "2016-12-31 23:59:00", "2017-01-01 10:00:00", None, None, None]


def test_floors(one):
    at = [dt.datetime(2024, 1, 1, 10, 17, 48)]
    assert one(at, "timestamp", lambda X: calendar.floor_minutes(X, 10)) == [dt.datetime(2024, 1, 1, 10, 10)]
    assert one(at, "timestamp", lambda X: calendar.floor_seconds(X, 30)) == [dt.datetime(2024, 1, 1, 10, 17, 30)]
    with pytest.raises(ValueError):
        calendar.floor_minutes(None, 7)


def test_lookback(one):
    now = dt.datetime(2024, 1, 8)
    ages = {"10min": dt.timedelta(minutes=10), "1h": dt.timedelta(hours=1), "7D": dt.timedelta(days=7)}
    for literal, age in ages.items():
        moments = [now - age, now - age - dt.timedelta(seconds=1)]
        assert one(moments, "timestamp", lambda X: calendar.within_last(X, F.lit(now), literal)) == [True, False]
    for wrong in ("10", "h", "3 weeks", "10m"):
        with pytest.raises(ValueError):
            calendar.lookback(wrong)


def test_event_time_falls_back(one):
    arrived = dt.datetime(2024, 5, 5)
    assert one(["2024-01-01T00:00:05", "ayer", None], "string", lambda X: calendar.event_time(X, F.lit(arrived))) == [
        dt.datetime(2024, 1, 1, 0, 0, 5), arrived, arrived]


def test_plain_names(spark):
    assert text.plain_name("DISEÑO Vía/No.") == "diseno_via_no_"
    with pytest.raises(ValueError, match="same name"):
        text.plain_columns(spark.createDataFrame([(1, 2)], "`Año` int, `ano` int"))


def test_corridors(one):
    streets = [" cl 10 # 3", "CARRERA80", "Autopista Sur", "Diagonal Oriental", "parque oriental", "vereda", None]
    assert one(streets, "string", lambda X: text.corridor_of(X)) == [
        "Cl 10", "Carrera 80", "Autopista", "Diagonal ORIENTAL", "Avenida Oriental", None, None]


def test_known_areas(one):
    assert one(["Popular", " sd ", "No_Definido", "null", "", None], "string", lambda X: text.is_known_area(X)) == [
        True, False, False, False, False, False]


def test_boundaries_and_networks(spark):
    rows = [("Comuna 1 - A", "8"), ("comuna x", "8"), ("Altavista", "7"), ("Comuna 2", "7"), ("Altavista", "9"), (None, "8")]
    frame = spark.createDataFrame(rows, "n string, l string")
    kept = frame.select(text.is_official_boundary(F.col("n"), F.col("l"))).collect()
    assert [r[0] for r in kept] == [True, False, True, False, False, False]
    rows = [("Bici Norte", "RED BICI"), ("Bici Sur", "otra"), ("Bici Este", None), ("Parque", ""), (" ", "RED BICI"), (None, None)]
    frame = spark.createDataFrame(rows, "n string, r string")
    kept = frame.select(text.belongs_to_network(F.col("n"), F.col("r"), "bici")).collect()
    assert [r[0] for r in kept] == [True, False, True, False, False, False]


def test_zones(one):
    towns = ["Bello", "Envigado", "Medellín", "Otro", None]
    centre = "valle_aburra_centro"
    assert one(towns, "string", lambda X: text.zone_of(X)) == ["valle_aburra_norte", "valle_aburra_sur", centre, centre, centre]


def test_coordinates(one):
    pairs = ["[6.24, -75.57]", "[-75.57, 6.24]", "[0,0]", None, "[a, b]", "[1]"]
    fixed = lambda X: geo.repair_swapped(geo.pair_from_brackets(X))
    assert [tuple(p) for p in one(pairs, "string", fixed)] == [
        (-75.57, 6.24), (-75.57, 6.24), (0.0, 0.0), (None, None), (None, None), (1.0, None)]
    assert tuple(one(["{'lon': '-75.5','lat':'6.2'}"], "string", lambda X: geo.pair_from_dict_text(X))[0]) == (-75.5, 6.2)
    assert tuple(one(["-75.5|6.2"], "string", lambda X: geo.pair_from_pipe(X))[0]) == (-75.5, 6.2)
    assert one(["[-75.5, 6.2]"], "string", lambda X: geo.pipe_text(X)) == ["-75.5|6.2"]


def test_holes_and_multipolygons(one):
    ring = "[[0,0],[4,0],[4,4],[0,4],[0,0]]"
    hole = "[[1,1],[3,1],[3,3],[1,3],[1,1]]"
    far = "[[10,0],[11,0],[11,4],[10,4],[10,0]]"
    polygon = f'{{"type":"Polygon","coordinates":[{ring},{hole}]}}'
    multi = f'{{"type":"MultiPolygon","coordinates":[[{ring}],[{far}]]}}'
    inside = lambda lon, holes: lambda X: geo.is_inside(F.lit(lon), F.lit(2.0), geo.edges_of(geo.rings_of(X, holes)))
    assert one([polygon, multi], "string", inside(2.0, False)) == [True, True]
    assert one([polygon, multi], "string", inside(2.0, True)) == [False, True]
    assert one([polygon, multi], "string", inside(10.5, False)) == [False, True]


def test_pseudonym(one):
    for key in ("secreto", "k" * 100):
        expected = [hmac.new(key.encode(), n.encode(), hashlib.sha256).hexdigest() for n in ("ana", "ñandú")]
        assert one(["ana", "ñandú", None], "string", lambda X: privacy.pseudonym(X, key)) == expected + [None]
    for missing in ("", "cambia-esta-clave-ya"):
        with pytest.raises(ValueError):
            privacy.pseudonym(None, missing)


def test_bins_and_flags(one):
    assert one([20.3, -0.5, None], "double", lambda X: measures.bin_label(X, 4)) == ["20-24", "-4-0", "sin_dato"]
    assert one([15.0], "double", lambda X: measures.bin_label(X, 15)) == ["15-30"]
    assert one([1.1, 1.0, None], "double", lambda X: measures.rain_flag(X)) == [1, 0, 0]
    minutes = [0.5, 9.0, 10.0, 29.0, 30.0, 241.0]
    assert one(minutes, "double", lambda X: measures.trip_class(X)) == ["corta", "corta", "media", "media", "larga", "larga"]
    assert one(minutes, "double", lambda X: measures.is_plausible_trip(X)) == [False, True, True, True, True, False]
    assert one([74.9, 75.0, 149.9, 150.0], "double", lambda X: measures.air_class(X)) == ["leve", "moderada", "moderada", "critica"]
    assert one([75.0, 100.0], "double", lambda X: measures.air_class_short_window(X)) == ["moderada", "alta"]
    assert one([-999.0, 21.0, None], "double", lambda X: measures.without_sentinel(X)) == [None, 21.0, None]


def test_texts_as_numbers(one):
    assert one([" 1.5 ", "", "n/d", None], "string", lambda X: measures.number_or_null(X)) == [1.5, None, None, None]
    assert one([" 7 ", "", "n/d", None], "string", lambda X: measures.whole_or_zero(X)) == [7, 0, 0, 0]
    assert one([0.125, 12.344999999999999], "double", lambda X: measures.rounded(X, 2)) == [0.13, 12.35]


def test_correlation(spark):
    frame = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0), ("a", None, 9.0), ("b", 5.0, 1.0), ("c", 1.0, 1.0), ("c", 1.0, 2.0)],
        "k string, x double, y double")
    found = {r["k"]: r["c"] for r in frame.groupBy("k").agg(measures.correlation(F.col("x"), F.col("y")).alias("c")).collect()}
    assert found["a"] == pytest.approx(1.0) and found["b"] is None and found["c"] is None


def test_messages(spark):
    rows = [('{"linea": "A", "pasajeros_periodo": "3"}',), ("no json",), ('{"linea": " "}',)]
    typed = messages.decode(spark.createDataFrame(rows, "value string"), messages.LINE_SCHEMA, key="linea")
    assert [(r["linea"], r["pasajeros_periodo"]) for r in typed.collect()] == [("A", "3")]


def test_field_count(one):
    lines = ['a,b,c', '"a,b",c', '"a ""x"", b",c,', ""]
    assert one(lines, "string", lambda X: messages.field_count(X)) == [3, 2, 3, 1]
