import datetime as dt
import json
import math
import random
import statistics

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.operators import classify, graph, quality, ranking, reports, reshape, rings, rollups, spatial, windows
from vialis.plans import transit


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_positions(spark):
    shuffled = random.Random(1).sample(range(500), 500)
    data = [(k, "g1" if k % 3 else ("g2" if k % 2 else None), k // 7) for k in shuffled]
    frame = spark.createDataFrame(data, "k int, g string, score int")
    order = [F.desc("score"), F.asc("k")]
    found = ranking.running_total(frame, ["g"], order, alias="n")
    expected = {}
    for group in ("g1", "g2", None):
        members = sorted((d for d in data if d[1] == group), key=lambda d: (-d[2], d[0]))
        expected.update({d[0]: i for i, d in enumerate(members, 1)})
    assert {r["k"]: r["n"] for r in found.collect()} == expected
    overall = ranking.running_total(frame, [], order, F.col("score"), "total")
    total, sums = 0, {}
    for d in sorted(data, key=lambda d: (-d[2], d[0])):
        total += d[2]
        sums[d[0]] = total
    assert {r["k"]: r["total"] for r in overall.collect()} == sums


def test_an_unreadable_value_never_beats_a_readable_one(spark):
    frame = spark.createDataFrame([(1, None, "bad"), (1, 5, "good"), (2, None, "only"), (None, None, "x"), (None, None, "x")], "id int, t int, w string")
    for last in (False, True):
        found = quality.one_per_key(frame, ["id"], [F.col("t")], last=last)
        assert sorted((r["id"] or 0, r["w"]) for r in found.collect()) == [(0, "x"), (0, "x"), (1, "good"), (2, "only")]


def test_one_per_key_keeps_unknown_keys(spark):
    data = [(1, 5, "b"), (1, 4, "a"), (1, 4, "c"), (None, 1, "x"), (None, 1, "x")]
    frame = spark.createDataFrame(data, "id int, t int, z string")
    first = quality.one_per_key(frame, ["id"], [F.col("t")])
    assert sorted(rows(first), key=str) == sorted([(1, 4, "a"), (None, 1, "x"), (None, 1, "x")], key=str)
    assert rows(quality.latest_per_entity(frame.filter("id = 1"), ["id"], "t")) == [(1, 5, "b")]


def test_required_and_absent_columns(spark):
    frame = spark.range(1)
    with pytest.raises(ValueError, match="hora"):
        quality.require_columns(frame, ["id", "hora"])
    assert quality.fill_absent(frame, {"id": "int", "zona": "string"}).columns == ["id", "zona"]


def test_sentinel_goes_before_the_average(spark):
    frame = spark.createDataFrame([("t", "s", "pm25", -999.0), ("t", "s", "pm25", 21.0)], "ts string, st string, v string, x double")
    wide = rollups.long_to_wide(quality.clear_sentinels(frame, ["x"]), ["ts", "st"], "v", ["pm25", "pm10"], "x")
    assert rows(wide) == [("t", "s", 21.0, None)]


def test_severity_table(spark):
    data = [(2020, "a", "Solo daños")] * 10 + [(2020, "a", "Con heridos")] * 3 + [(2020, "a", "Con muertos"), (2020, "b", "Otro")]
    frame = spark.createDataFrame(data, "anio int, comuna string, gravedad string")
    table = rollups.rank_severity(rollups.severity_table(frame, ["anio", "comuna"], "gravedad"), "anio", "comuna")
    found = {r["comuna"]: r for r in table.collect()}
    assert found["a"]["indice_severidad"] == pytest.approx(9.0) and found["a"]["incidentes_total"] == 14
    assert (found["a"]["ranking_severidad"], found["b"]["ranking_severidad"]) == (1, 2)
    assert found["b"]["incidentes_total"] == 0


def test_percentiles_are_exact_where_neighbouring_ranks_differ(spark):
    n = 120_000
    frame = spark.range(n).select(F.lit("l").alias("k"), (F.col("id") * 7_919 % n + 1).alias("x"))
    frame = frame.unionByName(spark.range(20).select(F.lit(None).cast("string").alias("k"), (F.col("id") + 1).alias("x")))
    found = {r["k"]: tuple(r)[1:] for r in rollups.percentiles(frame, ["k"], "x").collect()}
    assert found == {"l": (60_000, 90_000, 108_000, 114_000, n), None: (10, 15, 18, 19, 20)}


@pytest.mark.parametrize("size", [9, 10, 11, 15, 19, 20, 100, 137])
def test_exclusive_percentiles(spark, size):
    values = [random.Random(size).randint(1, 60) for _ in range(size)]
    frame = spark.createDataFrame([("l", x) for x in values], "k string, x bigint")
    found = rows(rollups.exclusive_percentiles(frame, ["k"], "x"))
    if size < 10:
        assert found == []
        return
    q = statistics.quantiles(values, n=20)
    assert found == [("l", int(statistics.median(values)), int(q[14]), int(q[17]), int(q[18]), size)]


def test_exclusive_percentiles_of_one_to_hundred(spark):
    frame = spark.range(1, 101).select(F.lit("l").alias("k"), F.col("id").alias("x"))
    assert rows(rollups.exclusive_percentiles(frame, ["k"], "x")) == [("l", 50, 75, 90, 95, 100)]


def test_rolling_sum_across_slices(spark):
    start = dt.datetime(2024, 1, 1)
    offsets = [0, 299, 300, 301, 3599, 3600, 3700, 3899, 3900, 3900]
    frame = spark.createDataFrame([("l", start + dt.timedelta(seconds=s), 1 + i) for i, s in enumerate(offsets)], "l string, t timestamp, x int")
    found = {r["t"]: (r["suma"], r["cuenta"]) for r in windows.rolling_sum(frame, "l", "t", "x", slice_seconds=600).collect()}
    for s in set(offsets):
        inside = [1 + i for i, o in enumerate(offsets) if s - 300 <= o <= s]
        assert found[start + dt.timedelta(seconds=s)] == (sum(inside), len(inside))


def test_latest_before(spark):
    start = dt.datetime(2024, 1, 1)
    at = lambda m: start + dt.timedelta(minutes=m)
    left = spark.createDataFrame([(i, at(m)) for i, m in enumerate([0, 5, 59, 200, 4000])], "i int, t timestamp")
    right = spark.createDataFrame([(at(5), 1.0), (at(58), 2.0), (at(130), None), (at(199), 3.0)], "t timestamp, x double")
    assert [r["x"] for r in windows.latest_before(left, right, "t", "x").orderBy("i").collect()] == [None, 1.0, 2.0, 3.0, 3.0]


@pytest.mark.parametrize("by", [(), ("k",)])
def test_latest_before_against_a_search(spark, by):
    """Busy instants, equal times on both sides, empty groups, nulls; no window over all rows."""
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(minutes=rng.choice([0, 3, 3, 3, rng.randint(0, 9000)]))
    lefts = [(i, rng.choice("abcx"), at()) for i in range(400)] + [(400, None, at()), (401, "a", None)]
    rights = [(rng.choice("abc"), at(), rng.choice([None, rng.random()])) for _ in range(300)]
    left = spark.createDataFrame(lefts, "i int, k string, t timestamp").repartition(5)
    right = spark.createDataFrame(rights, "k string, t timestamp, x double").repartition(3)
    found = windows.latest_before(left, right, "t", "x", by)
    want = {}
    for i, k, t in lefts:
        fitting = [(u, x) for r, u, x in rights if x is not None and t is not None and u <= t and (not by or r == k)]
        want[i] = max(fitting)[1] if fitting else None
    assert {r["i"]: r["x"] for r in found.collect()} == want
    assert found.columns == ["i", "k", "t", "x"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "_slice" in plan.split("Window [")[1].split("\n")[0]


SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1],[0,0]]]}'
BESIDE = '{"type":"Polygon","coordinates":[[[0.5,0],[2,0],[2,1],[0.5,1],[0.5,0]]]}'


def test_first_polygon_wins(spark):
    polygons = spark.createDataFrame([(2, "segundo", BESIDE), (1, "primero", SQUARE), (3, "roto", "{}")], "o int, n string, g string")
    points = spark.createDataFrame([(0, 0.25, 0.5), (1, 0.75, 0.5), (2, 1.5, 0.5), (3, 3.0, 0.5), (4, None, 0.5), (5, 0.25, 0.5)], "i int, x double, y double")
    found = spatial.assign_area(points, polygons, "x", "y", "n", "g", "o", cell=0.3)
    assert [r["area"] for r in found.orderBy("i").collect()] == ["primero", "primero", "segundo", None, None, "primero"]


def test_equal_places_come_by_name_and_missing_ones_last(spark):
    points = spark.createDataFrame([(0, 0.75, 0.5)], "i int, x double, y double")
    area = lambda rows: spatial.assign_area(
        points, spark.createDataFrame(rows, "o int, n string, g string"), "x", "y", "n", "g", "o", cell=0.3).first()["area"]
    assert area([(1, "b", SQUARE), (1, "a", BESIDE)]) == "a"
    assert area([(None, "a", SQUARE), (7, "b", BESIDE)]) == "b"
    assert area([(None, "b", SQUARE), (None, "a", BESIDE)]) == "a"


def test_spatial_join_against_brute_force(spark):
    rng = random.Random(7)
    shapes = []
    for n in range(12):
        x, y = rng.uniform(0, 5), rng.uniform(0, 5)
        ring = [(x + rng.uniform(-2, 2), y + rng.uniform(-2, 2)) for _ in range(6)]
        shapes.append((n, f"p{n}", ring))
    text = lambda ring: '{"type":"Polygon","coordinates":[[' + ",".join(f"[{a},{b}]" for a, b in ring + ring[:1]) + "]]}"
    polygons = spark.createDataFrame([(n, name, text(r)) for n, name, r in shapes], "o int, n string, g string")
    spots = [(i, rng.uniform(-2, 7), rng.uniform(-2, 7)) for i in range(300)]

    def inside(px, py, ring):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax:
                odd = not odd
        return odd

    expected = {i: next((name for _, name, r in shapes if inside(px, py, r)), None) for i, px, py in spots}
    points = spark.createDataFrame(spots, "i int, x double, y double")
    for cell, leaf in ((0.7, 64), (0.11, 1), (0.02, 2)):
        found = spatial.assign_area(points, polygons, "x", "y", "n", "g", "o", cell=cell, leaf=leaf)
        assert {r["i"]: r["area"] for r in found.collect()} == expected


def _even_odd(px, py, ring):
    odd = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > py) != (by > py):
            run, rise = (px - ax) * (by - ay), (bx - ax) * (py - ay)
            odd ^= run < rise if by > ay else run > rise
    return odd


def test_cells_decide_like_the_whole_polygon_on_corners_and_sides(spark):
    """Whole numbers: points, corners, cell sides and edges fall together wherever they can."""
    rng = random.Random(9)
    shapes = [(n, f"p{n}", [(rng.randint(-6, 10), rng.randint(-6, 10)) for _ in range(rng.randint(3, 9))]) for n in range(25)]
    text = lambda ring: '{"type":"Polygon","coordinates":[[' + ",".join(f"[{a},{b}]" for a, b in ring + ring[:1]) + "]]}"
    points = spark.createDataFrame([(x * 100 + y, float(x), float(y)) for x in range(-8, 13) for y in range(-8, 13)], "i int, x double, y double")
    for n, name, ring in shapes:
        polygon = spark.createDataFrame([(n, name, text(ring))], "o int, n string, g string")
        found = spatial.assign_area(points, polygon, "x", "y", "n", "g", "o", cell=1.0, leaf=n % 3)
        got = {r["i"] for r in found.collect() if r["area"] is not None}
        assert got == {x * 100 + y for x in range(-8, 13) for y in range(-8, 13) if _even_odd(x, y, ring)}, ring
        if n == 4:
            break


def test_a_large_polygon_spreads_over_tasks(spark):
    edges = 100_000
    turn = [2 * math.pi * k / edges for k in range(edges)]
    ring = [((5 + 0.8 * math.sin(40 * t)) * math.cos(t), (5 + 0.8 * math.sin(40 * t)) * math.sin(t)) for t in turn]
    shape = spark.createDataFrame([(1, "a", '{"type":"Polygon","coordinates":[[' + ",".join(f"[{x},{y}]" for x, y in ring) + "]]}")], "o int, n string, g string")
    index = spatial.area_index(shape, "n", "g", "o")
    sizes = index.select(F.size("_edges").alias("n"), "_level").collect()
    assert max(r["n"] for r in sizes if r["_level"] > 0) <= spatial.LEAF_EDGES
    assert edges <= sum(r["n"] for r in sizes) < 2 * edges and len(sizes) < 20_000
    tasks = index.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.sum(F.size("_edges")).alias("n")).collect()
    assert len(tasks) >= 4 and max(r["n"] for r in tasks) < 0.5 * edges
    rng = random.Random(3)
    spots = [(i, rng.uniform(-6.5, 6.5), rng.uniform(-6.5, 6.5)) for i in range(2000)]
    found = spatial.assign_area(spark.createDataFrame(spots, "i int, x double, y double"), shape, "x", "y", "n", "g", "o")
    inside = lambda x, y: math.hypot(x, y) < 5 + 0.8 * math.sin(40 * math.atan2(y, x))
    assert {r["i"] for r in found.collect() if r["area"]} == {i for i, x, y in spots if inside(x, y)}


def test_lines_not_listed_are_counted_together(spark):
    frame = spark.createDataFrame([(1, "A", 5), (1, "B", 7), (1, "C", 1), (1, None, 2), (2, "A", 3)], "ventana_inicio int, linea string, n bigint")
    assert rows(reports.series_by_line(frame, ["A", "Z"], "linea", "n").orderBy("ventana_inicio")) == [(1, 5, 0, 10), (2, 3, 0, 0)]


def test_hours_to_rows(spark):
    frame = spark.createDataFrame(
        [("01.01.2024", " L1 ", "180", None, "x", "-3", "999"), ("nunca", "L1", "1", "1", "1", "1", "9"), ("2024-01-02", "", "1", "1", "1", "1", "9")],
        "dia string, linea string, h4 string, h5 string, h6 string, h7 string, total string")
    found = reshape.hours_to_rows(frame, "dia", "linea", {"h4": 4, "h5": 5, "h6": 6, "h7": 7})
    assert rows(found) == [(dt.date(2024, 1, 1), "L1", 4, 180)]


def test_totals_spread_evenly(spark):
    frame = spark.createDataFrame([(dt.date(2024, 1, 1), 7, "A", 100), (dt.date(2024, 1, 1), 8, "A", 0)], "d date, h int, l string, p bigint")
    found = reshape.spread_evenly(frame, "d", "h", "l", "p").orderBy("timestamp").collect()
    assert len(found) == 12 and sum(r["pasajeros_periodo"] for r in found) == 100
    assert [r["timestamp"].minute for r in found] == list(range(0, 60, 5))


LEGACY = [
    '7,01/02/2016 10:00:00,Choque,Solo daños,Centro,"CL 1, piso 2",-75.5|6.2',
    '7,2016-02-01T10:00:00.000Z,Choque,Solo daños,Centro,La Candelaria,"CL ""1""","[-75.5, 6.2]"',
    '8,2018-02-01T10:00:00.000Z,B,Con heridos,Centro,X,dir,"[-75.5, 6.2]"',
    '8,2018-02-01T10:00:00.000Z,A,Con heridos,Centro,X,dir,sin coma',
    ',01/02/2016 10:00:00,c,g,b,d,1|2', '9,ayer,c,g,b,d,1|2', 'a,b', '   ',
]


def test_legacy_normaliser(spark):
    lines = spark.createDataFrame([(line,) for line in LEGACY], "value string")
    assert rows(reshape.normalise_legacy(lines), "nro_radicado") == [
        ("7", "2016-02-01 10:00:00", 2016, 2, "Choque", "Solo daños", "Centro", "La Candelaria", 'CL "1"', "-75.5", "6.2"),
        ("8", "2018-02-01 10:00:00", 2018, 2, "A", "Con heridos", "Centro", "X", "dir", "", ""),
    ]
    assert dict(rows(reshape.legacy_counters(lines))) == {
        "esquema_pre2017": 1, "esquema_post2017": 3, "sin_radicado": 1, "fecha_no_reconocida": 1, "lineas_malformadas": 1,
        "duplicados_resueltos": 2, "registros_emitidos": 2}


def test_ring_chaining():
    square = [(0, 0), (0, 1), (1, 1), (1, 0)]
    assert rings.chain([[square[0], square[1]], [square[2], square[1]], [square[3], square[0]], [square[2], square[3]]]) == [
        *square, square[0]]
    loose = rings.chain([[(0, 0), (0, 1)], [(5, 5), (6, 6)]])
    assert loose == [(0, 0), (0, 1), (5, 5), (6, 6), (0, 0)]
    assert rings.chain([]) == [] and rings.chain([[(1, 1), (2, 2), (1, 1)]]) == [(1, 1), (2, 2), (1, 1)]
    near = rings.chain([[(0.0, 0.0), (1.0, 1.0)], [(1.0 + 5e-8, 1.0), (2.0, 0.0)]])
    assert near == [(0.0, 0.0), (1.0, 1.0), (2.0, 0.0), (0.0, 0.0)]


def test_rings_apart_stay_apart(spark):
    square = lambda x: [(x, 0), (x + 2, 0), (x + 2, 2), (x, 2)]
    ways = [[square(x)[i], square(x)[(i + 1) % 4]] for i in range(4) for x in (0, 5)]
    assert [sorted(set(r)) for r in rings.chains(ways)] == [sorted(square(0)), sorted(square(5))]
    assert all(len(r) == 5 and r[0] == r[-1] for r in rings.chains(ways)) and rings.chains([[], []]) == []
    member = "relation_id bigint, type string, role string, seq int, lons array<double>, lats array<double>"
    row = lambda role, seq, way: (1, "way", role, seq, [float(p[0]) for p in way], [float(p[1]) for p in way])
    hole = [(5.5, 0.5), (6.0, 0.5), (6.0, 1.0), (5.5, 0.5)]
    members = spark.createDataFrame([*[row("outer", i, w) for i, w in enumerate(ways)], row("inner", 0, hole)], member)
    relation = spark.createDataFrame([(1, "a", "8", None, None)], "relation_id bigint, name string, admin_level string, alt_name string, wikipedia string")
    shape = json.loads(rings.polygon_features(relation, members).first()["geometry_geojson"])
    assert shape["type"] == "MultiPolygon" and [len(p) for p in shape["coordinates"]] == [1, 2]
    assert len(json.loads(rings.polygon_features(relation, members, one_ring=True).first()["geometry_geojson"])["coordinates"]) == 2


def test_holes_go_to_the_ring_they_lie_in(spark):
    """A notch, an island in a hole with a hole of its own, rings that touch, a hole outside everything."""
    outers = [
        [(0, 0), (9, 0), (9, 2), (2, 2), (2, 9), (0, 9)],          # an L
        [(4, 4), (8, 4), (8, 8), (4, 8)],                          # a square in its notch
        [(20, 0), (40, 0), (40, 20), (20, 20)],                    # a large square ...
        [(25, 5), (35, 5), (35, 15), (25, 15)],                    # ... and an island in its hole
    ]
    inners = [
        [(5, 5), (6, 5), (6, 6), (5, 6)],                          # in the notch square
        [(22, 2), (38, 2), (38, 18), (22, 18)],                    # in the large square, around the island
        [(25, 5), (28, 5), (28, 8), (25, 8)],                      # in the island, touching its corner
        [(0.5, 0.5), (1, 0.5), (1, 8), (0.5, 8)],                  # in the L
        [(90, 90), (91, 90), (91, 91)],                            # nowhere
    ]
    member = "relation_id bigint, type string, role string, seq int, lons array<double>, lats array<double>"
    row = lambda role, seq, ring: (7, "way", role, seq, [float(p[0]) for p in [*ring, ring[0]]], [float(p[1]) for p in [*ring, ring[0]]])
    members = spark.createDataFrame([row("outer", i, r) for i, r in enumerate(outers)] + [row("inner", i, r) for i, r in enumerate(inners)], member)
    relation = spark.createDataFrame([(7, "a", "8", None, None)], "relation_id bigint, name string, admin_level string, alt_name string, wikipedia string")
    shape = json.loads(rings.polygon_features(relation, members).first()["geometry_geojson"])
    starts = [[tuple(r[0]) for r in part] for part in shape["coordinates"]]
    assert starts == [[(0, 0), (0.5, 0.5), (90, 90)], [(4, 4), (5, 5)], [(20, 0), (22, 2)], [(25, 5), (25, 5)]]


def test_polygon_features(spark):
    member = "relation_id bigint, type string, role string, seq int, lons array<double>, lats array<double>"
    members = spark.createDataFrame([
        (1, "way", "outer", 0, [0.0, 9.0, 9.0], [0.0, 0.0, 9.0]), (1, "way", "outer", 1, [0.0, 0.0, 9.0], [0.0, 9.0, 9.0]),
        (1, "way", "inner", 0, [1.0, 2.0, 2.0, 1.0], [1.0, 1.0, 2.0, 1.0]),
        (2, "way", "outer", 0, [0.0, 1.0], [0.0, 1.0]), (3, "node", "outer", 0, [0.0], [0.0])], member)
    relations = spark.createDataFrame([(1, "Altavista", "7", None, None), (2, "b", "8", None, None), (3, "c", "8", None, None)],
                                      "relation_id bigint, name string, admin_level string, alt_name string, wikipedia string")
    found = rings.polygon_features(relations, members).collect()
    assert [(r["osm_id"], r["tipo"], r["nombre_alt"]) for r in found] == [(1, "corregimiento", "")]
    assert found[0]["geometry_geojson"] == (
        '{"type":"Polygon","coordinates":[[[0.0,0.0],[9.0,0.0],[9.0,9.0],[0.0,9.0],[0.0,0.0]],[[1.0,1.0],[2.0,1.0],[2.0,2.0],[1.0,1.0]]]}')


@pytest.mark.parametrize("spread", [1, 1000])
def test_pagerank_of_a_path(spark, spread):
    vertices = spark.createDataFrame([(i,) for i in range(1, 6)], "v int")
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a int, b int")
    found = dict(rows(graph.pagerank(vertices.filter("v < 5"), edges, "v", "a", "b", spread=spread)))
    assert found[1] == found[4] == pytest.approx(0.175439, abs=1e-6)
    assert found[2] == found[3] == pytest.approx(0.324561, abs=1e-6)
    lonely = dict(rows(graph.pagerank(vertices, edges, "v", "a", "b", rounds=2, spread=spread)))
    assert lonely[5] == pytest.approx(0.15 / 5)


@pytest.mark.parametrize("hubs", [False, True])
def test_pagerank_moves_only_flows_between_rounds(spark, hubs):
    nodes = spark.createDataFrame([(i, 2, 1) for i in range(9)], "id long, degree long, parts int")
    links = graph.both_ways(spark.createDataFrame([(i, (i + 1) % 9) for i in range(9)], "a long, b long"), "a", "b")
    laid = graph._laid_out(nodes, links, hubs)
    assert laid.count() == 27
    moves = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        states = [nodes.withColumn("rank", F.lit(1 / 9))]
        for _ in range(3):
            states.append(graph._handed_on(states[-1], laid, hubs, 0.15 / 9, 0.85))
        # The plan of the laid-out edges stands in each round's plan, too.
        own = moves(states[3]) - moves(states[2]) - moves(laid.select("src"))
        assert sorted(rows(states[3].select("id", F.round("rank", 9)))) == [(i, pytest.approx(1 / 9)) for i in range(9)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        laid.unpersist()
    assert own == (2 if hubs else 1)


def test_transit_network(spark):
    stations, links = transit.stations(spark), transit.links(spark)
    assert (stations.count(), links.count()) == (34, 33)
    routes = graph.route_table(graph.shortest_routes(stations, links, "id", "nombre", "origen", "destino", "minutos", sources=stations)).cache()
    assert routes.count() == 34 * 33
    far = routes.filter("origen_id = 'A21' and destino_id = 'M02'").first()
    assert (far["tiempo_min"], far["origen"], far["destino"]) == (71, "La Estrella", "Parque Arví")
    assert far["num_paradas"] == len(far["ruta_ids"]) - 1 and far["ruta_ids"][0] == "A21" and far["ruta_nombres"][-1] == "Parque Arví"


def test_no_sources_and_no_polygons(spark):
    vertices = spark.createDataFrame([("a", "A")], "k string, n string")
    edges = spark.createDataFrame([], "s string, t string, w int")
    none = spark.createDataFrame([], "k string")
    assert graph.shortest_routes(vertices, edges, "k", "n", "s", "t", "w", none).count() == 0
    points = spark.createDataFrame([(0, 0.25, 0.5)], "i int, x double, y double")
    for shapes in ([], [(1, "roto", "{}")]):
        polygons = spark.createDataFrame(shapes, "o int, n string, g string")
        assert spatial.assign_area(points, polygons, "x", "y", "n", "g", "o").first()["area"] is None


def test_routes_prefer_time_over_stops(spark):
    vertices = spark.createDataFrame([(x, x.upper()) for x in "abcde"], "k string, n string")
    edges = spark.createDataFrame([("a", "b", 10), ("a", "c", 2), ("c", "b", 3), ("b", "d", 1)], "s string, t string, w int")
    start = spark.createDataFrame([("a",)], "k string")
    found = graph.route_table(graph.shortest_routes(vertices, edges, "k", "n", "s", "t", "w", start))
    assert {r["destino_id"]: (r["tiempo_min"], "".join(r["ruta_ids"])) for r in found.collect()} == {
        "b": (5, "acb"), "c": (2, "ac"), "d": (6, "acbd")}


def test_route_lengths_read_a_round_once(spark, monkeypatch):
    """Lengths equal those of the routes, also where labels are bettered and folders joined; a round's frontier is read alone."""
    vertices = spark.createDataFrame([(i, f"n{i}") for i in range(12)], "k long, n string")
    edges = spark.createDataFrame([(i, i + 1, 1 + i % 2) for i in range(11)] + [(0, 9, 13), (2, 7, 5), (7, 1, 2)], "s long, t long, w int")
    starts = spark.createDataFrame([(0,), (11,)], "k long")
    monkeypatch.setattr(graph, "FOLDERS", 3)
    lengths = graph.route_lengths(vertices, edges, "k", "s", "t", "w", starts)
    routes = graph.shortest_routes(vertices, edges, "k", "n", "s", "t", "w", starts).collect()
    assert {(r["source"], r["id"], r["minutes"], r["stops"]) for r in lengths.collect()} == {
        (r["source"], r["id"], r["minutes"], len(r["ids"]) - 1) for r in routes}
    assert len(routes) == 24 and not [t for t in spark.catalog.listTables() if t.name.startswith("rutas_")]


def test_routes_through_a_hub_and_cycles(spark):
    """Against a plain label-setting search: fastest, then fewest stops, then the least stop before the last."""
    rng = random.Random(12)
    ids = [f"v{i:03d}" for i in range(70)]
    edges = [("v000", x, rng.randint(1, 9)) for x in ids[1:50]] + [(ids[i], ids[i + 1], 1) for i in range(50, 69)]
    edges += [(rng.choice(ids[:55]), rng.choice(ids[:55]), rng.randint(0, 3)) for _ in range(60)]
    vertices = spark.createDataFrame([(x, x.upper()) for x in ids] + [("alone", "ALONE")], "k string, n string")
    links = spark.createDataFrame([*edges, ("v001", "unknown", 1)], "s string, t string, w int")
    sources = ["v000", "v060", "alone", "v003"]
    starts = spark.createDataFrame([(x,) for x in sources + ["v003", "nobody"]], "k string")
    got = {(r["source"], r["id"]): (r["minutes"], r["ids"], r["names"])
           for r in graph.shortest_routes(vertices, links, "k", "n", "s", "t", "w", starts).collect()}
    near = {}
    for a, b, w in edges:
        for x, y in ((a, b), (b, a)):
            near.setdefault(x, {}).setdefault(y, []).append(w)
    want = {}
    for source in sources:
        best = {source: (0, 0, None)}
        for _ in range(len(ids)):
            for x, (m, k, _) in list(best.items()):
                for y, ws in near.get(x, {}).items():
                    label = (m + min(ws), k + 1, x)
                    if y not in best or label[:2] < best[y][:2] or label[:2] == best[y][:2] and best[y][2] is not None and x < best[y][2]:
                        best[y] = label
        for x in best:
            path = [x]
            while best[path[0]][2] is not None:
                path.insert(0, best[path[0]][2])
            want[source, x] = (best[x][0], path, [p.upper() for p in path])
    assert got == want


def test_metrics_equal_the_evaluator(spark):
    rng = random.Random(3)
    scored = spark.createDataFrame([(float(rng.randint(0, 2)), float(rng.choice([0, 0, 1, 3]))) for _ in range(400)], "label double, prediction double")
    found = classify.metrics(classify.confusion(scored)).first()
    for name, metric in (("accuracy", "accuracy"), ("f1_weighted", "f1"), ("precision_weighted", "weightedPrecision"), ("recall_weighted", "weightedRecall")):
        assert found[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(scored))


def test_rings_hold_few_rows_as_python_objects():
    import tracemalloc

    import pyarrow as pa

    corners = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
    ways = list(zip(corners, corners[1:] + corners[:1]))

    def peak(n):
        lons, lats = (pa.array([[[a[i], b[i]] for a, b in ways]] * n) for i in (0, 1))
        tracemalloc.start()
        found = rings._over_rows(rings.chains).func(lons, lats)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(found) == n
        assert found.to_pylist() == [[[list(c) for c in [*corners, corners[0]]]]] * n
        return most

    assert peak(8_000) < 4 * peak(800)


def test_training_rows_are_spread_however_few_files_they_lie_in(spark, tmp_path):
    spark.range(3_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    frame = spark.read.parquet(str(tmp_path / "one"))
    assert frame.rdd.getNumPartitions() == 1
    spread = classify.spread(frame, "id", 3_000)
    sizes = [len(p) for p in spread.rdd.glom().collect()]
    assert len(sizes) == classify.TRAINING_PARTS and sum(sizes) == 3_000 and max(sizes) < 200
    assert classify.spread(frame, "id", 3_000, parts=2, part_rows=500).rdd.getNumPartitions() == 6


def test_forest_trains_on_spread_rows(spark, monkeypatch):
    seen = []

    class Fake:
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())
            return self

        def transform(self, rows):
            return rows

    monkeypatch.setattr(classify, "forest", lambda *a, **k: Fake())
    frame = spark.range(200).coalesce(1).select("id", F.lit("x").alias("y"), F.lit("c").alias("c"), F.lit(1.0).alias("n"))
    classify.train(frame, "id", "y", 100, ["c"], ["n"])
    assert seen == [classify.TRAINING_PARTS]


def test_classifier_round_trip(spark, tmp_path):
    rng = random.Random(5)
    data = []
    for i in range(400):
        kind = rng.choice(["Choque", "Caída", None])
        data.append((i, "Con heridos" if kind == "Caída" else "Solo daños", dt.datetime(2020, 1 + i % 12, 1, i % 24), kind, "Vía", "C", 1 + i % 12, -75.5, None))
    frame = spark.createDataFrame(data, "id int, gravedad string, t timestamp, clase string, diseno_via string, comuna string, mes_accidente int, longitud double, latitud double")
    ready = classify.prepare_features(frame, "gravedad", "t", [s for s, _, _ in v.SEVERITIES])
    model, scored = classify.train(ready, "id", "gravedad", trees=5, depth=4)
    assert classify.metrics(classify.confusion(scored)).first()["accuracy"] > 0.95
    assert "Caída" in classify.importances(model, scored, 1).first()["feature"] or "clase" in classify.importances(model, scored, 1).first()["feature"]
    classify.save(model, str(tmp_path / "m"))
    again = classify.load(str(tmp_path / "m")).transform(classify.split_by_key(ready, "id")[1])
    assert rows(classify.confusion(again), "label", "prediction") == rows(classify.confusion(scored), "label", "prediction")
    with pytest.raises(ValueError):
        classify.train(ready.limit(100), "id", "gravedad")


def test_risk_score(spark):
    volume = spark.createDataFrame([("a", 10, 1), ("b", 20, 2), ("c", 20, 2), ("z", 1, 1)], "comuna string, vehiculos_total bigint, corredores_distintos bigint")
    incidents = spark.createDataFrame([("a", 9, 1, 0), ("b", 9, 0, 5), ("c", 9, 0, 1)], "comuna string, incidentes_total bigint, con_muertos bigint, con_heridos bigint")
    found = {r["comuna"]: (r["rank_volumen"], r["rank_severidad"], r["score_riesgo"]) for r in rollups.composite_risk(volume, incidents, "comuna").collect()}
    assert found == {"a": (3, 1, 4), "b": (1, 2, 3), "c": (2, 3, 5)}


def test_frequent_streets_and_search(spark):
    frame = spark.createDataFrame([("a", "cl 1"), ("a", "CL 1 "), ("a", "cl 2"), ("a", " "), ("b", "x")], "c string, d string")
    assert rows(rollups.frequent_streets(frame, "c", "d", 1), "c") == [("a", "CL 1", 2), ("b", "X", 1)]
    at = dt.datetime(2024, 1, 1)
    docs = spark.createDataFrame([("z1", "leve", at, at), ("z2", "critica", at + dt.timedelta(hours=1), at + dt.timedelta(hours=1))],
                                 "zona string, gravedad string, ventana_inicio timestamp, emitido_en timestamp")
    now = F.lit(at + dt.timedelta(hours=2))
    assert [r["zona"] for r in reports.search_alerts(docs, now).collect()] == ["z2", "z1"]
    assert [r["zona"] for r in reports.search_alerts(docs, now, last="1h").collect()] == ["z2"]
    assert reports.search_alerts(docs, now, zone="z1", severity="critica").isEmpty()
