"""Closed rings and polygon features from the way segments of boundary relations."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from vialis.functions.geo import box_of, edges_of, interior_point, is_inside, ring_area
from vialis.functions.text import boundary_kind
from vialis.session import settle

TOLERANCE = 1e-7
LEAST_POINTS = 4
# Rows of an Arrow batch that are Python objects at one time.
ROWS_AT_ONCE = 64


def _near(a, b) -> bool:
    return abs(a[0] - b[0]) < TOLERANCE and abs(a[1] - b[1]) < TOLERANCE


def _tile(point) -> tuple[int, int]:
    return round(point[0] / TOLERANCE), round(point[1] / TOLERANCE)


def _walk(ways: list, ends: dict, free: set[int], first: int, closing: bool) -> list:
    """The ring that starts with one way; of several ways that fit its tip the first in the list is taken.

    With ``closing`` the walk ends where the ring meets its start.
    """
    ring = list(ways[first])
    free.discard(first)
    while free and not (closing and len(ring) >= LEAST_POINTS and _near(ring[0], ring[-1])):
        tip = ring[-1]
        x, y = _tile(tip)
        around = set().union(*(ends.get((x + i, y + j), ()) for i in (-1, 0, 1) for j in (-1, 0, 1)))
        fitting = (n for n in sorted(around & free) if _near(ways[n][0], tip) or _near(ways[n][-1], tip))
        number = next(fitting, None)
        if number is None:
            break
        way = ways[number] if _near(ways[number][0], tip) else ways[number][::-1]
        ring += way[1:]
        free.remove(number)
    return ring


def _closed(ring: list) -> list:
    return ring if not ring or _near(ring[0], ring[-1]) else [*ring, ring[0]]


def _indexed(ways: list[list[tuple[float, float]]]) -> tuple[list, dict, set[int]]:
    """The ways that have points, their numbers by the tile of either end, and all numbers."""
    ways = [w for w in ways if w]
    ends = defaultdict(set)
    for number, way in enumerate(ways):
        ends[_tile(way[0])].add(number)
        ends[_tile(way[-1])].add(number)
    return ways, ends, set(range(len(ways)))


def chain(ways: list[list[tuple[float, float]]]) -> list[tuple[float, float]]:
    """One ring: ways end to end from the first one, those that never fit added in list order, and closed."""
    ways, ends, free = _indexed(ways)
    if not ways:
        return []
    ring = _walk(ways, ends, free, 0, closing=False)
    for number in sorted(free):
        ring += ways[number]
    return _closed(ring)


def chains(ways: list[list[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """All rings: one is walked until it closes or nothing fits, the next starts with the first way left.

    Ends are looked up by tile, so the work grows with the number of ways, not
    its square. A way is turned round where only its end fits.
    """
    ways, ends, free = _indexed(ways)
    found = []
    while free:
        found.append(_closed(_walk(ways, ends, free, min(free), closing=True)))
    return found


RINGS = pa.list_(pa.list_(pa.list_(pa.float64())))


def _in_slices(join, lons: pa.Array, lats: pa.Array, rows: int = ROWS_AT_ONCE) -> pa.Array:
    """``join`` over the ways of each row. A batch becomes Python objects a few rows at a time, as they take many times its size."""
    parts = [pa.array([], RINGS)]
    for start in range(0, len(lons), rows):
        some = zip(lons.slice(start, rows).to_pylist(), lats.slice(start, rows).to_pylist())
        parts.append(pa.array([join([list(zip(x, y)) for x, y in zip(*ways)]) for ways in some], RINGS))
    return pa.concat_arrays(parts)


def _over_rows(join):
    @F.arrow_udf(ArrayType(ArrayType(ArrayType(DoubleType()))))
    def run(lons: pa.Array, lats: pa.Array) -> pa.Array:
        return _in_slices(join, lons, lats)
    return run


_all_rings = _over_rows(chains)
_one_ring = _over_rows(lambda ways: [chain(ways)])


def rings_of_relations(members: DataFrame, one_ring: bool = False) -> DataFrame:
    """Rings per relation and role from ``relation_id, type, role, seq, lons, lats``, numbered by ``part``.

    The segments of a relation's role meet in one row, as large as the rings
    they form, and are chained in Arrow batches. ``one_ring`` gives a single ring
    with what does not fit at its end.
    """
    ways = members.filter((F.col("type") == "way") & F.col("role").isin("outer", "inner"))
    gathered = ways.groupBy("relation_id", "role").agg(
        F.sort_array(F.collect_list(F.struct("seq", "lons", "lats"))).alias("_ways")
    )
    joined = _one_ring if one_ring else _all_rings
    chained = gathered.select("relation_id", "role", joined("_ways.lons", "_ways.lats").alias("_rings"))
    whole = chained.select("relation_id", "role", F.filter("_rings", lambda r: F.size(r) >= LEAST_POINTS).alias("_rings"))
    return whole.select("relation_id", "role", F.posexplode("_rings").alias("part", "ring"))


def _homes(rings: DataFrame) -> DataFrame:
    """``relation_id, part, home``: the outer ring each inner one lies in, by exact test.

    Of nested outer rings around it that is the innermost, the one with the
    least area. The test is made for a point inside the inner ring, so rings may touch; an outer ring that lies in the hole
    itself does not hold its corners. Only rings of one relation whose boxes fit meet.
    """
    facts = rings.withColumn("box", box_of(F.col("ring")))
    inner = facts.filter("role = 'inner'").select("relation_id", "part", "box", interior_point(F.col("ring")).alias("point"))
    outer = facts.filter("role = 'outer'").select(
        "relation_id", F.col("part").alias("home"), F.col("box").alias("around"), ring_area(F.col("ring")).alias("area"), "ring")
    fits = ((F.col("around.west") <= F.col("box.west")) & (F.col("around.east") >= F.col("box.east"))
            & (F.col("around.south") <= F.col("box.south")) & (F.col("around.north") >= F.col("box.north")))
    met = inner.join(outer, "relation_id").filter(fits)
    inside = is_inside(F.col("point.x"), F.col("point.y"), edges_of(F.array("ring")))
    return met.filter(inside).groupBy("relation_id", "part").agg(F.min_by("home", F.struct("area", "home")).alias("home"))


def polygon_features(relations: DataFrame, members: DataFrame, one_ring: bool = False) -> DataFrame:
    """Features with properties and GeoJSON text; relations without an outer ring are dropped.

    Several outer rings make a MultiPolygon; an inner ring goes to the innermost
    outer one that it lies in, else to the first.

    ``relations`` has ``relation_id`` and the tags ``name, admin_level, alt_name, wikipedia``.
    """
    chained = settle(rings_of_relations(members, one_ring))
    outer = chained.filter("role = 'outer'").select("relation_id", F.col("part").alias("home"), F.lit(-1).alias("part"), "ring")
    first = outer.groupBy("relation_id").agg(F.min("home").alias("first"))
    inner = chained.filter("role = 'inner'").join(_homes(chained), ["relation_id", "part"], "left").join(first, "relation_id")
    inner = inner.select("relation_id", F.coalesce("home", "first").alias("home"), "part", "ring")
    # An outer ring comes before the inner ones in it.
    polygons = outer.unionByName(inner).groupBy("relation_id", "home").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("part", "ring"))), lambda x: x["ring"]).alias("rings"))
    rings = polygons.groupBy("relation_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("home", "rings"))), lambda x: x["rings"]).alias("_parts"))
    shape = lambda kind, value: F.to_json(F.struct(F.lit(kind).alias("type"), value.alias("coordinates")))
    geometry = F.when(F.size("_parts") == 1, shape("Polygon", F.element_at("_parts", 1))).otherwise(
        shape("MultiPolygon", F.col("_parts")))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return relations.join(rings, "relation_id").select(
        F.col("relation_id").alias("osm_id"),
        text("name").alias("nombre"),
        boundary_kind(F.col("admin_level")).alias("tipo"),
        F.coalesce("admin_level", F.lit("?")).alias("admin_level"),
        text("alt_name").alias("nombre_alt"),
        text("wikipedia").alias("wikipedia"),
        geometry.alias("geometry_geojson"),
    )
