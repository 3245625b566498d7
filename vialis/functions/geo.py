"""Coordinates as text or numbers, rings from GeoJSON, and the point-in-ring test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialis import vocabulary as v

RING = "array<array<double>>"


def _pair(first: Column, second: Column, names=("first", "second")) -> Column:
    return F.struct(first.alias(names[0]), second.alias(names[1]))


def _split_pair(text: Column, separator: str) -> Column:
    parts = F.split(text, separator, 2)
    number = lambda at: F.trim(F.get(parts, F.lit(at))).try_cast("double")
    return _pair(number(0), number(1))


def pair_from_brackets(text: Column) -> Column:
    """Numbers of ``[lon, lat]`` text as struct ``first, second``; null where unreadable."""
    return _split_pair(F.regexp_replace(text, r"[\[\]\s]", ""), ",")


def pair_from_pipe(text: Column) -> Column:
    """Numbers of ``lon|lat`` text."""
    return _split_pair(text, r"\|")


def pair_from_dict_text(text: Column) -> Column:
    """Numbers of ``{'lon': '..', 'lat': '..'}`` text."""
    number = lambda key: F.regexp_extract(text, rf"'{key}'\s*:\s*'([^']+)'", 1).try_cast("double")
    return _pair(number("lon"), number("lat"))


def pipe_text(text: Column) -> Column:
    """``[lon, lat]`` rewritten as ``lon|lat``."""
    return F.translate(F.regexp_replace(text, r"[\[\]\s]", ""), ",", "|")


def repair_swapped(pair: Column) -> Column:
    """Struct ``lon, lat``; a pair whose first number is a latitude is turned round."""
    first, second = pair["first"], pair["second"]
    swapped = first.between(*v.SWAPPED_FIRST) & second.between(*v.SWAPPED_SECOND)
    return _pair(
        F.when(swapped, second).otherwise(first),
        F.when(swapped, first).otherwise(second),
        ("lon", "lat"),
    )


def in_valid_area(lon: Column, lat: Column, lon_range=v.LON_RANGE, lat_range=v.LAT_RANGE) -> Column:
    """Inclusive bounding box; plain comparisons, so Parquet can skip row groups."""
    return lon.between(*lon_range) & lat.between(*lat_range)


def rings_of(geojson: Column, holes: bool = False) -> Column:
    """Rings of Polygon or MultiPolygon text; outer rings only unless ``holes``."""
    kind = F.get_json_object(geojson, "$.type")
    one = F.from_json(geojson, f"coordinates array<{RING}>")["coordinates"]
    many = F.from_json(geojson, f"coordinates array<array<{RING}>>")["coordinates"]
    polygons = F.when(kind == "MultiPolygon", many).when(kind == "Polygon", F.array(one))
    if holes:
        return F.flatten(polygons)
    return F.transform(polygons, lambda rings: F.get(rings, F.lit(0)))


def edges_of(rings: Column) -> Column:
    """All edges of all rings, each ring closed, as structs ``x0, y0, x1, y1``."""
    def closed(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(
            ring, following,
            lambda a, b: F.struct(
                F.get(a, F.lit(0)).alias("x0"), F.get(a, F.lit(1)).alias("y0"),
                F.get(b, F.lit(0)).alias("x1"), F.get(b, F.lit(1)).alias("y1"),
            ),
        )
    return F.flatten(F.transform(rings, closed))


def _beside(lon: Column, lat: Column, e: Column) -> Column:
    """Whether a point lies to the east of an edge's line; on the line it counts as east. For edges that are not level."""
    run = (lon - e["x0"]) * (e["y1"] - e["y0"])
    rise = (e["x1"] - e["x0"]) * (lat - e["y0"])
    return F.when(e["y1"] > e["y0"], run >= rise).otherwise(run <= rise)


def _meets_east(lon: Column, lat: Column, e: Column) -> Column:
    """Whether a ray to the east of the point crosses the edge."""
    return ((e["y0"] > lat) != (e["y1"] > lat)) & ~_beside(lon, lat, e)


def _meets_north(lon: Column, lat: Column, e: Column) -> Column:
    """Whether a ray to the north of the point crosses the edge, for the same choice of sides."""
    rising = (e["x1"] > e["x0"]) == (e["y1"] > e["y0"])
    above = F.when(e["y0"] == e["y1"], e["y0"] > lat).otherwise(rising == _beside(lon, lat, e))
    return ((e["x0"] > lon) != (e["x1"] > lon)) & above


def is_inside(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd rule: a ray to the east of the point crosses an odd number of edges."""
    return F.size(F.filter(edges, lambda e: _meets_east(lon, lat, e))) % 2 == 1


def is_inside_near(lon: Column, lat: Column, east: Column, south: Column, corner: Column, edges: Column) -> Column:
    """``is_inside`` from what is near: whether the south-east corner of a cell is inside, and the edges that touch the cell.

    The way from the point east to the cell's side and down to the corner
    crosses only such edges, and changes sides at each.
    """
    def crossed(e: Column) -> Column:
        level = _meets_east(lon, lat, e) != _meets_east(east, lat, e)
        upright = _meets_north(east, lat, e) != _meets_north(east, south, e)
        return level != upright
    return corner != (F.size(F.filter(edges, crossed)) % 2 == 1)


def touches(e: Column, west: Column, east: Column, south: Column, north: Column) -> Column:
    """Whether an edge meets a box, its sides included."""
    near = ((F.least(e["x0"], e["x1"]) <= east) & (F.greatest(e["x0"], e["x1"]) >= west)
            & (F.least(e["y0"], e["y1"]) <= north) & (F.greatest(e["y0"], e["y1"]) >= south))
    side = lambda x, y: (x - e["x0"]) * (e["y1"] - e["y0"]) - (e["x1"] - e["x0"]) * (y - e["y0"])
    sides = [side(x, y) for x in (west, east) for y in (south, north)]
    return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def interior_point(ring: Column) -> Column:
    """A point strictly inside a ring, as struct ``x, y``: the middle of the first stretch inside it at a height between two corners.

    A ring without an inside gives its first corner.
    """
    heights = F.array_sort(F.array_distinct(F.transform(ring, lambda p: F.get(p, F.lit(1)))))
    below = F.floor((F.size(heights) - 1) / 2).cast("int")
    height = (F.get(heights, below) + F.get(heights, below + 1)) / 2

    def meeting(e: Column) -> Column:
        return e["x0"] + (height - e["y0"]) * (e["x1"] - e["x0"]) / (e["y1"] - e["y0"])

    crossed = F.filter(edges_of(F.array(ring)), lambda e: (e["y0"] > height) != (e["y1"] > height))
    xs = F.array_sort(F.transform(crossed, meeting))
    middle = (F.get(xs, F.lit(0)) + F.get(xs, F.lit(1))) / 2
    first = F.get(ring, F.lit(0))
    return F.struct(F.coalesce(middle, F.get(first, F.lit(0))).alias("x"),
                    F.when(middle.isNull(), F.get(first, F.lit(1))).otherwise(height).alias("y"))


def box_of(ring: Column) -> Column:
    """Struct ``west, south, east, north`` of a ring."""
    x, y = F.transform(ring, lambda p: F.get(p, F.lit(0))), F.transform(ring, lambda p: F.get(p, F.lit(1)))
    return F.struct(F.array_min(x).alias("west"), F.array_min(y).alias("south"), F.array_max(x).alias("east"), F.array_max(y).alias("north"))


def ring_area(ring: Column) -> Column:
    """Area inside a ring, whichever way round it goes."""
    twice = F.aggregate(edges_of(F.array(ring)), F.lit(0.0), lambda a, e: a + e["x0"] * e["y1"] - e["x1"] * e["y0"])
    return F.abs(twice) / 2
