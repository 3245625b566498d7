"""Area of a point: a join on the cells of a quadtree with an exact even-odd test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.functions.geo import edges_of, is_inside, is_inside_near, rings_of, touches
from vialis.session import settle

# Side of the smallest cell in degrees; cells of level n are 2^n times as wide.
CELL_DEGREES = 0.005
# A cell with more edges than this is split.
LEAF_EDGES = 64
# Share of a cell by which its sides are moved out, so that rounding never leaves a point outside its cell.
MARGIN = 1e-6

NODE = ("_rank", "_area", "_level", "_cx", "_cy", "_east", "_south", "_inside", "_edges")


def _with_sides(cells: DataFrame, cell: float) -> DataFrame:
    """The sides of each cell, and those of its margin, as columns: they are computed once, not for each edge."""
    sized = cells.withColumn("_size", F.lit(cell) * F.pow(F.lit(2.0), F.col("_level")))
    side = lambda c, step: (F.col(c) + step) * F.col("_size")
    return sized.withColumns({
        "_east": side("_cx", 1), "_south": side("_cy", 0), "_w": side("_cx", -MARGIN), "_e": side("_cx", 1 + MARGIN),
        "_s": side("_cy", -MARGIN), "_n": side("_cy", 1 + MARGIN)})


def _near_edges(edges: str) -> Column:
    """The edges that touch a cell, with its margin."""
    return F.filter(edges, lambda e: touches(e, *map(F.col, ("_w", "_e", "_s", "_n"))))


def _roots(polygons: DataFrame, name: str, geojson: str, order: str, cell: float, holes: bool) -> DataFrame:
    """The cells as large as a polygon that it reaches, four at most."""
    shaped = polygons.select(
        F.col(order).alias("_rank"), F.col(name).alias("_area"), edges_of(rings_of(F.col(geojson), holes)).alias("_all"),
    ).filter(F.size("_all") > 0)
    # Every corner starts one edge.
    low = lambda axis: F.array_min(F.transform("_all", lambda e: e[axis]))
    high = lambda axis: F.array_max(F.transform("_all", lambda e: e[axis]))
    boxed = shaped.withColumns({f"_{end}_{axis}": of(f"{axis}0") for end, of in (("low", low), ("high", high)) for axis in "xy"})
    wide = F.greatest(F.col("_high_x") - F.col("_low_x"), F.col("_high_y") - F.col("_low_y"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(wide / cell)).cast("int"))
    boxed = boxed.withColumn("_level", level).withColumn("_size", F.lit(cell) * F.pow(F.lit(2.0), F.col("_level")))
    cells = lambda axis: F.explode(F.sequence(F.floor(F.col(f"_low_{axis}") / F.col("_size")), F.floor(F.col(f"_high_{axis}") / F.col("_size"))))
    placed = _with_sides(boxed.withColumn("_cx", cells("x")).withColumn("_cy", cells("y")), cell)
    return placed.withColumns({
        "_inside": is_inside(F.col("_east"), F.col("_south"), F.col("_all")), "_edges": _near_edges("_all")}).select(*NODE)


def _quarters(nodes: DataFrame, cell: float) -> DataFrame:
    """The four quarters of each cell, each with the edges that touch it and the side its corner is on."""
    quarter = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x in (0, 1) for y in (0, 1)]))
    halves = nodes.withColumnsRenamed({"_east": "_from_e", "_south": "_from_s"}).withColumn("_half", quarter).withColumns({
        "_level": F.col("_level") - 1, "_cx": F.col("_cx") * 2 + F.col("_half.x"), "_cy": F.col("_cy") * 2 + F.col("_half.y")})
    inside = is_inside_near(*map(F.col, ("_east", "_south", "_from_e", "_from_s", "_inside", "_edges")))
    return _with_sides(halves, cell).withColumns({"_inside": inside, "_edges": _near_edges("_edges")}).select(*NODE)


def area_index(
    polygons: DataFrame, name: str, geojson: str, order: str, cell: float = CELL_DEGREES, holes: bool = False,
    leaf: int = LEAF_EDGES,
) -> DataFrame:
    """A quadtree cover: cells of several levels that lie in a polygon or on its border, with the edges that touch them.

    A cell with more than ``leaf`` edges is split in four, round by
    round down to the width ``cell``; each quarter gets the edges that touch it. So the cells of one large polygon spread over
    the cluster as they are split. ``_inside`` tells of the south-east corner of a cell; a cell
    without edges is all inside or, dropped, all outside.
    """
    done = None
    nodes = _roots(polygons, name, geojson, order, cell, holes)
    while True:
        is_open = (F.size("_edges") > leaf) & (F.col("_level") > 0)
        spread = nodes.filter((F.size("_edges") > 0) | F.col("_inside")).repartition("_cx", "_cy", "_level")
        nodes = settle(spread)
        leaves = nodes.filter(~is_open)
        done = leaves if done is None else done.unionByName(leaves)
        nodes = nodes.filter(is_open)
        if nodes.isEmpty():
            return done
        nodes = _quarters(nodes, cell)


def assign_area(
    points: DataFrame,
    polygons: DataFrame,
    lon: str,
    lat: str,
    name: str,
    geojson: str,
    order: str,
    alias: str = "area",
    cell: float = CELL_DEGREES,
    holes: bool = False,
    leaf: int = LEAF_EDGES,
) -> DataFrame:
    """Points with the first polygon, by ``order``, that holds them; null outside all of them.

    Polygons with equal order values come by name, those without one last.
    Distinct coordinates are joined with the polygon index on their cells of all levels in use, so
    a crowded place is tested once and is no heavier than any other; whether
    the index travels to the executors is left to Spark's own size check.
    Points without coordinates meet nothing and take no part in the joins.
    """
    index = area_index(polygons, name, geojson, order, cell, holes, leaf)
    # Some twenty levels at most lie between the smallest cell and the whole earth.
    levels = [r[0] for r in index.select("_level").distinct().collect()]
    located = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    spots = points.filter(located).select(F.col(lon).alias("_lon"), F.col(lat).alias("_lat")).distinct()
    spots = spots.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    size = F.lit(cell) * F.pow(F.lit(2.0), F.col("_level"))
    spots = spots.withColumns({"_cx": F.floor(F.col("_lon") / size), "_cy": F.floor(F.col("_lat") / size)})
    covers = is_inside_near(*map(F.col, ("_lon", "_lat", "_east", "_south", "_inside", "_edges")))
    hits = spots.join(index, ["_level", "_cx", "_cy"]).filter(covers)
    place = F.struct(F.col("_rank").isNull(), F.col("_rank"), F.col("_area"))
    first = hits.groupBy("_lon", "_lat").agg(F.min(place)["_area"].alias("_area"))
    # A row without coordinates gets a key of its own, so that all of them do not meet in one task.
    apart = F.when(~located, -1.0 - F.monotonically_increasing_id())
    keyed = points.withColumn("_apart", F.coalesce(apart, F.lit(0.0)))
    first = first.withColumn("_apart_0", F.lit(0.0))
    same = (F.col(lon) == F.col("_lon")) & (F.col(lat) == F.col("_lat")) & (F.col("_apart") == F.col("_apart_0"))
    joined = keyed.join(first, same, "left")
    return joined.select(*points.columns, F.col("_area").alias(alias))


def area_or_text(geometric: str, textual: str) -> Column:
    """Area from geometry where there is one, else the area the source gave as text."""
    return F.coalesce(F.col(geometric), F.col(textual))
