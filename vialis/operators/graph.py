"""Centrality and shortest routes on vertex and edge frames."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vialis.operators.ranking import ranked
from vialis.session import settle

# Edges of a vertex that stay together; a vertex has as many parts as that takes.
SPREAD = 10_000
# Rounds between two lineage cuts.
CUT_EVERY = 5
# Folders of labels that are read side by side before they become one.
FOLDERS = 24
# Decimals that count when ranks are compared, so equal vertices tie on any layout of the sums.
RANK_DECIMALS = 12


def both_ways(edges: DataFrame, src: str, dst: str, weight: str | None = None) -> DataFrame:
    """Every edge in both directions as ``src, dst[, weight]``."""
    rest = [] if weight is None else [F.col(weight).alias("weight")]
    forth = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst"), *rest)
    back = edges.select(F.col(dst).alias("src"), F.col(src).alias("dst"), *rest)
    return forth.unionByName(back)


def _laid_out(nodes: DataFrame, links: DataFrame, hubs: bool) -> DataFrame:
    """``src, part, dst, stays``: the links of ``nodes`` by their source, or by source and part; every node has a row that stays with it."""
    session = nodes.sparkSession
    tasks = int(session.conf.get("spark.sql.shuffle.partitions"))
    counts = nodes.select(F.col("id").alias("src"), "parts")
    part = F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int")
    rows = links.join(counts, "src").select("src", part.alias("part"), "dst", F.lit(False).alias("stays"))
    rows = rows.unionByName(nodes.select(F.col("id").alias("src"), F.lit(0).alias("part"), F.col("id").alias("dst"), F.lit(True).alias("stays")))
    keys = ["src", "part"] if hubs else ["src"]
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)


def _handed_on(state: DataFrame, laid: DataFrame, hubs: bool, base: float, damping: float) -> DataFrame:
    """``state`` after one round."""
    shares = state.select(F.col("id").alias("src"), (F.col("rank") / F.col("degree")).alias("flow"), "degree", "parts")
    if hubs:
        shares = shares.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    of_node = lambda c: F.when(F.col("stays"), F.col(c)).alias(c)
    flows = laid.join(shares, ["src", "part"] if hubs else "src").select(
        F.col("dst").alias("id"), F.when(F.col("stays"), 0.0).otherwise(F.col("flow")).alias("flow"), of_node("degree"), of_node("parts"))
    return flows.groupBy("id").agg(
        F.max("degree").alias("degree"), F.max("parts").alias("parts"), (F.lit(base) + F.sum("flow") * damping).alias("rank"))


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    key: str,
    src: str,
    dst: str,
    rounds: int = 20,
    damping: float = 0.85,
    spread: int = SPREAD,
) -> DataFrame:
    """``id, pagerank`` after ``rounds`` power iterations over undirected edges.

    Ranks start even; what vertices without neighbours hold is not handed on.
    One round is one join and one aggregate: the vertices travel through the
    aggregate with a zero flow, so none is lost and no second join is needed.
    Edges are laid out before the first round by source: the aggregate leaves the ranks
    where the edges are, and a round moves flows only. If a vertex has more than ``spread`` edges, they
    are laid out by source and part: a vertex has
    one part per ``spread`` edges, picked by a hash of the other end, and its
    rank is sent to each of its parts. So the edges of a hub lie on many tasks.
    """
    links = settle(both_ways(edges, src, dst))
    degrees = links.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    parts = F.ceil(F.col("degree") / spread).cast("int")
    ids = vertices.select(F.col(key).alias("id"))
    nodes = ids.join(degrees, F.col("id") == F.col("src"), "left").select(
        "id", "degree", F.coalesce(parts, F.lit(1)).alias("parts"))
    nodes = settle(nodes)
    total, parts = nodes.agg(F.count(F.lit(1)), F.max("parts")).first()
    hubs = (parts or 1) > 1
    # Laid out once; a lost part is read again from `links`.
    laid = _laid_out(nodes, links, hubs)
    state = nodes.withColumn("rank", F.lit(1.0 / total if total else 0.0))
    for number in range(1, rounds + 1):
        state = _handed_on(state, laid, hubs, (1 - damping) / max(total, 1), damping)
        if number % CUT_EVERY == 0 or number == rounds:
            state = settle(state)
    laid.unpersist()
    return state.select("id", F.col("rank").alias("pagerank"))


def centrality(vertices: DataFrame, edges: DataFrame, key: str, src: str, dst: str, **options) -> DataFrame:
    """Vertices with their rank value and position, most central first, ties by id."""
    scored = pagerank(vertices, edges, key, src, dst, **options)
    scored = scored.withColumn("_score", F.round("pagerank", RANK_DECIMALS))
    placed = ranked(scored, [F.desc("_score"), F.asc("id")], "ranking")
    placed = placed.select(F.col("id").alias("_id"), "pagerank", "ranking")
    return vertices.join(placed, F.col(key) == F.col("_id")).drop("_id")


def _distances(starts: DataFrame, links: DataFrame) -> DataFrame:
    """``source, id, minutes, round, prev``: the best label of every vertex that a source reaches, with the stops on its way as ``round``.

    A round joins the labels of the round before, the frontier, with the
    edges, and keeps what betters the vertex. Every round's labels are a folder of their own, so
    the frontier is read alone; new labels are held against the old ones of the same vertices only. A label does not go back
    where it came from: that way is never better.
    """
    spark = links.sparkSession

    def stored(rows: DataFrame) -> tuple[DataFrame, int]:
        counted = Observation()
        kept = settle(rows.observe(counted, F.count(F.lit(1)).alias("n")))
        return kept, counted.get["n"]

    frontier, grown = stored(starts.withColumn("round", F.lit(0)))
    known, number = [frontier], 0
    while grown:
        number += 1
        step = frontier.join(links, F.col("id") == F.col("src")).filter(F.col("prev").isNull() | (F.col("dst") != F.col("prev")))
        step = step.select(
            "source", F.col("dst").alias("id"), F.struct((F.col("minutes") + F.col("weight")).alias("minutes"), F.col("src").alias("prev")).alias("new"))
        best, grown = stored(step.groupBy("source", "id").agg(F.min("new").alias("new")))
        if not grown:
            break
        old = reduce(DataFrame.unionByName, known).select("source", "id", "minutes")
        met = old.join(best.select("source", "id"), ["source", "id"]).groupBy("source", "id").agg(F.min("minutes").alias("held"))
        held = best.join(met, ["source", "id"], "left")
        better = held.filter(F.col("held").isNull() | (F.col("new.minutes") < F.col("held")))
        frontier, grown = stored(better.select("source", "id", "new.minutes", "new.prev", F.lit(number).alias("round")))
        known.append(frontier)
        if len(known) > FOLDERS:
            known = [settle(reduce(DataFrame.unionByName, known))]
    every = reduce(DataFrame.unionByName, known)
    best = F.min(F.struct("minutes", "round", "prev")).alias("best")
    return every.groupBy("source", "id").agg(best).select("source", "id", "best.*")


def _traced(final: DataFrame, names: DataFrame, rounds: int) -> DataFrame:
    """``source, id, minutes, ids, names``: the stops on the way, put together from predecessors by pointer doubling.

    Each row holds the end of its route and the vertex before that end; joining it with that
    vertex's row doubles what it holds.
    """
    rows = settle(final.join(names, "id").select(
        "source", "id", "minutes", F.col("prev").alias("before"), F.array("id").alias("ids"), F.array("name").alias("names")))
    reach = 1
    while reach < rounds + 1:
        other = rows.select(
            "source", F.col("id").alias("before"), F.col("before").alias("_before"), F.col("ids").alias("_ids"), F.col("names").alias("_names"))
        longer = rows.filter(F.col("before").isNotNull()).join(other, ["source", "before"]).select(
            "source", "id", "minutes", F.col("_before").alias("before"), F.concat("_ids", "ids").alias("ids"),
            F.concat("_names", "names").alias("names"))
        rows = settle(rows.filter(F.col("before").isNull()).unionByName(longer))
        reach *= 2
    return rows.drop("before")


def route_lengths(vertices: DataFrame, edges: DataFrame, key: str, src: str, dst: str, weight: str, sources: DataFrame) -> DataFrame:
    """``source, id, minutes, stops, prev`` of the routes that ``shortest_routes`` finds, without putting them together.

    A label of some round has a way of as many edges, and so have the final labels: what stands before
    the last stop of a final label is final, too.
    """
    spark = vertices.sparkSession
    ids = vertices.select(F.col(key).alias("id"))
    links = both_ways(edges, src, dst, weight).join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")
    links = settle(links.groupBy("src", "dst").agg(F.min("weight").alias("weight")))
    # Laid out once by source, so that a round moves labels only; a lost part is read again from the settled table.
    links = links.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "src").persist(StorageLevel.MEMORY_AND_DISK)
    starts = ids.join(sources.select(F.col(key).alias("id")).distinct(), "id", "left_semi").select(
        F.col("id").alias("source"), "id", F.lit(0).cast(links.schema["weight"].dataType).alias("minutes"),
        F.lit(None).cast(ids.schema["id"].dataType).alias("prev"))
    try:
        return _distances(starts, links).withColumnRenamed("round", "stops")
    finally:
        links.unpersist()


def shortest_routes(
    vertices: DataFrame,
    edges: DataFrame,
    key: str,
    name: str,
    src: str,
    dst: str,
    weight: str,
    sources: DataFrame,
) -> DataFrame:
    """Fastest route from every source to every vertex it reaches, with the stops on the way.

    ``sources`` is a frame with the ``key`` column; the result is as large as the
    pairs of sources and vertices. Rows of distance and predecessor are bettered edge by edge, from the
    frontier of the round before, until nothing gets better; routes are put together once, at the end. Of equally fast routes the
    one with fewer stops stays, of those the one whose stop before the last has the least id, and so on backwards.
    Weights must not be negative.
    """
    ids = vertices.select(F.col(key).alias("id"), F.col(name).alias("name"))
    final = settle(route_lengths(vertices, edges, key, src, dst, weight, sources))
    rounds = final.agg(F.max("stops")).first()[0] or 0
    return _traced(final.drop("stops"), ids, rounds)


def route_table(routes: DataFrame) -> DataFrame:
    """Origin, destination, minutes and stops; a vertex is no route to itself."""
    return routes.filter(F.col("source") != F.col("id")).select(
        F.get("names", F.lit(0)).alias("origen"),
        F.col("source").alias("origen_id"),
        F.element_at("names", -1).alias("destino"),
        F.col("id").alias("destino_id"),
        F.col("minutes").cast("int").alias("tiempo_min"),
        (F.size("ids") - 1).alias("num_paradas"),
        F.col("ids").alias("ruta_ids"),
        F.col("names").alias("ruta_nombres"),
    )
