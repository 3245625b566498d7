"""Customers as a tree of stations: each key is joined to half of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialis.operators import graph, reports
from vialis.operators.ranking import first_rows
from vialis.questions.base import table, with_shown

ROUNDS = 20


def stations(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")


def links(spark, sf_dir):
    """Minutes follow the nation; the root has no link to itself."""
    return stations(spark, sf_dir).filter(F.col("c_custkey") > 0).select(
        "c_custkey", F.floor(F.col("c_custkey") / 2).alias("padre"), (F.col("c_nationkey") % 5 + 1).alias("minutos"))


def pagerank(spark, sf_dir):
    """Ranks are scaled by the number of stations, so that six decimals tell them apart."""
    found = graph.centrality(stations(spark, sf_dir), links(spark, sf_dir), "c_custkey", "c_custkey", "padre", rounds=ROUNDS)
    size = stations(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")).scalar()
    scaled = found.withColumn("pagerank", F.col("pagerank") * size)
    return with_shown(scaled, "pagerank").select("c_custkey", "c_name", "pagerank", "ranking")


def most_central(spark, sf_dir):
    return reports.most_central(pagerank(spark, sf_dir))


def landmarks(spark, sf_dir):
    """The station with the largest balance of each segment."""
    best = stations(spark, sf_dir).groupBy("c_mktsegment").agg(F.max(F.struct("c_acctbal", "c_custkey")).alias("b"))
    return best.select("b.c_custkey")


def routes(spark, sf_dir):
    found = graph.shortest_routes(
        stations(spark, sf_dir), links(spark, sf_dir), "c_custkey", "c_name", "c_custkey", "padre", "minutos",
        sources=landmarks(spark, sf_dir))
    return graph.route_table(found)


def lengths(spark, sf_dir):
    """Minutes and stops of the routes, which need not be put together for that."""
    found = graph.route_lengths(
        stations(spark, sf_dir), links(spark, sf_dir), "c_custkey", "c_custkey", "padre", "minutos", sources=landmarks(spark, sf_dir))
    return found.filter("source <> id").select(
        F.col("source").alias("origen_id"), F.col("id").alias("destino_id"), F.col("minutes").cast("int").alias("tiempo_min"),
        F.col("stops").alias("num_paradas"))


def shortest_routes(spark, sf_dir):
    text = lambda c: F.concat_ws(",", F.col(c).cast("array<string>")).alias(c)
    return routes(spark, sf_dir).select(
        "origen", "origen_id", "destino", "destino_id", "tiempo_min", "num_paradas", text("ruta_ids"), text("ruta_nombres"))


def longest_routes(spark, sf_dir):
    order = [F.desc("tiempo_min"), F.asc("origen_id"), F.asc("destino_id")]
    found = first_rows(lengths(spark, sf_dir), order, 5)
    for end in ("origen", "destino"):
        names = stations(spark, sf_dir).select(F.col("c_custkey").alias(f"{end}_id"), F.col("c_name").alias(end))
        found = found.join(names, f"{end}_id")
    return found.select("origen", "destino", "tiempo_min", "num_paradas")


def degrees(spark, sf_dir):
    both = graph.both_ways(links(spark, sf_dir), "c_custkey", "padre")
    return both.groupBy(F.col("src").alias("c_custkey")).agg(F.count(F.lit(1)).alias("vecinos"))


QUERIES = {q.__name__: q for q in (pagerank, most_central, shortest_routes, longest_routes, degrees)}

_GRAPH = """links AS (
    SELECT c_custkey AS a, c_custkey // 2 AS b, CAST(c_nationkey % 5 + 1 AS INTEGER) AS w FROM customer WHERE c_custkey > 0),
  both_ways AS (SELECT a AS src, b AS dst, w FROM links UNION ALL SELECT b, a, w FROM links)"""
_RANKS = ["r0 AS (SELECT c_custkey AS id, 1.0e0 / (SELECT count(*) FROM customer) AS p FROM customer)"] + [
    f"""r{i} AS MATERIALIZED (SELECT c_custkey AS id, 0.15e0 / (SELECT count(*) FROM customer) + 0.85e0 * coalesce(f, 0) AS p
    FROM customer LEFT JOIN (SELECT dst, sum(p / d) AS f FROM both_ways JOIN r{i - 1} ON src = id JOIN deg USING (src) GROUP BY 1)
    ON c_custkey = dst)""" for i in range(1, ROUNDS + 1)]
_PAGERANK = f"""WITH {_GRAPH}, deg AS (SELECT src, count(*) AS d FROM both_ways GROUP BY 1), {', '.join(_RANKS)},
  ranked AS (SELECT c_custkey, c_name, CAST(round(CAST(p * (SELECT count(*) FROM customer) AS DECIMAL(28,9)), 6) AS DOUBLE) AS pagerank,
    CAST(row_number() OVER (ORDER BY round(p, 12) DESC, id) AS INTEGER) AS ranking FROM r{ROUNDS} JOIN customer ON id = c_custkey)"""
_ROUTES = f"""WITH RECURSIVE {_GRAPH},
  marks AS (SELECT arg_max(c_custkey, (c_acctbal, c_custkey)) AS s FROM customer GROUP BY c_mktsegment),
  walk AS (
    SELECT s, s AS v, CAST(-1 AS BIGINT) AS prev, 0 AS t, 0 AS k, [s] AS ids FROM marks
    UNION ALL SELECT s, dst, v, t + w, k + 1, list_append(ids, dst) FROM walk JOIN both_ways ON v = src WHERE dst <> prev),
  routes AS (
    SELECT o.c_name AS origen, s AS origen_id, d.c_name AS destino, v AS destino_id, CAST(t AS INTEGER) AS tiempo_min,
           k AS num_paradas, ids FROM walk JOIN customer o ON o.c_custkey = s JOIN customer d ON d.c_custkey = v WHERE s <> v)"""

SQL = {
    "pagerank": f"{_PAGERANK} SELECT * FROM ranked",
    "most_central": f"{_PAGERANK} SELECT * FROM ranked ORDER BY ranking LIMIT 10",
    "shortest_routes": f"""{_ROUTES} SELECT * EXCLUDE (ids), array_to_string(ids, ',') AS ruta_ids,
        array_to_string([printf('Customer#%09d', i) for i in ids], ',') AS ruta_nombres FROM routes""",
    "longest_routes": f"""{_ROUTES} SELECT origen, destino, tiempo_min, num_paradas FROM routes
        ORDER BY tiempo_min DESC, origen_id, destino_id LIMIT 5""",
    "degrees": f"WITH {_GRAPH} SELECT src AS c_custkey, count(*) AS vecinos FROM both_ways GROUP BY 1",
}
