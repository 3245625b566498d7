"""Customers as points and stations, nations as polygons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialis.functions.geo import (
    in_valid_area, pair_from_brackets, pair_from_dict_text, pair_from_pipe, repair_swapped,
)
from vialis.functions.privacy import pseudonymise
from vialis.functions.text import belongs_to_network, boundary_kind, is_interchange, is_official_boundary, plain_columns
from vialis.operators.quality import require_columns
from vialis.operators.ranking import running_total
from vialis.operators.rings import polygon_features, rings_of_relations
from vialis.operators.spatial import area_or_text, assign_area
from vialis.questions.base import table
from vialis.session import settle

KEY = "clave-de-muestra"


def coordinate_text(spark, sf_dir):
    """Coordinates as text in three notations; nations below five have the pair swapped."""
    lon = F.concat(F.lit("-75."), F.lpad((F.col("c_custkey") * 7919 % 10000).cast("string"), 4, "0"))
    lat = F.concat(F.when(F.col("c_mktsegment") == "BUILDING", F.lit("7.")).otherwise(F.lit("6.")),
                   F.lpad((F.col("c_custkey") * 104729 % 10000).cast("string"), 4, "0"))
    swapped = F.col("c_nationkey") < 5
    first, second = F.when(swapped, lat).otherwise(lon), F.when(swapped, lon).otherwise(lat)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("[sin, dato]")).otherwise(
            F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]"))).alias("corchetes"),
        F.concat(first, F.lit("|"), second).alias("barra"),
        F.concat(F.lit("{'lon': '"), first, F.lit("', 'lat': '"), second, F.lit("'}")).alias("texto"),
    )


def coord_repair(spark, sf_dir):
    rows = coordinate_text(spark, sf_dir).select(
        "c_custkey", *[repair_swapped(parse(F.col(c))).alias(c) for c, parse in (
            ("corchetes", pair_from_brackets), ("barra", pair_from_pipe), ("texto", pair_from_dict_text))]
    )
    inside = rows.filter(in_valid_area(F.col("barra.lon"), F.col("barra.lat")))
    return inside.select(
        "c_custkey", F.col("corchetes.lon").alias("lon"), F.col("corchetes.lat").alias("lat"),
        F.col("barra.lon").alias("lon_barra"), F.col("barra.lat").alias("lat_barra"),
        F.col("texto.lon").alias("lon_texto"), F.col("texto.lat").alias("lat_texto"),
    )


def nation_polygons(spark, sf_dir):
    """Whole-number polygons: even nations are L-shaped, odd ones squares that overlap the next cell.

    Every third nation is a MultiPolygon with one part.
    """
    x, y = (F.col("n_nationkey") % 5) * 150, F.floor(F.col("n_nationkey") / 5) * 180
    at = lambda dx, dy: F.format_string("[%d,%d]", x + dx, y + dy)
    ell = F.concat_ws(",", *[at(*p) for p in ((0, 0), (140, 0), (140, 60), (60, 60), (60, 170), (0, 170), (0, 0))])
    square = F.concat_ws(",", *[at(*p) for p in ((0, 0), (200, 0), (200, 200), (0, 200), (0, 0))])
    ring = F.concat(F.lit("[["), F.when(F.col("n_nationkey") % 2 == 0, ell).otherwise(square), F.lit("]]"))
    is_multi = F.col("n_nationkey") % 3 == 0
    shape = F.when(is_multi, F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), ring, F.lit("]}"))).otherwise(
        F.concat(F.lit('{"type":"Polygon","coordinates":'), ring, F.lit("}")))
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", shape.alias("geometria"))


def points(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment",
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", (F.col("c_custkey") * 7919 % 900) + 0.5).alias("lon"),
        ((F.col("c_custkey") * 104729 % 1000) + 0.5).alias("lat"),
    )


def _placed(spark, sf_dir, order="n_nationkey"):
    polygons = nation_polygons(spark, sf_dir).withColumn("lugar", order if isinstance(order, Column) else F.col(order))
    found = assign_area(points(spark, sf_dir), polygons, "lon", "lat", "n_name", "geometria", "lugar",
                        alias="comuna_geo", cell=60.0)
    return found.withColumn("comuna", area_or_text("comuna_geo", "c_mktsegment"))


def area_of_point(spark, sf_dir):
    return _placed(spark, sf_dir)


def area_of_point_by_shuffle(spark, sf_dir):
    """The same question with no side small enough to be sent around."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return settle(_placed(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def area_of_point_ties(spark, sf_dir):
    """Polygons that share their place in the order, or have none: by name, and last."""
    return _placed(spark, sf_dir, F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey") % 3))


def pseudonyms(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("id_usuario"))
    return pseudonymise(rows, "id_usuario", KEY)


def column_names(spark, sf_dir):
    """Headers with capitals, accents, blanks, dots and slashes, made plain."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("Señal Devolución"), F.col("l_quantity").alias("Cantidad.Total/Día"))
    plain = require_columns(plain_columns(rows), ["senal_devolucion", "cantidad_total_dia"])
    return plain.groupBy("senal_devolucion").agg(F.sum(F.col("cantidad_total_dia").cast("bigint")).alias("cantidad_total_dia"))


RURAL = ("Altavista", "Santa Elena", "San Cristóbal", "Otro Lugar")


def boundary_rules(spark, sf_dir):
    """Division names and levels made of customers, kept and labelled by the official rules."""
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("comuna "), F.col("c_nationkey").cast("string"), F.lit(" - A"))).when(
        F.col("c_mktsegment") == "MACHINERY", F.lit("Comuna Sur")).otherwise(
        F.element_at(F.array(*[F.lit(r) for r in RURAL]), F.col("c_nationkey") % 4 + 1))
    level = F.element_at(F.array(F.lit("7"), F.lit("8"), F.lit("9")), (F.col("c_custkey") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", name.alias("nombre"), level.alias("admin_level"))
    return rows.filter(is_official_boundary(F.col("nombre"), F.col("admin_level"))).withColumn(
        "tipo", boundary_kind(F.col("admin_level")))


def station_rules(spark, sf_dir):
    """Stations of one network, numbered in key order, with a capacity where none is readable."""
    rows = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_nationkey") == 3, F.lit("  ")).when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("BiciRed "), "s_name"))
        .otherwise(F.col("s_name")).alias("nombre"),
        F.when(F.col("s_nationkey") < 8, F.lit("Red BICIRED")).when(F.col("s_nationkey") < 14, F.lit("otra red")).alias("red"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey").cast("string")).otherwise(F.lit("?")).alias("capacidad"),
    )
    chosen = rows.filter(belongs_to_network(F.col("nombre"), F.col("red"), "bicired"))
    numbered = running_total(chosen, [], [F.asc("s_suppkey")], alias="_id")
    return numbered.select(
        F.col("_id").cast("bigint").alias("_id"), F.concat(F.lit("ENC"), F.lpad(
            F.col("_id").cast("string"), F.greatest(F.lit(3), F.length(F.col("_id").cast("string"))), F.lit("0"))).alias("estacion_id"),
        F.trim("nombre").alias("nombre"),
        F.coalesce(F.col("capacidad").try_cast("int"), F.lit(12)).alias("capacidad_anclajes"),
    )


# East of a customer's first square stands a second one.
SECOND = 20


def way_members(spark, sf_dir):
    """Each customer two squares of four ways each, listed out of order and with the third one reversed."""
    x, y = F.col("c_custkey") % 100, F.floor(F.col("c_custkey") / 100)
    corners = {0: (0, 0), 1: (10, 0), 2: (10, 10), 3: (0, 10)}
    ways = [(0, 0, 1), (1, 2, 3), (2, 2, 1), (3, 3, 0)]
    member = lambda seq, a, b, east: F.struct(
        F.lit(seq + 4 * (east > 0)).alias("seq"),
        F.array(*[(x + corners[p][0] + east).cast("double") for p in (a, b)]).alias("lons"),
        F.array(*[(y + corners[p][1]).cast("double") for p in (a, b)]).alias("lats"),
    )
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("relation_id"), F.explode(F.array(*[member(*w, e) for e in (0, SECOND) for w in ways])).alias("m"))
    return rows.select("relation_id", F.lit("way").alias("type"), F.lit("outer").alias("role"), "m.*")


def rings(spark, sf_dir):
    found = rings_of_relations(way_members(spark, sf_dir))
    return found.select("relation_id", "role", "part", F.transform("ring", lambda p: F.concat_ws(
        " ", p[0].cast("int").cast("string"), p[1].cast("int").cast("string"))).alias("_r")).select(
        "relation_id", "role", "part", F.concat_ws(",", "_r").alias("anillo"))


def ring_features(spark, sf_dir):
    """Features of two squares each: how many polygons, and the points of each."""
    relations = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("relation_id"), F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") < 9, F.lit("7")).otherwise(F.lit("8")).alias("admin_level"),
        F.lit(None).cast("string").alias("alt_name"), F.lit("es:Lugar").alias("wikipedia"))
    features = polygon_features(relations, way_members(spark, sf_dir))
    parts = F.from_json("geometry_geojson", "coordinates array<array<array<array<double>>>>")["coordinates"]
    return features.withColumns({
        "forma": F.get_json_object("geometry_geojson", "$.type"), "partes": F.size(parts), "puntos": F.size(parts[1][0]),
    }).drop("geometry_geojson")


def interchange_lines(spark, sf_dir):
    """Nations on more than one line, written ``A/B``, with their customers."""
    line = F.when(F.col("c_nationkey") % 2 == 0, F.lit("A/B")).otherwise(F.lit("A"))
    rows = table(spark, sf_dir, "customer").select("c_nationkey", line.alias("linea"))
    return rows.filter(is_interchange(F.col("linea"))).groupBy("c_nationkey", "linea").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {q.__name__: q for q in (
    coord_repair, area_of_point, area_of_point_by_shuffle, area_of_point_ties, pseudonyms, column_names, boundary_rules, station_rules,
    rings, ring_features, interchange_lines,
)}

_SHAPES = """points AS (
    SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN (c_custkey * 7919 % 900) + 0.5e0 END AS lon,
           (c_custkey * 104729 % 1000) + 0.5e0 AS lat FROM customer),
  corners AS (
    SELECT n_nationkey, n_name, unnest(generate_series(1, len(p))) AS i, unnest(p) AS c, len(p) AS n FROM (
      SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 2 = 0
        THEN [[0,0],[140,0],[140,60],[60,60],[60,170],[0,170]] ELSE [[0,0],[200,0],[200,200],[0,200]] END AS p FROM nation)),
  spots AS (SELECT n_nationkey, n_name, i, n, c[1] + (n_nationkey % 5) * 150.0e0 AS x, c[2] + (n_nationkey // 5) * 180.0e0 AS y FROM corners),
  edges AS (SELECT a.n_nationkey, a.n_name, a.x AS x0, a.y AS y0, b.x AS x1, b.y AS y1
    FROM spots a JOIN spots b ON a.n_nationkey = b.n_nationkey AND b.i = a.i % a.n + 1),
  crossings AS (
    SELECT c_custkey, n_nationkey, n_name FROM points, edges
    WHERE (y0 > lat) <> (y1 > lat) AND lon < (x1 - x0) * (lat - y0) / (y1 - y0) + x0),
  inside AS (
    SELECT c_custkey, arg_min(n_name, n_nationkey) AS comuna_geo FROM (
      SELECT c_custkey, n_nationkey, n_name FROM crossings GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY 1)"""
_AREA = f"""WITH {_SHAPES}
    SELECT c_custkey, c_mktsegment, lon, lat, comuna_geo, coalesce(comuna_geo, c_mktsegment) AS comuna
    FROM points LEFT JOIN inside USING (c_custkey)"""
_LUGAR = "CASE WHEN n_nationkey % 4 <> 0 THEN n_nationkey % 3 END"
_AREA_TIES = _AREA.replace("arg_min(n_name, n_nationkey)", f"arg_min(n_name, ({_LUGAR} IS NULL, coalesce({_LUGAR}, 0), n_name))")


def _pad(byte: int) -> str:
    return bytes(b ^ byte for b in KEY.encode().ljust(64, b"\0")).hex()


SQL = {
    "coord_repair": """WITH t AS (
        SELECT c_custkey, c_mktsegment, CAST('-75.' || lpad(CAST(c_custkey * 7919 % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS lon,
               CAST('6.' || lpad(CAST(c_custkey * 104729 % 10000 AS VARCHAR), 4, '0') AS DOUBLE) AS lat
        FROM customer WHERE c_mktsegment <> 'BUILDING')
        SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN lon END AS lon,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN lat END AS lat, lon AS lon_barra, lat AS lat_barra,
               lon AS lon_texto, lat AS lat_texto FROM t WHERE lon BETWEEN -76 AND -75 AND lat BETWEEN 5.7 AND 6.7""",
    "area_of_point": _AREA,
    "area_of_point_by_shuffle": _AREA,
    "area_of_point_ties": _AREA_TIES,
    "pseudonyms": f"""SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN
        sha256(unhex('{_pad(0x5C)}') || unhex(sha256(unhex('{_pad(0x36)}') || encode(c_name)))) END AS usuario_pseudo FROM customer""",
    "column_names": """SELECT l_returnflag AS senal_devolucion, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS cantidad_total_dia
        FROM lineitem GROUP BY 1""",
    "boundary_rules": """WITH t AS (
        SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'comuna ' || c_nationkey || ' - A' WHEN 'MACHINERY' THEN 'Comuna Sur'
               ELSE ['Altavista', 'Santa Elena', 'San Cristóbal', 'Otro Lugar'][c_nationkey % 4 + 1] END AS nombre,
               ['7', '8', '9'][c_custkey % 3 + 1] AS admin_level FROM customer)
        SELECT *, CASE WHEN admin_level = '7' THEN 'corregimiento' ELSE 'comuna' END AS tipo FROM t
        WHERE (nombre IN ('Altavista', 'Santa Elena', 'San Cristóbal') AND admin_level IN ('7', '8'))
           OR (admin_level = '8' AND regexp_matches(nombre, '^(?i:comuna)\\s+\\d+'))""",
    "station_rules": """WITH t AS (
        SELECT s_suppkey, CASE WHEN s_nationkey = 3 THEN '' WHEN s_nationkey % 2 = 0 THEN 'BiciRed ' || s_name ELSE s_name END AS nombre,
               CASE WHEN s_nationkey < 8 THEN 'red bicired' WHEN s_nationkey < 14 THEN 'otra red' ELSE '' END AS red,
               CASE WHEN s_acctbal > 5000 THEN s_nationkey ELSE 12 END AS capacidad_anclajes FROM supplier),
      k AS (SELECT *, row_number() OVER (ORDER BY s_suppkey) AS _id FROM t WHERE nombre <> ''
            AND CASE WHEN red <> '' THEN contains(red, 'bicired') ELSE contains(lower(nombre), 'bicired') END)
        SELECT _id, printf('ENC%03d', _id) AS estacion_id, nombre, CAST(capacidad_anclajes AS INTEGER) AS capacidad_anclajes FROM k""",
    "rings": """WITH t AS (SELECT c_custkey AS relation_id, CAST(part AS INTEGER) AS part, c_custkey % 100 + 20 * part AS x,
               c_custkey // 100 AS y FROM customer, (SELECT unnest([0, 1]) AS part))
        SELECT relation_id, 'outer' AS role, part, x || ' ' || y || ',' || (x + 10) || ' ' || y || ',' || (x + 10) || ' ' || (y + 10)
               || ',' || x || ' ' || (y + 10) || ',' || x || ' ' || y AS anillo FROM t""",
    "ring_features": """SELECT c_custkey AS osm_id, c_name AS nombre, CASE WHEN c_nationkey < 9 THEN 'corregimiento' ELSE 'comuna' END AS tipo,
        CASE WHEN c_nationkey < 9 THEN '7' ELSE '8' END AS admin_level, '' AS nombre_alt, 'es:Lugar' AS wikipedia,
        'MultiPolygon' AS forma, 2 AS partes, 5 AS puntos FROM customer""",
    "interchange_lines": "SELECT c_nationkey, 'A/B' AS linea, count(*) AS n FROM customer WHERE c_nationkey % 2 = 0 GROUP BY 1",
}
