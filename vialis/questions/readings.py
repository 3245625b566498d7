"""Events as sensor readings and stored alerts; mixed traffic counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.calendar import floor_minutes, floor_seconds
from vialis.functions.measures import vehicle_total
from vialis.functions.messages import AIR_SCHEMA, air_message, corridor_message, decode
from vialis.functions.text import zone_of
from vialis.operators import quality, reports, reshape, rollups
from vialis.operators.windows import latest_before
from vialis.questions.base import events, local_times, sql_shown, table, with_shown
from vialis.sources.files import typed_readings
from vialis.streaming.alerts import air_alerts, line_snapshots

# Municipality a market segment stands for.
TOWNS = {"BUILDING": "Bello", "MACHINERY": "Itagüí", "HOUSEHOLD": "Medellín", "FURNITURE": "Caldas"}
LINES = ("click", "error", "purchase", "signup", "view")


def readings(spark, sf_dir, kind, variable):
    """Long text readings per hour and user; values below one are the sentinel, some times are unreadable."""
    rows = table(spark, sf_dir, "events").filter(F.col("event_type") == kind)
    return rows.select(
        F.when(F.col("value") >= 300, F.lit("sin fecha")).otherwise(
            F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.col("user_id").cast("string").alias("estacion_id"),
        F.lit(variable).alias("variable"),
        F.when(F.col("value") < 1, F.lit("-999")).otherwise(F.col("value").cast("string")).alias("valor"),
    )


def stations(spark, sf_dir):
    town = F
    for segment, name in TOWNS.items():
        town = town.when(F.col("c_mktsegment") == segment, F.lit(name))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("estacion_id"), F.col("c_name").alias("estacion_nombre"),
        town.alias("municipio"),
    )


def sensor_wide(spark, sf_dir):
    """Two long sources stacked, cleared of the sentinel, made wide and met with the station dimension."""
    long = typed_readings(readings(spark, sf_dir, "view", "pm25").unionByName(readings(spark, sf_dir, "click", "pm10")))
    clean = quality.clear_sentinels(long, ["valor"])
    wide = rollups.long_to_wide(clean, ["timestamp", "estacion_id"], "variable", ["pm25", "pm10"], "valor")
    joined = wide.join(stations(spark, sf_dir), "estacion_id", "left")
    joined = joined.withColumn("zona", zone_of(F.col("municipio")))
    filled = quality.fill_absent(joined, {"temperatura_c": "double", "municipio": "string"})
    return local_times(with_shown(filled, "pm25", "pm10"), "timestamp")


def sentinel_clean(spark, sf_dir):
    marked = table(spark, sf_dir, "events").withColumn(
        "pm25", F.when(F.col("event_type") == "error", F.lit(v.SENTINEL)).otherwise(F.col("value") - 5)
    )
    valid = quality.valid_readings(quality.clear_sentinels(marked, ["pm25", "pm10"]), "pm25")
    return with_shown(valid.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("pm25").alias("media")), "media")


def stations_to_long(spark, sf_dir):
    """One column per event type as stations, blank where a user had none that hour."""
    rows = table(spark, sf_dir, "events").select(
        F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd HH:mm:ss").alias("fecha_hora"), "event_type", "value")
    wide = rollups.long_to_wide(rows, ["fecha_hora"], "event_type", LINES, "value")
    text = wide.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in LINES})
    return with_shown(reshape.stations_to_rows(text, "fecha_hora", "pm25"), "valor")


def latest_reading_asof(spark, sf_dir):
    """Each view with the newest error value at or before it."""
    rows = table(spark, sf_dir, "events")
    left = rows.filter(F.col("event_type") == "view").select("event_id", "ts")
    right = rows.filter(F.col("event_type") == "error").select("ts", F.col("value").alias("lluvia"))
    return latest_before(left, right, "ts", "lluvia")


def latest_per_entity(spark, sf_dir):
    return quality.latest_per_entity(table(spark, sf_dir, "events"), ["user_id"], "ts")


def dedupe_latest(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return quality.one_per_key(items, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate")], last=True)


def floored_times(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        floor_minutes(F.col("ts"), 10).alias("diez"), floor_seconds(F.col("ts"), 30).alias("treinta"))
    counted = rows.groupBy("diez").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("treinta").alias("pasos"))
    return local_times(counted, "diez")


def json_fields(spark, sf_dir):
    """The JSON column as typed fields; air messages with blank and unreadable numbers."""
    number = F.from_json("props", "k string")["k"]
    message = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("estacion_id"),
        F.when(F.col("event_type") == "error", F.lit("n/d")).when(F.col("event_type") == "view", F.lit("")).otherwise(number).alias("pm25"),
        number.alias("pm10"),
    ))
    # Broken text and messages without a station are dropped.
    value = F.when(F.col("event_type") == "signup", F.lit("{no json")).otherwise(message)
    rows = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    typed = air_message(decode(rows, AIR_SCHEMA, key="estacion_id"))
    return typed.select("event_id", "estacion_id", "pm25", "pm10")


def mixed_schema_union(spark, sf_dir):
    """Manual counts and camera counts of two schemas in one table, brought to common columns."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    manual = orders.select(
        F.concat(F.lit("Calle "), F.col("o_custkey").cast("string")).alias("via_principal"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("fecha_hora"),
        F.substring("o_orderpriority", 1, 1).alias("autos"),
        F.when(F.col("o_orderstatus") == "F", F.lit("x")).otherwise(F.lit("2")).alias("buses"),
        F.lit("1").alias("camiones"), F.lit(None).cast("string").alias("motos"),
    ).withColumn("tipo_aforo", F.lit("manual"))
    camera = items.select(
        F.concat(F.lit("Carrera "), F.col("l_suppkey").cast("string")).alias("corredor"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("fechahora"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(
            F.col("l_quantity").cast("int").cast("string")).alias("intensidad"),
    ).withColumn("tipo_aforo", F.lit("camara"))
    both = manual.unionByName(camera, allowMissingColumns=True)
    common = both.select(
        "tipo_aforo", F.coalesce("via_principal", "corredor").alias("corredor"),
        F.coalesce(*[F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd") for c in ("fecha_hora", "fechahora")]).alias("fecha"),
        vehicle_total(F.col("tipo_aforo"), [F.col(c) for c in ("autos", "buses", "camiones", "motos")],
                      F.col("intensidad")).alias("vehiculos"),
    ).filter(F.col("vehiculos").isNotNull())
    return common.groupBy("tipo_aforo", "corredor", F.year("fecha").alias("anio")).agg(
        F.sum("vehiculos").alias("vehiculos"), F.count(F.lit(1)).alias("n"))


def corridor_messages(spark, sf_dir):
    """Camera rows as traffic messages with trimmed names, defaults and a parsed place."""
    items = table(spark, sf_dir, "lineitem")
    quantity = F.col("l_quantity").cast("int").cast("string")
    rows = items.select(
        F.when(F.col("l_linestatus") == "F", F.lit("")).otherwise(
            F.concat(F.lit(" Carrera "), F.col("l_suppkey").cast("string"), F.lit(" "))).alias("corredor"),
        F.lit(None).cast("string").alias("dispositivo"),
        F.concat(F.lit("{'lon': '-75.5', 'lat': '6."), F.col("l_linenumber").cast("string"), F.lit("'}")).alias("location"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("fechahora"),
        F.when(F.col("l_returnflag") == "R", F.lit("0")).otherwise(quantity).alias("intensidad"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(F.lit("12.5")).alias("velocidad"),
        F.lit("n/d").alias("ocupacion"),
    )
    return corridor_message(rows).groupBy("corredor", "dispositivo", "latitud", "longitud", "velocidad_kmh", "ocupacion_pct").agg(
        F.sum("intensidad").alias("intensidad"), F.count(F.lit(1)).alias("n"))


def alerts(spark, sf_dir):
    """Batch twin of the air alerts; a document counts as emitted when its window ends."""
    found = air_alerts(events(spark, sf_dir), "event_type", "ts", "value")
    return found.withColumnRenamed("event_type", "zona").withColumn("emitido_en", F.col("ventana_fin"))


def newest(spark, sf_dir):
    """The time the questions below count back from: the newest event, as a one-row subquery."""
    return events(spark, sf_dir).agg(F.max("ts").alias("now")).scalar()


def alert_search(spark, sf_dir):
    found = reports.search_alerts(alerts(spark, sf_dir), newest(spark, sf_dir), severity="moderada", last="7d")
    return local_times(found, "ventana_inicio", "ventana_fin", "emitido_en")


def recent_kpis(spark, sf_dir):
    return reports.recent_counts(alerts(spark, sf_dir).withColumn("tipo", F.col("gravedad")), newest(spark, sf_dir), "24h")


def latest_k(spark, sf_dir):
    docs = alerts(spark, sf_dir).withColumn("_id", F.concat_ws("/", F.col("zona"), F.col("ventana_inicio").cast("string")))
    return local_times(reports.latest_documents(docs, "_id", 200), "ventana_inicio", "ventana_fin", "emitido_en")


def series_pivot(spark, sf_dir):
    snapshots = line_snapshots(
        events(spark, sf_dir).withColumn("value", F.col("value").cast("bigint")), "event_type", "ts", "value", "1 hour", "1 hour")
    found = reports.series_by_line(snapshots, list(LINES), "event_type", "pasajeros_acumulados")
    few = reports.series_by_line(snapshots, list(LINES[:2]), "event_type", "pasajeros_acumulados")
    both = found.drop(reports.OTHER_LINES).join(few.select("ventana_inicio", reports.OTHER_LINES), "ventana_inicio")
    return local_times(both, "ventana_inicio")


QUERIES = {q.__name__: q for q in (
    sensor_wide, sentinel_clean, stations_to_long, latest_reading_asof, latest_per_entity, dedupe_latest, floored_times,
    json_fields, mixed_schema_union, corridor_messages, alert_search, recent_kpis, latest_k, series_pivot,
)}

_ALERTS = f"""alerts AS (
    SELECT event_type AS zona, w AS ventana_inicio, w + INTERVAL 10 MINUTES AS ventana_fin,
           {sql_shown('a', 2)} AS pm25_promedio, n AS lecturas_en_ventana, 'ALERTA_PM25' AS tipo,
           CASE WHEN a >= 150 THEN 'critica' WHEN a >= 75 THEN 'moderada' ELSE 'leve' END AS gravedad,
           75.0::DOUBLE AS umbral, w + INTERVAL 10 MINUTES AS emitido_en
    FROM (SELECT event_type, time_bucket(INTERVAL 10 MINUTES, ts) AS w, avg(value) AS a, count(*) AS n
          FROM events WHERE value > 0 GROUP BY 1, 2) WHERE a > 75)"""
_TOWN = "CASE c_mktsegment " + " ".join(f"WHEN '{s}' THEN '{t}'" for s, t in TOWNS.items()) + " END"

SQL = {
    "sensor_wide": f"""WITH wide AS (
        SELECT date_trunc('hour', ts) AS timestamp, CAST(user_id AS VARCHAR) AS estacion_id,
               avg(CASE WHEN value >= 1 THEN value END) FILTER (event_type = 'view') AS pm25,
               avg(CASE WHEN value >= 1 THEN value END) FILTER (event_type = 'click') AS pm10
        FROM events WHERE event_type IN ('view', 'click') AND value < 300 GROUP BY 1, 2),
      st AS (SELECT CAST(c_custkey AS VARCHAR) AS estacion_id, c_name AS estacion_nombre, {_TOWN} AS municipio FROM customer)
        SELECT timestamp, estacion_id, {sql_shown('pm25')} AS pm25, {sql_shown('pm10')} AS pm10, estacion_nombre, municipio,
               CASE WHEN municipio = 'Bello' THEN 'valle_aburra_norte' WHEN municipio IN ('Itagüí', 'Caldas')
                    THEN 'valle_aburra_sur' ELSE 'valle_aburra_centro' END AS zona, CAST(NULL AS DOUBLE) AS temperatura_c
        FROM wide LEFT JOIN st USING (estacion_id)""",
    "sentinel_clean": f"""
        SELECT event_type, count(*) AS n, {sql_shown('avg(value - 5)')} AS media FROM events
        WHERE event_type <> 'error' AND value - 5 > 0 GROUP BY 1""",
    "stations_to_long": f"""
        SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS timestamp, event_type AS estacion_id,
               'pm25' AS variable, {sql_shown('avg(value)')} AS valor FROM events GROUP BY 1, 2""",
    "latest_reading_asof": """
        SELECT l.event_id, l.ts, r.value AS lluvia FROM (SELECT * FROM events WHERE event_type = 'view') l
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') r ON l.ts >= r.ts""",
    "latest_per_entity": """
        SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC, props DESC) AS r FROM events) WHERE r = 1""",
    "dedupe_latest": """
        SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                     l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS r FROM lineitem) WHERE r = 1""",
    "floored_times": """
        SELECT time_bucket(INTERVAL 10 MINUTES, ts) AS diez, count(*) AS n,
               count(DISTINCT time_bucket(INTERVAL 30 SECONDS, ts)) AS pasos FROM events GROUP BY 1""",
    "json_fields": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS estacion_id,
               CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS pm25,
               CAST(json_extract(props, '$.k') AS DOUBLE) AS pm10 FROM events WHERE event_type <> 'signup'""",
    "mixed_schema_union": """
        SELECT 'manual' AS tipo_aforo, 'Calle ' || o_custkey AS corredor, CAST(year(o_orderdate) AS INTEGER) AS anio,
               CAST(sum(CAST(o_orderpriority[1:1] AS INTEGER) + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 2 END + 1) AS BIGINT) AS vehiculos,
               count(*) AS n FROM orders GROUP BY 1, 2, 3
        UNION ALL
        SELECT 'camara', 'Carrera ' || l_suppkey, CAST(year(l_shipdate) AS INTEGER), CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT), count(*)
        FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3""",
    "corridor_messages": """
        SELECT CASE WHEN l_linestatus = 'F' THEN 'DESCONOCIDO' ELSE 'Carrera ' || l_suppkey END AS corredor,
               'CCTV' AS dispositivo, CAST('6.' || l_linenumber AS DOUBLE) AS latitud, -75.5::DOUBLE AS longitud,
               12.5::DOUBLE AS velocidad_kmh, 0 AS ocupacion_pct,
               CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS intensidad, count(*) AS n
        FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL""",
    "alert_search": f"""WITH {_ALERTS}
        SELECT * FROM alerts WHERE gravedad = 'moderada' AND emitido_en >= (SELECT max(ts) FROM events) - INTERVAL 7 DAYS
        ORDER BY ventana_inicio DESC, zona LIMIT 30""",
    "recent_kpis": f"""WITH {_ALERTS}
        SELECT gravedad AS tipo, count(*) AS n FROM alerts
        WHERE emitido_en >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS GROUP BY 1""",
    "latest_k": f"""WITH {_ALERTS}
        SELECT *, zona || '/' || strftime(ventana_inicio, '%Y-%m-%d %H:%M:%S') AS _id FROM alerts
        ORDER BY emitido_en DESC, _id LIMIT 200""",
    "series_pivot": f"""
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ventana_inicio,
               {', '.join(f"CAST(coalesce(sum(CAST(trunc(value) AS BIGINT)) FILTER (event_type = '{c}'), 0) AS BIGINT) AS {c}" for c in LINES)},
               CAST(coalesce(sum(CAST(trunc(value) AS BIGINT)) FILTER (event_type NOT IN ({', '.join(f"'{c}'" for c in LINES[:2])})), 0) AS BIGINT) AS otras
        FROM events GROUP BY 1""",
}
