"""Tables and files written by a query and read back: appends, versions, formats, references."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vialis.functions.geo import rings_of
from vialis.functions.text import corridor_of
from vialis.operators.ranking import first_rows, running_total
from vialis.questions import incidents, ridership
from vialis.questions.base import events, sql_shown, table, with_shown
from vialis.session import by_hash, scratch_folder, settle
from vialis.sources import files, tables

BATCHES = (("click", "error"), ("view",), ("signup", "purchase"))


def layer(spark) -> str:
    """A new database of its own in the shared scratch folder."""
    name = f"capa_{uuid.uuid4().hex[:10]}"
    tables.create_layers(spark, scratch_folder(spark, "tablas"), [name])
    return name


def batches(spark, sf_dir):
    rows = events(spark, sf_dir).drop("props")
    return [rows.filter(F.col("event_type").isin(*kinds)) for kinds in BATCHES]


def bronze_append(spark, sf_dir):
    """Three appends and a repeated one, which adds nothing."""
    target = f"{layer(spark)}.eventos"
    for number, batch in enumerate(batches(spark, sf_dir) + batches(spark, sf_dir)[:1]):
        tables.append_raw(batch, target, "eventos_muestra", f"lote_{number % 3}.parquet")
    tables.append_raw(batches(spark, sf_dir)[0].filter("false"), target, "eventos_muestra", "vacio.parquet")
    stored = spark.table(target)
    return stored.groupBy("fuente_id", "nombre_archivo", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("timestamp_ingesta").alias("con_hora"), F.count("fecha_ingesta").alias("con_fecha"))


def source_files(spark, sf_dir):
    """Audit columns with the name of the file each row was read from."""
    rows = tables.audited(spark.read.parquet(f"{sf_dir}/orders.parquet"), "pedidos")
    return rows.groupBy("nombre_archivo", "fuente_id").agg(F.count(F.lit(1)).alias("n"))


def derived_replace(spark, sf_dir):
    """A derived table partitioned by year, replaced by a second version of itself."""
    target = f"{layer(spark)}.accidentalidad_por_comuna"
    severity = incidents.severity(spark, sf_dir)
    tables.replace_table(severity.select("anio", "comuna"), target, "anio")
    tables.replace_table(severity, target, "anio")
    return with_shown(spark.table(target), "indice_severidad")


def small_replace(spark, sf_dir):
    target = f"{layer(spark)}.percentiles"
    tables.replace_table(ridership.band_percentiles(spark, sf_dir), target)
    return spark.table(target)


def versioned(spark, sf_dir) -> str:
    """One table, a partition per batch."""
    target = f"{layer(spark)}.lecturas"
    rows = [b.withColumn("_batch_id", F.lit(n)) for n, b in enumerate(batches(spark, sf_dir), start=1)]
    for batch in rows:
        batch.write.mode("append").partitionBy("_batch_id").saveAsTable(target)
    return target


def versioned_read(spark, sf_dir):
    """The first two batches of a table partitioned by batch; the third is pruned."""
    past = spark.table(versioned(spark, sf_dir)).filter("_batch_id <= 2")
    return past.groupBy("_batch_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def snapshots(spark, sf_dir):
    """Rows per batch and their running total."""
    counted = spark.table(versioned(spark, sf_dir)).groupBy("_batch_id").agg(F.count(F.lit(1)).alias("added_records"))
    summed = running_total(counted, [], [F.col("_batch_id")], F.col("added_records"), "total_records")
    return summed.select("_batch_id", F.lit("append").alias("operation"), "added_records", "total_records",
                         F.col("added_records").alias("added_in_summary"))


def schema_evolution(spark, sf_dir):
    """A column added between two batches: old rows read null."""
    target = f"{layer(spark)}.lecturas"
    first, second, _ = batches(spark, sf_dir)
    tables.append_raw(first, target, "lecturas", "1")
    more = tables.with_table_columns(second.withColumn("observacion", F.lit("nueva")), target)
    tables.append_raw(more, target, "lecturas", "2")
    return spark.table(target).groupBy(F.col("ruta_archivo").cast("int").alias("_batch_id")).agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.col("observacion").isNull()).alias("sin_observacion"))


# Keys of one delivered file.
FILE_KEYS = 20_000


def deliver(spark, rows, root: str) -> None:
    """Each status as a folder of files by ranges of the key, all of them named ``data.csv``; files that are there are replaced."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fresh = scratch_folder(spark, "entrega")
    parts = ["estado", "tramo"]
    placed = rows.withColumns({"estado": F.col("o_orderstatus"), "tramo": F.floor(F.col("o_orderkey") / FILE_KEYS)})
    by_hash(placed, *parts, rows=rows.count()).write.partitionBy(*parts).csv(fresh, header=True)
    # Spark names the files itself; a delivery brings them under names of their own.
    for path in files.existing_inputs(spark, [f"{fresh}/*/*/part-*.csv"]):
        part = hadoop.Path(path)
        place = hadoop.Path(f"{root}/{part.getParent().getParent().getName()}/{part.getParent().getName()}/data.csv")
        system = part.getFileSystem(conf)
        system.mkdirs(place.getParent())
        system.delete(place, False)
        system.rename(part, place)


def bronze_same_names(spark, sf_dir):
    """Equal base names in many folders, a load of a superset, grown files: every row is there once."""
    target, root = f"{layer(spark)}.pedidos", scratch_folder(spark, "nombres")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    read = lambda found: spark.read.schema("o_orderkey bigint, o_orderstatus string").csv(found, header=True)
    of = lambda status: orders.filter(F.col("o_orderstatus") == status)

    def load(*states: str) -> None:
        paths = files.existing_inputs(spark, [f"{root}/estado={x}/*/data.csv" for x in states])
        tables.append_files(spark, paths, target, "pedidos", read)

    deliver(spark, of("F").unionByName(of("O").filter("o_orderkey % 2 = 0")), root)
    load("F")
    load("F", "O")
    deliver(spark, of("O").unionByName(of("P")), root)
    load("F", "O", "P")
    load("O")
    stored = tables.held(spark, target)
    # Copies of a key meet first, in as many tasks as there are rows for: a file of few bytes may hold millions of keys.
    keyed = by_hash(stored.select("o_orderstatus", "nombre_archivo", "o_orderkey"), "o_orderkey", rows=stored.count())
    copies = keyed.groupBy("o_orderstatus", "nombre_archivo", "o_orderkey").agg(F.count(F.lit(1)).alias("copias"))
    return copies.groupBy("o_orderstatus", "nombre_archivo").agg(
        F.sum("copias").alias("n"), F.count("o_orderkey").alias("distintos"))


def layer_names(spark, sf_dir):
    """Layers made twice without harm; a dropped table is gone; the counts come from what is left."""
    name = layer(spark)
    tables.create_layers(spark, None, [name])
    nations = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    for t in ("una", "otra"):
        tables.replace_table(nations, f"{name}.{t}")
    tables.drop_table(spark, f"{name}.otra")
    left = F.lit(int(spark.catalog.tableExists(f"{name}.otra")))
    return spark.table(f"{name}.una").withColumn("otra_existe", left)


# Records one JSON document holds; a document is one file, and one task reads it.
DOCUMENT_RECORDS = 500


def block(key: str):
    return F.floor(F.col(key) / DOCUMENT_RECORDS)


def geojson_features(spark, sf_dir):
    """A polygon per supplier, written as FeatureCollections and read as one row per feature."""
    path = scratch_folder(spark, "geojson")
    x = F.col("s_suppkey")
    corner = lambda dx, dy: F.format_string("[%d,%d]", x + dx, x + dy)
    square = F.concat(F.lit("[["), F.concat_ws(",", *[corner(*c) for c in ((0, 0), (9, 0), (9, 9), (0, 9), (0, 0))]), F.lit("]]"))
    is_multi = F.col("s_nationkey") % 3 == 0
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"'), F.when(is_multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")),
        F.lit('","coordinates":'), F.when(is_multi, F.concat(F.lit("["), square, F.lit("]"))).otherwise(square),
        F.lit('},"properties":'),
        F.to_json(F.struct(x.alias("osm_id"), F.col("s_name").alias("nombre"), F.lit("comuna").alias("tipo"), F.lit("8").alias("admin_level"))),
        F.lit("}"))
    documents = table(spark, sf_dir, "supplier").groupBy(block("s_suppkey").alias("bloque")).agg(F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list(feature)), F.lit("]}")).alias("value"))
    documents.write.partitionBy("bloque").text(path)
    read = files.read_geojson(spark, f"{path}/*/*.txt").select("osm_id", "nombre", "tipo", "admin_level", "geometry_geojson")
    ring = F.get(rings_of(F.col("geometry_geojson")), F.lit(0))
    return read.select("osm_id", "nombre", "tipo", "admin_level", F.size(ring).alias("puntos"), ring[1][0].alias("este"))


def json_stations(spark, sf_dir):
    """Stations written as ``result.records[]``, and read back as rows."""
    path = scratch_folder(spark, "estaciones")
    record = F.struct(
        F.col("s_suppkey").cast("int").alias("_id"), F.format_string("ENC%03d", "s_suppkey").alias("estacion_id"),
        F.col("s_name").alias("nombre"), F.lit(12).alias("capacidad_anclajes"), F.lit("activa").alias("estado"))
    documents = table(spark, sf_dir, "supplier").groupBy(block("s_suppkey").alias("bloque")).agg(
        F.to_json(F.struct(F.struct(F.collect_list(record).alias("records")).alias("result"))).alias("value"))
    documents.write.partitionBy("bloque").text(path)
    return files.read_bike_stations(spark, f"{path}/*/*.txt").select("_id", "estacion_id", "nombre", "capacidad_anclajes", "estado")


def csv_text(spark, sf_dir):
    """Quoted fields with commas, quotes and line breaks, through a headed CSV of text."""
    path = scratch_folder(spark, "csv")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Nro Radicado"), F.concat(F.lit('Calle "'), "o_orderpriority", F.lit('",\nBarrio')).alias("Dirección"))
    rows.write.option("escape", '"').csv(path, header=True)
    read = files.read_text_table(spark, files.existing_inputs(spark, [f"{path}/*.csv"]))
    return read.select("nro_radicado", "direccion")


def csv_ridership(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    files.write_csv(ridership.hourly(spark, sf_dir).select("fecha", "linea", "hora", "pasajeros"), path)
    return files.read_ridership(spark, path)


def csv_trips(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    rows = events(spark, sf_dir)
    files.write_csv(rows.select(
        F.col("event_id").alias("id_viaje"), F.col("user_id").alias("id_usuario"), F.col("event_type").alias("estacion_origen"),
        F.lit("x").alias("estacion_destino"), F.col("ts").alias("ts_inicio"), F.col("ts").alias("ts_fin"),
        F.col("value").alias("duracion_min")), path)
    read = files.read_trips(spark, path)
    grouped = read.groupBy("estacion_origen", F.to_date("ts_inicio").alias("fecha")).agg(
        F.count("id_viaje").alias("n"), F.sum("duracion_min").alias("minutos"))
    return with_shown(grouped, "minutos")


def csv_readings(spark, sf_dir):
    path = scratch_folder(spark, "csv")
    rows = table(spark, sf_dir, "events")
    files.write_csv(rows.select(
        F.when(F.col("event_type") == "view", F.lit("ayer")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.col("user_id").alias("estacion_id"), F.col("event_type").alias("variable"),
        F.when(F.col("event_type") == "click", F.lit("n/d")).otherwise(F.col("value").cast("string")).alias("valor")), path)
    read = files.read_readings(spark, path)
    return with_shown(read.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.sum("valor").alias("suma")), "suma")


def tsv_stations(spark, sf_dir):
    path = scratch_folder(spark, "tsv")
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("codigo"), F.col("s_name").alias("nombre_completo"),
        F.when(F.col("s_nationkey") != 4, F.format_string("EST-%d", "s_suppkey")).alias("nombre_corto"),
        F.lit(6.25).alias("latitud"), F.lit(-75.5).alias("longitud"), F.lit("Itagüí").alias("municipio"))
    rows.write.csv(path, header=True, sep="\t")
    return files.read_stations(spark, path)


def tsv_canonical(spark, sf_dir):
    path = scratch_folder(spark, "tsv")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.year("o_orderdate"), F.month("o_orderdate"),
        F.lit("c"), "o_orderstatus", F.lit("b"), F.lit("k"), "o_orderpriority",
        F.when(F.col("o_orderstatus") == "F", F.lit("sin dato")).otherwise(F.lit("-75.5")), F.lit("6.2"))
    rows.write.csv(path, sep="\t")
    read = files.read_canonical_incidents(spark, path)
    return read.groupBy("anio", "mes", "gravedad").agg(
        F.count("nro_radicado").alias("n"), F.min("longitud").alias("lon"), F.max("latitud").alias("lat"))


def station_months(spark, sf_dir):
    """Wide files by year, with other stations in odd years; only files of the wanted years count."""
    path = scratch_folder(spark, "meses")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_shipdate").agg(*[
        F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))).alias(f"EST-{flag}") for flag in ("A", "N", "R")])
    month = F.concat(F.lit("pm25_"), F.year("l_shipdate"), F.lit("_01"))
    rows = settle(rows.select(
        month.alias("mes"), (F.year("l_shipdate") % 2).alias("_odd"), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("Fecha_Hora"),
        "EST-A", "EST-N", "EST-R"))
    for odd, stations in ((1, "RA"), (0, "ANR")):
        of_years = rows.filter(F.col("_odd") == odd).select("mes", "Fecha_Hora", *[F.col(f"EST-{f}") for f in stations])
        of_years.write.mode("append").partitionBy("mes").csv(path, header=True, sep="\t")
    read = files.read_station_months(spark, [f"{path}/*/*.csv"], "pm25", 1996, 1999)
    return with_shown(read, "valor")


def reference_export(spark, sf_dir):
    """Percentiles exported as JSON and taken from there while the gold table does not exist."""
    path = scratch_folder(spark, "referencia")
    files.write_json(ridership.band_percentiles(spark, sf_dir), path)
    return tables.load_reference(spark, f"{layer(spark)}.percentiles", path)


def reference_table(spark, sf_dir):
    target = f"{layer(spark)}.percentiles"
    tables.replace_table(ridership.band_percentiles(spark, sf_dir), target)
    return tables.load_reference(spark, target, "/no/such/export")


def corridor_export(spark, sf_dir):
    """Corridors exported as JSON lines and read back, each once."""
    path = scratch_folder(spark, "corredores")
    named = incidents.street_to_corridor(spark, sf_dir).filter(F.col("corredor").isNotNull()).select("corredor").distinct()
    files.write_json(named.select(F.array(F.concat(F.lit(" "), "corredor")).alias("corredores")), path)
    return tables.load_risk_corridors(spark, path)


def corridors_default(spark, sf_dir):
    """Without an export the known corridors count; here with the parts whose street lies on one."""
    known = tables.load_risk_corridors(spark, "/no/such/export")
    streets = table(spark, sf_dir, "part").select(corridor_of(F.concat(F.lit("CALLE "), F.col("p_size").cast("string"))).alias("corredor"))
    return known.join(streets.groupBy("corredor").agg(F.count(F.lit(1)).alias("n")), "corredor", "left").fillna(0, ["n"])


def format_comparison(spark, sf_dir):
    """The same rows as CSV and as Parquet with two codecs: full and filtered counts agree."""
    rows = table(spark, sf_dir, "lineitem")
    counts = None
    for name, write, read in (
        ("csv", files.write_csv, lambda p: spark.read.schema(rows.schema).csv(p, header=True)),
        ("parquet_snappy", lambda df, p: files.write_parquet(df, p, "snappy"), spark.read.parquet),
        ("parquet_zstd", lambda df, p: files.write_parquet(df, p, "zstd"), spark.read.parquet),
    ):
        path = scratch_folder(spark, name)
        write(rows, path)
        counted = read(path).agg(
            F.count(F.lit(1)).alias("filas"), F.count_if(F.col("l_returnflag") == "R").alias("filtradas")
        ).select(F.lit(name).alias("formato"), "filas", "filtradas")
        counts = counted if counts is None else counts.unionByName(counted)
    return counts


def pruned_scan(spark, sf_dir):
    """Two columns and a condition that reach the Parquet scan."""
    return files.read_columns(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"], F.col("l_quantity") >= 49).groupBy(
        "l_quantity").agg(F.countDistinct("l_orderkey").alias("pedidos"))


def capped_scan(spark, sf_dir):
    """The thousand rows that come first in a fixed order: a top-k report over the whole table."""
    order = [F.asc("l_shipdate"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey"),
             F.asc("l_extendedprice"), F.asc("l_tax"), F.asc("l_discount")]
    kept = first_rows(table(spark, sf_dir, "lineitem"), order, 1000)
    return kept.select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


QUERIES = {q.__name__: q for q in (
    bronze_append, source_files, derived_replace, small_replace, versioned_read, snapshots, schema_evolution, layer_names,
    geojson_features, json_stations, csv_text, csv_ridership, csv_trips, csv_readings, tsv_stations, tsv_canonical,
    station_months, reference_export, reference_table, corridor_export, corridors_default, format_comparison, pruned_scan,
    capped_scan, bronze_same_names,
)}

_BATCH = "CASE WHEN event_type IN ('click', 'error') THEN 1 WHEN event_type = 'view' THEN 2 ELSE 3 END"
_STREET = incidents.SQL["street_to_corridor"]

SQL = {
    "bronze_append": f"""SELECT 'eventos_muestra' AS fuente_id, 'lote_' || ({_BATCH} - 1) || '.parquet' AS nombre_archivo, event_type,
        count(*) AS n, count(*) AS con_hora, count(*) AS con_fecha FROM events GROUP BY ALL""",
    "bronze_same_names": """SELECT o_orderstatus, 'data.csv' AS nombre_archivo, count(*) AS n, count(DISTINCT o_orderkey) AS distintos
        FROM orders GROUP BY 1""",
    "source_files": "SELECT 'orders.parquet' AS nombre_archivo, 'pedidos' AS fuente_id, count(*) AS n FROM orders",
    "derived_replace": incidents.SQL["severity_by_area_year"].split(",\n               CAST(row_number()")[0] + " FROM severity",
    "small_replace": ridership.SQL["band_percentiles"],
    "versioned_read": f"""SELECT {_BATCH} AS _batch_id, event_type, count(*) AS n FROM events
        WHERE {_BATCH} <= 2 GROUP BY ALL""",
    "snapshots": f"""SELECT _batch_id, 'append' AS operation, n AS added_records,
        CAST(sum(n) OVER (ORDER BY _batch_id) AS BIGINT) AS total_records, n AS added_in_summary
        FROM (SELECT {_BATCH} AS _batch_id, count(*) AS n FROM events GROUP BY 1)""",
    "schema_evolution": f"""SELECT {_BATCH} AS _batch_id, count(*) AS filas,
        count(*) FILTER ({_BATCH} = 1) AS sin_observacion FROM events WHERE {_BATCH} < 3 GROUP BY 1""",
    "layer_names": "SELECT c_nationkey, count(*) AS n, 0 AS otra_existe FROM customer GROUP BY 1",
    "geojson_features": """SELECT s_suppkey AS osm_id, s_name AS nombre, 'comuna' AS tipo, '8' AS admin_level, 5 AS puntos,
        CAST(s_suppkey + 9 AS DOUBLE) AS este FROM supplier""",
    "json_stations": """SELECT CAST(s_suppkey AS INTEGER) AS _id, printf('ENC%03d', s_suppkey) AS estacion_id, s_name AS nombre,
        12 AS capacidad_anclajes, 'activa' AS estado FROM supplier""",
    "csv_text": """SELECT CAST(o_orderkey AS VARCHAR) AS nro_radicado, 'Calle "' || o_orderpriority || '",' || chr(10) || 'Barrio' AS direccion
        FROM orders""",
    "csv_ridership": f"""WITH {ridership._HOURLY} SELECT CAST(fecha AS VARCHAR) AS fecha, linea, hora, pasajeros FROM hourly""",
    "csv_trips": f"""SELECT event_type AS estacion_origen, CAST(CAST(ts AS DATE) AS VARCHAR) AS fecha, count(*) AS n,
        {sql_shown('sum(value)')} AS minutos FROM events GROUP BY 1, 2""",
    "csv_readings": f"""SELECT event_type AS variable, count(*) AS n, {sql_shown("sum(CASE WHEN event_type <> 'click' THEN value END)")} AS suma
        FROM events WHERE event_type <> 'view' GROUP BY 1""",
    "tsv_stations": """SELECT 'EST-' || s_suppkey AS estacion_id, s_name AS estacion_nombre, 6.25::DOUBLE AS latitud,
        -75.5::DOUBLE AS longitud, 'Itagüí' AS municipio FROM supplier WHERE s_nationkey <> 4""",
    "tsv_canonical": """SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, CAST(month(o_orderdate) AS INTEGER) AS mes,
        o_orderstatus AS gravedad, count(*) AS n, min(CASE WHEN o_orderstatus <> 'F' THEN -75.5e0 END) AS lon,
        6.2e0 AS lat FROM orders GROUP BY 1, 2, 3""",
    "station_months": f"""SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS timestamp, 'EST-' || l_returnflag AS estacion_id,
        'pm25' AS variable, {sql_shown('sum(l_quantity)')} AS valor FROM lineitem
        WHERE year(l_shipdate) BETWEEN 1996 AND 1999 AND (year(l_shipdate) % 2 = 0 OR l_returnflag <> 'N') GROUP BY 1, 2""",
    "reference_export": ridership.SQL["band_percentiles"],
    "reference_table": ridership.SQL["band_percentiles"],
    "corridor_export": f"SELECT DISTINCT corredor FROM ({_STREET}) WHERE corredor IS NOT NULL",
    "corridors_default": f"""SELECT corredor, coalesce(n, 0) AS n FROM (SELECT unnest([{', '.join(f"'{c}'" for c in incidents.v.KNOWN_CORRIDORS)}]) AS corredor)
        LEFT JOIN (SELECT 'Calle ' || p_size AS corredor, count(*) AS n FROM part GROUP BY 1) USING (corredor)""",
    "format_comparison": """SELECT unnest(['csv', 'parquet_snappy', 'parquet_zstd']) AS formato, filas, filtradas FROM (
        SELECT count(*) AS filas, count(*) FILTER (l_returnflag = 'R') AS filtradas FROM lineitem)""",
    "pruned_scan": "SELECT l_quantity, count(DISTINCT l_orderkey) AS pedidos FROM lineitem WHERE l_quantity >= 49 GROUP BY 1",
    "capped_scan": """SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_tax, l_discount LIMIT 1000""",
}
