"""File inputs. Schemas are given or all text; no reader infers types in an extra pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis.functions.text import plain_columns
from vialis.session import settle

RIDERSHIP_SCHEMA = "fecha date, linea string, hora int, pasajeros bigint"
TRIP_SCHEMA = ("id_viaje string, id_usuario string, estacion_origen string, estacion_destino string, "
               "ts_inicio timestamp, ts_fin timestamp, duracion_min double")
READING_SCHEMA = "timestamp string, estacion_id string, variable string, valor string"
STATION_SCHEMA = ("codigo string, nombre_completo string, nombre_corto string, latitud double, "
                  "longitud double, municipio string")
CANONICAL_SCHEMA = ("nro_radicado string, fecha string, anio int, mes int, clase string, gravedad string, "
                    "barrio string, comuna string, direccion string, longitud string, latitud string")
FEATURE_SCHEMA = ("features array<struct<geometry:string, properties:struct<osm_id:bigint, nombre:string, "
                  "tipo:string, admin_level:string, nombre_alt:string, wikipedia:string>>>")
BIKE_STATION_SCHEMA = ("result struct<records:array<struct<_id:int, estacion_id:string, nombre:string, "
                       "latitud:double, longitud:double, capacidad_anclajes:int, estado:string>>>")


def existing_inputs(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """Files that match and are not empty, on any file system Hadoop knows; none at all is an error."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        for status in path.getFileSystem(conf).globStatus(path) or []:
            if status.isDirectory() or status.getLen() > 0:
                found.append(status.getPath().toString())
    if not found:
        raise FileNotFoundError(f"no input with content matches {list(patterns)}")
    return found


def read_text_table(spark: SparkSession, paths, multiline: bool = True) -> DataFrame:
    """Headed CSV with every column as text and plain names.

    Quoted fields may span lines, which makes a file one task: deliver large
    inputs as many files, or pass ``multiline=False`` where no field has a line
    break, so that a file can be split.
    """
    reader = spark.read.options(header=True, inferSchema=False, multiLine=multiline, escape='"')
    return plain_columns(reader.csv(paths))


def read_ridership(spark: SparkSession, paths) -> DataFrame:
    return spark.read.schema(RIDERSHIP_SCHEMA).csv(paths, header=True)


def read_trips(spark: SparkSession, paths) -> DataFrame:
    return spark.read.schema(TRIP_SCHEMA).csv(paths, header=True)


def read_readings(spark: SparkSession, paths) -> DataFrame:
    """Long sensor rows with a parsed time and value; rows without a time are dropped."""
    return typed_readings(spark.read.schema(READING_SCHEMA).csv(paths, header=True))


def typed_readings(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "timestamp": F.try_to_timestamp("timestamp"), "valor": F.col("valor").try_cast("double"),
    }).filter(F.col("timestamp").isNotNull())


def read_stations(spark: SparkSession, paths) -> DataFrame:
    """Station dimension from headed tab-separated text; rows without an id are dropped."""
    rows = spark.read.schema(STATION_SCHEMA).csv(paths, header=True, sep="\t", quote='"')
    return rows.select(
        F.col("nombre_corto").alias("estacion_id"), F.col("nombre_completo").alias("estacion_nombre"),
        "latitud", "longitud", "municipio",
    ).filter(F.col("estacion_id").isNotNull())


def read_canonical_incidents(spark: SparkSession, paths) -> DataFrame:
    """Headerless tab-separated parts; coordinates as doubles, unreadable ones null."""
    rows = spark.read.schema(CANONICAL_SCHEMA).csv(paths, sep="\t", header=False)
    return rows.withColumns({c: F.col(c).try_cast("double") for c in ("longitud", "latitud")})


def read_geojson(spark: SparkSession, paths, path_column: str | None = None) -> DataFrame:
    """One row per feature of a FeatureCollection with the geometry as JSON text, and its file's path if asked for."""
    files = spark.read.schema(FEATURE_SCHEMA).json(paths, multiLine=True)
    place = [] if path_column is None else [F.col("_metadata.file_path").alias(path_column)]
    feature = files.select(F.explode("features").alias("f"), *place)
    return feature.select("f.properties.*", F.col("f.geometry").alias("geometry_geojson"), *[c for c in feature.columns if c != "f"])


def read_bike_stations(spark: SparkSession, paths) -> DataFrame:
    files = spark.read.schema(BIKE_STATION_SCHEMA).json(paths, multiLine=True)
    return files.select(F.explode("result.records").alias("r")).select("r.*")


def file_year(name: Column) -> Column:
    """Year of a monthly file from its name, ``..2021_03..``; null without one."""
    return F.regexp_extract(name, r"(\d{4})_\d{2}", 1).try_cast("int")


def in_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of files whose name, or else the folder they lie in, falls in the years; both are file metadata, so other files are skipped."""
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    year = F.coalesce(file_year(F.col("_metadata.file_name")), file_year(folder))
    return df.filter(year.between(first, last))


def _header_lines(lines: DataFrame) -> DataFrame:
    """The first line of each file, as (ruta, encabezado)."""
    starts = lines.filter(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("ruta"), F.monotonically_increasing_id().alias("_at"), "value")
    return starts.groupBy("ruta").agg(F.min_by("value", "_at").alias("encabezado"))


def _cells(line: str) -> Column:
    """Tab-separated cells without blanks and quotation marks around them."""
    return F.transform(F.split(line, "\t"), lambda c: F.trim(F.regexp_replace(F.trim(c), '^"(.*)"$', "$1")))


def read_station_months(spark: SparkSession, paths: Sequence[str], variable: str, first: int, last: int) -> DataFrame:
    """Long readings from monthly wide files, each with its own set of stations.

    All files are lines of one scan, however many there are. A table of their
    first lines, written before, names the columns of each line: cell and
    column of the same place make a reading. Lines without a time, cells without a number and columns without a name are
    skipped, and so is a repeated first line. Cells hold no tabs or line breaks.
    """
    lines = in_years(spark.read.text(existing_inputs(spark, paths)), first, last)
    headers = settle(_header_lines(lines))
    placed = lines.select(F.col("_metadata.file_path").alias("ruta"), "value").join(headers, "ruta")
    cells = placed.filter(F.col("value") != F.col("encabezado")).select(_cells("value").alias("c"), _cells("encabezado").alias("h"))
    pairs = cells.select(F.get("c", F.lit(0)).alias("timestamp"), F.explode(F.slice(F.arrays_zip("h", "c"), 2, F.size("h"))).alias("x"))
    return pairs.select(
        "timestamp", F.col("x.h").alias("estacion_id"), F.lit(variable).alias("variable"), F.col("x.c").try_cast("double").alias("valor"),
    ).filter((F.col("timestamp") != "") & (F.col("estacion_id") != "") & F.col("valor").isNotNull())


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Parquet scan of some columns; a plain condition is pushed down to the row groups."""
    rows = spark.read.parquet(path)
    if condition is not None:
        rows = rows.filter(condition)
    return rows.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_parquet(df: DataFrame, path: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Reference tables as JSON lines, the fallback of the streaming jobs."""
    df.write.mode("overwrite").json(path)
