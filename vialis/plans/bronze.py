"""Source files into bronze tables. Every loader returns the rows it added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.privacy import pseudonymise
from vialis.functions.text import zone_of
from vialis.operators.quality import clean_ridership, clear_sentinels, fill_absent, require_columns
from vialis.operators.reshape import normalise_legacy
from vialis.plans import DEFAULT, Layers
from vialis.sources import files, tables

WEATHER = ("temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh")
AIR_COLUMNS = ("estacion_id", "estacion_nombre", "zona", "latitud", "longitud", "municipio", "timestamp",
               "pm25", "pm10", *WEATHER)
STATION_COLUMNS = {"estacion_nombre": "string", "latitud": "double", "longitud": "double", "municipio": "string"}


def load_incidents(spark: SparkSession, paths: Sequence[str], layers: Layers = DEFAULT, multiline: bool = True) -> int:
    """Incidents as text. Without line breaks inside fields pass ``multiline=False``, so that large files are split."""
    return tables.append_files(
        spark, files.existing_inputs(spark, paths), layers.raw("incidentes"), "incidentes_viales",
        lambda found: files.read_text_table(spark, found, multiline))


def load_ridership(spark: SparkSession, paths: Sequence[str], layers: Layers = DEFAULT) -> int:
    def read(found: list[str]) -> DataFrame:
        rows = require_columns(files.read_ridership(spark, found), ["fecha", "linea", "hora", "pasajeros"])
        return clean_ridership(rows, "fecha", "linea", "hora", "pasajeros")

    return tables.append_files(spark, files.existing_inputs(spark, paths), layers.raw("afluencia"), "afluencia_real", read)


def load_trips(spark: SparkSession, paths: Sequence[str], key: str, layers: Layers = DEFAULT) -> int:
    """Bike trips; user ids are stored only as keyed pseudonyms."""
    def read(found: list[str]) -> DataFrame:
        rows = tables.with_path(require_columns(files.read_trips(spark, found), ["id_usuario"]))
        return pseudonymise(rows, "id_usuario", key)

    return tables.append_files(spark, files.existing_inputs(spark, paths), layers.raw("viajes"), "prestamos_bici", read)


def load_air(
    spark: SparkSession, readings: Sequence[str], stations: Sequence[str] | None = None, layers: Layers = DEFAULT
) -> int:
    """Long readings of several files, in one scan, as one row per time and station, beside the station's data.

    The missing-value marker is cleared before readings of one key are averaged.
    A row names all files it was made of.
    """
    def read(found: list[str]) -> DataFrame:
        long = clear_sentinels(tables.with_path(files.read_readings(spark, found)), ["valor"])
        wide = long.groupBy("timestamp", "estacion_id").agg(
            *[F.avg(F.when(F.col("variable") == name, F.col("valor"))).alias(name) for name in ("pm25", "pm10")],
            F.concat_ws(";", F.sort_array(F.collect_set(v.FILE_PATH))).alias(v.FILE_PATH),
        )
        if stations is not None:
            wide = wide.join(files.read_stations(spark, files.existing_inputs(spark, stations)), "estacion_id", "left")
        wide = fill_absent(wide, STATION_COLUMNS).withColumn("zona", zone_of(F.col("municipio")))
        return fill_absent(wide, {c: "double" for c in WEATHER}).select(*AIR_COLUMNS, v.FILE_PATH)

    return tables.append_files(spark, files.existing_inputs(spark, readings), layers.raw("aire"), "aire_real", read)


def load_polygons(spark: SparkSession, paths: Sequence[str], layers: Layers = DEFAULT) -> int:
    return tables.append_files(
        spark, files.existing_inputs(spark, paths), layers.raw("poligonos"), "limites_osm",
        lambda found: files.read_geojson(spark, found, v.FILE_PATH))


def load_counts(
    spark: SparkSession, manual: Sequence[str] = (), cameras: Sequence[str] = (), layers: Layers = DEFAULT,
    multiline: bool = True,
) -> int:
    """Manual and camera counts in one table, each with the columns of its own schema.

    The manual files give the table its columns, so they are loaded first;
    columns that only camera files have are added to it.
    """
    table, written = layers.raw("aforos"), 0
    for kind, paths in (("manual", manual), ("camara", cameras)):
        if not paths:
            continue

        def read(found: list[str], kind: str = kind) -> DataFrame:
            rows = tables.with_path(files.read_text_table(spark, found, multiline)).withColumn("tipo_aforo", F.lit(kind))
            return tables.with_table_columns(rows, table)

        written += tables.append_files(spark, files.existing_inputs(spark, paths), table, "aforos_trafico", read)
    return written


def load_legacy(spark: SparkSession, paths: Sequence[str], layers: Layers = DEFAULT) -> int:
    """Text lines of both legacy layouts, normalised and with one row per record id."""
    def read(found: list[str]) -> DataFrame:
        rows = normalise_legacy(tables.with_path(spark.read.text(found)), keep=[v.FILE_PATH])
        return rows.withColumns({c: F.col(c).try_cast("double") for c in ("longitud", "latitud")})

    return tables.append_files(
        spark, files.existing_inputs(spark, paths), layers.raw("incidentes_legado"), "incidentes_legado", read)


def load_canonical(spark: SparkSession, paths: Sequence[str], layers: Layers = DEFAULT) -> int:
    """Incidents another job has already normalised to tab-separated parts."""
    return tables.append_files(
        spark, files.existing_inputs(spark, paths), layers.raw("incidentes_legado"), "incidentes_legado",
        lambda found: files.read_canonical_incidents(spark, found))
