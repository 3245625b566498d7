"""JSON messages and quoted text lines as typed fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.functions.geo import pair_from_dict_text
from vialis.functions.measures import number_or_null, whole_or_zero

# Message schemas by role of the topic: every value as text, typed afterwards.
AIR_TEXT = ("estacion_id", "estacion_nombre", "zona", "timestamp")
AIR_NUMBERS = ("latitud", "longitud", "pm25", "pm10", "temperatura_c", "humedad_pct",
               "precipitacion_mm", "viento_kmh")
BIKE_SCHEMA = ("estacion_id string, nombre string, latitud double, longitud double, "
               "capacidad_anclajes int, bicicletas_disponibles string, anclajes_libres string, timestamp string")
CORRIDOR_SCHEMA = ("corredor string, dispositivo string, latitud double, longitud double, timestamp string, "
                   "intensidad string, velocidad_kmh string, ocupacion_pct string")
LINE_SCHEMA = ("linea string, timestamp string, hora int, pasajeros_periodo string, "
               "pasajeros_hora_total string, fuente string")
AIR_SCHEMA = ", ".join(f"{c} string" for c in AIR_TEXT + AIR_NUMBERS)


def decode(df: DataFrame, schema: str, value: str = "value", key: str | None = None) -> DataFrame:
    """Fields of the JSON value beside the other columns; rows without a key are dropped."""
    rest = [c for c in df.columns if c != value]
    fields = df.select(*rest, F.from_json(F.col(value).cast("string"), schema).alias("_m")).select(*rest, "_m.*")
    return fields if key is None else has_key(fields, key)


def has_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.trim(F.col(key)) != "")


def air_message(row: DataFrame) -> DataFrame:
    """Air reading with every numeric field as double or null."""
    return row.withColumns({c: number_or_null(F.col(c)) for c in AIR_NUMBERS})


def corridor_message(row: DataFrame) -> DataFrame:
    """Camera row as a traffic message; rows that carry neither traffic nor speed are dropped."""
    place = pair_from_dict_text(F.col("location"))
    return row.select(
        F.trim(F.coalesce(F.nullif(F.col("corredor"), F.lit("")), F.lit("DESCONOCIDO"))).alias("corredor"),
        F.coalesce(F.col("dispositivo"), F.lit("CCTV")).alias("dispositivo"),
        place["second"].alias("latitud"),
        place["first"].alias("longitud"),
        F.coalesce(F.col("fechahora"), F.lit("")).alias("timestamp"),
        whole_or_zero(F.col("intensidad")).alias("intensidad"),
        whole_or_zero(F.col("velocidad"), "double").alias("velocidad_kmh"),
        whole_or_zero(F.col("ocupacion")).alias("ocupacion_pct"),
    ).filter((F.col("intensidad") != 0) | (F.col("velocidad_kmh") != 0))


def field_count(line: Column) -> Column:
    """Number of fields of a quoted CSV line: commas left after the quoted parts are gone."""
    return F.regexp_count(F.regexp_replace(line, r'"[^"]*"', ""), F.lit(",")) + 1
