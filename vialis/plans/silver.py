"""Bronze tables cleaned into silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.calendar import day_band, is_weekend
from vialis.functions.geo import in_valid_area, pair_from_brackets, pair_from_dict_text, repair_swapped
from vialis.functions.measures import is_plausible_trip, trip_class, vehicle_total
from vialis.operators import quality
from vialis.operators.rollups import network_daily
from vialis.operators.spatial import area_or_text, assign_area
from vialis.plans import DEFAULT, Layers
from vialis.sources import tables
from vialis.sources.tables import replace_table

READINGS = ("pm25", "pm10", "temperatura_c", "humedad_pct", "precipitacion_mm", "viento_kmh")


def _with_area(points: DataFrame, polygons: DataFrame, alias: str) -> DataFrame:
    return assign_area(points, polygons, "longitud", "latitud", "nombre", "geometry_geojson", "osm_id", alias=alias)


def clean_incidents(raw: DataFrame, polygons: DataFrame) -> DataFrame:
    """Placed, dated incidents, one per record id; the area of the map replaces the area in the text.

    Rows are cut to the valid area and to one per id before the spatial join.
    """
    place = repair_swapped(pair_from_brackets(F.col("location")))
    rows = raw.withColumn("_p", place).withColumns({"longitud": F.col("_p.lon"), "latitud": F.col("_p.lat")})
    rows = rows.filter(in_valid_area(F.col("longitud"), F.col("latitud")))
    at = F.try_to_timestamp("fecha_accidentes")
    rows = rows.select(
        F.col("nro_radicado").alias("incidente_id"), at.alias("fecha_accidente_ts"),
        F.year(at).alias("anio_accidente"), F.month(at).alias("mes_accidente"),
        F.col("clase_accidente").alias("clase"), F.col("gravedad_accidente").alias("gravedad"),
        F.col("diseno").alias("diseno_via"), "longitud", "latitud", F.col("barrio").alias("barrio_medata"),
        F.col("comuna").alias("comuna_texto"), "direccion",
    )
    single = quality.one_per_key(rows, ["incidente_id"], [F.col("fecha_accidente_ts")])
    placed = _with_area(single, polygons, "comuna_geo").withColumn("comuna", area_or_text("comuna_geo", "comuna_texto"))
    return placed.select(
        "incidente_id", "fecha_accidente_ts", "anio_accidente", "mes_accidente", "clase", "gravedad", "diseno_via",
        "longitud", "latitud", "barrio_medata", "comuna", "direccion",
    )


def merged_readings(raw: DataFrame, keys: Sequence[str] = ("timestamp", "estacion_id")) -> DataFrame:
    """One row per time and station: loads that brought other readings of it are joined, of one reading the newest load counts.

    A missing value never takes the place of one that is there.
    """
    values = [c for c in raw.columns if c not in (*keys, *tables.AUDIT)]
    when = F.struct(F.col(v.INGESTED_AT), F.col(v.LOAD)) if {v.INGESTED_AT, v.LOAD} <= set(raw.columns) else F.struct(F.lit(0))
    newest = [F.max(F.when(F.col(c).isNotNull(), F.struct(when.alias("w"), F.col(c).alias("x"))))["x"].alias(c) for c in values]
    return raw.groupBy(*keys).agg(*newest)


def clean_air(raw: DataFrame) -> DataFrame:
    raw = merged_readings(quality.clear_sentinels(raw, READINGS))
    rows = quality.valid_readings(raw, "pm25")
    rows = quality.fill_absent(rows, {"municipio": "string"})
    return rows.select(
        "estacion_id", "estacion_nombre", "zona", "municipio", "latitud", "longitud", "timestamp",
        F.date_trunc("hour", "timestamp").alias("fecha_hora"), F.year("timestamp").alias("anio"),
        F.hour("timestamp").alias("hora"), *READINGS,
    )


def ridership_with_climate(raw: DataFrame, air: DataFrame) -> DataFrame:
    """Hourly ridership, each hour once, with the climate of its day and the parts of the calendar."""
    hourly = quality.one_per_key(
        raw.select("fecha", "linea", "hora", "pasajeros"), ["fecha", "linea", "hora"], [F.col("pasajeros")], last=True)
    climate = network_daily(
        air, "timestamp",
        {"pm25_promedio_red": "pm25", "pm10_promedio_red": "pm10", "temperatura_promedio_c": "temperatura_c"},
        {"precipitacion_total_mm": "precipitacion_mm"},
    )
    return hourly.join(climate, on="fecha", how="left").withColumns({
        "anio": F.year("fecha"), "dia_semana": F.dayofweek("fecha"), "es_finde": is_weekend(F.col("fecha")),
        "franja_horaria": day_band(F.col("hora")),
    })


def trips_with_climate(raw: DataFrame, air: DataFrame) -> DataFrame:
    rows = raw.filter(F.col("ts_inicio").isNotNull() & is_plausible_trip(F.col("duracion_min"))).select(
        "id_viaje", "usuario_pseudo", "estacion_origen", "estacion_destino", "ts_inicio", "ts_fin", "duracion_min")
    single = quality.one_per_key(rows, ["id_viaje"], [F.col("ts_inicio")])
    climate = network_daily(
        air, "timestamp", {"temperatura_promedio_c": "temperatura_c", "pm25_promedio": "pm25"},
        {"precipitacion_total_mm": "precipitacion_mm"},
    )
    dated = single.withColumns({
        "categoria_duracion": trip_class(F.col("duracion_min")), "fecha": F.to_date("ts_inicio"),
        "hora": F.hour("ts_inicio"), "anio": F.year("ts_inicio"),
    })
    return dated.join(climate, on="fecha", how="left").select(
        "id_viaje", "usuario_pseudo", "estacion_origen", "estacion_destino", "ts_inicio", "ts_fin", "duracion_min",
        "categoria_duracion", "fecha", "hora", "anio", "temperatura_promedio_c", "pm25_promedio", "precipitacion_total_mm",
    )


COUNT_COLUMNS = ("coordenadax", "coordenaday", "location", "via_principal", "corredor", "fecha_hora", "fechahora",
                 "autos", "buses", "camiones", "motos", "intensidad")


def placed_counts(raw: DataFrame, polygons: DataFrame) -> DataFrame:
    """Both kinds of traffic counts in common columns, inside the valid area, with their area."""
    raw = quality.fill_absent(raw, {c: "string" for c in COUNT_COLUMNS})
    place = pair_from_dict_text(F.col("location"))
    day = lambda c: F.try_to_date(F.substring(c, 1, 10))
    rows = raw.select(
        "tipo_aforo", F.coalesce("via_principal", "corredor").alias("corredor"),
        F.coalesce(F.col("coordenadax").try_cast("double"), place["first"]).alias("longitud"),
        F.coalesce(F.col("coordenaday").try_cast("double"), place["second"]).alias("latitud"),
        F.coalesce(day("fecha_hora"), day("fechahora")).alias("fecha"),
        vehicle_total(F.col("tipo_aforo"), [F.col(c) for c in ("autos", "buses", "camiones", "motos")],
                      F.col("intensidad")).alias("vehiculos"),
    ).filter(in_valid_area(F.col("longitud"), F.col("latitud")) & F.col("vehiculos").isNotNull())
    return _with_area(rows, polygons, "comuna").select(
        "tipo_aforo", "corredor", "comuna", "longitud", "latitud", "fecha", F.year("fecha").alias("anio"), "vehiculos")


def build(spark: SparkSession, layers: Layers = DEFAULT) -> None:
    """Build every silver table; air comes first, two others need it."""
    raw = lambda name: tables.held(spark, layers.raw(name))
    polygons = raw("poligonos").select("osm_id", "nombre", "geometry_geojson")
    replace_table(clean_air(raw("aire")), layers.clean("aire"), "anio")
    air = spark.table(layers.clean("aire"))
    replace_table(ridership_with_climate(raw("afluencia"), air), layers.clean("afluencia_horaria"), "anio")
    replace_table(clean_incidents(raw("incidentes"), polygons), layers.clean("incidentes"), "anio_accidente")
    replace_table(trips_with_climate(raw("viajes"), air), layers.clean("viajes"), "anio")
    replace_table(placed_counts(raw("aforos"), polygons), layers.clean("aforos_corredor"), "anio")
