"""Silver tables aggregated into gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.measures import bin_label, rain_flag
from vialis.functions.text import corridor_of, is_known_area
from vialis.operators import classify, graph, rollups
from vialis.plans import DEFAULT, Layers
from vialis.session import settle
from vialis.sources.files import write_json
from vialis.sources.tables import replace_table, with_known_corridors

RISK_AREAS = 8
STREETS_PER_AREA = 25


def ridership_and_air(ridership: DataFrame) -> DataFrame:
    daily = rollups.line_daily(
        ridership, ["fecha", "linea"], "pasajeros", "pm25_promedio_red", "precipitacion_total_mm")
    return rollups.line_monthly(daily, "fecha", "linea")


def severity(incidents: DataFrame) -> DataFrame:
    known = incidents.filter(F.col("comuna").isNotNull()).withColumnRenamed("anio_accidente", "anio")
    table = rollups.severity_table(known, ["anio", "comuna"], "gravedad")
    return rollups.rank_severity(table, "anio", "comuna")


def bike_demand(trips: DataFrame) -> DataFrame:
    binned = trips.withColumns({
        "bin_temperatura": bin_label(F.col("temperatura_promedio_c"), v.TEMPERATURE_BIN),
        "bin_pm25": bin_label(F.col("pm25_promedio"), v.PM25_BIN),
        "llovio": rain_flag(F.col("precipitacion_total_mm")),
    })
    demand = rollups.demand_by_bins(binned, ["fecha", "bin_temperatura", "bin_pm25", "llovio"], "duracion_min")
    return demand.withColumn("anio", F.year("fecha"))


def area_risk(counts: DataFrame, incidents: DataFrame) -> DataFrame:
    known = F.col("comuna").isNotNull()
    volume = rollups.volume_per_area(counts.filter(known), "comuna", "vehiculos", "corredor")
    return rollups.composite_risk(volume, rollups.incidents_per_area(incidents.filter(known), "comuna", "gravedad"), "comuna")


def line_percentiles(ridership: DataFrame, exact: bool = False) -> DataFrame:
    """Percentiles per line and band: approximate, or exact by the exclusive rule."""
    positive = ridership.filter(F.col("pasajeros") > 0)
    measure = rollups.exclusive_percentiles if exact else rollups.percentiles
    return measure(positive, ["linea", "franja_horaria"], "pasajeros")


def risk_corridors(incidents: DataFrame, k: int = RISK_AREAS, streets: int = STREETS_PER_AREA) -> DataFrame:
    """Corridors of the most frequent addresses in the worst areas, and the known ones; the incidents are read once."""
    known = incidents.filter(is_known_area(F.col("comuna"))).withColumn("comuna", F.trim("comuna"))
    counts = settle(rollups.street_counts(known, "comuna", "gravedad", "direccion"))
    frequent = rollups.corridors_at_risk(counts, "comuna", "gravedad", k, streets, dead="Con muertos", injured="Con heridos")
    named = frequent.select(corridor_of(F.col("via")).alias("corredor")).filter(F.col("corredor").isNotNull())
    return with_known_corridors(named)


def export_references(percentiles: DataFrame, corridors: DataFrame, root: str) -> None:
    """The two references of the streaming jobs as JSON below ``root``; corridors one per line."""
    write_json(percentiles, f"{root}/percentiles_linea")
    write_json(corridors.select(F.array("corredor").alias("corredores")).distinct(), f"{root}/corredores_riesgo")


def network_centrality(stations: DataFrame, links: DataFrame) -> DataFrame:
    return graph.centrality(stations, links, "id", "origen", "destino").select(
        "id", "nombre", "linea", "longitud", "latitud", "pagerank", "ranking")


def network_routes(stations: DataFrame, links: DataFrame, sources: DataFrame) -> DataFrame:
    return graph.route_table(graph.shortest_routes(
        stations, links, "id", "nombre", "origen", "destino", "minutos", sources=sources))


def severity_model(incidents: DataFrame, trees: int = v.TREES, depth: int = v.DEPTH):
    """Fitted model and its one-row evaluation."""
    classes = [text for text, _, _ in v.SEVERITIES]
    ready = classify.prepare_features(incidents, "gravedad", "fecha_accidente_ts", classes)
    model, scored = classify.train(ready, "incidente_id", "gravedad", trees=trees, depth=depth)
    return model, classify.evaluation(classify.confusion(scored), trees, depth)


def build(spark: SparkSession, layers: Layers = DEFAULT) -> None:
    clean = lambda name: spark.table(layers.clean(name))
    replace_table(ridership_and_air(clean("afluencia_horaria")), layers.derived("afluencia_vs_pm25"), "anio")
    replace_table(severity(clean("incidentes")), layers.derived("accidentalidad_por_comuna"), "anio")
    replace_table(bike_demand(clean("viajes")), layers.derived("demanda_bici_vs_clima"), "anio")
    replace_table(area_risk(clean("aforos_corredor"), clean("incidentes")), layers.derived("corredores_riesgo_compuesto"))
    replace_table(line_percentiles(clean("afluencia_horaria")), layers.derived("percentiles_linea"))


def build_network(
    spark: SparkSession, stations: DataFrame, links: DataFrame, sources: DataFrame, layers: Layers = DEFAULT
) -> None:
    """Centrality of all stations, and the routes from ``sources``."""
    replace_table(network_centrality(stations, links), layers.derived("red_pagerank"))
    replace_table(network_routes(stations, links, sources), layers.derived("red_rutas_optimas"))


def build_model(spark: SparkSession, path: str, layers: Layers = DEFAULT) -> None:
    model, evaluation = severity_model(spark.table(layers.clean("incidentes")))
    replace_table(evaluation, layers.derived("ml_fatalidad_eval"))
    classify.save(model, path)
