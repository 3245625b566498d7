"""Orders as incidents: the status is the severity, the customer's nation the area."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialis import vocabulary as v
from vialis.functions.text import corridor_of, is_known_area
from vialis.operators import reports, rollups
from vialis.operators.ranking import first_rows
from vialis.questions.base import sql_shown, table, with_shown
from vialis.session import settle
from vialis.sources.tables import with_known_corridors

CLASSES = (("F", "con_heridos", 1.0), ("O", "con_muertos", 5.0), ("P", "solo_danos", 0.1))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", F.col("n_name").alias("comuna"),
                F.year("o_orderdate").alias("anio"), F.col("o_orderstatus").alias("gravedad"))
    )


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.severity_table(incidents(spark, sf_dir), ["anio", "comuna"], "gravedad", CLASSES)


def severity_by_area_year(spark, sf_dir):
    return with_shown(rollups.rank_severity(severity(spark, sf_dir), "anio", "comuna"), "indice_severidad")


def severity_top_latest_year(spark, sf_dir):
    order = [F.desc("indice_severidad"), F.asc("comuna")]
    table = settle(severity(spark, sf_dir))
    return with_shown(reports.latest_year_top(table, "anio", order, 5), "indice_severidad")


def volume(spark, sf_dir):
    """Line quantities as vehicles, suppliers as corridors; added up per supplier before any join."""
    items, supplier, nation = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    per_corridor = items.groupBy("l_suppkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("vehiculos"))
    return (
        per_corridor.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("comuna"), "l_suppkey", "vehiculos")
    )


def composite_risk(spark, sf_dir):
    volumes = rollups.volume_per_area(volume(spark, sf_dir), "comuna", "vehiculos", "l_suppkey")
    counts = rollups.incidents_per_area(incidents(spark, sf_dir), "comuna", "gravedad", dead="O", injured="F")
    return rollups.composite_risk(volumes, counts, "comuna")


def composite_risk_top(spark, sf_dir):
    return first_rows(composite_risk(spark, sf_dir), [F.asc("score_riesgo"), F.asc("comuna")], 10)


def corridors_approx(spark, sf_dir):
    return rollups.approximate_corridors(volume(spark, sf_dir), "comuna", "l_suppkey")


def corridors_estimate(spark, sf_dir):
    """Whether the estimated distinct suppliers per nation are within four times the asked error of the exact count."""
    rows = volume(spark, sf_dir)
    exact = rows.groupBy("comuna").agg(F.countDistinct("l_suppkey").alias("exacto"))
    near = F.abs(F.col("corredores_aprox") - F.col("exacto")) <= F.greatest(F.lit(1.0), F.col("exacto") * 0.2)
    return exact.join(rollups.approximate_corridors(rows, "comuna", "l_suppkey"), "comuna").select("comuna", "exacto", near.alias("cerca"))


def severity_with_others(spark, sf_dir):
    """Two of the three classes listed: the third is counted beside them."""
    return rollups.severity_table(incidents(spark, sf_dir), ["comuna"], "gravedad", CLASSES[:2], others="otros").select(
        "comuna", "con_heridos", "con_muertos", "incidentes_total", "otros")


def area_history(spark, sf_dir):
    return with_shown(reports.deadliest_areas(severity(spark, sf_dir), "comuna"), "severidad_promedio")


def deaths_per_year(spark, sf_dir):
    return reports.deaths_per_year(severity(spark, sf_dir))


def severity_reports(spark, sf_dir):
    return with_shown(reports.severity_by(severity(spark, sf_dir), "comuna", "anio"), "severidad_media")


def top_areas_report(spark, sf_dir):
    areas = reports.severity_by(severity(spark, sf_dir), "comuna")
    return with_shown(first_rows(areas, [F.desc("muertos"), F.asc("comuna")], 5), "severidad_media")


def most_severe_report(spark, sf_dir):
    return with_shown(reports.most_severe(severity(spark, sf_dir), "anio", "comuna"), "indice_severidad")


def yearly_air(spark, sf_dir):
    """Monthly mean tax of the lines shipped, in the place of a monthly air average."""
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(F.year("l_shipdate").alias("anio"), F.month("l_shipdate").alias("mes")).agg(
        F.avg("l_tax").alias("pm25_promedio_mes")
    )


def deaths_and_air(spark, sf_dir):
    joined = reports.deaths_and_air(yearly_air(spark, sf_dir), severity(spark, sf_dir))
    return with_shown(joined, "pm25_promedio_anual")


def corr_scalar(spark, sf_dir):
    joined = reports.deaths_and_air(yearly_air(spark, sf_dir), severity(spark, sf_dir))
    return with_shown(reports.scalar_correlation(joined, "pm25_promedio_anual", "muertos_total"), "correlacion")


def placed(spark, sf_dir):
    """Incidents with a street made of the priority and the customer, and some unknown areas."""
    number, rank = F.col("o_custkey").cast("string"), F.substring("o_orderpriority", 1, 1)
    street = (
        F.when(rank == "1", F.concat(F.lit("Calle "), number))
        .when(rank == "2", F.concat(F.lit(" cr "), number, F.lit(" # 10")))
        .when(rank == "3", F.concat(F.lit("Autopista Norte "), number))
        .when(rank == "4", F.concat(F.lit("AVENIDA"), number))
        .otherwise(F.lit(""))
    )
    area = F.when(F.col("comuna") == "NATION_0", F.lit(" sd ")).when(
        F.col("comuna") == "NATION_1", F.lit("No_Definido")).otherwise(F.col("comuna"))
    return incidents(spark, sf_dir).withColumns({"direccion": street, "comuna": area}).filter(
        is_known_area(F.col("comuna"))
    )


def area_scores(spark, sf_dir):
    return rollups.area_ranking(placed(spark, sf_dir), "comuna", "gravedad", dead="O", injured="F")


def area_score_top(spark, sf_dir):
    return first_rows(area_scores(spark, sf_dir), [F.desc("score"), F.asc("comuna")], 8)


def top_streets(spark, sf_dir):
    return rollups.frequent_streets(placed(spark, sf_dir), "comuna", "direccion")


def risk_corridors(spark, sf_dir):
    """The joins behind the incidents run once: both steps read the counts per area, severity and street."""
    counts = settle(rollups.street_counts(placed(spark, sf_dir), "comuna", "gravedad", "direccion"))
    streets = rollups.corridors_at_risk(counts, "comuna", "gravedad", 8, 25, dead="O", injured="F")
    corridors = streets.select(corridor_of(F.col("via")).alias("corredor")).filter(F.col("corredor").isNotNull())
    return with_known_corridors(corridors)


def street_to_corridor(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    kinds = {"ECONOMY": " calle ", "SMALL": "Tv", "MEDIUM": "AVENIDA ", "PROMO": "Autopista Norte ",
             "STANDARD": "Parque Oriental ", "LARGE": "Vereda "}
    street = F
    for kind, text in kinds.items():
        street = street.when(F.col("p_type") == kind, F.concat(F.lit(text), F.col("p_size").cast("string"), F.lit("b # 3")))
    return parts.select("p_partkey", corridor_of(street).alias("corredor"))


def area_frequency(spark, sf_dir):
    return reports.frequencies(incidents(spark, sf_dir), "gravedad", "comuna")


def gold_row_counts(spark, sf_dir):
    return reports.row_counts({
        "accidentalidad_por_comuna": severity(spark, sf_dir),
        "corredores_por_comuna": volume(spark, sf_dir),
        "incidentes": incidents(spark, sf_dir),
    })


QUERIES = {q.__name__: q for q in (
    severity_by_area_year, severity_top_latest_year, composite_risk, composite_risk_top, corridors_approx,
    area_history, deaths_per_year, severity_reports, top_areas_report, most_severe_report, deaths_and_air,
    corr_scalar, area_score_top, top_streets, risk_corridors, street_to_corridor, area_frequency, gold_row_counts,
    corridors_estimate, severity_with_others,
)}

_INCIDENTS = """incidents AS (
    SELECT o_orderkey, o_custkey, o_orderpriority, n_name AS comuna, CAST(year(o_orderdate) AS INTEGER) AS anio,
           o_orderstatus AS gravedad
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_SEVERITY = _INCIDENTS + """, severity AS (
    SELECT anio, comuna, con_heridos, con_muertos, solo_danos,
           con_heridos + con_muertos + solo_danos AS incidentes_total,
           con_heridos * 1.0e0 + con_muertos * 5.0e0 + solo_danos * 0.1e0 AS indice_severidad
    FROM (SELECT anio, comuna, count(*) FILTER (gravedad = 'F') AS con_heridos,
                 count(*) FILTER (gravedad = 'O') AS con_muertos, count(*) FILTER (gravedad = 'P') AS solo_danos
          FROM incidents GROUP BY ALL))"""
_RISK = _INCIDENTS + """, vol AS (
    SELECT n_name AS comuna, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS vehiculos_total,
           count(DISTINCT l_suppkey) AS corredores_distintos
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
  inc AS (
    SELECT comuna, count(*) AS incidentes_total, count(*) FILTER (gravedad = 'O') AS con_muertos,
           count(*) FILTER (gravedad = 'F') AS con_heridos FROM incidents GROUP BY 1),
  risk AS (
    SELECT *, CAST(rank_volumen + rank_severidad AS INTEGER) AS score_riesgo FROM (
      SELECT comuna, vehiculos_total, corredores_distintos, incidentes_total, con_muertos, con_heridos,
             CAST(row_number() OVER (ORDER BY vehiculos_total DESC, comuna) AS INTEGER) AS rank_volumen,
             CAST(row_number() OVER (ORDER BY con_muertos * 5 + con_heridos DESC, comuna) AS INTEGER) AS rank_severidad
      FROM vol JOIN inc USING (comuna)))"""
_AIR = """air AS (SELECT anio, avg(m) AS a FROM (
    SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, month(l_shipdate) AS mes, avg(l_tax) AS m FROM lineitem GROUP BY 1, 2)
    GROUP BY 1),
  both_sides AS (SELECT anio, a AS pm25_promedio_anual, muertos_total FROM air JOIN (
    SELECT anio, CAST(sum(con_muertos) AS BIGINT) AS muertos_total FROM severity GROUP BY 1) USING (anio))"""
_PLACED = _INCIDENTS + """, placed AS (
    SELECT comuna, gravedad, CASE o_orderpriority[1:1]
        WHEN '1' THEN 'CALLE ' || o_custkey WHEN '2' THEN 'CR ' || o_custkey || ' # 10'
        WHEN '3' THEN 'AUTOPISTA NORTE ' || o_custkey WHEN '4' THEN 'AVENIDA' || o_custkey ELSE '' END AS via
    FROM incidents WHERE comuna NOT IN ('NATION_0', 'NATION_1')),
  scores AS (
    SELECT comuna, count(*) FILTER (gravedad = 'O') AS muertos, count(*) FILTER (gravedad = 'F') AS heridos,
           count(*) FILTER (gravedad = 'P') AS danos FROM placed GROUP BY 1),
  best AS (
    SELECT *, CAST(round(CAST(muertos * 5 + heridos AS DECIMAL(18,1)) + CAST(danos AS DECIMAL(18,1)) / 10, 1) AS DOUBLE) AS score
    FROM scores ORDER BY score DESC, comuna LIMIT 8),
  streets AS (
    SELECT comuna, via, n FROM (
      SELECT *, row_number() OVER (PARTITION BY comuna ORDER BY n DESC, via) AS r
      FROM (SELECT comuna, via, count(*) AS n FROM placed WHERE via <> '' GROUP BY 1, 2)) WHERE r <= 25)"""
_STREET_KINDS = "'^(AVENIDA|AV|CALLE|CL|CARRERA|CR|TRANSVERSAL|TV|DIAGONAL|DG)\\s*([0-9A-Z]+)'"


def _sql_corridor(street: str) -> str:
    kind = f"regexp_extract({street}, {_STREET_KINDS}, 1)"
    return (f"CASE WHEN {kind} <> '' THEN {kind}[1:1] || lower({kind}[2:]) || ' ' || "
            f"regexp_extract({street}, {_STREET_KINDS}, 2) WHEN contains({street}, 'AUTOPISTA') THEN 'Autopista' "
            f"WHEN contains({street}, 'BOLIVARIANA') THEN 'Avenida Bolivariana' "
            f"WHEN contains({street}, 'ORIENTAL') THEN 'Avenida Oriental' END")


SQL = {
    "corridors_estimate": """SELECT n_name AS comuna, count(DISTINCT l_suppkey) AS exacto, true AS cerca
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
    "severity_with_others": f"""WITH {_INCIDENTS}
        SELECT comuna, count(*) FILTER (gravedad = 'F') AS con_heridos, count(*) FILTER (gravedad = 'O') AS con_muertos,
               count(*) FILTER (gravedad IN ('F', 'O')) AS incidentes_total, count(*) FILTER (gravedad NOT IN ('F', 'O')) AS otros
        FROM incidents GROUP BY 1""",
    "severity_by_area_year": f"""WITH {_SEVERITY}
        SELECT anio, comuna, con_heridos, con_muertos, solo_danos, incidentes_total,
               {sql_shown('indice_severidad')} AS indice_severidad,
               CAST(row_number() OVER (PARTITION BY anio ORDER BY indice_severidad DESC, comuna) AS INTEGER)
                   AS ranking_severidad FROM severity""",
    "severity_top_latest_year": f"""WITH {_SEVERITY}
        SELECT anio, comuna, con_heridos, con_muertos, solo_danos, incidentes_total,
               {sql_shown('indice_severidad')} AS indice_severidad
        FROM severity WHERE anio = (SELECT max(anio) FROM severity)
        ORDER BY severity.indice_severidad DESC, comuna LIMIT 5""",
    "composite_risk": f"WITH {_RISK} SELECT * FROM risk",
    "composite_risk_top": f"WITH {_RISK} SELECT * FROM risk ORDER BY score_riesgo, comuna LIMIT 10",
    "area_history": f"""WITH {_SEVERITY}
        SELECT comuna, CAST(sum(incidentes_total) AS BIGINT) AS incidentes_totales,
               CAST(sum(con_muertos) AS BIGINT) AS total_muertos, CAST(sum(con_heridos) AS BIGINT) AS total_heridos,
               {sql_shown('avg(indice_severidad)')} AS severidad_promedio
        FROM severity GROUP BY comuna ORDER BY total_muertos DESC, comuna LIMIT 10""",
    "deaths_per_year": f"""WITH {_SEVERITY}
        SELECT anio, CAST(sum(con_muertos) AS BIGINT) AS muertos_total FROM severity GROUP BY anio""",
    "severity_reports": f"""WITH {_SEVERITY}
        SELECT comuna, anio, CAST(sum(con_muertos) AS BIGINT) AS muertos, CAST(sum(con_heridos) AS BIGINT) AS heridos,
               {sql_shown('avg(indice_severidad)')} AS severidad_media FROM severity GROUP BY comuna, anio""",
    "top_areas_report": f"""WITH {_SEVERITY}
        SELECT comuna, CAST(sum(con_muertos) AS BIGINT) AS muertos, CAST(sum(con_heridos) AS BIGINT) AS heridos,
               {sql_shown('avg(indice_severidad)')} AS severidad_media FROM severity GROUP BY comuna
        ORDER BY muertos DESC, comuna LIMIT 5""",
    "most_severe_report": f"""WITH {_SEVERITY}
        SELECT anio, comuna, incidentes_total, {sql_shown('indice_severidad')} AS indice_severidad
        FROM severity ORDER BY severity.indice_severidad DESC, anio, comuna LIMIT 10""",
    "deaths_and_air": f"""WITH {_SEVERITY}, {_AIR}
        SELECT anio, {sql_shown('pm25_promedio_anual')} AS pm25_promedio_anual, muertos_total FROM both_sides""",
    "corr_scalar": f"""WITH {_SEVERITY}, {_AIR}
        SELECT {sql_shown('corr(pm25_promedio_anual, muertos_total)')} AS correlacion FROM both_sides""",
    "area_score_top": f"WITH {_PLACED} SELECT comuna, muertos, heridos, danos, score FROM best",
    "top_streets": f"WITH {_PLACED} SELECT comuna, via, n FROM streets",
    "risk_corridors": f"""WITH {_PLACED}
        SELECT {_sql_corridor('via')} AS corredor FROM streets WHERE comuna IN (SELECT comuna FROM best)
        UNION SELECT unnest([{', '.join(f"'{c}'" for c in v.KNOWN_CORRIDORS)}])""",
    "street_to_corridor": f"""WITH streets AS (
        SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'CALLE ' WHEN 'SMALL' THEN 'TV' WHEN 'MEDIUM' THEN 'AVENIDA '
            WHEN 'PROMO' THEN 'AUTOPISTA NORTE ' WHEN 'STANDARD' THEN 'PARQUE ORIENTAL ' ELSE 'VEREDA ' END
            || p_size || 'B # 3' AS via FROM part)
        SELECT p_partkey, {_sql_corridor('via')} AS corredor FROM streets""",
    "area_frequency": f"WITH {_INCIDENTS} SELECT gravedad, comuna, count(*) AS n FROM incidents GROUP BY 1, 2",
    "gold_row_counts": f"""WITH {_SEVERITY}
        SELECT 'accidentalidad_por_comuna' AS tabla, count(*) AS filas FROM severity
        UNION ALL SELECT 'corredores_por_comuna', count(DISTINCT l_suppkey) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        UNION ALL SELECT 'incidentes', count(*) FROM incidents""",
}
