"""Orders as incident records in the two legacy text layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vialis.functions.calendar import day_first_text
from vialis.functions.geo import pipe_text
from vialis.operators import reports, reshape
from vialis.questions.base import table

# Days that move the order dates to both sides of 2017.
SHIFT_DAYS = 18 * 365
FIRST_NEW_YEAR = 2017


def records(spark, sf_dir):
    """Incident fields per order; the record id is the customer, so ids repeat in both layouts."""
    lon = F.concat(F.lit("-75."), (F.col("o_custkey") % 90 + 10).cast("string"))
    lat = F.concat(F.lit("6."), (F.col("o_orderkey") % 90 + 10).cast("string"))
    shift = F.make_dt_interval(F.lit(SHIFT_DAYS), (F.col("o_orderkey") % 24).cast("int"), F.lit(30))
    return table(spark, sf_dir, "orders").select(
        (F.col("o_orderdate").cast("timestamp") + shift).alias("momento"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(" ")).otherwise(F.col("o_custkey").cast("string")).alias("nro_radicado"),
        F.col("o_orderpriority").alias("clase"),
        F.concat(F.lit(" "), F.col("o_orderstatus")).alias("gravedad"),
        F.lit("Barrio, uno").alias("barrio"),
        F.concat(F.lit("Comuna "), (F.col("o_custkey") % 16).cast("string")).alias("comuna"),
        F.concat(F.lit('CL 10 "B", '), F.col("o_orderkey").cast("string")).alias("direccion"),
        F.concat(F.lit("["), lon, F.lit(", "), lat, F.lit("]")).alias("ubicacion"),
    )


def legacy_lines(df, moment):
    """Text lines in the layout of their year: day-first with seven fields before 2017, else ISO with eight.

    ``df`` has the fields of the newer layout except ``fecha``, which is taken
    from ``moment``.
    """
    at = F.col(moment)
    iso = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000Z"))
    old = df.filter(F.year(at) < FIRST_NEW_YEAR).withColumns(
        {"fecha": day_first_text(at), "ubicacion": pipe_text(F.col("ubicacion"))}
    )
    new = df.filter(F.year(at) >= FIRST_NEW_YEAR).withColumn("fecha", iso)
    line = lambda fields: F.to_csv(F.struct(*fields), {"escape": '"'}).alias("value")
    return old.select(line(reshape.OLD_FIELDS)).unionByName(new.select(line(reshape.NEW_FIELDS)))


def lines(spark, sf_dir):
    """All records as text, beside a line of the wrong length and one with a bad date per urgent order."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    spoiled = urgent.select(F.explode(F.array(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(",a,b")),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(',ayer,c,g,"x, y",dir,1|2')),
        F.lit("   "),
    )).alias("value"))
    return legacy_lines(records(spark, sf_dir), "momento").unionByName(spoiled)


def legacy_normalise(spark, sf_dir):
    return reshape.normalise_legacy(lines(spark, sf_dir))


def legacy_quality(spark, sf_dir):
    return reshape.legacy_counters(lines(spark, sf_dir))


def legacy_rows_per_year(spark, sf_dir):
    return reports.rows_per_year(legacy_normalise(spark, sf_dir))


QUERIES = {q.__name__: q for q in (legacy_normalise, legacy_quality, legacy_rows_per_year)}

_RECORDS = """records AS (
    SELECT CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS nro_radicado,
           o_orderdate + to_days(18 * 365) + to_hours(o_orderkey % 24) + INTERVAL 30 MINUTES AS momento,
           o_orderpriority AS clase, o_orderstatus AS gravedad, 'Barrio, uno' AS barrio,
           'Comuna ' || (o_custkey % 16) AS comuna, 'CL 10 "B", ' || o_orderkey AS direccion,
           '-75.' || (o_custkey % 90 + 10) AS longitud, '6.' || (o_orderkey % 90 + 10) AS latitud FROM orders),
  usable AS (
    SELECT *, strftime(momento, '%Y-%m-%d %H:%M:%S') AS fecha, CASE WHEN year(momento) < 2017 THEN 'pre2017' ELSE 'post2017' END AS layout,
           CASE WHEN year(momento) < 2017 THEN '' ELSE comuna END AS comuna_dada FROM records),
  kept AS (
    SELECT *, row_number() OVER (PARTITION BY nro_radicado ORDER BY CASE WHEN layout = 'post2017' THEN 0 ELSE 1 END, fecha, clase,
           gravedad, barrio, comuna_dada, direccion, longitud, latitud) AS r,
           count(*) OVER (PARTITION BY nro_radicado) AS copies FROM usable WHERE nro_radicado <> ''),
  urgent AS (SELECT count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT')"""

SQL = {
    "legacy_normalise": f"""WITH {_RECORDS}
        SELECT nro_radicado, fecha, CAST(year(momento) AS INTEGER) AS anio, CAST(month(momento) AS INTEGER) AS mes, clase, gravedad,
               barrio, comuna_dada AS comuna, direccion, longitud, latitud FROM kept WHERE r = 1""",
    "legacy_quality": f"""WITH {_RECORDS}
        SELECT 'lineas_malformadas' AS status, n FROM urgent UNION ALL SELECT 'fecha_no_reconocida', n FROM urgent
        UNION ALL SELECT 'sin_radicado', count(*) FROM records WHERE nro_radicado = ''
        UNION ALL SELECT 'esquema_' || layout, count(*) FROM usable WHERE nro_radicado <> '' GROUP BY 1
        UNION ALL SELECT 'duplicados_resueltos', count(*) FROM kept WHERE r = 1 AND copies > 1
        UNION ALL SELECT 'registros_emitidos', count(*) FROM kept WHERE r = 1""",
    "legacy_rows_per_year": f"""WITH {_RECORDS}
        SELECT CAST(year(momento) AS INTEGER) AS anio, count(*) AS n FROM kept WHERE r = 1 GROUP BY 1""",
}
