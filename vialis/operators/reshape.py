"""Wide to long, and the two legacy text layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.functions.calendar import canonical_moment, parse_day, parse_legacy_moment
from vialis.functions.messages import field_count
from vialis.operators.quality import one_per_key

# Fields of a legacy line, by layout, and the canonical columns after normalising.
OLD_FIELDS = ("nro_radicado", "fecha", "clase", "gravedad", "barrio", "direccion", "ubicacion")
NEW_FIELDS = ("nro_radicado", "fecha", "clase", "gravedad", "barrio", "comuna", "direccion", "ubicacion")
CANONICAL = ("nro_radicado", "fecha", "anio", "mes", "clase", "gravedad", "barrio", "comuna",
             "direccion", "longitud", "latitud")
OLD_LAYOUT, NEW_LAYOUT = "pre2017", "post2017"

# Status of a line in the quality counters.
MALFORMED, NO_ID, BAD_DATE = "lineas_malformadas", "sin_radicado", "fecha_no_reconocida"
RESOLVED, EMITTED = "duplicados_resueltos", "registros_emitidos"


def hours_to_rows(df: DataFrame, day: str, line: str, hours: dict[str, int]) -> DataFrame:
    """One row per day, line and hour from one column per hour; columns not listed are left out.

    Rows without a readable day or line, and cells that hold no whole number of
    zero or more, are skipped.
    """
    keyed = df.select(
        parse_day(F.col(day)).alias("fecha"), F.trim(F.col(line)).alias("linea"),
        *[F.col(c).try_cast("bigint").alias(str(h)) for c, h in hours.items()],
    ).filter(F.col("fecha").isNotNull() & (F.col("linea") != ""))
    long = keyed.unpivot(["fecha", "linea"], [str(h) for h in hours.values()], "hora", "pasajeros")
    return long.withColumn("hora", F.col("hora").cast("int")).filter(F.col("pasajeros") >= 0)


def stations_to_rows(df: DataFrame, moment: str, variable: str, stations: Sequence[str] | None = None) -> DataFrame:
    """One row per moment and station from one column per station; blanks are skipped."""
    stations = [c for c in df.columns if c != moment] if stations is None else list(stations)
    typed = df.select(
        F.trim(F.col(f"`{moment}`").cast("string")).alias("timestamp"),
        *[F.trim(F.col(f"`{c}`").cast("string")).try_cast("double").alias(c) for c in stations],
    ).filter(F.col("timestamp") != "")
    long = typed.unpivot(["timestamp"], [F.col(f"`{c}`") for c in stations], "estacion_id", "valor")
    return long.filter(F.col("valor").isNotNull()).select(
        "timestamp", F.trim("estacion_id").alias("estacion_id"), F.lit(variable).alias("variable"), "valor"
    )


def spread_evenly(df: DataFrame, day: str, hour: str, line: str, passengers: str, parts: int = 12) -> DataFrame:
    """Hourly totals resampled to ``parts`` equal times that add up to them; the first ones take the remainder."""
    start = F.col(day).cast("timestamp") + F.make_dt_interval(hours=F.col(hour))
    minute = F.floor(F.col("_i") * 60 / parts).cast("int")
    share = F.floor(F.col(passengers) / parts) + F.when(F.col("_i") < F.col(passengers) % parts, 1).otherwise(0)
    return df.filter(F.col(passengers) > 0).withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        F.trim(F.col(line)).alias("linea"),
        (start + F.make_dt_interval(mins=minute)).alias("timestamp"),
        F.col(hour).cast("int").alias("hora"),
        share.cast("bigint").alias("pasajeros_periodo"),
        F.col(passengers).cast("bigint").alias("pasajeros_hora_total"),
    )


def read_legacy(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Fields of every line with its layout, a ``status`` that says whether it is usable, and the columns in ``keep``."""
    text = F.col(value)
    slots = [f"f{i}" for i in range(len(NEW_FIELDS))]
    parsed = F.from_csv(text, ", ".join(f"{s} string" for s in slots), {"escape": '"'})
    # One generated row per line: the parse runs once, and no later filter is moved before it.
    rows = lines.filter(F.trim(text) != "").select(
        *keep, F.inline(F.array(F.struct(field_count(text).alias("_fields"), parsed.alias("_f"))))
    ).select(*keep, "_fields", "_f.*")
    is_old, is_new = F.col("_fields") == len(OLD_FIELDS), F.col("_fields") == len(NEW_FIELDS)

    def field(name: str) -> Column:
        old = F.col(slots[OLD_FIELDS.index(name)]) if name in OLD_FIELDS else F.lit("")
        chosen = F.when(is_old, old).when(is_new, F.col(slots[NEW_FIELDS.index(name)]))
        return F.coalesce(F.trim(chosen), F.lit("")).alias(name)

    layout = F.when(is_old, F.lit(OLD_LAYOUT)).when(is_new, F.lit(NEW_LAYOUT)).alias("layout")
    rows = rows.select(*keep, layout, *[field(n) for n in NEW_FIELDS])
    place = F.when(
        F.col("layout") == OLD_LAYOUT, F.split("ubicacion", r"\|", 2)
    ).otherwise(F.split(F.regexp_replace("ubicacion", r"[\[\] ]", ""), ",", 2))
    part = lambda at: F.when(F.size(place) == 2, F.trim(F.get(place, F.lit(at)))).otherwise("")
    rows = rows.withColumns({
        "_at": parse_legacy_moment(F.col("fecha")), "longitud": part(0), "latitud": part(1),
    })
    status = (
        F.when(F.col("layout").isNull(), F.lit(MALFORMED))
        .when(F.col("nro_radicado") == "", F.lit(NO_ID))
        .when(F.col("_at").isNull(), F.lit(BAD_DATE))
        .otherwise(F.concat(F.lit("esquema_"), F.col("layout")))
    )
    rows = rows.withColumns({
        "status": status,
        "fecha": canonical_moment(F.col("_at")),
        "anio": F.year("_at"),
        "mes": F.month("_at"),
    })
    # Again one generated row, so that a filter on the status reads it and does not repeat the parse.
    return rows.select(*keep, F.inline(F.array(F.struct("status", "layout", *CANONICAL))))


def _usable(read: DataFrame) -> DataFrame:
    return read.filter(F.col("status").startswith("esquema_"))


def normalise_legacy(lines: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Canonical rows, one per record id: the newer layout wins, then the first by value."""
    usable = _usable(read_legacy(lines, value, keep))
    newest_first = F.when(F.col("layout") == NEW_LAYOUT, 0).otherwise(1)
    order = [newest_first, *[F.col(c) for c in CANONICAL if c != "nro_radicado"]]
    return one_per_key(usable, ["nro_radicado"], order).select(*CANONICAL, *keep)


def legacy_counters(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines per status, ids that had copies, and records written, one row per counter.

    Both kinds of counter start from one count per usable id and status, so the
    text is read and parsed once.
    """
    read = read_legacy(lines, value)
    usable_id = F.when(F.col("status").startswith("esquema_"), F.col("nro_radicado"))
    counted = read.groupBy(usable_id.alias("_id"), "status").agg(F.count(F.lit(1)).alias("n"))
    per_id = counted.groupBy("_id").agg(F.sum("n").alias("n"))
    is_record = F.col("_id").isNotNull()
    written = per_id.agg(
        F.count_if(is_record & (F.col("n") > 1)).alias(RESOLVED), F.count_if(is_record).alias(EMITTED)
    ).unpivot([], [RESOLVED, EMITTED], "status", "n")
    return counted.groupBy("status").agg(F.sum("n").alias("n")).unionByName(written).filter(F.col("n") > 0)
