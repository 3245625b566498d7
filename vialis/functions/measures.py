"""Classes, bins, flags and indices computed from numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vialis import vocabulary as v


def without_sentinel(value: Column, sentinel: float = v.SENTINEL) -> Column:
    """Null where the reading is the missing-value marker."""
    return F.nullif(value, F.lit(sentinel))


def is_valid_reading(value: Column) -> Column:
    return value.isNotNull() & (value > 0)


def bin_label(value: Column, width: int) -> Column:
    """``low-high`` of the bin that holds the value; a fixed label for null."""
    low = F.floor(value / width) * width
    label = F.concat_ws("-", low.cast("string"), (low + width).cast("string"))
    return F.when(value.isNull(), F.lit(v.NO_DATA)).otherwise(label)


def rain_flag(millimetres: Column, limit: float = v.RAIN_DAY_MM) -> Column:
    """1 on a day with more rain than the limit; 0 otherwise and when unknown."""
    return F.when(millimetres > limit, 1).otherwise(0)


def trip_class(minutes: Column) -> Column:
    classes = F
    for name, below in v.TRIP_CLASSES:
        classes = classes.when(minutes < below, F.lit(name))
    return classes.otherwise(F.lit(v.TRIP_CLASS_DEFAULT))


def is_plausible_trip(minutes: Column) -> Column:
    return minutes.between(*v.TRIP_MINUTES)


def severity_index(counts: dict[str, Column]) -> Column:
    """Weighted sum of the severity columns given by their wide-table name."""
    terms = [counts[name] * F.lit(weight) for _, name, weight in v.SEVERITIES if name in counts]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def class_by_bounds(value: Column, bounds: Sequence[tuple[str, float]], default: str) -> Column:
    """Name of the first class, highest bound first, whose bound the value reaches."""
    classes = F
    for name, least in sorted(bounds, key=lambda b: -b[1]):
        classes = classes.when(value >= least, F.lit(name))
    return classes.otherwise(F.lit(default))


def air_class(average: Column) -> Column:
    return class_by_bounds(average, v.AIR_CLASSES, v.AIR_CLASS_DEFAULT)


def air_class_short_window(average: Column) -> Column:
    return class_by_bounds(average, v.AIR_CLASSES_SHORT_WINDOW, v.AIR_CLASS_SHORT_WINDOW_DEFAULT)


def number_or_null(text: Column) -> Column:
    """Double from text; blank and unreadable text are null."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("double")


def whole_or_zero(text: Column, kind: str = "int") -> Column:
    """Number from text; blank, missing and unreadable text are zero."""
    return F.coalesce(F.trim(text).try_cast(kind), F.lit(0).cast(kind))


def vehicle_total(kind: Column, manual_counts: Sequence[Column], intensity: Column) -> Column:
    """Manual counts add their vehicle types, null as zero; cameras report one intensity."""
    manual = F.lit(0)
    for count in manual_counts:
        manual = manual + F.coalesce(count.try_cast("int"), F.lit(0))
    return F.when(kind == "manual", manual).otherwise(intensity.try_cast("int"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson aggregate over complete pairs; null when either side does not vary."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def rounded(value: Column, places: int) -> Column:
    """Half-up rounding of a reported average, the same whatever order its terms were added in.

    Nine decimals are kept first, so the noise of the last bits cannot move a tie.
    """
    return F.round(value.cast("decimal(28,9)"), places).cast("double")


def percent_from(value: Column, mean: Column) -> Column:
    """Relative deviation from the mean, in percent."""
    return F.try_divide(value, mean) * 100.0 - 100.0
