"""Names, addresses and areas as text."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis import vocabulary as v


def plain_name(name: str) -> str:
    """Lower case without accents; blanks, dots and slashes become underscores."""
    letters = unicodedata.normalize("NFKD", name.lower())
    letters = "".join(c for c in letters if not unicodedata.combining(c))
    return re.sub(r"[ ./]", "_", letters)


def plain_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`plain_name`; two columns on one name are an error."""
    names = [plain_name(c) for c in df.columns]
    doubled = sorted(n for n, times in Counter(names).items() if times > 1)
    if doubled:
        raise ValueError(f"columns fall on the same name: {doubled}")
    return df.toDF(*names)


def is_known_area(area: Column) -> Column:
    """False for null and for names that stand for an unknown area."""
    return area.isNotNull() & ~F.upper(F.trim(area)).isin(*v.PLACEHOLDER_AREAS)


def corridor_of(address: Column) -> Column:
    """Corridor an address lies on: street kind and token, else a keyword's corridor, else null."""
    street = F.upper(F.trim(address))
    kind, token = (F.regexp_extract(street, v.STREET_PATTERN, group) for group in (1, 2))
    corridor = F.when(kind != "", F.concat_ws(" ", F.initcap(kind), token))
    for word, name in v.STREET_KEYWORDS:
        corridor = corridor.when(street.contains(word), F.lit(name))
    return corridor


def is_interchange(line: Column) -> Column:
    """True for stations served by more than one line, written ``A/B``."""
    return line.contains("/")


def zone_of(municipality: Column) -> Column:
    zones = F
    for name, members in v.ZONES:
        zones = zones.when(municipality.isin(*members), F.lit(name))
    return zones.otherwise(F.lit(v.ZONE_DEFAULT))


def is_official_boundary(name: Column, level: Column) -> Column:
    """Numbered urban divisions at level 8, listed rural divisions at level 7 or 8."""
    rural = name.isin(*v.RURAL_DIVISIONS)
    urban = name.rlike(r"(?i)^Comuna\s+\d+")
    return F.coalesce(((level == "8") & (urban | rural)) | ((level == "7") & rural), F.lit(False))


def boundary_kind(level: Column) -> Column:
    return F.when(level == "7", F.lit("corregimiento")).otherwise(F.lit("comuna"))


def belongs_to_network(name: Column, network: Column, brand: str) -> Column:
    """A named station whose network, or name where it has none, carries the brand."""
    network = F.lower(F.coalesce(network, F.lit("")))
    carrier = F.when(network != "", network).otherwise(F.lower(F.trim(name)))
    return F.coalesce((F.trim(name) != "") & carrier.contains(brand.lower()), F.lit(False))
