"""Keyed pseudonyms."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
PLACEHOLDER_KEY = "cambia-esta-clave"


def pseudonym(value: Column, key: str) -> Column:
    """HMAC-SHA256 of the text, in hex; null stays null. A missing key is an error.

    Both padded key blocks become literals of the plan, so event logs and query
    listings must be as private as the key; set ``spark.redaction.string.regex``
    where they are not.
    """
    if not key or key.startswith(PLACEHOLDER_KEY):
        raise ValueError("a pseudonym needs a real key")
    secret = key.encode("utf-8")
    if len(secret) > BLOCK:
        secret = hashlib.sha256(secret).digest()
    secret = secret.ljust(BLOCK, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in secret)) for pad in (0x36, 0x5C))
    digest = F.unhex(F.sha2(F.concat(inner, F.encode(value, "UTF-8")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def pseudonymise(df: DataFrame, column: str, key: str, alias: str = "usuario_pseudo") -> DataFrame:
    """Add the pseudonym and drop the column it came from."""
    return df.withColumn(alias, pseudonym(F.col(column).cast("string"), key)).drop(column)
