"""Placement of rows on shards by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def preference(shard: str, table_size: int, seed: int = 0) -> tuple[int, int]:
    """First slot and step of a shard's permutation of the slots."""
    return _number(f"{seed}:offset:{shard}") % table_size, _number(f"{seed}:skip:{shard}") % (table_size - 1) + 1


def lookup_table(shards: list[str], table_size: int = TABLE_SIZE, seed: int = 0) -> list[int]:
    """The shard (as index into ``shards``) of each slot.

    Every shard prefers the slots in an order of its own, a walk with a fixed
    step through a prime number of slots. The shards take turns; on its turn a
    shard claims the first slot of its order that is still free. All shards end
    with equally many slots, give or take one, and a shard that leaves or joins
    moves few slots of the others.
    """
    if not _is_prime(table_size):
        raise ValueError("the number of slots has to be prime")
    if not 0 < len(shards) <= table_size:
        raise ValueError("between one shard and one shard per slot")
    if len(set(shards)) < len(shards):
        raise ValueError("shards need names of their own")
    walks = [preference(s, table_size, seed) for s in shards]
    at = [first for first, _ in walks]
    table, free = [-1] * table_size, table_size
    while free:
        for i, (_, step) in enumerate(walks):
            slot = at[i]
            while table[slot] >= 0:
                slot = (slot + step) % table_size
            table[slot], at[i] = i, (slot + step) % table_size
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, table_size: int = TABLE_SIZE) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text, modulo the number of slots; a null key counts as empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % table_size


def table_frame(spark: SparkSession, shards: list[str], table_size: int = TABLE_SIZE, seed: int = 0) -> DataFrame:
    """The lookup table as rows (slot, shard); its size is ``table_size``, whatever the data."""
    filled = lookup_table(shards, table_size, seed)
    return spark.createDataFrame(list(enumerate(filled)), "_slot long, _shard int")


def place(
    docs: DataFrame, key: str = "doc_id", n_shards: int = SHARDS, table_size: int = TABLE_SIZE, seed: int = 0,
    alias: str = "shard",
) -> DataFrame:
    """``docs`` with the shard of each row, as an int from 0.

    The placement is one look-up in a table of ``table_size`` rows that is
    broadcast: a fixed bound, 65,537 rows of 12 bytes by default. No row moves,
    so a hot key costs nothing here. Rows with the same key, repeated rows too,
    go to the same shard; rows with a null key go to the shard of the empty
    text. An empty table gives no rows. A column already called ``alias`` is
    replaced; all others pass through.
    """
    shards = [f"shard-{i}" for i in range(n_shards)]
    rows = table_frame(docs.sparkSession, shards, table_size, seed)
    kept = [c for c in docs.columns if c.lower() != alias.lower()]
    placed = docs.select(slot_of(docs[key], table_size).alias("_at"), F.struct(*[docs[c] for c in kept]).alias("_doc"))
    found = placed.join(F.broadcast(rows), F.col("_at") == F.col("_slot"))
    return found.select("_doc.*", F.col("_shard").alias(alias))
