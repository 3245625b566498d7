"""A mix of sources by target weights, in integer numbers of equal-token blocks."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import discard, starts_in_seeded_order, written
from vialis.operators.ranking import running_total

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Plan:
    """What a mix is to hold.

    ``weights`` go round the sources in code point order, null last. The mix has
    ``share`` times all words; a source gives ``passes`` times its words at
    most. ``blocks_per_source`` sets the block size: all blocks together are so
    many times the number of sources, rounded up to a multiple of ``shards``. The
    blocks are smaller where the smallest source would have fewer than
    ``least_blocks`` otherwise, down to one word.
    """

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    passes: int = 2
    shards: int = 8
    blocks_per_source: int = 4096
    least_blocks: int = 256
    seed: int = 11


def n_words(text: Column) -> Column:
    """Number of runs of other characters than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, source: str, plan: Plan = Plan()) -> DataFrame:
    """Weight and target words of each source, from rows (source, source_size).

    What a source cannot give is shared again among the others by weight, until
    no source is above its limit. Each round is one sum over the sources.
    """
    ranked = running_total(sizes, [], [F.col(source).asc_nulls_last()], alias="_rank", settled=True)
    weights = F.array(*[F.lit(w) for w in plan.weights])
    rows = written(ranked.withColumn("weight", F.element_at(
        weights, (F.pmod(F.col("_rank") - 1, F.lit(len(plan.weights))) + 1).cast("int")
    )), "weights")
    limit = F.col("source_size") * F.lit(float(plan.passes))
    total = plan.share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    unit = 0.0
    while True:
        full = limit <= F.col("weight") * F.lit(unit)
        given, weight, filled = rows.agg(
            F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, True)),
        ).first()
        if not weight:
            break
        unit = max(0.0, (total - (given or 0.0)) / weight)
        if rows.filter(limit <= F.col("weight") * F.lit(unit)).count() == filled:
            break
    return rows.withColumn("target", F.least(limit, F.col("weight") * F.lit(unit)))


def quotas(sources: DataFrame, source: str, plan: Plan = Plan()) -> tuple[DataFrame, float]:
    """Blocks of each source per shard, and the words of a block.

    Blocks are seats and targets are votes: source i claims with the quotients
    target / 1, target / 3, target / 5 and so on, and the highest quotients get
    the blocks. The order of the quotients is also the order of the shards:
    each takes the next run of equally many blocks, so every shard holds the
    sources in nearly the target proportions, and the numbers are integers. The
    number of quotients is a parameter times the number of sources, or more, so
    that the smallest source has ``least_blocks`` or blocks of a single word.

    Up to each shard's last block, a source's share bounds the quotients that it
    wins for certain and those that it may win. Only those in between are put in
    order: a few rows per source and shard, however many blocks there are.
    """
    n, words, least = sources.agg(
        F.count(F.lit(1)), F.sum("target"), F.min(F.when(F.col("target") > 0, F.col("target"))),
    ).first()
    if not words:
        return sources.select(source, F.array_repeat(F.lit(0), plan.shards).alias("blocks")), 1.0
    smallest = max(1.0, least / plan.least_blocks)
    per_shard = max(-(-plan.blocks_per_source * n // plan.shards), math.ceil(words / smallest / plan.shards))
    block = words / (per_shard * plan.shards)
    upto = F.col("_cut") * F.lit(per_shard)
    share = F.col("target") / words * upto
    # Rounded shares miss the seats by n / 2 at most, so the divisor that fits differs by n / (2 * seats) of itself.
    off = n / (2 * upto)
    sure = F.greatest(F.lit(0), F.floor(share * (1 - off) - 0.5) - 1).cast("bigint")
    most = (F.ceil(share * (1 + off) + 0.5) + 1).cast("bigint")
    bounds = written(sources.filter("target > 0").select(
        source, "_rank", "target", F.explode(F.sequence(F.lit(1), F.lit(plan.shards))).alias("_cut"),
    ).withColumns({"_sure": sure, "_most": most}), "bounds")
    given = {r["_cut"]: r["_given"] for r in bounds.groupBy("_cut").agg(F.sum("_sure").alias("_given")).collect()}
    free = F.array(*[F.lit(k * per_shard - given[k]).cast("bigint") for k in range(1, plan.shards + 1)])
    claims = bounds.select(
        "_cut", "_rank", "target", F.explode(F.sequence("_sure", "_most")).alias("_seat"),
    ).withColumn("_quotient", F.col("target") / (2 * F.col("_seat") + 1))
    order = [F.col("_quotient").desc(), F.col("_rank"), F.col("_seat")]
    placed = running_total(claims, ["_cut"], order, alias="_place")
    won = F.count(F.when(F.col("_place") <= F.element_at(free, F.col("_cut")), True))
    more = placed.groupBy(F.col("_rank").alias("_r"), F.col("_cut").alias("_k")).agg(won.alias("_won"))
    ends = bounds.join(more, (F.col("_rank") == F.col("_r")) & (F.col("_cut") == F.col("_k")))
    upto = [F.coalesce(F.sum(F.when(F.col("_cut") == k, F.col("_sure") + F.col("_won"))), F.lit(0)) for k in range(plan.shards + 1)]
    counted = ends.groupBy(source).agg(*[(b - a).alias(f"_b{i}") for i, (a, b) in enumerate(zip(upto, upto[1:], strict=False))])
    return counted.select(source, F.array(*[F.col(f"_b{i}") for i in range(plan.shards)]).alias("blocks")), block


@dataclass(frozen=True)
class Mix:
    """``rows``: each document with its place and what the mix takes; ``sources``: targets and blocks per shard.

    Both read ``tables``, which may be discarded when they are not needed any more.
    """

    rows: DataFrame
    sources: DataFrame
    block_words: float
    tables: tuple[DataFrame, ...] = ()


def mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", plan: Plan = Plan(),
    order: str | None = None,
) -> Mix:
    """How many words of each document the mix takes.

    A source's documents stand in a seeded order of their ids (or of the column
    ``order``), one behind the other, and
    that row of words, as often as ``passes`` allows, is cut into blocks of equal
    size. The source's quota is its first blocks, so the taken words differ
    from the target by less than a block, and no document is taken more than
    ``passes`` times. ``rows`` has doc_id, source, size, start (words before it
    in its source), source_size, target, taken. Only ids and counts move.

    Null texts have size 0 and nothing is taken of them; null sources are one
    source, the last one; null ids and repeated rows count like any others; an
    empty table gives empty frames. Other columns of ``docs`` are not used.
    """
    counted = written(docs.select(
        docs[doc_id].alias("doc_id"), docs[source].alias("source"), n_words(docs[text]).alias("size"),
        docs[order or doc_id].alias("_order"),
    ), "sizes")
    sizes = written(counted.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    aimed = targets(sizes, "source", plan)
    seats, block = quotas(aimed, "source", plan)
    seats = seats.withColumnRenamed("source", "_s")
    known = aimed.join(seats, aimed["source"].eqNullSafe(F.col("_s")), "left").drop("_s", "_w")
    blocks = F.coalesce(F.aggregate("blocks", F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    known = written(known.withColumn("_end", F.least(
        F.round(blocks * F.lit(block)).cast("bigint"), F.col("source_size") * plan.passes
    )), "quotas")
    placed = starts_in_seeded_order(counted, "source", "size", "_order", seed=plan.seed)
    to_join = known.select(F.col("source").alias("_s"), "source_size", "target", "_end")
    taken = F.lit(0).cast("bigint")
    for i in range(plan.passes):
        left = F.col("_end") - F.col("source_size") * i - F.col("start")
        taken += F.greatest(F.lit(0), F.least(F.col("size"), left))
    rows = placed.join(to_join, placed["source"].eqNullSafe(F.col("_s"))).withColumn("taken", taken)
    discard(sizes)
    return Mix(rows.drop("_s", "_end", "_order"), known.drop("_end", "_rank"), block, (counted, known))


def pieces(mixed: Mix, plan: Plan = Plan()) -> DataFrame:
    """The parts of documents that make up each shard.

    One row for each run of words of a document in a shard: doc_id, source,
    shard, pass, from_word and to_word (counted in the document, end exclusive).
    """
    sources = mixed.sources
    ends = F.transform(F.sequence(F.lit(1), F.size("blocks")), lambda i: F.aggregate(
        F.slice("blocks", 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x) * F.lit(mixed.block_words))
    limits = sources.filter(F.col("blocks").isNotNull()).select(
        F.col("source").alias("_s"), F.transform(ends, lambda e: F.least(
            F.round(e).cast("bigint"), F.col("source_size") * plan.passes)).alias("_ends"),
    )
    rows = mixed.rows.join(limits, F.col("source").eqNullSafe(F.col("_s")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(plan.passes - 1))).alias("pass"))
    rows = rows.withColumn("_at", F.col("start") + F.col("pass") * F.col("source_size"))
    rows = rows.select("*", F.posexplode("_ends").alias("shard", "_stop"))
    first = F.when(F.col("shard") == 0, F.lit(0)).otherwise(F.element_at("_ends", F.greatest(F.col("shard"), F.lit(1))))
    from_word = F.greatest(F.lit(0), first - F.col("_at"))
    to_word = F.least(F.col("size"), F.col("_stop") - F.col("_at"))
    cut = rows.select("doc_id", "source", "shard", "pass", from_word.alias("from_word"), to_word.alias("to_word"))
    return cut.filter(F.col("from_word") < F.col("to_word"))


def resample(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``docs`` as the mix wants them: whole documents, each as often as its middle word is taken.

    The form for a pipeline: a row is kept, left out or repeated, never cut. A
    document without words is kept once. The columns are those of ``docs``.
    """
    columns = docs.columns
    names = [f"_c{i}" for i in range(len(columns))]
    whole = docs.select(*[docs[c].alias(n) for c, n in zip(columns, names, strict=True)],
                        docs["source"].alias("source"), docs["text"].alias("text"))
    whole = whole.withColumns({"_a": F.xxhash64(*names), "_b": F.xxhash64(F.lit(1), *names)})
    mixed = mix(whole.withColumn("_id", F.struct("_a", "_b")), doc_id="_id", plan=plan)
    blocks = F.aggregate(F.coalesce("blocks", F.array().cast("array<bigint>")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    ends = mixed.sources.select(F.col("source").alias("_s"), (blocks * F.lit(mixed.block_words)).alias("_end"))
    middle = F.col("start") + F.col("size") / 2
    times = F.lit(0)
    for i in range(plan.passes):
        times += F.when(middle + F.col("source_size") * i < F.col("_end"), 1).otherwise(0)
    rows = mixed.rows.join(ends, F.col("source").eqNullSafe(F.col("_s")))
    rows = rows.select("doc_id", F.when(F.col("size") == 0, 1).otherwise(times).alias("_times"))
    # Equal rows have one key: the first of them stands for all, as often as they are taken together.
    lots = rows.groupBy("doc_id").agg(F.sum("_times").cast("int").alias("_times"), F.count(F.lit(1)).alias("_n"))
    lots = written(lots.filter("_times > 0").select("doc_id._a", "doc_id._b", "_times", "_n"), "lots")
    discard(*mixed.tables)
    met = whole.drop("source", "text").join(lots, ["_a", "_b"])
    once = met.filter("_n = 1").unionByName(met.filter("_n > 1").dropDuplicates(["_a", "_b"]))
    repeated = once.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times")))
    return repeated.select(*[F.col(n).alias(c) for c, n in zip(columns, names, strict=True)])
