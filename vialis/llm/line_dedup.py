"""Removal of lines that repeat an earlier line of the collection, nearly or exactly, by a set-similarity join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vialis.llm.common import discard, written

BUCKETS = 65_536
PARTS = 8
BLANKS = "\t\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """Least Jaccard similarity, as a fraction of whole numbers, and how many earlier neighbours a line is held against first."""

    over: int = 4
    under: int = 5
    neighbours: int = 4

    def least_overlap(self, n: Column, m: Column) -> Column:
        """Common tokens that sets of n and m tokens need."""
        return F.ceil(F.lit(self.over) * (n + m) / F.lit(self.over + self.under)).cast("int")

    def prefix(self, n: Column) -> Column:
        """Rarest tokens of which two similar sets share one."""
        return n - F.ceil(F.lit(self.over) * n / F.lit(self.under)).cast("int") + 1

    def short_prefix(self, n: Column) -> Column:
        """The same for two sets of equal size."""
        return n - F.ceil(F.lit(2 * self.over) * n / F.lit(self.over + self.under)).cast("int") + 1


def normal(text: Column) -> Column:
    """Lower case, with blanks for other white space inside lines."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return F.lower(text)


def words(line: Column) -> Column:
    """Words of a normal line, repeats and empty ones included."""
    return F.split(line, " ")


def rarity(docs: DataFrame, text: str) -> Column:
    """Rank of each of 65,536 hash buckets by the number of words that fall into it over all texts, as the upper 16 bits of a long.

    Ranks are counted from the middle: longs have a sign. They are counted by Spark; the driver gets one number per bucket,
    whatever the size of the vocabulary.
    """
    found = docs.select(F.explode(words(F.replace(normal(docs[text]), F.lit("\n"), F.lit(" ")))).alias("w")).filter("w <> ''")
    bucket = F.xxhash64("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    counts = dict(found.groupBy(bucket.alias("b")).count().collect())
    order = sorted(range(BUCKETS), key=lambda b: (counts.get(b, 0), b))
    ranks = [0] * BUCKETS
    for rank, b in enumerate(order):
        ranks[b] = rank
    return F.split(F.lit(",".join(str((rank - BUCKETS // 2) << 48) for rank in ranks)), ",").cast("array<bigint>")


def hashes(line: Column) -> Column:
    """Hashes of the distinct words of a line."""
    return F.array_remove(F.array_distinct(F.transform(words(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def by_rarity(found: Column, ranks: Column) -> Column:
    """Word hashes as longs that sort rarest first.

    The rank of a word's bucket takes the place of the bucket's 16 bits, so the
    long orders by rarity and still names the hash.
    """
    def code(h: Column) -> Column:
        rank = F.get(ranks, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
        return rank.bitwiseOR(F.shiftrightunsigned(h, 16))

    return F.sort_array(F.transform(found, code))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, h, line, words) of every line, in normal form; h is the hash of the whole text."""
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.xxhash64(docs[text]).alias("h"), normal(docs[text]).alias("_text"))
    return rows.select("doc_id", "h", F.posexplode(F.split("_text", "\n")).alias("line", "words"))


def _place() -> Column:
    """A line's place in the collection: by id, null last, then text hash and line number."""
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("h"), F.col("line"))


def _worded(docs: DataFrame, doc_id: str, text: str, ranks: Column) -> DataFrame:
    """(doc_id, h, line, tokens) of every line that has words, its tokens rarest first.

    Lines without words go by their text: a filter on the tokens would have them made twice.
    """
    worded = _lines(docs, doc_id, text).filter(F.trim("words") != "")
    return worded.select("doc_id", "h", "line", by_rarity(hashes(F.col("words")), ranks).alias("tokens"))


def _marked(docs: DataFrame, doc_id: str, text: str, ranks: Column, rule: Rule) -> DataFrame:
    """Every line that has words: its place, the names k1 and k2 of its set, the set's size and prefix.

    The prefix keeps the upper half of each long, rank and 16 bits of the hash:
    enough to find candidates, which are verified by all of their words.
    """
    rows = _worded(docs, doc_id, text, ranks)
    n = F.size("tokens")
    prefix = F.transform(F.slice("tokens", 1, rule.prefix(n)), lambda t: F.shiftright(t, 32).cast("int"))
    # Each word turns one of 64 bits over: sets that differ in d words differ in d bits at most.
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("bigint"), t.bitwiseAND(F.lit(63)).cast("int"))
    bits = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, t: a.bitwiseXOR(bit(t)))
    return written(rows.select(
        "doc_id", "h", "line", F.xxhash64("tokens").alias("k1"), F.xxhash64(F.lit(1), "tokens").alias("k2"), n.alias("n"),
        prefix.alias("prefix"), bits.alias("bits")), "lines")


def _first(lines: DataFrame) -> DataFrame:
    """One row per distinct set: its first place, size, prefix and an id; ids are in the order of the places."""
    rows = lines.select("k1", "k2", _place().alias("first"), "n", "bits", "prefix")
    firsts = rows.groupBy("k1", "k2").agg(
        F.min("first").alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"),
        F.first("prefix").alias("prefix"))
    firsts = firsts.select("k1", "k2", "first.doc_id", "first.h", "first.line", "n", "bits", "prefix")
    order = [F.col("doc_id").asc_nulls_last(), F.col("h"), F.col("line")]
    ordered = firsts.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ordered.withColumn("id", F.monotonically_increasing_id()), "line-sets")


def _postings(firsts: DataFrame, prefix: Column) -> DataFrame:
    """A row for each token of a set's prefix, with its position and what the filters need."""
    return firsts.select("id", "n", "bits", F.posexplode(prefix).alias("q", "token"))


def _reach(rule: Rule, n: Column, q: Column, x: Column, m: Column, r: Column, y: Column) -> Column:
    """Length and positional filter: what is left from the common token on is enough; and the bits x and y differ in no more
    places than the words of similar sets may."""
    lengths = (F.least(n, m) * rule.under >= F.greatest(n, m) * rule.over)
    overlap = rule.least_overlap(n, m)
    return lengths & (F.least(n - q, m - r) >= overlap) & (F.bit_count(x.bitwiseXOR(y)) <= n + m - 2 * overlap)


def _neighbours(firsts: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (earlier, later) of sets that stand next to each other in a token's list."""
    near = W.partitionBy("token").orderBy("id").rowsBetween(-rule.neighbours, -1)
    rows = _postings(firsts, F.slice("prefix", 1, rule.short_prefix(F.col("n"))))
    rows = rows.withColumn("_near", F.collect_list(F.struct("id", "n", "q", "bits")).over(near))
    good = F.filter("_near", lambda x: _reach(rule, x["n"], x["q"], x["bits"], F.col("n"), F.col("q"), F.col("bits")))
    return rows.select(F.explode(good).alias("x"), F.col("id").alias("later")).select(F.col("x.id").alias("earlier"), "later").distinct()


def _others(firsts: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """All pairs (earlier, later) that share a prefix token and whose later set has no match yet."""
    open_ones = firsts.join(found, firsts["id"] == found["later"], "left_anti")
    later = _postings(open_ones, F.col("prefix"))
    earlier = _postings(firsts, F.col("prefix")).withColumnsRenamed({"id": "x_id", "n": "x_n", "q": "x_q", "bits": "x_bits"})
    reach = _reach(rule, F.col("x_n"), F.col("x_q"), F.col("x_bits"), F.col("n"), F.col("q"), F.col("bits"))
    met = later.join(earlier, (later["token"] == earlier["token"]) & (F.col("x_id") < F.col("id")) & reach)
    return met.select(F.col("x_id").alias("earlier"), F.col("id").alias("later")).distinct()


def _bits(part: int) -> Column:
    """64 bits; each word that falls into this part of 64 times ``PARTS`` places turns one of them over."""
    mine = F.filter("tokens", lambda t: F.shiftright(t, 6).bitwiseAND(F.lit(PARTS - 1)) == part)
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("bigint"), t.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(mine, F.lit(0).cast("bigint"), lambda a, t: a.bitwiseXOR(bit(t)))


def _named(marks: DataFrame, side: str, prefix: str) -> DataFrame:
    return marks.select(F.col("id").alias(side), *[F.col(c).alias(prefix + c) for c in marks.columns if c != "id"])


def _wanted_lines(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, words) of the lines (id, _d, h, line) that are ``wanted``, once each.

    Documents meet the list of their wanted lines, so a text moves once at most, however many lines of the collection are wanted.
    """
    lists = wanted.groupBy("_d", "h").agg(F.collect_list(F.struct("line", "id")).alias("_picks"))
    met = texts.join(lists, ["_d", "h"]).dropDuplicates(["_d", "h"]).withColumn("_lines", F.split("_text", "\n"))
    picked = met.select("_lines", F.explode("_picks").alias("_pick"))
    return picked.select("_pick.id", normal(F.get("_lines", F.col("_pick.line"))).alias("words"))


def _verified(pairs: DataFrame, firsts: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The later sets (later) of the pairs whose Jaccard similarity is enough; only their lines are split into words again."""
    pairs = written(pairs, "pairs")
    named = pairs.select(F.col("earlier").alias("id")).unionByName(pairs.select(F.col("later").alias("id"))).distinct()
    wanted = written(firsts.join(named, "id").select("id", F.coalesce("doc_id", F.lit(0)).alias("_d"), "h", "line"), "wanted")
    full = written(_wanted_lines(texts, wanted).select("id", hashes(F.col("words")).alias("tokens")).select(
        "id", "tokens", F.size("tokens").alias("n"), *[_bits(part).alias(f"s{part}") for part in range(PARTS)]), "tokens")
    # Longer marks first: only pairs that they cannot tell apart move with all their words.
    marks = full.drop("tokens")
    near = pairs.join(_named(marks, "later", "x_"), "later").join(_named(marks, "earlier", "y_"), "earlier")
    apart = sum((F.bit_count(F.col(f"x_s{part}").bitwiseXOR(F.col(f"y_s{part}"))) for part in range(PARTS)), F.lit(0))
    least = rule.least_overlap(F.col("x_n"), F.col("y_n"))
    near = written(near.filter(apart <= F.col("x_n") + F.col("y_n") - 2 * least).select("earlier", "later"), "near")
    words_of = full.select("id", "tokens")
    both = near.join(words_of.withColumnsRenamed({"id": "later", "tokens": "y"}), "later")
    both = both.join(words_of.withColumnsRenamed({"id": "earlier", "tokens": "x"}), "earlier")
    common = F.size(F.array_intersect("x", "y"))
    good = common >= rule.least_overlap(F.size("x"), F.size("y"))
    matched = written(both.filter(good).select("later").distinct(), "matched")
    discard(pairs, wanted, full, near)
    return matched


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """(doc_id, h, n_lines, removed) of every row: h is the text's hash, removed the sorted numbers of its lines that go, from 0.

    A line goes if its set of lower-case words has a Jaccard similarity of at
    least ``over / under`` with that of an earlier line; earlier is by doc_id,
    then text hash, then line number, and lines that go count as earlier ones,
    too. Equal sets are joined once. Tokens stand rarest first; two similar sets
    share one of the first few (prefix filter), are nearly of one length and
    have enough tokens left behind the common one (positional filter). Each set
    first meets its neighbours in the lists of its tokens; most sets in a large
    group of near copies find their match there and need no more pairs, all others
    meet every earlier set of their lists. So a hot group costs rows for its
    members, not for its pairs.

    Null texts have no lines; lines without words stay; a null doc_id comes
    last; rows equal in id and text are one document and lose the same lines; an
    empty table gives no rows. Other columns are not used.
    """
    marked = _marked(docs, doc_id, text, rarity(docs, text), rule)
    texts = docs.select(F.coalesce(docs[doc_id].cast("bigint"), F.lit(0)).alias("_d"), F.xxhash64(docs[text]).alias("h"),
                        docs[text].alias("_text"))
    firsts = _first(marked)
    near = _verified(_neighbours(firsts, rule), firsts, texts, rule)
    rest = _verified(_others(firsts, near, rule), firsts, texts, rule)
    gone = near.unionByName(rest).withColumn("gone", F.lit(True))
    judged = firsts.join(gone, firsts["id"] == gone["later"], "left").select(
        "k1", "k2", _place().alias("first"), F.coalesce("gone", F.lit(False)).alias("gone"))
    again = marked.select("doc_id", "h", "line", "k1", "k2").join(judged, ["k1", "k2"]).filter(F.col("gone") | (_place() != F.col("first")))
    lists = written(again.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("line")).alias("removed")), "removed")
    discard(marked, firsts, near, rest)
    lists = lists.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "removed")
    rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), F.xxhash64(docs[text]).alias("h"),
                       F.coalesce(F.size(F.split(docs[text], "\n")), F.lit(0)).alias("n_lines"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0)))
    joined = rows.join(lists, rows["doc_id"].eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left")
    return joined.select("doc_id", "h", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``docs`` with the lines that ``removed_lines`` names taken out of the text; all columns pass through."""
    lists = removed_lines(docs, doc_id, text, rule).filter(F.size("removed") > 0).dropDuplicates(["doc_id", "h"])
    lists = lists.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), F.col("removed").alias("_r"))
    columns = docs.columns
    whole = docs.select(docs[doc_id].cast("bigint").alias("_id"), F.xxhash64(docs[text]).alias("_x"), docs[text].alias("_text"),
                        F.struct(*[docs[c] for c in columns]).alias("_doc"))
    joined = whole.join(lists, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h")), "left")
    kept = F.filter(F.split("_text", "\n"), lambda line, i: ~F.array_contains("_r", i))
    new = F.when(F.col("_r").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[new.alias(c) if c == text else F.col("_doc")[c].alias(c) for c in columns])
