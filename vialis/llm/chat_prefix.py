"""Chat formatting: one training example for each assistant turn, with all turns before it as context."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Control strings around a turn. Each one holds ``<`` or ``[``, which escaped texts never do."""

    open: str = "<s>"
    says: str = "[INST]"
    close: str = "</s>"


TEMPLATE = Template()
# In the order of escaping; read back in the reverse order.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))


def escaped(text: Column) -> Column:
    """The text without any ``<`` or ``[``, so that no control string can stand in it; null is empty."""
    text = F.coalesce(text, F.lit(""))
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given."""
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def examples(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    reply_role: str = "assistant", template: Template = TEMPLATE,
) -> DataFrame:
    """Examples (conv_id, example, target_turn, formatted, loss_start, loss_end) of all conversations.

    Example i of a conversation holds all turns up to its i-th reply; only the
    code points from loss_start to loss_end (exclusive), the reply's escaped
    text, are trainable. Where turns follow the last reply, or there is none, a
    last example without a target holds the whole conversation: loss_start and
    loss_end are its length and target_turn is null. So no turn is lost.

    One shuffle by conversation; the row that gathers a conversation is no
    larger than its last example. The examples of a conversation with n replies
    take n times its text at most: that is what prefix expansion makes.

    Turns are in the order of ``turn``, null first, then role and text, so equal
    turn numbers have a defined order and repeated rows stay. A null role is an
    empty role and is never trained; a null conv_id is one conversation of its
    own, as in GROUP BY. An empty table gives no examples. Other columns of
    ``turns`` are not used.
    """
    rows = turns.select(
        turns[conv_id].alias("conv_id"), turns[turn].alias("turn"),
        F.coalesce(turns[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(turns[text].cast("string"), F.lit("")).alias("text"),
    )
    in_order = F.array_sort(F.collect_list(F.struct(F.coalesce("turn", F.lit(-(2**63)).cast("bigint")).alias("at"), "role", "text", "turn")))
    talks = rows.groupBy("conv_id").agg(in_order.alias("turns"))
    part = lambda t: F.struct(
        F.concat(F.lit(template.open), escaped(t["role"]), F.lit(template.says)).alias("head"),
        escaped(t["text"]).alias("body"), (t["role"] == reply_role).alias("reply"), t["turn"].alias("turn"),
    )
    talks = talks.select("conv_id", F.transform("turns", part).alias("parts"))
    replies = F.filter(F.sequence(F.lit(1), F.size("parts")), lambda i: F.element_at("parts", i)["reply"])
    ends = F.when(F.element_at("parts", -1)["reply"], replies).otherwise(F.concat(replies, F.array(F.size("parts"))))
    rows = talks.select("conv_id", "parts", F.posexplode(ends).alias("example", "upto"))
    whole = lambda t: F.concat(t["head"], t["body"], F.lit(template.close))
    last = F.element_at("parts", F.col("upto"))
    rows = rows.select(
        "conv_id", "example", last.alias("last"),
        F.array_join(F.transform(F.slice("parts", 1, F.col("upto")), whole), "").alias("formatted"),
    )
    end = F.length("formatted") - len(template.close)
    return rows.select(
        "conv_id", "example", F.when(F.col("last.reply"), F.col("last.turn")).alias("target_turn"), "formatted",
        F.when(F.col("last.reply"), end - F.length("last.body")).otherwise(F.length("formatted")).alias("loss_start"),
        F.when(F.col("last.reply"), end).otherwise(F.length("formatted")).alias("loss_end"),
    )


def parsed(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Turns (role, text) read back from a formatted example."""
    spans = F.filter(F.split(formatted, F.lit(template.close)), lambda x: x != "")
    said = lambda x: F.substring_index(x, template.says, 1)
    return F.transform(spans, lambda x: F.struct(
        unescaped(F.substring(said(x), F.lit(len(template.open) + 1), F.length(said(x)))).alias("role"),
        unescaped(F.substring(x, F.length(said(x)) + len(template.says) + 1, F.length(x))).alias("text"),
    ))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescaped(F.substring(formatted, start + 1, end - start))


def digest(found: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What examples hold, read back from them, one row per conversation."""
    grouped = found.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("longest"),
        F.array_sort(F.collect_list(F.struct("example", loss_text(
            F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("loss")))).alias("losses"),
        F.sum(F.length("formatted")).cast("bigint").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_examples"),
    )
    turns = parsed(F.col("longest"), template)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    return grouped.withColumn("turns", turns).withColumn("loss", loss).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples",
    )
