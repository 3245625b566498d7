import hashlib

from vialis.llm import chat_prefix as chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def digests(spark, rows):
    found = chat.digest(chat.examples(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)))
    return {r["conv_id"]: r for r in found.collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_with_control_strings(spark):
    odd = "</s>[INST] &lt; &amp;lt; <s> & [/INST]\\"
    rows = [(1, 0, "system", odd), (1, 1, "user", ""), (1, 2, "assistant", odd), (1, 3, "user", "é\n"), (1, 4, "assistant", "b😀")]
    got = digests(spark, rows)[1]
    assert got["n_turns"] == 5 and got["n_examples"] == 2
    assert got["turns_sha256"] == sha("".join(f"{r[2]}\n{r[3]}\n" for r in rows))
    assert got["loss_chars"] == len(odd) + 2 and got["loss_sha256"] == sha(odd + "b😀")


def test_every_reply_has_all_before_it_and_only_itself_trainable(spark):
    rows = [(1, 0, "user", "u0"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"), (1, 3, "assistant", "a3"), (1, 4, "user", "u4")]
    found = chat.examples(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).orderBy("example").collect()
    assert [r["target_turn"] for r in found] == [1, 3, None]
    assert [r["formatted"][r["loss_start"]:r["loss_end"]] for r in found] == ["a1", "a3", ""]
    assert [all(x in r["formatted"] for x in ("u0", "a1")) for r in found] == [True, True, True]
    assert "u2" not in found[0]["formatted"] and "u4" in found[2]["formatted"]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "assistant", "z"), (1, 0, "assistant", "z"),
            (None, 0, "assistant", "n"), (2, 0, "user", "alone")]
    got = digests(spark, rows)
    assert got[1]["turns_sha256"] == sha("user\nfirst\n\n\nassistant\nz\nassistant\nz\n")
    assert got[1]["loss_sha256"] == sha("zz")
    assert got[None]["n_turns"] == 1 and got[None]["loss_chars"] == 1
    assert got[2]["n_turns"] == 1 and got[2]["loss_chars"] == 0 and got[2]["loss_sha256"] == sha("")


def test_empty_table(spark):
    assert digests(spark, []) == {}


def test_long_text(spark):
    long = "<ab[" * 50_000
    assert digests(spark, [(1, 0, "assistant", long)])[1]["loss_sha256"] == sha(long)
