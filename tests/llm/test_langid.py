import random

from pyspark.sql import functions as F

from vialis.llm import langid

WORDS = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["zwölf", "boxkämpfer", "jagen", "viktor"], "cc": ["съешь", "ещё", "этих", "мягких"]}


def docs(spark, n=300):
    r = random.Random(2)
    rows = [(i, " ".join(r.choices(WORDS[k], k=30)).capitalize() + ".", k, "s", 0.5) for i in range(n) for k in [r.choice(list(WORDS))]]
    rows += [(n, None, "aa", "s", 0.5), (n + 1, "", "bb", "s", 0.5), (n + 2, "12 34 !", "cc", "s", 0.5), (None, "lorem dolor ipsum", None, "s", 0.5),
             (n + 3, "lorem " * 20_000, "aa", "s", 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")


def test_held_out_accuracy_and_odd_rows(spark):
    table = docs(spark)
    got = langid.predict(table, langid.held_out("doc_id")).join(table.select("doc_id", "lang", "text"), "doc_id", "left").collect()
    told = {r["doc_id"]: r for r in got}
    assert len(got) == table.count()
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None and r["doc_id"] < 300)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [(told[i]["lang_pred"], told[i]["score"]) for i in (300, 301, 302)] == [("und", 0.0)] * 3
    assert told[303]["lang_pred"] == "aa" and told[None]["lang_pred"] == "aa" and told[None]["held_out"] is False


def test_held_out_rows_teach_nothing(spark):
    table = docs(spark).withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    assert langid.predict(table, langid.held_out("doc_id")).filter("lang_pred = 'zz'").count() == 0


def test_nothing_learned_and_empty(spark):
    table = docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.predict(table, F.lit(False)).collect()} == {"und"}
    assert langid.predict(table.limit(0), F.lit(False)).count() == 0


def test_phrases_are_longest_matches():
    sample = "abracadabra cadabra barb"
    model = langid.Model({"x": [sample], "y": ["zzz qqq"]})
    r = random.Random(3)
    learned = model.alphabet.encoded(sample).tobytes() + b"\0"
    for _ in range(50):
        codes = model.alphabet.encoded("".join(r.choices("abrcd zq", k=40)))
        count, at = 0, 0
        while at < len(codes):
            size = 1
            while at + size < len(codes) and codes[at:at + size + 1].tobytes() in learned:
                size += 1
            count, at = count + 1, at + size
        assert model.phrases(codes[:, None])[0, 0] == count


def test_known_keeps_clean_rows_and_all_columns(spark):
    table = docs(spark).withColumns({"lang_pred": F.lit(1), "bits": F.lit("x"), "_doc": F.lit(2)})
    kept = langid.known(table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in table.select("doc_id").collect()} - {r["doc_id"] for r in kept.collect()} == {300, 301, 302}


def test_every_letter_of_the_samples_counts():
    r = random.Random(4)
    latin = {"x": " ".join(r.choices(["lorem", "ipsum", "dolor"], k=60)), "y": " ".join(r.choices(["quick", "fjord", "waltz"], k=60))}
    signs = {"zh": range(0x4E00, 0x4E00 + 300), "ja": range(0x6000, 0x6000 + 300)}
    words = {k: ["".join(map(chr, v[i:i + 3])) for i in range(0, 300, 3)] for k, v in signs.items()}
    samples = {k: ["".join(r.choices(v, k=130)) for _ in range(5)] for k, v in words.items()}
    model = langid.Model({**{k: [v] * 20 for k, v in latin.items()}, **samples})
    seen = set("".join("".join(t) for t in model.samples.values())) - {" "}
    codes = {c: int(model.alphabet.encoded(c)[0]) for c in seen}
    assert len(set(codes.values())) == len(seen) and min(codes.values()) > 1
    texts = ["".join(r.choices(words[k], k=14)) for k in ("zh", "ja") * 20] + [latin["x"][:50], latin["y"][:50]]
    assert model.judged(texts)[0] == ["zh", "ja"] * 20 + ["x", "y"]
    joined = {k: [tuple(model.alphabet.encoded(t)) for t in v] for k, v in model.samples.items()}
    learned = [c for p in joined["ja"] for c in (*p, 0)]
    parts = {tuple(learned[i:i + n]) for n in range(1, 8) for i in range(len(learned) - n + 1)}
    for text in texts[:10]:
        whole, count, at = tuple(model.alphabet.encoded(text).tolist()), 0, 0
        while at < len(whole):
            size = 1
            while at + size < len(whole) and whole[at:at + size + 1] in parts:
                size += 1
            count, at = count + 1, at + size
        assert model.phrases(model.alphabet.encoded(text)[:, None])[model.languages.index("ja"), 0] == count
