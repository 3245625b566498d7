import random
import re

import numpy as np
import pytest

from vialis.llm import decontaminate as dec

RULE = dec.Rule()


def text_of(r, n):
    return " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(n))


def edited(r, text, edits):
    out = list(text)
    for _ in range(edits):
        at = r.randrange(len(out))
        out[at:at + 1] = r.choice([[], [out[at], "z"], ["y"]])
    return "".join(out)


def best_edits(item, text):
    """Least edit distance of the item to any part of the text, the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def norm(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, leaks string"),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, doc_id int"))


@pytest.fixture(scope="module")
def made():
    r = random.Random(11)
    items = [(i, text_of(r, r.choice([6, 15, 40]))) for i in range(30)]
    docs = []
    for k in range(200):
        item = r.choice(items)[1]
        middle = [item, edited(r, item, r.randint(1, 12)), item.upper().replace(" ", ",\n"), text_of(r, 20), item[:len(item) // 2]][k % 5]
        docs.append((k, f"{text_of(r, r.randint(0, 30))} {middle} {text_of(r, r.randint(0, 30))}"))
    return docs, items


@pytest.mark.parametrize("block", [2_000_000, 500])
def test_leaks_equal_the_whole_table_of_edits(spark, made, block):
    docs, items = made
    table, bench = frames(spark, docs, items)
    got = {}
    for r in dec.with_leaks(table, bench, block_chars=block).collect():
        for leak in r["leaks"]:
            got[(r["doc_id"], leak["item_id"])] = min(leak["edits"], got.get((r["doc_id"], leak["item_id"]), 10**6))
    texts, want = {i: norm(t) for i, t in docs}, {}
    for j, item in items:
        item = norm(item)
        for i, t in texts.items():
            if len(item) >= RULE.shortest and (edits := best_edits(item, t)) <= RULE.budget(len(item)):
                want[(i, j)] = edits
    assert got == want


def test_places_in_the_text(spark):
    item = "The quick brown fox jumps over the lazy dog again and again"
    doc = f"Ä, before -- {item.replace(' ', '  ')}! after"
    table, bench = frames(spark, [(1, doc)], [(7, item), (8, item.upper()), (9, "short"), (None, item), (10, None)])
    leaks = dec.with_leaks(table, bench).collect()[0]["leaks"]
    assert [(x["item_id"], x["edits"]) for x in leaks] == [(7, 0)]
    assert doc[leaks[0]["start"]:leaks[0]["end"]] == item.replace(" ", "  ")


def test_clean_keeps_other_rows_whole(spark):
    item = "an item of the benchmark with more than a few words in it"
    rows = [(1, "x " + item), (2, None), (3, ""), (4, "an item of the benchmark"), (5, "clean"), (5, "clean"), (None, item), (6, ("clean words " * 20_000))]
    table, bench = frames(spark, rows, [(1, item)])
    kept = dec.clean(table, bench)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 5, 6]
    assert dec.clean(table, bench.limit(0)).count() == len(rows)
    assert dec.clean(table.limit(0), bench).count() == 0


def test_gram_hashes_depend_on_the_window_alone():
    r = np.random.default_rng(2)
    codes = r.integers(0, 3, 400).astype(np.uint32)
    for q in (1, 5, 12):
        hashes, seen = dec.gram_hashes(codes, q), {}
        for i, h in enumerate(hashes):
            assert seen.setdefault(codes[i:i + q].tobytes(), h) == h
        assert len(set(seen.values())) == len(seen) and len(hashes) == 401 - q


@pytest.mark.parametrize("block", [2_000_000, 50])
def test_equal_items_and_short_items(spark, block):
    item = "The quick brown fox jumps over the lazy dog again and again"
    items = [(7, item), (3, "something else that nobody has in a text"), (8, item.upper()), (9, "Who, then?"), (10, "你叫什么名字"), (11, "..."), (12, "who then")]
    docs = [(1, f"x {item} y"), (2, "Ah: who   then did it? Who then"), (3, "whoa, then"), (4, "请问你叫什么名字呢"), (5, "who"), (6, "你叫什么名"), (7, "Who! Then")]
    table, bench = frames(spark, docs, items)
    pairs = lambda rows: sorted((r["doc_id"], x["item_id"], x["start"], x["end"]) for r in rows for x in r["leaks"])
    first = [(1, 7, 2, 2 + len(item)), (2, 9, 4, 14), (2, 9, 23, 31), (4, 10, 2, 8), (7, 9, 0, 9)]
    assert pairs(dec.with_leaks(table, bench, block_chars=block).collect()) == first
    every = first + [(d, {7: 8, 9: 12}[i], a, b) for d, i, a, b in first if i in (7, 9)]
    assert pairs(dec.with_leaks(table, bench, block_chars=block, every_id=True).collect()) == sorted(every)
    assert sorted(r["doc_id"] for r in dec.clean(table, bench).collect()) == [3, 5, 6]
