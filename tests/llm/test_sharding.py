import pytest

from vialis.llm import sharding


def test_every_shard_has_equally_many_slots_and_few_move():
    names = [f"s{i}" for i in range(20)]
    before = sharding.lookup_table(names, 4099)
    counts = [before.count(i) for i in range(20)]
    assert max(counts) - min(counts) <= 1
    after = sharding.lookup_table(names[:-1], 4099)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.2 * 4099


def test_slots_are_claimed_in_turn_by_preference():
    names, size = ["a", "b", "c"], 13
    walks = [[(f + j * s) % size for j in range(size)] for f, s in (sharding.preference(n, size) for n in names)]
    table, turn = [None] * size, 0
    while None in table:
        i = turn % 3
        table[next(s for s in walks[i] if table[s] is None)] = i
        turn += 1
    assert sharding.lookup_table(names, size) == table


@pytest.mark.parametrize("names, size", [(["a"], 12), ([], 13), (["a", "a"], 13)])
def test_refused(names, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(names, size)


def test_placement(spark):
    rows = [(1, "x", 5, 0), (1, "y", 6, 0), (None, "z", 7, 0), (None, None, 8, 0), (2, "", 9, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, _slot string, Shard int, _at int")
    got = sharding.place(docs, n_shards=4).collect()
    assert len(got) == 5 and set(got[0].asDict()) == {"doc_id", "_slot", "_at", "shard"}
    by_key = {}
    for r in got:
        by_key.setdefault(r["doc_id"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_key.values())
    assert sharding.place(docs.limit(0)).count() == 0
