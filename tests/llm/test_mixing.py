import pytest
from pyspark.sql import functions as F

from vialis.llm import mixing

PLAN = mixing.Plan(blocks_per_source=200)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "w " * (1 + i % 17), f"s{i % 5}" if i % 3 else "hot") for i in range(900)]
    rows += [(900, None, "s1"), (901, "", "s1"), (902, "a b\x0bc d", None), (None, "x y", "s2"), (None, "x y", "s2"), (5, "w " * 2000, "s4")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def expected_targets(sizes, plan):
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(names)}
    total, fixed = plan.share * sum(sizes.values()), {}
    while True:
        left = [s for s in names if s not in fixed]
        unit = (total - sum(fixed.values())) / sum(weight[s] for s in left) if left else 0
        over = [s for s in left if weight[s] * unit > plan.passes * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * unit for s in left}
        fixed |= {s: float(plan.passes * sizes[s]) for s in over}


def highest_quotients(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(votes, key=lambda s: (votes[s] / (2 * won[s] + 1), -list(votes).index(s)))
        won[best] += 1
    return won


def test_targets_quotas_and_taken_words(spark, docs):
    mixed = mixing.mix(docs, plan=PLAN)
    rows = mixed.rows.collect()
    assert len(rows) == docs.count()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    goal = expected_targets(sizes, PLAN)
    sources = {r["source"]: r for r in mixed.sources.collect()}
    names = sorted([s for s in sizes if s is not None]) + [None]
    assert {s: r["target"] for s, r in sources.items()} == pytest.approx(goal)
    seats = sum(sum(r["blocks"] or []) for r in sources.values())
    assert {s: sum(sources[s]["blocks"] or []) for s in names} == highest_quotients({s: goal[s] for s in names}, seats)
    assert len({sum((r["blocks"] or [0] * 8)[i] for r in sources.values()) for i in range(8)}) == 1
    for s in names:
        taken = sum(r["taken"] for r in rows if r["source"] == s)
        assert abs(taken - goal[s]) <= mixed.block_words + 1
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by_id = {r["doc_id"]: r["size"] for r in rows}
    assert by_id[900] == 0 and by_id[901] == 0 and by_id[902] == 3


def test_reruns_agree_on_other_partitionings(docs):
    keys = ["doc_id", "size", "source_size", "target", "taken"]
    a = sorted(map(str, mixing.mix(docs, plan=PLAN).rows.select(*keys).collect()))
    b = sorted(map(str, mixing.mix(docs.repartition(7), plan=PLAN).rows.select(*keys).collect()))
    assert a == b


def test_pieces_make_up_what_is_taken(docs):
    mixed = mixing.mix(docs.filter("doc_id is not null and doc_id <> 5"), plan=PLAN)
    cut = mixing.pieces(mixed, PLAN).groupBy("doc_id").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    got = {r["doc_id"]: r["words"] for r in cut.collect()}
    assert got == {r["doc_id"]: r["taken"] for r in mixed.rows.collect() if r["taken"]}


def test_resample_repeats_whole_documents(spark, docs):
    clash = docs.withColumns({"_row": F.lit(1), "size": F.lit("x"), "_times": F.lit(None).cast("int")})
    got = mixing.resample(clash, PLAN)
    assert got.columns == clash.columns
    counts = {tuple(r)[:-1]: r["count"] for r in got.groupBy("doc_id", "text", "source").count().collect()}
    assert set(counts) <= {tuple(r) for r in docs.collect()} and set(counts.values()) <= {1, 2, 3, 4}
    assert counts[(900, None, "s1")] == 1 and counts[(901, "", "s1")] == 1


def test_empty_and_wordless(spark, docs):
    assert mixing.mix(docs.limit(0)).rows.count() == 0
    assert mixing.resample(docs.limit(0)).count() == 0
    rows = mixing.mix(docs.filter("doc_id in (900, 901)")).rows.collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2


def test_a_source_far_below_the_mean_comes_near_its_target(spark):
    rows = [(i, "w " * 1000, f"s{i % 3}") for i in range(900)] + [(1000 + i, "w " * 50, "tiny") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    plan = mixing.Plan(weights=(5.0, 2.0, 1.0, 0.001), blocks_per_source=50)
    mixed = mixing.mix(docs, plan=plan)
    taken = {r["source"]: r["t"] for r in mixed.rows.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    sources = {r["source"]: r for r in mixed.sources.collect()}
    goal = {s: r["target"] for s, r in sources.items()}
    assert goal["tiny"] < sum(goal.values()) / len(goal) / 500
    assert taken == pytest.approx(goal, rel=0.01)
    seats = sum(sum(r["blocks"]) for r in sources.values())
    names = sorted(goal)
    votes = {s: goal[s] for s in names}
    for k in range(1, plan.shards + 1):
        assert {s: sum(sources[s]["blocks"][:k]) for s in names} == highest_quotients(votes, seats // plan.shards * k)
    assert mixing.resample(docs, plan).filter("source = 'tiny'").count() > 0
