import random

import numpy as np
import pytest

from vialis.llm import ngram_join as join


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, links int")


def sets(texts):
    out = []
    for t in texts:
        w = (t or "").lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows):
    found = sets([t for _, t in rows])
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(found[i] & found[j])
            if common and 9 * common >= 4 * (len(found[i]) + len(found[j])):
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if r == b else r for r in root]
    names = {}
    for (i, _), r in zip(rows, root, strict=True):
        names.setdefault(r, []).append(i)
    name = {r: min((i for i in ids if i is not None), default=None) for r, ids in names.items()}
    return sorted(((i, name[r], n) for (i, _), r, n in zip(rows, root, links, strict=True)), key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    out = []
    for g in range(40):
        base = r.choices(words, k=r.choice([1, 3, 5, 20, 60, 150]))
        for _ in range(r.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(words)
            out.append((len(out), " ".join(copy)))
    # One large group whose members differ in a word or two, and one passage that many share.
    base = r.choices(words, k=100)
    for _ in range(150):
        copy = list(base)
        copy[r.randrange(100)] = r.choice(words)
        out.append((len(out), " ".join(copy)))
    shared = r.choices(words, k=40)
    out += [(1000 + i, " ".join(shared + r.choices(words, k=60))) for i in range(60)]
    out += [(2000, None), (2001, ""), (2002, "one two"), (2003, "One  two"), (None, "one two"), (None, "lonely text"), (0, out[0][1])]
    return out


@pytest.mark.parametrize("size", [512, 40])
def test_classes_and_links_equal_all_pairs(spark, rows, size):
    got = sorted((tuple(r) for r in join.near_copies(frame(spark, rows), rule=join.Rule(rows_per_task=size)).collect()), key=str)
    assert got == brute(rows)


def test_first_of_each_leaves_one_row_per_class(spark, rows):
    table = frame(spark, rows)
    kept = join.first_of_each(table)
    assert kept.columns == table.columns
    want = {(i, c) for i, c, _ in brute(rows) if i == c and i is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i, _ in want}) and ids.count(None) == 1


def test_prefix_is_shortened_until_the_recall_is_met():
    rule = join.Rule()
    assert rule.recall_at(rule.depth) >= rule.recall > rule.recall_at(rule.depth + 1)


def test_common_grams_of_all_pairs():
    r = np.random.default_rng(1)
    found = [np.unique(r.integers(0, 60, 30)).astype(np.uint64) for _ in range(70)]
    want = [[len(set(a) & set(b)) for b in found] for a in found]
    got = join.intersections(found, heavy=20, columns=7)
    np.fill_diagonal(got, np.diag(want))
    assert (got == np.array(want)).all()


def test_n_grams_of_all_texts_are_counted(spark, monkeypatch):
    """No text is left out of the count, however it is hashed; equal texts count once, and so do the chunks of a task."""
    monkeypatch.setattr(join, "TOKENS_HELD", 500)
    r = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    many, few = r.choices(words, k=12), r.choices(words, k=12)
    texts = [" ".join(r.choices(words, k=20) + many) for _ in range(join.MANY)]
    texts += [" ".join(few + r.choices(words, k=20)) for _ in range(join.MANY - 1)]
    texts += [texts[-1]] * 40 + [None, "", "one"] + ["one two"] * 40
    want = {}
    for t in set(texts):
        for token in join.tokens_of(join.grams(t, 5)).tolist():
            want[token] = want.get(token, 0) + 1
    want = sorted((n, token) for token, n in want.items() if n >= join.MANY)
    got = join.common_grams(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), "text", join.Rule())
    assert got.tolist() == [token for _, token in want] and len(want) == 8


def test_empty(spark):
    assert join.near_copies(frame(spark, [])).count() == 0
    assert join.near_copies(frame(spark, [(1, None)])).collect()[0]["n_links"] == 0
    assert join.first_of_each(frame(spark, [])).count() == 0


def test_a_passage_that_many_share_below_the_threshold(spark):
    """Nodes with many clusters: the prefix grows, clusters are held against a node's first ones, and no pair of all is made."""
    r = random.Random(21)
    words = [f"w{i}" for i in range(3000)]
    shared = r.choices(words, k=60)
    rows = [(i, " ".join(shared + r.choices(words, k=r.choice([20, 30, 60])))) for i in range(900)]
    for i in range(60):
        near = rows[i * 7][1].split()
        near[-1 - r.randrange(5)] = r.choice(words)
        rows.append((2000 + i, " ".join(near)))
    table = frame(spark, rows)
    got = sorted((tuple(x) for x in join.near_copies(table, rule=join.Rule(crowd=2)).collect()), key=str)
    assert got == brute(rows)


def test_crowded_nodes_get_longer_prefixes(spark):
    rule = join.Rule(crowd=3)
    more = rule.longest - rule.depth
    r = random.Random(4)
    sketches = [bytes(r.choice(b"ab") for _ in range(rule.trees * rule.longest)) for _ in range(60)] + [bytes(rule.trees * rule.longest)] * 9
    reps = spark.createDataFrame(list(enumerate(sketches)), "id long, sketch binary")
    heads = reps.selectExpr("2 AS tree", "5L AS label", "id", "id AS root")
    nodes = {}
    for x in join._grown(heads, reps, rule).collect():
        nodes.setdefault(x["node"], []).append(x["id"])
    at = 2 * rule.longest + rule.depth
    rest = lambda i: sketches[i][at:at + more]
    for members in nodes.values():
        same = {rest(i) for i in members}
        assert len(members) <= 3 or len(same) == 1
    assert sorted(len(m) for m in nodes.values())[-1] == 9
    # Sets that are apart share no prefix that is as short as those of their nodes would have to be.
    for one in nodes.values():
        for two in nodes.values():
            if one is not two:
                common = next((k for k in range(more) if rest(one[0])[k] != rest(two[0])[k]), more)
                assert sum(rest(i)[:common] == rest(one[0])[:common] for i in range(len(sketches))) > 3 or common == 0


@pytest.mark.parametrize("large", [64, 1])
def test_links_that_the_forest_leaves_out_are_found(spark, rows, large):
    """One tree with its longest prefix brings few pairs together; the lists of prefixes give the others."""
    r = random.Random(33)
    words = [f"v{i}" for i in range(2000)]
    pairs = []
    for i in range(60):
        base = r.choices(words, k=r.choice([9, 45, 100, 300]))
        other = list(base)
        for _ in range(len(base) // 45):
            other[r.randrange(len(other))] = r.choice(words)
        pairs += [(5000 + 2 * i, " ".join(base)), (5001 + 2 * i, " ".join(other))]
    rule = join.Rule(trees=1, recall=0.0, large=large)
    assert rule.depth == rule.longest
    got = sorted((tuple(x) for x in join.near_copies(frame(spark, rows + pairs), rule=rule).collect()), key=str)
    assert got == brute(rows + pairs)


def test_prefixes_and_marks_lose_no_similar_sets():
    r = np.random.default_rng(5)
    rule = join.Rule()
    common = r.integers(0, 2**63, 300, dtype=np.uint64)
    places = np.argsort(common, kind="stable")
    for size in (1, 4, 5, 9, 90, 1000, 5000):
        own = np.concatenate([r.integers(0, 2**63, size, dtype=np.uint64), r.choice(common, min(size, 250), replace=False)])
        a = np.unique(own[:size] if size < 9 else own[-size:])
        keep = -(-8 * len(a) // 9)
        b = np.unique(np.concatenate([a[r.permutation(len(a))[:keep]], r.integers(0, 2**63, len(a) - keep, dtype=np.uint64)]))
        both = len(a) + len(b)
        if 9 * len(np.intersect1d(a, b)) >= 4 * both:
            first = [set(join.prefix_of(x, common[places], places, rule.prefix(len(x))).tolist()) for x in (a, b)]
            assert first[0] & first[1]
        assert join.differing(join.mark_of(a), join.mark_of(b)) <= len(np.setxor1d(a, b))


def test_a_group_of_near_copies_is_brought_together_by_a_few_edges_a_set(spark, monkeypatch):
    """Sets that meet in many nodes: clusters are joined by a row for each set, not by one for each set, node and centre."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    base = r.choices(words, k=200)
    rows = []
    for i in range(500):
        copy = list(base)
        for at in r.sample(range(200), r.choice([2, 8, 9])):
            copy[at] = r.choice(words)
        rows.append((i, " ".join(copy)))
    seen, real = [], join.components

    def counted(edges):
        seen.append(edges.count())
        return real(edges)

    monkeypatch.setattr(join, "components", counted)
    got = sorted((tuple(x) for x in join.near_copies(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    assert max(seen) <= 3 * len(rows), seen
