import random

from vialis.llm.components import components


def test_roots_are_least_nodes(spark):
    r = random.Random(12)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, 500 + i) for i in range(80)] + [(999, 999)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
