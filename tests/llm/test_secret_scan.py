import random
import re
import string

import numpy as np
import pytest

from vialis.llm import secret_scan as scan


def plain(text):
    words = ["password", "passwd", "secret", "token", "apikey", "api_key"]
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words)
    assign = re.compile(rf"({either})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(scan.KINDS[k], s, e) for s, k, e in sorted(found)]


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(6)
    pieces = ["token", "API_key", "PassWd", "ſecret", "secret", "\"", "'", " ", "=", ":", "abc123", "AKIA", "AKIA" + "Z9" * 9, "0f" * 12, "ab" * 5, "é", "g", "\n"]
    for _ in range(3000):
        text = "".join(r.choices(pieces, k=r.randint(1, 14)))
        assert scan.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 200_000, "token" + " " * 200_000, "=" * 200_000])
def test_long_runs_take_linear_time(text):
    assert isinstance(scan.base_spans(text), list)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, seen string, at int")


def key(r):
    return "".join(r.choices(string.ascii_letters + string.digits, k=32))


def test_network_finds_keys_without_a_known_name_and_leaves_words_alone(spark):
    r = random.Random(7)
    rows = [(i, f"some words before\nsecret = {key(r)}\nand after") for i in range(400)]
    rows += [(1000 + i, f"see path/to/module_{r.randint(1, 99)}.part and https.example.page_{r.randint(1, 999)} or {r.randint(10**13, 10**14)}") for i in range(400)]
    rows += [(5000 + i, f"some words before\nvalue = {key(r)}\nand after") for i in range(20)]
    got = {x["doc_id"]: x for x in scan.digest(scan.scan(frame(spark, rows))).collect()}
    assert sum(got[5000 + i]["n_learned"] for i in range(20)) >= 18
    assert sum(got[1000 + i]["n_learned"] for i in range(400)) <= 4
    assert all(got[i]["n_assign"] == 1 for i in range(400))


def test_short_values_assigned_words_and_long_runs_are_candidates():
    seen = lambda t: [t[s:e] for s, e, _ in scan.candidates(t, scan.base_spans(t))]
    assert seen("pwd: hunter22 and pass = Xk92pQ or pwd = correcthorsebattery") == ["hunter22", "Xk92pQ", "correcthorsebattery"]
    assert seen("ordinary Sentences END with words. Another-one, too") == ["Another-one"]
    assert seen('x="longword" (a.b) ---------- =') == ['longword']
    inner = "sk_live_51HxYzAbCdEfGhIjKl"
    run = f"path/to/some/rather/long/directory/{inner}/and/then/the/rest/of/the/path/goes/on.txt"
    views = [(s, e) for s, e, _ in scan.candidates(run, [])]
    assert views[0][0] == 0 and views[-1][1] == len(run) and all(e - s == scan.BODY for s, e in views)
    assert all(b[0] <= a[1] - scan.BODY // 2 for a, b in zip(views, views[1:]))
    assert any(s <= run.index(inner) and run.index(inner) + len(inner) <= e for s, e in views)
    assert scan.window(run, 24, 72)[:scan.SIDE] == run[:24] and scan.window("ab" * 3, 0, 6).strip("\0") == "ababab"


def test_a_key_in_the_middle_of_a_long_run(spark):
    r = random.Random(11)
    way = lambda k: "/".join(r.choice(["usr", "local", "share", "module", "example", "data"]) for _ in range(k))
    rows = [(i, f"words before\nsecret = {key(r)}\nand after") for i in range(400)]
    rows += [(1000 + i, f"see {way(20)} or {way(3)}.part or {r.randint(10**7, 10**9)} there") for i in range(400)]
    rows += [(5000 + i, f"see {way(9)}/{key(r)}/{way(9)} there") for i in range(20)]
    got = {x["doc_id"]: x for x in scan.digest(scan.scan(frame(spark, rows))).collect()}
    found = [x for x in got.values() if x["doc_id"] >= 5000 and x["n_learned"]]
    assert len(found) >= 14 and sum(x["n_learned"] for x in got.values() if 1000 <= x["doc_id"] < 5000) <= 8
    for x in found:
        text = dict(rows)[x["doc_id"]]
        spans = [tuple(map(int, p.split(":")[1:])) for p in x["spans"].split(",")]
        assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        longest = max(re.finditer("[A-Za-z0-9]{32}", text), key=lambda m: len(m[0]))
        assert any(s < longest.end() and e > longest.start() for s, e in spans)


def test_threshold_keeps_the_asked_recall(spark):
    r = random.Random(8)
    rows = [(scan.window(t := f"x = {key(r)} y", 4, 36), 1) for _ in range(300)]
    rows += [(scan.window(t := f"x = {'word_' * 5} {i} y", 4, 29), 0) for i in range(300)]
    found = scan.train(spark.createDataFrame(rows, "window string, label int"))
    assert found.recall >= 0.95 and found.precision >= 0.95 and found.threshold >= 0.9
    assert found.network.probability(scan.encoded([rows[0][0]])).shape == (1,)
    assert np.isfinite(found.network.scale)


def test_all_findings_train_however_they_lie(spark):
    """More findings than a task takes: none is left out, and the network does not depend on how rows are dealt."""
    r = random.Random(12)
    rows = [(scan.window(t := f"x = {key(r)} y", 4, 36), 1) for _ in range(3200)]
    rows += [(scan.window(t := f"x = {'word_' * 5}{i} y", 4, 29 + len(str(i))), 0) for i in range(3200)]
    table = spark.createDataFrame(rows + rows[:50], "window string, label int")
    found = scan.train(table, scan.Training(per_task=1000))
    assert found.learned + found.held == len(set(rows)) == 6400
    assert found.recall >= 0.95 and found.precision >= 0.95
    again = scan.train(table.repartition(7), scan.Training(per_task=1000))
    assert (found.network.state() == again.network.state()).all() and found.threshold == again.threshold


def test_slopes_equal_differences():
    r = np.random.default_rng(0)
    net = scan.Network()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    codes, labels = r.integers(0, scan.CODES, (5, scan.WIDTH)).astype(np.uint8), np.array([0, 1, 1, 0, 1.0])
    def loss():
        z = net._forward(codes)[-1]
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))
    slopes = net._slopes(codes, labels, np.ones(5))
    for name, spot in (("conv", (3, 2)), ("out", (5,)), ("bias", (1,)), ("shift", (0,))):
        value = net.weights[name][spot]
        net.weights[name][spot] = value + 1e-5
        up = loss()
        net.weights[name][spot] = value - 1e-5
        down = loss()
        net.weights[name][spot] = value
        assert slopes[name][spot] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_nulls_copies_and_empty(spark):
    rows = [(1, None), (2, ""), (None, "token: abcdef"), (3, "token: abcdef"), (3, "token: abcdef")]
    got = sorted((x["doc_id"] or 0, x["n_assign"], x["spans"]) for x in scan.digest(scan.scan(frame(spark, rows))).collect())
    assert got == [(0, 1, "assign:0:13"), (1, 0, ""), (2, 0, ""), (3, 1, "assign:0:13"), (3, 1, "assign:0:13")]
    assert scan.scan(frame(spark, [])).count() == 0
