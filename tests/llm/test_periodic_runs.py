import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from vialis.llm import periodic_runs
from vialis.llm.periodic_runs import Positions, Rule, runs_of


def brute(ids, rule):
    """All maximal stretches of each period, without those that a shorter period explains."""
    n, found = len(ids), set()
    for q in range(1, n // rule.periods + 1):
        i = 0
        while i < n - q:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and ids[j] == ids[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(rule.words, rule.periods * q) and not any(
                all(ids[x] == ids[x + d] for x in range(start, start + length - d)) for d in range(1, q)
            ):
                found.add((start, length, q))
            i = j
    return sorted(found)


def sequences():
    r = random.Random(3)
    for k in range(250):
        ids = [r.randrange(r.choice([1, 2, 3, 20])) for _ in range(r.randrange(0, 70))]
        for _ in range(r.randrange(0, 3)):
            unit = [r.randrange(3) for _ in range(r.randrange(1, 14))]
            ids += (unit * 9)[:r.randrange(1, 100)] + [r.randrange(4) for _ in range(r.randrange(0, 8))]
        yield ids
    yield [0] * 400
    yield [0, 1] * 200
    a, b = [0], [0, 1]
    for _ in range(11):
        a, b = b, b + a
    yield b


@pytest.mark.parametrize("rule", [Rule(), Rule(6, 2), Rule(10, 3), Rule(3, 3)])
def test_runs_equal_every_period_tried(rule):
    for ids in sequences():
        assert runs_of(np.array(ids), rule) == brute(ids, rule), ids


def test_ordered_sets_give_new_neighbours(monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 4)
    r = random.Random(1)
    for _ in range(200):
        x, y = r.sample(range(60), 20), r.sample(range(60, 120), 20)
        both = r.sample(x + y, 30)
        one, two = sorted(both[:18]), sorted(both[18:])
        sets = []
        for part in (one, two):
            s = Positions(part[0])
            for p in random.Random(2).sample(part[1:], len(part) - 1):
                s.add(p)
            assert list(s) == part
            sets.append(s)
        got = set(sets[0].unite(sets[1]))
        merged = sorted(both)
        assert list(sets[0]) == merged
        assert got == {(i, j) for i, j in zip(merged, merged[1:]) if (i in one) != (j in one)}


def told(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, Rule())
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_digest_of_rows(spark):
    r = random.Random(8)
    texts = [" ".join(r.choice(["a", "b", "é c", "d e", "f\tg\n"]) for _ in range(r.randrange(0, 150))) for _ in range(150)]
    texts += ["x " * 700, "ab cd\x0bef " * 20, ("one two three four " * 30 + "end ") * 4]
    rows = [*enumerate(texts), (None, "x " * 30), (None, None), (500, ""), (501, " \n "), (7, texts[7]), (7, texts[7])]
    frame = spark.createDataFrame([(i, t, "r", 3) for i, t in rows], "doc_id long, text string, runs string, length int")
    got = periodic_runs.digest(periodic_runs.find(frame, tail=periodic_runs.planted_tail))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, (tuple(x) for x in got.collect()))) == sorted(str(told(i, t)) for i, t in rows)


def test_one_long_text_and_no_rows(spark):
    text = "w " * 300_000 + " ".join(f"u{i}" for i in range(1000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periodic_runs.find(frame).collect()[0]
    assert row["n_words"] == 301_000 and [tuple(x) for x in row["runs"]] == [(0, 300_000, 1)]
    assert row["collapsed"].startswith("w u0 u1 ")
    assert periodic_runs.find(frame.limit(0)).count() == 0
