import random
import re

import pytest

from vialis.llm import license_scan
from vialis.llm.license_scan import Template

FEW = (Template("mit", "mit license", 100, True), Template("gpl", "general public license", 100, True),
       Template("note", "you may copy and use this work", 70), Template("lgpl", "lesser general public license", 100))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, row int, words string, k int")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, templates, step):
    ws, found = words(text), []
    for k in range(0, max(1, -(-len(ws) // step))):
        block = ws[k * step:(k + 2) * step]
        for number, t in enumerate(templates):
            common = len(set(block) & set(t.words))
            places = [k * step + i for i in range(min(step, len(block))) if block[i:i + len(t.words)] == t.words] if t.phrase else []
            if common >= t.need and (places or not t.phrase):
                found.append((k * step, t.label, number, t.phrase, k * step + len(block), common / len(set(t.words)), places))
    return len(ws), sorted(found)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(4)
    known = ["MIT", "License", "general", "Public", "you", "may", "copy", "and", "use", "this", "work", "lesser", "der", "K", "café", "x1"]
    out = [" ".join(r.choices(known, k=r.randint(0, 60))) for _ in range(120)]
    out += ["a " * 31 + "MIT\nLicense " + "b " * 40, "mit-LICENSE", "MIT license\x00mit_License", "éMIT license", "mitK license",
            "You may copy, and use this worK", "general public " * 50 + "license", "the " * 5000 + "General Public License " + "z " * 3000]
    return out


def test_every_block_against_every_template(spark, texts):
    rows = [*enumerate(texts), (900, None), (901, ""), (902, "   "), (None, "mit license"), (None, "mit license"), (7, "mit license")]
    got = license_scan.scan(frame(spark, rows), templates=FEW, step=8).collect()
    flat = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], [tuple(m) for m in r["matches"]]) for r in got)
    assert flat == sorted((i is None, i or 0, *brute(t, FEW, 8)) for i, t in rows)


def test_phrase_places_are_counted_once(spark, texts):
    got = {r["doc_id"]: r for r in license_scan.digest(license_scan.scan(frame(spark, enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        ws = words(text)
        places = {t.label: [p for p in range(len(ws)) if ws[p:p + len(t.words)] == t.words] for t in license_scan.TEMPLATES if t.phrase}
        every = sorted(p for found in places.values() for p in found)
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (len(ws), len(every))
        assert (row["first_word"], row["last_word"]) == ((every[0], every[-1]) if every else (None, None))
        base = sorted(label for label, found in places.items() if found)
        assert row["base_labels"] == ",".join(base) and set(base) <= set(row["labels"].split(",")) | {""}
        assert 0 <= row["score"] <= 1


def test_notice_without_its_name(spark):
    text = ("x " * 100 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its "
            "associated documentation files" + " y" * 100)
    row = license_scan.digest(license_scan.scan(frame(spark, [(1, text), (2, text.replace("granted", "no").replace("free", "for a")
                                                                         .replace("software", "x").replace("files", "x"))]))).collect()
    found = {r["doc_id"]: (r["n_base"], r["base_labels"], r["labels"], r["score"]) for r in row}
    assert found == {1: (0, "", "mit", 1.0), 2: (0, "", "", 0.0)}


def test_empty_table_and_short_blocks(spark):
    assert license_scan.scan(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(frame(spark, []), step=4)
