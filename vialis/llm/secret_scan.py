"""Secrets in texts: fixed patterns, and a character convolutional network over all other candidates."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import discard, python_ready, unit_hash, with_columns_from_text, written
from vialis.llm.spans import SPAN, Span, counted, joined, matches
from vialis.operators.ranking import running_total

KINDS = ("assign", "access", "hex")
LEARNED = "learned"

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A run of 24 or more: shorter runs fail anyway, and a run is matched from its start.
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{6,}")
SIGNS = "+/_.=-"

SIDE, BODY = 24, 48
WIDTH = 2 * SIDE + BODY
CODES = 72


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, by start, then kind; offsets are code points."""
    found = {
        "assign": matches(ASSIGN, text, lambda m: len(m[2]) >= 6),
        "access": matches(ACCESS, text, lambda m: len(m[0]) >= 20) if "AKIA" in text else [],
        "hex": matches(HEX, text, lambda m: True),
    }
    spans = [(k, s, e) for k in KINDS for s, e in found[k]]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _assigned(text: str, run: str, start: int) -> bool:
    """Whether a run holds an equals sign before its end or comes after a colon or an equals sign."""
    return "=" in run.rstrip("=") or text[max(0, start - 4):start].rstrip(" \"'")[-1:] in (":", "=")


def candidates(text: str, base: list[Span]) -> list[tuple[int, int, bool]]:
    """(start, end, found by the fixed patterns) of every run of 6 or more key characters.

    Runs of letters in one case, or capitalised, are words and no candidates, unless they come after a colon or an
    equals sign. A run longer than a view is seen in views that overlap by half.
    """
    out, nxt = [], 0
    spans = sorted((s, e) for _, s, e in base)
    for m in TOKEN.finditer(text):
        run = m[0]
        core = run.strip(SIGNS)
        word = core.isalpha() and (core[1:].islower() or core.isupper())
        if len(core) < 6 or word and not _assigned(text, run, m.start()):
            continue
        for s, e in views(*m.span()):
            while nxt < len(spans) and spans[nxt][1] <= s:
                nxt += 1
            out.append((s, e, any(a < e and b > s for a, b in spans[nxt:nxt + 4])))
    return out


def views(start: int, end: int) -> list[tuple[int, int]]:
    """A run as one view, or as views of ``BODY`` characters, each half a view after the one before, the last at the run's end."""
    if end - start <= BODY:
        return [(start, end)]
    return [(s, s + BODY) for s in [*range(start, end - BODY, BODY // 2), end - BODY]]


def window(text: str, start: int, end: int) -> str:
    """The text before a view, the view, the text after it, at fixed places."""
    return (text[max(0, start - SIDE):start].rjust(SIDE, "\0") + text[start:end].ljust(BODY, "\0")
            + text[end:end + SIDE].ljust(SIDE, "\0"))


def _code_table() -> np.ndarray:
    """Codes of code points: 0 nothing, 1 white space, 2 other letters, 3 other signs, then ASCII letters, digits, key signs."""
    table = np.full(256, 3, dtype=np.uint8)
    table[0] = 0
    for c in "\t\n\v\f\r ":
        table[ord(c)] = 1
    table[0xC0:] = 2
    signs = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ=:\"'+/"
    for i, c in enumerate(signs):
        table[ord(c)] = 4 + i
    return table


CODE_TABLE = _code_table()


def encoded(windows: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(windows).encode("utf-32-le", "replace"), dtype=np.uint32)
    return CODE_TABLE[np.minimum(points, 255)].reshape(-1, WIDTH)


def _embedded(secret: np.ndarray, other: np.ndarray, r: np.random.Generator) -> np.ndarray:
    """The other window with the secret's view put into its own at some place."""
    out, view = other.copy(), secret[SIDE:SIDE + BODY]
    length = min(int((view > 0).sum()), 2 * BODY // 3)
    at = SIDE + int(r.integers(0, BODY - length + 1))
    out[at:at + length] = view[:length]
    return out


class Network:
    """Embedding, one convolution, maximum over the three parts of the window, one logistic unit; Adam, numpy."""

    EMBED, FILTERS, REACH = 8, 24, 5

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        shape = (self.REACH * self.EMBED, self.FILTERS)
        self.weights = {
            "embed": r.normal(0, 0.3, (CODES, self.EMBED)).astype(np.float32),
            "conv": r.normal(0, (2 / shape[0]) ** 0.5, shape).astype(np.float32),
            "bias": np.zeros(self.FILTERS, dtype=np.float32),
            "out": r.normal(0, 0.1, 3 * self.FILTERS).astype(np.float32),
            "shift": np.zeros(1, dtype=np.float32),
        }
        self.first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.step, self.scale, self.offset = 0, 1.0, 0.0

    def state(self) -> np.ndarray:
        """Weights, both moments of Adam and the number of steps as one vector."""
        parts = [v.ravel() for d in (self.weights, self.first, self.second) for v in d.values()]
        return np.concatenate([*parts, [self.step]]).astype(np.float64)

    def load(self, state: np.ndarray) -> None:
        at = 0
        for d in (self.weights, self.first, self.second):
            for k, v in d.items():
                d[k] = state[at:at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
        self.step = int(round(state[at]))

    def _forward(self, codes: np.ndarray) -> tuple:
        w = self.weights
        vectors = w["embed"][codes]
        n, steps = len(codes), WIDTH - self.REACH + 1
        columns = np.concatenate([vectors[:, i:i + steps] for i in range(self.REACH)], axis=2)
        maps = columns.reshape(n * steps, -1) @ w["conv"] + w["bias"]
        maps = maps.reshape(n, steps, self.FILTERS)
        cuts = (0, SIDE - 2, SIDE + BODY - 2, steps)
        tops = [maps[:, a:b].argmax(axis=1) + a for a, b in zip(cuts, cuts[1:], strict=False)]
        pooled = np.concatenate([np.take_along_axis(maps, t[:, None], axis=1)[:, 0] for t in tops], axis=1)
        hidden = np.maximum(pooled, 0)
        return columns, tops, hidden, hidden @ w["out"] + w["shift"][0]

    def fit(self, codes: np.ndarray, labels: np.ndarray, positives: float, seed: list[int], batch: int = 64, rate: float = 0.004,
            hidden: float = 0.5, inside: float = 0.5) -> None:
        """One pass over findings; ``positives`` is the share of label 1 among all, which weighs the two classes."""
        r, first, second = np.random.default_rng(seed), self.first, self.second
        weight = np.where(labels > 0, 0.5 / max(1e-9, positives), 0.5 / max(1e-9, 1 - positives))
        plain = np.flatnonzero((labels == 0) & (codes[:, SIDE + BODY - 1] > 0))
        order = r.permutation(len(codes))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            x = codes[pick].copy()
            # A share of the secrets is put inside other text, as they stand in the views of a long run.
            for row in np.flatnonzero((labels[pick] > 0) & (r.random(len(pick)) < inside)) if len(plain) else ():
                x[row] = _embedded(codes[pick[row]], codes[r.choice(plain)], r)
            # In a share of the cases the context is hidden, so that the shape alone counts, too.
            hide = r.random(len(pick)) < hidden
            x[hide, :SIDE] = 0
            x[hide, SIDE + BODY:] = 0
            self.step += 1
            for name, slope in self._slopes(x, labels[pick], weight[pick]).items():
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                move = first[name] / (1 - 0.9**self.step) / (np.sqrt(second[name] / (1 - 0.999**self.step)) + 1e-8)
                self.weights[name] = (self.weights[name] - rate * move).astype(np.float32)

    def _slopes(self, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        columns, tops, hidden, logit = self._forward(codes)
        n, steps = columns.shape[:2]
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * weight / n).astype(np.float32)
        back = np.outer(error, self.weights["out"]) * (hidden > 0)
        maps = np.zeros((n, steps, self.FILTERS), dtype=np.float32)
        rows, filters = np.arange(n)[:, None], np.arange(self.FILTERS)[None, :]
        for i, top in enumerate(tops):
            maps[rows, top, filters] += back[:, i * self.FILTERS:(i + 1) * self.FILTERS]
        flat = maps.reshape(n * steps, -1)
        spread = (flat @ self.weights["conv"].T).reshape(n, steps, self.REACH, self.EMBED)
        embed = np.zeros_like(self.weights["embed"])
        for i in range(self.REACH):
            np.add.at(embed, codes[:, i:i + steps].ravel(), spread[:, :, i].reshape(-1, self.EMBED))
        return {
            "embed": embed, "conv": columns.reshape(n * steps, -1).T @ flat, "bias": flat.sum(axis=0),
            "out": hidden.T @ error, "shift": np.array([error.sum()], dtype=np.float32),
        }

    def logits(self, codes: np.ndarray, block: int = 512) -> np.ndarray:
        parts = [self._forward(codes[i:i + block])[-1] for i in range(0, len(codes), block)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def sure(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.offset, -30, 30)))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return self.sure(self.logits(codes))


@dataclass(frozen=True)
class Training:
    """Findings that one task takes in a pass, least number of each class, recall asked of the threshold, least probability."""

    per_task: int = 20_000
    least: int = 20
    recall: float = 0.98
    surest: float = 0.9


@dataclass(frozen=True)
class Scanner:
    """``learned`` and ``held`` count the distinct findings that trained the network and those that set the threshold."""

    network: Network
    threshold: float
    recall: float
    precision: float
    learned: int
    held: int


def bare(codes: np.ndarray) -> np.ndarray:
    """Windows without their context."""
    out = codes.copy()
    out[:, :SIDE] = 0
    out[:, SIDE + BODY:] = 0
    return out


def _one_pass(begun: np.ndarray, positives: float, number: int, hidden: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A pass over one share, from the state ``begun``."""
    def work(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["_u", "window", "label"], ignore_index=True)
        own = Network()
        own.load(begun)
        labels = batch["label"].to_numpy(np.float32)
        own.fit(encoded(batch["window"].tolist()), labels, positives, [5, number, int(batch["share"][0])], hidden=hidden)
        return pd.DataFrame({"state": [own.state().tolist()], "n": [len(batch)]})

    return work


def _fitted(network: Network, rows: DataFrame, epochs: int, hidden: float, per_task: int) -> int:
    """Train ``network`` by passes over all ``rows`` (window, label, _u); returns how many findings a pass has.

    The findings are dealt into shares by their hash, as many as there are
    ``per_task``. In a pass every share takes the network of the pass before
    through its own findings, and what comes back is averaged, weighted by their
    number; the sums are of whole numbers, so their order does not show.
    """
    count, positives = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
    shares = -(-count // per_task)
    dealt = rows.withColumn("share", F.floor(F.col("_u") * shares).cast("int"))
    python_ready(rows.sparkSession)
    seen = 0
    for number in range(epochs):
        work = _one_pass(network.state(), positives, number, hidden)
        states = dealt.groupBy("share").applyInPandas(work, "state array<double>, n long")
        whole = F.round(F.col("value") * F.col("n") * F.lit(2.0**40)).cast("decimal(38,0)")
        means = states.select("n", F.posexplode("state").alias("place", "value")).groupBy("place").agg(
            F.sum(whole).alias("total"), F.sum("n").alias("n")).orderBy("place").collect()
        network.load(np.array([float(m["total"]) / 2**40 / m["n"] for m in means]))
        seen = means[0]["n"]
    return seen


def _calibrate(network: Network, judged: DataFrame, secrets: int, others: int) -> None:
    """Platt scaling on rows (z, label) that were not trained on: slope and offset of the logit, by Newton steps."""
    b = np.array([1.0, 0.0])
    goal = F.when(F.col("label") > 0, (secrets + 1) / (secrets + 2)).otherwise(1 / (others + 2))
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("z") * float(b[0]) + float(b[1])))))
        rows = judged.select("z", (p * (1 - p)).alias("w"), (p - goal).alias("e"))
        zz, z1, ones, ez, e1 = rows.agg(
            F.sum(F.expr("w * z * z")), F.sum(F.expr("w * z")), F.sum("w"), F.sum(F.expr("e * z")), F.sum("e")).first()
        bend = np.array([[zz, z1], [z1, ones]]) + 1e-3 * np.eye(2)
        move = np.clip(np.linalg.solve(bend, np.array([ez, e1]) + 1e-3 * (b - [1.0, 0.0])), -1, 1)
        b = b - move
        if np.abs(move).max() < 1e-10:
            break
    # So many places that the order of the sums does not show.
    network.scale, network.offset = round(float(max(b[0], 1e-3)), 8), round(float(b[1]), 8)


def train(labelled: DataFrame, training: Training = Training()) -> Scanner | None:
    """A scanner from labelled findings (window, label); None where a class has too few.

    All findings count, copies once. Unlabelled look-alikes of the
    labelled secrets are left out. A third, by the hash of the window, calibrates the
    probabilities and sets the threshold: the highest that keeps the asked
    recall, in the findings' contexts and without any, but no lower than
    ``surest``. The other findings train the network where they lie, share by share (``_fitted``).
    """
    rows = labelled.distinct().withColumn("_u", unit_hash(F.col("window"), seed=9))
    rows = written(rows.withColumn("apart", F.floor(F.col("_u") * 3e6) % 3 == 0), "findings")
    counted = lambda df: {(r["label"], r["apart"]): r["count"] for r in df.groupBy("label", "apart").count().collect()}
    sizes = counted(rows)
    both = [sum(n for (label, _), n in sizes.items() if label == k) for k in (0, 1)]
    if min(both) < training.least or not all((k, True) in sizes for k in (0, 1)):
        return None
    # A secret that no fixed pattern knows is labelled 0: what a first network takes for one by its shape alone teaches nothing.
    shape = Network(seed=4)
    _fitted(shape, rows.filter(~F.col("apart")), 4, 1.0, training.per_task)
    shaped = with_columns_from_text(rows, "window", "alike double", lambda w: {"alike": shape.logits(bare(encoded(w)))}, keep_text=True)
    clear = written(shaped.filter((F.col("label") > 0) | (F.col("alike") < 0)).drop("alike"), "clear")
    discard(rows)
    sizes = counted(clear)
    if not all((0, k) in sizes for k in (False, True)):
        return None
    network = Network()
    learned = _fitted(network, clear.filter(~F.col("apart")), 8, 0.5, training.per_task)

    def both_views(windows: list[str]) -> dict[str, np.ndarray]:
        codes = encoded(windows)
        return {"z": network.logits(codes).astype(float), "plain": network.logits(bare(codes)).astype(float)}

    judged = with_columns_from_text(clear.filter("apart").select("window", "label"), "window", "z double, plain double", both_views)
    judged = written(judged, "judged")
    secrets, others = sizes[1, True], sizes[0, True]
    _calibrate(network, judged, secrets, others)
    kept = int(np.ceil(training.recall * secrets))
    views = judged.filter("label > 0").select(F.explode(F.array(
        F.struct(F.lit(0).alias("view"), F.col("z")), F.struct(F.lit(1).alias("view"), F.col("plain").alias("z")))).alias("v"))
    falling = running_total(views.groupBy("v.view", "v.z").count(), ["view"], [F.desc("z")], F.col("count"), "place")
    lowest = falling.filter(F.col("place") >= kept).groupBy("view").agg(F.max("z").alias("z")).agg(F.min("z")).first()[0]
    threshold = max(training.surest, float(network.sure(np.array([lowest], dtype=np.float32))[0]))
    least = max(lowest, (np.log(training.surest / (1 - training.surest)) - network.offset) / network.scale)
    flagged, found = judged.filter(F.col("z") >= float(least)).agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    discard(clear, judged)
    return Scanner(network, threshold, found / secrets, found / flagged if flagged else 1.0, learned, secrets + others)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", training: Training = Training()) -> DataFrame:
    """Secrets of every row: doc_id, base (spans of the fixed patterns), added (spans that the network found).

    Findings of the fixed patterns are the labelled positives, all other
    candidates the negatives. The network then judges every candidate in its
    context, long ones view by view; those it is sure of are added where no fixed pattern touches them,
    and what the fixed patterns found stays in any case. Texts are read once; candidates go
    to the shared folder with their windows of ``WIDTH`` characters.

    A null text is empty and has no spans, a null id is kept, repeated rows each
    get their spans, an empty table gives none; with too few labelled findings
    nothing is added. Other columns are not used.
    """
    def work(texts: list[str | None]) -> dict[str, list]:
        base = [base_spans(t) if t else [] for t in texts]
        found = [candidates(t, b) if t else [] for t, b in zip(texts, base, strict=True)]
        return {
            "base": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in b] for b in base],
            "seen": [
                [{"start": s, "end": e, "known": k, "window": window(t, s, e)} for s, e, k in c]
                for t, c in zip(texts, found, strict=True)
            ],
        }

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("_text"))
    new = f"base array<{SPAN}>, seen array<struct<start:int,end:int,known:boolean,window:string>>"
    scanned = written(with_columns_from_text(rows, "_text", new, work), "candidates")
    labelled = scanned.select(F.inline("seen")).select("window", F.col("known").cast("int").alias("label"))
    scanner = train(labelled, training)
    none = F.array().cast(f"array<{SPAN}>")
    if scanner is None:
        return scanned.select("doc_id", "base", none.alias("added"))
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    rows = scanned.select("doc_id", "base", F.transform("seen", lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["known"].alias("known"))).alias("at"),
        F.array_join(F.transform("seen", lambda c: c["window"]), "").alias("windows"),
    )

    def judge(batch: list[str | None]) -> dict[str, list]:
        counts = [len(w) // WIDTH for w in batch]
        sure = shared.value.network.probability(encoded(["".join(batch)])) >= shared.value.threshold
        ends = np.cumsum([0, *counts])
        return {"yes": [sure[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]}

    judged = with_columns_from_text(rows, "windows", "yes array<boolean>", judge)
    added = F.transform(
        F.filter(F.arrays_zip("at", "yes"), lambda x: x["yes"] & ~x["at"]["known"]),
        lambda x: F.struct(F.lit(LEARNED).alias("kind"), x["at"]["start"].alias("start"), x["at"]["end"].alias("end")),
    )
    return judged.select("doc_id", "base", _united(added).alias("added"))


def _united(spans: Column) -> Column:
    """Spans in order, those that overlap as one: views of one run share half of their characters."""
    def put(found: Column, x: Column) -> Column:
        last = F.get(found, F.size(found) - 1)
        longer = F.struct(last["kind"].alias("kind"), last["start"].alias("start"), x["end"].alias("end"))
        rest = F.slice(found, F.lit(1), F.greatest(F.lit(0), F.size(found) - 1))
        return F.when(last["end"] > x["start"], F.concat(rest, F.array(longer))).otherwise(F.concat(found, F.array(x)))
    return F.aggregate(spans, F.array().cast(f"array<{SPAN}>"), put)


def digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""
    order = (*KINDS, LEARNED)
    return found.select(
        "doc_id", *[counted(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.col("base"), order, by_start=True), 256).alias("base_sha256"),
        joined(F.concat("base", "added"), order, by_start=True).alias("spans"),
        F.size("added").cast("bigint").alias("n_learned"),
    )
