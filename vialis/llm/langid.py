"""Language of texts by cross-parsing with suffix automata of labelled text."""

from __future__ import annotations

import hashlib
import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vialis.llm.common import unit_hash, with_columns_from_text

UNKNOWN = "und"
SAMPLE_DOCS = 100
SAMPLE_CHARS = 40_000
PIECE = 400
LETTERS = 94
LANE = 512
LANES = 8_192


def held_out(doc_id: str) -> Column:
    """Whether crc32 of the id's text leaves 1 modulo 3; false for null."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


class Alphabet:
    """Code of each code point: 0 for what is not a letter, 1 for a letter unseen in training, from 2 the seen ones."""

    def __init__(self, texts: list[str]):
        seen = Counter(c for t in texts for c in t.lower() if c.isalpha())
        self.codes = {c: i + 2 for i, (c, _) in enumerate(sorted(seen.items(), key=lambda x: (-x[1], x[0])))}
        self.size = (len(self.codes) + 3) // 2 * 2
        # Codes below this have a column in the automata's tables, those of rarer letters are looked up.
        self.columns = min(self.size, LETTERS + 2)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32) if self.size <= np.iinfo(t).max)
        points = np.zeros(0x110000, dtype=kind)
        for point in range(0x110000):
            if unicodedata.category(chr(point))[0] == "L":
                points[point] = self.codes.get(chr(point).lower()[0], 1)
        self.points = points
        self.end = int(np.iinfo(kind).max)

    def encoded(self, text: str) -> np.ndarray:
        """Codes of a text; each run of other characters is a single 0 between words."""
        codes = self.points[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
        keep = codes > 0
        keep[1:] |= (codes[1:] == 0) & (codes[:-1] > 0)
        return codes[keep]


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a code sequence: next state by code, for each state."""
    nexts: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes.tolist():
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
    return nexts


class Automaton:
    """A suffix automaton whose entries are the next state's offset, odd where a phrase begins.

    The columns of the commonest letters are a table; moves by rarer letters
    are sorted by state and code.
    """

    def __init__(self, codes: np.ndarray, alphabet: Alphabet):
        nexts, self.size, self.columns = suffix_automaton(codes), alphabet.size, alphabet.columns
        table = np.full((len(nexts), self.columns), -1, dtype=np.int64)
        # One more state, before the first phrase and after a letter that the language lacks: any letter begins a phrase there.
        self.first = len(nexts) * self.columns
        begin = np.full(self.size, self.first + 1, dtype=np.int64)
        for c, to in nexts[0].items():
            begin[c] = to * self.columns + 1
        rare = []
        for state, moves in enumerate(nexts):
            for c, to in moves.items():
                if c < self.columns:
                    table[state, c] = to * self.columns
                else:
                    rare.append((state * self.size + c, to * self.columns))
        common = begin[None, :self.columns]
        self.table = np.vstack([np.where(table >= 0, table, common), common]).astype(np.int32).ravel()
        self.begin = begin.astype(np.int32)
        # The last key is none of a move; it keeps every place inside the arrays.
        rare = np.array([*sorted(rare), (np.iinfo(np.int64).max, 0)], dtype=np.int64)
        self.keys, self.to = np.ascontiguousarray(rare[:, 0]), rare[:, 1].astype(np.int32)

    def rare_moves(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        keys = states.astype(np.int64) // self.columns * self.size + codes
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.to[at], self.begin[codes])


_BUILT: dict[str, tuple] = {}


class Model:
    """One automaton per language.

    Only the bounded samples travel; the tables are built from them once in
    each Python worker.
    """

    def __init__(self, samples: dict[str, list[str]]):
        self.samples = samples
        self.languages = sorted(samples)
        self.mark = hashlib.sha256(repr(sorted(samples.items())).encode("utf-8", "replace")).hexdigest()

    @property
    def alphabet(self) -> Alphabet:
        return self._built()[0]

    @property
    def tables(self) -> list[Automaton]:
        return self._built()[1]

    @property
    def norms(self) -> list[float]:
        return self._built()[2]

    def _built(self) -> tuple[Alphabet, list[Automaton], list[float]]:
        if self.mark not in _BUILT:
            _BUILT.clear()
            _BUILT[self.mark] = self._build()
        return _BUILT[self.mark]

    def _build(self) -> tuple[Alphabet, list[Automaton], list[float]]:
        alphabet = Alphabet([t for texts in self.samples.values() for t in texts])
        tables, norms = [], []
        for lang in self.languages:
            parts = [alphabet.encoded(t) for t in self.samples[lang]]
            codes = np.concatenate([x for p in parts for x in (p, np.zeros(1, dtype=np.uint8))])[:SAMPLE_CHARS]
            tables.append(Automaton(codes, alphabet))
            norms.append(float(np.log2(len(codes) + 1)))
        return alphabet, tables, norms

    def phrases(self, codes: np.ndarray) -> np.ndarray:
        """Phrases per language and lane; ``codes`` is (steps, lanes), the alphabet's ``end`` past a lane's end."""
        out = np.zeros((len(self.tables), codes.shape[1]), dtype=np.int64)
        ends = (codes != self.alphabet.end).sum(axis=0)
        order = np.argsort(-ends, kind="stable")
        codes = np.ascontiguousarray(codes[:, order])
        alive = np.searchsorted(-ends[order], -np.arange(codes.shape[0]), side="left")
        columns = self.alphabet.columns
        low = np.minimum(codes, columns - 1).astype(np.uint8)
        rare = [np.flatnonzero(codes[i, :n] >= columns) for i, n in enumerate(alive.tolist())]
        for k, moves in enumerate(self.tables):
            state = np.full(codes.shape[1], moves.first, dtype=np.int32)
            begun = np.zeros(codes.shape[1], dtype=np.int32)
            for i, n in enumerate(alive.tolist()):
                if not n:
                    break
                code = moves.table.take(state[:n] + low[i, :n])
                if len(rare[i]):
                    code[rare[i]] = moves.rare_moves(state[rare[i]], codes[i, rare[i]])
                begin = code & 1
                begun[:n] += begin
                np.subtract(code, begin, out=state[:n])
            out[k, order] = begun
        return out

    def judged(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits per letter of each text.

        A text is cut into lanes of ``LANE`` codes that are parsed next to each
        other, each with a first phrase of its own; all lanes of a text add up.
        """
        parts = [self.alphabet.encoded(t) if t else np.zeros(0, dtype=np.uint8) for t in texts]
        letters = np.array([int((p > 0).sum()) for p in parts])
        total = np.zeros((len(texts), len(self.tables)))
        owner: list[int] = []
        lanes: list[np.ndarray] = []

        def flush() -> None:
            if not lanes:
                return
            codes = np.full((len(lanes), max(map(len, lanes))), self.alphabet.end, dtype=self.alphabet.points.dtype)
            for i, lane in enumerate(lanes):
                codes[i, :len(lane)] = lane
            np.add.at(total, np.array(owner), self.phrases(codes.T).T)
            owner.clear()
            lanes.clear()

        for i, p in enumerate(parts):
            if not letters[i]:
                continue
            for at in range(0, len(p), LANE):
                owner.append(i)
                lanes.append(p[at:at + LANE])
                if len(lanes) == LANES:
                    flush()
        flush()
        bits = total * np.array(self.norms) / np.maximum(1, letters)[:, None]
        best = bits.argmin(axis=1) if len(self.tables) else np.zeros(len(texts), dtype=int)
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)]
        if len(self.tables) > 1:
            two = np.sort(bits, axis=1)[:, :2]
            score = np.where(letters > 0, 1 - two[:, 0] / np.maximum(two[:, 1], 1e-12), 0.0)
        else:
            score = (letters > 0).astype(float)
        return names, score, np.where(letters > 0, bits.min(axis=1), 0.0)


def train(docs: DataFrame, lang: str = "lang", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from the labelled rows of ``docs``; None if no row has a label and a letter.

    Of each language ``sample_docs`` texts are taken, those with the lowest hash
    of the text, and of each a piece of ``PIECE`` characters at a place that the
    hash names; the automaton holds ``SAMPLE_CHARS`` at most. This bounded sample
    for training is picked in the tasks before anything moves. Copies of a text
    count once.
    """
    rows = docs.filter(docs[lang].isNotNull() & docs[text].rlike(r"\p{L}")).select(
        docs[lang].cast("string").alias("lang"), docs[text].alias("text"), unit_hash(docs[text], seed=7).alias("_u"),
    )
    at = F.floor(unit_hash(F.col("_u"), seed=8) * F.greatest(F.lit(1), F.length("text") - PIECE)).cast("int") + 1
    rows = rows.select("lang", "_u", F.substring("text", at, F.lit(PIECE)).alias("text"))
    first = rows.withColumn("_n", F.dense_rank().over(W.partitionBy("lang").orderBy("_u")))
    picked = first.filter(F.col("_n") <= sample_docs).groupBy("lang", "_u").agg(F.min("text").alias("text"))
    samples: dict[str, list[str]] = {}
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["_u"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    return Model(samples) if samples else None


def predict(
    docs: DataFrame, hold_out: Column, doc_id: str = "doc_id", lang: str = "lang", text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Language of every row: doc_id, held_out, lang_pred, score, bits, and the columns in ``keep``.

    The model learns from rows with a label that are not held out; a prediction
    sees the text alone. A text is parsed into longest phrases that occur in a
    language's labelled text; the language needing the fewest phrases, each
    weighed by the bits of a place in that text, wins. ``score`` is the margin
    to the second language, 0 to 1, and ``bits`` the cost per letter.

    Null texts and texts without letters are ``und`` with score 0, and so are
    all if nothing could be learned. Ties go to the language that comes first
    by name. Repeated rows get equal answers; a null id is not held out; an empty
    table gives no rows. Other columns are not used.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs[doc_id].alias("doc_id"), hold_out.alias("held_out"), docs[text].cast("string").alias("_text"),
        *[docs[c] for c in keep],
    )
    model = train(docs.filter(~hold_out), lang, text)
    if model is None:
        nothing = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "bits": F.lit(0.0)}
        return rows.drop("_text").withColumns(nothing)
    shared = spark.sparkContext.broadcast(model)

    def judge(texts: list[str | None]) -> dict[str, list]:
        found, score, bits = shared.value.judged(texts)
        return {"lang_pred": found, "score": score, "bits": bits}

    return with_columns_from_text(rows, "_text", "lang_pred string, score double, bits double", judge)


def known(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a language that could be learned; texts without letters go.

    All columns pass through, whatever their names.
    """
    rows = docs.select(docs[lang].alias("lang"), docs[text].alias("text"), F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    found = predict(rows, F.lit(False), doc_id="lang", keep=("_doc",))
    return found.filter(F.col("lang_pred") != UNKNOWN).select("_doc.*")
