"""Whitening of embeddings by spectral divide and conquer of their covariance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from vialis.llm.common import python_ready

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
ROWS_AT_ONCE = 4_096
EXACT = 2**53
LONG = 2**63
EPS = np.finfo(np.float64).eps


def _halley(low: float) -> tuple[float, float, float]:
    """Weights of the next step when the least singular value is ``low`` at least."""
    d = np.cbrt(4 * (1 - low**2) / low**4)
    a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d))) / 2
    b = (a - 1) ** 2 / 4
    return a, b, a + b - 1


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps (QDWH).

    Ill-conditioned steps go through a QR factorisation, the others through a Cholesky factor.
    """
    size = np.linalg.norm(a)
    x = a / size if size else a
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(1.0, max(low, EPS))
    n = len(a)
    for _ in range(30):
        wa, wb, wc = _halley(low)
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        else:
            lower = np.linalg.cholesky(np.eye(n) + wc * x.T @ x)
            half = np.linalg.solve(lower, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved < np.cbrt(EPS):
            break
    return x


def _halves(a: np.ndarray, noise: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces, that of the larger eigenvalues first; None if all eigenvalues are equal.

    The polar factor of ``a`` less a shift is +1 on the eigenvectors above the
    shift and -1 on those below it, so half of its sum with the identity projects on the former.
    A shift that hits an eigenvalue, or has all of them on one side, is replaced by another.
    """
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n))
    if spread <= noise:
        return None
    step = spread / np.sqrt(n)
    shifts = [np.median(np.diag(a)), mean, *(mean + f * step for f in (0.03, -0.03, 0.1, -0.1, 0.31, -0.31, 0.7, -0.7))]
    random = np.random.default_rng(n)
    for shift in shifts:
        u = polar_factor(a - shift * np.eye(n))
        rank = int(round((np.trace(u) + n) / 2))
        if not 0 < rank < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-10 * n:
            continue
        project = (u + np.eye(n)) / 2
        q, _ = np.linalg.qr(project @ random.standard_normal((n, rank)))
        for _ in range(3):
            q, _ = np.linalg.qr(project @ q[:, :rank], mode="complete")
            if np.linalg.norm(q[:, rank:].T @ a @ q[:, :rank]) <= noise:
                break
        return q[:, :rank], q[:, rank:]
    return None


def leading_components(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    The space is split again and again, larger eigenvalues first, until a
    part has one dimension or a single eigenvalue; parts behind the first ``k`` components are not split.
    """
    n = len(covariance)
    noise = 4 * n * EPS * max(np.linalg.norm(covariance), np.finfo(np.float64).tiny)
    open_parts, vectors, have = [np.eye(n)], [], 0
    while open_parts and have < k:
        basis = open_parts.pop()
        inside = basis.T @ covariance @ basis
        halves = _halves((inside + inside.T) / 2, noise) if basis.shape[1] > 1 else None
        if halves is None:
            vectors.append(basis)
            have += basis.shape[1]
        else:
            open_parts += [basis @ halves[1], basis @ halves[0]]
    v, _ = np.linalg.qr(np.hstack(vectors)) if vectors else (np.zeros((n, 0)), None)
    values = np.einsum("ij,ij->j", v, covariance @ v)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], v[:, order]


def _matrix(column: pa.Array, width: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which vectors are whole (not null or empty, all entries finite, of the given width), their entries, and all lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets, dtype=np.int64)
    lengths = np.diff(offsets)
    flat = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    start = offsets - offsets[0]
    good = (bad[start[1:]] == bad[start[:-1]]) & (lengths > 0) & column.is_valid().to_numpy(zero_copy_only=False)
    if width is None:
        return good, flat, lengths
    good &= lengths == width
    return good, flat[np.repeat(good, lengths)].reshape(-1, width), lengths


def _whole(x: np.ndarray) -> np.ndarray:
    """Entries as whole numbers; what a long cannot hold is set to its nearest end."""
    return np.clip(np.floor(x * SCALE) + SHIFT, -(2.0**62), 2.0**62).astype(np.int64)


def _per_task(vectors: DataFrame, schema: str, work) -> DataFrame:
    """Rows that ``work`` makes of the batches of a task's vectors."""
    types = StructType.fromDDL(schema)
    names = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = work(batch.column(batch.num_columns - 1) for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in names], names=names.names)

    return vectors.mapInArrow(run, types)


def _width(vectors: DataFrame) -> tuple[int, int]:
    """The commonest length of whole vectors, the longer one of two, and the number of vectors that have it."""
    def work(columns):
        seen: dict[int, int] = {}
        for column in columns:
            good, _, lengths = _matrix(column, None)
            for length, n in zip(*np.unique(lengths[good], return_counts=True), strict=True):
                seen[int(length)] = seen.get(int(length), 0) + int(n)
        return {"length": list(seen), "n": list(seen.values())}

    counted = _per_task(vectors, "length int, n bigint", work).groupBy("length").agg(F.sum("n").alias("n"))
    first = counted.orderBy(F.desc("n"), F.desc("length")).first()
    return (first["length"], first["n"]) if first else (0, 0)


def _sums(vectors: DataFrame, width: int) -> list[int]:
    """Exact sum of each dimension."""
    def work(columns):
        total = np.zeros(width, dtype=object)
        for column in columns:
            whole = _whole(_matrix(column, width)[1])
            # Halves of the numbers, so that a batch cannot overflow.
            total += (whole >> 31).sum(axis=0).astype(object) * 2**31 + (whole & (2**31 - 1)).sum(axis=0).astype(object)
        return {"i": list(range(width)), "high": [int(t) >> 31 for t in total], "low": [int(t) & (2**31 - 1) for t in total]}

    rows = _per_task(vectors, "i int, high bigint, low bigint", work).groupBy("i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    sums = {r["i"]: r["high"] * 2**31 + r["low"] for r in rows}
    return [sums[i] for i in range(width)]


def _products(y: np.ndarray) -> np.ndarray:
    """Sum of the outer products of whole numbers as Python integers, through blocks whose sums a double holds exactly."""
    most = int(np.abs(y).max(initial=0))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    if most * most >= EXACT:
        high, low = y >> 24, y & (2**24 - 1)
        if most >= 2**50:
            wide = y.astype(object)
            return wide.T @ wide
        cross = _mixed(high, low)
        return _products(high) * 2**48 + (cross + cross.T) * 2**24 + _products(low)
    rows = max(1, min(ROWS_AT_ONCE, EXACT // max(1, most * most)))
    for i in range(0, len(y), rows):
        part = y[i:i + rows].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0))
    rows = max(1, min(ROWS_AT_ONCE, EXACT // max(1, most)))
    total = np.zeros((x.shape[1], y.shape[1]), dtype=object)
    for i in range(0, len(x), rows):
        total += (x[i:i + rows].astype(np.float64).T @ y[i:i + rows].astype(np.float64)).astype(np.int64).astype(object)
    return total


def covariance(vectors: DataFrame, width: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n, exact but for its last rounding.

    Vectors are centred by the whole numbers nearest to the means before they are multiplied, and what
    that leaves of the means is taken off at the end. Each task gives one row of limbs per
    dimension; Spark adds them.
    """
    centre = [(2 * s + n) // (2 * n) for s in sums]
    middle = np.array(centre, dtype=np.int64)

    def work(columns):
        total = np.zeros((width, width), dtype=object)
        for column in columns:
            total += _products(_whole(_matrix(column, width)[1]) - middle)
        limbs = [[[(int(v) >> 40 * k) & (2**40 - 1) if k < 3 else int(v) >> 120 for v in row] for row in total] for k in range(4)]
        return {"i": list(range(width)), **{f"l{k}": limbs[k] for k in range(4)}}

    schema = "i int, " + ", ".join(f"l{k} array<bigint>" for k in range(4))
    rows = _per_task(vectors, schema, work)
    entries = rows.select("i", F.posexplode(F.arrays_zip("l0", "l1", "l2", "l3")).alias("j", "v"))
    summed = entries.groupBy("i", "j").agg(*[F.sum(f"v.l{k}").alias(f"l{k}") for k in range(4)]).collect()
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((width, width))
    for r in summed:
        exact = sum(r[f"l{k}"] << 40 * k for k in range(4))
        out[r["i"], r["j"]] = (exact * n - rest[r["i"]] * rest[r["j"]]) / (n * n)
    return (out + out.T) / 2


def _centred(whole: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n: whole numbers first, then one rounding of the rest."""
    base, rest = sums // n, sums % n
    return (whole - base.astype(np.int64)) - (rest / n).astype(np.float64)


def _identity_error(vectors: DataFrame, width: int, n: int, sums: np.ndarray, weights) -> float:
    """Largest absolute entry of the covariance of the whitened vectors, as they are written, less the identity."""
    k = weights.value.shape[1]

    def work(columns):
        products, total = np.zeros((k, k)), np.zeros(k)
        for column in columns:
            z = _centred(_whole(_matrix(column, width)[1]), n, sums) @ weights.value
            products += z.T @ z
            total += z.sum(axis=0)
        return {"i": list(range(k)), "total": total, "products": list(products)}

    rows = _per_task(vectors, "i int, total double, products array<double>", work)
    entries = rows.select("i", "total", F.posexplode("products").alias("j", "v"))
    totals = entries.groupBy("i", "j").agg(F.sum("total").alias("total"), F.sum("v").alias("v")).collect()
    mean = np.zeros(k)
    second = np.zeros((k, k))
    for r in totals:
        mean[r["i"]] = r["total"] / n
        second[r["i"], r["j"]] = r["v"] / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _deviations(whole: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None where a long cannot hold it."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    y = whole - base
    most = int(np.abs(y).max(initial=0)) + 1
    if most * most * n * n * whole.shape[1] < LONG:
        return ((y * n - np.array([s % n for s in sums], dtype=np.int64)) ** 2).sum(axis=1).tolist()
    rest = [s % n for s in sums]
    exact = (sum((n * int(v) - r) ** 2 for v, r in zip(row, rest, strict=True)) for row in y)
    return [v if v < LONG else None for v in exact]


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each whole vector and leading component.

    Entries c become whole numbers x = floor(64 c) + 1000000. Vectors that are null or empty, hold null or
    non-finite entries, or are not of the commonest length (the longer one of two) take no part.
    Means and covariance are sums that Spark adds up over the tasks, in whole numbers, so no
    order of adding changes them; the driver holds d x d numbers for vectors of d entries, whatever the
    number of rows. It splits the covariance's space by polar decompositions; the d x ``components``
    weights are broadcast. ``deviation`` is the sum of (n x - S)^2, null
    where a long cannot hold it; ``explained`` the share of the component in the trace; ``identity_error`` is
    measured on the whitened vectors in a pass of its own.

    A component without variance (up to rounding) has null for ``whitened`` and counts 0 in ``explained``;
    ``explained`` is null if nothing varies. Ids may be null or repeat: each row is judged by itself. A table without
    whole vectors gives no rows. Other columns are not used.
    """
    spark: SparkSession = vectors.sparkSession
    python_ready(spark)
    rows = vectors.select(vectors[vec_id].alias("vec_id"), vectors[vector].alias("vector"))
    only = rows.select("vector")
    width, n = _width(only)
    schema = StructType([rows.schema["vec_id"], *StructType.fromDDL(
        "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double").fields])
    if not n:
        return spark.createDataFrame([], schema)
    exact = _sums(only, width)
    sums = np.array(exact, dtype=object)
    matrix = covariance(only, width, n, exact)
    values, directions = leading_components(matrix, min(components, width))
    trace = float(np.trace(matrix))
    varied = values > 10 * width * EPS * max(trace, 0.0)
    weights = spark.sparkContext.broadcast(directions[:, varied] / np.sqrt(values[varied]))
    error = _identity_error(only, width, n, sums, weights) if varied.any() else 0.0
    shares = [float(v) / trace if good else 0.0 for v, good in zip(values, varied, strict=True)] if trace > 0 else [None] * len(values)
    k, seen = len(values), np.flatnonzero(varied)
    types = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                good, entries, _ = _matrix(part.column(1), width)
                whole = _whole(entries)
                z = np.full((len(whole), k), np.nan)
                z[:, seen] = _centred(whole, n, sums) @ weights.value
                rows = np.repeat(np.flatnonzero(good), k)
                deviation = pa.array(_deviations(whole, n, exact), type=pa.int64())
                flat = z.reshape(-1)
                columns = [
                    part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(whole))),
                    pa.array(np.full(len(rows), n, dtype=np.int64)), deviation.take(pa.array(np.repeat(np.arange(len(whole)), k))),
                    pa.array(flat, mask=np.isnan(flat)), pa.array(shares * len(whole), type=pa.float64()),
                    pa.array(np.full(len(rows), error))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, types, strict=True)], names=types.names)

    return rows.mapInArrow(run, schema)
