"""Whitening of embeddings by principal components, found by spectral divide and conquer on polar decompositions (QDWH)."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table

#: Entries become whole numbers x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries of this size or more count as not finite, so that all sums fit 38 digits.
LIMIT = float(1 << 30)
EPS = np.finfo(float).eps


def polar_sign(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, that is its matrix sign, by the QR form of the dynamically weighted Halley iteration.

    The weights follow a lower bound of the singular values, which an iteration raises to nearly 1, so six or seven
    iterations serve even where an eigenvalue is as small as the rounding.
    """
    d = len(a)
    x = a / np.linalg.norm(a)
    low, eye = EPS, np.eye(d)
    for _ in range(30):
        t = np.cbrt(4 * (1 - low**2) / low**4)
        wa = np.sqrt(1 + t) + 0.5 * np.sqrt(8 - 4 * t + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + t)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved < (10 * EPS) ** (1 / 3):
            break
    return x


def invariant_halves(a: np.ndarray, noise: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift; None where a is a multiple of the identity up to noise.

    The projector (sign + 1) / 2 of a shifted matrix has the rank of the upper half. A shift beside all eigenvalues is
    bisected; one that meets an eigenvalue splits its space at will, which the residual shows, and is moved.
    """
    d = len(a)
    centre = np.trace(a) / d
    reach = np.linalg.norm(a - centre * np.eye(d))
    if reach <= noise:
        return None
    best = None
    for shift in (centre, np.median(np.diag(a)), *(centre + reach * s / np.sqrt(d) for s in (0.05, -0.05, 0.2, -0.2, 0.5, -0.5, 0.8, -0.8))):
        projector = (polar_sign(a - shift * np.eye(d)) + np.eye(d)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < d:
            continue
        # Two passes of orthogonal iteration: the projector's range, from its largest columns.
        start = projector[:, np.argsort(-np.diag(projector), kind="stable")[:rank]]
        full, _ = np.linalg.qr(np.hstack([projector @ np.linalg.qr(start)[0], np.eye(d)]))
        upper, lower = full[:, :rank], full[:, rank:d]
        upper, _ = np.linalg.qr(projector @ upper)
        lower, _ = np.linalg.qr(lower - upper @ (upper.T @ lower))
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = (left, upper, lower)
        if left <= 30 * noise:
            break
    return None if best is None else best[1:]


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns) of a symmetric matrix, by splitting invariant subspaces until they are single components."""
    noise = 4 * EPS * max(np.linalg.norm(a), np.finfo(float).tiny)
    found, todo = [], [np.eye(len(a))]
    while todo:
        basis = todo.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        halves = invariant_halves(part, noise) if len(part) > 1 else None
        if halves is None:
            found.append(basis)
        else:
            todo += [basis @ h for h in halves]
    vectors = refined(a, np.linalg.qr(np.hstack(found))[0])
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def refined(a: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Two Newton steps for all eigenvectors at once: what recursion has left of one component in another is taken out."""
    for _ in range(2):
        rest = np.eye(len(a)) - vectors.T @ vectors
        s = vectors.T @ a @ vectors
        values = np.diag(s) / (1 - np.diag(rest))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(rest)) + EPS * np.linalg.norm(a)
        step = np.where(near, rest / 2, (s + values[None, :] * rest) / np.where(near, 1.0, gap))
        vectors = vectors + vectors @ step
    return vectors @ (1.5 * np.eye(len(a)) - 0.5 * vectors.T @ vectors)


def as_matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers from a list column without NULLs."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (np.floor(SCALE * flat) + SHIFT).astype(np.int64).reshape(len(column), -1)


def exact_products(y: np.ndarray) -> np.ndarray:
    """The sums y'y of whole numbers as Python numbers: floating products are used only where they are exact."""
    most = int(np.abs(y).max(initial=0))
    if most * most >= 1 << 52:
        wide = y.astype(object)
        return wide.T @ wide
    step = max(1, (1 << 53) // max(1, most * most) - 1)
    total = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), step):
        part = y[i : i + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def covariance(n: int, sums: list[int], products: list[list[int]]) -> np.ndarray:
    """Covariance (divisor n) from sums and sums of products of whole numbers; rounded once, at the end."""
    d = len(sums)
    return np.array([[float(Fraction(n * products[i][j] - sums[i] * sums[j], n * n)) for j in range(d)] for i in range(d)]).reshape(d, d)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors of finite entries, in double precision, of the length that most of them have (the greater at ties)."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: F.coalesce(F.abs(c) < LIMIT, F.lit(False)) & ~F.isnan(c))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(v.isNotNull() & (F.size(v) > 0) & fine)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (lengths["d"] if lengths else 0))


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for each usable vector and each of the first components.

    Vectors that are NULL, or hold an entry that is NULL, not finite or 2**30 or more, are left out; so are those of another
    length than most. An entry c becomes the whole number x = floor(1024 * c) + 100000. The mean and the covariance V
    (divisor n) are of all remaining vectors. Each task sums whole numbers, centred about the rounded mean, without rounding, and
    Spark adds these up in 38 digits, so V does not depend on the order of rows and is rounded once. V has the
    size of a vector squared, whatever the number of rows; the driver splits it by QDWH into components (spectrum), and the
    first ones are sent to all tasks with the mean.

    whitened: the centred vector on a unit eigenvector over the root of its eigenvalue. explained: eigenvalue over trace.
    deviation: sum over dimensions of (n * x - sum) ** 2, NULL where it passes 64 bits. identity_error: largest entry of
    the whitened columns' covariance minus the identity, one value.

    Directions without variance (below 1e-12 of the trace) cannot be whitened and have no rows, so equal vectors, a
    single one and an empty table give none. Repeated rows and ids each count; a NULL id is kept; other columns are ignored.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = usable(vectors, id_col, vector_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            x = as_matrix(batch.column(0))
            if len(x):
                n, part = n + len(x), x.sum(axis=0)
                total = part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(np.full(len(total), n)), pa.array(total)], names=["i", "n", "s"])

    exact = "decimal(38,0)"
    got = rows.select("v").mapInArrow(add, "i int, n long, s long").groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(exact)).alias("s")).orderBy("i").collect()
    if not got:
        return spark.createDataFrame([], schema)
    n, sums = got[0]["n"], [int(r["s"]) for r in got]
    d, middle = len(sums), np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                total = total + exact_products(as_matrix(batch.column(0)) - middle)
        i, j = np.triu_indices(d)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array((i * d + j).astype(np.int64)), pa.array([str(t) for t in total[i, j]])], names=["place", "s"])

    summed = rows.select("v").mapInArrow(multiply, "place long, s string").groupBy("place").agg(F.sum(F.col("s").cast(exact)).alias("s")).collect()
    upper = {r["place"]: int(r["s"]) for r in summed}
    products = [[upper.get(min(i, j) * d + max(i, j), 0) for j in range(d)] for i in range(d)]
    values, axes = spectrum(covariance(n, [s - n * int(m) for s, m in zip(sums, middle, strict=True)], products))
    trace = float(values.sum())
    kept = [k for k in range(min(components, d)) if values[k] > 1e-12 * trace]
    if not kept:
        return spark.createDataFrame([], schema)
    off = np.array([float(Fraction(s, n) - int(m)) for s, m in zip(sums, middle, strict=True)])
    shared = spark.sparkContext.broadcast((middle, off, axes[:, kept] / np.sqrt(values[kept]), np.array([n * int(m) - s for s, m in zip(sums, middle, strict=True)], object)))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, off, axes, rest = shared.value
        for batch in batches:
            y = as_matrix(batch.column(1)) - middle
            most = max(n * int(np.abs(y).max(initial=0)) + int(max(abs(r) for r in rest)), 1)
            if most * most * d < 1 << 63:
                deviation = ((n * y + rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [x if x < 1 << 63 else None for x in ((n * y.astype(object) + rest) ** 2).sum(axis=1)]
            w = (y - off) @ axes
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    white = kept_table(rows.select("vec_id", "v").mapInArrow(project, "vec_id long, deviation long, w array<double>"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, mean, moment = 0, np.zeros(len(kept)), np.zeros((len(kept),) * 2)
        for batch in batches:
            w = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            if len(w):
                count, mean, moment = merged((count, mean, moment), (len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0))))
        if count:
            yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([mean.tolist()]), pa.array([moment.ravel().tolist()])], names=["n", "mean", "moment"])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        state = None
        for r in table.to_pylist():
            part = (r["n"], np.array(r["mean"]), np.array(r["moment"]).reshape(len(kept), -1))
            state = part if state is None else merged(state, part)
        return pa.table({"n": [state[0]], "mean": [state[1].tolist()], "moment": [state[2].ravel().tolist()]})

    moments = "n long, mean array<double>, moment array<double>"
    parts = white.select("w").mapInArrow(check, moments)
    for groups in (1024, 1):  # so many partial moments at most meet in the last task
        parts = parts.withColumn("group", F.spark_partition_id() % groups).groupBy("group").applyInArrow(meet, moments)
    final = parts.first()
    error = float(np.abs(np.array(final["moment"]).reshape(len(kept), -1) / final["n"] - np.eye(len(kept))).max())
    explained = F.element_at(F.lit([float(values[k] / trace) for k in kept]), F.col("component"))
    out = white.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).withColumn("component", F.col("k") + 1)
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def merged(a: tuple, b: tuple) -> tuple:
    """Counts, means and centred moments of two disjoint sets as those of their union."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)
