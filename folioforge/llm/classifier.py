"""Quality classifier: importance resampling with hashed n-gram models and Gumbel top-k."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table

#: Labelled rows that fit the target model at most (those with the least hash of their id).
LABELLED_ROWS = 50_000


def ngram_buckets(text: str | None, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Buckets of all byte n-grams of the whole text, one for each n-gram and size."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    out = []
    for n in sizes:
        if len(raw) >= n:
            key = np.full(len(raw) - n + 1, n, np.uint32)
            for k in range(n):
                key = (key ^ raw[k : len(raw) - n + 1 + k]) * np.uint32(0x9E3779B1)
                key ^= key >> np.uint32(15)
            out.append(key >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def for_cut(doc: int) -> bool:
    """Whether a labelled document is held out of the fit, to find the cut: a third, by its id."""
    return zlib.crc32(str(doc).encode()) % 3 == 0


def labelled_sample(labels: DataFrame, rows: int) -> dict[int, int]:
    """doc_id -> quality for at most `rows` labelled documents, the same for any order of the rows; NULLs are left out, a document with both labels is bad."""
    picked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return {int(r["doc_id"]): int(r["quality"]) for r in picked.collect()}


def fit(docs: DataFrame, sample: dict[int, int], sizes: tuple[int, ...], bits: int, smoothing: float) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw): raw counts come from all documents, target counts from the good labelled ones.

    Each task adds up its n-grams; sums by bucket are shuffled, and 2**bits of them collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2**bits, np.int64), np.zeros(2**bits, np.int64)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = np.bincount(ngram_buckets(text, sizes, bits), minlength=2**bits)
                raw += n
                if sample.get(doc) == 1:
                    target += n
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    sums = docs.select("doc_id", "text").mapInArrow(run, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(2**bits), np.zeros(2**bits)
    for bucket, r, t in sums.collect():
        raw[bucket], target[bucket] = r, t
    raw, target = raw + smoothing, target + smoothing * (target.sum() + 1) / (raw.sum() + 1)
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def top_k_threshold(scores: DataFrame, key: str, k: int, ways: int = 1024) -> tuple[float, int]:
    """The k-th largest key, and how many rows at exactly that key belong to the top k.

    The range that holds it is cut into `ways` parts, counted, and narrowed, until it is a single value; each round
    moves at most `ways` counts. NULL keys do not exist here.
    """
    low, high = scores.agg(F.min(key), F.max(key)).first()
    above = 0
    for _ in range(12):
        if low == high:
            break
        step = (high - low) / ways
        if step <= 0 or low + step == low:
            break
        part = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(step)), F.lit(ways - 1))
        inside = scores.where((F.col(key) >= low) & (F.col(key) <= high))
        parts = sorted(inside.groupBy(part.alias("p")).agg(F.count("*").alias("c"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect(), key=lambda r: -r["p"])
        for r in parts:
            if above + r["c"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["c"]
    if low != high:  # neighbouring floats: the few rows left are sorted
        for r in scores.where((F.col(key) >= low) & (F.col(key) <= high)).groupBy(key).count().orderBy(F.col(key).desc()).collect():
            if above + r["count"] >= k:
                return float(r[key]), k - above
            above += r["count"]
    return float(low), k - above


def classify(
    docs: DataFrame,
    labels: DataFrame,
    keep: float | None = None,
    temper: float = 1.0,
    good_cost: float = 20.0,
    sizes: tuple[int, ...] = (2, 3, 4),
    bits: int = 16,
    smoothing: float = 1.0,
    labelled_rows: int = LABELLED_ROWS,
    seed: int = 3,
    id_col: str = "doc_id",
    key_col: str | None = None,
) -> DataFrame:
    """One row for each document: (doc_id, n_grams, log_weight, gumbel_key, kept), and key_col (a long) if it is given.

    Two bag-of-n-grams models over hashed byte n-grams of whole texts: target (good labelled documents, at most
    labelled_rows labels, but for a third held out by id) and raw (all documents). log_weight is the logarithm of the
    likelihood ratio of the text under the two, which is its importance weight (raised to `temper`). Adding Gumbel noise,
    drawn from a hash of the id and the text, and taking the k largest keys samples k documents without replacement in
    proportion to these weights. k is keep times the number of documents; by default keep comes from the held-out labelled
    documents: as many are sampled as score above the cut that separates their good from their bad ones best, where losing
    a good one costs as much as keeping good_cost bad ones. (Without both kinds among those held out, the cut is read on all.)

    The k-th key is found by counting in ranges, never by a global sort. Ties at it go by (id, hash). NULL and empty
    texts have weight 0 n-grams, log_weight NULL, and are never sampled. Without any good labelled document all
    documents with text are kept. Repeated rows each count. An empty table gives no rows; other columns are ignored.
    """
    key = [] if key_col is None else [key_col]
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text", *key)
    sample = labelled_sample(labels, labelled_rows)
    fitted = {d: q for d, q in sample.items() if not for_cut(d)}
    fitted = fitted if any(fitted.values()) else sample
    held = {d: q for d, q in sample.items() if d not in fitted}
    cut_on = held if {q == 1 for q in held.values()} == {True, False} else sample
    ratio = fit(docs, fitted, sizes, bits, smoothing) if any(sample.values()) else np.zeros(2**bits, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight, label = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = ngram_buckets(text, sizes, bits)
                n.append(len(at))
                weight.append(float(ratio[at].sum(dtype=np.float64)) if len(at) else None)
                label.append(cut_on.get(doc))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.float64()), pa.array(label, pa.int32()), *batch.columns[2:]], names=["doc_id", "n_grams", "log_weight", "label", "noise", *key])

    noise = F.xxhash64("doc_id", F.crc32(F.coalesce("text", F.lit(""))), F.lit(seed))
    scores = docs.select("doc_id", "text", noise.alias("noise"), *key).mapInArrow(run, "doc_id long, n_grams long, log_weight double, label int, noise long" + "".join(f", {k} long" for k in key))
    scores = kept_table(scores.withColumn("gumbel_key", F.lit(temper) * F.col("log_weight") - F.log(-F.log(_uniform(F.col("noise"))))))
    judged = scores.where("log_weight IS NOT NULL")
    n_all = judged.count()
    if keep is not None:
        k = round(keep * n_all)
    elif any(sample.values()):
        k = judged.where(F.col("log_weight") >= best_cut(judged, good_cost)).count()
    else:
        k = n_all
    if not 0 < k < n_all:
        return scores.select("doc_id", "n_grams", "log_weight", "gumbel_key", (F.col("log_weight").isNotNull() & F.lit(k > 0)).alias("kept"), *key)
    edge, ties = top_k_threshold(judged, "gumbel_key", k)
    last = judged.where(F.col("gumbel_key") == edge).select(F.struct(F.coalesce("doc_id", F.lit(-(2**63))), "noise").alias("t")).orderBy("t").limit(ties).agg(F.max("t").alias("t")).first()["t"]
    order = F.struct(F.coalesce("doc_id", F.lit(-(2**63))), F.col("noise"))
    kept = (F.col("gumbel_key") > edge) | ((F.col("gumbel_key") == edge) & (order <= F.struct(F.lit(last[0]).cast("long"), F.lit(last[1]).cast("long"))))
    return scores.select("doc_id", "n_grams", "log_weight", "gumbel_key", F.coalesce(kept, F.lit(False)).alias("kept"), *key)


def _uniform(noise: Column) -> Column:
    """A number strictly inside (0, 1) from 64 hashed bits."""
    return (F.shiftrightunsigned(noise, 11).cast("double") + 0.5) / F.lit(2.0**53)


def best_cut(judged: DataFrame, good_cost: float, ways: int = 4096) -> float:
    """The cut on log_weight with the least cost of labelled documents on the wrong side; the middle of the gap where several are equal.

    Labelled scores are counted in `ways` ranges of equal width on the scale of asinh, fine around 0, so what reaches the
    driver is bounded.
    """
    known = judged.where("label IS NOT NULL").withColumn("scaled", F.asinh("log_weight"))
    low, high = known.agg(F.min("scaled"), F.max("scaled")).first()
    if low is None or low == high:
        return -np.inf
    part = F.least(F.floor((F.col("scaled") - F.lit(low)) / F.lit((high - low) / ways)), F.lit(ways - 1)).cast("int")
    good, bad = np.zeros(ways), np.zeros(ways)
    for r in known.groupBy(part.alias("p")).agg(F.sum((F.col("label") == 1).cast("long")).alias("g"), F.count("*").alias("n")).collect():
        good[r["p"]], bad[r["p"]] = r["g"], r["n"] - r["g"]
    wrong = np.concatenate([[0], good_cost * np.cumsum(good)]) + np.concatenate([np.cumsum(bad[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    return float(np.sinh(low + (high - low) * (best[0] + best[-1]) / 2 / ways))
