"""Near-duplicate detection: tensored MinHash banding, exact verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import components, kept_table

SHINGLE = 5
#: Broadcast the ids of documents to re-read only up to this many (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000
#: Bits of a set's parity map.
PARITY = 1024
_RNG = np.random.default_rng(20240229)
_WEIGHTS = _RNG.integers(1, 2**63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's 5-word shingles; A-Z folded; a shorter text is one shingle; no words, none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=5)], np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.array([digest(w) for w in words], np.uint64)
    n = len(words) - SHINGLE + 1
    sums = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        sums += hashed[k : k + n] * _WEIGHTS[k]
    return np.unique(_mix(sums))


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, the same for any order."""
    with np.errstate(over="ignore"):
        return tuple(int(_mix(s ^ np.uint64(salt)).sum(dtype=np.uint64).astype(np.int64)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def _constants(tables: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240301)
    n = 2 * tables * width
    return rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, n, dtype=np.uint64)


def signatures(docs: DataFrame, tables: int, width: int) -> DataFrame:
    """(doc_id, n, f1, f2, factors, parity): set size, a 128-bit hash of the set, 2 * tables factor values of width minhashes
    each, and the set's parity map."""
    odd, flip = _constants(tables, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.arange(2 * tables, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            n, f1, f2, factors, parities = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                with np.errstate(over="ignore"):
                    for out, half in zip((f1, f2), set_hash(s), strict=True):
                        out.append(half)
                    if not len(s):
                        factors.append([])
                        parities.append([])
                        continue
                    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
                    for at in range(0, len(s), 2048):
                        least = np.minimum(least, ((s[at : at + 2048, None] ^ flip) * odd).min(axis=0))
                    parts = _mix(least).reshape(2 * tables, width)
                    key = slots.copy()
                    for k in range(width):
                        key = _mix(key ^ parts[:, k])
                    parity = np.packbits((np.bincount((s >> np.uint64(40)).astype(np.int64) & (PARITY - 1), minlength=PARITY) & 1).astype(np.uint8)).view(np.int64)
                    parities.append(parity)
                factors.append(key.astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(factors, pa.list_(pa.int64())), pa.array(parities, pa.list_(pa.int64()))], names=["doc_id", "n", "f1", "f2", "factors", "parity"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, f1 long, f2 long, factors array<long>, parity array<long>")


def own_sets(texts: DataFrame) -> DataFrame:
    """(node, set), once for each class, of (node, f1, f2, text): texts of the class's id, of which those with another set are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for node, f1, f2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = shingle_set(text)
                if set_hash(s) == (f1, f2):
                    nodes.append(node)
                    sets.append(s.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["node", "set"])

    found = texts.select("node", "f1", "f2", "text").mapInArrow(run, "node long, set binary")
    return found.groupBy("node").agg(F.first("set").alias("set"))


def verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges (a, b) whose full sets meet 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = edges.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())  # neither set repeats a hash
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 75, tables: int = 14, width: int = 2, id_col: str = "doc_id") -> DataFrame:
    """One row for each document: (doc_id, n_shingles, component_id, kept).

    Documents are linked when 100 * |A and B| >= percent * |A or B| over their sets of distinct 5-word shingles (A-Z
    folded, whole texts; under five words the whole sequence is one shingle; no words link with nothing).
    component_id is the smallest doc_id reachable over links, kept marks that document.

    Method. Two collections of `tables` factors, each factor a hash of `width` minhashes, are tensored: a table key
    is a pair (factor i of the first, factor j of the second), so tables**2 keys of 2 * width minhashes come from
    2 * tables * width minhash functions. A pair of similarity s shares a key with probability
    (1 - (1 - s**width)**tables)**2: over 0.99998 at 0.75 with the defaults.

    1. Equal sets collapse into a class (aggregated before any shuffle), named by its smallest id; if several classes
       have the same smallest id, as rows of one id may differ in text, all but one of them get numbers of their own.
    2. Factors that occur in one class only cannot be part of a shared key and are dropped before keys are formed.
    3. Every class is verified against the smallest class in each of its buckets, and then every pair that shares a
       key and still lies in different components is verified. No pair is skipped unless its ends are already joined or
       its set sizes or parity maps rule it out, which are exact bounds. In a bucket only what lies outside its largest
       component is paired, so a group of near copies is not compared with itself.
    4. Links are verified on full sets; components are found by alternating stars.

    NULL text is empty. NULL ids are kept as rows of their own with component_id NULL and kept false. Rows that share an
    id are documents of their own, each with the component of its text; repeated rows are equal sets. An empty table
    gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    sigs = kept_table(signatures(docs, tables, width))
    same_set = ["f1", "f2", "n"]
    classes = sigs.where("n > 0 AND doc_id IS NOT NULL").groupBy(*same_set).agg(F.min("doc_id").alias("least"), F.first("factors").alias("factors"), F.first("parity").alias("parity"))
    classes = kept_table(classes.withColumn("node", F.col("least")))
    doubled = kept_table(classes.groupBy("node").agg(F.count("*").alias("c"), F.min("f1").alias("kept")).where("c > 1").select("node", "kept"))
    if not doubled.isEmpty():
        own = F.bitwise_not(F.shiftrightunsigned(F.xxhash64(*same_set), 1))
        other = F.col("f1") != F.col("kept")
        classes = kept_table(classes.join(doubled, "node", "left").withColumn("node", F.when(other, own).otherwise(F.col("node"))).drop("kept"))
    named = class_components(docs, classes, percent, tables, width)
    whole = sigs.select("doc_id", *same_set).join(classes.select("node", "least", *same_set), same_set, "left")
    if named is not None:
        named = kept_table(named)
        least = kept_table(named.join(classes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("component_id")))
        whole = whole.join(named.join(least, "component").select("node", "component_id"), "node", "left")
    else:
        whole = whole.withColumn("component_id", F.lit(None).cast("long"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "least", "doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def parities_allow(x: str, y: str, total: Column, percent: int) -> Column:
    """Whether two sets of `total` members together can reach the threshold: each place where their parity maps differ needs a member of one alone."""
    apart: Column = F.lit(0)
    for i in range(PARITY // 64):
        apart = apart + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return apart * (100 + percent) <= total * (100 - percent)


def class_components(docs: DataFrame, classes: DataFrame, percent: int, tables: int, width: int) -> DataFrame | None:
    """(node, component) of the classes (node, least, n, f1, f2, factors, parity) that have links; None without candidates."""
    factors = classes.select("node", F.posexplode("factors").alias("slot", "value"))
    shared = factors.groupBy("value").agg(F.count("*").alias("c")).where("c > 1").select("value")
    alive = factors.join(shared, "value", "left_semi").groupBy("node").agg(F.collect_list(F.struct("slot", "value")).alias("fs"))

    def side(first: bool) -> Column:
        return F.transform(F.filter("fs", lambda f: (f["slot"] < tables) == F.lit(first)), lambda f: f["value"])

    alive = kept_table(alive.select("node", side(True).alias("g"), side(False).alias("h")).where("size(g) > 0 AND size(h) > 0"))
    keys = alive.select("node", F.explode("g").alias("gv"), "h").select("node", "gv", F.explode("h").alias("hv")).select(F.xxhash64("gv", "hv").alias("key"), "node")
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1").select("key", "hub")
    buckets = kept_table(keys.join(hubs, "key").select("key", "node", "hub"))
    tried = kept_table(buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    if tried.isEmpty():
        return None
    # One text of each class in a bucket: rows that share an id are told apart by their sets.
    wanted = kept_table(classes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "least", "f1", "f2"))
    small = wanted.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(wanted) if small else wanted, F.col("doc_id") == F.col("least"))
    sets = kept_table(own_sets(texts))
    links = kept_table(verified(tried, sets, percent))

    labels = kept_table(components(links).withColumnRenamed("component", "label"))
    # What is left: pairs that share a key and lie in different components. Matching on one factor of the first
    # collection (the least that both hold) with an overlap in the second gives each such pair once.
    narrow = kept_table(alive.select("node", F.explode("g").alias("gv")).join(labels, "node", "left").select("node", "gv", F.coalesce("label", "node").alias("comp")))
    sizes = narrow.groupBy("gv", "comp").agg(F.count("*").alias("c"))
    mixed = kept_table(sizes.groupBy("gv").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1").select("gv", "main"))
    narrow = kept_table(narrow.join(mixed, "gv"))  # the wide columns only travel with what is left
    split = narrow.join(alive, "node").join(classes.select("node", "n", "parity"), "node")
    x, y = split.where("comp <> main").alias("x"), split.alias("y")
    apart = (F.col("x.gv") == F.col("y.gv")) & (F.col("x.comp") != F.col("y.comp")) & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.node") < F.col("y.node")))
    sized = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    once = F.array_min(F.array_intersect("x.g", "y.g")) == F.col("x.gv")
    possible = parities_allow("x.parity", "y.parity", F.col("x.n") + F.col("y.n"), percent)
    rest = x.join(y, apart & sized & possible & F.arrays_overlap("x.h", "y.h") & once).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    rest = rest.join(tried, ["a", "b"], "left_anti")
    late = kept_table(verified(rest, sets, percent))
    if late.isEmpty():
        return labels.withColumnRenamed("label", "component")
    # The late links join components as wholes.
    def component_of(side: str) -> DataFrame:
        return labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))

    joined = late.join(component_of("a"), "a", "left").join(component_of("b"), "b", "left")
    joined = joined.select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
    wholes = kept_table(components(joined).select(F.col("node").alias("label"), "component"))
    known = labels.unionByName(late.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti").withColumn("label", F.col("node")))
    return known.join(wholes, "label", "left").select("node", F.coalesce("component", "label").alias("component"))
