"""Benchmark decontamination (DataFrame operations only): SimHash windows, multi-index Hamming blocks, exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table, word_array

SHINGLE, BLOCKS, BITS = 5, 8, 8
UNIT = 1 << 20


def word_hashes(text: Column) -> Column:
    """64-bit hashes of the folded words of a whole text; NULL is empty."""
    return F.transform(word_array(F.lower(F.coalesce(text, F.lit("")))), lambda w: F.xxhash64(w))


def shingle_at(words: str, at: Column) -> Column:
    """Hash of the five words from position at, counted from 0."""
    return F.xxhash64(*[F.get(F.col(words), at + k) for k in range(SHINGLE)])


def shingles(words: str) -> Column:
    """Distinct shingle hashes of an array of word hashes."""
    n = F.size(words) - SHINGLE
    return F.when(n < 0, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: shingle_at(words, i))))


def simhash(words: str) -> Column:
    """64 majority votes over the bits of the word hashes."""
    return F.expr(f"aggregate(transform(sequence(0, 63), b -> IF(aggregate({words}, 0, (n, h) -> n + CAST(getbit(h, b) AS INT) * 2 - 1) > 0, shiftleft(1L, b), 0L)), 0L, (a, x) -> a | x)")


def hamming_blocks(fingerprint: str, flips: int) -> Column:
    """(block, value) rows of a fingerprint's 8 blocks of 8 bits, with every value that differs in at most flips (0 to 2) bits."""
    masks = [m for m in range(2**BITS) if m.bit_count() <= flips]
    # Loops of the plan, as hundreds of written-out structs are more than a generated method holds.
    value = f"CAST((shiftrightunsigned({fingerprint}, j * {BITS}) & {2**BITS - 1}) ^ m AS INT)"
    return F.expr(f"flatten(transform(sequence(0, {BLOCKS - 1}), j -> transform(array({', '.join(map(str, masks))}), m -> struct(j AS block, {value} AS value))))")


def laid_windows(spots: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_key, item_id, n, start) of all windows whose shared shingles may weigh enough.

    spots: places of a document (at) where a shingle of the item stands, with its weight and the item's whole weight. A
    window is laid if the spots that it may hold, up to its last one, weigh percent of the item. This bounds its
    similarity from above, wherever in the item those shingles stand, so no window that reaches it is passed over.
    """
    by = Window.partitionBy("doc_id", "text_key", "item_id")
    reach = F.col("n") - SHINGLE
    # Frames are of one length: in units of just over the reach, the window's spots lie within one unit.
    place = F.expr(f"CAST(at AS BIGINT) * {UNIT} div (n - {SHINGLE - 1})")
    held = F.sum("weight").over(by.orderBy(place).rangeBetween(-UNIT - 1, 0))
    rows = spots.withColumn("held", held).withColumn("next", F.lead("at").over(by.orderBy("at"))).where(100 * F.col("held") >= percent * F.col("whole") - 1e-6)
    first = F.greatest(F.col("at") - reach, F.lit(0))
    last = F.least(F.coalesce(F.col("next") - 1 - reach, F.col("at")), F.col("at"), F.greatest(F.col("nw") - F.col("n"), F.lit(0)))
    return rows.where(first <= last).select("doc_id", "text_key", "item_id", "n", F.explode(F.sequence(first, last)).alias("start"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = 75, radius: int = 23, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """One row for each document and benchmark item that it contains: (doc_id, item_id, start_word, end_word, distance, similarity).

    Whole texts, words folded to lower case. A window has as many words as its item (a shorter text is one window). Only a
    window that holds enough of the item's five-word shingles can reach the similarity asked for, in whatever order they
    stand, so windows are laid at every start where the weights of shared shingles come to percent of the item's
    (laid_windows), and nowhere else. Each window gets a 64-bit SimHash of its words. Items stand in a multi-index: 8 blocks of 8 bits, each with all values at up to two flipped
    bits, so that any two fingerprints within distance 23 meet in a block (radius at most 23). A window is looked up
    among the entries of the items that it was laid for, so it never meets the rest of a large benchmark by chance.
    Candidates within radius are verified by the weighted Jaccard similarity of their shingle sets: 100 * common weight >=
    percent * total weight, where an item's shingle weighs one over the number of items that have it, any other 1. The
    best window of each (document, item) is returned.

    Items of under five words cannot be told from chance and are left out; equal items are each reported. NULL and
    empty texts give no rows. A NULL doc_id is reported as NULL; rows that share an id are searched apart and reported
    once. Item tables are written to the shared folder first, so that the planner broadcasts them only while their
    size is under its threshold. Empty tables give no rows; other columns are ignored.
    """
    if not 0 <= radius <= 23:
        raise ValueError("radius must be 0 to 23")
    items = benchmark.where(f"`{item_col}` IS NOT NULL").select(F.col(item_col).alias("item_id"), word_hashes(F.col("text")).alias("iw")).where(F.size("iw") >= SHINGLE).distinct()
    items = items.select("item_id", F.size("iw").alias("n"), shingles("iw").alias("is"), simhash("iw").alias("ifp"))
    places = kept_table(items.select("item_id", "n", F.explode("is").alias("shingle")))
    places = places.join(places.groupBy("shingle").agg((1.0 / F.countDistinct("item_id")).alias("weight")), "shingle")
    whole = places.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("shingle", "weight"))).alias("weights"), F.sum("weight").alias("whole"))
    items = kept_table(items.join(whole, "item_id"))
    places = kept_table(places.join(items.select("item_id", "whole"), "item_id"))

    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64("text").alias("text_key"), word_hashes(F.col("text")).alias("w"))
    at = F.explode(F.sequence(F.lit(0), F.size("w") - SHINGLE)).alias("at")
    spots = words.where(F.size("w") >= SHINGLE).select("doc_id", "text_key", F.size("w").alias("nw"), at, "w")
    spots = spots.select("doc_id", "text_key", "nw", "at", shingle_at("w", F.col("at")).alias("shingle"))
    spots = kept_table(spots.join(places, "shingle").select("doc_id", "text_key", "item_id", "n", "nw", "at", "weight", "whole").distinct())
    laid = kept_table(laid_windows(spots, percent))

    same = F.col("d.doc_id").eqNullSafe(F.col("v.doc_id")) & (F.col("d.text_key") == F.col("v.text_key"))
    # Texts are dealt as they are, at every size, as the number of documents with windows has no bound; only these are cut into words again.
    hits = kept_table(laid.select("doc_id", "text_key").distinct())
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    texts = kept_table(texts.alias("d").join(hits.hint("shuffle_hash").alias("v"), same, "left_semi"))
    again = texts.select("doc_id", "text_key", word_hashes(F.col("text")).alias("w")).alias("d").join(laid.select("doc_id", "text_key", "start", "n").distinct().alias("v"), same)
    cut = again.select("d.doc_id", "d.text_key", "v.start", "v.n", F.expr("slice(d.w, v.start + 1, v.n)").alias("ww")).distinct()
    cut = kept_table(cut.select("doc_id", "text_key", "start", "n", F.size("ww").alias("long"), simhash("ww").alias("fp"), shingles("ww").alias("ws")))
    owned = cut.alias("d").join(laid.alias("v"), same & (F.col("d.start") == F.col("v.start")) & (F.col("d.n") == F.col("v.n"))).select("d.*", "v.item_id")
    met = owned.select("doc_id", "item_id", "start", "long", "fp", "ws", F.explode(hamming_blocks("fp", 0)).alias("b"))
    met = met.select("doc_id", "item_id", "start", "long", "fp", "ws", F.col("b.block").alias("block"), F.col("b.value").alias("value"))
    index = kept_table(items.select("item_id", "ifp", F.explode(hamming_blocks("ifp", radius // BLOCKS)).alias("b")).select("item_id", "ifp", "b.block", "b.value"))
    near = met.join(index, ["item_id", "block", "value"]).withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp")))).where(F.col("distance") <= radius)
    near = near.select("doc_id", "item_id", "start", F.col("long").alias("n"), "distance", "ws").distinct().join(items.select("item_id", "weights"), "item_id")
    common = F.aggregate(F.array_intersect("ws", F.map_keys("weights")), F.lit(0.0), lambda a, x: a + F.element_at(F.col("weights"), x))
    total = F.aggregate(F.map_values("weights"), F.lit(0.0), lambda a, x: a + x) + F.size(F.array_except("ws", F.map_keys("weights")))
    near = near.withColumn("common", common).withColumn("total", total).where(100 * F.col("common") >= percent * F.col("total") - 1e-9)
    best = F.min_by(F.struct("start", "n", "distance", (F.col("common") / F.col("total")).alias("similarity")), F.struct(-F.col("common") / F.col("total"), "start", "n"))
    found = near.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select("doc_id", "item_id", F.col("b.start").cast("long").alias("start_word"), (F.col("b.start") + F.col("b.n")).cast("long").alias("end_word"), F.col("b.distance").cast("int").alias("distance"), F.round("b.similarity", 6).alias("similarity"))
