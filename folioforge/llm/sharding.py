"""Sharding: documents to shards that are balanced in bytes, tokens and rows at once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import kept_table, text_or_empty, word_count

MEASURES = ("size", "n_tokens", "n_rows")


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Vector bin packing: the largest vector first, to the shard whose residual capacity has the highest dot product with it.

    vectors: items x measures. Capacities are equal shares of the totals; each measure is scaled by its capacity.
    Residuals may go below zero, so every item finds a place. Ties go to the lower shard.
    """
    total = vectors.sum(axis=0)
    scaled = vectors * n_shards / np.where(total > 0, total, 1.0)
    residual = np.ones((n_shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=np.int32)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        out[i] = np.argmax(residual @ scaled[i])
        residual[out[i]] -= scaled[i]
    return out


def assign_shards(docs: DataFrame, n_shards: int = 16, parcels: int = 4096, id_col: str = "doc_id") -> DataFrame:
    """One row for each document: (doc_id, size, n_tokens, text_crc32, shard, slot).

    size: UTF-8 bytes of the text plus 1 (NULL text: 1, no tokens). Groups are documents of equal text (NULL and empty
    are one group). A group goes as a whole into one of `parcels` parcels by its hash; a group that would be larger
    than one parcel's even share in any measure is hot and is split by document id into chunks of about that share.
    So what the driver packs is bounded by parcels and the number of shares, whatever the input's size. Parcels and
    chunks are packed by `place`. Slots count from 0 without gaps in each shard: parcels follow each other, and rows
    are numbered within their parcel by (id, size), so no window sees more than a parcel. Repeated rows are kept, each
    with a slot of its own; NULL ids sort first. An empty table gives no rows. Other columns are ignored.
    """
    spark, text = docs.sparkSession, text_or_empty("text")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), word_count(text).alias("n_tokens"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    rows = kept_table(rows)
    totals = rows.agg(F.sum("size"), F.sum("n_tokens"), F.count("*")).first()
    share = [max(1.0, (x or 0) / parcels) for x in totals]
    groups = rows.groupBy("text_hash", "text_crc32", "size").agg(F.sum("size").alias("g_size"), F.sum("n_tokens").alias("g_tokens"), F.count("*").alias("g_rows"))
    chunks = F.ceil(F.greatest(*[F.col(c) / F.lit(s) for c, s in zip(("g_size", "g_tokens", "g_rows"), share, strict=True)]))
    hot = groups.where((F.col("g_rows") > 1) & (chunks > 1)).select("text_hash", "text_crc32", "size", F.least(chunks, F.col("g_rows")).cast("long").alias("chunks"))
    # Each hot group holds a full share of some measure: there are at most 3 * parcels of them, so this side is small by construction.
    rows = rows.join(F.broadcast(hot), ["text_hash", "text_crc32", "size"], "left")
    salt = F.when(F.col("chunks").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("chunks")))
    parcel = F.when(F.col("chunks").isNull(), F.pmod("text_hash", F.lit(parcels))).otherwise(F.xxhash64("text_hash", "text_crc32", "size"))
    rows = rows.select("doc_id", "size", "n_tokens", "text_crc32", parcel.cast("long").alias("parcel"), salt.cast("long").alias("salt"))
    sums = rows.groupBy("parcel", "salt").agg(F.sum("size").cast("double").alias("size"), F.sum("n_tokens").cast("double").alias("n_tokens"), F.count("*").cast("double").alias("n_rows"))
    items = sums.toPandas().sort_values(["parcel", "salt"], ignore_index=True)  # bounded: parcels + chunks
    items["shard"] = place(items[list(MEASURES)].to_numpy(dtype=float), n_shards)
    items["start"] = items.groupby("shard")["n_rows"].cumsum() - items["n_rows"]
    schema = T.StructType([T.StructField("parcel", T.LongType()), T.StructField("salt", T.LongType()), T.StructField("shard", T.IntegerType()), T.StructField("start", T.LongType())])
    plan = spark.createDataFrame([(int(p), int(s), int(h), int(b)) for p, s, h, b in zip(items["parcel"], items["salt"], items["shard"], items["start"], strict=True)], schema)
    within = F.row_number().over(Window.partitionBy("parcel", "salt").orderBy("doc_id", "size", "text_crc32"))
    rows = rows.withColumn("within", within).join(F.broadcast(plan), ["parcel", "salt"])
    return rows.select("doc_id", "size", "n_tokens", "text_crc32", "shard", (F.col("start") + F.col("within") - 1).cast("long").alias("slot"))
