"""Mixing sources to target weights (DataFrame operations only)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table, text_or_empty, word_count


def weights(tokens: list[float], alpha: float) -> list[float]:
    """Token shares raised to alpha and normalised; sources without tokens get nothing."""
    total = sum(tokens)
    raised = [(x / total) ** alpha if x > 0 else 0.0 for x in tokens]
    return [x / sum(raised) for x in raised]


def entropy(shares: list[float]) -> float:
    return -sum(w * math.log(w) for w in shares if w > 0)


def repetition(tokens: list[float], shares: list[float]) -> float:
    """Times that the most repeated source is read while the least repeated one is read once."""
    rates = [w / x for x, w in zip(tokens, shares, strict=True) if x > 0]
    return max(rates) / min(rates)


def bisect_alpha(tokens: list[float], min_entropy_share: float | None, max_repetition: float | None, rounds: int = 60) -> float:
    """The exponent in [0, 1] for the target: the largest whose entropy reaches min_entropy_share of log(sources), or the least whose repetition stays in max_repetition.

    Entropy falls and repetition falls as the exponent grows, so both bisect. With both, the repetition limit wins.
    """
    live = [x for x in tokens if x > 0]
    if len(live) < 2:
        return 1.0
    low, high = 0.0, 1.0
    if min_entropy_share is not None:
        if entropy(weights(live, 1.0)) < min_entropy_share * math.log(len(live)):
            for _ in range(rounds):
                mid = (low + high) / 2
                low, high = (mid, high) if entropy(weights(live, mid)) >= min_entropy_share * math.log(len(live)) else (low, mid)
            alpha = low
        else:
            alpha = 1.0
    else:
        alpha = 0.0
    if max_repetition is not None and repetition(live, weights(live, alpha)) > max_repetition:
        low, high = alpha, 1.0
        for _ in range(rounds):
            mid = (low + high) / 2
            low, high = (low, mid) if repetition(live, weights(live, mid)) <= max_repetition else (mid, high)
        alpha = high
    return alpha


def hashed(seed: int, *columns: str) -> Column:
    """60 bits of the MD5 of a seed and some columns, as a number; NULL columns are left out."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in columns])), 1, 15), 16, 10).cast("long")


def same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


@dataclass(frozen=True)
class Mixture:
    """A plan: the exponent, and (source, weight, epochs, rest, s_tokens, block, b_start, b_tokens), one row for each block."""

    alpha: float
    blocks: int
    parts: DataFrame


def dealt(docs: DataFrame, id_col: str, blocks: int, seed: int) -> DataFrame:
    """docs with n_tokens, block and place, the order inside a block: both from id and text, so rows without an id are spread as well."""
    text = text_or_empty("text")
    docs = docs.withColumns({"n_tokens": word_count(text), "digest": F.md5(text)})
    return docs.withColumns({"block": F.pmod(hashed(seed, id_col, "digest"), F.lit(blocks)).cast("int"), "place": hashed(seed + 1, id_col, "digest")}).drop("digest")


def plan(rows: DataFrame, blocks: int, min_entropy_share: float | None, max_repetition: float | None, budget_tokens: float | None, seed: int, max_sources: int) -> Mixture:
    """The plan for rows (source, block, n_tokens): see mix."""
    sums = kept_table(rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("b_tokens")))
    sources = sums.groupBy("source").agg(F.sum("b_tokens").alias("s_tokens")).limit(max_sources + 1).collect()
    if len(sources) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sources.sort(key=lambda r: (r["source"] is not None, r["source"] or ""))
    tokens = [float(r["s_tokens"]) for r in sources]
    alpha = bisect_alpha(tokens, min_entropy_share, max_repetition)
    shares = weights(tokens, alpha) if sum(tokens) else [0.0] * len(tokens)
    budget = budget_tokens if budget_tokens is not None else max((x / w for x, w in zip(tokens, shares, strict=True) if w > 0), default=0.0)
    rated = []
    for r, x, w in zip(sources, tokens, shares, strict=True):
        quota = round(w * budget)
        rated.append((r["source"], w, int(quota // x) if x else 1, int(quota % x) if x else 0, int(x)))
    rated = F.broadcast(rows.sparkSession.createDataFrame(rated, "source string, weight double, epochs long, rest long, s_tokens long"))  # bounded: max_sources rows
    # Where each block starts in its source: one row for each block, blocks in hashed order.
    ahead = Window.partitionBy("source").orderBy(hashed(seed + 2, "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("b_start", F.coalesce(F.sum("b_tokens").over(ahead), F.lit(0)))
    parts = starts.alias("x").join(rated.alias("p"), same_source("x", "p")).select("x.source", "weight", "epochs", "rest", "s_tokens", "block", "b_start", "b_tokens")
    return Mixture(alpha, blocks, kept_table(parts))


def default_blocks(docs: DataFrame) -> int:
    """Blocks of a source: they grow with the table, so that a block of the largest source stays within some thousand rows."""
    return max(256, docs.count() // 4096)


def copies_of(start: Column) -> Column:
    """How often a row is read that starts at `start` of its source's permutation."""
    extra = F.when(F.col("n_tokens") > 0, (start < F.col("rest")).cast("long")).otherwise(F.lit(0))
    copies = F.col("epochs") + extra
    return F.when(F.col("n_tokens") == 0, F.greatest(copies, F.lit(1))).otherwise(copies).cast("long")


def inside() -> Column:
    """Tokens ahead of a row in its block. Rows with the same place, id and size are alike, so their order does not matter."""
    ahead = Window.partitionBy("source", "block").orderBy("place", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))


def mix(
    docs: DataFrame,
    min_entropy_share: float | None = None,
    max_repetition: float | None = 2.0,
    budget_tokens: float | None = None,
    blocks: int | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    max_sources: int = 100_000,
) -> DataFrame:
    """One row for each document: (doc_id, source, n_tokens, block, alpha, weight, copies, mix_key).

    Weights are the token shares of the sources, raised to the exponent that bisect_alpha finds. Without budget_tokens
    the budget is the smallest that reads every source at least once, so no document is left out; with it, a source
    whose quota is below its size is read in part. Each source is a permutation of blocks (documents are dealt
    to blocks, and blocks ordered, by seeded hashes of id and text; their number grows with the table unless it is given):
    whole epochs first, then whole blocks while the quota lasts, then
    the block where it ends, in a hashed order, up to the document that reaches the quota. copies is how often a
    document is taken, mix_key in [0, 1) the place of its first copy in its source's quota: sorting by it interleaves
    the sources in their proportions.

    A source is its name; NULL is a source of its own. Documents without tokens go with each epoch of their source and
    are taken at least once. Repeated rows count as rows, as do NULL ids. An empty table gives
    no rows. Only the table of sources (at most max_sources, else an error) reaches the driver; a hot source is spread
    over its blocks, and a window never holds more than one block of a source or one row for each block.
    """
    n_blocks = blocks or default_blocks(docs)
    rows = dealt(docs.select(F.col(id_col).alias("doc_id"), "source", "text"), "doc_id", n_blocks, seed).drop("text")
    rows = kept_table(rows)
    mixture = plan(rows, n_blocks, min_entropy_share, max_repetition, budget_tokens, seed, max_sources)
    rows = rows.withColumn("d_start", inside())
    rows = rows.alias("x").join(mixture.parts.alias("p"), same_source("x", "p") & (F.col("x.block") == F.col("p.block")))
    start = F.col("b_start") + F.col("d_start")
    copies = copies_of(start)
    key = start / F.greatest(F.col("epochs") * F.col("s_tokens") + F.col("rest"), F.lit(1))
    return rows.select("x.doc_id", "x.source", "n_tokens", "x.block", F.lit(mixture.alpha).alias("alpha"), "weight", copies.alias("copies"), F.when(copies > 0, key).alias("mix_key"))


def repeated(
    docs: DataFrame,
    columns: list[str],
    min_entropy_share: float | None = None,
    max_repetition: float | None = 2.0,
    budget_tokens: float | None = None,
    blocks: int | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    max_sources: int = 100_000,
) -> DataFrame:
    """The mixture itself: `columns` of each document, in as many rows as `mix` says that it is read.

    How often a document is read follows from its source and block alone, but for the one block of each source in which
    the quota ends: only that block's documents are put in order and joined by id, so no other text is shuffled. Rows
    with the same id, text and source there are read alike, as often as the first of them. The rest is as in mix.
    """
    n_blocks = blocks or default_blocks(docs)
    rows = dealt(docs.select(F.col(id_col).alias("doc_id"), "text", *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(columns)], "source"), "doc_id", n_blocks, seed)
    narrow = kept_table(rows.select("doc_id", "source", "n_tokens", "block", "place"))
    parts = plan(narrow, n_blocks, min_entropy_share, max_repetition, budget_tokens, seed, max_sources).parts
    ends = (F.col("b_start") < F.col("rest")) & (F.col("rest") < F.col("b_start") + F.col("b_tokens"))
    with_plan = lambda df: df.alias("x").join(parts.withColumn("ends", ends).alias("p"), same_source("x", "p") & (F.col("x.block") == F.col("p.block"))).select("x.*", "epochs", "rest", "b_start", "ends")
    last = with_plan(narrow).where("ends").withColumn("d_start", inside())
    last = last.withColumn("copies", copies_of(F.col("b_start") + F.col("d_start"))).groupBy("doc_id", "source", "place").agg(F.max("copies").alias("copies"))
    last = kept_table(last)
    planned = with_plan(rows)
    whole = planned.where("NOT ends").withColumn("copies", copies_of(F.col("b_start")))
    x, y = planned.where("ends").alias("x"), last.alias("y")
    split = x.join(y, F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & same_source("x", "y") & (F.col("x.place") == F.col("y.place"))).select("x.*", "y.copies")
    out = [F.col(f"kept_{i}").alias(c) for i, c in enumerate(columns)]
    both = whole.select(*out, "copies").unionByName(split.select(*out, "copies"))
    return both.select(*columns, F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy")).drop("copy")
