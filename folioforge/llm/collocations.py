"""Phrase collocations: counts of all frequent word sequences by multikey quicksort of suffix pointers, then scores of their cuts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table

#: Words of the longest phrase.
DEPTH = 4
#: Bytes of text of a block, and pointers that a route gets on average.
BLOCK_BYTES, ROUTE_POINTERS = 4 << 20, 1 << 19
#: Every character that ends a piece becomes a full stop, the other blank a space (fixed values).
ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b".........\x20")
BLOCKS = "block long, lang string, total long, words array<string>, counts array<long>, codes binary"


def packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers of one length, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([c.astype(np.int64) for c in columns]).tobytes())


def unpacked(data: bytes, columns: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64).reshape(columns, -1)


def cuts(text: str, size: int) -> Iterator[bytes]:
    """The folded text with a lone full stop at each end of a piece, in parts of about size bytes (a longer piece stays whole)."""
    folded, first = text.encode().lower().translate(ENDS).replace(b".", b" . "), 0
    while len(folded) - first > size:
        last = folded.find(b" . ", first + size)
        if last < 0:
            break
        yield folded[first : last + 3]
        first = last + 3
    yield folded[first:] if first else folded


def coded(lang: str, parts: list[bytes], block: int) -> pa.RecordBatch:
    """A block's words of one language: its own list of words with counts, and the text as places in it (-1 between pieces)."""
    words = pc.dictionary_encode(pc.list_flatten(pc.ascii_split_whitespace(pa.array([(b" . ".join(parts)).decode()], pa.large_string()))))
    codes, names = words.indices.to_numpy().astype(np.int64), words.dictionary
    stop, none = (pc.index(names, pa.scalar(x, names.type)).as_py() for x in (".", ""))
    codes = codes[codes != none] if none >= 0 else codes
    if stop >= 0:
        codes = np.where(codes == stop, -1, codes)
    counts = np.bincount(codes[codes >= 0], minlength=len(names))
    row = [[block], [lang], [int(counts.sum())], [names.to_pylist()], [counts.tolist()], [packed(codes)]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()), strict=True)], names=["block", "lang", "total", "words", "counts", "codes"])


def blocks_of(docs: DataFrame, size: int) -> DataFrame:
    """Texts where they are read, in blocks of about size bytes, coded by language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        bulk, block = 0, TaskContext.get().partitionId() << 32

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal bulk, block
            for lang, parts in held.items():
                yield coded(lang, parts, block)
                block += 1
            held.clear()
            bulk = 0

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                for part in cuts(text.as_py(), size):
                    held.setdefault(lang.as_py(), []).append(part)
                    bulk += len(part)
                    if bulk >= size:
                        yield from flush()
        yield from flush()

    return docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")).mapInArrow(run, BLOCKS)


def mixed(*columns: np.ndarray) -> np.ndarray:
    """A 64-bit hash of rows of whole numbers; equal rows have equal hashes."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def suffixes(ids: np.ndarray, total: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of two to four words that begin at each word (rows of columns, -1 behind the end), and two rows of spreads.

    A phrase occurs no oftener than its rarest word. The spreads are over how many routes the suffixes of the leading two, and then
    of the leading three words are to be dealt, so that each gets most of them at the utmost: 1 for nearly all.
    """
    cols, f = np.full((DEPTH, len(ids)), -1, np.int64), np.zeros((DEPTH - 1, len(ids)), np.int64)
    for k in range(min(DEPTH, len(ids))):
        cols[k, : len(ids) - k] = ids[k:]
        if k < DEPTH - 1:
            f[k, : len(ids) - k] = total[k:]
    use = (cols[0] >= 0) & (cols[1] >= 0)
    cols, f = cols[:, use], f[:, use]
    cols[3, cols[2] < 0] = -1
    two = np.minimum(f[0], f[1])
    return cols, 1 + np.stack([two, np.where(cols[2] >= 0, np.minimum(two, f[2]), 0)]) // most


def routed(cols: np.ndarray, spread: np.ndarray, routes: int) -> Iterator[tuple[int, bytes]]:
    """(route, packed suffixes with their counts): equal suffixes of a block count as one, so a hot phrase is a row for each block.

    The leading two words choose the route; where these, or the leading three, are spread, the next word chooses how far from there.
    """
    if not cols.shape[1]:
        return
    far = lambda k: (mixed(cols[k]) >> np.uint64(20)) % spread[k - 2].astype(np.uint64)
    route = ((mixed(cols[0], cols[1]) >> np.uint64(20)) + far(2) + far(3)) % np.uint64(routes)
    lead = 2 + (spread[0] > 1) + (spread[1] > 1)
    order = np.lexsort((mixed(*cols), route))
    cols, lead, route = cols[:, order], lead[order], route[order]
    first = np.flatnonzero(np.r_[True, (cols[:, 1:] != cols[:, :-1]).any(axis=0)])
    weight = np.diff(np.r_[first, len(order)])
    cols, lead, route = cols[:, first], lead[first], route[first]
    ends = np.flatnonzero(np.r_[route[1:] != route[:-1], True]) + 1
    for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True):
        yield int(route[a]), packed(*cols[:, a:b], weight[a:b], lead[a:b])


def quicksorted(cols: np.ndarray, weight: np.ndarray, lead: np.ndarray, least: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For phrases of 2, 3 and 4 words: (rows of word ids, counts), by multikey three-way quicksort of the suffix pointers.

    All open partitions are split at once: pointers of a partition of depth d go before, to or behind its pivot's word at
    place d. The equal part has one word more in common, and its weight is that phrase's count; it goes on at the next place. A
    partition under least is abandoned, unless other routes have a share of its phrase (lead says so): such phrases
    come with the count of this route, whatever it is.
    """
    order = np.arange(cols.shape[1])
    # Leading pairs whose hash has too little weight are abandoned before they are sorted.
    slot = (mixed(cols[0], cols[1]) >> np.uint64(24)) & np.uint64((1 << max(10, 2 + int(len(order)).bit_length())) - 1)
    heavy = np.bincount(slot.astype(np.int64), weight)[slot.astype(np.int64)] >= least
    order = order[heavy | (lead > 2)]
    length, depth = np.array([len(order)]), np.array([0])
    found: list[list] = [[], [], []]
    while len(order):
        start = np.cumsum(length) - length
        level = np.repeat(depth, length)
        value = cols[level, order]
        a, b, c = value[start], value[start + length // 2], value[start + length - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))
        part = np.repeat(np.arange(len(length)), length)
        side = np.where(value < pivot[part], 0, np.where(value == pivot[part], 1, 2))
        sizes = np.bincount(part * 3 + side, minlength=3 * len(length))
        begin = np.cumsum(sizes) - sizes
        place = np.empty(len(order), np.int64)
        for s in range(3):
            there = np.flatnonzero(side == s)
            own = sizes[s::3]
            place[there] = np.arange(len(there)) + np.repeat(begin[s::3] - (np.cumsum(own) - own), own)
        moved = np.empty_like(order)
        moved[place] = order
        order = moved
        full = sizes > 0
        equal = np.tile([False, True, False], len(length))[full]
        depth = np.repeat(depth, 3)[full] + equal
        pivot, length = np.repeat(pivot, 3)[full], sizes[full]
        start = np.cumsum(length) - length
        total, most = np.add.reduceat(weight[order], start), np.maximum.reduceat(lead[order], start)
        # A phrase of k words is shared among routes where suffixes of it are routed by more than k words.
        go = (total >= least) | (most > np.maximum(depth, 2))
        for k in (2, 3, 4):
            hit = equal & (depth == k) & go & (pivot >= 0)
            found[k - 2].append((cols[:k, order[start[hit]]], total[hit]))
        go &= (depth < DEPTH) & ~(equal & (pivot < 0))
        order, length, depth = order[np.repeat(go, length)], length[go], depth[go]
    return [(np.concatenate([x for x, _ in f], axis=1) if f else np.zeros((k, 0), np.int64), np.concatenate([n for _, n in f]) if f else np.zeros(0, np.int64)) for k, f in zip((2, 3, 4), found, strict=True)]


def phrase_counts(docs: DataFrame, least: int, block_bytes: int, route_pointers: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals): (id, lang, word, f) of frequent words, (ids, f) of frequent sequences of one to four, (lang, n)."""
    blocks = kept_table(blocks_of(docs, block_bytes))
    totals = kept_table(blocks.groupBy("lang").agg(F.sum("total").alias("n")))
    own = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).where("w.counts > 0")
    counted = own.groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.counts").alias("f")).where(F.col("f") >= least)
    words = kept_table(counted.withColumn("id", F.monotonically_increasing_id()))
    n = totals.agg(F.sum("n")).first()[0] or 0
    routes = max(16, n // route_pointers)
    listed = own.select("block", "lang", "code", F.col("w.words").alias("word")).join(words, ["lang", "word"])
    listed = listed.groupBy("block").agg(F.collect_list(F.struct("code", "id", "f")).alias("known"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, known in zip(batch.column(0), batch.column(1), strict=True):
                code = unpacked(codes.as_py(), 1)[0]
                place, word, f = (known.values.field(k).to_numpy() for k in range(3))
                ids, total = np.full(int(max(code.max(initial=0), place.max())) + 2, -1), np.zeros(int(max(code.max(initial=0), place.max())) + 2, np.int64)
                ids[place], total[place] = word, f  # the last line stands for the end of a piece
                rows = list(routed(*suffixes(ids[code], total[code], max(1, route_pointers // 2)), routes)) if len(code) else []
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array([d for _, d in rows], pa.binary())], names=["route", "data"])

    def mine(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([unpacked(x.as_py(), DEPTH + 2) for batch in batches for x in batch.column("data")], axis=1)
        for cols, n in quicksorted(table[:DEPTH], table[DEPTH], table[DEPTH + 1], least):
            yield pa.RecordBatch.from_arrays([pa.array(list(np.ascontiguousarray(cols.T)), pa.list_(pa.int64())), pa.array(n.astype(np.int64))], names=["ids", "n"])

    sent = blocks.select("block", "codes").join(listed, "block").select("codes", "known").mapInArrow(send, "route long, data binary")
    found = sent.groupBy("route").applyInArrow(mine, "ids array<long>, n long")
    phrases = found.groupBy("ids").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return words, kept_table(phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))), totals


def pieces_of(phrase: str, size: int) -> Column:
    """Runs of words inside an array of size words, from two words on, itself excluded."""
    return F.array(*[F.slice(phrase, i + 1, k) for k in range(2, size) for i in range(size - k + 1)])


def wide(name: str) -> Column:
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, covered_percent: int = 80, block_bytes: int = BLOCK_BYTES, route_pointers: int = ROUTE_POINTERS) -> DataFrame:
    """The first phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts are folded (A-Z) and split into pieces at punctuation and line ends, and these into words at blanks. Candidates
    are sequences of two to four words of a piece that occur least times (a). Of its cuts into two parts, which occur l
    and r times, the one with the lowest floor(2,000,000 * a / (l + r)) gives the score, at ties the one after fewer words. A
    candidate inside a longer one that occurs covered_percent of its times goes. n: words of the language. Ranks go by
    score, a (both falling) and phrase, in the order of UTF-8 bytes.

    Texts are coded in blocks of about block_bytes, which bound a task's memory (a piece is never cut). A word that occurs
    under least times ends all suffixes, as no frequent phrase holds it. The suffixes of a block are counted,
    and routed over all blocks by their leading two words; a route is quicksorted to a depth of four words, and its partitions
    under least are abandoned (quicksorted). Leading words that may be too many for one route are dealt by their next
    words over as many routes as they may fill, and their counts are added up afterwards; no suffix is left out. Counts are exact: words are told apart by id,
    not by hash; products are decimals.

    NULL texts are empty; a NULL lang is `und`. Repeated rows count as often as they stand. Empty tables, and languages
    without a candidate, give no rows; other columns are ignored.
    """
    words, phrases, totals = phrase_counts(docs, least, block_bytes, route_pointers)
    size = F.size("ids")
    longer = phrases.where(size > 2).select("f", F.explode(F.when(size == 3, pieces_of("ids", 3)).otherwise(pieces_of("ids", 4))).alias("ids"))
    cover = longer.groupBy("ids").agg(F.max("f").alias("most"))
    open_ = phrases.where(size > 1).join(cover, "ids", "left").where(F.col("most").isNull() | (100 * wide("most") < covered_percent * wide("f")))
    open_ = kept_table(open_.select("ids", F.col("f").alias("a")))
    cut = open_.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = cut.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("tail"))
    parts = cut.join(phrases.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head").join(phrases.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    scored = parts.withColumn("a20", wide("a")).withColumn("lr", wide("l") + wide("r")).withColumn("score", F.expr("(a20 * 2000000) div lr"))
    lowest = scored.groupBy("ids").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("s"))
    spelt = lowest.select("ids", "s", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("ids", "s", "lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = spelt.select("lang", "phrase", "s.a", "s.l", "s.r", "s.score")
    return best_of_each(ranked, top).join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def best_of_each(ranked: DataFrame, top: int) -> DataFrame:
    """The first rows of each language with their rank; each task passes on its own first rows only."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
