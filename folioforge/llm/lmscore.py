"""Language-model scoring: a causal self-attention model in numpy over subword ids, beside an add-one word model."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table

#: Where the tokenizer's ranks are; the session's spark.folioforge.tokenizer names another place.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How the tokenizer's vocabulary splits text before merging (fixed value, goes with the file).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: PATTERN for text whose white space is single line feeds, most of them before a space and a word. It splits such text alike, and as nothing in it
#: looks ahead or holds on to what it matched, it needs no backtracking.
LINE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""
NOWHERE = "\t\t"  # the one special token of an encoder that must have one; no such text holds a tab
_ODD_SPACE = re.compile(r"[^\S\n]")
SPAN = 8  # tokens a window moves by; each token sees the rest of its span and the whole span before
WIDTH = 8  # of queries, keys and values
TOPICS = 32  # distributions over all ids that a context mixes
LEAST_BLOCK, MOST_BLOCK = 16 << 20, 32 << 20
SUBS, CHUNK = 1 << 17, 1024
RATE, FLOOR = 0.2, np.float32(1e-4)
#: Parameters stay within these, which keeps every exponential inside float32.
LIMITS = {"q": 3.0, "k": 3.0, "v": 3.0, "a": 12.0, "w": 1.5, "r": 3.0}
SHARES = 64  # groups that average a round's models


@dataclass
class Tokens:
    """A tokenizer file's ranks as an encoder; the id after the last one ends a text."""

    ranks: dict[bytes, int]

    def __post_init__(self) -> None:
        self.end = max(self.ranks.values()) + 1
        self.by_line = tiktoken.Encoding("lines", pat_str=LINE_PATTERN, mergeable_ranks=self.ranks, special_tokens={NOWHERE: self.end})
        self.line = self.by_line.encode_ordinary("\n")

    @cached_property
    def encoder(self) -> tiktoken.Encoding:
        """For any text; few blocks need it."""
        return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, each after a space, end to end, and how many each has.

        They go through in one call, one a line; words that hold white space other than ASCII, which may join lines, go alone.
        """
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        text = b"\n".join(words).decode("utf-8", "replace")
        alone = {}
        if _ODD_SPACE.search(text):
            lines = text.split("\n")
            alone = {i: np.array(self.encoder.encode_ordinary(f" {w}"), np.int64) for i, w in enumerate(lines) if _ODD_SPACE.search(w)}
            text = "\n".join(["x" if i in alone else w for i, w in enumerate(lines)])
        ids = self.by_line.encode_to_numpy(" " + text.replace("\n", "\n ") + "\n", disallowed_special=()).astype(np.int64)
        ends = np.flatnonzero(ids == self.line[0])
        if len(self.line) != 1 or len(ends) != len(words):
            raise ValueError("the tokenizer joins lines")
        sizes = np.diff(np.concatenate([[-1], ends])) - 1
        if alone:
            stops = np.cumsum(sizes + 1)
            parts, at = [], 0
            for i, own in alone.items():
                parts += [ids[at : stops[i] - sizes[i] - 1], own, ids[stops[i] - 1 : stops[i]]]
                at, sizes[i] = stops[i], len(own)
            ids = np.concatenate([*parts, ids[at:]])
        return ids[ids != self.line[0]], sizes


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# Key j of a window lies SPAN - j + i positions before query i; what is not in the past is masked.
_BACK = SPAN + np.arange(SPAN)[:, None] - np.arange(2 * SPAN)[None, :]
_MASK = np.where(_BACK >= 0, 0, -1e9).astype(np.float32)
_BACK = np.clip(_BACK, 0, 2 * SPAN - 1)


@dataclass
class Model:
    """Attention over id embeddings whose output mixes TOPICS distributions over ids.

    Rows of q, k, v, a and s belong to the ids that occur in training texts, in the order of `ids`, and a last one to
    all others. P(next = y | context) = sum over topics t of softmax(a[last id] + attended @ w)[t] * B[y, t], with
    B[y, t] = (s[y, t] + FLOOR * u[y]) / (sum of s[:, t] + FLOOR): the sum over every id of the tokenizer is 1. u has the
    add-one shares; the row of the others has the share of one of them. g has Adagrad's mean squares.
    """

    ids: np.ndarray
    u: np.ndarray
    p: dict[str, np.ndarray]
    s: np.ndarray
    steps: int = 0
    g: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def start(cls, ids: np.ndarray, counts: np.ndarray, n_ids: int) -> Model:
        """The model before training, for the training counts of the ids that occur, of n_ids in all."""
        n, rng = len(ids) + 1, np.random.default_rng(11)
        draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(np.float32)
        u = ((np.append(counts, 0) + 1.0) / (counts.sum() + n_ids)).astype(np.float32)
        p = {"q": draw(0.3, n, WIDTH), "k": draw(0.3, n, WIDTH), "v": draw(0.3, n, WIDTH), "a": draw(0.3, n, TOPICS), "w": draw(0.1, WIDTH, TOPICS), "r": np.zeros(2 * SPAN, np.float32)}
        s = (u[:, None] * rng.gamma(2, 0.5, (n, TOPICS))).astype(np.float32)
        s[-1] = 0  # what training did not see is only in the floor
        return cls(ids, u, p, s / max(s.sum(), np.float32(1e-30)), 0, {k: np.full(n if k in "qkva" else 1, 1e-8, np.float32) for k in p})

    def rows_of(self, ids: np.ndarray) -> np.ndarray:
        """Rows of tokenizer ids."""
        at = np.searchsorted(self.ids, ids)
        at[at == len(self.ids)] = 0
        return np.where(self.ids[at] == ids, at, len(self.ids)).astype(np.int32) if len(self.ids) else np.zeros(len(ids), np.int32)

    def packed(self) -> np.ndarray:
        """All that training changes, as one matrix: a line for each row, and lines for what rows share."""
        lines = np.concatenate([*(self.p[k] for k in "qkva"), self.s, *(self.g[k][:, None] for k in "qkva")], axis=1)
        shared = np.concatenate([self.p["w"].ravel(), self.p["r"], self.g["w"], self.g["r"]])
        shared = np.append(shared, np.zeros(-len(shared) % lines.shape[1], np.float32))
        return np.concatenate([lines, shared.reshape(-1, lines.shape[1])]).astype(np.float32)

    def unpacked(self, matrix: np.ndarray, steps: int) -> Model:
        n, ends = len(self.u), np.cumsum([WIDTH, WIDTH, WIDTH, TOPICS, TOPICS])
        parts = np.split(matrix[:n], ends, axis=1)
        shared = matrix[n:].ravel()
        w, r, gw, gr = np.split(shared[: WIDTH * TOPICS + 2 * SPAN + 2], np.cumsum([WIDTH * TOPICS, 2 * SPAN, 1]))
        p = {k: x.copy() for k, x in zip("qkva", parts, strict=False)} | {"w": w.reshape(WIDTH, TOPICS).copy(), "r": r.copy()}
        g = {k: parts[5][:, i].copy() for i, k in enumerate("qkva")} | {"w": gw.copy(), "r": gr.copy()}
        return Model(self.ids, self.u, p, parts[4].copy(), steps, g)

    def attend(self, x: np.ndarray, begins: np.ndarray):
        """Batched masked attention over spans x[1:], x[0] being the span before: exponentials of the mixture's logits, and what the gradient needs."""
        n, ids = len(x) - 1, x.ravel()
        now = ids[SPAN:]
        q = self.p["q"].take(now, axis=0).reshape(n, SPAN, WIDTH)
        q *= q.dtype.type(WIDTH**-0.5)
        k, v = self.p["k"].take(ids, axis=0), self.p["v"].take(ids, axis=0)
        # Windows of two spans overlap, so they are views.
        shape, (far, near) = (n, 2 * SPAN, WIDTH), k.strides
        k, v = (np.ndarray(shape, m.dtype, m, strides=(SPAN * far, far, near)) for m in (k, v))
        e = q @ k.transpose(0, 2, 1)
        e += self.p["r"][_BACK] + _MASK
        e[begins, :, :SPAN] = -1e9
        np.exp(e, out=e)
        inverse = 1 / (e.reshape(-1, 2 * SPAN) @ np.ones(2 * SPAN, e.dtype)).reshape(n, SPAN, 1)
        o = e @ v
        o *= inverse
        z = o.reshape(-1, WIDTH) @ self.p["w"]
        z += self.p["a"].take(now, axis=0)
        np.exp(z, out=z)
        return z, (q, k, v, e, inverse, o)

    def emitted(self, y: np.ndarray) -> np.ndarray:
        """B[y] for rows y; -1 is the last row."""
        if len(y) > len(self.u):  # the smaller of both is worked out
            b = self.s + (FLOOR * self.u)[:, None]
            b /= self.s.sum(axis=0) + FLOOR
            return b.take(y, axis=0)
        b = self.s.take(y, axis=0)
        b += (FLOOR * self.u).take(y)[:, None]
        b /= self.s.sum(axis=0) + FLOOR
        return b

    def gradient(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray) -> tuple[dict[str, tuple[np.ndarray | None, np.ndarray]], np.ndarray, np.ndarray]:
        """Gradients of the mean loss over the real targets, name -> (rows or None for all, values), and the rows and
        summed responsibilities of the targets by topic. Keys and values of the span before x[1:] are read and move as well."""
        z, (q, k, v, e, inverse, o) = self.attend(x, begins)
        y = y.ravel()
        real = y >= 0
        places = np.flatnonzero(real)
        weight = real * z.dtype.type(1 / max(1, len(places)))
        ones = np.ones(TOPICS, z.dtype)
        share = self.emitted(y)
        share *= z
        share *= (weight / (share @ ones))[:, None]
        z *= (weight / (z @ ones))[:, None]
        z -= share
        n = len(x) - 1
        g = {"w": (None, (z.T @ o.reshape(-1, WIDTH)).T)}
        order, first, of = runs(y.take(places))
        targets = of, run_sums(share, places.take(order), first)
        d_o = (z @ self.p["w"].T).reshape(n, SPAN, WIDTH)
        e *= inverse
        d_v = e.transpose(0, 2, 1) @ d_o
        d_s = d_o @ v.transpose(0, 2, 1)
        o *= d_o
        d_s -= (o.reshape(-1, WIDTH) @ np.ones(WIDTH, z.dtype)).reshape(n, SPAN, 1)
        d_s *= e
        g["r"] = (None, np.bincount(_BACK.ravel(), d_s.sum(axis=0).ravel(), 2 * SPAN).astype(z.dtype))
        d_k = d_s.transpose(0, 2, 1) @ q
        d_q = d_s @ k
        d_q *= z.dtype.type(WIDTH**-0.5)
        # A span is read by its own window and by the next one; the first one here by the next one only. Each part is summed where it stands.
        ids = x.ravel()
        order, first, rows = runs(ids)
        order += SPAN * np.maximum(order // SPAN - 1, 0)
        for name, d in (("k", d_k), ("v", d_v)):
            d[:-1, SPAN:] += d[1:, :SPAN]
            g[name] = rows, run_sums(d.reshape(-1, WIDTH), order, first)
        order, first, rows = runs(ids[SPAN:])
        g["q"], g["a"] = (rows, run_sums(d_q.reshape(-1, WIDTH), order, first)), (rows, run_sums(z, order, first))
        return g, *targets

    def learn(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray) -> None:
        """One step: Adagrad on the attention, stepwise expectation maximisation on the topics' distributions."""
        g, rows, summed = self.gradient(x, begins, y)
        eta = np.float32(max(0.004, 1 / (1 + 0.1 * self.steps)))
        self.s *= 1 - eta
        self.s[rows] += eta * summed
        self.steps += 1
        for name, (at, d) in g.items():
            p, past = self.p[name], self.g[name]
            square = np.einsum("ij,ij->i", d, d) / d.shape[1] if at is not None else np.vdot(d, d).reshape(1) / d.size
            here = slice(None) if at is None else at
            square += past if at is None else past.take(at)
            past[here] = square
            pace = np.float32(RATE) / np.sqrt(square)
            d *= pace[:, None] if at is not None else pace
            np.subtract(p if at is None else p.take(at, axis=0), d, out=d)
            p[here] = np.clip(d, -LIMITS[name], LIMITS[name], out=d)

    def train(self, stream: np.ndarray, lengths: np.ndarray) -> None:
        """One pass over texts (rows, laid end to end), chunk by chunk in a fixed mixed order; the very first chunks are small."""
        x, begins, y, _ = windows(stream, lengths, len(self.ids) and self.end_row)
        size = CHUNK if self.steps >= 64 else 64
        for at in np.random.default_rng(5).permutation(np.arange(0, len(x), size)):
            self.learn(chunk(x, at, size), begins[at : at + size], y[at : at + size])

    @property
    def end_row(self) -> int:
        """Row of what precedes a text: the end, which is the largest id of any text."""
        return len(self.ids) - 1

    def token_scores(self, stream: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Natural-log probability of each token (a row), in order."""
        x, begins, y, place = windows(stream, lengths, max(0, self.end_row))
        out, ones = np.empty(x.size, np.float32), np.ones(TOPICS, np.float32)
        emitted = self.emitted(np.arange(len(self.u)))  # a target of -1 gets the last row, and is not kept
        for at in range(0, len(x), CHUNK):
            z, _ = self.attend(chunk(x, at), begins[at : at + CHUNK])
            b = emitted.take(y[at : at + CHUNK].ravel(), axis=0)
            b *= z
            out[at * SPAN : at * SPAN + len(b)] = np.log(b @ ones) - np.log(z @ ones)
        return out[place]


def runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of rows in ascending order, where each distinct one begins among them, and the distinct ones."""
    order = np.argsort(rows.astype(np.uint16) if rows.max(initial=0) < 2**16 else rows, kind="stable")
    rows = rows.take(order)
    first = np.flatnonzero(np.concatenate([[True][: len(rows)], rows[1:] != rows[:-1]]))
    return order, first, rows.take(first)


def run_sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values at these places by run. Two columns at a time go as the parts of one complex number, which halves the calls."""
    values = values.take(order, axis=0)
    if not len(first) or values.shape[1] % 2:
        return np.add.reduceat(values, first, axis=0) if len(first) else values
    return np.add.reduceat(values.view(f"c{2 * values.itemsize}"), first, axis=0).view(values.dtype)


def summed_by(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their values."""
    order, first, rows = runs(rows)
    return rows, run_sums(values, order, first)


def windows(stream: np.ndarray, lengths: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts laid end to end -> spans of inputs, which spans begin a text, targets (-1: none), and where each token went.

    The input at a token is the token before it (`before` at a text's start), so each token is predicted once, from up
    to 2 * SPAN tokens of its own text.
    """
    spans = -(-lengths // SPAN)
    first = np.cumsum(spans) - spans
    offset = np.cumsum(lengths) - lengths
    place = np.arange(len(stream)) + np.repeat(first * SPAN - offset, lengths)
    targets = np.full(int(spans.sum()) * SPAN, -1, np.int32)
    targets[place] = stream
    inputs = np.full_like(targets, before)
    last = np.empty_like(stream)
    last[1:] = stream[:-1]
    last[offset[lengths > 0]] = before
    inputs[place] = last
    begins = np.zeros(len(inputs) // SPAN, bool)
    begins[first[lengths > 0]] = True
    return inputs.reshape(-1, SPAN), begins, targets.reshape(-1, SPAN), place


def chunk(x: np.ndarray, at: int, size: int = CHUNK) -> np.ndarray:
    """Some spans from at on, after the span before them (for the first, any: a text begins there)."""
    return x[at - 1 : at + size] if at else np.concatenate([x[:1], x[:size]])


@dataclass
class Words:
    """The ragged subword rows of a block's words and, last, of the end of a text."""

    starts: np.ndarray
    sizes: np.ndarray
    subs: np.ndarray

    @classmethod
    def of(cls, starts: np.ndarray, subs: np.ndarray, end: int) -> Words:
        starts, subs = np.append(starts, starts[-1] + 1), np.append(subs, end).astype(np.int32)
        return cls(starts.astype(np.int32), np.diff(starts).astype(np.int32), subs)

    def laid_out(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts (word ids) end to end, each with its end: word ids and their number by text, subword rows and their number by text."""
        end = np.array([len(self.sizes) - 1], np.int32)
        words = np.concatenate([x for t in texts for x in (t, end)])
        n_words = np.array([len(t) + 1 for t in texts], np.int64)
        n = self.sizes.take(words)
        stop = np.cumsum(n, dtype=np.int32)
        at = np.repeat(self.starts.take(words) - (stop - n), n)
        at += np.arange(len(at), dtype=np.int32)
        ends = stop[np.cumsum(n_words) - 1]
        return words, n_words, self.subs.take(at), np.diff(ends, prepend=0).astype(np.int64)


ENCODED = "block long, kind int, doc_id long, held_out boolean, id int, words binary, n long, data binary"
#: Text whose words one group counts.
PART_BYTES = 64 << 20
SLICE = 250  # documents that stand as words at a time
#: Spark's setting of rows in a batch that goes to Python.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts are long, and 10,000 of them in a batch stand several times on either side."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, 1000)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


@dataclass
class Block:
    """One block's texts, taken in some at a time, so that only few stand as objects; what stays is their words, end to end."""

    number: int
    docs: list[tuple[int | None, bool]] = field(default_factory=list)
    lengths: list[int] = field(default_factory=list)
    words: list[pa.Array] = field(default_factory=list)
    bulk: int = 0

    def add(self, docs: pa.RecordBatch) -> None:
        """Take in rows of (id, held out, text)."""
        text = pc.fill_null(docs.column(2), "")
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(text)))
        words = split.flatten()
        lengths = pc.list_value_length(split).to_numpy()
        if pc.any(pc.equal(words, "")).as_py():  # a text without words is split into one empty word
            lengths = lengths - pc.equal(pc.ascii_trim_whitespace(text), "").to_numpy(zero_copy_only=False)
            words = words.filter(pc.not_equal(words, ""))
        self.words.append(words.cast(pa.binary()))
        self.lengths += lengths.tolist()
        self.docs += zip(docs.column(0).to_pylist(), docs.column(1).to_pylist(), strict=True)
        self.bulk += pc.sum(pc.utf8_length(text)).as_py() or 0

    def encoded(self, tokens: Tokens, n_parts: int) -> Iterator[pa.RecordBatch]:
        """What the block adds: its texts as local word ids (kind 0), its words with their local ids and training counts, packed
        by the part that counts them (1), their subwords (2) and the subword counts of its training texts (3)."""
        found = pa.chunked_array(self.words, pa.binary()).dictionary_encode()  # its chunks share one dictionary
        self.words.clear()
        ids = np.concatenate([c.indices.to_numpy() for c in found.chunks]).astype(np.int32, copy=False)
        all_coded, words = np.split(ids, np.cumsum(self.lengths)[:-1]), found.chunk(0).dictionary.to_numpy(zero_copy_only=False).tolist()
        del found, ids
        told = [tokens.words(words[at : at + 50_000]) for at in range(0, len(words) + 1, 50_000)]
        subs, sizes = (np.concatenate(x).astype(np.int32) for x in zip(*told, strict=True))
        del told
        trained, n_train = np.zeros(len(words), np.int64), 0
        schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("id", pa.int32()), ("words", pa.binary()), ("n", pa.int64()), ("data", pa.binary())])

        def rows(size: int, sort: int, **columns) -> pa.RecordBatch:
            given = {"block": pa.array(np.full(size, self.number, np.int64)), "kind": pa.array(np.full(size, sort, np.int32)), **columns}
            return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

        for at in range(0, len(self.docs), 2000):
            part, coded = self.docs[at : at + 2000], all_coded[at : at + 2000]
            learnt = [c for c, d in zip(coded, part, strict=True) if not d[1]]
            n_train += len(learnt)
            if learnt:
                trained += np.bincount(np.concatenate(learnt), minlength=len(words))
            data = pa.array([c.tobytes() for c in coded], pa.binary())
            yield rows(len(part), 0, id=pa.array(np.arange(at, at + len(part), dtype=np.int32)), doc_id=pa.array([d[0] for d in part], pa.int64()), held_out=pa.array([d[1] for d in part]), data=data)
        part_of = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(n_parts)
        order = np.argsort(part_of, kind="stable")
        used, first = np.unique(part_of[order], return_index=True)
        for part, at in zip(used.tolist(), np.split(order, first[1:]), strict=True):
            packed = np.concatenate([at, trained[at]]).astype(np.int64).tobytes()
            yield rows(1, 1, id=pa.array([part], pa.int32()), words=pa.array([b"\n".join([words[i] for i in at.tolist()])], pa.binary()), data=pa.array([packed], pa.binary()))
        yield rows(1, 2, data=pa.array([np.concatenate([np.array([len(words)], np.int32), sizes, subs]).tobytes()], pa.binary()))
        counts = np.bincount(subs, np.repeat(trained, sizes), tokens.end + 1).astype(np.int64)
        counts[tokens.end] += n_train
        some = np.flatnonzero(counts)
        yield rows(len(some), 3, id=pa.array(some.astype(np.int32)), n=pa.array(counts[some]))
        pa.default_memory_pool().release_unused()  # the worker lives on, beside the next task's


COUNTED = "block long, data binary, total long, distinct long"


def count_words(part: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts over all blocks of one part's words: for each block (local ids, counts), and, on the first row, the part's
    training words and how many distinct ones."""
    blocks, ids, own, words = [], [], [], []
    for batch in batches:
        for block, text, data in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "data")), strict=True):
            at, n = np.frombuffer(data, np.int64).reshape(2, -1)
            blocks.append(block)
            ids.append(at)
            own.append(n)
            words.append(pa.array(text.split(b"\n"), pa.binary()))
    told = np.concatenate([c.indices.to_numpy() for c in pa.chunked_array(words).dictionary_encode().chunks])
    counts = np.bincount(told, np.concatenate(own)).astype(np.int64)
    each = np.split(counts[told], np.cumsum([len(x) for x in ids])[:-1])
    packed = [np.concatenate([at, c]).tobytes() for at, c in zip(ids, each, strict=True)]
    first = np.arange(len(blocks)) == 0
    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(packed, pa.binary()), pa.array(first * counts.sum()), pa.array(first * (counts > 0).sum())], names=["block", "data", "total", "distinct"])


def decoded(kinds: np.ndarray, data: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The ragged subword ids of a block's words, from its row of kind 2."""
    ragged = np.frombuffer(data[int(np.flatnonzero(kinds == 2)[0])].as_py(), np.int32)
    n = int(ragged[0])
    return np.concatenate([[0], np.cumsum(ragged[1 : n + 1])]), ragged[n + 1 :]


def grouped(data: pa.ChunkedArray, order: np.ndarray) -> Iterator[list[np.ndarray]]:
    """Texts at these places as word ids, some at a time, so that what is laid out stays bounded (a longer text comes alone)."""
    group, size = [], 0
    for i in order.tolist():
        group.append(np.frombuffer(data[i].as_py(), np.int32))
        size += len(group[-1])
        if size > SUBS:
            yield group
            group, size = [], 0
    if group:
        yield group


def trained_model(coded: DataFrame, end: int) -> Model:
    """The model after one pass over the training texts of all blocks.

    Rounds take about 1, 2, 4, ... blocks, in a hashed order. Each block of a round goes on from the model so far, step by step over its own
    texts; the round's models are averaged by their tokens, row by row, into the next one. A round's matrices are summed
    in SHARES streams; the driver gets one matrix a round: a line for each id of the tokenizer that occurs.
    """
    spark = coded.sparkSession
    counted = coded.where("kind = 3").groupBy("id").agg(F.sum("n").alias("n")).orderBy("id").collect()
    model = Model.start(np.array([r["id"] for r in counted], np.int64), np.array([r["n"] for r in counted], np.int64), end + 1)
    if not counted:
        return model
    n_blocks, lines, span = coded.where("kind = 2").count(), len(model.packed()), 1 << 20
    place = F.pmod(F.xxhash64("block"), F.lit(span))
    first = 0
    while first < span:
        last = min(span, first + first + max(1, span // n_blocks))
        shared = spark.sparkContext.broadcast(model)

        def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches))
            kinds = table.column("kind").to_numpy()
            starts, subs = decoded(kinds, table.column("data"))
            old = shared.value
            own = old.unpacked(old.packed(), old.steps)
            words, seen = Words.of(starts, own.rows_of(subs), own.end_row), 0
            texts = np.flatnonzero(kinds == 0)
            texts = texts[np.argsort(table.column("nth").take(pa.array(texts)).to_numpy(), kind="stable")]
            for group in grouped(table.column("data"), texts):
                _, _, stream, lengths = words.laid_out(group)
                own.train(stream, lengths)
                seen += len(stream)
            if seen:
                matrix = own.packed()
                del table, words
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lines, dtype=np.int32)), pa.array(np.full(lines, seen)), pa.array(np.full(lines, own.steps - old.steps)), pa.array([x.tobytes() for x in matrix], pa.binary())], names=["at", "n", "steps", "x"])

        def average(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = range(key[0].as_py(), lines, SHARES)
            sums, n, steps = None, np.zeros(len(own)), np.zeros(len(own))
            for batch in batches:
                at, weight = batch.column("at").to_numpy() // SHARES, batch.column("n").to_numpy().astype(float)
                x = np.stack([np.frombuffer(b, np.float32) for b in batch.column("x").to_pylist()])
                sums = np.zeros((len(own), x.shape[1])) if sums is None else sums
                np.add.at(sums, at, x * weight[:, None])
                np.add.at(n, at, weight)
                np.add.at(steps, at, weight * batch.column("steps").to_numpy())
            mean = (sums / n[:, None]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(own, np.int32)), pa.array(np.rint(steps / n).astype(np.int64)), pa.array([m.tobytes() for m in mean], pa.binary())], names=["at", "steps", "x"])

        part = coded.where((F.col("kind") == 2) | ((F.col("kind") == 0) & ~F.col("held_out"))).where((place >= first) & (place < last))
        models = part.select("block", "kind", F.col("id").alias("nth"), "data").groupBy("block").applyInArrow(run, "at int, n long, steps long, x binary")
        with small_batches(spark):
            models = kept_table(models)
        got = models.groupBy(F.pmod("at", F.lit(SHARES)).alias("share")).applyInArrow(average, "at int, steps long, x binary").collect()
        shared.unpersist()
        if got:
            matrix = np.stack([np.frombuffer(r["x"], np.float32) for r in sorted(got, key=lambda r: r["at"])])
            model = model.unpacked(matrix, model.steps + got[0]["steps"])
        first = last
    return model


def score(docs: DataFrame, tokenizer: str | None = None, block_bytes: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row for each document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Documents whose crc32 of the id as text leaves 2 modulo 7 are held out; everything is learnt from all others.

    base_score: words (A-Z folded) and one end, each log10((c + 1) / (N + V + 1)) with the training counts of the
    whole corpus. score: log10 probability of the text's subword ids and its end under the attention model (Model): one
    head over embeddings of the subword ids, whose output mixes distributions over all ids. Texts are cut into spans of
    SPAN tokens, each attending to itself and the span before under a causal mask, so contexts overlap and every token
    is scored once. The model is trained once through, over all training texts, in rounds that double (trained_model).

    Documents stay where they are read, in blocks of about block_bytes (by default 16 MB, up to 32 on large tables), so no
    text is shuffled and the work on a block is bounded whatever the input. A block's texts are encoded
    once and written to the shared folder. Words are dealt by a hash to parts of about PART_BYTES of text; a block sends its
    words to each part in one packed row, and gets their counts over the whole corpus back. The driver gets one row for each id of the tokenizer
    that occurs, and one matrix of the model a round. The tokenizer's file is read on the driver and sent with the tasks.

    NULL text is empty (one end token); NULL ids count as the empty id; repeated rows each count; without training
    documents the model stays at its start and all counts are 0; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(tokenizer or spark.conf.get("spark.folioforge.tokenizer", TOKENIZER)))  # of the size of the tokenizer's vocabulary
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = block_bytes or int(min(max(LEAST_BLOCK, total / 4096), MOST_BLOCK))
    n_parts = max(1, -(-total // PART_BYTES))
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, block = Tokens(ranks.value), Block(TaskContext.get().partitionId() << 24)
        for b in batches:
            for at in range(0, len(b), SLICE):
                block.add(b.slice(at, SLICE))
                if block.bulk >= 1.25 * size:
                    yield from block.encoded(tokens, n_parts)
                    block = Block(block.number + 1)
        if block.docs:
            yield from block.encoded(tokens, n_parts)

    parts = docs.select("doc_id", held.alias("held_out"), "text").coalesce(max(1, round(total / size)))
    with small_batches(spark):
        coded = kept_table(parts.mapInArrow(encode, ENCODED))

    # The whole corpus' counts of each word, beside each block that has it.
    packed = coded.where("kind = 1").select("block", F.col("id").alias("part"), "words", "data")
    words = kept_table(packed.groupBy("part").applyInArrow(count_words, COUNTED))
    seen = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    n_train = coded.where("kind = 0 AND NOT held_out").count()
    n_all, n_distinct = int(seen[0]) + n_train, int(seen[1]) + (n_train > 0)

    end = max(ranks.value.values()) + 1
    model = spark.sparkContext.broadcast(trained_model(coded, end))  # of the size of the tokenizer's vocabulary
    texts = coded.where("kind IN (0, 2)").select("block", "kind", "doc_id", "held_out", "data")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        kinds, known = left.column("kind").to_numpy(), model.value
        starts, subs = decoded(kinds, left.column("data"))
        words = Words.of(starts, known.rows_of(subs), int(known.rows_of(np.array([end]))[0]))
        c = np.zeros(len(starts), np.int64)  # the last place is the end's
        for data in right.column("data"):
            at, n = np.frombuffer(data.as_py(), np.int64).reshape(2, -1)
            c[at] = n
        c[-1] = n_train
        cost, seen = np.log10((c + 1) / (n_all + n_distinct + 1)), (c > 0).astype(np.int64)
        rows, texts = left.select(["doc_id", "held_out"]).filter(pa.array(kinds == 0)), np.flatnonzero(kinds == 0)
        n_tokens, n_known, base, scored = [], [], [], []
        for group in grouped(left.column("data"), texts):
            ids, n_words, stream, lengths = words.laid_out(group)
            begin = np.cumsum(n_words) - n_words
            n_tokens.append(n_words)
            n_known.append(np.add.reduceat(seen.take(ids), begin))
            base.append(np.add.reduceat(cost.take(ids), begin))
            logs = known.token_scores(stream, lengths).astype(float)
            scored.append(np.add.reduceat(logs, np.cumsum(lengths) - lengths) / np.log(10))
        m, joined = len(rows), lambda x, kind: pa.array(np.concatenate(x) if x else [], kind)
        return pa.table([rows.column("doc_id"), rows.column("held_out"), joined(n_tokens, pa.int64()), joined(n_known, pa.int64()), pa.array(np.full(m, n_all, np.int64)), joined(base, pa.float64()), joined(scored, pa.float64())], names=[x.split()[0] for x in schema.split(", ")])

    return texts.groupBy("block").cogroup(words.select("block", "data").groupBy("block")).applyInArrow(finish, schema)
