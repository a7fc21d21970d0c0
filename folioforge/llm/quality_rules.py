"""Quality rules: base counts and the divergence of a document's histograms from its language's references."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import SPACE

# Frequent function words of each language, as the bins of its word histogram.
COMMON_WORDS = {
    "en": "the of and to in is that it was for on with as be by at this from or an are not but which have a".split(),
    "fr": "de la le et les des en un une du que dans qui est pour par sur au avec pas ce il ne se plus".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero".split(),
}
SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "punctuation", "symbol", "other")
_PUNCTUATION = b".,;:!?\"'()-"


def _byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte; continuation bytes get the number of classes, so that they can be cut off."""
    table = np.full(256, 6, np.uint8)
    table[ord("a") : ord("z") + 1], table[ord("A") : ord("Z") + 1], table[ord("0") : ord("9") + 1] = 0, 1, 2
    table[list(SPACE.encode())], table[list(_PUNCTUATION)] = 3, 4
    table[[b for b in range(33, 127) if not chr(b).isalnum() and b not in _PUNCTUATION]] = 5
    table[0x80:0xC0] = len(CLASSES)
    return table


_TABLE = _byte_classes()


def divergence(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, in [0, 1]) of two histograms; 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return max(0.0, (half(p) + half(q)) / 2) ** 0.5


def common_forms(words: list[str]) -> list[list[bytes]]:
    """The forms under which each common word is counted: small or capitalised, alone or with a comma or full stop."""
    return [[(form + end).encode() for form in (w, w.capitalize()) for end in ("", ",", ".")] for w in words]


def histograms(raw: bytes, count: dict[bytes, int], n_words: int, forms: list[list[bytes]] | None) -> tuple[np.ndarray, np.ndarray]:
    """Class histogram of the characters, and common-word histogram whose last bin holds all other words."""
    classes = np.bincount(_TABLE[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)[: len(CLASSES)]
    if not forms:
        return classes, np.zeros(0, np.int64)
    get = count.get
    bins = [sum([get(f, 0) for f in fs]) for fs in forms]
    return classes, np.array([*bins, n_words - sum(bins)], np.int64)


def repeated_words(words: list[bytes], ids: dict[bytes, int]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(words) < 3:
        return 0
    seq = np.array(list(map(ids.__getitem__, words)), np.int64)
    key = seq[:-2] * len(ids) + seq[1:-1]
    if len(ids) >= 2_000_000:  # three factors would not fit 63 bits
        key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    key = key * len(ids) + seq[2:]
    order = np.sort(key)
    again = order[1:] == order[:-1]
    if not again.any():
        return 0
    window = np.isin(key, order[1:][again])
    covered = np.zeros(len(seq), bool)
    for k in range(3):
        covered[k : k + len(window)] |= window
    return int(covered.sum())


def measure(text: str | None, forms: list[list[bytes]] | None) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the two histograms of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    count = Counter(words)
    classes, bins = histograms(raw, count, len(words), forms)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    repeat = repeated_words(words, dict(zip(count, range(len(count)), strict=True)))
    return [len(words), len(text) - int(classes[3]), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat], classes, bins


def base_failed(counts: list[int]) -> bool:
    return counts[0] < 50 or 100 * counts[4] > 50 * counts[0]


def references(docs: DataFrame, words: dict[str, list[str]], min_words: int, max_languages: int = 10_000) -> dict[str, tuple[int, np.ndarray, np.ndarray]]:
    """Class and word histograms of each language: the mean shares over all documents of at least min_words words, each
    document counting alike, however long; and the number of these documents.

    Shares are added up in millionths, so the sums do not depend on the order. Each task adds up what it reads;
    (language, bin) sums are what is shuffled and, being bounded by max_languages times the bins, collected. More
    languages are an error.
    """
    longest = max(map(len, words.values()), default=0) + 1
    forms = {k: common_forms(v) for k, v in words.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lang = lang or ""
                raw = (text or "").encode("utf-8", "surrogatepass")
                split = raw.split()
                if len(split) >= min_words:
                    classes, bins = histograms(raw, Counter(split), len(split), forms.get(lang))
                    total = sums.setdefault(lang, np.zeros(1 + len(CLASSES) + longest, np.int64))
                    total[0] += 1
                    for at, part in ((1, classes), (1 + len(CLASSES), bins)):
                        total[at : at + len(part)] += np.rint(part * (1e6 / max(1, part.sum()))).astype(np.int64)
        rows = [(k, i, int(n)) for k, v in sums.items() for i, n in enumerate(v)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "bin", "n"])

    summed = docs.select("text", "lang").mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    most = max_languages * (1 + len(CLASSES) + longest)
    rows = summed.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {max_languages} languages")
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["lang"], np.zeros(1 + len(CLASSES) + longest, np.int64))[r["bin"]] = r["n"]
    words_at = 1 + len(CLASSES)
    return {k: (int(v[0]), v[1:words_at], v[words_at : words_at + len(words[k]) + 1] if k in words else v[:0]) for k, v in out.items()}


def apply_rules(
    docs: DataFrame,
    words: dict[str, list[str]] = COMMON_WORDS,
    max_class_distance: float = 0.3,
    max_word_distance: float = 0.33,
    min_words: int = 80,
    min_reference_docs: int = 20,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row for each document: (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept).

    Two passes over whole texts. The first takes the mean character classes and common words of each language over all
    documents of min_words words; the second measures each document's Jensen-Shannon distance from the
    references of its language. A document is rejected by the base rules, or if it has min_words words and one
    distance is above its limit. A language without a list of common words is judged by its classes alone, and one of
    fewer than min_reference_docs reference documents by the base rules alone.

    NULL text is empty (it fails the base rules); NULL language is one of its own; repeated rows are measured alike;
    an empty table gives no rows; other columns are ignored.
    """
    known, forms = references(docs, words, min_words), {k: common_forms(v) for k, v in words.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, failed, apart, kept = [], [], [], []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lang = lang or ""
                counts, classes, bins = measure(text, forms.get(lang))
                n_docs, ref_classes, ref_words = known.get(lang, (0, np.zeros(0), np.zeros(0)))
                enough = n_docs >= min_reference_docs
                by_class = divergence(classes, ref_classes) if enough else 0.0
                by_word = divergence(bins, ref_words) if enough and len(bins) else 0.0
                rows.append(counts)
                failed.append(base_failed(counts))
                apart.append((by_class, by_word))
                kept.append(not failed[-1] and not (counts[0] >= min_words and (by_class > max_class_distance or by_word > max_word_distance)))
            table = np.array(rows, np.int64).reshape(-1, 5)
            apart = np.array(apart, float).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(table[:, i]) for i in range(5)], pa.array(failed, pa.bool_()), pa.array(apart[:, 0]), pa.array(apart[:, 1]), pa.array(kept, pa.bool_())], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept"])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, class_distance double, word_distance double, kept boolean"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "text", "lang").mapInArrow(run, schema)
