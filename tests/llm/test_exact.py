"""Whitening, exact duplicates and collocations against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import collocations, exactdedup, whitening

DOCS = "doc_id long, text string, lang string, id string, row string, hash long, n long, block string"


def docs(spark, rows):
    """Documents (id, text, lang) with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "i", "r", 1, 2, "b") for r in rows], DOCS)


def stripped(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_duplicates(rows):
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[stripped(text)].append((-len(text or ""), i is None, i or 0, i))
    best = {t: min(g)[3] for t, g in groups.items()}
    return Counter((i, best[stripped(t)], len(groups[stripped(t)]), hashlib.sha256(stripped(t).encode()).hexdigest()) for i, t, _ in rows)


@pytest.mark.parametrize("bits", [exactdedup.first_bits, lambda sha: F.unhex(F.substring(sha, 1, 1))])
def test_exact_duplicates(spark, bits):
    """By a whole hash, and by one of 4 bits, where nearly all groups hold several texts."""
    rng = random.Random(1)
    texts = [None, "", " \n", "a b", "ab", " a\tb ", "é x", "éx", "é  x", "long " * 30_000] + [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(200)]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(None, "a b", "en"), (None, "only", None), (3, "a  b", "en"), (7, "twice", "en"), (7, "twice", "en")]
    out = exactdedup.exact_duplicates(docs(spark, rows), bits=bits).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == brute_duplicates(rows)
    kept = Counter(r["text_sha256"] for r in out if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({stripped(t) for _, t, _ in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])
    first = exactdedup.exact_duplicates(docs(spark, rows[:10]), longest=False, bits=bits).collect()
    assert {r["doc_id"]: r["keep_id"] for r in first} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, 8: 6, 9: 9}
    assert exactdedup.exact_duplicates(docs(spark, []), bits=bits).count() == 0


def brute_collocations(rows, least, top=2000):
    count, words = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(w)
            for k in range(1, 5):
                count[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        long = {p: n for p, n in f.items() if n >= least and len(p) > 1}
        ranked = []
        for p, a in long.items():
            if any(len(q) > len(p) and 100 * n >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, n in long.items()):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, words[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return out


@pytest.mark.parametrize(("least", "block_bytes", "route_pointers"), [(3, 200, 1 << 20), (4, 5000, 64), (5, 1 << 20, 8)])
def test_collocations(spark, least, block_bytes, route_pointers):
    """Few words, so that phrases repeat; the last two make nearly all leading words hot, and so routed by three and four words."""
    rng = random.Random(least)
    rows = [(0, None, None), (1, "", "en"), (2, " .,;\n", "en"), (3, "Über ÜBER Zulu zulu ZULU. " * 9, None), (4, "a a a a a a a a " * 30, "en"), (None, "x\ty\x0bz\x1cq x\ty\x0cz", "fr")]
    for i in range(150):
        n = rng.randint(1, 60)
        rows.append((i % 40, "".join(rng.choice(["the", "of", "a", "b", "C", "dé", "x y"]) + rng.choice([" ", " ", " ", "  ", ". ", "\n", "\t"]) for _ in range(n)), rng.choice(["en", "en", "de", None, "und"])))
    out = collocations.collocations(docs(spark, rows), least=least, block_bytes=block_bytes, route_pointers=route_pointers).collect()
    assert sorted(map(tuple, out)) == sorted(brute_collocations(rows, least))
    few = collocations.collocations(docs(spark, rows), least=least, top=3).collect()
    assert sorted(map(tuple, few)) == sorted(r for r in brute_collocations(rows, least) if r[1] <= 3)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, None, "en"), (2, "once only", None)])).count() == 0


def test_a_very_long_text(spark):
    rows = [(1, "one two three " * 40_000, "en"), (2, "p, q " * 50, "en")]
    out = collocations.collocations(docs(spark, rows), block_bytes=10_000).collect()
    assert sorted(map(tuple, out)) == sorted(brute_collocations(rows, 30))


@pytest.mark.parametrize("kind", ["plain", "multiple", "close", "poor", "one"])
def test_spectrum(kind):
    rng = np.random.default_rng(3)
    d = 1 if kind == "one" else 40
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = {"plain": np.exp(rng.normal(size=d) * 3), "multiple": np.repeat([5.0, 3.0, 3.0, 1.0], 10), "close": np.r_[9.0, 9.0 - 1e-8, rng.uniform(1, 2, max(0, d - 2))], "poor": np.r_[rng.uniform(1, 2, 4), np.zeros(36)], "one": np.array([4.0])}[kind]
    a = (q * values) @ q.T
    found, axes = whitening.spectrum((a + a.T) / 2)
    assert np.allclose(found, np.sort(values)[::-1], atol=1e-13 * values.max(), rtol=0)
    assert np.linalg.norm(axes.T @ axes - np.eye(d)) < 1e-12 and np.linalg.norm(a @ axes - axes * found) < 1e-13 * d * values.max()


def test_exact_products():
    rng = np.random.default_rng(4)
    for most in (10, 1 << 22, 1 << 30):
        y = rng.integers(-most, most, size=(500, 3))
        assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label int, v int")


def test_whitening(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(x) for x in row]) for i, row in enumerate(np.float32(rng.normal(size=(300, 12)) * np.linspace(0.5, 3, 12)))]
    bad = [(900, None), (901, [1.0] * 11 + [None]), (902, [1.0] * 11 + [math.nan]), (903, [1.0] * 11 + [math.inf]), (904, []), (905, [1.0, 2.0]), (906, [1e12] + [0.0] * 11)]
    rows = good + [(None, good[0][1]), (5, good[5][1])]
    out = whitening.whiten(vectors(spark, rows + bad).repartition(3)).collect()
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], object)
    n, s = len(rows), x.sum(axis=0)
    v = np.array((n * x - s).T @ (n * x - s) / n**3, float)
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    white = np.array(x - s / n, float) @ axes / np.sqrt(e)
    assert len(out) == 8 * n and {r["n"] for r in out} == {n}
    want = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        want[key].append(i)
    signs = {}
    for r in sorted(out, key=lambda r: (-1 if r["vec_id"] is None else r["vec_id"], r["component"])):
        i, k = want[r["vec_id"]][0], r["component"] - 1
        signs.setdefault(k, np.sign(r["whitened"] * white[i, k]))
        assert abs(signs[k] * r["whitened"] - white[i, k]) < 1e-9 and abs(r["explained"] - e[k] / e.sum()) < 1e-12
        assert r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[i], s, strict=True)) and r["identity_error"] < 1e-12
    assert Counter(r["vec_id"] for r in out)[None] == 8 and Counter(r["vec_id"] for r in out)[5] == 16


def test_whitening_without_variance(spark):
    none = [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None), (2, [])]]
    for rows in none:
        assert whitening.whiten(vectors(spark, rows)).count() == 0
    out = whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0]), (3, [1e6, 2.0])])).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 3
    huge = whitening.whiten(vectors(spark, [(1, [5e8, 2.0]), (2, [-5e8, 7.0])])).collect()
    assert {r["component"]: r["deviation"] for r in huge} == {1: None} and all(abs(abs(r["whitened"]) - 1) < 1e-12 for r in huge)
