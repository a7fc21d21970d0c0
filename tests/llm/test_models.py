"""Near-duplicates, quality rules, classifier, licenses, decontamination and scoring against brute force."""

import math
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioforge.llm import classifier, decontaminate, licenses, lmscore, neardup, quality_rules
from folioforge.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, key string, noise long"


def docs(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "en", "s", 0, "x", "y", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(texts))]


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(4)
    texts = [None, "", " \t", "one two", "One  TWO", "one two three", "É a b c d e", "é a b c d e"]
    for _ in range(12):
        base = words(rng, rng.randint(30, 120))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    chain = words(rng, 60)
    for k in range(10):  # neighbours are near, the ends are not
        texts.append(" ".join(chain[k * 2 :] + words(rng, k * 2, 10**6)))
    texts += texts[10:14]
    sets, roots = brute_components(texts)
    out = {r["doc_id"]: r for r in neardup.near_duplicates(docs(spark, texts)).collect()}
    assert len(out) == len(texts)
    for i in range(len(texts)):
        assert (out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (len(sets[i]), roots[i], roots[i] == i), texts[i]


def test_near_duplicates_edges(spark):
    assert neardup.near_duplicates(docs(spark, [])).count() == 0
    out = neardup.near_duplicates(docs(spark, ["a b c d e f", "a b c d e f", "z"], ids=[5, None, 5])).collect()
    assert sorted((r["doc_id"] is None, r["component_id"], r["kept"]) for r in out) == [(False, 5, True), (False, 5, True), (True, None, False)]


def test_near_duplicates_of_repeated_ids(spark):
    rng = random.Random(14)
    bases = [words(rng, 40, 10**6) for _ in range(4)]
    near = lambda b, k: " ".join([*b[:-1], f"tail{k}"])
    # id 5 has three texts; two of them have partners with larger ids, one has a partner with a smaller id
    rows = [(5, near(bases[0], 0)), (5, near(bases[1], 0)), (5, near(bases[2], 0)), (9, near(bases[0], 1)), (8, near(bases[1], 1)), (2, near(bases[2], 1)), (7, near(bases[3], 0)), (7, near(bases[3], 0)), (6, near(bases[3], 1))]
    out = neardup.near_duplicates(docs(spark, [t for _, t in rows], ids=[i for i, _ in rows])).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in out) == Counter({(5, 5): 2, (5, 2): 1, (9, 5): 1, (8, 5): 1, (2, 2): 1, (7, 6): 2, (6, 6): 1})


def test_near_duplicates_around_the_threshold(spark):
    rng = random.Random(15)
    texts = [" ".join(words(rng, 20_000, 10**6)), ""]
    long = texts[0].split()
    for cut in (2400, 2800, 3200):  # a long text with a part replaced
        texts.append(" ".join(long[cut:] + words(rng, cut, 10**6)))
    for _ in range(40):
        base = words(rng, rng.randint(40, 400), 10**6)
        for share in (0.12, 0.14, 0.16, 0.18):
            n = round(len(base) * share)
            texts.append(" ".join(base[n:] + words(rng, n, 10**6)))
    # one factor's hot group: many near copies, and texts near the line to them
    hot = words(rng, 60, 10**6)
    texts += [" ".join(hot[:-1] + [f"h{k}"]) for k in range(150)] + [" ".join(hot[k:] + words(rng, k, 10**6)) for k in range(5, 14)]
    sets, roots = brute_components(texts)
    out = {r["doc_id"]: r for r in neardup.near_duplicates(docs(spark, texts)).collect()}
    assert [(out[i]["n_shingles"], out[i]["component_id"]) for i in range(len(texts))] == [(len(sets[i]), roots[i]) for i in range(len(texts))]


def test_components_of_a_long_path(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    extra = spark.createDataFrame([(900, 901), (901, 900), (902, 902)], "a long, b long")
    out = {r["node"]: r["component"] for r in components(edges.union(extra)).collect()}
    assert all(out[i] == 0 for i in range(201)) and out[901] == 900


def brute_base(text):
    text = text or ""
    w = text.encode().split()
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_quality_rules(spark):
    rng = random.Random(5)
    common = quality_rules.COMMON_WORDS["en"]
    clean = [" ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(150)) + ".\nLine." for _ in range(60)]
    odd = [None, "", "a\na\n \na", "x y z x y z x", "é€ " * 80, "<a>|#\n" * 70, clean[0].upper(), " | ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)), "a " * 100_000, clean[1]]
    texts = clean + odd
    out = {r["doc_id"]: r for r in quality_rules.apply_rules(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, dup, repeat = brute_base(t)
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
    assert all(out[i]["kept"] for i in range(60)) and out[len(texts) - 1]["kept"]
    assert not any(out[60 + i]["kept"] for i in range(9))
    assert quality_rules.apply_rules(docs(spark, [])).count() == 0


def test_divergence():
    a = np.array([1, 0, 3])
    assert quality_rules.divergence(a, 5 * a) == 0 and quality_rules.divergence(np.array([1, 0]), np.array([0, 1])) == 1
    assert quality_rules.divergence(np.zeros(2), np.ones(2)) == 0


def test_classifier(spark):
    rng = random.Random(6)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(80)) for _ in range(60)]
    bad = [" ".join(rng.choice(["###", "QQQ!!", "%%%", "&x&"]) for _ in range(80)) for _ in range(25)]
    texts = good + bad + [None, "", "ok", good[0]]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 85, 2)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in classifier.classify(docs(spark, texts), labels).collect()}
    assert len(out) == len(texts)
    assert all(out[i]["kept"] for i in range(60)) and not any(out[i]["kept"] for i in range(60, 85))
    assert not out[85]["kept"] and not out[86]["kept"] and out[88]["kept"]
    half = classifier.classify(docs(spark, texts), labels, keep=0.5).where("kept").count()
    assert half == round(0.5 * (len(texts) - 2))
    assert classifier.classify(docs(spark, []), labels).count() == 0
    assert classifier.classify(docs(spark, texts), labels.limit(0)).where("kept").count() == len(texts) - 2


def slow_bucket(gram, bits):
    key = len(gram)
    for b in gram:
        key = ((key ^ b) * 0x9E3779B1) % 2**32
        key ^= key >> 15
    return key >> (32 - bits)


def test_classifier_against_plain_python(spark):
    rng, bits = random.Random(16), 10
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma"] if rng.random() < 0.8 else ["###", "zz9", "é"]) for _ in range(rng.randint(1, 40))) for _ in range(120)] + ["", None, "x", "tie tie", "tie tie"]
    ids = [*range(len(texts) - 3), None, 500, 500]
    labels = {i: int(texts[i].count("#") + texts[i].count("9") < 3) for i in range(0, 120, 2)}
    frame = spark.createDataFrame([(i, q, 0) for i, q in labels.items()], "doc_id long, quality int, toxic int")
    out = classifier.classify(docs(spark, texts, ids=ids), frame, bits=bits, temper=0.5).collect()
    buckets = [[slow_bucket(raw[i : i + n], bits) for n in (2, 3, 4) for i in range(len(raw) - n + 1)] for raw in ((t or "").encode() for t in texts)]
    fitted = {i for i in labels if zlib.crc32(str(i).encode()) % 3}
    raw = Counter(b for bs in buckets for b in bs)
    target = Counter(b for i, bs in zip(ids, buckets, strict=True) if i in fitted and labels[i] for b in bs)
    p, n = [raw[b] + 1 for b in range(2**bits)], sum(raw.values())
    q = [target[b] + (sum(target.values()) + 1) / (n + 1) for b in range(2**bits)]
    want = sorted((str(i), len(bs), round(sum(math.log(q[b] / sum(q)) - math.log(p[b] / sum(p)) for b in bs), 3) if bs else None) for i, bs in zip(ids, buckets, strict=True))
    got = sorted((str(r["doc_id"]), r["n_grams"], None if r["log_weight"] is None else round(r["log_weight"], 3)) for r in out)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(a[2] is b[2] is None or math.isclose(a[2], b[2], abs_tol=0.01) for a, b in zip(got, want, strict=True))
    judged = [r for r in out if r["log_weight"] is not None]
    held = [(r["log_weight"], labels[r["doc_id"]]) for r in judged if r["doc_id"] in labels and r["doc_id"] not in fitted]
    cost = lambda cut: sum(20 * g if w < cut else 1 - g for w, g in held)
    k = sum(r["kept"] for r in out)
    ordered = sorted(judged, key=lambda r: -r["gumbel_key"])
    assert {id(r) for r in judged if r["kept"]} <= {id(r) for r in ordered if r["gumbel_key"] >= ordered[k - 1]["gumbel_key"]} and k < len(judged)
    cuts = sorted(r["log_weight"] for r in judged)
    assert cost(cuts[len(judged) - k]) == min(map(cost, [*cuts, cuts[-1] + 1]))


def test_top_k_is_exact(spark):
    rng = random.Random(7)
    values = [rng.choice([0.0, 1.0, rng.random(), rng.gauss(0, 1e6)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 7, 1500, 2999, 3000):
        edge, ties = classifier.top_k_threshold(df, "x", k, ways=16)
        ordered = sorted(values, reverse=True)
        assert edge == ordered[k - 1] and ties == k - sum(v > edge for v in values)


def test_licenses(spark):
    apache = licenses.TEMPLATES["Apache-2.0"]
    texts = ["intro words here. " + apache + " tail words", "LICENSED under the apache license, version 2.0", "Licensed under the Apache License, Version 1.1.", "driving licence office opens at nine on weekdays only", None, "", "é " * 50_000 + licenses.TEMPLATES["MIT"], licenses.TEMPLATES["GPL-3.0"] + "\n" + licenses.TEMPLATES["CC-BY-NC-4.0"]]
    out = licenses.scan_licenses(docs(spark, texts)).collect()
    named = defaultdict(list)
    for r in out:
        if r["confirmed"]:
            named[r["doc_id"]].append(r["license"])
            assert "icen" in texts[r["doc_id"]][r["start"] : r["end"]].lower()
    assert dict(named) == {0: ["Apache-2.0"], 1: ["Apache-2.0"], 6: ["MIT"], 7: ["GPL-3.0", "CC-BY-NC-4.0"]}
    assert "-2.0" in [r["differences"] for r in out if r["doc_id"] == 2][0]
    assert licenses.scan_licenses(docs(spark, [])).count() == 0


def known_templates(most=0.1):
    return licenses.Templates(licenses.TEMPLATES, most)


def test_a_later_notice_does_not_hide_an_earlier_one():
    known, t = known_templates(), licenses.TEMPLATES
    short = ["Proprietary", "Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "GPL-2.0", "MIT", "CC0-1.0", "Proprietary", "AGPL-3.0", "LGPL-3.0"]
    for names in (["Proprietary", "Apache-2.0"], ["CC-BY-NC-4.0", "GPL-3.0"], ["MIT", "MIT"], short, short[::-1]):
        text = " ".join(t[k] for k in names)
        found = licenses.scan_text(text, known)
        assert [(text[a:b], k, d, ok) for a, b, k, _, d, ok in found] == [(t[k], k, "", True) for k in names]
    _, _, name, _, differs, ok = licenses.scan_text("of the of " + t["BSD-3-Clause"].replace("source and ", "source or ").replace("Redistribution", "The redistribution"), known)[0]
    assert (name, differs, ok) == ("BSD-3-Clause", "-and +or", True)


def test_every_license_template_is_confirmed():
    known = known_templates()
    for name, notice in licenses.TEMPLATES.items():
        for text in (notice, "some words before it " * 60 + notice + " and others after it" * 60, "x" * 5000 + " " + notice.replace(" ", "\n ") + " " + "y" * 5000):
            found = [(" ".join(text[a:b].split()), k) for a, b, k, _, _, ok in licenses.scan_text(text, known) if ok]
            assert found == [(" ".join(notice.split()), name)], name


def fewest_differences(want, have):
    """Fewest missing and extra words of any span of have against want, with insertions at the span's ends free."""
    row = [0] * (len(have) + 1)
    for w in want:
        above, row = row, [row[0] + 1]
        for j, h in enumerate(have):
            row.append(above[j] if w == h else 1 + min(above[j + 1], row[j]))
    return min(row)


def test_altered_notices_against_all_templates_and_places():
    rng, known = random.Random(31), known_templates()
    filler = words(rng, 300, 10**6)
    for name, notice in [(k, v) for k, v in licenses.TEMPLATES.items() for _ in range(3)]:
        w = notice.split()
        for _ in range(rng.randint(0, len(w) // 8)):
            at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            w[at : at + (kind > 0)] = words(rng, int(kind < 2), 10**6)
        text = " ".join(filler[: rng.randint(0, 50)] + w + filler[60 : rng.randint(60, 120)])
        have = [licenses.plain(x) for x in text.split()]
        possible = {k for k, v in known.words.items() if fewest_differences(v, have) <= 0.1 * len(v)}
        confirmed = {k for _, _, k, _, _, ok in licenses.scan_text(text, known) if ok}
        assert confirmed <= possible and bool(confirmed) == bool(possible), (name, text)


def test_notices_in_other_words_and_languages():
    known, t = known_templates(), licenses.TEMPLATES
    found = lambda text: [(k, ok) for _, _, k, _, _, ok in licenses.scan_text(text, known)]
    assert found("It is available under Creative Commons Attribution-ShareAlike 4.0 for all.") == [("CC-BY-SA-4.0 (short)", True)]
    assert found("// SPDX-License-Identifier: MIT") == [("MIT (tag)", True)]
    assert found("Hinweis: " + t["GPL-3.0 (German)"].replace("Programm", "Werk")) == [("GPL-3.0 (German)", True)]
    assert found("the driving office sends its permission slips in the following weeks") == [] == found(None) == found("")


def brute_leaks(texts, items, percent=75):
    owners = Counter(s for t in dict(items).values() for s in shingles(t) if len((t or "").split()) >= 5)
    found = set()
    for d, text in enumerate(texts):
        w = (text or "").lower().split()
        for i, item in items:
            want = (item or "").lower().split()
            if len(want) < 5 or len(w) < 5:
                continue
            weights = {s: 1 / owners[s] for s in shingles(item)}
            for at in range(max(1, len(w) - len(want) + 1)):
                got = shingles(" ".join(w[at : at + len(want)]))
                if len(w[at : at + len(want)]) < 5:
                    continue
                common = sum(weights.get(s, 0) for s in got)
                if 100 * common >= percent * (sum(weights.values()) + sum(s not in weights for s in got)) - 1e-9:
                    found.add((d, i))
    return found


def test_decontamination_against_all_windows(spark):
    rng = random.Random(8)
    items = [(i, " ".join(words(rng, rng.randint(15, 55), 5000))) for i in range(20)] + [(50, "too short"), (51, None), (52, "")]
    items.append((60, items[0][1]))
    texts = [None, "", "a b c"]
    for k in range(60):
        t = words(rng, rng.randint(20, 200), 5000)
        if k % 2:
            leak = items[rng.randrange(20)][1].split()
            for _ in range(rng.randint(0, 2)):
                leak[rng.randrange(len(leak))] = "changed"
            at = rng.randrange(len(t))
            t[at:at] = leak
        texts.append(" ".join(t).replace("w1", "W1"))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit("clash"))
    out = decontaminate.find_leaks(docs(spark, texts), benchmark).collect()
    got = {(r["doc_id"], r["item_id"]) for r in out}
    assert got == brute_leaks(texts, items) and len(got) == len(out) > 10
    assert decontaminate.find_leaks(docs(spark, []), benchmark).count() == 0
    assert decontaminate.find_leaks(docs(spark, texts), benchmark.limit(0)).count() == 0


def test_decontamination_with_insertions_and_shared_openings(spark):
    rng = random.Random(21)
    opening, close = words(rng, 12, 10**6), words(rng, 4, 10**6)
    items = [(i, opening[: 12 * (i % 2)] + words(rng, rng.randint(14, 40), 10**6) + close[: 4 * (i % 3 == 0)]) for i in range(24)]
    items += [(90, items[0][1] + words(rng, 10, 10**6)), (91, items[1][1][:-9])]  # one item inside another
    texts = []
    for k in range(240):
        leak = list(items[k % len(items)][1])
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(leak))
            kind = rng.randrange(3)
            leak[at : at + (kind > 0) * rng.randint(1, 3)] = words(rng, rng.randint(1, 3) if kind < 2 else 0, 10**6)
        texts.append(" ".join(words(rng, rng.randint(0, 12), 10**6) + leak + (opening if k % 5 == 0 else []) + words(rng, rng.randint(0, 12), 10**6)))
    texts += texts[:3]
    items = [(i, " ".join(w)) for i, w in items]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = docs(spark, [*texts, texts[5]], ids=[*range(len(texts)), None])
    out = decontaminate.find_leaks(rows, benchmark).collect()
    want = brute_leaks(texts, items)
    assert {(r["doc_id"], r["item_id"]) for r in out} == want | {(None, i) for d, i in want if d == 5}
    assert len(out) > 50


def test_moved_passages_are_found(spark):
    """Passages of 20 to 200 words, rotated, halved, with blocks swapped or with words between, and with repeated shingles: all windows are searched."""
    rng = random.Random(31)
    items = [(i, words(rng, n, 10**6)) for i, n in enumerate([20, 30, 45, 60, 100, 200])]
    items.append((6, (words(rng, 9, 10**6) * 3)[:24]))  # repeats its own shingles
    texts = []
    for _, w in items:
        n = len(w)
        for k in (n // 2, n // 3, 2 * n // 3):
            texts.append(w[k:] + w[:k])
        third = n // 3
        texts += [w[third:] + words(rng, n // 8, 10**6) + w[:third], w[: n // 2] + words(rng, n // 12 + 1, 10**6) + w[n // 2 :], w[n // 2 :], w + w, w[: n // 5 * 4] * 2]
        texts.append([x for i in range(0, n, 10) for x in (w[i + 5 : i + 10] + w[i : i + 5])])
    texts = [" ".join(words(rng, rng.randint(0, 40), 10**6) + t + words(rng, rng.randint(0, 40), 10**6)) for t in texts]
    items = [(i, " ".join(w)) for i, w in items]
    out = decontaminate.find_leaks(docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute_leaks(texts, items)
    assert {(r["doc_id"], r["item_id"]) for r in out} == want and len(want) > 20


def test_a_long_text_full_of_spots(spark):
    rng = random.Random(32)
    items = [(i, words(rng, 30, 10**6)) for i in range(3)]
    text = [x for k in range(700) for x in (items[k % 3][1] if k % 50 == 0 else items[k % 3][1][:12] + words(rng, 18, 10**6))]
    items = [(i, " ".join(w)) for i, w in items]
    rows = docs(spark, [" ".join(text), None])
    out = decontaminate.find_leaks(rows, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"], r["similarity"]) for r in out} == {(0, i, 1.0) for i in range(3)}


def test_hamming_blocks_guarantee(spark):
    rng = random.Random(9)
    rows = []
    for k in range(300):
        a = rng.getrandbits(64)
        flips = rng.sample(range(64), rng.randint(0, 15))
        b = a
        for f in flips:
            b ^= 1 << f
        rows.append((k, a - 2**64 if a >= 2**63 else a, b - 2**64 if b >= 2**63 else b))
    df = spark.createDataFrame(rows, "k long, a long, b long")
    x = df.select("k", F.explode(decontaminate.hamming_blocks("a", 0)).alias("m"))
    y = df.select("k", F.explode(decontaminate.hamming_blocks("b", 1)).alias("m"))
    assert x.join(y, ["k", "m"]).select("k").distinct().count() == 300


def test_leaks_near_the_threshold_are_found(spark):
    rng = random.Random(12)
    items = [(i, words(rng, 59, 10**6)) for i in range(60)]
    texts = [(i, k, words(rng, 9, 10**6) + w[7 * (k % 2) : 52 + 7 * (k % 2)] + words(rng, 9, 10**6)) for i, w in items for k in range(4)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    out = decontaminate.find_leaks(docs(spark, [" ".join(t) for _, _, t in texts]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(d, i) for d, (i, _, _) in enumerate(texts)}  # 48 of 62 shingles are common


@pytest.mark.parametrize("block_bytes", [3_000, 1 << 24])
def test_base_scores_against_counts(spark, block_bytes):
    rng = random.Random(10)
    texts = [None, "", "A a"] + [" ".join(words(rng, rng.randint(1, 80), 60)) for _ in range(80)]
    out = {r["doc_id"]: r for r in lmscore.score(docs(spark, texts), block_bytes=block_bytes).collect()}
    split = [(t or "").encode().lower().split() + ["<end>"] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = Counter(w for s, h in zip(split, held, strict=True) if not h for w in s)
    n = sum(c.values())
    for i, s in enumerate(split):
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(s), sum(c[w] > 0 for w in s), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + len(c) + 1)) for w in s), rel_tol=1e-9)
        assert r["score"] < 0
    assert lmscore.score(docs(spark, [])).count() == 0


def small_model(rng, kind=np.float32, n=30):
    ids = np.sort(rng.choice(1000, n, replace=False))
    model = lmscore.Model.start(ids, rng.integers(1, 50, n), 1001)
    for k in ("w", "r"):
        model.p[k] = model.p[k] + rng.normal(0, 0.3, model.p[k].shape)
    model.p = {k: v.astype(kind) for k, v in model.p.items()}
    model.s, model.u = model.s.astype(kind), model.u.astype(kind)
    return model


def slow_scores(model, stream, lengths):
    """Natural-log probabilities, token by token, from the definition."""
    out, at = [], 0
    p, s = model.p, model.s
    b = (s + lmscore.FLOOR * model.u[:, None]) / (s.sum(axis=0) + lmscore.FLOOR)
    for length in lengths:
        text = stream[at : at + length]
        inputs = np.concatenate([[model.end_row], text[:-1]])
        for i, y in enumerate(text):
            past = np.arange(max(0, i // lmscore.SPAN - 1) * lmscore.SPAN, i + 1)
            e = np.array([p["q"][inputs[i]] @ p["k"][inputs[j]] / lmscore.WIDTH**0.5 + p["r"][i - j] for j in past])
            e = np.exp(e) / np.exp(e).sum()
            z = np.exp(p["a"][inputs[i]] + (e @ p["v"][inputs[past]]) @ p["w"])
            out.append(math.log((z / z.sum()) @ b[y]))
        at += length
    return np.array(out)


def test_scores_follow_the_definition():
    rng = np.random.default_rng(1)
    model = small_model(rng)
    lengths = np.array([40, 1, 16, 90, 17])
    stream = rng.integers(0, 31, lengths.sum())
    fast = model.token_scores(stream, lengths)
    assert len(fast) == lengths.sum() and np.allclose(fast, slow_scores(model, stream, lengths), atol=2e-4)
    # the last row stands for every id that training did not see: all ids together have probability 1
    total = sum(np.exp(model.token_scores(np.array([3, 5, y]), np.array([3]))[2]) * (1 if y < 30 else 1001 - 30) for y in range(31))
    assert abs(total - 1) < 1e-4
    changed = stream.copy()
    changed[20] = (changed[20] + 1) % 30  # a later token changes nothing before it, and texts do not see each other
    other = model.token_scores(changed, lengths)
    assert np.allclose(fast[:20], other[:20]) and not np.allclose(fast[21:40], other[21:40]) and np.allclose(fast[40:], other[40:])


def test_attention_gradient():
    rng = np.random.default_rng(0)
    model = small_model(rng, np.float64)
    x, begins, y, _ = lmscore.windows(rng.integers(0, 31, 100), np.array([16, 3, 16, 9, 56]), model.end_row)
    begins[:] = True  # windows without a span before, as keys of the span before a chunk are left as they are
    x = lmscore.chunk(x, 0)

    def loss():
        z, _ = model.attend(x, begins)
        real = y.ravel() >= 0
        b = model.emitted(np.maximum(y.ravel(), 0))
        return -(np.log((z * b).sum(axis=1)) - np.log(z.sum(axis=1)))[real].mean()

    g, rows, summed = model.gradient(x, begins, y)
    assert abs(summed.sum() - 1) < 1e-9 and set(rows) == set(y[y >= 0])
    for name, (at, values) in g.items():
        whole = np.zeros_like(model.p[name])
        whole[slice(None) if at is None else at] = values
        where = np.unravel_index(np.abs(whole).argmax(), whole.shape)
        p, losses = model.p[name], []
        for move in (1e-5, -1e-5):
            p[where] += move
            losses.append(loss())
            p[where] -= move
        assert math.isclose((losses[0] - losses[1]) / 2e-5, whole[where], rel_tol=1e-3), name


def test_training_learns_more_than_shares_and_packs():
    stream = np.tile(np.array([1, 2, 3, 4, 9, 4, 7, 29]), 4000)
    lengths = np.full(len(stream) // 80, 80)
    counts = np.bincount(stream, minlength=30)
    model = lmscore.Model.start(np.arange(30), counts, 50)
    before = model.token_scores(stream, lengths).mean()
    model.train(stream, lengths)
    assert model.token_scores(stream, lengths).mean() > before + 0.5
    again = model.unpacked(model.packed(), model.steps)
    assert np.array_equal(again.token_scores(stream, lengths), model.token_scores(stream, lengths))
    assert all(np.array_equal(again.g[k], model.g[k]) for k in model.g) and again.steps == model.steps > 3
    assert list(model.rows_of(np.array([0, 29, 30, 49]))) == [0, 29, 30, 30]


def test_rows_are_summed():
    rows, summed = lmscore.summed_by(np.array([70000, 2, 70000]), np.array([[1.0], [2.0], [5.0]]))
    assert rows.tolist() == [2, 70000] and summed.tolist() == [[2.0], [6.0]]


def test_held_out_texts_score_above_their_ids_shares(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    tokens = lmscore.Tokens(lmscore.read_ranks(lmscore.TOKENIZER))
    ids = {r["doc_id"]: [*tokens.words((r["text"] or "").encode().lower().split())[0], tokens.end] for r in table.collect()}
    out = lmscore.score(table, block_bytes=200_000).collect()
    counts = Counter(t for r in out if not r["held_out"] for t in ids[r["doc_id"]])
    total = sum(counts.values()) + tokens.end + 1
    shares = sum(math.log10((counts[t] + 1) / total) for r in out if r["held_out"] for t in ids[r["doc_id"]])
    assert 0.88 * shares < sum(r["score"] for r in out if r["held_out"]) < 0 and all(math.isfinite(r["score"]) for r in out)


def test_words_are_encoded_alike_together_and_alone():
    tokens = lmscore.Tokens(lmscore.read_ranks(lmscore.TOKENIZER))
    mixed = [b"one", "é\u00a0x".encode(), b"two-three", b"\xff\xfe", b"don't", "ẞ".encode(), b"\x1c"]
    for words in (mixed, [b"a", b"bc"], [], ["é".encode()]):
        ids, sizes = tokens.words(words)
        assert ids.tolist() == [t for w in words for t in tokens.encoder.encode_ordinary(" " + w.decode("utf-8", "replace"))]
        assert sizes.sum() == len(ids) and len(sizes) == len(words)


def test_words_are_split_without_backtracking():
    """Lines of any words go through a pattern that splits them as the tokenizer's own does, in less time than that takes."""
    tokens, rng = lmscore.Tokens(lmscore.read_ranks(lmscore.TOKENIZER)), random.Random(6)
    pool = ["a", "B", "'s", "'ll", "'", "9", "½", "é", "ß", "一", "\u0301", "-", "_", "#", "\u200b", "\ufeff", "\x1b", "\x00", "😀", "\U000e0001", "'re", "ا", "ำ", "٣", "\x7f", "�", "<|", "\x84", "\u3000", "\x1c"]
    odd = ["".join(rng.choices(pool, k=rng.randint(1, 8))) for _ in range(5_000)]
    ids, sizes = tokens.words([w.encode() for w in odd])
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [tokens.encoder.encode_ordinary(f" {w}") for w in odd]
    plain = ["".join(rng.choices("etaoinshr,", k=rng.randint(2, 9))) for _ in range(20_000)]
    text, coded = " " + "\n ".join(plain) + "\n", [w.encode() for w in plain]
    spent = {"the tokenizer's pattern": [], "words": []}
    for _ in range(12):
        for name, call in (("the tokenizer's pattern", lambda: tokens.encoder.encode_ordinary(text)), ("words", lambda: tokens.words(coded))):
            began = time.process_time()
            call()
            spent[name].append(time.process_time() - began)
    assert min(spent["words"]) < 0.9 * min(spent["the tokenizer's pattern"])


def test_every_step_moves_all_parameters_from_all_positions():
    """Queries, keys, values and places move at each step, and keys and values of the span before a chunk get their part."""
    rng = np.random.default_rng(3)
    model = small_model(rng, np.float64)
    x, begins, y, _ = lmscore.windows(rng.integers(0, 30, 96), np.array([96]), model.end_row)
    x, begins, y = lmscore.chunk(x, 4, 3), begins[4:7], y[4:7]  # in the midst of a text

    def loss():
        z, _ = model.attend(x, begins)
        b = model.emitted(y.ravel())
        return -(np.log((z * b).sum(axis=1)) - np.log(z.sum(axis=1))).mean()

    g, _, _ = model.gradient(x, begins, y)
    for name in "kv":
        at, values = g[name]
        assert set(at) == set(x.ravel())
        p = model.p[name]
        for row, value in zip(at, values, strict=True):
            losses = []
            for move in (1e-5, -1e-5):
                p[row, 0] += move
                losses.append(loss())
                p[row, 0] -= move
            assert abs((losses[0] - losses[1]) / 2e-5 - value[0]) < 1e-8 + 1e-3 * abs(value[0]), (name, row)
    model = small_model(rng)
    for _ in range(5):
        before = {k: v.copy() for k, v in model.p.items()}
        model.learn(x, begins, y)
        assert all((model.p[k] != before[k]).any() for k in before)
        assert all((model.p[k][np.unique(x)] != before[k][np.unique(x)]).any(axis=1).all() for k in "kv")


def test_rows_are_summed_in_fewer_calls_than_columns():
    """Runs of every length, in both kinds of floats, give the plain sums at less than the cost of one call a run and column."""
    rng = np.random.default_rng(4)
    rows = np.minimum(rng.zipf(1.3, 8192), 2400) - 1
    for kind, width in ((np.float64, 56), (np.float64, 3), (np.float32, 56), (np.float32, 32)):
        values = rng.normal(size=(len(rows), width)).astype(kind)
        whole = np.zeros((2400, width))
        np.add.at(whole, rows, values.astype(float))
        at, summed = lmscore.summed_by(rows, values)
        assert at.tolist() == sorted(set(rows.tolist())) and summed.dtype == kind
        assert np.allclose(summed, whole[at], atol=1e-9 if kind is np.float64 else 1e-2)
    assert [x.shape for x in lmscore.summed_by(rows[:0], values[:0])] == [(0,), (0, 32)]
    ordered = values.take(order := np.argsort(rows, kind="stable"), axis=0)
    first = np.flatnonzero(np.diff(rows[order], prepend=-1))
    spent = {"by columns": [], "by runs": []}
    for _ in range(60):
        for name, call in (("by columns", lambda: np.add.reduceat(ordered, first, axis=0)), ("by runs", lambda: lmscore.summed_by(rows, values))):
            began = time.process_time()
            call()
            spent[name].append(time.process_time() - began)
    assert min(spent["by runs"]) < min(spent["by columns"])


def test_a_step_sums_its_parts_where_they_stand():
    """No copy of all gradients side by side: a step's peak stays below 4.5 numbers for each one of a row's parameters and token."""
    rng = np.random.default_rng(5)
    model = small_model(rng, n=500)
    x, begins, y, _ = lmscore.windows(rng.integers(0, 500, 8 * lmscore.CHUNK), np.array([8 * lmscore.CHUNK]), model.end_row)
    x = lmscore.chunk(x, 0)
    model.gradient(x, begins, y)
    tracemalloc.start()
    try:
        model.gradient(x, begins, y)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 4.5 * 4 * x.size * (3 * lmscore.WIDTH + lmscore.TOPICS)


def test_texts_become_words_without_an_object_each():
    """Texts split as bytes do, whatever white space, nulls and empty texts stand among them; the words stay in Arrow."""
    texts = [None, "", " ", "\t\n\x0b\x0c\r", "\x1c A\x1d", "A B  c d É\x85x", "\x00 \x00", " ΑΒ ẞ﻿\n\n y ", "　", "Zz"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "held_out": [i % 3 == 0 for i in range(10)], "text": texts})
    for part in (batch, batch.slice(2, 5), batch.slice(0, 1), batch.slice(4, 1), batch.slice(0, 0)):
        own, split = part.column(2).to_pylist(), [(t or "").encode().lower().split() for t in part.column(2).to_pylist()]
        block = lmscore.Block(0)
        block.add(part)
        assert pa.chunked_array(block.words, pa.binary()).to_pylist() == [w for s in split for w in s]
        assert block.lengths == [len(s) for s in split] and block.bulk == sum(len(t or "") for t in own)
        assert block.docs == list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
