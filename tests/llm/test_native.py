"""Chat formatting, secret scans, sharding and mixing against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folioforge.llm import chat, mixing, secrets, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, gram string, block string"


def docs(spark, texts, source="s"):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, "en", source if isinstance(source, str) else source[i], 0, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def test_chat_round_trip_and_loss(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "a\\<|b\\\\|", "", None, "<\\|<\\~>\n", "é<|", "\\"]
    rows = [(1, i, "assistant" if i % 2 else "user\n<|x", t) for i, t in enumerate(nasty)] + [(2, 0, "user", "hi"), (None, 0, None, "z"), (2, 0, "user", "hi")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit("clash"))
    out = chat.format_chats(chat.replies_by_turn(turns)).select("tree", "formatted", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l"))
    got = {r["tree"]: r for r in out.collect()}
    want = defaultdict(list)
    for c, _, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want[c].append((role or "", text or ""))
    assert {k: [(x["role"], x["text"]) for x in r["t"]] for k, r in got.items()} == dict(want)
    assert got[1]["l"] == "".join(t or "" for i, t in enumerate(nasty) if i % 2)
    assert got[1]["formatted"].count(chat.END.strip()) == len(nasty)


def test_reply_trees(spark):
    # 1 has a branch point below the root, 2 two roots, 3 a circle that no root reaches and an orphan
    rows = [(1, 1, None, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 3, -9.0), (1, 4, 3, -9.0), (2, 1, None, None), (2, 2, None, 2.0), (3, 1, 2, 0.0), (3, 2, 1, 0.0), (3, 3, 2, 0.0), (3, 9, 77, 0.0), (1, None, 1, 0.0)]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, score double")
    out = chat.branches(messages).collect()
    paths = defaultdict(list)
    for r in sorted(out, key=lambda r: r["depth"]):
        paths[r["tree"], r["rank"]].append(r["node"])
    assert dict(paths) == {(1, 1): [1, 2], (1, 2): [1, 3, 4], (2, 1): [2], (2, 2): [1], (3, 1): [9]}
    assert {(r["tree"], r["leaf"]) for r in chat.branches(messages, top=1).collect()} == {(1, 2), (2, 2), (3, 9)}
    deep = spark.range(100).select(F.lit(1).cast("long").alias("tree"), F.col("id").alias("node"), F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"), F.lit(0.0).alias("score"))
    assert [r["node"] for r in chat.branches(deep).orderBy("depth").collect()] == list(range(100))
    assert chat.branches(messages.limit(0)).count() == 0


def test_chats_of_trees_with_nulls(spark):
    """Turns without role or text stay in their branch; branches rank by score; ties and repeated rows count once."""
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", None, 0.0), (1, 3, 2, None, "x", 1.0), (1, 4, 3, "assistant", "a", 0.0), (1, 5, 2, "user", None, 3.0), (1, 5, 2, "user", None, 3.0), (None, 1, None, "assistant", "z", None)]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double").withColumn("rank", F.lit(9))
    out = chat.format_chats(messages)
    out = out.select("tree", "rank", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("l"), "loss_spans")
    got = {(r["tree"], r["rank"]): r for r in out.collect()}
    assert {k: [tuple(x) for x in r["t"]] for k, r in got.items()} == {
        (1, 1): [("user", "q"), ("assistant", ""), ("user", "")],
        (1, 2): [("user", "q"), ("assistant", ""), ("", "x"), ("assistant", "a")],
        (None, 1): [("assistant", "z")],
    }
    assert got[1, 2]["l"] == "a" and len(got[1, 2]["loss_spans"]) == 2 and all(None not in tuple(s) for s in got[1, 2]["loss_spans"])
    assert chat.format_chats(messages, top=1).count() == 2 and chat.format_chats(messages.limit(0)).count() == 0


def brute_secrets(text):
    rules = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16), ("forge", re.compile("gh[pousr]_[A-Za-z0-9]+"), 0, 40), ("cloud", re.compile("AIza[0-9A-Za-z_-]+"), 0, 39), ("chat", re.compile("xox[abp]-[0-9A-Za-z-]+"), 0, 20), ("private", re.compile("-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----"), 0, 0))
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, r, g, n) in enumerate(rules) for m in r.finditer(text or "") if len(m.group(g)) >= n]
    return ",".join(x[2] for x in sorted(found))


def test_secrets_against_regex(spark):
    pieces = ["token", "SECRET", "api_key", "APIKEY", "password", ":", "= ", '"', "'", "abcdef0123456789", "AKIA", "ABCDEFGHIJ0123456789", "short", " ", "é€😀", "passwd=", "\n", "deadbeef", "ghp_", "A1b2" * 9, "AIza", "xoxb-", "-----BEGIN ", "EC ", "PRIVATE KEY-----"]
    rng = random.Random(3)
    texts = [None, "", "token=secret=abcdefghijklmnop", "token: secret: abcdefghijklmnop", "AKIAAKIA" + "A" * 30, "x" * 200_000 + " token=abcdefghijklmnop"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(300)]
    out = secrets.scan(docs(spark, texts)).select("doc_id", secrets.written(F.col("spans")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in out} == {i: brute_secrets(t) for i, t in enumerate(texts)}
    assert secrets.scan(docs(spark, [])).count() == 0


def test_trigram_queries():
    asked = {r.kind: r.trigram_query() for r in secrets.RULES}
    sets = lambda *texts: frozenset(frozenset(t.split()) for t in texts)
    assert asked["hex"] == frozenset() and asked["access"] == sets("aki kia")
    assert asked["assign"] == sets("ass pas wor", "ass pas swd", "cre ecr sec", "ken oke tok", "api ike pik", "_ke i_k pi_")
    assert asked["forge"] == sets("ghp hp_", "gho ho_", "ghu hu_", "ghs hs_", "ghr hr_")
    need = secrets.required
    assert need("a+b") == need("ab?c?") == need("abc|x") == need("(abc)*") == need(".*") == need("ab[0-9]c") == need("(?=abc)") == frozenset()
    assert need("(abc)+") == need("x?abc") == need("abc|xabc") == sets("abc") and need("abc.*(def|ghi)") == sets("abc def", "abc ghi")
    assert need("ab(c|d)$") == sets("abc", "abd") and need("abc[0-9]{3}xyz") == sets("abc xyz") and need("(?i:ABC)") == sets("abc")


def test_a_text_full_of_matches(spark):
    text = "deadbeefdeadbeef " * 3000
    out = secrets.scan(docs(spark, [text])).select(secrets.written(F.col("spans")).alias("s")).first()["s"]
    assert out == brute_secrets(text)


def test_sharding_laws(spark):
    rng = random.Random(1)
    texts = ["same text here"] * 400 + ["word " * rng.randint(0, 60) + str(i) for i in range(800)] + [None, "", "", "é" * 5]
    out = sharding.assign_shards(docs(spark, texts), 4, parcels=64).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(len(texts)))
    for r in out:
        t = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(t) + 1 and r["text_crc32"] == zlib.crc32(t) and r["n_tokens"] == len(t.split())
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 4
    for measure in ("size", "n_tokens"):
        sums = Counter()
        for r in out:
            sums[r["shard"]] += r[measure]
        assert max(sums.values()) < 1.1 * min(sums.values())
    cold = defaultdict(set)  # groups under a parcel's share stay whole
    for r in out:
        cold[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for t, s in cold.items() if t and t != "same text here") and len(cold["same text here"]) > 1
    assert sharding.assign_shards(docs(spark, []), 4).count() == 0
    twice = docs(spark, ["a b", "c"]).union(docs(spark, ["a b", "c"]))
    assert sharding.assign_shards(twice, 2).count() == 4


def test_bisect_alpha():
    tokens = [800.0, 150.0, 50.0]
    a = mixing.bisect_alpha(tokens, None, 2.0)
    assert 0 < a < 1 and abs(mixing.repetition(tokens, mixing.weights(tokens, a)) - 2.0) < 1e-6
    a = mixing.bisect_alpha(tokens, 0.9, None)
    assert abs(mixing.entropy(mixing.weights(tokens, a)) - 0.9 * __import__("math").log(3)) < 1e-6
    assert mixing.bisect_alpha([5.0], 0.9, 2.0) == 1.0 and mixing.bisect_alpha([5.0, 0.0], None, 2.0) == 1.0
    assert mixing.bisect_alpha([10.0, 10.0], None, 2.0) == 0.0


def test_mix_quotas(spark):
    rng = random.Random(2)
    sources = ["big"] * 700 + ["mid"] * 200 + ["small"] * 60 + [None] * 40
    texts = ["w " * rng.randint(1, 40) for _ in sources[:-2]] + ["", None]
    out = mixing.mix(docs(spark, texts, sources), max_repetition=2.0, blocks=16).collect()
    assert len(out) == len(texts) and all(r["copies"] >= 1 for r in out)
    total, taken, weight, longest = Counter(), Counter(), {}, Counter()
    for r in out:
        n = len((texts[r["doc_id"]] or "").split())
        assert n == r["n_tokens"]
        total[r["source"]] += n
        taken[r["source"]] += n * r["copies"]
        weight[r["source"]] = r["weight"]
        longest[r["source"]] = max(longest[r["source"]], n)
    assert abs(sum(weight.values()) - 1) < 1e-9
    quota = {s: weight[s] * max(total[x] / weight[x] for x in total) for s in total}
    assert all(-1 <= taken[s] - quota[s] <= longest[s] + 1 for s in total)  # the document that reaches the quota is the last
    assert max(taken[s] / total[s] for s in total) <= 2 + 0.1
    half = mixing.mix(docs(spark, texts, sources), max_repetition=None, min_entropy_share=0.9, budget_tokens=2000, blocks=16).collect()
    spent = sum(len((texts[r["doc_id"]] or "").split()) * r["copies"] for r in half)
    assert 2000 - 4 <= spent <= 2000 + 4 * 40
    assert mixing.mix(docs(spark, [])).count() == 0


def test_mix_limits_sources(spark):
    with pytest.raises(ValueError):
        mixing.mix(docs(spark, ["a"] * 5, list("abcde")), max_sources=3)


def test_hashes_are_plain():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
