"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import chat, classifier, collocations, decontaminate, exactdedup, licenses, lmscore, mixing, neardup, quality_rules, secrets, sharding, whitening
from folioforge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), max_repetition=2.0)
    return out.withColumns({c: F.round(c, 9) for c in ("alpha", "weight", "mix_key")})


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign_shards(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op5_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secrets.written(F.col("spans"), secrets.BASE)
    return out.select("doc_id", *[count(r.kind) for r in secrets.BASE], F.sha2(base, 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.format_chats(chat.replies_by_turn(turns))
    told, learnt = chat.read_back(F.col("formatted")), chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    out = out.select(F.col("tree").alias("conv_id"), told.alias("turns"), learnt.alias("learnt"), F.length("formatted").cast("long").alias("formatted_chars"))
    turns_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns_text, 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_neardup": op2_neardup,
    "op3_sharding": op3_sharding,
    "op4_quality": op4_quality,
    "op5_lmscore": op5_lmscore,
    "op6_licenses": op6_licenses,
    "op7_decontamination": op7_decontamination,
    "op8_secrets": op8_secrets,
    "op9_chat": op9_chat,
    "op10_classifier": op10_classifier,
    "op11_whitening": op11_whitening,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_collocations": op13_collocations,
}

# The exponent at which the largest source is read half as often as the smallest has a closed form.
OP1_SQL = r"""
WITH n AS (SELECT greatest(256, count(*) // 4096) AS blocks FROM documents),
t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_tokens,
  ('0x' || substr(md5(concat_ws(':', '17', doc_id, md5(text))), 1, 15))::BIGINT % (SELECT blocks FROM n) AS block,
  ('0x' || substr(md5(concat_ws(':', '18', doc_id, md5(text))), 1, 15))::BIGINT AS place FROM t),
s AS (SELECT source, CAST(sum(n_tokens) AS DOUBLE) AS x FROM d GROUP BY source),
e AS (SELECT CASE WHEN count(*) < 2 THEN 1 WHEN max(x) <= 2 * min(x) THEN 0 ELSE 1 - ln(2) / ln(max(x) / min(x)) END AS alpha FROM s WHERE x > 0),
w AS (SELECT source, x, CASE WHEN x > 0 THEN x ** alpha / sum(CASE WHEN x > 0 THEN x ** alpha END) OVER () ELSE 0 END AS weight, alpha FROM s, e),
q AS (SELECT *, round(weight * coalesce(max(x / nullif(weight, 0)) OVER (), 0)) AS quota FROM w),
p AS (SELECT source, alpha, weight, x, CASE WHEN x > 0 THEN floor(quota / x) ELSE 1 END AS epochs, CASE WHEN x > 0 THEN quota - x * floor(quota / x) ELSE 0 END AS rest FROM q),
b AS (SELECT source, block, sum(n_tokens) AS tokens FROM d GROUP BY source, block),
f AS (SELECT source, block, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY ('0x' || substr(md5(concat_ws(':', '19', block)), 1, 15))::BIGINT, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM b),
r AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source, block ORDER BY place, doc_id NULLS FIRST, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM d),
c AS (SELECT r.doc_id, r.source, n_tokens, r.block, alpha, weight, first + ahead AS start, epochs, rest, x,
  CASE WHEN n_tokens = 0 THEN greatest(epochs, 1) WHEN first + ahead < rest THEN epochs + 1 ELSE epochs END AS copies
  FROM r JOIN f ON r.source IS NOT DISTINCT FROM f.source AND r.block = f.block JOIN p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(block AS INT) AS block, round(alpha, 9) AS alpha, round(weight, 9) AS weight, CAST(copies AS BIGINT) AS copies,
  CASE WHEN copies > 0 THEN round(start / greatest(epochs * x + rest, 1), 9) END AS mix_key FROM c
"""

_ALL = " UNION ALL ".join(
    f"SELECT r, {i} AS rank, '{rule.kind}' AS kind, {rule.least} AS least, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS hits, regexp_extract_all(t, '{p}', {rule.value}) AS vals FROM d"
    for i, rule in enumerate(secrets.RULES)
    for p in [rule.regex.replace("'", "''")]
)
OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
m AS ({_ALL}),
u AS (SELECT r, rank, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, vals FROM m),
p AS (SELECT r, rank, kind, least, i, length(gaps[i]) AS gap, length(hits[i]) AS size, length(vals[i]) AS val FROM u),
q AS (SELECT *, sum(gap + size) OVER (PARTITION BY r, rank ORDER BY i) - size AS first FROM p),
f AS (SELECT r, rank, kind, CAST(first AS BIGINT) AS first, kind || ':' || CAST(first AS BIGINT) || ':' || CAST(first + size AS BIGINT) AS span FROM q WHERE val >= least),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(span, ',' ORDER BY first, rank) FILTER (rank < {len(secrets.BASE)}) AS base, string_agg(span, ',' ORDER BY first, rank) AS spans FROM f GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON g.r = d.r
"""

OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
escaped AS (
  SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 4 * (length(role) - length(replace(role, chr(10), ''))) - 1 * (length(role) - length(replace(role, chr(10), ''))) AS role_chars,
    length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(12 + role_chars + 1 + text_chars + 11) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

FORMS = ", ".join(f"('{lang}', {i}, '{(form + end)}')" for lang, words in quality_rules.COMMON_WORDS.items() for i, w in enumerate(words) for form in (w, w.capitalize()) for end in ("", ",", "."))
OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, row_number() OVER () AS r FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
rep AS (SELECT r, count(DISTINCT i + o) AS n_repeat_words FROM k, (SELECT unnest([0, 1, 2]) AS o) WHERE c > 1 GROUP BY r),
base AS (SELECT w.r, doc_id, lang, ws, t, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN rep ON rep.r = w.r),
pat AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS bin, unnest(['[a-z]', '[A-Z]', '[0-9]', '[\x20\x09-\x0D]', '[.,;:!?"''()-]', '[#$%&*+/<=>@\[\\\]^_`{{|}}~]']) AS p),
c6 AS (SELECT r, bin, length(t) - length(regexp_replace(t, p, '', 'g')) AS n FROM base, pat),
cls AS (SELECT r, 'c' AS h, bin, n FROM c6 UNION ALL SELECT base.r, 'c', 6, length(any_value(t)) - sum(n) FROM base JOIN c6 ON c6.r = base.r GROUP BY base.r),
forms(lang, bin, form) AS (VALUES {FORMS}),
bins AS (SELECT DISTINCT lang, bin FROM forms),
hits AS (SELECT u.r, f.bin, count(*) AS n FROM (SELECT r, lang, unnest(ws) AS x FROM base) u JOIN forms f ON f.lang = u.lang AND f.form = u.x GROUP BY ALL),
wrd AS (SELECT base.r, 'w' AS h, bins.bin, coalesce(hits.n, 0) AS n FROM base JOIN bins ON bins.lang = base.lang LEFT JOIN hits ON hits.r = base.r AND hits.bin = bins.bin),
hist AS (SELECT * FROM cls UNION ALL SELECT * FROM wrd UNION ALL SELECT base.r, 'w', 999, any_value(n_words) - sum(n) FROM base JOIN wrd ON wrd.r = base.r GROUP BY base.r),
share AS (SELECT r, h, bin, n / sum(n) OVER (PARTITION BY r, h) AS p, sum(n) OVER (PARTITION BY r, h) AS total FROM hist),
refs AS (SELECT lang, h, bin, sum(round(coalesce(p, 0) * 1e6)) AS q, count(*) AS docs FROM share JOIN base ON base.r = share.r WHERE n_words >= 80 GROUP BY ALL),
refq AS (SELECT lang, h, bin, q / sum(q) OVER (PARTITION BY lang, h) AS q FROM refs WHERE docs >= 20),
js AS (SELECT base.r, share.h, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS far
  FROM base JOIN share ON share.r = base.r JOIN refq ON refq.lang = base.lang AND refq.h = share.h AND refq.bin = share.bin WHERE total > 0 GROUP BY ALL),
bad AS (SELECT DISTINCT r FROM js WHERE (h = 'c' AND far > 0.3) OR (h = 'w' AND far > 0.33))
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT (n_words >= 80 AND base.r IN (SELECT r FROM bad)) AS kept FROM base
"""

OP12_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS place, count(*) OVER (PARTITION BY norm) AS group_size,
  first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""

OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
p AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, ws[i:i + k - 1] AS x, k, count(*) AS f FROM p GROUP BY ALL HAVING count(*) >= 30),
sub AS (SELECT lang, x, k, f, unnest(range(2, k)) AS size FROM f WHERE k > 2),
ins AS (SELECT lang, x, f, size, unnest(range(1, k - size + 2)) AS i FROM sub),
cov AS (SELECT lang, x[i:i + size - 1] AS x, max(f) AS most FROM ins GROUP BY ALL),
c AS (SELECT f.lang, f.x, f.k, f.f AS a FROM f LEFT JOIN cov ON cov.lang = f.lang AND cov.x = f.x WHERE f.k > 1 AND (most IS NULL OR 100 * most < 80 * f.f)),
cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
s AS (SELECT cut.lang, cut.x, j, a, h.f AS l, g.f AS r, (2000000 * a::HUGEINT) // (h.f + g.f) AS score
  FROM cut JOIN f h ON h.lang = cut.lang AND h.x = cut.x[1:j] JOIN f g ON g.lang = cut.lang AND g.x = cut.x[j + 1:cut.k]),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, x ORDER BY score, j) AS nth FROM s),
ranked AS (SELECT lang, array_to_string(x, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM low WHERE nth = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op1_mixing": OP1_SQL, "op4_quality": OP4_SQL, "op8_secrets": OP8_SQL, "op9_chat": OP9_SQL, "op12_exact_dedup": OP12_SQL, "op13_collocations": OP13_SQL}
