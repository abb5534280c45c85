"""One thin query per operator over its whole tables, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.llm import (
    decontamination, exact_dedup, importance, language_id, mixing, packing, quality, simhash, suffix_dedup, token_count,
    toxicity, url_filter, whitening,
)
from dayline.session import configure

BLANK_SQL = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, length(t) AS points, sha256(regexp_replace(t, '{BLANK_SQL}', '', 'g')) AS text_sha256 FROM d)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS kept, text_sha256
FROM n"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out()
    told = language_id.predict(docs, language_id.learn(docs.where(~held)))
    return told.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def _rule_cases(value: str) -> str:
    """Rules from the longest to the shortest, as they decide."""
    longest = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{(h + p) if value == 'rule' else v}'"
        for v, h, p in longest
    )
    return f"CASE {fits} END"


OP3_SQL = rf"""
WITH RECURSIVE
p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
a AS (SELECT *, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
  regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM p),
links AS (
  SELECT host || path AS a, regexp_extract(unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')),
    '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS target FROM a
  UNION ALL
  SELECT host || path, regexp_extract(unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')),
    '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM a),
ends AS (
  SELECT DISTINCT a, translate(regexp_extract(target, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')
    || regexp_extract(target, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS b
  FROM links WHERE contains(target, '://')),
edge AS (SELECT a, b FROM ends WHERE a <> '' AND b <> '' AND a <> b UNION SELECT b, a FROM ends WHERE a <> '' AND b <> '' AND a <> b),
reach(node, other) AS (SELECT a, a FROM edge UNION SELECT r.node, e.b FROM reach r JOIN edge e ON r.other = e.a),
node AS (SELECT DISTINCT a AS address, regexp_extract(a, '(?s)^([^/]*)', 1) AS host, regexp_extract(a, '(?s)^[^/]*(.*)$', 1) AS path FROM edge),
judged AS (SELECT address, {_rule_cases('verdict')} AS v FROM node),
alias AS (
  SELECT r.node AS address, CASE WHEN bool_or(j.v = 'allow') THEN 'allow' ELSE 'block' END AS v
  FROM reach r JOIN judged j ON j.address = r.other WHERE j.v IS NOT NULL GROUP BY 1),
page AS (SELECT page_id, host, path, {_rule_cases('rule')} AS rule, {_rule_cases('verdict')} AS own FROM a)
SELECT page_id, host, path, rule, coalesce(own, alias.v, 'allow') AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN alias.v IS NOT NULL THEN 'alias' ELSE 'default' END AS via
FROM page LEFT JOIN alias ON alias.address = host || path"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = quality.measured(docs)
    return quality.assess(rows, quality.learn(rows, labels))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    told = toxicity.score(docs, toxicity.learn(docs, labels))
    return told.select("doc_id", (toxicity.fold_of() == 0).alias("held_out"), "score", "predicted", "mean", "worst")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.digest(decontamination.occurrences(docs, benchmark))


WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP6_SQL = f"""
WITH b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + {decontamination.WINDOW - 1}], ' ') AS phrase, least(len(w), {decontamination.WINDOW}) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {decontamination.WINDOW - 2}, 2))) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, g.n FROM grams g JOIN win USING (phrase)),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY encode(item_id::VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)"""


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.removed(table(spark, sf_dir, "documents")))


OP7_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * suffix_dedup.LENGTH}) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {suffix_dedup.LENGTH - 1})) AS p FROM d)),
f AS (SELECT doc_id, p, dense_rank() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM w),
g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {suffix_dedup.LENGTH} THEN 1 ELSE 0 END AS cut FROM f WHERE n > 1),
r AS (SELECT doc_id, p, sum(cut) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
spans AS (SELECT doc_id, min(p) AS a, max(p) + {suffix_dedup.LENGTH} AS b FROM r GROUP BY doc_id, run),
parts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
  FROM parts JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("whole", "source")


OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS draw FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS rank FROM s),
c AS (SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][(rank % {len(mixing.WEIGHTS)})::INT + 1] AS weight, source_size * {mixing.EPOCHS} AS cap FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM c),
o AS (SELECT level FROM l WHERE cap >= level * weight ORDER BY cap / weight, rank LIMIT 1),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT level FROM o) * weight) AS target,
    CASE WHEN source_size > 0 THEN floor(least(cap::DOUBLE, (SELECT level FROM o) * weight) / source_size) ELSE 0 END::BIGINT AS whole FROM l),
r AS (
  SELECT doc_id, size, source_size, target, whole, floor(target)::BIGINT - whole * source_size AS extra,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (whole * size + greatest(0, least(size, extra - start)))::BIGINT AS taken FROM r"""


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = f"""
WITH crc AS (
  SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(0, 256) r(i)),
d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
g AS (SELECT {WORDS_SQL} AS w FROM benchmark),
dw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM d) GROUP BY 1),
gw AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM g) GROUP BY 1),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM gw)),
b AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % {importance.BUCKETS} AS bucket FROM v, crc),
counts AS (
  SELECT bucket, coalesce(sum(dw.n), 0) AS s, coalesce(sum(gw.n), 0) AS t
  FROM b LEFT JOIN dw USING (word) LEFT JOIN gw USING (word) GROUP BY 1),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + {importance.BUCKETS})::DOUBLE)
    / ((s + 1)::DOUBLE * (sum(t) OVER () + {importance.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN b USING (word) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    ((('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5)::DOUBLE / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= {importance.LEAST_WORDS})
SELECT doc_id, n_features, weight, score, rank FROM scored
LEFT JOIN (SELECT doc_id, rank FROM ranked WHERE rank <= {importance.PERCENT} * n // 100) USING (doc_id)"""


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


PLANS = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_language_id": (op2_language_id, None),
    "op3_url_filter": (op3_url_filter, OP3_SQL),
    "op4_quality": (op4_quality, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_decontamination": (op6_decontamination, OP6_SQL),
    "op7_suffix_dedup": (op7_suffix_dedup, OP7_SQL),
    "op8_token_counts": (op8_token_counts, None),
    "op9_simhash": (op9_simhash, None),
    "op10_mixing": (op10_mixing, OP10_SQL),
    "op11_importance": (op11_importance, OP11_SQL),
    "op12_packing": (op12_packing, None),
    "op13_whitening": (op13_whitening, None),
}


def queries() -> dict:
    return {name: plan for name, (plan, _) in PLANS.items()}


def oracle_sql() -> dict:
    return {name: sql for name, (_, sql) in PLANS.items() if sql}
