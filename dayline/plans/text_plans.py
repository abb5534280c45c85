"""Scalar functions over documents, pages and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions import similarity, text, topics, urls, values
from dayline.functions.arrow import match_text
from dayline.plans.inputs import PHRASES, fingerprint_sql, quote, sentence_sql, sql_list, squeeze_sql, table, url_sql

D = "documents"


def _docs(spark, sf):
    return table(spark, sf, D).withColumn("body", text.squeeze(F.col("text")))


def squeeze(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5("body").alias("body_md5"), F.length("body").alias("chars"))


def fingerprint(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(text.title_fingerprint(F.col("text"))).alias("fingerprint_md5"))


def content_hash(spark, sf):
    return _docs(spark, sf).select("doc_id", text.content_hash(text.first_sentence(F.col("body"))).alias("content_hash"))


def canonical_url(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical_url"))


def topic_labels(spark, sf):
    d = table(spark, sf, "events")
    names = ["AI_Agent", "open-source", "GPUs", "Policy", "  enterprise   AI ", "Quantum Things", ""]
    raw = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names)).cast("int") + 1)
    return d.select("event_id", topics.topic_key(raw).alias("topic_key"), F.coalesce(topics.topic_label(raw), F.lit("?")).alias("topic_label"))


_TOPIC_SQL = f"""SELECT event_id, CASE n WHEN 0 THEN 'ai agents' WHEN 1 THEN 'developer tools and open source' WHEN 2 THEN 'ai infrastructure' WHEN 3 THEN 'ai safety and governance'
  WHEN 4 THEN 'ai business and market' WHEN 5 THEN 'quantum things' ELSE '' END AS topic_key,
 CASE n WHEN 0 THEN 'AI Agents' WHEN 1 THEN 'Developer Tools and Open Source' WHEN 2 THEN 'AI Infrastructure' WHEN 3 THEN 'AI Safety and Governance'
  WHEN 4 THEN 'AI Business and Market' ELSE '?' END AS topic_label FROM (SELECT event_id, event_id % 7 AS n FROM events)"""

WORDS = ("the", "and", "of", "der", "que", "le", "und er", "it is")


def keyword_match(spark, sf):
    body = F.lower("body")
    alternation = "|".join(WORDS)
    return _docs(spark, sf).select("doc_id", body.rlike(rf"(?<![a-z0-9])(?:{alternation})(?![a-z0-9])").alias("hit"), *[body.rlike(rf"(?<![a-z0-9]){w}(?![a-z0-9])").alias(f"w{i}") for i, w in enumerate(WORDS)])


def first_sentence(spark, sf):
    return _docs(spark, sf).select("doc_id", text.first_sentence(F.col("body")).alias("sentence"))


def token_sets(spark, sf):
    t = similarity.token_set(F.col("body"))
    return _docs(spark, sf).select("doc_id", F.size(t).alias("n"), F.md5(F.array_join(F.sort_array(t), " ")).alias("tokens_md5"))


_TOKENS = f"list_filter(list_distinct(regexp_extract_all(lower(%s), '[a-z0-9]+|[㐀-鿿]')), lambda t: NOT list_contains({sql_list(lexicon.STOP_WORDS)}, t))"


def _pairs(spark, sf):
    """Every conversation turn next to a benchmark passage: numbers go round the passages."""
    b = table(spark, sf, "benchmark").withColumnRenamed("text", "left")
    n = b.agg(F.max("item_id")).first()[0] + 1
    c = table(spark, sf, "conversations").withColumnRenamed("text", "right")
    return b.join(c, b["item_id"] == c["conv_id"] % n)


_PAIRS = """SELECT item_id, conv_id, turn, b.text AS l, c.text AS r FROM benchmark b
  JOIN conversations c ON b.item_id = c.conv_id % (SELECT max(item_id) + 1 FROM benchmark)"""


def jaccard(spark, sf):
    return _pairs(spark, sf).select("item_id", "conv_id", "turn", F.round(similarity.jaccard(similarity.token_set(F.col("left")), similarity.token_set(F.col("right"))), 6).alias("jaccard"))


_JACCARD_SQL = f"""WITH p AS ({_PAIRS}), t AS (SELECT item_id, conv_id, turn, {_TOKENS % 'l'} AS a, {_TOKENS % 'r'} AS b FROM p)
SELECT item_id, conv_id, turn, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard FROM t"""


def entity_overlap(spark, sf):
    words = lambda c: F.split(text.squeeze(F.col(c)), " ")
    return _pairs(spark, sf).select("item_id", "conv_id", "turn", F.round(similarity.overlap(similarity.entity_set(words("left")), similarity.entity_set(words("right"))), 6).alias("overlap"))


_OVERLAP_SQL = f"""WITH p AS ({_PAIRS}), t AS (SELECT item_id, conv_id, turn, list_distinct(string_split(lower({squeeze_sql('l')}), ' ')) AS a0, list_distinct(string_split(lower({squeeze_sql('r')}), ' ')) AS b0 FROM p),
u AS (SELECT item_id, conv_id, turn, list_filter(a0, lambda x: x NOT IN ('', 'ai')) AS a, list_filter(b0, lambda x: x NOT IN ('', 'ai')) AS b FROM t)
SELECT item_id, conv_id, turn, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE len(list_intersect(a, b)) / least(len(a), len(b)) END, 6) AS overlap FROM u"""


def set_algebra(spark, sf):
    a, b = similarity.token_set(F.col("left")), similarity.token_set(F.col("right"))
    return _pairs(spark, sf).select("item_id", "conv_id", "turn", F.size(F.array_intersect(a, b)).alias("n_both"), F.size(F.array_union(a, b)).alias("n_any"), F.size(F.array_except(a, b)).alias("n_left_only"))


_SETS_SQL = f"""WITH p AS ({_PAIRS}), t AS (SELECT item_id, conv_id, turn, {_TOKENS % 'l'} AS a, {_TOKENS % 'r'} AS b FROM p)
SELECT item_id, conv_id, turn, len(list_intersect(a, b)) AS n_both, len(list_distinct(list_concat(a, b))) AS n_any, len(list_filter(a, lambda x: NOT list_contains(b, x))) AS n_left_only FROM t"""


def novelty(spark, sf):
    phrase = lambda shift: F.element_at(F.array(*[F.lit(p) for p in PHRASES]), ((F.col("doc_id") + F.lit(shift)) % len(PHRASES)).cast("int") + 1)
    now, then = similarity.normal(F.concat_ws(" ", text.first_sentence(F.col("body")), phrase(0))), similarity.normal(F.concat_ws(" ", text.first_sentence(F.col("body")), phrase(4)))
    return _docs(spark, sf).select("doc_id", similarity.novelty(now, then, F.lit(0.5)).alias("novel"))


_SPECIFIC = "list_distinct(regexp_extract_all(%s, '(?:gpt|claude|gemini|llama|mistral|opus|sonnet|haiku|codex)?[0-9]+(?:\\.[0-9]+)*[a-z]*|\\$?[0-9]+(?:\\.[0-9]+)?(?:b|m|bn|million|billion|%%)?'))"
_NOVELTY_SQL = f"""WITH d AS (SELECT doc_id, {squeeze_sql('text')} AS body FROM documents),
t AS (SELECT doc_id, lower({sentence_sql('body')} || ' ' || {sql_list(PHRASES)}[(doc_id % 16)::INT + 1]) AS a, lower({sentence_sql('body')} || ' ' || {sql_list(PHRASES)}[((doc_id + 4) % 16)::INT + 1]) AS b FROM d)
SELECT doc_id, len(list_filter({_SPECIFIC % 'a'}, lambda x: NOT list_contains({_SPECIFIC % 'b'}, x))) > 0 OR len(list_filter({sql_list(lexicon.NOVELTY_WORDS)}, lambda w: contains(a, w))) > 0 AS novel FROM t"""


def quote_form(spark, sf):
    return table(spark, sf, D).select("doc_id", F.md5(match_text("text")).alias("quote_md5"))


_QUOTE_SQL = f"""SELECT doc_id, md5(trim(regexp_replace(replace(lower(replace(replace(replace(replace(text, '“', '"'), '”', '"'), '‘', ''''), '’', '''')), 'ß', 'ss'), '\\s+', ' ', 'g'))) AS quote_md5 FROM documents"""


def trims(spark, sf):
    b = F.col("body")
    return _docs(spark, sf).select("doc_id", *[F.md5(text.ellipsis(b, n)).alias(f"trim_{n}") for n in (220, 240, 300)])


_TRIM_SQL = "WITH d AS (SELECT doc_id, " + squeeze_sql("text") + " AS b FROM documents) SELECT doc_id, " + ", ".join(f"md5(CASE WHEN length(b) > {n} THEN b[:{n - 3}] || '...' ELSE b END) AS trim_{n}" for n in (220, 240, 300)) + " FROM d"


def marked_cut(spark, sf):
    out, cut = text.truncate_marked(F.col("body"), 2000)
    return _docs(spark, sf).select("doc_id", F.md5(out).alias("cut_md5"), cut.alias("was_cut"))


_MARKED_SQL = f"WITH d AS (SELECT doc_id, {squeeze_sql('text')} AS b FROM documents) SELECT doc_id, md5(CASE WHEN length(b) > 2000 THEN b[:1988] || chr(10) || '[truncated]' ELSE b END) AS cut_md5, length(b) > 2000 AS was_cut FROM d"


def break_cut(spark, sf):
    out, cut = text.truncate_at_break(F.col("text"), 600)
    return table(spark, sf, D).select("doc_id", F.md5(out).alias("cut_md5"), cut.alias("was_cut"))


_BREAK_SQL = """WITH d AS (SELECT doc_id, text, regexp_replace(text[:600], '\\s+$', '') AS h FROM documents),
p AS (SELECT *, greatest(CASE WHEN contains(h, chr(10) || chr(10)) THEN length(h) - position(chr(10) || chr(10) IN reverse(h)) - 1 ELSE -1 END,
  CASE WHEN contains(h, '. ') THEN length(h) - position(' .' IN reverse(h)) - 1 ELSE -1 END, CASE WHEN contains(h, '。') THEN length(h) - position('。' IN reverse(h)) ELSE -1 END) AS cut_at FROM d)
SELECT doc_id, md5(CASE WHEN length(text) <= 600 THEN text WHEN cut_at > 300 THEN regexp_replace(h[:cut_at + 1], '\\s+$', '') ELSE h END) AS cut_md5, length(text) > 600 AS was_cut FROM p"""


def record_ids(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", text.safe_record_id(F.concat(F.lit("structured-"), F.col("doc_id").cast("string"))).alias("plain_id"), text.safe_record_id(F.concat(F.col("source"), F.lit("/"), text.first_sentence(F.col("body")))).alias("slug_id"))


_RECORD_SQL = f"""WITH d AS (SELECT doc_id, source, {squeeze_sql('text')} AS body FROM documents), k AS (SELECT doc_id, source || '/' || {sentence_sql('body')} AS v FROM d),
s AS (SELECT *, regexp_replace(regexp_replace(v, '[^A-Za-z0-9_.-]+', '-', 'g'), '^[.-]+|[.-]+$', '', 'g') AS slug FROM k)
SELECT doc_id, 'structured-' || doc_id AS plain_id, CASE WHEN slug = '' THEN 'memory-item' ELSE slug[:80] END || '-' || sha256(v)[:12] AS slug_id FROM s"""


def fenced_json(spark, sf):
    kind = F.col("event_id") % 4
    raw = F.when(kind == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(kind == 1, F.col("props")).when(kind == 2, F.concat(F.lit("Answer: "), "props")).otherwise(F.lit("```\n[1, 2]\n```"))
    parsed = text.valid_json(raw)
    return table(spark, sf, "events").select("event_id", parsed.isNotNull().alias("is_json"), F.get_json_object(parsed, "$.k").try_cast("bigint").alias("k"))


_FENCED_SQL = "SELECT event_id, event_id % 4 <> 2 AS is_json, CASE WHEN event_id % 4 IN (0, 1) THEN try_cast(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events"


def specific(spark, sf):
    terms = text.specific_terms(F.col("text"), lexicon.SPECIFIC_TERM_PATTERNS)
    return table(spark, sf, D).select("doc_id", F.array_join(terms, "|").alias("terms"))


def token_estimate(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.word_count(F.col("text")).alias("tokens"))


def cost(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", values.token_cost(text.word_count(F.col("text")), F.lit(100), F.lit(0.0005), F.lit(0.004), F.lit(1000)).alias("cost_usd"))


_COST_SQL = "SELECT conv_id, turn, round(greatest(1, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) / 1000 * 0.0005::DOUBLE + 100 / 1000 * 0.004::DOUBLE, 10) AS cost_usd FROM conversations"


def level_ranks(spark, sf):
    now = F.when(F.col("toxic") == 1, "high").when(F.col("quality") == 1, "Low").otherwise("unknown")
    then = F.when(F.col("doc_id") % 3 == 0, "medium").when(F.col("doc_id") % 3 == 1, "low")
    return table(spark, sf, "labels").select("doc_id", values.level_rank(now).alias("current_rank"), values.direction(values.level_rank(now), values.level_rank(then)).alias("direction"))


_LEVEL_SQL = """WITH r AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 3 WHEN quality = 1 THEN 1 ELSE 0 END AS c, CASE doc_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS h FROM labels)
SELECT doc_id, c AS current_rank, CASE WHEN h <= 0 THEN 'no_historical_baseline' WHEN c - h >= 2 THEN 'much_higher' WHEN c > h THEN 'higher' WHEN c - h <= -2 THEN 'much_lower' WHEN c < h THEN 'lower' ELSE 'stable' END AS direction FROM r"""


def labels(spark, sf):
    level = F.when(F.col("toxic") == 1, "high").when(F.col("quality") == 1, "low").otherwise("odd")
    prose = F.concat(F.lit("risk_level="), level, F.lit(" importance_score: "), F.col("doc_id").cast("string"), F.lit(" is heating_up"))
    return table(spark, sf, "labels").select("doc_id", text.label(level, lexicon.LEVEL_LABELS).alias("label"), text.display_prose(prose, lexicon.LEVEL_LABELS, lexicon.PROSE_STATES).alias("prose"))


_LABEL_SQL = """SELECT doc_id, CASE WHEN toxic = 1 THEN '高' WHEN quality = 1 THEN '低' ELSE 'odd' END AS label,
 CASE WHEN toxic = 1 THEN '风险等级高' WHEN quality = 1 THEN '风险等级低' ELSE 'risk_level=odd' END || ' 关注度评分 ' || doc_id || ' is 升温' AS prose FROM labels"""


def timestamps(spark, sf):
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    shown = (
        F.when(F.col("event_id") % 5 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 5 == 1, F.concat(F.date_format(ts, "E, d MMM yyyy HH:mm:ss"), F.lit(" +0000")))
        .when(F.col("event_id") % 5 == 2, F.concat(F.date_format(ts, "E, d MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(F.col("event_id") % 5 == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+08:00'"))
        .otherwise(F.lit("soon"))
    )
    return table(spark, sf, "events").select("event_id", F.unix_seconds(values.feed_timestamp(shown)).alias("parsed"), F.unix_seconds(values.epoch_timestamp(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))).alias("from_epoch"))


_TIME_SQL = "SELECT event_id, CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN floor(epoch(ts))::BIGINT - 28800 ELSE floor(epoch(ts))::BIGINT END AS parsed, floor(epoch(ts))::BIGINT AS from_epoch FROM events"


def coercion(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, F.get_json_object("props", "$.k")).when(F.col("event_id") % 3 == 1, F.lit("n/a"))
    return table(spark, sf, "events").select("event_id", values.as_int(raw).alias("as_int"), values.as_double(F.col("value").cast("string")).alias("as_double"))


def list_distinct(spark, sf):
    words = text.distinct_ignore_case(F.split(F.col("body"), " "), 12)
    return _docs(spark, sf).select("doc_id", F.array_join(words, " ").alias("first_words")).where("first_words <> ''")


_DISTINCT_SQL = f"""WITH d AS (SELECT doc_id, string_split({squeeze_sql('text')}, ' ') AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
f AS (SELECT doc_id, lower(word) AS k, min(i) AS i, arg_min(word, i) AS word FROM e WHERE word <> '' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n FROM f)
SELECT doc_id, string_agg(word, ' ' ORDER BY n) AS first_words FROM r WHERE n <= 12 GROUP BY doc_id"""

_BODY = f"WITH d AS (SELECT doc_id, {squeeze_sql('text')} AS body FROM documents) SELECT doc_id, "

PLANS = {
    "sc1_squeeze": (squeeze, _BODY + "md5(body) AS body_md5, length(body) AS chars FROM d"),
    "sc2_title_fingerprint": (fingerprint, f"SELECT doc_id, md5({fingerprint_sql('text')}) AS fingerprint_md5 FROM documents"),
    "sc3_content_hash": (content_hash, _BODY + f"sha256({fingerprint_sql(sentence_sql('body'))}) AS content_hash FROM d"),
    "sc4_canonical_url": (canonical_url, f"SELECT page_id, {url_sql('url')} AS canonical_url FROM pages"),
    "sc5_topic_key": (topic_labels, _TOPIC_SQL),
    "sc6_keyword_match": (
        keyword_match,
        _BODY + ", ".join([f"regexp_matches(lower(body), '(^|[^a-z0-9])({'|'.join(WORDS)})([^a-z0-9]|$)') AS hit"] + [f"regexp_matches(lower(body), '(^|[^a-z0-9]){w}([^a-z0-9]|$)') AS w{i}" for i, w in enumerate(WORDS)]) + " FROM d",
    ),
    "sc7_first_sentence": (first_sentence, _BODY + f"{sentence_sql('body')} AS sentence FROM d"),
    "sc8_token_set": (token_sets, f"WITH t AS (SELECT doc_id, {_TOKENS % squeeze_sql('text')} AS t FROM documents) SELECT doc_id, len(t) AS n, md5(array_to_string(list_sort(t), ' ')) AS tokens_md5 FROM t"),
    "sc9_jaccard": (jaccard, _JACCARD_SQL),
    "sc11_entity_overlap": (entity_overlap, _OVERLAP_SQL),
    "sc12_novelty": (novelty, _NOVELTY_SQL),
    "sc13_quote_form": (quote_form, _QUOTE_SQL),
    "sc14_ellipsis": (trims, _TRIM_SQL),
    "sc15_marked_cut": (marked_cut, _MARKED_SQL),
    "src15_break_cut": (break_cut, _BREAK_SQL),
    "sc16_record_id": (record_ids, _RECORD_SQL),
    "sc17_fenced_json": (fenced_json, _FENCED_SQL),
    "sc18_specific_terms": (specific, None),
    "sc19_token_estimate": (token_estimate, "SELECT conv_id, turn, greatest(1, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) AS tokens FROM conversations"),
    "sc20_cost": (cost, _COST_SQL),
    "sc21_level_direction": (level_ranks, _LEVEL_SQL),
    "sc22_display_labels": (labels, _LABEL_SQL),
    "sc23_timestamps": (timestamps, _TIME_SQL),
    "sc26_coercion": (coercion, "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN coalesce(try_cast(json_extract_string(props, '$.k') AS BIGINT), 0) ELSE 0 END AS as_int, value AS as_double FROM events"),
    "set2_set_algebra": (set_algebra, _SETS_SQL),
    "dd4_ordered_distinct": (list_distinct, _DISTINCT_SQL),
}
__all__ = ["PLANS", "quote"]
