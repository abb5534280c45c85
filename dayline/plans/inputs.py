"""The given tables in the roles of the operators, in Spark and, independently, in SQL.

Nothing here is sampled or cut: every frame has one row per row of its table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.once import let, once
from dayline.functions.text import first_sentence, squeeze
from dayline.operators.clean import identity, on_report_date, require_fields
from dayline.operators.extract import structure
from dayline.operators.memory import retrieve, to_entries
from dayline.session import checkpoint_folder

# Summaries give every rule of the vocabularies something to match.
PHRASES = (
    "OpenAI announces GPT-5.2 model training on a GPU cluster for ai workload inference.",
    "New AI Act policy targets generative ai safety audits and training data.",
    "Researchers publish a benchmark paper on multimodal reasoning with Google DeepMind.",
    "Startup launches agent platform for enterprise developer workflow.",
    "Smartphone camera launch adds a gemini photo feature.",
    "Anthropic raises funding at a higher valuation for an ai lab.",
    "Cloud region opens a data center with ai cloud services.",
    "General privacy bill raises regulation concern for consumers.",
    "Music game studio talks about movie travel.",
    "Partnership with NVIDIA and Microsoft expands open source framework adoption.",
    "人工智能 大模型 发布 智能体 平台",
    "该云服务没有明确的大模型训练任务",
    "Lawsuit and complaint over a security risk and breach at Meta.",
    "The model is used as a tool in a study.",
    "Chip maker ships 20% more H100 units.",
    "Quarterly customer revenue update for the market.",
)


_stages: dict[tuple, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _changed(spark: SparkSession, sf: str) -> int:
    """When the documents last changed: a stage of older ones isn't read again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/documents.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime()


def stage(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A stage table: written once per session and state of the input, then read by every later step.

    Steps hand each other tables, so a text is cleaned and classified once, however many
    reports are made from it.
    """
    key = (spark.sparkContext.applicationId, sf, _changed(spark, sf), name)
    if key not in _stages:
        path = f"{checkpoint_folder(spark)}/stage-{name}-{uuid.uuid4().hex}"
        build(spark, sf).write.parquet(path)
        _stages[key] = path
    return spark.read.parquet(_stages[key])


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw items of 30 report dates, with blanks, off-date items and URL variants."""
    d = once(table(spark, sf, "documents"), {"_title": let(first_sentence(F.col("text")), squeeze)})
    n = F.col("doc_id")
    host, page = F.col("source"), F.col("n_chars").cast("string")
    mark = (n % 2).cast("string")
    url = (
        F.when(n % 41 == 0, F.lit(""))
        .when(n % 3 == 0, F.concat(F.lit("https://"), host, F.lit(".example.com/"), F.col("lang"), F.lit("/"), page, F.lit("?utm_source=feed&id="), mark))
        .when(n % 3 == 1, F.concat(F.lit("HTTPS://"), F.upper(host), F.lit(".Example.com:443/"), F.col("lang"), F.lit("/"), page, F.lit("/?id="), mark, F.lit("#top")))
        .otherwise(F.concat(F.lit("https://"), host, F.lit(".example.com/"), F.col("lang"), F.lit("/"), page, F.lit("?id="), mark, F.lit("&ref=x")))
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (n % 30).cast("int"))
    hours = ((n % 29) - 2).cast("int")
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (n % len(PHRASES)).cast("int") + 1)
    return d.select(
        n.alias("pos"), F.concat(F.lit("raw-"), n.cast("string")).alias("id"), F.when(n % 37 == 0, F.lit("  ")).otherwise(F.col("_title")).alias("title"), host.alias("source"), url.alias("url"),
        (day.cast("timestamp") + F.make_dt_interval(hours=hours)).alias("published_at"),
        F.when(F.col("lang") == "en", "blog").when(F.col("lang") == "de", "news").when(F.col("lang") == "fr", "research").otherwise("release").alias("source_type"),
        F.when(F.col("lang") == "en", "en").otherwise("other").alias("language"), F.when(n % 5 == 4, F.lit("")).otherwise(phrase).alias("summary"), F.col("text").alias("content"),
        F.create_map(
            F.lit("content_source"), F.when(n % 3 == 0, "article_html").otherwise("rss_feed"), F.lit("source_family"), F.when(host == "src0", "aggregator").otherwise("media"), F.lit("fetched_via"), F.when(n % 4 == 0, "rss").otherwise("file"),
            F.lit("full_content_error"), F.when(n % 10 == 0, "extracted_text_too_short").when(n % 10 == 1, "non_http_url").otherwise(""),
        ).alias("metadata"),
        day.alias("report_date"),
    )


def clean_items(spark: SparkSession, sf: str) -> DataFrame:
    """Complete items on their report date, with identity keys."""
    return identity(on_report_date(require_fields(raw(spark, sf))))


def structured_items(spark: SparkSession, sf: str) -> DataFrame:
    return structure(clean(spark, sf))


def retrieved_history(spark: SparkSession, sf: str) -> DataFrame:
    return retrieve(history(spark, sf), structured(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return stage(spark, sf, "clean", clean_items)


def structured(spark: SparkSession, sf: str) -> DataFrame:
    return stage(spark, sf, "structured", structured_items)


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Every structured item as a history entry (report dates read the days before them)."""
    return to_entries(structured(spark, sf)).drop("report_date")


def retrieved(spark: SparkSession, sf: str) -> DataFrame:
    return stage(spark, sf, "retrieved", retrieved_history)


# --- the same frames in SQL --------------------------------------------------------
def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def any_word(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {quote(w)})" for w in words) + ")"


def squeeze_sql(col: str) -> str:
    return f"trim(regexp_replace(coalesce({col}, ''), '\\s+', ' ', 'g'))"


def sentence_sql(col: str) -> str:
    """First sentence of an already squeezed text."""
    return f"CASE WHEN regexp_matches({col}, '[.!?。！？] ') THEN regexp_extract({col}, '^(.*?[.!?。！？]) ', 1) ELSE {col} END"


def fingerprint_sql(col: str) -> str:
    return f"trim(regexp_replace(lower({col}), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def url_sql(col: str) -> str:
    """Canonical form of a URL column."""
    part = lambda group: f"regexp_extract({col}, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\\?([^#]*))?(#.*)?$', {group})"
    scheme, host, path, query = f"lower({part(1)})", f"lower({part(2)})", part(3), part(5)
    keys = sql_list(lexicon.TRACKING_KEYS)
    pairs = (
        f"list_sort(list_transform(list_filter(string_split({query}, '&'), lambda p: p <> '' AND NOT list_contains({keys}, lower(split_part(p, '=', 1))) "
        f"AND NOT starts_with(lower(p), 'utm_')), lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END))"
    )
    q = f"array_to_string({pairs}, '&')"
    clean_host = f"CASE WHEN {scheme} = 'http' THEN regexp_replace({host}, ':80$', '') WHEN {scheme} = 'https' THEN regexp_replace({host}, ':443$', '') ELSE {host} END"
    clean_path = f"CASE WHEN {path} IN ('', '/') THEN '/' ELSE regexp_replace({path}, '/+$', '') END"
    return (
        f"CASE WHEN {col} = '' THEN '' WHEN {part(1)} = '' OR {part(2)} = '' THEN lower({col}) "
        f"ELSE {scheme} || '://' || {clean_host} || {clean_path} || CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END END"
    )


RAW_SQL = f"""
doc AS (SELECT doc_id, lang, source, n_chars, text, {squeeze_sql('text')} AS body FROM documents),
raw AS (
  SELECT doc_id AS pos, 'raw-' || doc_id AS id,
    CASE WHEN doc_id % 37 = 0 THEN '  ' ELSE {sentence_sql('body')} END AS title, source,
    CASE WHEN doc_id % 41 = 0 THEN ''
      WHEN doc_id % 3 = 0 THEN 'https://' || source || '.example.com/' || lang || '/' || n_chars || '?utm_source=feed&id=' || (doc_id % 2)
      WHEN doc_id % 3 = 1 THEN 'HTTPS://' || upper(source) || '.Example.com:443/' || lang || '/' || n_chars || '/?id=' || (doc_id % 2) || '#top'
      ELSE 'https://' || source || '.example.com/' || lang || '/' || n_chars || '?id=' || (doc_id % 2) || '&ref=x' END AS url,
    TIMESTAMP '2024-01-01' + to_days((doc_id % 30)::INT) + to_hours((doc_id % 29) - 2) AS published_at,
    CASE lang WHEN 'en' THEN 'blog' WHEN 'de' THEN 'news' WHEN 'fr' THEN 'research' ELSE 'release' END AS source_type,
    CASE lang WHEN 'en' THEN 'en' ELSE 'other' END AS language,
    CASE WHEN doc_id % 5 = 4 THEN '' ELSE {sql_list(PHRASES)}[(doc_id % {len(PHRASES)})::INT + 1] END AS summary,
    body AS content,
    CASE WHEN doc_id % 3 = 0 THEN 'article_html' ELSE 'rss_feed' END AS content_source,
    CASE WHEN source = 'src0' THEN 'aggregator' ELSE 'media' END AS source_family,
    CASE WHEN doc_id % 4 = 0 THEN 'rss' ELSE 'file' END AS fetched_via,
    CASE doc_id % 10 WHEN 0 THEN 'extracted_text_too_short' WHEN 1 THEN 'non_http_url' ELSE '' END AS full_content_error,
    DATE '2024-01-01' + (doc_id % 30)::INT AS report_date
  FROM doc)"""

CLEAN_SQL = f"""{RAW_SQL},
clean AS (
  SELECT *, {url_sql('url')} AS canonical_url, {fingerprint_sql('title')} AS title_fingerprint, sha256({fingerprint_sql('title')}) AS content_hash
  FROM raw
  WHERE trim(title) <> '' AND source <> '' AND url <> '' AND (summary <> '' OR content <> '') AND published_at::DATE = report_date)"""


def _cases(rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {condition} THEN {quote(value)}" for condition, value in rules) + f" ELSE {quote(default)} END"


def _structured_sql() -> str:
    L = lexicon
    b = "lbody"
    topic = _cases([(any_word(b, w), t) for t, w in L.TOPIC_WORDS.items()], L.TOPICS[-1])
    released = any_word(b, L.RELEASE_WORDS)
    event = _cases(
        [(any_word(b, w), e) for e, w in L.EVENT_WORDS.items()] + [(f"{released} AND (contains({b}, 'model') OR source_type = 'release')", "model_release"), (released, "product_launch")], "market"
    )
    scope = _cases([("event_type = 'policy'", "policy"), ("event_type = 'funding'", "capital"), ("event_type = 'security'", "security")] + [(any_word(b, w), s) for s, w in L.SCOPE_WORDS.items()], "ecosystem")
    risk = _cases([(f"event_type IN ('controversy', 'security') OR {any_word(b, L.HIGH_RISK_WORDS)}", "high"), (f"event_type = 'policy' OR {any_word(b, L.MEDIUM_RISK_WORDS)}", "medium")], "low")
    chance = _cases([(f"event_type IN ('model_release', 'product_launch', 'partnership') OR {any_word(b, L.HIGH_OPPORTUNITY_WORDS)}", "high"), ("event_type IN ('research', 'market')", "medium")], "low")
    mood = _cases(
        [("risk_level = 'high' AND opportunity_level = 'high'", "mixed"), ("risk_level = 'high'", "negative"), (any_word(b, L.MIXED_SENTIMENT_WORDS), "mixed"), ("opportunity_level = 'high'", "positive")], "neutral"
    )
    score = (
        "least(100, 50 + CASE WHEN source_type IN ('blog', 'release', 'research') THEN 8 ELSE 0 END + CASE WHEN event_type IN ('model_release', 'product_launch') THEN 14 ELSE 0 END"
        " + CASE WHEN event_type IN ('policy', 'security') THEN 12 ELSE 0 END + CASE WHEN event_type = 'partnership' THEN 8 ELSE 0 END"
        f" + CASE WHEN {any_word(b, L.BIG_NAME_WORDS)} THEN 10 ELSE 0 END + CASE WHEN {any_word(b, L.MOMENTUM_WORDS)} THEN 6 ELSE 0 END"
        " + CASE risk_level WHEN 'high' THEN 8 WHEN 'medium' THEN 4 ELSE 0 END)"
    )
    names = "[" + ", ".join(f"CASE WHEN regexp_matches(full_text, '\\b{n}\\b') THEN {quote(n)} END" for n in L.ENTITY_NAMES) + "]"
    hint = "CASE WHEN trim(evidence) = '' THEN " + quote(L.NO_EVIDENCE_HINT) + " " + " ".join(f"WHEN {any_word('lower(evidence)', w)} THEN {quote(h)}" for w, h in L.EVIDENCE_HINTS) + f" ELSE {quote(L.DEFAULT_EVIDENCE_HINT)} END"
    phrase = lambda col, phrases, default: f"CASE {col} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in phrases.items()) + f" ELSE {quote(default)} END"
    return f"""{CLEAN_SQL},
s1 AS (SELECT *, title || ' ' || summary || ' ' || content AS full_text, lower(title || ' ' || summary || ' ' || content) AS lbody,
  {sentence_sql('content')} AS first_content, {sentence_sql('summary')} AS first_summary FROM clean),
s2 AS (SELECT *, {topic} AS topic, {event} AS event_type, list_filter({names}, lambda x: x IS NOT NULL) AS names,
  CASE WHEN first_content <> '' THEN first_content WHEN summary <> '' THEN summary ELSE title END AS evidence FROM s1),
s3 AS (SELECT *, {scope} AS impact_scope, {risk} AS risk_level, {chance} AS opportunity_level FROM s2),
s4 AS (SELECT *, {mood} AS sentiment, {score} AS importance_score, {hint} AS hint, {phrase('event_type', L.EVENT_PHRASES, '事件')} AS ep, {phrase('impact_scope', L.SCOPE_PHRASES, '相关方向')} AS sp FROM s3),
structured AS (
  SELECT pos, replace(id, 'raw-', 'structured-') AS id, id AS raw_id, title, source, url, published_at, report_date, source_type, language, topic,
    CASE WHEN len(names) = 0 THEN ['AI industry'] ELSE names END AS entities, event_type,
    CASE WHEN summary <> '' THEN summary WHEN first_content <> '' THEN first_content ELSE title END AS summary, summary AS raw_summary, content,
    first_content, first_summary, evidence, sentiment, impact_scope, importance_score, risk_level, opportunity_level, content_hash, canonical_url,
    content_source, source_family, fetched_via,
    CASE WHEN content <> '' THEN 'content' WHEN summary <> '' THEN 'summary' ELSE 'title' END AS evidence_field,
    CASE WHEN importance_score >= 85 THEN topic || ' 的' || ep || '直接影响' || sp || '，' || hint
      WHEN importance_score >= 70 THEN topic || ' 的' || ep || '已显示明确' || sp || '影响，' || hint
      WHEN importance_score >= 50 THEN topic || ' 的' || ep || '具备跟踪价值，但影响范围仍需验证' ELSE '当前证据有限，' || topic || ' 相关影响仍不清晰' END AS importance_rationale,
    CASE risk_level WHEN 'high' THEN ep || '涉及' || sp || '高风险，' || hint WHEN 'medium' THEN ep || '仍有' || sp || '不确定性，' || hint
      ELSE '低：材料未显示突出风险，主要证据集中在' || sp || '进展' END AS risk_rationale,
    CASE opportunity_level WHEN 'high' THEN ep || '强化' || sp || '机会，' || hint WHEN 'medium' THEN ep || '可能带来' || sp || '机会，但落地效果待观察'
      ELSE '低：新闻重点不在机会扩张，' || sp || '增量有限' END AS opportunity_rationale
  FROM s4)"""


STRUCTURED_SQL = _structured_sql()

# Newest ten entries per report date and topic of the seven days up to its end, without entries
# that share a key with a current item of the date.
RETRIEVED_SQL = f"""{STRUCTURED_SQL},
dated AS (SELECT s.*, unnest(range(0, 7)) AS ahead FROM structured s),
offered AS (SELECT * EXCLUDE (report_date, ahead), (published_at::DATE + ahead::INT)::DATE AS report_date FROM dated),
asked AS (SELECT DISTINCT report_date, topic FROM structured),
current_keys AS (SELECT DISTINCT report_date, unnest([id, url, content_hash]) AS k FROM structured),
fresh AS (
  SELECT o.* FROM offered o JOIN asked USING (report_date, topic)
  WHERE NOT EXISTS (SELECT 1 FROM current_keys c WHERE c.report_date = o.report_date AND c.k = o.id)
    AND NOT EXISTS (SELECT 1 FROM current_keys c WHERE c.report_date = o.report_date AND c.k = o.raw_id)
    AND NOT EXISTS (SELECT 1 FROM current_keys c WHERE c.report_date = o.report_date AND c.k = o.url)
    AND NOT EXISTS (SELECT 1 FROM current_keys c WHERE c.report_date = o.report_date AND c.k = o.content_hash)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY report_date, topic ORDER BY published_at DESC, pos, id) AS rank FROM fresh),
retrieved AS (SELECT *, id AS memory_item_id, lower(topic) AS topic_key FROM ranked WHERE rank <= 10)"""
