"""Article bodies from landed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions import markup
from dayline.functions.once import once
from dayline.functions.text import contains_any, strip, truncate_at_break
from dayline.functions.urls import is_http_url

_CJK = "[㐀-䶿一-鿿豈-﫿]"


def is_useful(block: Column) -> Column:
    """Enough words (or CJK characters), no boilerplate phrase, long enough or a sentence."""
    words = F.size(F.split(block, " "))
    cjk = F.length(block) - F.length(F.regexp_replace(block, _CJK, ""))
    sentence = block.rlike(r"[.!?。！？]\z")
    return (
        ((words >= 5) | (cjk >= 12))
        & ~contains_any(F.lower(block), lexicon.BOILERPLATE_PHRASES)
        & ((F.length(block) >= 35) | sentence)
    )


def _joined(blocks: DataFrame, source: str, out: str) -> DataFrame:
    """Drop repeats (ignoring case) inside the page and join in document order.

    Sorting by text puts repeats side by side, so a page of n blocks costs n log n and
    nothing is shuffled.
    """
    entry = F.transform(source, lambda b: F.struct(F.lower(b["block"]).alias("k"), b["pos"].alias("pos"), b["block"].alias("block")))
    ordered = blocks.withColumn("_sorted", F.sort_array(entry))
    kept = ordered.withColumn("_kept", F.zip_with("_sorted", F.concat(F.array(F.lit(None).cast("string")), F.transform("_sorted", lambda e: e["k"])), lambda e, before: F.struct(e["pos"].alias("pos"), e["block"].alias("block"), (before.isNull() | (before != e["k"])).alias("first"))))
    first = F.sort_array(F.filter("_kept", lambda e: e["first"] & e["block"].isNotNull()))
    return kept.withColumn(out, F.array_join(F.transform(first, lambda e: e["block"]), "\n\n")).drop("_sorted", "_kept")


def article_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Article text per page: the container's blocks when they carry enough, else all blocks.

    ``article_error`` says why a page has none to read, and its text is null then; a page whose blocks are
    all of no use has an empty text.  Reading, filtering, dedupe and choice are column expressions over one page.
    """
    if html not in pages.columns:
        raise ValueError(f"pages have no column {html!r}")
    rows = markup.with_blocks(pages, html, "_all", "article_error").drop(html)
    rows = once(rows, {"_all": F.filter("_all", lambda b: is_useful(b["block"]))})
    rows = rows.withColumn("_in", F.filter("_all", lambda b: b["in_container"]))
    rows = _joined(_joined(rows, "_all", "_all_text"), "_in", "_in_text")
    enough = F.length("_in_text") >= F.least(F.lit(400), F.length("_all_text"))
    text = F.when(F.col("article_error").isNull(), F.when(enough, F.col("_in_text")).otherwise(F.col("_all_text")))
    return rows.withColumns({"article_text": text, "block_count": F.size("_all")}).drop("_all", "_in", "_all_text", "_in_text")


def choose_body(rows: DataFrame, min_chars: int = 400, max_chars: int | None = None, enabled: bool = True) -> DataFrame:
    """Extracted article or fallback text, with the reason for a fallback.

    ``rows``: url, fallback, fallback_source, fetch_error, content_type, extracted.
    """
    fallback = strip(F.col("fallback"))
    extracted = F.coalesce("extracted", F.lit(""))
    kind = F.coalesce("content_type", F.lit(""))
    error = (
        F.when(F.lit(not enabled), F.lit(None).cast("string"))
        .when(~is_http_url(F.col("url")), "non_http_url")
        .when(F.coalesce("fetch_error", F.lit("")) != "", F.col("fetch_error"))
        .when((kind != "") & ~F.contains(F.lower(kind), F.lit("html")), F.concat(F.lit("unsupported_content_type: "), kind))
        .when(F.length(extracted) < min_chars, "extracted_text_too_short")
        .when(F.length(extracted) <= F.length(fallback), "extracted_text_not_longer_than_fallback")
    )
    text, cut = truncate_at_break(extracted, max_chars)
    out = rows.withColumn("full_content_error", error)
    use = F.lit(enabled) & F.col("full_content_error").isNull()
    out = out.withColumns({"content": F.when(use, text).otherwise(fallback), "content_source": F.when(use, "article_html").otherwise(F.col("fallback_source")), "content_truncated": F.when(use, cut)})
    return out.withColumn("content_chars", F.length("content"))
