"""Exact deduplication by content-defined chunk recipes.

Each normalised text is cut into chunks at places that only the bytes around them decide.
A chunk is known by a 64-bit identifier.  All distinct chunks are grouped once to verify the
identifiers: where different chunks share one, they get an ordinal besides.  A document is
then the ordered list of its verified identifiers, its recipe, and only recipes are compared,
so no document moves as a whole, and a chunk that many documents hold moves once per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.common import BLANKS, content, match_rows, shared

#: Bytes of a chunk, at least and at most (but for the last chunk of a text).
LEAST, MOST = 256, 8192
#: A cut falls behind three bytes of these classes, about once in a thousand bytes of prose.
CUT_CLASSES = ("bdfgimnu", "acehiort", "delnprst")


def normalised(text: Column) -> Column:
    """The text without blanks; texts are equal when these are."""
    return F.regexp_replace(text, f"{BLANKS}+", "")


def _byte_class(letters: str) -> str:
    """A fixed eighth of all other bytes stands beside the letters, so that every script has cuts."""
    others = "".join(f"\\x{b:02X}" for b in range(0x80, 0x100) if (b * 37 + len(letters) + ord(letters[0])) % 4 == 0)
    return f"[{letters}{others}]"


def chunk_pattern(least: int = LEAST, most: int = MOST) -> str:
    """Shortest piece of at least ``least`` bytes that ends in a cut; else ``most`` bytes or the rest."""
    cut = "".join(_byte_class(c) for c in CUT_CLASSES)
    return f"(?s).{{{least},{most}}}?(?<={cut})|.{{1,{most}}}"


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """Chunks of a text in order; each character stands for one UTF-8 byte."""
    as_bytes = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.regexp_extract_all(as_bytes, F.lit(chunk_pattern(least, most)), F.lit(0))


def verified_identifiers(pieces: DataFrame) -> DataFrame:
    """``(chunk_id, chunk)`` -> ``(chunk_id, chunk, ordinal)`` of identifiers that several chunks share.

    Every distinct chunk takes part; the result is empty when all identifiers are unique.
    """
    distinct = pieces.distinct()
    held = distinct.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    clash = distinct.join(held.select("chunk_id"), "chunk_id", "left_semi")
    order = Window.partitionBy("chunk_id").orderBy("chunk")
    return clash.select("chunk_id", "chunk", F.row_number().over(order).alias("ordinal"))


def recipes(
    docs: DataFrame,
    identify: Callable[[Column], Column] = F.xxhash64,
    least: int = LEAST,
    most: int = MOST,
) -> DataFrame:
    """``(doc_id, points, text_sha256, recipe)`` per row of ``docs``; the recipe is a list of identifiers."""
    texts = docs.select("doc_id", content().alias("_text")).select(
        "doc_id",
        F.length("_text").cast("long").alias("points"),
        normalised(F.col("_text")).alias("_norm"),
    )
    cut = texts.withColumn("_chunks", chunks(F.col("_norm"), least, most))
    pieces = cut.select(F.explode("_chunks").alias("chunk")).select(identify(F.col("chunk")).alias("chunk_id"), "chunk")
    clashes = shared(verified_identifiers(pieces))
    made = cut.select(
        "doc_id", "points", F.sha2("_norm", 256).alias("text_sha256"),
        F.transform("_chunks", lambda c: F.struct(identify(c).alias("chunk_id"), F.lit(0).alias("ordinal"))).alias("recipe"),
    )
    if clashes.isEmpty():
        return made
    # Identifiers that several chunks share: the chunk itself decides its ordinal.
    rows = cut.select("doc_id", "points", F.sha2("_norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("_row"), "_chunks")
    rows = rows.select("doc_id", "points", "text_sha256", "_row", F.posexplode_outer("_chunks").alias("_pos", "chunk"))
    rows = rows.withColumn("chunk_id", identify(F.col("chunk")))
    ranked = match_rows(rows, clashes, ["chunk_id", "chunk"], "left")
    step = F.struct("_pos", "chunk_id", F.coalesce("ordinal", F.lit(0)).alias("ordinal"))
    return (
        ranked.groupBy("_row", "doc_id", "points", "text_sha256")
        .agg(F.sort_array(F.collect_list(F.when(F.col("_pos").isNotNull(), step))).alias("_steps"))
        .select(
            "doc_id", "points", "text_sha256",
            F.transform("_steps", lambda s: F.struct(s["chunk_id"].alias("chunk_id"), s["ordinal"].alias("ordinal"))).alias("recipe"),
        )
    )


def exact_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the group of equal texts it is in and who stays.

    Null and empty texts, and texts of blanks alone, are equal: their recipe has no chunk.  The
    row with the most code points in its original text stays, of those the smallest ``doc_id``
    (null last).  Rows that repeat the ``doc_id`` that stays are all marked as kept.  An empty
    table gives no rows; other columns of ``docs`` are not read.
    """
    made = shared(recipes(docs, **parameters))
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d")))
    groups = made.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), best.alias("_best"))
    groups = groups.select("recipe", "group_size", F.col("_best.d").alias("keep_id"))
    return match_rows(made, groups, ["recipe"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        F.size("recipe").alias("n_chunks"),
    )


def drop_exact_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a ``doc_id`` names one document."""
    kept = exact_duplicates(docs, **parameters).where("kept").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
