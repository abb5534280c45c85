"""Mixing sources to target weights by capped water-filling.

Sources share the words by weight; none gets more than ``epochs`` times what it has, and
what it can't take goes to the others by weight.  Every document of a source is then taken
the whole times that the source's share allows, and a seeded draw decides which documents
are taken once more; the document at the end of the draw is taken in part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayline.llm.common import match_rows, shared

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 42
#: Hexadecimal digits of the draw that number its slots: 4,096 slots of a source are summed apart.
SLOT_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def water_fill(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sizes(source, source_size, weight)`` with ``target``: the level that caps and weights leave.

    A source is capped when ``epochs * size / weight`` is below the water level.  Sources in the
    order of that ratio are capped one after another, and the first level that the next one
    exceeds is right, so no rounds are needed.  One row per source is sorted in one task.
    """
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    below, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = (
        sizes.withColumn("cap", F.col("source_size") * epochs)
        .withColumn("_level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum("weight").over(rest))
        .withColumn("_open", F.col("cap") >= F.col("_level") * F.col("weight"))
        .withColumn("_level", F.min(F.when(F.col("_open"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("_level")))).over(everything)["_level"])
    )
    return filled.withColumn(
        "target", F.least(F.col("cap").cast("double"), F.col("_level") * F.col("weight"))
    ).drop("_level", "_open", "rank")


def weighted_sources(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``sizes(source, source_size)`` with ``rank`` (by code point, null last) and the weight of that rank."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    wheel = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    return ranked.withColumn("weight", F.element_at(wheel, (F.col("rank") % len(weights) + 1).cast("int")))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, whole, taken)`` per row of ``docs(doc_id, text, source)``.

    ``taken`` words of a document are ``whole`` repetitions of all of it and a further draw of
    all, part or none; of a source they are its target, rounded down.  Null and empty texts
    have size 0 and are taken 0 times; a null source is a source of its own, the last.  Repeated rows are
    separate documents.  If all sizes are 0 every target is 0.  An empty table gives no rows.
    """
    rows = shared(docs.select(
        "doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("draw"),
    ).withColumn("slot", F.substring("draw", 1, SLOT_DIGITS)))
    slots = rows.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    sources = slots.groupBy("source").agg(F.sum("slot_size").alias("source_size"))
    sources = water_fill(weighted_sources(sources, weights), epochs)
    sources = shared(
        sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("extra", F.floor("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "extra")
    )
    before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = slots.withColumn("slot_start", F.coalesce(F.sum("slot_size").over(before), F.lit(0)))
    placed = match_rows(placed, sources, ["source"])
    # Of a slot, all documents are taken once more, or none; only the slot at the end is ordered.
    room = F.col("extra") - F.col("slot_start")
    placed = shared(placed.select("source", "slot", "source_size", "target", "whole", room.alias("room"), (room >= F.col("slot_size")).alias("all_of_slot")))
    known = match_rows(rows, placed, ["source", "slot"])
    at_end = (F.col("room") > 0) & ~F.col("all_of_slot")
    once = F.when(F.col("all_of_slot"), F.col("size")).otherwise(F.lit(0))
    order = Window.partitionBy("source", "slot").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("room") - F.coalesce(F.sum("size").over(order), F.lit(0))
    ordered = known.where(at_end).withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), left)))
    done = known.where(~at_end).withColumn("more", once).unionByName(ordered)
    return done.select(
        "doc_id", "source", "size", "source_size", "target", "whole", (F.col("whole") * F.col("size") + F.col("more")).cast("long").alias("taken")
    )


OWN = ("mix_size", "mix_target", "mix_whole", "mix_extra", "mix_taken")


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with the plan of each; documents that the mix takes no word of are left out.

    A reader takes a document ``mix_whole`` times whole and then its first ``mix_extra`` words, which makes
    ``mix_taken`` of its ``mix_size`` words; ``mix_target`` is what its source is to have.  Columns of those names are
    replaced.  A ``doc_id`` names one document: rows that share one share its plan.
    """
    made = mix(docs, **parameters).withColumn("extra", F.col("taken") - F.col("whole") * F.col("size"))
    plan = made.groupBy("doc_id").agg(*[F.max(c[4:]).alias(c) for c in OWN]).where("mix_taken > 0")
    rows = docs.drop(*OWN)
    key = "_planned" + "_" * max(map(len, rows.columns))  # longer than any column's name
    plan = plan.withColumnRenamed("doc_id", key)
    return rows.join(plan, rows["doc_id"].eqNullSafe(plan[key])).drop(key)
