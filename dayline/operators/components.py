"""Iterative graph operators over item-key edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayline.operators.groups import lookup
from dayline.session import append, discard, durable

#: Rounds of contraction that keep one order of the nodes.
SAME_ORDER = 4


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node per node: ``edges(a, b)`` -> ``(node, component)``.

    Local contraction (Lacki et al., "Connected Components at Scale via Local Contractions"): in a random
    order every node moves to the first of itself and its neighbours, then on to where that one moved, and only
    links between different such nodes go on.  Links shrink by a factor a round whatever the diameter, so
    all rounds together cost little more than the first, and finished components cost nothing more.  A star
    is done soonest in one order, ties and unlucky chains need another, so the order changes every few rounds.
    In the end the moves are followed from the last round back.  A hot node's first neighbour is a
    partial aggregate, and the joins can split it.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    links = durable(edges.where("a <> b").select(*ends).distinct())
    moves = []
    while not links.isEmpty():
        order = lambda c: F.xxhash64(c, F.lit(len(moves) // SAME_ORDER))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min_by("b", order("b")).alias("b"))
        to = F.when(order("b") < order("a"), F.col("b")).otherwise(F.col("a"))
        step = durable(first.select(F.col("a").alias("node"), to.alias("to")))
        onward = step.select(F.col("node").alias("to"), F.col("to").alias("_to"))
        moves.append(durable(lookup(step, onward, ["to"], "inner").select("node", F.col("_to").alias("to"))))
        discard(step)
        moved = links
        for end in ("a", "b"):
            of = moves[-1].select(F.col("node").alias(end), F.col("to").alias("_to"))
            moved = lookup(moved, of, [end], "inner").withColumn(end, F.col("_to")).drop("_to")
        done, links = links, durable(moved.where("a <> b").select(*ends).distinct())
        discard(done)
    discard(links)
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    met = moves[-1]
    for before in reversed(moves[:-1]):
        further = met.select(F.col("node").alias("to"), F.col("to").alias("_to"))
        met = lookup(before, further, ["to"], "left").select("node", F.coalesce("_to", "to").alias("to"))
    met = durable(met)
    for done in moves:
        discard(done)
    least = met.groupBy("to").agg(F.min("node").alias("component"))
    return durable(lookup(met, least, ["to"], "inner").select("node", "component"))


def contract(known: DataFrame | None, edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` with the roots ``x``, ``y`` that known components give their ends, and whether they are known."""
    met = edges.where("a <> b").select("a", "b").distinct()
    for end, root in (("a", "x"), ("b", "y")):
        if known is None:
            met = met.withColumns({root: F.col(end), f"known_{end}": F.lit(False)})
            continue
        of = known.select(F.col("node").alias(end), F.col("component").alias("_root"))
        met = lookup(met, of, [end], "left").withColumns({root: F.coalesce("_root", end), f"known_{end}": F.col("_root").isNotNull()}).drop("_root")
    return met


def extend_components(known: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Components of all edges so far, from those of the earlier ones and the new edges alone.

    ``known(node, component)`` is what an earlier call returned (None: nothing yet).  New edges are contracted
    to the roots of their ends; only roots that differ enter the rounds, so their cost follows what a
    day adds and not what there is.  The rows of roots that moved are then given their new one.
    """
    met = durable(contract(known, edges))
    moved = connected_components(met.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    ends = [F.struct(F.col(end).alias("node"), F.col(root).alias("root"), F.col(f"known_{end}").alias("known")) for end, root in (("a", "x"), ("b", "y"))]
    new = met.select(F.explode(F.array(*ends)).alias("e")).select("e.*").where("NOT known").select("node", F.col("root").alias("component")).distinct()
    every = new if known is None else known.select("node", "component").unionByName(new)
    to = moved.where("node <> component").select(F.col("node").alias("component"), F.col("component").alias("_to"))
    return durable(lookup(every, to, ["component"], "left").select("node", F.coalesce("_to", "component").alias("component")))


def first_fit(claims: DataFrame) -> DataFrame:
    """Positions kept when rows arrive in order and a row sharing a key with a kept row is dropped.

    ``claims(pos, value)`` holds the keys of each row.  A row is decided once it is the
    earliest undecided row of all its keys; every round decides at least the earliest row
    of each cluster, and clusters are decided side by side.  Rounds follow the longest chain of
    rows that wait for each other, with no cap; a round's tables are deleted when it is over,
    and winners are gathered in one table.
    """
    open_claims = durable(claims.distinct())
    winners_of_all = None
    while True:
        first = open_claims.groupBy("value").agg(F.min("pos").alias("first_pos"))
        marked = lookup(open_claims, first, ["value"], "inner")
        winners = marked.groupBy("pos").agg(F.bool_and(F.col("pos") == F.col("first_pos")).alias("wins")).where("wins").select("pos")
        won = durable(winners)
        winners_of_all = durable(won) if winners_of_all is None else append(winners_of_all, won)
        # Each value is claimed by at most one winner, so this has one row per value; earlier winners are closed.
        taken = lookup(open_claims, won, ["pos"], "left_semi").select("value").distinct()
        gone = lookup(open_claims, taken, ["value"], "left_semi").select("pos").distinct()
        done, open_claims = open_claims, durable(open_claims.join(gone, "pos", "left_anti"))
        discard(done)
        discard(won)
        if open_claims.isEmpty():
            discard(open_claims)
            return winners_of_all
