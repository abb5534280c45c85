"""Quality by a document classifier under hierarchical empirical Bayes.

The classifier compares how often good and bad labelled texts fall in the bins of a few measures of
the text.  Beside it stands what is known of the place: the share of good texts on a path
(source and language) is drawn towards that of its host (source), and that of a host towards
all, by as much as the hosts and paths differ beyond chance; a place with few labels says little.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.llm.common import content, match_rows, shared

#: Bins of each measure; labels of prior weight at most; posterior from which a document stays.
BINS, STRONGEST, KEEP_FROM = 16, 1e4, 0.1
#: Evidence of a text counts up to this many nats either way.
MOST_EVIDENCE = 12.0
MEASURES = ("words", "capitals", "signs", "digits", "length", "bars", "repeats", "variety")
OWN = ("quality_evidence", "quality_prior", "quality_score", "quality_kept")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Measures of a whole text and its list of words, each from 0 to ``BINS - 1``."""
    n = F.size(words)
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(n, F.lit(1)) * BINS
    values = {
        "words": F.log2(n + F.lit(1.0)),
        "capitals": share(r"\p{Lu}{2,}"),
        "signs": share(r"[^\p{L}\p{N}\s.,;:'\"()\-]+"),
        "digits": share(r"\p{N}+"),
        "length": (F.length(text) - n) / F.greatest(n, F.lit(1)),
        "bars": share(r"\s[^\p{L}\p{N}\s]+(?=\s|$)"),
        "repeats": share(r"(?:^|\s)(\S++)(?=\s\1(?:\s|$))"),
        "variety": F.size(F.array_distinct(words)) / F.greatest(n, F.lit(1)) * BINS,
    }
    return {k: F.least(F.lit(BINS - 1), F.greatest(F.lit(0), F.floor(v))).cast("int") for k, v in values.items()}


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, host, path, <measures>)`` per row of ``docs(doc_id, text, source, lang)``, as a table of its own."""
    rows = docs.select("doc_id", F.col("source").alias("host"), F.col("lang").alias("path"), content().alias("_text"))
    rows = rows.withColumn("_words", F.filter(F.split("_text", r"\s+"), lambda w: w != ""))
    return shared(rows.select("doc_id", "host", "path", *[c.alias(k) for k, c in measures(F.col("_text"), F.col("_words")).items()]))


def _labels(labels: DataFrame) -> DataFrame:
    """One mark by document; a document that is marked twice is good if no mark says bad."""
    rows = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    return rows.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("good"))


def learn(rows: DataFrame, labels: DataFrame) -> dict | None:
    """From ``measured`` rows: ``evidence`` by measure and bin (bounded), and tables of priors by host and by
    host and path; None without both labels."""
    rows = shared(match_rows(rows, _labels(labels), ["doc_id"]))
    each = rows.select("good", F.explode(F.create_map(*[x for k in MEASURES for x in (F.lit(k), F.col(k))])).alias("measure", "bin"))
    counts = each.groupBy("measure", "bin", "good").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {(r["measure"], r["bin"], r["good"]): r["n"] for r in counts}
    total = [sum(v for (m, _, g), v in n.items() if m == "words" and g == good) for good in (0, 1)]
    if not all(total):
        return None
    chance = lambda m, b, g: (n.get((m, b, g), 0) + 0.5) / (total[g] + 0.5 * BINS)
    evidence = {m: [math.log(chance(m, b, 1) / chance(m, b, 0)) for b in range(BINS)] for m in MEASURES}
    share = total[1] / sum(total)
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    hosts = shrunk(hosts.withColumn("above", F.lit(share)), share).withColumnRenamed("prior", "host_prior").select("host", "host_prior")
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    paths = shrunk(match_rows(paths, hosts, ["host"]).withColumnRenamed("host_prior", "above"), share)
    sites = shared(paths.select("host", "path", "prior"))
    return {"evidence": evidence, "share": share, "hosts": shared(hosts), "sites": sites}


def shrunk(groups: DataFrame, share: float) -> DataFrame:
    """``groups(n, good, above)`` with ``prior``: the group's share drawn towards ``above``.

    The prior's weight in labels comes from how much more the shares vary than chance would
    have them (moments of a beta-binomial); at most ``STRONGEST``.
    """
    spread = F.pow(F.col("good") / F.col("n") - F.col("above"), 2)
    moments = groups.agg(F.sum(F.col("n") * spread).alias("s"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    chance = share * (1 - share)
    between = max(0.0, (moments["s"] - moments["k"] * chance) / moments["n"]) if moments["n"] else 0.0
    weight = min(STRONGEST, max(1.0, chance / between - 1)) if between > 0 else STRONGEST
    return groups.withColumn("prior", (F.col("good") + F.col("above") * weight) / (F.col("n") + weight))


def assess(rows: DataFrame, model: dict | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """``(doc_id, quality_evidence, quality_prior, quality_score, quality_kept)`` of ``measured`` rows.

    A place without labels has the prior of its host, a host without labels that of all rows.
    Null source or language is a place like any other.  Null and empty texts are judged by
    their measures, which are 0.  Without a model all documents stay, with score 1.  Repeated
    rows are judged alike; an empty table gives no rows.
    """
    if model is None:
        one = F.lit(1.0)
        return rows.select("doc_id", *[v.alias(k) for k, v in zip(OWN, (F.lit(0.0), one, one, F.lit(True)))])
    told = [F.element_at(F.array(*map(F.lit, model["evidence"][m])), F.col(m) + 1) for m in MEASURES]
    total = told[0]
    for more in told[1:]:
        total = total + more
    rows = rows.select("doc_id", "host", "path", F.greatest(F.lit(-MOST_EVIDENCE), F.least(F.lit(MOST_EVIDENCE), total)).alias(OWN[0]))
    rows = match_rows(match_rows(rows, model["sites"], ["host", "path"], "left"), model["hosts"], ["host"], "left")
    prior = F.coalesce("prior", "host_prior", F.lit(model["share"]))
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), prior))
    score = 1 / (1 + F.exp(-(F.log(bounded / (1 - bounded)) + F.col("quality_evidence"))))
    return rows.select("doc_id", "quality_evidence", prior.alias("quality_prior"), score.alias("quality_score")).withColumn(
        "quality_kept", F.col("quality_score") >= keep_from
    )


def keep_good(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; learned from the labelled ones among them.

    A ``doc_id`` names one document; of rows that share one, all stay if one does.
    """
    rows = measured(docs)
    kept = assess(rows, learn(rows, labels), keep_from).where("quality_kept").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
