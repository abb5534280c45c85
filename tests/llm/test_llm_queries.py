"""Registered queries against their SQL, and the pipeline against what its stages promise."""

import re

import corpus_pipeline
import pytest
from oracle import compare, connect

from dayline.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.PLANS)
def test_query(spark, name):
    plan, sql = queries.PLANS[name]
    rows, problem, _ = compare(spark, connect(SMALL), SMALL, plan, sql)
    assert rows > 0 and problem is None


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == names, name
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bare = [re.sub(r"[\x20\x09-\x0D]", "", t) for t in texts.values()]
    assert len(set(bare)) == len(bare) < counts[0]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    left = [i for i, t in texts.items() for w in [words(t)] if any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9))]
    assert not left
    mixed = corpus_pipeline.run(spark, sf)
    assert mixed.count() > 0 and set(names) < set(mixed.columns)
