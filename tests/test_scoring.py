"""Model scoring that is resumed, audited and strict."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dayline.operators import scoring


def prompts(spark, texts, parts=3):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string").repartition(parts, "id")


def counting(folder, dies_at=None):
    """A model that leaves a mark for each call that returns; the process dies at one prompt, once."""

    def model(text):
        if text == dies_at and not os.path.exists(f"{folder}/died"):
            open(f"{folder}/died", "w").close()
            os._exit(1)
        with open(f"{folder}/calls", "a") as f:
            f.write(text + "\n")
        return json.dumps({"score": len(text)})

    return model


def test_a_killed_task_costs_no_second_call(spark, tmp_path):
    texts = [f"prompt {i}" for i in range(60)] + ["prompt 3", None]
    answers, marks = str(tmp_path / "answers"), str(tmp_path)
    score = lambda: scoring.score_items(prompts(spark, texts), "text", counting(marks, "prompt 41"), ("score",), answers=answers)
    with pytest.raises(Exception):
        score().collect()
    before = Counter(open(f"{marks}/calls").read().splitlines())
    assert 0 < sum(before.values()) < 61
    got = {r["id"]: r for r in score().collect()}
    calls = Counter(open(f"{marks}/calls").read().splitlines())
    # Only the call in hand when its process died may be made again; "prompt 3" stands in two rows.
    again = [t for t, n in calls.items() if n > 1 and t != "prompt 3"]
    assert len(again) <= 3 and len(got) == 62 and all(r["error_type"] is None for r in got.values())
    total = sum(calls.values())
    assert {r["id"] for r in score().collect()} == set(got) and sum(Counter(open(f"{marks}/calls").read().splitlines()).values()) == total


def test_attempts_are_resumed_where_they_stopped(spark, tmp_path):
    def model(text):
        with open(f"{tmp_path}/calls", "a") as f:
            f.write(text + "\n")
        return "no json"

    rows = prompts(spark, ["a", "b"])
    once = scoring.score_items(rows, "text", model, retries=0, answers=f"{tmp_path}/answers").collect()
    more = scoring.score_items(rows, "text", model, retries=2, answers=f"{tmp_path}/answers", concurrency=2).collect()
    assert [len(r["calls"]) for r in once] == [1, 1] and [len(r["calls"]) for r in more] == [3, 3]
    assert Counter(open(f"{tmp_path}/calls").read().split()) == {"a": 3, "b": 3}
    assert {r["error_type"] for r in more} == {"invalid_json"}


@pytest.mark.parametrize(
    "content, wanted",
    [
        ('{"score": 1}', None), ('```json\n{"score": 1}\n```', None), ('[{"score": 1}]', None), ("[]", "item_count_mismatch"), ("x", "invalid_json"),
        ("3", "schema_error"), ('{"other": 1}', "schema_error"), ('{"score": -1}', "audit_failure"), ("", "invalid_json"),
    ],
)
def test_answers_and_their_errors(content, wanted):
    assert scoring.parse_answer(content, ("score",), lambda answer, prompt: answer["score"] > 0)[1] == wanted


def test_strict_scoring_fails_where_rules_would_step_in(spark):
    rows = prompts(spark, ["good", "bad"])
    made = scoring.score_items(rows, "text", lambda t: '{"score": 7}' if t == "good" else "?", ("score",))
    rules = rows.select("id", F.lit(-1).alias("score"))
    lenient = {r["id"]: (r["score"], r["decision_source"], r["error_type"]) for r in scoring.with_fallback(made, "score INT", rules).collect()}
    assert lenient == {"0": (7, "model", None), "1": (-1, "rule_fallback", "invalid_json")}
    with pytest.raises(Exception, match="model answer failed: invalid_json"):
        scoring.with_fallback(made, "score INT", rules, strict=True).collect()
    audited = scoring.score_items(rows, "text", lambda t: '{"score": 7}', ("score",), audit=lambda answer, prompt: prompt == "good")
    assert {r["id"]: r["error_type"] for r in audited.collect()} == {"0": None, "1": "audit_failure"}
