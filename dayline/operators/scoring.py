"""A pluggable per-row model scorer with retries, typed errors and rule fallback."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayline.functions.text import FENCE_HEAD, FENCE_TAIL
from dayline.operators.groups import lookup

SCORED = (
    "id STRING, answer STRING, error_type STRING, "
    "calls ARRAY<STRUCT<attempt:INT,model:STRING,success:BOOLEAN,prompt_tokens:BIGINT,completion_tokens:BIGINT,elapsed_ms:BIGINT,error:STRING>>"
)


#: One line of an answer file: a call of the model, with the key of its prompt.
ANSWER = "key STRING, attempt INT, content STRING, failure STRING, elapsed_ms BIGINT"


def parse_answer(
    content: str, required: tuple[str, ...], audit: Callable[[dict, str], bool] | None = None, prompt: str = ""
) -> tuple[str | None, str | None]:
    """(json, error_type) of one model answer: an object, or a list of exactly one, that has what is required and passes the audit."""
    text = re.sub(FENCE_HEAD, "", content.strip())
    text = re.sub(FENCE_TAIL, "", text).strip() if content.strip().startswith("```") else content.strip()
    try:
        parsed = json.loads(text)
    except ValueError:
        return None, "invalid_json"
    if isinstance(parsed, list):
        if len(parsed) != 1:
            return None, "item_count_mismatch"
        parsed = parsed[0]
    if not isinstance(parsed, dict) or any(k not in parsed for k in required):
        return None, "schema_error"
    if audit is not None and not audit(parsed, prompt):
        return None, "audit_failure"
    return json.dumps(parsed, ensure_ascii=False), None


class _Saved:
    """Answers of a partition as small files in a shared folder; what an attempt that died has written is found again."""

    def __init__(self, folder: str | None, partition: int):
        self.fs = self.root = None
        self.found: dict[str, list[dict]] = {}
        self.prefix = f"part-{partition:06d}-"
        if folder is None:
            return
        self.fs, self.root = pafs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        self.fs.create_dir(self.root)
        for info in self.fs.get_file_info(pafs.FileSelector(self.root)):
            if info.base_name.startswith(self.prefix):
                with self.fs.open_input_stream(info.path) as f:
                    for line in f.read().decode().splitlines():
                        self.found.setdefault((row := json.loads(line))["key"], []).append(row)

    def add(self, rows: list[dict]) -> None:
        if self.fs is None or not rows:
            return
        with self.fs.open_output_stream(f"{self.root}/{self.prefix}{uuid.uuid4().hex}.json") as f:
            f.write("".join(json.dumps(row) + "\n" for row in rows).encode())


def saved_answers(spark: SparkSession, folder: str) -> DataFrame:
    """``(key, known)``: the calls made for each prompt so far, in order of attempt, over all runs that used the folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"key STRING, known ARRAY<STRUCT<{ANSWER.replace('key STRING, ', '')}>>")
    lines = spark.read.schema(ANSWER).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).json(folder)
    once_each = lines.where("key IS NOT NULL").dropDuplicates(["key", "attempt"])
    return once_each.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("attempt", "content", "failure", "elapsed_ms"))).alias("known"))


def score_items(
    items: DataFrame, prompt: str, model: Callable[[str], str], required: tuple[str, ...] = (), retries: int = 1, name: str = "model",
    audit: Callable[[dict, str], bool] | None = None, answers: str | None = None, concurrency: int = 1,
) -> DataFrame:
    """Call ``model`` on the ``prompt`` column of every row: up to ``retries`` more times until the answer parses and passes ``audit``.

    Partitions call side by side, and each makes up to ``concurrency`` calls at once.  With ``answers``, a shared
    folder, every call is kept there under the hash of its prompt and its attempt as soon as it returns: a task or a
    job that is repeated only calls for what is missing, and no prompt of a task is asked twice.  At most the calls of the last few
    prompts are lost with an executor.  Without it, materialise the result before using it twice.
    """
    spark = items.sparkSession
    rows = items.select("id", F.col(prompt).alias("prompt"), F.sha2(F.concat_ws("\x1f", F.lit(name), F.col(prompt)), 256).alias("key"))
    job = None
    if answers is None:
        rows = rows.withColumn("known", F.lit(None).cast("array<struct<attempt:int,content:string,failure:string,elapsed_ms:bigint>>"))
    else:
        job = f"{answers}/{uuid.uuid4().hex}"
        rows = lookup(rows, saved_answers(spark, answers), ["key"], "left")

    def ask(text: str, attempt: int) -> dict:
        started = time.perf_counter()
        content = failure = None
        try:
            content = model(text)
        except Exception as exc:  # whatever a model raises is its answer's failure
            failure = f"{type(exc).__name__}: {exc}"
        return {"attempt": attempt, "content": content, "failure": failure, "elapsed_ms": round((time.perf_counter() - started) * 1000)}

    def judged(call: dict, text: str) -> tuple[str | None, str | None]:
        return (None, "transport_error") if call["failure"] is not None else parse_answer(call["content"] or "", required, audit, text)

    def settle(key: str, text: str, known: list[dict]) -> tuple[list[dict], list[dict]]:
        """All calls of a prompt up to the one that settles it, and those of them that are new."""
        calls, new = [], []
        for attempt in range(1, retries + 2):
            call = next((c for c in known if c["attempt"] == attempt), None)
            if call is None:
                call = ask(text, attempt)
                new.append({"key": key, **call})
            calls.append(call)
            if judged(call, text)[1] is None:
                break
        return calls, new

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        saved = _Saved(job, TaskContext.get().partitionId())
        done: dict[str, list[dict]] = {}
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                out = []
                for at in range(0, len(batch), concurrency):
                    part = batch.iloc[at : at + concurrency]
                    open_ = {}
                    for key, text, known in zip(part["key"], part["prompt"], part["known"]):
                        if key not in done and key not in open_:
                            before = [dict(c) for c in known] if known is not None else []
                            open_[key] = pool.submit(settle, key, text or "", before + saved.found.get(key, []))
                    settled = {key: future.result() for key, future in open_.items()}
                    saved.add([call for _, new in settled.values() for call in new])
                    if answers is not None:
                        done.update({key: calls for key, (calls, _) in settled.items()})
                    for item_id, key, text in zip(part["id"], part["key"], part["prompt"]):
                        calls = done[key] if key in done else settled[key][0]
                        answer, error = judged(calls[-1], text or "")
                        out.append((item_id, answer, error, [_logged(c, text or "", name) for c in calls]))
                yield pd.DataFrame(out, columns=["id", "answer", "error_type", "calls"])

    return rows.mapInPandas(run, SCORED)


def _logged(call: dict, text: str, name: str) -> dict:
    words = len((call["content"] or "").split())
    return {
        "attempt": call["attempt"], "model": name, "success": call["failure"] is None, "prompt_tokens": max(1, len(text.split())),
        "completion_tokens": words, "elapsed_ms": call["elapsed_ms"], "error": call["failure"],
    }


def with_fallback(scored: DataFrame, answer_schema: str, rules: DataFrame, strict: bool = False) -> DataFrame:
    """Model answers where they parse, rule results elsewhere, with the source of the decision.

    ``rules`` has ``id`` and the fields of ``answer_schema``.  In strict mode a failed
    answer fails the query instead.
    """
    parsed = scored.select("id", "error_type", F.from_json("answer", answer_schema).alias("a"))
    if strict:
        parsed = parsed.withColumn("a", F.when(F.col("error_type").isNull(), F.col("a")).otherwise(F.raise_error(F.concat(F.lit("model answer failed: "), "error_type"))))
    fields = [c for c in rules.columns if c != "id"]
    rule = rules.select("id", *[F.col(c).alias(f"_r_{c}") for c in fields])
    return parsed.join(rule, "id", "left").select(
        "id", *[F.when(F.col("error_type").isNull(), F.coalesce(F.col(f"a.{c}"), F.col(f"_r_{c}"))).otherwise(F.col(f"_r_{c}")).alias(c) for c in fields],
        F.when(F.col("error_type").isNull(), "model").otherwise("rule_fallback").alias("decision_source"), "error_type",
    )


def call_log(scored: DataFrame, run_id: str, step_name: str) -> DataFrame:
    """One row per model call."""
    return scored.select(F.lit(run_id).alias("run_id"), F.lit(step_name).alias("step_name"), F.col("id").alias("item_id"), F.explode("calls").alias("c")).select("run_id", "step_name", "item_id", "c.*", (F.col("c.prompt_tokens") + F.col("c.completion_tokens")).alias("total_tokens"))
