"""M0: model inference as a batch DataFrame operator.

A *request table* (one prompt per row) goes in, a *reply table* comes out.
The backend is pluggable; it runs inside ``mapInPandas`` on Arrow batches, one
client per task, so concurrency is bounded by the number of partitions.

Scale notes
* Identical requests (same task, model, system, prompt and parameters) at
  temperature 0 share one reply: requests are keyed by ``cache_key = sha2(...)``,
  de-duplicated with a map-side partial aggregate, and replies are joined back on
  the key. A hot prompt (a third of all rows) is one backend call; AQE splits the
  skewed side of the join-back. Above temperature 0 every request is asked.
* A reply cache (a table of earlier replies) is honoured with a ``left_anti``
  join, so only new prompts reach the backend. Failed replies in it are not used.
  ``ReplyTable`` keeps it bucketed by key, so that the cache is never shuffled.
* Requests are dealt by key to as many tasks as the session has shuffle partitions
  (``num_partitions`` otherwise); nothing is counted first.
* Replies are written to the shared checkpoint folder and read back before
  anything else uses them, so later stages and their retries don't ask again. A
  model task that is itself lost is run again and asks again.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qbank.session import checkpoint_dir
from qbank.session import materialize as _materialize

REQUEST_COLUMNS = ["request_id", "task", "model", "system", "prompt", "temperature",
                   "json_mode", "max_tokens"]
REPLY_SCHEMA = T.StructType([
    T.StructField("cache_key", T.StringType()),
    T.StructField("response", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
])


def build_requests(df: DataFrame, *, request_id, prompt, task: str, system: str | Column | None = None,
                   model: str = "rule", temperature: float = 0.0, json_mode: bool = True,
                   max_tokens: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Project ``df`` to the request schema (plus any ``keep`` columns)."""
    rid = F.col(request_id) if isinstance(request_id, str) else request_id
    pr = F.col(prompt) if isinstance(prompt, str) else prompt
    cols = [
        rid.cast("string").alias("request_id"),
        F.lit(task).alias("task"),
        F.lit(model).alias("model"),
        (system if isinstance(system, Column) else F.lit(system)).cast("string").alias("system"),
        pr.alias("prompt"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(bool(json_mode)).alias("json_mode"),
        F.lit(max_tokens).cast("int").alias("max_tokens"),
    ]
    return df.select(*cols, *(keep or []))


def cache_key_col() -> Column:
    return F.sha2(F.concat_ws("\u0001", F.col("task"), F.col("model"),
                              F.when(F.col("temperature") > 0, F.coalesce("request_id", F.lit("")))
                              .otherwise(F.lit("")), F.coalesce(F.col("system"), F.lit("")),
                              F.col("prompt"), F.col("temperature").cast("string"),
                              F.col("json_mode").cast("string"),
                              F.coalesce(F.col("max_tokens").cast("string"), F.lit(""))), 256)


class Backend:
    """Interface: ``complete(batch)`` gets a pandas frame with the request
    columns and returns a frame with ``response``, ``status``, ``error``
    (same length and order). Implementations must be picklable; heavy clients
    should be created lazily inside ``complete``."""

    def complete(self, batch: pd.DataFrame) -> pd.DataFrame:  # pragma: no cover
        raise NotImplementedError


def _h(s: str) -> str:
    return hashlib.md5(s.encode("utf-8")).hexdigest()


class RuleBackend(Backend):
    """Deterministic offline backend: every reply is a function of
    ``md5(prompt)`` (written ``h`` below), so SQL can state the expected reply.

    Rules (fixed values, mirrored in the SQL oracles):
    * ``answer``: c = ascii(h[0]) % 4; form = ascii(h[1]) % 3 gives the
      choice as a number c+1, a quoted number "c+1", or the letter of c.
    * ``answer_batch``: as ``answer`` with 0-based numbers c.
    * ``classify``: completeness from [0,1,2,3,9] at ascii(h[0]) % 5, type
      from [1,2,3,4,5,9,8] at ascii(h[1]) % 7 (8 is out of domain on purpose),
      mcq = ascii(h[2]) % 2; reasons ``rule:`` + h[0:8].
    * ``extract_keypoints`` / ``extract_features``: n = 2 + ascii(h[0]) % 6
      points named ``kp1..kpn`` (``f1..fn``), detail md5(h || j)[0:12];
      ascii(h[1]) % 4 = 0 and n >= 4 renames the last point to the first
      name, = 1 and n >= 3 renames the second one (duplicate names).
    * ``distort_keypoint`` / ``swap_feature``: new name ``new-`` + h[0:6],
      detail h[6:18]; the old name echoes the ``Selected ...:`` line, upper-
      cased (a misquote) when ascii(h[2]) % 5 = 0.
    * ``distractors`` / ``keypoint_distractors``: answers ``gold-``/``wrong1-``
      ... + h[0:8]; ``structured_distractors``: n = 2 + ascii(h[0]) % 3 wrong
      choices ``wrong{j}-`` + h[0:8].
    * any other task: text ``ans-`` + h[0:12].
    * a prompt that is NULL gets status ``error``.
    """

    SELECTED = re.compile(r"Selected (?:key point|feature): ([^\n]*)")

    def complete(self, batch: pd.DataFrame) -> pd.DataFrame:
        out = [self._one(t, p) for t, p in zip(batch["task"], batch["prompt"])]
        return pd.DataFrame(out, columns=["response", "status", "error"])

    def _one(self, task, prompt):
        if prompt is None:
            return (None, "error", "empty prompt")
        h = _h(prompt)
        a0, a1, a2 = ord(h[0]), ord(h[1]), ord(h[2])
        tag = "rule:" + h[:8]
        if task in ("answer", "answer_batch"):
            c = a0 % 4
            n = c + 1 if task == "answer" else c
            form = a1 % 3
            choice = n if form == 0 else (str(n) if form == 1 else "ABCD"[c])
            return (json.dumps({"reason": tag, "choice": choice}), "ok", None)
        if task == "classify":
            return (json.dumps({
                "completeness_reason": tag, "type_reason": tag, "mcq_reason": tag,
                "completeness_choice": [0, 1, 2, 3, 9][a0 % 5],
                "type_choice": [1, 2, 3, 4, 5, 9, 8][a1 % 7],
                "mcq_choice": a2 % 2}), "ok", None)
        if task in ("extract_keypoints", "extract_features"):
            key, prefix, top = (("keypoint", "kp", "Keypoints") if task == "extract_keypoints"
                                else ("feature", "f", "Features"))
            n = 2 + a0 % 6
            names = [f"{prefix}{j}" for j in range(1, n + 1)]
            if a1 % 4 == 0 and n >= 4:
                names[-1] = names[0]
            elif a1 % 4 == 1 and n >= 3:
                names[1] = names[0]
            pts = [{key: names[j - 1], "detail": _h(h + str(j))[:12]} for j in range(1, n + 1)]
            return (json.dumps({"Analysis": tag, top: pts}), "ok", None)
        if task in ("distort_keypoint", "swap_feature"):
            m = self.SELECTED.search(prompt)
            old = m.group(1) if m else ""
            if a2 % 5 == 0:
                old = old.upper()
            if task == "distort_keypoint":
                body = {"analysis_1": tag, "analysis_2": tag, "new_keypoint": "new-" + h[:6],
                        "new_keypoint_detail": h[6:18], "old_keypoint": old,
                        "old_keypoint_detail": ""}
            else:
                body = {"analysis_1": tag, "analysis_2": tag, "new_feature": "new-" + h[:6],
                        "new_feature_detail": h[6:18], "old_feature": old}
            return (json.dumps(body), "ok", None)
        if task in ("distractors", "keypoint_distractors"):
            body = {"question": "q-" + h[:8], "choice": {
                "gold_choice": {"reason": tag, "answer": "gold-" + h[:8]},
                "incorrect_choice_1": {"reason": tag, "answer": "wrong1-" + h[:8]},
                "incorrect_choice_2": {"reason": tag, "answer": "wrong2-" + h[:8]},
                "incorrect_choice_3": {"reason": tag, "answer": "wrong3-" + h[:8]}}}
            if task == "keypoint_distractors":
                body = {"Analysis": tag, **body}
            return (json.dumps(body), "ok", None)
        if task == "structured_distractors":
            n = 2 + a0 % 3
            body = {"Analysis": tag, "question": "q-" + h[:8], "choices": {
                "gold_choice": {"reason": tag, "answer": "gold-" + h[:8]},
                "incorrect_choices": [{"key_point_changed": f"kp{j}", "reason": tag,
                                       "answer": f"wrong{j}-" + h[:8]} for j in range(1, n + 1)]}}
            return (json.dumps(body), "ok", None)
        return ("ans-" + h[:12], "ok", None)


def _call_backend(backend: Backend):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b) == 0:
                continue
            try:
                r = backend.complete(b)
                res = pd.DataFrame({"cache_key": b["cache_key"].values,
                                    "response": r["response"].values,
                                    "status": r["status"].values,
                                    "error": r["error"].values})
            except Exception as e:  # a failed call is data, not a job abort (T7)
                res = pd.DataFrame({"cache_key": b["cache_key"].values, "response": None,
                                    "status": "error", "error": repr(e)[:500]})
            yield res
    return run


def replay(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """Answer requests from a table of recorded replies (``REPLY_SCHEMA``, one usable
    row per ``cache_key``): the cache join of ``infer`` by itself, with no backend.
    Requests without a recorded reply get status ``missing``."""
    keyed = requests.withColumn("cache_key", cache_key_col())
    usable = replies.where(F.col("status") == "ok").select("cache_key", "response")
    out = keyed.join(usable.dropDuplicates(["cache_key"]), "cache_key", "left")
    return out.withColumn("status", F.when(F.col("response").isNotNull(), "ok").otherwise("missing"))


class ReplyTable:
    """M0's reply cache: a Parquet table at ``path`` in the shared folder, bucketed by
    ``cache_key``. A run's requests are shuffled to the buckets; the cache itself, which
    grows run by run, is read in place. Appended replies add files to the buckets."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or f"{checkpoint_dir(spark).rstrip('/')}/reply-cache-{uuid.uuid4().hex}"
        # no fewer buckets than shuffle partitions: else the planner shuffles both sides
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = "reply_cache_" + hashlib.md5(self.path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (cache_key STRING, response STRING, status STRING, error STRING) "
                  f"USING parquet CLUSTERED BY (cache_key) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def add(self, replies: DataFrame) -> None:
        """Append usable replies."""
        rows = replies.where(F.col("status") == "ok").select("cache_key", "response", "status", "error")
        rows = rows.repartition(self.buckets, "cache_key")  # a file a bucket
        rows.write.mode("append").format("parquet").option("path", self.path).bucketBy(
            self.buckets, "cache_key").saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)


def infer(requests: DataFrame, backend: Backend, *, cache: DataFrame | None = None,
          num_partitions: int | None = None, materialize: bool = True,
          name: str = "replies", keep_prompt: bool = False) -> DataFrame:
    """Run each request through ``backend`` once per distinct request.

    Returns the request columns that are not model inputs (``request_id`` and
    any kept columns; ``prompt`` too with ``keep_prompt``) plus
    ``cache_key, response, status, error``.
    """
    keyed = requests.withColumn("cache_key", cache_key_col())
    todo = keyed.select(*REQUEST_COLUMNS[1:], "cache_key").dropDuplicates(["cache_key"])
    cached = None
    if cache is not None:
        # only the cached replies this run asks for, one per key
        cached = (cache.where(F.col("status") == "ok").select(*REPLY_SCHEMA.fieldNames())
                  .dropDuplicates(["cache_key"])
                  .join(todo.select("cache_key"), "cache_key", "left_semi"))
        todo = todo.join(cached.select("cache_key"), "cache_key", "left_anti")
    if num_partitions is None:  # bounded by the session, not by the requests
        num_partitions = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = todo.repartition(num_partitions, "cache_key")
    replies = todo.mapInPandas(_call_backend(backend), REPLY_SCHEMA)
    if cached is not None:
        replies = replies.unionByName(cached)
    if materialize:
        replies = _materialize(replies, name)
    rest = [c for c in keyed.columns
            if c not in REQUEST_COLUMNS[1:] or (keep_prompt and c == "prompt")]
    return keyed.select(*rest).join(replies, "cache_key", "left")
