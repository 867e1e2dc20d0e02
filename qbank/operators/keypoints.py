"""Key-point operators: sampling (S2 / W3), the "others" lists (F8, F9, F10),
the removal check (F11), feature swap (J7), and the generation job that
turns a question into four choices through the model stages (M1-M6, A7, A8).

Every per-question list is an in-row array: sampling, filtering and
counting are higher-order column expressions (no shuffle). The only fan-out is
``posexplode`` of the k sampled key points (k rows per question, k fixed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from qbank.functions import prompts as P
from qbank.functions.util import as_col
from qbank.operators.infer import Backend, build_requests, infer
from qbank.session import materialize

KEYPOINTS_SCHEMA = ("Analysis STRING, Keypoints ARRAY<STRUCT<keypoint: STRING, "
                    "detail: STRING>>")
FEATURES_SCHEMA = "Analysis STRING, Features ARRAY<STRUCT<feature: STRING, detail: STRING>>"
DISTORT_SCHEMA = ("analysis_1 STRING, analysis_2 STRING, new_keypoint STRING, "
                  "new_keypoint_detail STRING, old_keypoint STRING, old_keypoint_detail STRING")
SWAP_SCHEMA = ("analysis_1 STRING, analysis_2 STRING, new_feature STRING, "
               "new_feature_detail STRING, old_feature STRING")


def sample_keypoints(arr, k: int, seed, row_id) -> Column:
    """K of n elements without replacement, in a hash order that depends
    only on (seed, row, position). NULL when n < k (caller quarantines)."""
    a = as_col(arr)
    keyed = F.transform(a, lambda x, i: F.struct(
        F.md5(F.concat_ws(":", as_col(seed).cast("string"), as_col(row_id).cast("string"),
                          i.cast("string"))).alias("k"), i.alias("i"), x.alias("x")))
    picked = F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s["x"])
    return F.when(F.size(a) >= k, picked)


def sample_rank(exploded: DataFrame, k: int, seed: int, group: str, pos: str) -> DataFrame:
    """The same sample over an exploded key-point table (for questions
    whose key points are too many to keep in one row).

    Two rounds, so a hot question never lands whole in one task: the first
    keeps the k best per (question, input partition), spread over tasks; the
    second ranks at most k x partitions candidates per question."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string"),
                          F.col(pos).cast("string")))
    x = exploded.withColumn("_h", h).withColumn("_p", F.spark_partition_id())
    local = Window.partitionBy(group, "_p").orderBy("_h", F.col(pos))
    cand = x.withColumn("_r", F.row_number().over(local)).where(F.col("_r") <= k)
    final = Window.partitionBy(group).orderBy("_h", F.col(pos))
    return (cand.withColumn("_r", F.row_number().over(final)).where(F.col("_r") <= k)
            .drop("_r", "_h", "_p"))


def others_by_struct(arr, sel) -> Column:
    """F8: every key point that is not equal to the selected one as a whole."""
    return F.filter(as_col(arr), lambda x: ~x.eqNullSafe(as_col(sel)))


def others_by_name(arr, name, field: str = "keypoint") -> Column:
    """Drop every key point whose name equals ``name`` (all of them,
    not only the adjacent one a mutate-while-iterating loop would drop: T3)."""
    return F.filter(as_col(arr), lambda x: ~x[field].eqNullSafe(as_col(name)))


def swap_by_name(arr, old, new_name, new_detail, field: str = "feature") -> Column:
    """Replace the element(s) named ``old`` by the new pair; no match =
    unchanged list."""
    return F.transform(as_col(arr), lambda x: F.when(
        x[field].eqNullSafe(as_col(old)),
        F.struct(as_col(new_name).alias(field), as_col(new_detail).alias("detail"))
    ).otherwise(x))


def generate_mcqs(questions: DataFrame, backend: Backend, *, id_col: str = "seq",
                  k: int = 3, seed: int = 42, model: str = "rule",
                  carry: list[str] | None = None) -> DataFrame:
    """M5/M6: question + gold answer -> [true answer, k misleading answers].

    Stages: M1 extract key points -> S2 sample k -> M3 true answer, and per
    sampled point F8 -> M2 distort -> F9 -> M4 misleading answer; A8 gathers
    the answers in sample order, A7 the prompt audit, F11 the removal check.
    Rows with fewer than k key points, a failed stage or an unreadable reply come
    out with a ``status`` and no choices (quarantine), never as a job failure.
    ``id_col`` must identify a row uniquely (stages are joined back on it).
    """
    carry = list(dict.fromkeys([c for c in (carry or []) if c != id_col]))
    base = [id_col, "question", "answer", *carry]
    q = questions.select(*dict.fromkeys(base))

    # M1
    r1 = infer(build_requests(q, request_id=id_col, task="extract_keypoints", model=model,
                              prompt=P.EXTRACT_KEYPOINTS.to_column(question="question",
                                                                   answer="answer"),
                              keep=base), backend, name="extract", keep_prompt=True)
    kp = (r1.withColumn("_p", F.from_json("response", KEYPOINTS_SCHEMA))
          .select(*base, F.col("prompt").alias("p_extract"), F.col("response").alias("r_extract"),
                  F.col("_p.Keypoints").alias("keypoints")))
    kp = (kp.withColumn("n_keypoints", F.coalesce(F.size("keypoints"), F.lit(-1)))
          .withColumn("sampled", sample_keypoints("keypoints", k, F.lit(seed), F.col(id_col))))

    ok = kp.where(F.col("sampled").isNotNull())
    bad = kp.where(F.col("sampled").isNull()).select(
        *base, "n_keypoints",
        F.when(F.col("keypoints").isNull(), F.lit("unreadable_keypoints"))
        .otherwise(F.lit("too_few_keypoints")).alias("status"))

    # M3
    kp_block = P.pairs_block("keypoints", "keypoint", "detail")
    ok = materialize(ok, "keypoints")  # later stages read it, not its lineage
    r3 = infer(build_requests(ok, request_id=id_col, task="generate_true_answer", model=model,
                              json_mode=False,
                              prompt=P.TRUE_ANSWER.to_column(question="question",
                                                             keypoints=kp_block),
                              keep=[id_col]), backend, name="true", keep_prompt=True)
    true = r3.select(id_col, F.col("prompt").alias("p_true"), F.col("response").alias("true_answer"),
                     (F.col("status") == "ok").alias("true_ok"))

    # per sampled key point: F8 -> M2
    ex = ok.select(id_col, "question", "keypoints", F.posexplode("sampled").alias("j", "sel"))
    ex = ex.withColumn("others", others_by_struct("keypoints", "sel"))
    r2 = infer(build_requests(ex, request_id=F.concat_ws("#", F.col(id_col).cast("string"),
                                                          F.col("j").cast("string")),
                              task="distort_keypoint", model=model,
                              prompt=P.DISTORT_KEYPOINT.to_column(
                                  question="question", name=F.col("sel.keypoint"),
                                  detail=F.col("sel.detail"),
                                  others=P.others_block("others", "keypoint", "detail",
                                                        "key point")),
                              keep=[id_col, "j", "question", "keypoints", "sel"]),
               backend, name="distort", keep_prompt=True)
    d = (r2.withColumn("_d", F.from_json("response", DISTORT_SCHEMA))
         .select(id_col, "j", "question", "keypoints", F.col("prompt").alias("p_distort"),
                 F.col("response").alias("r_distort"),
                 ((F.col("status") == "ok") & F.col("_d.new_keypoint").isNotNull()
                  & F.col("_d.new_keypoint_detail").isNotNull()).alias("distort_ok"),
                 F.col("_d.new_keypoint").alias("new_keypoint"),
                 F.col("_d.new_keypoint_detail").alias("new_keypoint_detail"),
                 F.col("sel.keypoint").alias("real_old_keypoint")))
    # F9 -> M4
    d = d.withColumn("remaining", others_by_name("keypoints", "real_old_keypoint"))
    d = d.withColumn("n_removed", F.size("keypoints") - F.size("remaining"))
    d = materialize(d, "distorted")
    # a failed distortion has nothing to mislead with: its prompt is NULL, not asked
    r4 = infer(build_requests(d, request_id=F.concat_ws("#", F.col(id_col).cast("string"),
                                                         F.col("j").cast("string")),
                              task="generate_mislead_answer", model=model, json_mode=False,
                              prompt=P.MISLEAD_ANSWER.to_column(
                                  question="question", new_name="new_keypoint",
                                  new_detail="new_keypoint_detail",
                                  keypoints=P.pairs_block("remaining", "keypoint", "detail")),
                              keep=[id_col, "j", "p_distort", "r_distort", "n_removed", "distort_ok"]),
               backend, name="mislead", keep_prompt=True)
    # Gather the k answers per question in sample order (k rows per group)
    parts = (r4.groupBy(id_col)
             .agg(F.array_sort(F.collect_list(F.struct(
                 "j", F.col("response").alias("answer"), "p_distort", "r_distort",
                 F.col("prompt").alias("p_mislead"), "n_removed",
                 F.coalesce(F.col("distort_ok"), F.lit(False)).alias("distort_ok"),
                 F.coalesce(F.col("status") == "ok", F.lit(False)).alias("mislead_ok"))))
                  .alias("parts")))

    audit = lambda p, r: F.array(F.struct(F.col(p).alias("prompt"), F.col(r).alias("response")))
    out = (ok.drop("sampled").join(true, id_col).join(parts, id_col)
           .withColumn("choices", F.concat(F.array("true_answer"),
                                           F.transform("parts", lambda x: x["answer"])))
           .withColumn("n_removed_total",
                       F.aggregate("parts", F.lit(0), lambda acc, x: acc + x["n_removed"]))
           .withColumn("prompt_and_response", F.map_from_entries(F.array(
               F.struct(F.lit("extract_keypoints"), audit("p_extract", "r_extract")),
               F.struct(F.lit("generate_true_answer"), audit("p_true", "true_answer")),
               F.struct(F.lit("distort_keypoint"), F.transform("parts", lambda x: F.struct(
                   x["p_distort"].alias("prompt"), x["r_distort"].alias("response")))),
               F.struct(F.lit("generate_mislead_answer"), F.transform("parts", lambda x: F.struct(
                   x["p_mislead"].alias("prompt"), x["answer"].alias("response")))))))
           .withColumn("status", F.when(~F.coalesce("true_ok", F.lit(False))
                                        | F.col("true_answer").isNull(), F.lit("failed_true_answer"))
                       .when(F.exists("parts", lambda x: ~x["distort_ok"]), F.lit("failed_distortion"))
                       .when(F.exists("parts", lambda x: ~x["mislead_ok"] | x["answer"].isNull()),
                             F.lit("failed_mislead_answer"))
                       .when(F.col("n_removed_total") != k, F.lit("not_all_distorted"))
                       .otherwise(F.lit("ok")))
           .withColumn("choices", F.when(~F.col("status").startswith("failed"), F.col("choices")))
           .withColumn("correct_answer", F.when(F.col("choices").isNotNull(), F.lit("A"))))
    return (out.select(*base, "n_keypoints", "status", "choices", "correct_answer",
                       "n_removed_total", "prompt_and_response")
            .unionByName(bad, allowMissingColumns=True))


def audit_calls(generated: DataFrame, id_col: str = "seq") -> DataFrame:
    """A7 as rows: per question, stage and call in call order, prompt and response."""
    stages = generated.select(id_col, F.explode("prompt_and_response").alias("stage", "calls"))
    return stages.select(id_col, "stage", F.posexplode("calls").alias("pos", "c")).select(
        id_col, "stage", "pos", "c.prompt", "c.response")


#: What can become of a question in ``generate_mcqs``.
STATUSES = ("ok", "not_all_distorted", "too_few_keypoints", "unreadable_keypoints", "failed_true_answer",
            "failed_distortion", "failed_mislead_answer")


def count_statuses(generated: DataFrame, name: str = "generation") -> tuple[DataFrame, Observation]:
    """F11 / T7 counts beside the records: whatever action writes the returned table also
    counts its rows per status; ``get`` of the observation then reads the counts, with
    no job of its own."""
    seen = Observation(name)
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return generated.observe(seen, *counts), seen
