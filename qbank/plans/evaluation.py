"""E3 jobs: answer, score, label and audit generated questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.operators import evaluate as EV
from qbank.operators.infer import Backend, RuleBackend
from qbank.operators.mcq import shuffle_choices, split_renderable
from qbank.sources import fixtures as FX
from qbank.sources import tables as TB


def shuffled_questions(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    """documents -> choice sets -> seeded shuffle + render (renderable rows only)."""
    sets = FX.choice_sets(TB.documents(spark, sf_dir).select("doc_id", "text", "source"))
    good, _bad = split_renderable(sets)
    return shuffle_choices(good, seed=seed)


def rejected_choice_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F11/T13/T14 quarantine: choice sets that cannot be rendered, with the reason."""
    _good, bad = split_renderable(FX.choice_sets(TB.documents(spark, sf_dir).select("doc_id", "text", "source")))
    return bad.select("seq", "source", "question", F.size("choices").alias("n_choices"), "reject_reason")


def answer_log(spark: SparkSession, sf_dir: str, backend: Backend | None = None,
               seed: int = 42, scoring: str = "one_based", task: str = "answer") -> DataFrame:
    """M7 + A4: the answer log, one row per distinct question, last answer wins."""
    mcqs = shuffled_questions(spark, sf_dir, seed)
    answered = EV.answer_questions(mcqs, backend or RuleBackend(), task=task, scoring=scoring,
                                   keep=["source"])
    return EV.last_wins(answered.select("question", "seq", "source", "gold_index",
                                        "predicted_index", "correct"), "question", "seq")


def mcq_accuracy(spark: SparkSession, sf_dir: str, backend: Backend | None = None,
                 seed: int = 42, scoring: str = "one_based") -> DataFrame:
    """Flagship: accuracy of the backend on shuffled questions, per source."""
    log = answer_log(spark, sf_dir, backend, seed, scoring)
    return EV.accuracy(log, by=["source"])


def shuffled_mcqs(spark: SparkSession, sf_dir: str, seed: int = 42) -> DataFrame:
    """S1 + P11 + P12 + T1: the shuffled question table."""
    return shuffled_questions(spark, sf_dir, seed).select(
        "seq", "source", "question", "gold_index", "gold_letter", "gold_ambiguous", "mcq")


def answer_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the keyed answer log (last answer wins, first position kept)."""
    return answer_log(spark, sf_dir)


def enriched_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + W1: add each question's rendered text and file index to the log.
    Like the keyed original, a repeated question takes its last occurrence;
    questions missing on either side survive (full outer join, T12)."""
    data = EV.row_index(shuffled_questions(spark, sf_dir).select("seq", "question", "mcq"), "seq")
    last = EV.last_wins(data.select("question", "seq", "mcq", "row_index"), "question", "seq")
    log = answer_log(spark, sf_dir).select("question", "predicted_index", "gold_index", "correct")
    return log.join(last.select("question", "mcq", "row_index"), "question", "full_outer")


def spot_check(spark: SparkSession, sf_dir: str, draws: int = 10, seed: int = 7) -> DataFrame:
    """S3: ``draws`` log rows drawn with replacement (a sampling operator);
    draw j picks file row ``hash(seed, j) mod n``. Only the scalar row count
    reaches the driver; the pick is an equi-join of the draw list on the index."""
    data = EV.row_index(shuffled_questions(spark, sf_dir).select("seq", "question"), "seq")
    n = max(data.count(), 1)
    picks = (spark.range(1, draws + 1).withColumnRenamed("id", "draw")
             .withColumn("row_index", F.pmod(F.conv(F.substring(F.md5(F.concat_ws(
                 ":", F.lit(str(seed)), F.col("draw").cast("string"))), 1, 8), 16, 10)
                 .cast("bigint"), F.lit(n).cast("bigint"))))
    log = answer_log(spark, sf_dir).select("question", "gold_index", "predicted_index", "correct")
    return (picks.join(data, "row_index").join(log, "question", "left")
            .select("draw", "row_index", "question",
                    (F.col("gold_index") + 1).alias("gold_position"), "predicted_index",
                    "correct"))


def pick_row(spark: SparkSession, sf_dir: str, index: int = 562) -> DataFrame:
    """One record by file position (an ordered offset; nothing is indexed)."""
    data = shuffled_questions(spark, sf_dir).select("seq", "question", "mcq")
    return (data.orderBy("seq").offset(index).limit(1)
            .withColumn("row_index", F.lit(index).cast("bigint")))


def first_rows(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    """Stop after the first ``n`` records in file order (top-n, not a sample)."""
    return (shuffled_questions(spark, sf_dir).select("seq", "question", "gold_index")
            .orderBy("seq").limit(n))


def classified_questions(spark: SparkSession, sf_dir: str,
                         backend: Backend | None = None) -> DataFrame:
    """P9 + M8 + A4: label every self-check question, last label per question."""
    from qbank.plans.feed import self_check_questions
    qs = self_check_questions(spark, sf_dir).select("doc_id", "question", "clean_question")
    lab = EV.classify_questions(qs, backend or RuleBackend(), id_col="doc_id",
                                keep=["question"])
    cols = ["question", "doc_id", "completeness_reason", "type_reason", "mcq_reason",
            "completeness_choice", "type_choice", "mcq_choice", "codes_valid"]
    return EV.last_wins(lab.select(*cols), "question", "doc_id").drop("first_seq")


def batch_requests(spark: SparkSession, sf_dir: str, model: str = "rule-batch") -> DataFrame:
    """M9: the batch request table: one request per distinct question, custom
    id = sha2(question), params as JSON (the shape a batch endpoint takes)."""
    from qbank.functions import prompts as PR
    mcqs = EV.last_wins(shuffled_questions(spark, sf_dir).select("question", "seq", "mcq",
                                                                  "gold_index"), "question", "seq")
    prompt = PR.ANSWER_BATCH.to_column(mcq=F.col("mcq"))
    params = F.struct(F.lit(model).alias("model"), F.lit(PR.STUDENT_SYSTEM).alias("system"),
                      F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")))
                      .alias("messages"),
                      F.lit(0.0).alias("temperature"), F.lit(1000).alias("max_tokens"))
    return mcqs.select(F.sha2("question", 256).alias("custom_id"), "question", "gold_index",
                       F.to_json(params).alias("params"))


def batch_accuracy(spark: SparkSession, sf_dir: str, backend: Backend | None = None) -> DataFrame:
    """M9 -> results -> F7 + J5 + A3: score the succeeded batch results
    against the request table (0-based choices as the batch prompt asks)."""
    from qbank.operators.infer import build_requests, infer
    req = batch_requests(spark, sf_dir)
    p = F.from_json("params", "model STRING, system STRING, messages ARRAY<STRUCT<role: STRING, "
                    "content: STRING>>, temperature DOUBLE, max_tokens INT")
    calls = req.select("custom_id", p.alias("p"))
    results = infer(build_requests(calls, request_id="custom_id",
                                   prompt=F.col("p.messages")[0]["content"], task="answer_batch",
                                   system=None, model="rule-batch", max_tokens=1000),
                    backend or RuleBackend(), name="batch-results")
    results = results.select(F.col("request_id").alias("custom_id"),
                             F.when(F.col("status") == "ok", "succeeded").otherwise("errored")
                             .alias("result_type"), "response")
    ok = results.where(F.col("result_type") == "succeeded")
    joined = req.join(ok, "custom_id", "left")
    scored = joined.withColumn(
        "predicted_index",
        EV.predicted_index(F.from_json("response", EV.ANSWER_SCHEMA)["choice"], "zero_based")
    ).withColumn("correct", F.coalesce(F.col("predicted_index") == F.col("gold_index"),
                                       F.lit(False)))
    out = scored.agg(F.count(F.lit(1)).alias("n_requests"),
                     F.count("response").alias("n_succeeded"),
                     F.sum(F.col("correct").cast("bigint")).alias("n_correct"))
    return out.withColumn("n_correct", F.coalesce("n_correct", F.lit(0)).cast("bigint")) \
        .withColumn("accuracy_pct", F.try_divide(F.col("n_correct").cast("double") * 100.0,
                                                 F.col("n_succeeded").cast("double")))


def batch_request_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 request table decoded back from its JSON params (checkable form)."""
    p = F.from_json("params", "model STRING, messages ARRAY<STRUCT<role: STRING, "
                    "content: STRING>>, max_tokens INT")
    return batch_requests(spark, sf_dir).select(
        "custom_id", "question", "gold_index", p["model"].alias("model"),
        p["max_tokens"].alias("max_tokens"), F.md5(p["messages"][0]["content"]).alias("prompt_md5"))
