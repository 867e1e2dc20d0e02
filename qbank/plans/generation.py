"""E2 jobs: key-point sampling checks and MCQ generation through the model
stages, then the seeded shuffle of the generated choices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.operators import keypoints as KP
from qbank.operators.infer import Backend, RuleBackend
from qbank.operators.mcq import shuffle_choices
from qbank.session import materialize
from qbank.sources import fixtures as FX
from qbank.sources import tables as TB

K = 3
SEED = 42


def keypoint_sampling(spark: SparkSession, sf_dir: str, k: int = K, seed: int = SEED) -> DataFrame:
    """S2 + F8 + F9 + F11 over document key points with repeated names:
    one row per sampled key point with the sizes of both "others" lists and
    the question-level removal check. A question with fewer than ``k`` key points
    keeps one row without a sample, status ``too_few_keypoints``."""
    sets = FX.keypoint_sets(TB.documents(spark, sf_dir).select("doc_id", "text", "source"),
                            duplicate_names=True)
    s = sets.withColumn("sampled", KP.sample_keypoints("keypoints", k, F.lit(seed), F.col("seq")))
    s = s.withColumn("n_removed_total", F.aggregate(
        "sampled", F.lit(0),
        lambda acc, x: acc + (F.size("keypoints")
                              - F.size(KP.others_by_name("keypoints", x["keypoint"])))))
    ex = s.select("seq", "keypoints", "n_removed_total",
                  F.posexplode_outer("sampled").alias("j", "sel"))
    some = F.col("j").isNotNull()
    return ex.select(
        "seq", "j", F.col("sel.keypoint").alias("keypoint"),
        F.when(some, F.size(KP.others_by_struct("keypoints", "sel"))).alias("n_others"),
        F.when(some, F.size(KP.others_by_name("keypoints", F.col("sel.keypoint")))).alias("n_remaining"),
        F.when(some, F.col("n_removed_total") == k).alias("all_distorted"),
        F.when(some, F.lit("ok")).otherwise(F.lit("too_few_keypoints")).alias("status"))


def generated(spark: SparkSession, sf_dir: str, backend: Backend | None = None,
              k: int = K, seed: int = SEED) -> DataFrame:
    """M6 over every self-check record derived from conversations."""
    qs = FX.qa_pairs(TB.conversations(spark, sf_dir))
    return KP.generate_mcqs(qs, backend or RuleBackend(), k=k, seed=seed,
                            carry=["chapter_name", "textbook_name", "chapter_url"])


def generated_mcqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checkable projection of the generated records."""
    g = generated(spark, sf_dir)
    n_audit = F.aggregate(F.map_values("prompt_and_response"), F.lit(0),
                          lambda acc, x: acc + F.size(x))
    return g.select("seq", "n_keypoints", "status", "correct_answer",
                    F.array_join("choices", "\n~\n").alias("choices_joined"),
                    "n_removed_total", n_audit.alias("n_audit"))


def generated_shuffled(spark: SparkSession, sf_dir: str, seed: int = SEED) -> DataFrame:
    """E2 end to end: generated choices -> seeded shuffle -> rendered MCQ
    (only records with status ``ok``)."""
    g = generated(spark, sf_dir).where(F.col("status") == "ok")
    sh = shuffle_choices(g, seed=seed)
    return sh.select("seq", "gold_index", "gold_letter", "gold_ambiguous", "mcq")


def generation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per status of the generated records, counted while they are written."""
    records, seen = KP.count_statuses(generated(spark, sf_dir))
    materialize(records, "generated")
    counts = seen.get  # a number per status
    return spark.createDataFrame([(s, counts[s]) for s in KP.STATUSES], "status string, n_questions bigint")
