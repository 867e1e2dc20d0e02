"""Distractor-prompt variants (M10-M16) over the self-check records derived
from conversations, and over crawled key terms (X19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.operators import distractors as D
from qbank.operators.infer import Backend, RuleBackend
from qbank.session import materialize
from qbank.sources import fixtures as FX
from qbank.sources import tables as TB


def _qs(spark, sf_dir) -> DataFrame:
    return FX.qa_pairs(TB.conversations(spark, sf_dir)).select(
        "seq", "question", "answer", "textbook_name")


def _joined(c):
    return F.array_join(c, "\n~\n").alias("choices_joined")


def direct_distractors(spark: SparkSession, sf_dir: str, backend: Backend | None = None):
    r = D.direct_distractors(_qs(spark, sf_dir), backend or RuleBackend())
    return r.select("seq", "reply_question", _joined(F.col("choices")), "check_reply")


def keypoint_distractors(spark, sf_dir, backend: Backend | None = None):
    r = D.keypoint_distractors(_qs(spark, sf_dir), backend or RuleBackend())
    return r.select("seq", "analysis", _joined(F.col("choices")))


def structured_distractors(spark, sf_dir, backend: Backend | None = None):
    return D.structured_distractors(_qs(spark, sf_dir), backend or RuleBackend())


def question_breakdowns(spark, sf_dir, backend: Backend | None = None):
    return D.question_breakdown(_qs(spark, sf_dir), backend or RuleBackend())


def feature_variant(spark, sf_dir, backend: Backend | None = None):
    r = D.feature_variant(_qs(spark, sf_dir), backend or RuleBackend())
    return r.select("seq", "n_features", "status", F.array_join("answers", "\n~\n").alias(
        "answers_joined"), "n_unchanged", "gold_index")


def term_distractors(spark, sf_dir, backend: Backend | None = None):
    """X19 (one row per crawled key term) -> M11."""
    from qbank.plans.crawl import _route
    kt = _route(spark, sf_dir, "econ", "key_terms")
    terms = kt.select("chapter_name", "textbook_name", F.posexplode("key_terms").alias("pos", "kt")) \
        .select("chapter_name", "textbook_name", "pos", F.col("kt.term").alias("term"),
                F.col("kt.definition").alias("definition"))
    terms = materialize(terms, "terms")  # crawled once; requests and replies are joined on it
    r = D.term_distractors(terms, backend or RuleBackend(), ["chapter_name", "pos"])
    return r.select("chapter_name", "pos", "term", _joined(F.col("choices")))
