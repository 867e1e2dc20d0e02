"""Sink round trips: write with the library's sinks, read back with its
sources (explicit schemas), compare with the batch oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from qbank.operators import sections as SEC
from qbank.session import checkpoint_dir
from qbank.sources import io as IO


def _path(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


SECTION_COLS = ("doc_id BIGINT, section_name STRING, section_text STRING, chapter_name STRING, "
                "textbook_name STRING, chapter_url STRING, question STRING, answer STRING")


def feed_roundtrip(spark: SparkSession, sf_dir: str):
    """SNK1 -> SRC3."""
    from qbank.plans.feed import sections
    path = _path(spark, "feed")
    some = IO.write_feed(sections(spark, sf_dir), path, cheap=True)
    return IO.read_feed(spark, path, SECTION_COLS, some)


def delivery_roundtrip(spark: SparkSession, sf_dir: str):
    """P7 -> SNK3 -> text re-read -> decoded."""
    from qbank.plans.feed import LOAD_DATE, sections
    path = _path(spark, "delivery")
    IO.write_delivery(SEC.delivery_envelope(sections(spark, sf_dir), LOAD_DATE), path)
    schema = ("text STRING, metadata STRUCT<`date downloaded`: STRING, `site url`: STRING, "
              "`extra data`: STRUCT<chapter: STRING, section: STRING, textbook: STRING>>, "
              "`volunteer id` STRING, location STRING")
    r = F.from_json("value", schema)
    return IO.read_delivery(spark, path).select(
        r["text"].alias("text"), r["metadata"]["date downloaded"].alias("date_downloaded"),
        r["metadata"]["site url"].alias("site_url"),
        r["metadata"]["extra data"]["chapter"].alias("chapter"),
        r["metadata"]["extra data"]["section"].alias("section"),
        r["metadata"]["extra data"]["textbook"].alias("textbook"),
        r["volunteer id"].alias("volunteer_id"), r["location"].alias("location"))


def answer_log_roundtrip(spark: SparkSession, sf_dir: str):
    """SNK5 -> SRC5."""
    from qbank.plans.evaluation import answer_log
    path = _path(spark, "log")
    IO.write_log(answer_log(spark, sf_dir), path)
    return IO.reload_log(spark, path)


GENERATED_SCHEMA = (
    "seq DECIMAL(38,0), question STRING, answer STRING, chapter_name STRING, textbook_name STRING, "
    "chapter_url STRING, n_keypoints INT, status STRING, choices ARRAY<STRING>, "
    "correct_answer STRING, n_removed_total INT, "
    "prompt_and_response MAP<STRING, ARRAY<STRUCT<prompt: STRING, response: STRING>>>")


def generated_roundtrip(spark: SparkSession, sf_dir: str):
    """SNK2 (one JSON line per generated question, audit map included) -> SRC3."""
    from qbank.plans.generation import generated
    path = _path(spark, "generated")
    some = IO.write_feed(generated(spark, sf_dir).withColumn("type", F.lit("self-check-questions")), path)
    g = IO.read_feed(spark, path, GENERATED_SCHEMA, some)
    n_audit = F.aggregate(F.map_values("prompt_and_response"), F.lit(0),
                          lambda acc, x: acc + F.size(x))
    return g.select("seq", "n_keypoints", "status", "correct_answer",
                    F.array_join("choices", "\n~\n").alias("choices_joined"),
                    "n_removed_total", n_audit.alias("n_audit"))


SHUFFLED_SCHEMA = ("seq DECIMAL(38,0), source STRING, question STRING, choices ARRAY<STRING>, "
                   "shuffled ARRAY<STRING>, gold_index INT, gold_letter STRING, "
                   "gold_ambiguous BOOLEAN, mcq STRING")


def shuffled_roundtrip(spark: SparkSession, sf_dir: str):
    """SNK4: the shuffled questions as JSON lines (0-based gold index kept
    next to its letter) -> SRC3."""
    from qbank.plans.evaluation import shuffled_questions
    path = _path(spark, "shuffled")
    some = IO.write_feed(shuffled_questions(spark, sf_dir), path)
    return IO.read_feed(spark, path, SHUFFLED_SCHEMA, some).select(
        "seq", "source", "question", "gold_index", "gold_letter", "gold_ambiguous", "mcq")
