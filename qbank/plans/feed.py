"""E1 jobs that do not need markup: URL columns, section feed, splits,
counts, self-check questions and the delivery envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.functions import url as U
from qbank.operators import sections as SEC
from qbank.operators.evaluate import row_index
from qbank.sources import fixtures as FX
from qbank.sources import tables as TB

LOAD_DATE = "2024-11-01"


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P4 over every page URL (only ``page_id, url`` are read)."""
    p = TB.pages(spark, sf_dir).select("page_id", "url")
    return p.select("page_id",
                    U.chapter_name("url").alias("chapter_name"),
                    U.textbook_name("url").alias("textbook_name"),
                    U.section_slug(U.chapter_name("url")).alias("section_name"),
                    U.base_url("url").alias("base_url"))


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FX.sections(TB.documents(spark, sf_dir).select("doc_id", "text", "source"))


def section_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SEC.section_counts(sections(spark, sf_dir))


def self_check_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + P9 + W1: the self-check split, cleaned, indexed in file order."""
    sc = SEC.split_sections(sections(spark, sf_dir))[SEC.SELF_CHECK]
    sc = SEC.with_clean_question(sc.select("doc_id", "chapter_name", "question", "answer"))
    return row_index(sc, "doc_id")


def qa_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q/A records from conversations with P9 cleaning."""
    return SEC.with_clean_question(FX.qa_pairs(TB.conversations(spark, sf_dir)))


def delivery_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + SNK3 payload, decoded back from JSON and flattened for checking."""
    env = SEC.envelope_json(SEC.delivery_envelope(sections(spark, sf_dir), LOAD_DATE))
    schema = ("text STRING, metadata STRUCT<`date downloaded`: STRING, `site url`: STRING, "
              "`extra data`: STRUCT<chapter: STRING, section: STRING, textbook: STRING>>, "
              "`volunteer id` STRING, location STRING")
    r = F.from_json("value", schema)
    return env.select(
        r["text"].alias("text"),
        r["metadata"]["date downloaded"].alias("date_downloaded"),
        r["metadata"]["site url"].alias("site_url"),
        r["metadata"]["extra data"]["chapter"].alias("chapter"),
        r["metadata"]["extra data"]["section"].alias("section"),
        r["metadata"]["extra data"]["textbook"].alias("textbook"),
        r["volunteer id"].alias("volunteer_id"),
        r["location"].alias("location"),
    )
