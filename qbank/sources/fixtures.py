"""Adapters that derive the question-bank record types from the given tables.

The workflow's own inputs (crawled sections, generated questions) are not
shipped, so each record type is derived by Spark from ``documents`` and
``conversations``; the work grows with those tables. The SQL oracles derive
the same rows with DuckDB.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qbank.functions import text as TX
from qbank.functions.url import chapter_name, section_slug, textbook_name

BOOK_HOST = "https://books.example.org/books/"
# The three section classes of an economics book, by link slug.
SECTION_SLUGS = ["self-check-questions", "key-terms", "key-concepts-and-summary"]


#: Lines of a choice set: four choices (gold first), then the question.
SET_LINES = 5


def pair_key(major, minor) -> Column:
    """One number for a pair of long keys, in the order of the pair and without
    collisions: ``major * 10**19 + minor`` as decimal(38)."""
    wide = lambda c: F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)")
    return (wide(major) * F.lit(Decimal(10) ** 19).cast("decimal(20,0)")
            + wide(minor)).cast("decimal(38,0)")


def choice_sets(documents: DataFrame) -> DataFrame:
    """Every block of five lines of every text: choices = its first four lines
    (gold first), question = the last. A short last block keeps its last line as
    the question and the lines before it as fewer choices; a block of one line
    has no choices and is left to the quarantine. ``seq`` = (doc_id, block)."""
    ln = TX.lines("text")
    blocks = documents.select("doc_id", "source", ln.alias("lines")).select(
        "doc_id", "source", "lines",
        F.explode(F.sequence(F.lit(0), F.expr(f"(size(lines) - 1) div {SET_LINES}").cast("int"))).alias("block"))
    rows = blocks.select("doc_id", "source", "block",
                         F.slice("lines", F.col("block") * SET_LINES + 1, F.lit(SET_LINES)).alias("lines"))
    return rows.select(pair_key("doc_id", "block").alias("seq"), "source",
                       F.element_at("lines", -1).alias("question"),
                       F.slice("lines", F.lit(1), F.size("lines") - 1).alias("choices"))


def section_urls(documents: DataFrame) -> DataFrame:
    """One chapter URL per document and section class:
    ``.../books/{source}/pages/{doc_id}-{slug}`` (every document is a section
    of each of the three classes)."""
    d = documents.select("doc_id", "text", "source",
                         F.explode(F.array(*[F.lit(s) for s in SECTION_SLUGS])).alias("slug"))
    url = F.concat(F.lit(BOOK_HOST), F.col("source"), F.lit("/pages/"),
                   F.col("doc_id").cast("string"), F.lit("-"), F.col("slug"))
    return d.select("doc_id", "text", "source", url.alias("chapter_url"))


def sections(documents: DataFrame) -> DataFrame:
    """D2-D5 sections: canonical wide schema. Self-check rows carry the first
    line as the question (numbered ``N.``) and the rest as the answer."""
    d = section_urls(documents)
    cn = chapter_name("chapter_url")
    is_sc = cn.endswith("-self-check-questions")
    ln = TX.lines("text")
    question = F.concat(F.lit("\n"), (F.col("doc_id") % 20 + 1).cast("string"), F.lit(". \n\n"),
                        F.element_at(ln, 1), F.lit("\n"))
    answer = F.array_join(F.slice(ln, 2, F.greatest(F.size(ln) - 1, F.lit(0))), "\n")
    return d.select(
        "doc_id",
        F.when(is_sc, F.lit("self-check-questions")).otherwise(section_slug(cn)).alias("section_name"),
        F.when(is_sc, TX.qa_text(question, answer)).otherwise(F.col("text")).alias("section_text"),
        cn.alias("chapter_name"),
        textbook_name("chapter_url").alias("textbook_name"),
        F.col("chapter_url"),
        F.when(is_sc, question).alias("question"),
        F.when(is_sc, answer).alias("answer"),
    )


def qa_pairs(conversations: DataFrame) -> DataFrame:
    """Self-check question records from conversations: a user turn and the
    assistant turn right after it (same conv_id, turn + 1)."""
    u = conversations.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("q"))
    a = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a"))
    url = F.concat(F.lit(BOOK_HOST), F.lit("conversations/pages/"),
                   F.col("conv_id").cast("string"), F.lit("-self-check-questions"))
    question = F.concat(F.lit("\n"), F.expr("turn div 2 + 1").cast("string"),
                        F.lit(". \n\n"), F.col("q"), F.lit("\n"))
    return (u.join(a, ["conv_id", "turn"])
            .select(pair_key("conv_id", "turn").alias("seq"),
                    question.alias("question"), F.col("a").alias("answer"),
                    url.alias("chapter_url"))
            .select("seq", F.lit("self-check-questions").alias("section_name"),
                    TX.qa_text("question", "answer").alias("section_text"),
                    chapter_name("chapter_url").alias("chapter_name"),
                    textbook_name("chapter_url").alias("textbook_name"),
                    "chapter_url", "question", "answer"))


def keypoint_sets(documents: DataFrame, duplicate_names: bool = False) -> DataFrame:
    """Key points of every document: ``keypoint = 'kp' || pos``,
    ``detail = line``. With ``duplicate_names`` every third name repeats the
    one before it (exercises name-based removal, trap T3)."""
    ln = TX.lines("text")
    def name(i):
        pos = i + 1
        if duplicate_names:
            pos = F.when((i + 1) % 3 == 0, i).otherwise(i + 1)
        return F.concat(F.lit("kp"), pos.cast("string"))
    return (documents.select("doc_id", "source", ln.alias("lines"))
            .select(F.col("doc_id").alias("seq"), "source",
                    F.element_at("lines", 1).alias("question"),
                    F.transform("lines", lambda x, i: F.struct(name(i).alias("keypoint"),
                                                               x.alias("detail"))).alias("keypoints")))
