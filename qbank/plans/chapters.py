"""Chapter-page callbacks of the economics crawl (X3, X8-X12): applied to the
rendered chapter and self-check pages directly (the crawl does not route to
them, as in the original spider)."""

from __future__ import annotations

from pyspark.sql import functions as F

from qbank.functions import url as U
from qbank.operators import extract as X
from qbank.operators.dom import dom_nodes
from qbank.plans.crawl import site


def _parsed(spark, sf_dir, page, which=None):
    """The pages of a kind, parsed; ``which``: a condition on the URL, asked before parsing."""
    p = site(spark, sf_dir).where(F.col("page") == page).select("url", "html")
    if which is not None:
        p = p.where(which)
    return dom_nodes(p, keep=["url"]).withColumn("chapter_name", U.chapter_name("url"))


def econ_chapter_sections(spark, sf_dir):
    """X12 (+X11 inside sections): one row per section block of a chapter."""
    n = _parsed(spark, sf_dir, "chapter")
    return n.select("chapter_name", F.posexplode(X.section_blocks("nodes")).alias("pos", "s")) \
        .select("chapter_name", "pos", F.col("s.section_name").alias("section_name"),
                F.col("s.section_text").alias("section_text"))


def econ_chapter_intro(spark, sf_dir):
    """X10 + X11: the chapter's own text (title newline quirk, sections and
    boxes removed) and the number of chapter-level boxes."""
    n = _parsed(spark, sf_dir, "chapter")
    intro = X.chapter_intro_econ("nodes")
    return n.select("chapter_name", intro["section_name"].alias("section_name"),
                    intro["section_text"].alias("section_text"),
                    F.size(X.special_boxes("nodes")).alias("n_boxes"))


def econ_problem_texts(spark, sf_dir):
    """All problem text of a page as one record."""
    n = _parsed(spark, sf_dir, "content", F.col("url").endswith("-self-check-questions"))
    return n.select("chapter_name", U.section_slug("chapter_name").alias("section_name"),
                    X.problems_text("nodes").alias("section_text"))


def econ_chapter_feed(spark, sf_dir):
    """X10-X12 as the chapter callback's record stream (one row per record)."""
    n = _parsed(spark, sf_dir, "chapter")
    return n.select("chapter_name", F.posexplode(X.chapter_records_econ("nodes")).alias("pos", "r")) \
        .select("chapter_name", "pos", F.col("r.section_name").alias("section_name"),
                F.col("r.section_text").alias("section_text"))
