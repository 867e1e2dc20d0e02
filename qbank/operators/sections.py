"""Section records: routing split (F3), union of heterogeneous feeds (U1),
counts (A1), the delivery envelope (P7, P8) and link de-duplication (U2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qbank.functions import text as TX

# The three section classes the generation step reads.
SELF_CHECK = "self-check-questions"
KEY_TERMS = "keyterms"
KEY_CONCEPTS = "keyconceptsandsummary"

# Canonical wide section schema (union of all record shapes; ``chapter_text``
# of the finance records is folded into ``section_text``).
PAIR = lambda a, b: T.ArrayType(T.StructType([T.StructField(a, T.StringType()),
                                              T.StructField(b, T.StringType())]))
SECTION_SCHEMA = T.StructType([
    T.StructField("section_name", T.StringType()),
    T.StructField("section_text", T.StringType()),
    T.StructField("chapter_name", T.StringType()),
    T.StructField("textbook_name", T.StringType()),
    T.StructField("chapter_url", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("key_terms", PAIR("term", "definition")),
    T.StructField("key_concepts_and_summary", PAIR("concept", "definition")),
    T.StructField("questions_and_answers", PAIR("question", "answer")),
    T.StructField("questions_with_choices", T.ArrayType(T.StructType([
        T.StructField("question", T.StringType()),
        T.StructField("choices", T.ArrayType(T.StringType()))]))),
    T.StructField("questions", PAIR("question_number", "question")),
])


def to_canonical(df: DataFrame) -> DataFrame:
    """Fold ``chapter_text`` into ``section_text`` and add missing columns as NULL."""
    if "chapter_text" in df.columns:
        st = (F.coalesce(F.col("section_text"), F.col("chapter_text"))
              if "section_text" in df.columns else F.col("chapter_text"))
        df = df.withColumn("section_text", st).drop("chapter_text")
    extra = [c for c in df.columns if c not in SECTION_SCHEMA.fieldNames()]
    cols = [(F.col(f.name).cast(f.dataType) if f.name in df.columns
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in SECTION_SCHEMA.fields]
    return df.select(*extra, *cols)


def union_sections(*feeds: DataFrame) -> DataFrame:
    """One feed from heterogeneous callbacks (missing columns NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [to_canonical(f) for f in feeds])


def split_sections(sections: DataFrame) -> dict[str, DataFrame]:
    """three lazily filtered views by exact section_name; others are ignored.
    On a single scan Catalyst pushes each predicate into the Parquet reader."""
    return {name: sections.where(F.col("section_name") == name)
            for name in (SELF_CHECK, KEY_TERMS, KEY_CONCEPTS)}


def section_counts(sections: DataFrame) -> DataFrame:
    """A1: rows per section class (partial aggregate before the shuffle)."""
    return sections.groupBy("section_name").agg(F.count(F.lit(1)).alias("n_sections"))


def with_clean_question(df: DataFrame, question: str = "question") -> DataFrame:
    """P9 as a column ``clean_question``."""
    return df.withColumn("clean_question", TX.clean_question(F.col(question)))


# Delivery constants of the original export.
VOLUNTEER_ID = "2052"
LOCATION = "Atlanta, USA"


def delivery_envelope(sections: DataFrame, load_date: str, volunteer_id: str = VOLUNTEER_ID,
                      location: str = LOCATION, sentence_split: bool = False) -> DataFrame:
    """Nest a section into the delivery record (field names with
    spaces kept). ``load_date`` is an argument so reruns are reproducible."""
    text = TX.sentence_text("section_text") if sentence_split else F.col("section_text")
    meta = F.struct(
        F.date_format(F.to_date(F.lit(load_date)), "yyyy-MM-dd").alias("date downloaded"),
        F.col("chapter_url").alias("site url"),
        F.struct(F.col("chapter_name").alias("chapter"), F.col("section_name").alias("section"),
                 F.col("textbook_name").alias("textbook")).alias("extra data"))
    return sections.select(F.struct(text.alias("text"), meta.alias("metadata"),
                                    F.lit(volunteer_id).alias("volunteer id"),
                                    F.lit(location).alias("location")).alias("record"))


def envelope_json(envelopes: DataFrame) -> DataFrame:
    """SNK3 payload: one JSON text per record, field order kept."""
    return envelopes.select(F.to_json("record").alias("value"))


def dedup_links(links: DataFrame, url_col: str = "resolved_url",
                order: list[str] | None = None) -> DataFrame:
    """Visit each routed URL once, by the route of its first link in ``order``
    (answer-page joins opt out by not calling this)."""
    by = F.struct(*(order or []), "route")
    return links.groupBy(url_col).agg(F.min_by("route", by).alias("route"))
