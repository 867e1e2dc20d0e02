"""Scans of the input tables with explicit schemas (never inference).

Each reader returns a lazy DataFrame; callers select only the columns they
need, and Catalyst prunes the Parquet scan to them (``ReadSchema``) and pushes
filters into it (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S = T.StructField
STR, LONG, INT, DBL = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

SCHEMAS: dict[str, T.StructType] = {
    "pages": T.StructType([S("page_id", LONG), S("url", STR), S("html", STR)]),
    "documents": T.StructType([S("doc_id", LONG), S("text", STR), S("lang", STR),
                               S("source", STR), S("n_chars", LONG)]),
    "conversations": T.StructType([S("conv_id", LONG), S("turn", LONG), S("role", STR),
                                   S("text", STR)]),
    "benchmark": T.StructType([S("item_id", LONG), S("text", STR)]),
    "labels": T.StructType([S("doc_id", LONG), S("quality", INT), S("toxic", INT)]),
    "events": T.StructType([S("event_id", LONG), S("ts", T.TimestampNTZType()),
                            S("user_id", LONG), S("event_type", STR), S("value", DBL),
                            S("props", STR)]),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def pages(spark, sf_dir): return read_table(spark, sf_dir, "pages")
def documents(spark, sf_dir): return read_table(spark, sf_dir, "documents")
def conversations(spark, sf_dir): return read_table(spark, sf_dir, "conversations")
