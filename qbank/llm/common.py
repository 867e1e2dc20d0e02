"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.session import checkpoint_dir
from qbank.sources.tables import SCHEMAS, table_path

#: A word: a run of characters other than space, \t, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["documents"]).parquet(table_path(sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["conversations"]).parquet(table_path(sf_dir, "conversations"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage,
    survives lost executors and lets several readers share the work."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name = "_" + name
    return name


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def words(text: Column) -> Column:
    """The array of words of ``text`` (null: none)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1), uniform over distinct keys and the same in any engine:
    the first 52 bits of the MD5 of the parts joined by ``:`` (null: empty)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(2.0 ** 52)
