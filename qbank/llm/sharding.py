"""Sharding by weighted rendezvous hashing of a stable record key.

Every (key, shard) pair has a score, -weight / ln(u) with u the pair's unit hash;
a row goes to the shard with the largest score. A shard's scores do not depend on
the other shards, so one more shard only takes rows into itself, and a changed
weight only moves rows into or out of that shard.

Edge cases: a null key counts as one key of its own; rows of one key share its
shard; a null text has size 1 and the checksum of the empty text; an empty table
gives an empty result. Repeated rows get different slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import named, unit_hash

#: Ranges of row hashes that slots are counted over: bounds what one task sorts to
#: 1/4096 of a shard, and the table of counts to 4096 rows a shard.
SLOT_RANGES_HEX = 3


def _score(key: Column, name: int, weight: float) -> Column:
    """What shard ``name`` bids for the key; ties go to the lowest name."""
    return F.struct((F.lit(float(weight)) / -F.log(unit_hash(key, F.lit(name)))).alias("score"),
                    F.lit(-name).alias("minus"))


def best_bid(key: Column, weights: list[float]) -> Column:
    """The winning (score, -shard) over shards 0 to len(weights) - 1."""
    bids = [_score(key, n, w) for n, w in enumerate(weights) if w > 0]
    return F.greatest(*bids) if len(bids) > 1 else bids[0]


def assign(df: DataFrame, key_col: str, weights: list[float], out: str = "shard") -> DataFrame:
    """``df`` with the shard of each row: a narrow projection."""
    return df.withColumn(out, (-best_bid(named(key_col), weights)["minus"]).cast("int"))


def write_shards(df: DataFrame, path: str, key_col: str, weights: list[float]) -> None:
    """``df`` as Parquet in one folder per shard. Each task writes its own rows of a
    shard, so a large shard is never gathered."""
    assign(df, key_col, weights).write.partitionBy("shard").parquet(path)


def shard_slots(df: DataFrame, key_col: str, text_col: str, weights: list[float]) -> DataFrame:
    """doc_id (the key), size, text_crc32, law, shard, slot and grown_shard per row.

    Slots number a shard's rows from 0 in the order of a row hash. They are counted
    in two levels: rows per (shard, hash range), summed over the ranges before, plus
    the rank inside the range, so no task sees a whole shard.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    key = named(key_col)
    rows = df.select(
        key.alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        best_bid(key, weights).alias("bid"))
    # rows that share a key spread over the ranges by their texts
    row_hash = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                 F.col("text_crc32").cast("string")))
    rows = rows.select(
        "doc_id", "size", "text_crc32", (-F.col("bid")["minus"]).cast("int").alias("shard"),
        (-F.greatest("bid", _score(F.col("doc_id"), len(weights), 1.0))["minus"])
        .cast("int").alias("grown_shard"),
        row_hash.alias("row_hash"))
    rows = rows.withColumn("range", F.substring("row_hash", 1, SLOT_RANGES_HEX))
    counts = rows.groupBy("shard", "range").count()
    before = counts.select(
        "shard", "range",
        (F.sum("count").over(Window.partitionBy("shard").orderBy("range")) - F.col("count")).alias("before"))
    in_range = Window.partitionBy("shard", "range").orderBy("row_hash", "doc_id", "size")
    return (rows.withColumn("rank", F.row_number().over(in_range) - 1)
            .join(before, ["shard", "range"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("before") + F.col("rank")).cast("bigint").alias("slot"), "grown_shard"))
