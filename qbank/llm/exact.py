"""Exact de-duplication over an extendible-hash index kept in shared files.

The key of a text is its 64-bit hash. A combiner first collapses copies on the map side,
apart for each of ``COMBINERS`` residues of the input partition, so a text that a third
of all rows hold weighs at most that many entries; it settles nothing. The entries (key,
text, the combiner's largest id and count) are written as the pages of the index.

The directory starts as one bucket. A bucket that holds more than ``BUCKET_ENTRIES``
entries is split on its next key bit, which makes the directory deeper, and its halves
again, until all fit; only entries with one and the same key stay together at any
number. Counts are taken for ``STEP`` bits at a time, over the keys of the buckets that
are still overfull, so there is no greatest depth but the key's.

Each bucket, a range of keys, goes to one owner task. The owner sorts its entries by key
and bytes and walks the chain of every key: an entry whose bytes differ from those of the
one before it is the next link. The id that stays and the size of the group are read off
the links. Rows find their link by key, length in bytes and SHA-256.

Edge cases: a null text counts as empty; of equal texts the largest id stays (null
ids lose, and stay only where all are null); of repeated rows with that id exactly
one stays, in ``deduplicate`` the one with the smallest hash of all its columns; an empty
table gives an empty result; other columns don't matter, whatever their names. A text is
one value of a row: a task holds a few of them, up to Spark's 2 GB for a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import fresh, named, written

#: Entries that a bucket holds before it splits.
BUCKET_ENTRIES = 20_000
#: Entries that copies of one text may leave behind the combiner.
COMBINERS = 64
#: Key bits by which the directory may deepen in one pass over the keys.
STEP = 8
#: A bucket's number is a leading 1 and its bits, which fills a long at this depth.
KEY_BITS = 63


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _slot(key: Column, depth: int) -> Column:
    """The number of the bucket of ``depth`` bits that a key belongs to."""
    bits = F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")
    return bits + F.lit(1 << depth if depth < 63 else -(1 << 63))


def entries(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The combiner: key, text, id (the largest) and rows, a few per text at most."""
    texts = df.select(named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    return (texts.groupBy(_key(F.col("text")).alias("key"), "text", (F.spark_partition_id() % COMBINERS).alias("part"))
            .agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("rows")).drop("part"))


def directory(pages: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """bucket, depth: the buckets that overfull ones were split into, over ``pages`` (key)."""
    keys, depth, opened, found = pages.select("key"), 0, None, []
    while depth < KEY_BITS:
        deep = min(depth + STEP, KEY_BITS)
        if opened is not None:  # only buckets that are still overfull
            keys = keys.withColumn("bucket", _slot(F.col("key"), depth)).join(opened, "bucket", "left_semi").select("key")
        fine = keys.groupBy(_slot(F.col("key"), deep).alias("slot")).agg(
            F.count(F.lit(1)).alias("held"), F.min("key").alias("low"), F.max("key").alias("high"))
        levels = fine.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(deep))))
        nodes = (levels.groupBy("depth", F.expr(f"shiftrightunsigned(slot, {deep} - depth)").alias("bucket"))
                 .agg(F.sum("held").alias("held"), F.min("low").alias("low"), F.max("high").alias("high")))
        # keys that are all the same have no bit to be split on
        over = (F.col("held") > bucket_entries) & (F.col("low") < F.col("high"))
        nodes = written(nodes.select("depth", "bucket", over.alias("over")), "exact-nodes")
        split = nodes.where("over").select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
        halves = nodes.withColumn("parent", F.shiftrightunsigned("bucket", 1)).join(split, ["depth", "parent"], "left_semi")
        if depth == 0:
            halves = halves.unionByName(nodes.where("depth = 0").withColumn("parent", F.lit(0).cast("bigint")))
        fits = ~F.col("over") | (F.col("depth") == KEY_BITS)
        found.append(halves.where(fits).select("bucket", "depth"))
        opened = nodes.where(F.col("over") & (F.col("depth") == deep)).select("bucket")
        depth = deep
        if opened.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return written(out, "exact-directory")


def placed(rows: DataFrame, where: DataFrame) -> DataFrame:
    """``rows`` (with a key) and their ``bucket``. The directory is looked up once per
    depth that occurs in it (at most 63, a few with hashed keys)."""
    out = rows.withColumn("bucket", F.lit(None).cast("bigint"))
    for depth in sorted(r.depth for r in where.select("depth").distinct().collect()):
        at = where.where(F.col("depth") == depth).select(F.col("bucket").alias("found"))
        out = (out.join(at, _slot(F.col("key"), depth) == F.col("found"), "left")
               .withColumn("bucket", F.coalesce("bucket", "found")).drop("found"))
    return out


def walked(owned: DataFrame) -> DataFrame:
    """One row per link of every key's chain: bucket, key, chain (1 for the first),
    n_bytes, text_sha256, keep_id and group_size."""
    walk = Window.partitionBy("bucket", "key").orderBy(F.col("text").cast("binary"))
    after = F.lag(F.col("text").cast("binary")).over(walk)
    steps = owned.withColumn("next", F.when(after == F.col("text").cast("binary"), 0).otherwise(1))
    steps = steps.withColumn("chain", F.sum("next").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
    # the text of a link is needed once, at its first entry
    first = F.col("next") == 1
    steps = steps.select("bucket", "key", "chain", "id", "rows",
                         F.when(first, F.octet_length("text")).alias("n_bytes"),
                         F.when(first, F.sha2("text", 256)).alias("text_sha256"))
    return steps.groupBy("bucket", "key", "chain").agg(
        F.max("n_bytes").alias("n_bytes"), F.max("text_sha256").alias("text_sha256"),
        F.max("id").alias("keep_id"), F.sum("rows").alias("group_size"))


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, DataFrame]:
    """The directory (bucket, depth) and the links of ``walked``, both in the shared folder."""
    pages = written(entries(df, id_col, text_col), "exact-pages")
    where = directory(pages, bucket_entries)
    owned = placed(pages, where).repartition("bucket")
    return where, written(walked(owned), "exact-buckets")


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """Per row of ``df``: the id, keep_id, group_size, kept, text_sha256, bucket and chain."""
    _, links = build_index(df, id_col, text_col, bucket_entries)
    text = F.coalesce(named(text_col), F.lit(""))
    rows = df.select(named(id_col).alias("id"), _key(text).alias("key"), F.octet_length(text).alias("n_bytes"),
                     F.sha2(text, 256).alias("text_sha256"))
    # which of the rows with the same id and text this is
    again = Window.partitionBy("id", "key", "text_sha256").orderBy("id")
    rows = rows.withColumn("copy", F.row_number().over(again))
    found = rows.join(links, ["key", "n_bytes", "text_sha256"])
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256",
                        "bucket", "chain")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """The rows of ``df`` that stay, with its columns."""
    def row_key(i: Column, sha: Column) -> Column:
        return F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("null")), sha)

    _, links = build_index(df, id_col, text_col, bucket_entries)
    k, nth = fresh(df, "__row_key"), fresh(df, "__nth")
    stay = links.select(row_key(F.col("keep_id"), F.col("text_sha256")).alias(k))
    text = F.coalesce(named(text_col), F.lit(""))
    rows = df.withColumn(k, row_key(named(id_col), F.sha2(text, 256))).join(stay, k, "left_semi")
    plain = [named(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = Window.partitionBy(k).orderBy(F.xxhash64(*plain))
    return rows.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(k, nth)
