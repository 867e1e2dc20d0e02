"""SRC2: files that hold one JSON array of records each, read in parallel.

A JSON string holds no raw line feed, so every line of a file starts outside of a
string, and what a line adds to the nesting depth is known from the line alone. Splits
of a file are read apart; the depth at a split's start is the sum over the splits before
it (one number a split). A stretch of lines that ends at depth 1 or 0 holds whole records,
usually one record or a part of a line-wise array, and is parsed as a small array of its
own. A file on one line is one stretch. Files are read twice: for the sums of the splits,
and for the stretches, which are put together where they are read; only the first and the
last piece of a split are shuffled to those of its neighbours.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Escaped characters; once they are gone, a string ends at the next quote.
_ESCAPED, _STRING = r"\\.", r'"[^"]*+"'


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType | str,
                    corrupt_column: str | None = None) -> DataFrame:
    """The records of all arrays at ``path`` (files or folders). A stretch that can't be
    parsed gives a row of nulls, with its text in ``corrupt_column`` if one is named."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    bare = F.regexp_replace(F.regexp_replace("value", _ESCAPED, ""), _STRING, "")
    lines = lines.withColumn("step", _count(bare, "[{") - _count(bare, "]}"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # of each split: lines by the depth after them, from 0 at its start
    splits = lines.select("file", "block", "step").mapInArrow(_depths, "file string, block bigint, total bigint, depths array<struct<d:bigint,n:bigint>>")
    splits = splits.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    closes = F.aggregate(F.filter("depths", lambda x: x["d"] + F.col("base") <= 1), F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    splits = splits.withColumn("nth", F.coalesce(F.sum(closes).over(earlier), F.lit(0)))
    lines = lines.join(F.broadcast(splits.select("file", "block", "base", "nth")), ["file", "block"], "left")
    pieces = lines.select("file", "block", "value", "step", "base", "nth").mapInArrow(
        _stretches, "file string, block bigint, nth bigint, whole boolean, text string")
    torn = pieces.where(~F.col("whole")).groupBy("file", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("l"))
    torn = torn.select("file", "nth", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("text"))
    parts = pieces.where("whole").select("file", "nth", "text").unionByName(torn)
    text = F.col("text")
    text = F.regexp_replace(F.regexp_replace(text, r"^[\s,\[]+", ""), r"[\s,\]]+$", "")
    parts = parts.select("file", "nth", text.alias("text")).where("text <> ''")
    rows = parts.withColumn("r", F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), T.ArrayType(schema)))
    bad = F.col("r").isNull() | F.exists(F.coalesce("r", F.array()), lambda x: x.isNull())
    rows = rows.select("text", bad.alias("bad"), F.explode_outer("r").alias("r"))
    cols = [F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields]
    if corrupt_column:
        cols.append(F.when(F.col("bad"), F.col("text")).alias(corrupt_column))
    return rows.select(*cols)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(file, block) and the other columns of its next lines, in file order. A task reads
    the splits that it has got one after the other."""
    for b in batches:
        rows = list(zip(*[c.to_pylist() for c in b.columns]))
        start = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i][:2] != rows[start][:2]:
                yield rows[start][:2], [r[2:] for r in rows[start:i]]
                start = i


def _depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shape = pa.list_(pa.struct([("d", pa.int64()), ("n", pa.int64())]))

    def split(key, depth, seen):
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([depth], pa.int64()),
             pa.array([[{"d": d, "n": n} for d, n in seen.items()]], shape)], names=["file", "block", "total", "depths"])
    at, depth, seen = None, 0, Counter()
    for key, rows in _by_split(batches):
        if key != at:
            if at is not None:
                yield split(at, depth, seen)
            at, depth, seen = key, 0, Counter()
        for step, in rows:
            depth += step
            seen[depth] += 1
    if at is not None:
        yield split(at, depth, seen)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of each split; ``whole``: it surely has no lines in another split."""
    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    names, types = ["file", "block", "nth", "whole", "text"], [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    at, lines = None, []
    for key, rows in _by_split(batches):
        out = []
        if key != at:
            if lines:
                out.append((*at, nth, False, "\n".join(lines)))
            at, lines, (_, _, depth, nth), whole = key, [], rows[0], key[1] == 0
            if depth is None:
                raise RuntimeError(f"{key[0]} was split otherwise when it was read again")
        for value, step, _, _ in rows:
            depth += step
            lines.append(value)
            if depth <= 1:
                out.append((*at, nth, whole, "\n".join(lines)))
                lines, nth, whole = [], nth + 1, True
        if out:
            yield batch(out)
    if lines:
        yield batch([(*at, nth, False, "\n".join(lines))])


def write_json_arrays(df: DataFrame, path: str, indent: int | None = None, mode: str = "overwrite") -> None:
    """One JSON array a task, a record a line (or indented over several)."""
    record = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sign = "["
        for b in batches:
            out = []
            for text in b["value"]:
                out.append(sign + (json.dumps(json.loads(text), indent=indent, ensure_ascii=False) if indent else text))
                sign = ","
            if out:
                yield pd.DataFrame({"value": out})
        yield pd.DataFrame({"value": ["]" if sign == "," else "[]"]})
    df.select(record.alias("value")).mapInPandas(run, "value string").write.mode(mode).text(path)
