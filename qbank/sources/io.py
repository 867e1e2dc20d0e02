"""Feed and log readers/writers (SRC2-SRC6, SNK1-SNK5). Every read states its
schema; every write is a plain Spark writer (one file per task, no driver
round trip)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qbank.sources.json_array import read_json_array, write_json_arrays  # noqa: F401  (SRC2)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str,
               corrupt_column: str | None = "_corrupt_record") -> DataFrame:
    """SRC3: JSON lines (splittable). Malformed lines are kept with NULL fields
    and their text in ``corrupt_column`` instead of failing the job."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    r = spark.read.option("mode", "PERMISSIVE")
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    return r.schema(schema).json(path)


def write_feed(df: DataFrame, path: str, mode: str = "overwrite", cheap: bool = False) -> bool:
    """SNK1 / SNK2 / SNK4: UTF-8 JSON lines, all fields; no output for an
    empty feed (``read_feed`` gives no rows then). Returns whether anything was
    written. The feed is computed once, into the shared folder; a ``cheap`` one (rows
    projected from a table) is asked for its first row instead, and written once."""
    from qbank.session import materialize
    if not cheap:
        df = materialize(df, "feed")
    if df.isEmpty():
        return False
    df.write.mode(mode).option("encoding", "UTF-8").option("ignoreNullFields", False).json(path)
    return True


def read_feed(spark: SparkSession, path: str, schema: T.StructType | str, written: bool) -> DataFrame:
    """A feed that ``write_feed`` wrote, or no rows where it wrote nothing."""
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def write_delivery(envelopes: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK3: one JSON text per delivery record; field order and the spaced
    field names are kept."""
    envelopes.select(F.to_json("record").alias("value")).write.mode(mode).text(path)


def read_delivery(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def write_log(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK5: persist a log table (Parquet in place of a pickle)."""
    log.write.mode(mode).parquet(path)


def reload_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: re-read a persisted log."""
    return spark.read.parquet(path)


# The book catalog of the original notes (subject, title,
# licence, book slug as it appears in page URLs).
CATALOG = [
    ("Econ", "Principles of Economics 3e", "CC BY", "principles-economics-3e"),
    ("Econ", "Principles of Microeconomics 3e", "CC BY", "principles-microeconomics-3e"),
    ("Econ", "Principles of Macroeconomics 3e", "CC BY", "principles-macroeconomics-3e"),
    ("Finance", "Principles of Finance", "CC BY", "principles-finance"),
    ("Finance", "Principles of Financial Accounting", "CC BY", "principles-financial-accounting"),
    ("Finance", "Principles of Managerial Accounting", "CC BY", "principles-managerial-accounting"),
    ("Business", "Introduction to Business", "CC BY", "introduction-business"),
    ("Business", "Principles of Management", "CC BY", "principles-management"),
    ("Business", "Principles of Marketing", "CC BY", "principles-marketing"),
]


def catalog(spark: SparkSession) -> DataFrame:
    """SRC6: the book dimension, keyed by ``textbook_name`` (P2 of a book's
    page URLs). Nine rows: always safe to broadcast."""
    return spark.createDataFrame(
        CATALOG, "subject string, title string, license string, textbook_name string")


def licensed(sections: DataFrame, cat: DataFrame, license: str = "CC BY") -> DataFrame:
    """Keep sections of catalogued books under ``license`` (semi-join on the catalog)."""
    from qbank.operators.joins import semi_join
    ok = cat.where(F.col("license") == license).select("textbook_name")
    return semi_join(sections, ok, "textbook_name")
