"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` names a metric and the bounds it must keep. ``quality`` measures every
whole text with SQL functions only (no user functions, no shuffle), and compiles
the table into a single expression.

Edge cases: a null or empty text has no words and fails the length rule; a ratio
without a denominator counts as 0; repeated rows are judged alike; an empty table
gives an empty result; other columns are carried along whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qbank.llm.common import fresh, named, words

#: Frequent function words of the four languages served.
STOP_WORDS = (
    "the of and a to in is that for it was on are as with by at from this be "
    "de la el que y en los las un una por con para del se su es "
    "le les des et du est dans qui il au sur pour par "
    "der die und den von zu das mit sich ist im ein eine nicht auf dem"
).split()

#: (metric, least, most); None leaves a side open. The first row is the length rule
#: and the second the repetition rule; both reject regardless of the rest.
BASE_RULES = (("n_words", 20, None), ("repeat_share", None, 0.30))
RULES = (
    ("mean_word_chars", 2.0, 20.0),
    ("symbol_ratio", None, 0.10),
    ("stop_word_ratio", 0.01, None),
    ("dup_line_ratio", None, 0.40),
)
WINDOW = 8


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _within(metrics: dict[str, Column], rules) -> Column:
    tests = []
    for name, least, most in rules:
        if least is not None:
            tests.append(metrics[name] >= F.lit(least))
        if most is not None:
            tests.append(metrics[name] <= F.lit(most))
    return reduce(lambda a, b: a & b, tests)


def quality(df: DataFrame, text_col: str = "text", out: str = "quality") -> DataFrame:
    """``df`` with a struct column ``out``: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, the ratios, base_failed and kept.

    The steps are narrow projections stacked so that each intermediate array is
    computed once per row. Repeated windows are found by sorting the 64-bit
    hashes of a text's windows with their positions and comparing the words of
    neighbours with equal hashes; texts without equal hashes skip the sort.
    """
    t, ws, ls, hs, so, po = (fresh(df, f"__q_{x}") for x in ("t", "ws", "ls", "hs", "so", "po"))
    keep = [named(c) for c in df.columns if c != out]
    c = F.col
    step = df.select(*keep, F.coalesce(named(text_col), F.lit("")).alias(t))
    step = step.select(
        "*", words(c(t)).alias(ws),
        F.filter(F.split(c(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias(ls))
    n = F.size(ws)
    window = lambda i: F.slice(c(ws), i + 1, WINDOW)
    step = step.select(
        "*", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW),
                                             lambda i: F.xxhash64(*[F.get(c(ws), i + k) for k in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias(hs))
    none = F.array().cast("array<int>")
    step = step.select(
        "*", F.when(F.size(F.array_distinct(c(hs))) < F.size(hs),
                    F.sort_array(F.transform(c(hs), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
                    ).alias(so))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (window(a["i"]) == window(b["i"])), F.lit(False))

    step = step.select(
        "*", F.when(F.col(so).isNotNull(), F.sort_array(F.filter(
            F.transform(c(so), lambda s, k: F.when(
                same(s, F.get(c(so), k - 1)) | same(s, F.get(c(so), k + 1)), s["i"])),
            lambda x: x.isNotNull()))).otherwise(none).alias(po))
    # every repeated window covers WINDOW words, less what the next one covers
    covered = F.aggregate(
        F.transform(c(po), lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(c(po), k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x)
    counts = {
        "n_words": n.cast("bigint"),
        "word_chars": F.length(F.array_join(c(ws), "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(c(t), r"[#*$%&|<>]+", ""))).cast("bigint"),
        "n_lines": F.size(ls).cast("bigint"),
        "n_dup_lines": (F.size(ls) - F.size(F.array_distinct(c(ls)))).cast("bigint"),
        "n_repeat_words": covered,
        "n_stop_words": F.size(F.filter(c(ws), lambda w: F.lower(w).isin(STOP_WORDS))).cast("bigint"),
    }
    got = fresh(df, "__q_counts")
    step = step.select(*keep, F.struct(*[v.alias(k) for k, v in counts.items()]).alias(got))
    m = {k: c(got)[k] for k in counts}
    m |= {
        "repeat_share": _ratio(m["n_repeat_words"], m["n_words"]),
        "mean_word_chars": _ratio(m["word_chars"], m["n_words"]),
        "symbol_ratio": _ratio(m["n_symbols"], m["n_words"]),
        "stop_word_ratio": _ratio(m["n_stop_words"], m["n_words"]),
        "dup_line_ratio": _ratio(m["n_dup_lines"], m["n_lines"]),
    }
    # the repetition rule in whole numbers: 100 * repeated > 30 * words
    base_failed = (m["n_words"] < BASE_RULES[0][1]) | (
        100 * m["n_repeat_words"] > round(100 * BASE_RULES[1][2]) * m["n_words"])
    # spark_partition_id() is never negative; it only keeps the optimizer from
    # copying these expressions into a filter below the projections
    kept = ~base_failed & _within(m, RULES) & (F.spark_partition_id() >= 0)
    return step.select(*keep, F.struct(*[v.alias(k) for k, v in m.items()],
                                       base_failed.alias("base_failed"), kept.alias("kept")).alias(out))


def filter_quality(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that pass every rule, with the columns of ``df``."""
    q = fresh(df, "__quality")
    return quality(df, text_col, q).where(F.col(q)["kept"]).select(*[named(c) for c in df.columns])
