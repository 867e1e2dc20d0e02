"""MCQ assembly: shuffle with gold tracking (S1), rendering (P11), letters
(P12, P14), quarantine of unrenderable rows (T13, T14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qbank.functions import choices as CH


def shuffle_choices(df: DataFrame, *, choices: str = "choices", row_id: str = "seq",
                    question: str = "question", seed: int = 42) -> DataFrame:
    """Adds ``shuffled`` (the permuted choices), ``gold_index`` (0-based new
    position of the original first choice, first equal value wins),
    ``gold_letter``, ``gold_ambiguous`` and the rendered ``mcq`` text.

    Narrow: one projection, no shuffle of rows."""
    sh = CH.shuffled(F.col(choices), F.lit(seed), F.col(row_id))
    return (df.withColumn("shuffled", sh)
            .withColumn("gold_index", CH.gold_position("shuffled", F.element_at(choices, 1)))
            .withColumn("gold_letter", CH.index_to_letter(F.col("gold_index")))
            .withColumn("gold_ambiguous", CH.gold_ambiguous(F.col(choices)))
            .withColumn("mcq", CH.render_mcq(F.col(question), F.col("shuffled"))))


def unshuffled_mcq(df: DataFrame, *, choices: str = "choices",
                   question: str = "question") -> DataFrame:
    """P14 / fixed path: gold stays first, letter ``A``."""
    return (df.withColumn("gold_index", F.lit(0))
            .withColumn("gold_letter", F.lit("A"))
            .withColumn("mcq", CH.render_mcq(F.col(question), F.col(choices))))


def mcq_record(generated: DataFrame, kind: str) -> DataFrame:
    """P10: the record of a generated question: its type and provenance beside the
    question, the gold answer, the choices and the letter of the right one."""
    return generated.select("seq", F.lit(kind).alias("type"), "question", "answer", "status", "choices",
                            "correct_answer", "chapter_name", "textbook_name", "chapter_url")


def reject_reason(choices: str = "choices"):
    """A NULL choice would vanish from the rendered text; more than
    eleven choices have no letter. Such rows go to quarantine."""
    ch = F.col(choices)
    return (F.when(ch.isNull() | (F.size(ch) == 0), F.lit("no choices"))
            .when(F.exists(ch, lambda x: x.isNull()), F.lit("null choice"))
            .when(F.size(ch) > len(CH.LETTERS), F.lit("too many choices")))


def split_renderable(df: DataFrame, choices: str = "choices") -> tuple[DataFrame, DataFrame]:
    flagged = df.withColumn("reject_reason", reject_reason(choices))
    return (flagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            flagged.where(F.col("reject_reason").isNotNull()))
