"""Answering, scoring and labelling.

The answer log of the original workflow is a dict keyed by question, written
in file order, so a later row overwrites an earlier one but the key keeps its
first position. Here the log is a table and that rule is ``last_wins``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qbank.functions import choices as CH
from qbank.functions import prompts as P
from qbank.operators.infer import Backend, build_requests, infer

SCORING = ("one_based", "zero_based", "letter", "as_published")
ANSWER_SCHEMA = "reason STRING, choice STRING"
CLASSIFY_SCHEMA = ("completeness_reason STRING, type_reason STRING, mcq_reason STRING, "
                   "completeness_choice STRING, type_choice STRING, mcq_choice STRING")
# Code domains of the three labels.
COMPLETENESS_CODES = [0, 1, 2, 3, 9]
TYPE_CODES = [1, 2, 3, 4, 5, 9]
MCQ_CODES = [0, 1]


def predicted_index(choice_text, scoring: str = "one_based"):
    """Normalise a reply's choice (T6): numbers (quoted or not) and letters.
    Returns the 0-based choice position, NULL when it cannot be read."""
    if scoring not in SCORING:
        raise ValueError(f"scoring must be one of {SCORING}")
    t = F.regexp_replace(choice_text, r"^\s+|\s+$", "")
    n = t.try_cast("int")
    letter = CH.letter_to_index(t)
    if scoring == "letter":
        return letter
    shift = {"one_based": 1, "zero_based": 0, "as_published": 2}[scoring]
    return F.coalesce(n - shift, letter)


def answer_questions(mcqs: DataFrame, backend: Backend, *, id_col: str = "seq",
                     mcq_col: str = "mcq", task: str = "answer", model: str = "rule",
                     scoring: str = "one_based", keep: list[str] | None = None,
                     materialize: bool = True) -> DataFrame:
    """M7: ask the backend to answer each rendered question; parse the reply
    (T7: bad JSON gives NULLs and ``status``), normalise the choice and
    score it against ``gold_index``."""
    tpl = P.ANSWER if task == "answer" else P.ANSWER_BATCH
    keep = list(dict.fromkeys([id_col, "question", "gold_index", *(keep or [])]))
    req = build_requests(mcqs, request_id=id_col, prompt=tpl.to_column(mcq=F.col(mcq_col)),
                         task=task, system=P.STUDENT_SYSTEM, model=model,
                         max_tokens=1000 if task == "answer_batch" else None, keep=keep)
    rep = infer(req, backend, materialize=materialize, name=f"answers-{task}")
    parsed = F.from_json(F.col("response"), ANSWER_SCHEMA)
    return (rep.withColumn("_r", parsed)
            .withColumn("reason", F.col("_r.reason"))
            .withColumn("choice", F.col("_r.choice"))
            .withColumn("predicted_index", predicted_index(F.col("choice"), scoring))
            .withColumn("correct", F.coalesce(F.col("predicted_index") == F.col("gold_index"),
                                              F.lit(False)))
            .drop("_r"))


def last_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """A4: one row per ``key`` holding the values of its highest-``seq`` row,
    plus ``first_seq`` (the position the key was first seen at).

    ``max_by`` is a partial aggregate: a hot key is combined map-side, so a
    key holding a third of all rows ships one row per task to the shuffle."""
    others = [c for c in df.columns if c != key]
    return (df.groupBy(key)
            .agg(F.max_by(F.struct(*others), F.col(seq)).alias("_last"),
                 F.min(seq).alias("first_seq"))
            .select(key, "_last.*", "first_seq"))


def accuracy(log: DataFrame, by: list[str] | None = None, correct: str = "correct") -> DataFrame:
    """A2: percent correct (T8: an empty log gives NULL, not an error)."""
    aggs = [F.count(F.lit(1)).alias("n_questions"),
            F.sum(F.col(correct).cast("bigint")).alias("n_correct")]
    g = log.groupBy(*by) if by else log.groupBy()
    out = g.agg(*aggs).withColumn("n_correct", F.coalesce("n_correct", F.lit(0)).cast("bigint"))
    return out.withColumn("accuracy_pct",
                          F.try_divide(F.col("n_correct").cast("double") * 100.0,
                                       F.col("n_questions").cast("double")))


def classify_questions(questions: DataFrame, backend: Backend, *, id_col: str = "seq",
                       question_col: str = "clean_question", model: str = "rule",
                       keep: list[str] | None = None, materialize: bool = True) -> DataFrame:
    """M8: label completeness, type and multiple-choice fit, with a domain
    check per code (out-of-domain or unreadable codes are flagged, not fatal)."""
    req = build_requests(questions, request_id=id_col,
                         prompt=P.CLASSIFY.to_column(question=F.col(question_col)),
                         task="classify", system=P.CLASSIFY_SYSTEM, model=model,
                         keep=[id_col, *(keep or [])])
    rep = infer(req, backend, materialize=materialize, name="classify")
    r = F.from_json(F.col("response"), CLASSIFY_SCHEMA)
    out = rep.withColumn("_r", r)
    for f in ("completeness_reason", "type_reason", "mcq_reason"):
        out = out.withColumn(f, F.col(f"_r.{f}"))
    for f in ("completeness_choice", "type_choice", "mcq_choice"):
        out = out.withColumn(f, F.col(f"_r.{f}").try_cast("int"))
    valid = (F.col("completeness_choice").isin(COMPLETENESS_CODES)
             & F.col("type_choice").isin(TYPE_CODES) & F.col("mcq_choice").isin(MCQ_CODES))
    return out.withColumn("codes_valid", F.coalesce(valid, F.lit(False))).drop("_r")


def row_index(df: DataFrame, seq: str, name: str = "row_index") -> DataFrame:
    """0-based index in ``seq`` order, without a single-partition window.

    Rows are range-partitioned and sorted on ``seq``, and numbered inside their
    range; that is written once, so counting and numbering see the same ranges.
    Each range is counted (one small row per range); the index is the running
    offset of the range plus the number inside it."""
    from qbank.session import materialize
    # a sorted range's ids count up by one from its first, so the rank inside the
    # range needs no second shuffle
    ranged = materialize(df.repartitionByRange(seq).sortWithinPartitions(seq)
                         .withColumn("_at", F.monotonically_increasing_id())
                         .withColumn("_pid", F.shiftright("_at", 33))
                         .withColumn("_at", F.col("_at") - F.shiftleft("_pid", 33)), "ranges")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n"))
                            .alias("_off"))
    return (ranged.join(offsets, "_pid")
            .withColumn(name, (F.col("_off") + F.col("_at")).cast("bigint"))
            .drop("_pid", "_off", "_at"))
