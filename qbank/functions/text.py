"""Text column helpers shared by extraction, sections and the MCQ stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qbank.functions.util import as_col

# Whitespace as Python's str.strip() sees it: Unicode White_Space plus the
# four ASCII information separators (U+001C..U+001F). Spark's trim() only
# removes U+0020, so it is not used for "strip" semantics.
_WS = r"[\s\x{1c}-\x{1f}]"
STRIP_PATTERN = rf"(?U)^{_WS}+|{_WS}+$"
# Fixed value: leading "N." numbering of textbook questions.
NUMBERING_PATTERN = rf"(?U)^{_WS}*\d+\.{_WS}*"


def py_strip(c) -> Column:
    """``str.strip()`` with Unicode whitespace."""
    return F.regexp_replace(as_col(c), STRIP_PATTERN, "")


def clean_question(c) -> Column:
    """Drop leading whitespace and one ``N.`` numbering."""
    return F.regexp_replace(as_col(c), NUMBERING_PATTERN, "")


def qa_text(question, answer) -> Column:
    """``Question: {q} Answer: {a}``."""
    return F.concat(F.lit("Question: "), as_col(question), F.lit(" Answer: "), as_col(answer))


def sentence_text(c) -> Column:
    """P8 variant: split on '.', strip each piece, drop empty ones, join by a space."""
    pieces = F.transform(F.split(as_col(c), r"\."), lambda x: py_strip(x))
    return F.array_join(F.filter(pieces, lambda x: x != ""), " ")


def remove_all(text, pieces) -> Column:
    """Remove every occurrence of each string of ``pieces`` from ``text``, in
    array order (an empty piece leaves the text unchanged)."""
    return F.aggregate(as_col(pieces), as_col(text),
                       lambda acc, x: F.when(x == "", acc).otherwise(F.replace(acc, x, F.lit(""))))


def lines(c) -> Column:
    """Split a text into its ``\\n``-separated lines (trailing empties kept)."""
    return F.split(as_col(c), "\n", -1)
