"""Choice-array expressions: letters (P12), seeded shuffle (S1), rendering.

Randomness is portable: the order of a question's choices is the order of
``md5(seed:id:position)``, a pure function of the row, so the result does not
depend on partitioning, task retries or execution order (unlike ``rand`` or
``shuffle``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qbank.functions.util import as_col

# Fixed value: answer letters (eleven of them).
LETTERS = "ABCDEFGHIJK"


def index_to_letter(i) -> Column:
    """0-based index -> letter (NULL outside A..K)."""
    i = as_col(i)
    return F.when((i >= 0) & (i < len(LETTERS)), F.substring(F.lit(LETTERS), i + 1, 1))


def letter_to_index(c) -> Column:
    """Letter -> 0-based index (NULL when not one of A..K)."""
    c = F.upper(as_col(c))
    return F.when(F.length(c) == 1, F.nullif(F.instr(F.lit(LETTERS), c), F.lit(0)) - 1)


def shuffle_key(seed, row_id, pos) -> Column:
    return F.md5(F.concat_ws(":", as_col(seed).cast("string"), as_col(row_id).cast("string"),
                             as_col(pos).cast("string")))


def shuffled(choices, seed, row_id) -> Column:
    """Seeded permutation of ``choices`` (ties on the hash broken by position)."""
    ch = as_col(choices)
    keyed = F.transform(ch, lambda x, i: F.struct(shuffle_key(seed, row_id, i).alias("k"),
                                                  i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def gold_position(shuffled_choices, gold) -> Column:
    """0-based position of the first element equal to ``gold`` (T1: first equal wins)."""
    return (F.array_position(as_col(shuffled_choices), as_col(gold)) - 1).cast("int")


def gold_ambiguous(choices) -> Column:
    """The gold text appears more than once among the choices."""
    ch = as_col(choices)
    return F.size(F.filter(ch, lambda x: x == F.element_at(ch, 1))) > 1


def render_mcq(question, choices) -> Column:
    """``question\\n`` followed by ``L: choice\\n`` for each choice."""
    body = F.array_join(
        F.transform(as_col(choices),
                    lambda x, i: F.concat(F.substring(F.lit(LETTERS), i + 1, 1), F.lit(": "), x,
                                          F.lit("\n"))),
        "")
    return F.concat(as_col(question), F.lit("\n"), body)


def render_numbered(question, choices) -> Column:
    """``Question: q`` then ``Choice n: text`` lines (the unshuffled check form)."""
    body = F.array_join(
        F.transform(as_col(choices),
                    lambda x, i: F.concat(F.lit("Choice "), (i + 1).cast("string"), F.lit(": "), x)),
        "\n")
    return F.concat(F.lit("Question: "), as_col(question), F.lit("\n"), body)
