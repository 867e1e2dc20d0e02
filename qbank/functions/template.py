"""Prompt templates: a list of literal text pieces and named slots.

A template renders to a Spark column (``to_column``) and, for the SQL oracles,
to an equivalent SQL string expression (``to_sql``), so the exact prompt text
a backend sees is stated once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{([a-z_0-9]+)\}")


@dataclass(frozen=True)
class Template:
    text: str

    def parts(self):
        pos = 0
        for m in _SLOT.finditer(self.text):
            if m.start() > pos:
                yield ("lit", self.text[pos:m.start()])
            yield ("slot", m.group(1))
            pos = m.end()
        if pos < len(self.text):
            yield ("lit", self.text[pos:])

    def slots(self) -> list[str]:
        return [v for k, v in self.parts() if k == "slot"]

    def to_column(self, **slots) -> Column:
        cols = []
        for kind, v in self.parts():
            if kind == "lit":
                cols.append(F.lit(v))
            else:
                c = slots[v]
                cols.append(F.col(c) if isinstance(c, str) else c)
        return F.concat(*cols)

    def to_sql(self, **slots) -> str:
        out = []
        for kind, v in self.parts():
            out.append(sql_literal(v) if kind == "lit" else f"({slots[v]})")
        return "(" + " || ".join(out) + ")"


def sql_literal(s: str) -> str:
    """A SQL string expression equal to ``s`` (newlines spelled as chr(10))."""
    pieces = s.split("\n")
    lits = ["'" + p.replace("'", "''") + "'" for p in pieces]
    return "(" + " || chr(10) || ".join(lits) + ")"
