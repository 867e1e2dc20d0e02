"""Merkle manifest of a table: a tree of digests per group, and one tree over the groups.

Rows are leaves; the leaves of a group stand in order of ``order``, the groups in order
of their name (null first, bytewise). Level by level every ``FANOUT`` neighbouring nodes
(the last run may hold fewer) become one parent until one node is left: the group's
subroot. The subroots form the tree of the root in the same way.

Places come from one range exchange over (group, order): a range's rows are counted, and
a row's place is its number in the range plus the counts of the group's earlier ranges,
so no group is ever gathered. A level is computed by fixed-offset ``lag`` and ``lead``
columns over blocks of ``BLOCK`` neighbouring nodes: slot and run length mask the offsets
that leave the run, what stays are a node's siblings to the left and right, and the rows
at slot 0 hash the parents. Each level is written to the shared folder (a level has a
sixteenth of the rows below it). Going down, a node takes its parent's siblings by a join
on (group, number of the parent), so every leaf ends with its path: the siblings of its
run, then those of its parent's run, and so on to the root.

Edge cases: a null group is a group of its own, a null id stands first, rows of equal
group and order are ordered by their digest; repeated rows are leaves of their own; an
empty text is a value (``0:``), a null is ``-``; the length of a text is not bounded by
anything but its row; an empty table has no rows and no root; a group of one leaf has
that leaf as its subroot. Other columns of ``leaves`` are carried along whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import fresh, named, written

#: Children of a node.
FANOUT = 16
#: Neighbouring nodes of one window: whole runs, few enough for any task.
BLOCK = FANOUT * 256

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_NODE = ["grp", "at", "size", "digest"]
_PATH = "array<struct<left:string,right:string>>"


def digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values: ``-`` for null, else the number of UTF-8
    bytes, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
             for v in (v.cast("string") for v in values)]
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case."""
    return F.translate(text, UPPER, UPPER.lower())


def _group_key(group: Column) -> Column:
    """Never null, and in order of the groups: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def placed(df: DataFrame, grp: str, order: list[str]) -> DataFrame:
    """``df`` (written once) with ``at``, the place inside the group, and ``size``, the
    group's rows. Rows that are equal in all of ``order`` are spread by their place in
    the input."""
    tie = fresh(df, "tie")
    by = [named(grp), *[named(c).asc_nulls_first() for c in order], named(tie)]
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(*by).sortWithinPartitions(*by).drop(tie)
              .withColumn("num", F.monotonically_increasing_id())
              .withColumn("part", F.shiftright("num", 33)))
    ranged = written(ranged, "merkle-leaves")
    counts = ranged.groupBy("part", named(grp).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), F.min("num").alias("first"))  # a row per range and group
    whole = Window.partitionBy("g")
    sofar = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = counts.select(F.col("part").alias("p"), "g", F.sum("n").over(whole).alias("size"),
                           (F.coalesce(F.sum("n").over(sofar), F.lit(0)) - F.col("first")).alias("shift"))
    return (ranged.join(offset, (F.col("part") == F.col("p")) & (named(grp) == F.col("g")))
            .withColumn("at", F.col("num") + F.col("shift")).drop("num", "part", "p", "g", "shift"))


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``left`` and ``right``: the digests of their run before and after
    them, end to end. A node alone in its tree (size 1) has none."""
    block = Window.partitionBy("grp", F.floor(F.col("at") / BLOCK)).orderBy("at")
    slot = F.col("at") % FANOUT
    run = F.least(F.lit(FANOUT), F.col("size") - (F.col("at") - slot))
    before = [F.when(slot >= k, F.lag("digest", k).over(block)) for k in range(FANOUT - 1, 0, -1)]
    after = [F.when(slot + k < run, F.lead("digest", k).over(block)) for k in range(1, FANOUT)]
    return nodes.select("*", F.concat_ws("", *before).alias("left"), F.concat_ws("", *after).alias("right"))


def _levels(leaves: DataFrame, height: int) -> list[DataFrame]:
    """The written levels, leaves first, each with its siblings; a group ends with the
    level at which it has one node."""
    out = [written(_with_siblings(leaves), "merkle-level")]
    for _ in range(height):
        firsts = out[-1].where((F.col("size") > 1) & (F.col("at") % FANOUT == 0))
        parents = firsts.select(
            "grp", F.floor(F.col("at") / FANOUT).alias("at"), F.ceil(F.col("size") / FANOUT).alias("size"),
            F.sha2(F.concat("digest", "right"), 256).alias("digest"))
        out.append(written(_with_siblings(parents), "merkle-level"))
    return out


def _height(sizes: DataFrame) -> int:
    """Levels above the leaves of the largest group (one number to the driver)."""
    most = sizes.agg(F.max("size")).first()[0] or 0
    height = 0
    while most > 1:
        most, height = -(-most // FANOUT), height + 1
    return height


def _tops(levels: list[DataFrame]) -> DataFrame:
    """grp and digest of the last node of every group."""
    tops = [x.where("size = 1").select("grp", "digest") for x in levels]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _down(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves with ``path`` and the columns of ``above`` (grp, path, ...): each level
    takes what its parents have; a group's last node takes what its group has."""
    extra = [c for c in above.columns if c not in ("grp", "path")]
    have = None
    for level in reversed(levels):
        top = level.where("size = 1").join(above, "grp")
        if have is None:
            have = top
            continue
        parents = have.select(F.col("grp").alias("g"), F.col("at").alias("up"), "path", *extra)
        inner = level.where("size > 1").join(
            parents, (F.col("grp") == F.col("g")) & (F.floor(F.col("at") / FANOUT) == F.col("up"))).drop("g", "up")
        step = F.array(F.struct("left", "right"))
        have = inner.withColumn("path", F.concat(step, F.col("path"))).unionByName(top)
    return have.drop("left", "right", "size", "at")


def manifest(leaves: DataFrame, group: str, order: list[str], leaf: str) -> DataFrame:
    """``leaves`` with three more columns: ``subroot``, ``root`` and ``path``, the
    siblings (left, right) of the leaf's run, of its parent's run, and so on to the root.
    ``leaf`` names the column of digests."""
    carried = [named(c).alias(f"c{k}") for k, c in enumerate(leaves.columns)]
    names = leaves.columns
    rows = leaves.select(_group_key(named(group)).alias("grp"), named(leaf).alias("digest"),
                         *[named(c).alias(f"o{k}") for k, c in enumerate(order)],
                         F.struct(*carried).alias("row"))
    rows = written(rows, "merkle-digests")  # the range exchange reads its input twice
    keys = [f"o{k}" for k in range(len(order))]
    rows = placed(rows, "grp", [*keys, "digest"]).drop(*keys)
    # a row's own columns stay with the leaves; the levels hold nodes only
    levels = _levels(rows, _height(rows))
    subroots = _tops(levels)
    inside = _down(levels, subroots.select("grp", F.array().cast(_PATH).alias("path"),
                                           F.col("digest").alias("subroot")))
    roots = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    roots = placed(roots, "grp", ["name"])
    over = _levels(roots, _height(roots))
    root = _tops(over).select("grp", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    groups = _down(over, root).select(F.col("name").alias("g"), F.col("path").alias("rest"), "root")
    out = inside.join(groups, F.col("grp") == F.col("g"))
    return out.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)],
                      "subroot", "root", F.concat("path", "rest").alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
