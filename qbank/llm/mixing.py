"""Mixing sources to target weights by Pareto order sampling.

Targets: the wanted total is shared by weight; a source whose share is above
``max_copies`` times its size stops there and the excess goes to the others by
weight, until none is above. With sources sorted by cap / weight this is one level:
capped sources take their cap, the others weight * level.

Sample: a document's expected number of copies is its source's target over its size
(times its own importance, where given). The whole part is certain. The fractional
part p is its inclusion probability: with u uniform per document, documents rank by
the random odds u/(1-u) divided by the inclusion odds p/(1-p), and the first ones
whose sizes fill what is left of the target are taken once more, to the document
whose middle is nearest the target. Ranks are counted in two levels (bins of the
rank value, then rows within a bin), so no task sees a whole source.

Edge cases: null sources are one source, last in order; null and empty texts have
size 0 and take nothing; repeated rows count each; ties rank by id and size; an
empty table gives an empty result. ``u`` depends on the seed, the id and the text's
size alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import fresh, named, unit_hash, words

WEIGHT_CYCLE = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MAX_COPIES = 2
#: Bins of the rank value per source: bounds what one task sorts.
RANK_BINS = 4096


def targets(sized: DataFrame, total_share: float = TOTAL_SHARE, max_copies: int = MAX_COPIES,
            weights: tuple[float, ...] = WEIGHT_CYCLE) -> DataFrame:
    """source, source_size, target per source of ``sized`` (source, size).

    Only the per-source totals reach the windows over all sources.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(cycle, (F.row_number().over(order) - 1) % len(weights)))
    per = per.withColumn("cap", (F.lit(max_copies) * F.col("source_size")).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.lit(float(total_share)) * F.sum("source_size").over(everything)
              - (F.sum("cap").over(upto) - F.col("cap"))) / F.sum("weight").over(rest))
    per = per.withColumn("level", level)
    # the first source that its level leaves below its cap sets the level of all
    per = per.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"),
                                               F.struct((F.col("cap") / F.col("weight")).alias("r"), "level")
                                               )).over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return per.select("source", "source_size", target.alias("target"))


def rank_value(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, mapped from (0, inf) to (0, 1)."""
    odds = (u / (F.lit(1.0) - u)) / (p / (F.lit(1.0) - p))
    return odds / (F.lit(1.0) + odds)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        importance_col: str | None = None, total_share: float = TOTAL_SHARE,
        max_copies: int = MAX_COPIES, weights: tuple[float, ...] = WEIGHT_CYCLE,
        seed: str = "mix", carry: bool = False) -> DataFrame:
    """Per row: the id, size, source_size, target, copies and taken. With ``carry``
    every column of ``df`` stays and these follow under fresh names in one struct
    column ``mix``."""
    size = F.size(words(named(text_col))).cast("bigint")
    m = fresh(df, "mix") if carry else "mix"
    rows = df.select(*([F.struct(*[named(c) for c in df.columns]).alias("row")] if carry else []),
                     named(id_col).alias("id"), size.alias("size"),
                     named(source_col).cast("string").alias("source"),
                     (named(importance_col).cast("double") if importance_col else F.lit(1.0)).alias("imp"))
    per = targets(df.select(named(source_col).cast("string").alias("source"), size.alias("size")),
                  total_share, max_copies, weights)
    # a marker makes null sources join as one
    join_key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    rows = rows.withColumn("sk", join_key)
    per = per.withColumn("sk", join_key).drop("source")
    rows = rows.join(per, "sk")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("expected", F.least(F.lit(float(max_copies)), rate * F.col("imp")))
    rows = rows.withColumn("certain", F.floor("expected"))
    rows = rows.withColumn("p", F.col("expected") - F.col("certain"))
    u = unit_hash(F.lit(seed), F.col("id"), F.col("size"))
    rows = rows.withColumn("value", F.when((F.col("p") > 0) & (F.col("size") > 0), rank_value(u, F.col("p"))))
    rows = rows.withColumn("bin", F.coalesce(F.least(F.lit(RANK_BINS - 1), F.floor(F.col("value") * RANK_BINS)),
                                             F.floor(u * RANK_BINS) + RANK_BINS).cast("int"))
    drawn = F.col("value").isNotNull()
    bins = rows.groupBy("sk", "bin").agg(
        F.sum(F.when(drawn, F.col("size")).otherwise(0)).alias("bin_size"),
        F.sum(F.col("certain") * F.col("size")).alias("bin_certain"))
    in_source = Window.partitionBy("sk")
    bins = bins.select("sk", "bin",
                       (F.sum("bin_size").over(in_source.orderBy("bin")) - F.col("bin_size")).alias("before"),
                       F.sum("bin_certain").over(in_source).alias("certain_size"))
    ranked = rows.join(bins, ["sk", "bin"])
    in_bin = (Window.partitionBy("sk", "bin").orderBy("value", "id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = (F.col("before") + F.sum("size").over(in_bin) - F.col("size") / F.lit(2.0))
    once_more = drawn & (middle <= F.col("target") - F.col("certain_size"))
    ranked = ranked.withColumn("copies", (F.col("certain") + once_more.cast("int")).cast("bigint"))
    figures = [F.col("size"), F.col("source_size"), F.col("target"), F.col("copies"),
               (F.col("copies") * F.col("size")).alias("taken")]
    if carry:
        return ranked.select("row.*", F.struct(*figures).alias(m))
    return ranked.select(F.col("id").alias(id_col), *figures)


def sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           **options) -> DataFrame:
    """The mixed documents: each row of ``df`` as many times as it was taken."""
    m, n = fresh(df, "mix"), fresh(df, "__copy")
    mixed = mix(df, id_col, text_col, source_col, carry=True, **options)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(m)["copies"]))
    return mixed.where(F.col(m)["copies"] > 0).withColumn(n, copies).select(*[named(c) for c in df.columns])
