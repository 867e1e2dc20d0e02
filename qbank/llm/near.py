"""MinHash near-duplicates by a multi-index Hamming join, confirmed on full sets.

A text's set is its distinct shingles of words (64-bit hashes); texts with equal
sets form a class. A class has a signature of ``COMPONENTS`` minima of ``B_BITS``
bits. Signatures are split into ``CHUNKS`` chunks: by pigeonhole, two signatures that
differ in at most ``SIGNATURE_DISTANCE`` components have a chunk with at most one
difference, so every chunk is indexed once for each component left out. All pairs
within that distance therefore share a bucket; sets with a Jaccard similarity of 0.8
lie within it, or share a bucket all the same, but for about 2 in 100,000 pairs.

Inside buckets, each member is first compared with the bucket's hub, its most central
member (the one in the largest buckets), so a group of near copies costs a few
comparisons per member. What is still in different components is then joined bucket by
bucket on the distance of its signatures: finer ones of ``FINE_BITS`` one-bit minima
(``COARSE_BITS`` of them first), made for these members only and compared inside the join, so that a pair leaves a bucket
only if it is near enough, once, and from one bucket of those that it shares. The
threshold lies ``FINE_SIGMAS`` standard deviations above the mean distance of the least
similar sets that count. Two exact bounds thin the pairs beside it: a shingle that only
one of the remaining texts has is in no intersection, so the shingles that others have
too bound every similarity of a text; and two texts that were compared with the same hub
share at most the lesser of their parts inside it and the lesser of their parts outside
it. Every link is confirmed on the full sets. A crowded bucket is dealt in parts of about
``CROWD`` members, each of which meets the whole bucket in a task of its own.

Classes, not ids, are compared: an id that stands on rows with unlike texts has a class
for each, and each finds its own links.

Edge cases: null, empty and white texts have no set and are linked with nothing; a
text with fewer words than a shingle has one shingle of all its words; rows without
an id take the component of their set's ids, null where there is none; repeated rows
are one class; rows that share an id and not a text each have their own component;
empty tables give empty results; other columns don't matter. A text is hashed whole by
one task, about 60 bytes a byte of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm import rolling
from qbank.llm.common import WORD, fresh, named, written
from qbank.llm.graph import components

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
COMPONENTS, CHUNKS, B_BITS = 40, 8, 16
CHUNK_ERRORS = 1
SIGNATURE_DISTANCE = CHUNKS * (CHUNK_ERRORS + 1) - 1
#: One-bit minima of a fine signature: a first test takes COARSE_BITS of them.
COARSE_BITS, FINE_BITS, FINE_SIGMAS = 1024, 4096, 4.5
#: Members of a bucket that one part of it has in the join.
CROWD = 2048
#: Rounds in which members are compared with one hub each, before the join.
HUB_ROUNDS = 1
#: A class: its smallest id times CLASS_STEP and, away from 0, a part of its set's hash.
CLASS, CLASS_STEP = "decimal(38,0)", 10 ** 18

_RANDOM = np.random.Generator(np.random.PCG64(8021))
_FLIPS = _RANDOM.integers(0, 2 ** 63, COMPONENTS, np.uint64)
_FACTORS = _RANDOM.integers(0, 2 ** 63, COMPONENTS, np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_FLIPS = _RANDOM.integers(0, 2 ** 63, FINE_BITS, np.uint64)
_FINE_FACTORS = _RANDOM.integers(0, 2 ** 63, FINE_BITS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(group: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, doc, _, _ = rolling.words(group, lower=True)
    w, first = rolling.windows(h, doc, k)
    n = len(group)
    edges = np.searchsorted(doc[first], np.arange(n + 1)) if len(first) else np.zeros(n + 1, np.int64)
    word_edges = np.searchsorted(doc, np.arange(n + 1))
    out = []
    for i in range(n):
        if edges[i] < edges[i + 1]:
            out.append(np.unique(w[edges[i]:edges[i + 1]]))
        elif word_edges[i] < word_edges[i + 1]:  # fewer than k words: one shingle of all
            few = h[word_edges[i]:word_edges[i + 1]]
            seen = np.uint64(len(few))
            for x in few:
                seen = rolling.mix64(np.array([seen * np.uint64(0x9E3779B97F4A7C15) ^ x], np.uint64))[0]
            out.append(np.array([seen], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of COMPONENTS b-bit minima per set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), COMPONENTS), np.uint64)
    for c in range(COMPONENTS):
        out[:, c] = np.minimum.reduceat((flat ^ _FLIPS[c]) * _FACTORS[c], starts)
    return rolling.mix64(out) & np.uint64((1 << B_BITS) - 1)


def fine_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """FINE_BITS one-bit minima per set, packed into int64; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    bits = np.empty((len(sets), FINE_BITS), np.uint8)
    for c in range(FINE_BITS):
        least = np.minimum.reduceat((flat ^ _FINE_FLIPS[c]) * _FINE_FACTORS[c], starts)
        bits[:, c] = (rolling.mix64(least) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, 1).view(np.int64)


def fine_distance(similar_percent: int, bits: int = FINE_BITS) -> int:
    """The largest distance of ``bits`` of fine signatures at which sets are still compared."""
    q = (1 - similar_percent / 100) / 2
    return int(np.ceil(bits * q + FINE_SIGMAS * np.sqrt(bits * q * (1 - q))))


def fine_within(similar_percent: int, bits: int) -> Column:
    """Whether the first ``bits`` of the fine signatures of a pair are near enough. They are
    columns of 64 bits each: more than ``spark.sql.codegen.maxFields``, so Spark compiles the
    join's condition apart. Inlined in the join's own code, 32 columns had not ended on
    check_h after 100 s where 64 took 19 s, likely as too long a method for the JIT compiler."""
    away = sum((F.bit_count(F.col(f"fine_{i}").bitwiseXOR(F.col(f"hub_fine_{i}"))) for i in range(bits // 64)), F.lit(0))
    return away <= fine_distance(similar_percent, bits)


def set_hashes(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit hashes of each set, which name its class."""
    s1 = np.array([int(rolling.mix64(s + np.uint64(1)).sum()) for s in sets], np.uint64)
    s2 = np.array([int(rolling.mix64(s ^ np.uint64(0x5DEECE66D1234567)).sum()) for s in sets], np.uint64)
    return [pa.array(s1.astype(np.int64)), pa.array(s2.astype(np.int64))]


def class_key(i: Column, s1: Column) -> Column:
    """The key of a class, ordered by its smallest id."""
    step = F.lit(CLASS_STEP).cast("decimal(19,0)")
    tail = F.pmod(s1, F.lit(CLASS_STEP)) * F.when(i < 0, -1).otherwise(1)
    return (i.cast("decimal(19,0)") * step + tail.cast("decimal(19,0)")).cast(CLASS)


def class_id(key: Column) -> Column:
    """The smallest id of a class."""
    return F.call_function("div", key, F.lit(CLASS_STEP).cast("decimal(19,0)")).cast("bigint")


def class_tail(key: Column) -> Column:
    """What a class key has beside its smallest id."""
    return (key % F.lit(CLASS_STEP).cast("decimal(19,0)")).cast("bigint")


def index_keys(sig: np.ndarray) -> np.ndarray:
    """The bucket keys of each signature: per chunk, one for each component left out."""
    width = COMPONENTS // CHUNKS
    keys = []
    for chunk in range(CHUNKS):
        part = sig[:, chunk * width:(chunk + 1) * width]
        for out in range(width):
            key = np.full(len(sig), chunk * width + out + 1, np.uint64)
            for c in range(width):
                if c != out:
                    key = rolling.mix64(key * np.uint64(0x9E3779B97F4A7C15) + part[:, c])
            keys.append(key)
    return np.stack(keys, 1)


def _describe(k: int):
    """mapInArrow body: (id, text, t) -> (id, t, n, s1, s2, keys)."""
    def run(batches):
        for b in batches:
            for first, group in rolling.groups(b.column(1).to_pylist()):
                sets = shingle_sets(group, k)
                n = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(n)
                keys = [None] * len(sets)
                if len(some):
                    found = index_keys(signatures([sets[i] for i in some])).astype(np.int64)
                    for i, row in zip(some, found):
                        keys[i] = row
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(group)), b.column(2).slice(first, len(group)), pa.array(n),
                     *set_hashes(sets), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "t", "n", "s1", "s2", "keys"])
    return run


def _sets(k: int):
    """mapInArrow body: (id, text) -> (id, s1, s2, set)."""
    def run(batches):
        for b in batches:
            for first, group in rolling.groups(b.column(1).to_pylist()):
                sets = shingle_sets(group, k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(group)), *set_hashes(sets),
                     pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["id", "s1", "s2", "items"])
    return run


def _fine(batches):
    """mapInArrow body: (id, set) -> (id, fine signature)."""
    for b in batches:
        items = b.column(1)
        flat, edges = items.values.to_numpy().view(np.uint64), items.offsets.to_numpy()
        for first in range(0, b.num_rows, 256):
            last = min(first + 256, b.num_rows)
            rows = fine_signatures([flat[edges[i]:edges[i + 1]] for i in range(first, last)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(first, last - first), pa.array(list(rows), pa.list_(pa.int64()))], names=["id", "fine"])


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with the size of their sets' intersection (``both``) and whether they
    are similar enough (``alike``)."""
    a = sets.select(F.col("id").alias("u"), F.col("items").alias("a"))
    b = sets.select(F.col("id").alias("v"), F.col("items").alias("b"))
    rows = pairs.join(a, "u").join(b, "v").select(
        *pairs.columns, F.size(F.array_intersect("a", "b")).cast("bigint").alias("both"),
        (F.size("a") + F.size("b")).alias("sum"))
    alike = 100 * F.col("both") >= percent * (F.col("sum") - F.col("both"))
    return rows.withColumn("alike", alike).drop("sum")


def _labelled(rows: DataFrame, comps: DataFrame | None, id_col: str, out: str) -> DataFrame:
    """``rows`` with the component of an id column; ids without links are their own."""
    if comps is None:
        return rows.withColumn(out, F.col(id_col))
    c = comps.select(F.col("id").alias(id_col), F.col("comp").alias("found"))
    return rows.join(c, id_col, "left").withColumn(out, F.coalesce("found", id_col)).drop("found")


def _link_classes(docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame | None:
    """id, comp of the class representatives (id, n, keys) that are linked with others."""
    rows = reps.select("id", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    members = written(rows.join(shared, "key"), "near-buckets")
    reach = members.groupBy("id").agg(F.sum("held").alias("reach"))
    # shared: how many of the n shingles other texts have, as far as is known
    known = written(reps.select("id", "n").join(reach, "id").withColumn("shared", F.col("n")), "near-known")
    owners = known.select(class_id(F.col("id")).alias("id")).distinct()
    sets = docs.join(owners, "id", "left_semi").mapInArrow(_sets(k), "id bigint, s1 bigint, s2 bigint, items array<bigint>")
    sets = sets.select(class_key(F.col("id"), F.col("s1")).alias("id"), "items").join(known.select("id"), "id", "left_semi")
    sets = written(sets.dropDuplicates(["id"]), "near-sets")
    members = members.select("id", "key")
    # no intersection exceeds what both share with others; nor, for two texts with one
    # pivot, what both have inside it and what both share with others outside it
    def possible(one_pivot):
        beside = F.least(F.col("shared") - F.col("inside"), F.col("hub_shared") - F.col("hub_inside"))
        most = F.least("shared", "hub_shared", F.when(one_pivot, F.least("inside", "hub_inside") + beside))
        return 100 * most >= percent * (F.col("n") + F.col("hub_n") - most)

    known = known.withColumn("pivot", F.lit(None).cast(CLASS)).withColumn("inside", F.lit(None).cast("bigint"))
    sides = ["n", "shared", "pivot", "inside"]
    pivots = known.where(F.lit(False)).select("id", "pivot", "inside")
    tried, links, comps, turn = None, None, None, 0
    while turn <= HUB_ROUNDS:
        last = turn == HUB_ROUNDS
        now = members.join(_labelled(known, comps, "id", "comp"), "id")
        # the first round's hubs are the most central members, later ones any
        order = F.struct((-F.col("reach") if turn == 0 else F.xxhash64("id", F.lit(turn))).alias("order"),
                         F.col("id").alias("hub"), F.col("comp").alias("hub_comp"))
        apart = now.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"),
                                       F.count(F.lit(1)).alias("held"), F.min(order).alias("h")).where("c1 < c2")
        if turn > 0:  # only what is still apart goes on
            now = now.join(apart.select("key"), "key").select("key", "id", "n", "reach", "comp")
            members = written(now, "near-apart")
            # the pivots count too, so that no shingle of a pivot is alone
            left = members.select("id").distinct()
            left = left.union(pivots.join(left, "id").select("pivot")).distinct()
            lone = (sets.join(left, "id").select("id", F.explode("items").alias("item"))
                    .groupBy("item").agg(F.count(F.lit(1)).alias("texts"), F.min("id").alias("id"))
                    .where("texts = 1").groupBy("id").agg(F.count(F.lit(1)).alias("lone")))
            known = written(known.drop("shared", "pivot", "inside").join(members.select("id").distinct(), "id")
                            .join(pivots, "id", "left").join(lone, "id", "left").withColumn("shared", F.col("n") - F.coalesce("lone", F.lit(0)))
                            .where(100 * F.col("shared") >= percent * F.col("n")).drop("lone"), "near-known")
            now = members.join(known.select("id", "shared", "pivot", "inside"), "id")
            apart = now.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"),
                                           F.count(F.lit(1)).alias("held"), F.min(order).alias("h")).where("c1 < c2")
            members = members.select("id", "key")
        if last:  # everything still apart, pair by pair
            # a crowded bucket is dealt in parts, each of which meets the whole bucket
            places = now.join(apart.select("key", F.ceil(F.col("held") / CROWD).alias("parts")), "key").select("key", "id", "parts")
            live = places.groupBy("id").agg(F.collect_list("key").alias("keys"))
            left = sets.join(live, "id", "left_semi").select("id", "items")
            fine = [F.col("fine")[i].alias(f"fine_{i}") for i in range(FINE_BITS // 64)]
            left = live.join(left.mapInArrow(_fine, f"id {CLASS}, fine array<bigint>").select("id", *fine), "id")
            # components and pivots as two longs each: a comparison makes no decimal
            halves = [f(F.col(x)).alias(f"{x}_{tail}") for x in ("comp", "pivot") for f, tail in ((class_id, "id"), (class_tail, "tail"))]
            wide = now.select("id", "n", "shared", "inside", *halves).distinct().join(left, "id")
            mine = written(places.join(wide, "id"), "near-fine")
            tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            other = mine.withColumn("part", F.explode(F.expr("sequence(0L, parts - 1)"))).select(
                "key", "part", *[F.col(x).alias("hub" if x == "id" else f"hub_{x}") for x in mine.columns if x not in ("key", "parts")])
            mine = mine.withColumn("part", F.pmod(F.xxhash64("id", "key"), F.col("parts"))).drop("parts")
            pairs = mine.repartition(tasks, "key", "part").join(other.repartition(tasks, "key", "part"), ["key", "part"])
            one_component = F.col("comp_id") == F.col("hub_comp_id")
            apart = (F.col("comp_id") < F.col("hub_comp_id")) | (one_component & (F.col("comp_tail") < F.col("hub_comp_tail")))
            one_pivot = (F.col("pivot_id") == F.col("hub_pivot_id")) & (F.col("pivot_tail") == F.col("hub_pivot_tail"))
            first = F.array_min(F.array_intersect("keys", "hub_keys"))  # a pair leaves one of its buckets
            pairs = pairs.where(apart & fine_within(percent, COARSE_BITS) & fine_within(percent, FINE_BITS)
                                & possible(one_pivot) & (F.col("key") == first))
            pairs = pairs.select("id", "hub")
        else:
            pairs = now.select("key", "id", "comp").join(apart.select("key", "h.hub", "h.hub_comp"), "key")
            pairs = pairs.where(F.col("comp") != F.col("hub_comp")).groupBy("id", "hub").count()
            hub = known.select(F.col("id").alias("hub"), *[F.col(x).alias(f"hub_{x}") for x in sides])
            pairs = pairs.join(known, "id").join(hub, "hub").where(possible(F.col("pivot") == F.col("hub_pivot"))).select("id", "hub", "count")
        pairs = pairs.withColumn("u", F.greatest("id", "hub")).withColumn("v", F.least("id", "hub"))
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        if not last:  # of a member's hubs, the one that shares most buckets with it
            pairs = pairs.groupBy("id").agg(F.max(F.struct("count", "hub", "u", "v")).alias("best"))
            pairs = pairs.select("id", "best.hub", "best.u", "best.v")
        pairs = written(pairs.select("id", "hub", "u", "v"), "near-pairs")
        if pairs.isEmpty():
            turn = turn + 1 if last else HUB_ROUNDS
            continue
        fresh_pairs = pairs.select("u", "v").distinct()
        tried = fresh_pairs if tried is None else tried.union(fresh_pairs)
        seen = written(_compared(pairs, sets, percent), "near-links")
        new = seen.where("alike").select("u", "v").distinct()
        if turn == 0:  # a member's pivot is its first hub; a hub without one is its own
            pivots = seen.select("id", F.col("hub").alias("pivot"), F.col("both").alias("inside"))
            alone = seen.select(F.col("hub").alias("id")).distinct().join(pivots, "id", "left_anti")
            pivots = written(pivots.union(alone.join(known, "id").select("id", F.col("id").alias("pivot"), F.col("n"))),
                             "near-pivots")
        if not new.isEmpty():
            links = new if links is None else links.union(new)
            comps = written(components(links), "near-components")
        turn += 1
    return comps


def _found(df: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Per row of ``df``: id, t (hash of the text), n, class and component (class keys)."""
    docs = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    rows = docs.withColumn("t", F.xxhash64("text")).mapInArrow(
        _describe(k), "id bigint, t bigint, n bigint, s1 bigint, s2 bigint, keys array<bigint>")
    rows = written(rows, "near-rows")
    classes = (rows.where((F.col("n") > 0) & F.col("id").isNotNull())
               .groupBy("s1", "s2").agg(F.min("id").alias("rep")))
    classes = written(classes.withColumn("class", class_key(F.col("rep"), F.col("s1"))).drop("rep"), "near-classes")
    reps = (rows.where("n > 0").withColumn("class", class_key(F.col("id"), F.col("s1")))
            .join(classes.select("class"), "class", "left_semi").dropDuplicates(["class"])
            .select(F.col("class").alias("id"), "n", "keys"))
    labelled = _labelled(classes, _link_classes(docs, reps, k, percent), "class", "component")
    return rows.drop("keys").join(labelled, ["s1", "s2"], "left").select("id", "t", "n", "class", "component")


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              shingle_words: int = SHINGLE_WORDS, similar_percent: int = SIMILAR_PERCENT) -> DataFrame:
    """Per row of ``df``: the id, n_shingles, component_id (the smallest id reachable)
    and kept (id = component_id)."""
    found = _found(df, id_col, text_col, shingle_words, similar_percent)
    component = F.when(F.col("n") > 0, class_id(F.col("component"))).otherwise(F.col("id"))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = SHINGLE_WORDS, similar_percent: int = SIMILAR_PERCENT) -> DataFrame:
    """One row of ``df`` per component: the one with the smallest id; of several such
    rows the one with the smallest hash of its text, then of all its columns. Rows
    without an id and rows without words stay."""
    i, t, c, nth = (fresh(df, x) for x in ("__keep_id", "__text_hash", "__class", "__nth"))
    found = _found(df, id_col, text_col, shingle_words, similar_percent)
    keep = (found.where((F.col("class") == F.col("component")) & (F.col("id") == class_id(F.col("class"))))
            .select(F.col("id").alias(i), F.col("t").alias(t), F.col("class").alias(c)).distinct())
    rows = df.withColumn(i, named(id_col).cast("bigint")).withColumn(t, F.xxhash64(named(text_col)))
    plain = [named(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = Window.partitionBy(c).orderBy(t, F.xxhash64(*plain))
    one = rows.join(keep, [i, t]).withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    columns = [named(x) for x in df.columns]
    apart = named(id_col).isNull() | ~F.coalesce(named(text_col), F.lit("")).rlike(WORD)
    return one.select(*columns).unionByName(df.where(apart))
