"""The Merkle manifest against plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from plain import edge_rows, edges, empty
from pyspark.sql import functions as F

from qbank.llm import merkle, queries


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, low=False):
    out = []
    for k, v in enumerate(row):
        s = None if v is None else str(v)
        if low and k == 4 and s is not None:
            s = s.translate({i: i + 32 for i in range(65, 91)})
        out.append("-" if s is None else f"{len(s.encode())}:{s}")
    return sha("".join(out))


def tree(digests, fan=16):
    """The root, and for every leaf its (left, right) siblings from the bottom up."""
    paths, under = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, held = [], []
        for s in range(0, len(digests), fan):
            run = digests[s:s + fan]
            for k in range(len(run)):
                for leaf in under[s + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha("".join(run)))
            held.append([x for u in under[s:s + fan] for x in u])
        digests, under = above, held
    return digests[0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows
    (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        members = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = (members, *tree([leaf_of(r) for r in members]))
    root, over = tree([trees[s][1] for s in names])
    out = []
    for s, rest in zip(names, over):
        members, subroot, paths = trees[s]
        for r, path in zip(members, paths):
            h = leaf_of(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0)
            for a, b in path + rest:
                h = sha(a + h + b)
            out.append((r[0], leaf_of(r), subroot, root, sha("".join(a + b for a, b in path + rest)), h, h == root))
    return Counter(out)


def run(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return Counter(map(tuple, queries.op11_merkle_manifest(spark, str(tmp_path)).collect()))


def test_manifest_of_all_shapes(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in edge_rows()]  # nulls, empties, long texts, repeats
    for name, n in [("one", 1), ("sixteen", 16), ("seventeen", 17), ("deep", 16 * 16 + 1), ("été", 300),
                    ("hot", 5000), ("", 3), ("Zed", 2), *[(f"s{k}", 2) for k in range(18)]]:
        rows += [(rnd.randrange(10 ** 6), name, rnd.choice(["en", None]), i, f"Text {i} of {name}") for i in range(n)]
    rnd.shuffle(rows)
    got = run(spark, rows, tmp_path)
    assert got == plain_manifest(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_manifest_of_one_source(spark, tmp_path, n):
    rows = [(k, None, "en", None, "A") for k in range(n)]
    assert run(spark, rows, tmp_path) == plain_manifest(rows)


def test_equal_rows_spread_and_verify(spark, tmp_path):
    rows = [(5, "s", "en", 1, "same text")] * 700 + [(None, "s", None, None, None)] * 300
    assert run(spark, rows, tmp_path) == plain_manifest(rows)


def test_a_changed_leaf_changes_the_root(spark):
    leaves = spark.range(600).select("id", F.lit("g").alias("grp"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    found = merkle.manifest(leaves, "grp", ["id"], "h")
    row = found.where("id = 321").select("root", merkle.folded(F.col("h"), F.col("path")).alias("same"),
                                         merkle.folded(F.sha2(F.lit("x"), 256), F.col("path")).alias("other")).first()
    assert row.same == row.root != row.other


def test_manifest_edges(spark):
    # clashing names are carried along, an empty table has no rows
    df = edges(spark).withColumn("digest", F.lit("mine")).withColumn("at", F.lit(7)).withColumn("grp", F.lit(True))
    leaves = df.withColumn("path0", merkle.digest(F.col("text")))
    got = merkle.manifest(leaves, "source", ["doc_id"], "path0")
    assert got.columns == [*leaves.columns, "subroot", "root", "path"]
    rows = got.collect()
    assert len(rows) == len(edge_rows()) and {(r.digest, r.at, r.grp) for r in rows} == {("mine", 7, True)}
    assert got.where(merkle.folded(F.col("path0"), F.col("path")) != F.col("root")).count() == 0
    none = merkle.manifest(empty(spark).withColumn("h", merkle.digest(F.col("text"))), "source", ["doc_id"], "h")
    assert none.count() == 0
