"""JSON arrays in every layout, over many splits."""
import json
import random

import pytest

from qbank.sources import io as IO
from qbank.sources.json_array import read_json_array, write_json_arrays

SCHEMA = "n BIGINT, q STRING, choices ARRAY<STRING>, extra STRUCT<a: STRING, b: ARRAY<STRUCT<c: BIGINT>>>"


def records(n, seed=1):
    rnd = random.Random(seed)
    odd = ['plain', 'br{ace', '}] "quoted" [{', 'back\\slash', '\\"', 'line\nfeed', '', 'é 日本 😀', '\\\\" ]', ',']
    return [{"n": i, "q": rnd.choice(odd) * rnd.randrange(4), "choices": [rnd.choice(odd) for _ in range(rnd.randrange(4))],
             "extra": rnd.choice([None, {"a": rnd.choice(odd), "b": [{"c": i}, {"c": None}]}])} for i in range(n)]


def rows(df):
    return sorted((json.loads(x) for x in df.selectExpr("to_json(struct(*), map('ignoreNullFields', 'false')) AS j").toPandas()["j"]),
                  key=lambda r: r["n"])


LAYOUTS = {
    "one line": lambda r: json.dumps(r),
    "a record a line": lambda r: "[\n" + ",\n".join(json.dumps(x) for x in r) + "\n]",
    "leading commas": lambda r: "[" + "\n,".join(json.dumps(x, ensure_ascii=False) for x in r) + "]\n",
    "indented": lambda r: json.dumps(r, indent=4),
    "tabs": lambda r: json.dumps(r, indent="\t", ensure_ascii=False),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_over_many_splits(spark, tmp_path, layout):
    want = records(400)
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(LAYOUTS[layout](want[k * 150:(k + 1) * 150]), encoding="utf-8")
    conf = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        splits = spark.read.text(str(tmp_path)).selectExpr("_metadata.file_block_start AS b", "_metadata.file_path AS f").distinct()
        assert layout == "one line" or splits.count() > 12
        got = read_json_array(spark, str(tmp_path), SCHEMA)
        assert rows(got) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_arrays_and_bad_records(spark, tmp_path):
    for name, text in [("a", "[]"), ("b", ""), ("c", "[\n]\n"), ("d", '[\n{"n": 1},\n{"n": oops},\n{"n": 3}\n]')]:
        (tmp_path / f"{name}.json").write_text(text)
    got = {(r.n, r.bad) for r in read_json_array(spark, str(tmp_path), "n BIGINT", corrupt_column="bad").collect()}
    assert got == {(1, None), (None, '{"n": oops}'), (3, None)}


@pytest.mark.parametrize("indent", [None, 2])
def test_written_arrays_are_arrays(spark, tmp_path, indent):
    df = spark.createDataFrame([(i, f"q\"{i}\n", None) for i in range(50)], "n BIGINT, q STRING, choices ARRAY<STRING>")
    write_json_arrays(df.repartition(3), str(tmp_path / "out"), indent=indent)
    whole = [json.loads(p.read_text()) for p in (tmp_path / "out").glob("part-*")]
    assert sum(map(len, whole)) == 50
    back = IO.read_json_array(spark, str(tmp_path / "out"), "n BIGINT, q STRING, choices ARRAY<STRING>")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    write_json_arrays(df.limit(0), str(tmp_path / "none"))
    assert IO.read_json_array(spark, str(tmp_path / "none"), "n BIGINT").count() == 0


def test_whole_records_are_not_shuffled(spark, tmp_path):
    """Only the pieces at the ends of a split travel; lines are not written again."""
    (tmp_path / "a.json").write_text(json.dumps(records(200), indent=1))
    df = read_json_array(spark, str(tmp_path), SCHEMA)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_stretches" in plan and "Relation [value" in plan
    assert rows(df) == records(200)
