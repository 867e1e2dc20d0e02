import json
import os
import tempfile

from pyspark.sql import functions as F

from qbank.operators import extract as X
from qbank.operators import keypoints as KP
from qbank.operators.dom import dom_nodes
from qbank.sources import io as IO


def test_sample_rank_equals_in_row_sample(spark):
    rows = [(s, [(f"k{i}", str(i)) for i in range(n)]) for s, n in [(1, 6), (2, 3), (3, 9)]]
    df = spark.createDataFrame(rows, "seq long, kps array<struct<keypoint:string,detail:string>>")
    in_row = {r.seq: sorted(x.keypoint for x in r.s) for r in
              df.select("seq", KP.sample_keypoints("kps", 3, F.lit(42), F.col("seq")).alias("s")).collect()}
    ex = df.select("seq", F.posexplode("kps").alias("pos", "kp"))
    ranked = KP.sample_rank(ex, 3, 42, "seq", "pos").groupBy("seq").agg(
        F.sort_array(F.collect_list("kp.keypoint")).alias("s"))
    assert {r.seq: list(r.s) for r in ranked.collect()} == in_row


def test_class_text_introduction(spark):
    df = spark.createDataFrame([(1, '<div class="introduction x">A<b>B</b></div><div>C</div>')],
                               ["page_id", "html"])
    assert dom_nodes(df).select(X.class_text("nodes", "div", "introduction")).first()[0] == "AB"


def test_catalog_and_licensed(spark):
    cat = IO.catalog(spark)
    assert cat.count() == 9
    secs = spark.createDataFrame([("principles-finance", 1), ("other-book", 2)],
                                 ["textbook_name", "id"])
    assert [r.id for r in IO.licensed(secs, cat).collect()] == [1]


def test_json_readers_and_empty_feed(spark):
    d = tempfile.mkdtemp(prefix="qbank-io-")
    arr = os.path.join(d, "arr.json")
    with open(arr, "w") as f:
        json.dump([{"question": "q1", "n": 1}, {"question": "q2", "n": 2}], f, indent=4)
    got = IO.read_json_array(spark, arr, "question string, n int").orderBy("n").collect()
    assert [(r.question, r.n) for r in got] == [("q1", 1), ("q2", 2)]
    lines = os.path.join(d, "lines.json")
    with open(lines, "w") as f:
        f.write('{"question": "ok", "n": 3}\n{not json\n')
    rows = IO.read_jsonl(spark, lines, "question string, n int").collect()
    assert rows[0].question == "ok" and rows[1].question is None
    assert rows[1]["_corrupt_record"] == "{not json"
    assert IO.write_feed(spark.range(0).where("id < 0"), os.path.join(d, "empty")) is False
    assert not os.path.exists(os.path.join(d, "empty"))
