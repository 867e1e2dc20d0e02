"""Property checks: Spark column semantics equal the Python semantics of the
original workflow on generated inputs (one Spark job per generated batch)."""
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qbank.functions import choices as CH
from qbank.functions import text as TX

WS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　"
texts = st.text(alphabet=st.sampled_from(list(WS) + list("ab1.9 Zé")), max_size=12)


@settings(max_examples=5, deadline=None)
@given(st.lists(texts, min_size=1, max_size=60))
def test_strip_and_clean_match_python(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x string")
    got = df.select("x", TX.py_strip("x").alias("s"), TX.clean_question("x").alias("c")).collect()
    for r in got:
        assert r.s == r.x.strip()
        assert r.c == re.sub(r"^\s*\d+\.\s*", "", r.x)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "d", "e"]), min_size=1, max_size=6),
                min_size=1, max_size=40))
def test_shuffle_is_a_permutation_tracking_first_equal(spark, lists):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "seq long, ch array<string>")
    sh = CH.shuffled("ch", F.lit(7), "seq")
    out = df.select("seq", "ch", sh.alias("sh"), CH.gold_position(sh, F.element_at("ch", 1)).alias("g"),
                    CH.render_mcq(F.lit("Q"), sh).alias("m")).collect()
    for r in out:
        assert sorted(r.sh) == sorted(r.ch)
        assert r.g == r.sh.index(r.ch[0])  # first equal value wins (T1)
        assert r.m == "Q\n" + "".join(f"{'ABCDEFGHIJK'[i]}: {x}\n" for i, x in enumerate(r.sh))
