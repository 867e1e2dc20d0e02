from pyspark.sql import functions as F

from qbank.functions import choices as CH
from qbank.functions import text as TX
from qbank.functions import url as U
from qbank.operators.mcq import reject_reason, shuffle_choices


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys()))
    return df.select(expr.alias("r")).first()["r"]


def test_url_parts(spark):
    rows = [("https://a.org/books/econ/pages/3-key-terms",), ("https://a.org/books/econ/pages/",),
            ("https://a.org/x",), ("https://a.org/books/b/pages/1-intro?x=1#f",)]
    df = spark.createDataFrame(rows, ["url"])
    out = df.select(U.chapter_name("url").alias("c"), U.textbook_name("url").alias("t"),
                    U.section_slug(U.chapter_name("url")).alias("s"),
                    U.base_url("url").alias("b")).collect()
    assert [tuple(r) for r in out] == [
        ("3-key-terms", "econ", "keyterms", "https://a.org/books/econ/pages/"),
        ("", "econ", "", "https://a.org/books/econ/pages/"),
        ("x", None, "", "https://a.org/"),
        ("1-intro?x=1#f", "b", "intro?x=1#f", "https://a.org/books/b/pages/"),
    ]


def test_routes_first_match(spark):
    df = spark.createDataFrame([("1-key-terms",), ("2-key-concepts-and-summary",),
                                ("3-self-check-questions",), ("4-intro",), ("5-summary-key-terms",)],
                               ["l"])
    econ = [r[0] for r in df.select(U.route_econ("l")).collect()]
    fin = [r[0] for r in df.select(U.route_finance("l")).collect()]
    assert econ == ["key_terms", "key_concepts", "self_check", None, "key_terms"]
    assert fin == ["key_terms", "summary", "chapter", "chapter", "key_terms"]


def test_resolve_url(spark):
    base = "https://h.org/books/b/pages/1-contents?q=1#top"
    cases = {"2-key-terms#x": "https://h.org/books/b/pages/2-key-terms",
             "/root": "https://h.org/root", "//cdn.org/a": "https://cdn.org/a",
             "http://o.org/p": "http://o.org/p", "?z=2": "https://h.org/books/b/pages/1-contents?z=2",
             "": "https://h.org/books/b/pages/1-contents?q=1"}
    df = spark.createDataFrame([(base, k) for k in cases], ["b", "l"])
    got = {r["l"]: r["r"] for r in df.select("l", U.resolve_url("b", "l").alias("r")).collect()}
    assert got == cases


def test_strip_and_clean(spark):
    s = "   text 　\n"
    assert one(spark, TX.py_strip("x"), x=s) == s.strip()
    assert one(spark, TX.clean_question("q"), q="\n10. \n\n  What?") == "What?"
    assert one(spark, TX.clean_question("q"), q="What 1. is?") == "What 1. is?"
    assert one(spark, TX.qa_text("q", "a"), q="Q", a="A") == "Question: Q Answer: A"
    assert one(spark, TX.sentence_text("t"), t=" a. b .. c") == "a b c"


def test_letters_and_render(spark):
    df = spark.createDataFrame([(0,), (10,), (11,)], ["i"])
    assert [r[0] for r in df.select(CH.index_to_letter("i")).collect()] == ["A", "K", None]
    df = spark.createDataFrame([("c",), ("K",), ("Z",), ("AB",)], ["c"])
    assert [r[0] for r in df.select(CH.letter_to_index("c")).collect()] == [2, 10, None, None]
    assert one(spark, CH.render_mcq("q", "ch"), q="Q?", ch=["x", "y"]) == "Q?\nA: x\nB: y\n"


def test_shuffle_tracks_gold_and_is_partition_independent(spark):
    rows = [(i, f"q{i}", [f"g{i}", f"a{i}", f"b{i}", f"c{i}"]) for i in range(40)]
    rows.append((99, "dup", ["same", "x", "same", "y"]))
    df = spark.createDataFrame(rows, ["seq", "question", "choices"])
    a = {r.seq: (r.shuffled, r.gold_index) for r in shuffle_choices(df.repartition(1)).collect()}
    b = {r.seq: (r.shuffled, r.gold_index) for r in shuffle_choices(df.repartition(7)).collect()}
    assert a == b
    for seq, (sh, g) in a.items():
        assert sh[g] == ("same" if seq == 99 else f"g{seq}")
        assert sorted(sh) == sorted(dict((r[0], r[2]) for r in rows)[seq])
    amb = {r.seq: r.gold_ambiguous for r in shuffle_choices(df).collect()}
    assert amb[99] is True and amb[0] is False


def test_reject_reasons(spark):
    df = spark.createDataFrame([(["a", None],), ([str(i) for i in range(12)],), (["a", "b"],)],
                               "choices array<string>")
    got = [r[0] for r in df.select(reject_reason()).collect()]
    assert got == ["null choice", "too many choices", None]


def test_resolve_url_matches_urljoin(spark):
    from urllib.parse import urljoin
    bases = ["https://h.org/books/b/pages/1-contents?q=1#top", "http://h.org", "http://h.org/a/b/c",
             "http://h.org/a/b/"]
    links = ["2-key-terms#x", "../x", "../../x/y", "./z", ".", "..", "../", "/r/../s", "?z=2", "",
             "//cdn.org/a", "http://o.org/p", "a/./b/../c?d=1", "../../../../g", "g/", "x?y#z"]
    df = spark.createDataFrame([(b, k) for b in bases for k in links], ["b", "l"])
    for r in df.select("b", "l", U.resolve_url("b", "l").alias("r")).collect():
        assert r.r == urljoin(r.b, r.l).split("#")[0], (r.b, r.l)
