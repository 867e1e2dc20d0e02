"""Failures stay visible: bad replies, cached errors, bad and repeated pages."""
import pandas as pd
from pyspark.sql import functions as F

from qbank.operators import keypoints as KP
from qbank.operators import sections as SEC
from qbank.operators.dom import dom_nodes
from qbank.operators.infer import Backend, RuleBackend, build_requests, cache_key_col, infer
from qbank.plans import crawl as CR
from qbank.plans import workflow as WF
from qbank.sources import fixtures as FX
from qbank.streaming import jobs as ST


def questions(spark, n=40):
    return spark.createDataFrame([(i, f"q {i}", f"a {i}") for i in range(n)], "seq bigint, question string, answer string")


def test_a_failing_stage_is_reported(spark):
    class NoDistortion(RuleBackend):
        def complete(self, batch: pd.DataFrame) -> pd.DataFrame:
            out = super().complete(batch)
            bad = (batch["task"] == "distort_keypoint").values
            out.loc[bad, ["response", "status", "error"]] = [None, "error", "down"]
            return out

    g = KP.generate_mcqs(questions(spark), NoDistortion()).collect()
    assert {r.status for r in g} <= {"failed_distortion", "too_few_keypoints"}
    assert all(r.choices is None and r.correct_answer is None for r in g)
    good = KP.generate_mcqs(questions(spark), RuleBackend()).collect()
    assert any(r.status == "ok" and len(r.choices) == 4 for r in good)


def test_quarantine_keeps_what_shuffle_drops(spark):
    g = KP.generate_mcqs(questions(spark), RuleBackend())
    kept, out = WF.shuffle(g).count(), WF.quarantined(g).collect()
    assert kept + len(out) == 40 and out and all(r.reject_reason for r in out)


def Count():
    class Fresh(Backend):  # local: shipped to the workers by value
        def complete(self, batch):
            import uuid
            return pd.DataFrame({"response": [uuid.uuid4().hex for _ in range(len(batch))], "status": "ok", "error": None})
    return Fresh()


def test_cached_errors_are_asked_again(spark):
    req = build_requests(spark.createDataFrame([(1, "p")], "id int, prompt string"), request_id="id", prompt="prompt", task="t")
    cache = req.select(cache_key_col().alias("cache_key"), F.lit(None).cast("string").alias("response"),
                       F.lit("error").alias("status"), F.lit("down").alias("error"))
    row = infer(req, Count(), cache=cache).first()
    assert row.status == "ok" and row.response


def test_temperature_and_task_keep_replies_apart(spark):
    df = spark.createDataFrame([(i, "p") for i in range(4)], "id int, prompt string")
    ask = lambda t, task: {r.response for r in infer(build_requests(
        df, request_id="id", prompt="prompt", task=task, temperature=t), Count()).collect()}
    assert len(ask(0.0, "a")) == 1 and len(ask(0.7, "a")) == 4
    both = build_requests(df, request_id="id", prompt="prompt", task="a").union(
        build_requests(df, request_id="id", prompt="prompt", task="b"))
    assert len({r.response for r in infer(both, Count()).collect()}) == 2


def test_a_malformed_page_does_not_stop_the_others(spark):
    df = spark.createDataFrame([("u1", "<![foo[bar]]><p>x</p>"), ("u2", "<p>ok</p>"), ("u3", None)], "url string, html string")
    rows = {r.url: r.nodes for r in dom_nodes(df, keep=["url"]).collect()}
    assert len(rows["u2"]) > 0 and rows["u3"] is None and "u1" in rows


def test_a_page_stored_twice_answers_once(spark):
    pages = spark.createDataFrame([("https://h/b/pages/answers", '<div id="answer-1"><p>ANS</p></div>')] * 2, "url string, html string")
    probs = spark.createDataFrame([("https://h/b/pages/q", 0, "Q", "answer-1", "answers#answer-1")],
                                  "chapter_url string, problem_pos int, question string, fragment string, answer_link string")
    rows = CR.answer_problems(pages, probs).collect()
    assert [r.answer for r in rows] == ["ANS"]


def test_first_link_gives_the_route(spark):
    links = spark.createDataFrame([("u", "key_terms", 0, "a"), ("u", "chapter", 3, "a"), ("v", "x", 1, "a")],
                                  "resolved_url string, route string, pos int, url string")
    assert {r.resolved_url: r.route for r in SEC.dedup_links(links, order=["pos", "url"]).collect()} == {
        "u": "key_terms", "v": "x"}


def test_pair_keys_do_not_collide(spark):
    big = 2 ** 63 - 1
    rows = [(1, 1000), (2, 0), (1, 999), (0, 2000), (big, big), (big, 0), (0, big)]
    df = spark.createDataFrame(rows, "a bigint, b bigint").select("a", "b", FX.pair_key("a", "b").alias("k"))
    keys = {(r.a, r.b): r.k for r in df.collect()}
    assert len(set(keys.values())) == len(rows)
    assert sorted(rows) == sorted(rows, key=keys.get)


def test_choice_sets_keep_every_line(spark):
    texts = ["a", "a\nb", "\n".join("abcde"), "\n".join("abcdefgh"), ""]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    sets = FX.choice_sets(df).orderBy("seq").collect()
    assert sum(len(r.choices) + 1 for r in sets) == sum(len(t.split("\n")) for t in texts)
    assert [len(r.choices) for r in sets] == [0, 1, 4, 4, 2, 0]


def test_streamed_pages_of_catalogued_books_are_routed(spark):
    url = "https://books.example.org/books/principles-economics-3e/pages/1-key-terms"
    other = "https://books.example.org/books/unknown-book/pages/1-key-terms"
    html = '<div id="main-content"><dl><dt>T</dt><dd>D</dd></dl></div>'
    df = spark.createDataFrame([(url, html), (other, html)], "url string, html string")
    rows = ST.sections_stream(df).collect()
    assert [(r.chapter_url, r.section_name) for r in rows] == [(url, "keyterms")]
