"""Streams: bounded state, late and absent rows, restarts and redelivery."""
import json

import pytest
from pyspark.sql import functions as F

from qbank.plans import streams as STR
from qbank.streaming import jobs as ST

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def one_partition(spark):
    """State stores of a few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


BOOK = "https://books.example.org/books/econ-x/pages/"


def page(*problems):
    return '<div id="main-content">' + "".join(
        f'<div data-type="problem" id="p{k}"><p>{q}</p><a href="{link}" {frag}>Show</a></div>'
        for k, (q, link, frag) in enumerate(problems)) + "</div>"


def asks(q, element, answers="1-answers"):
    return (q, f"{answers}#{element}", f'data-page-fragment="{element}"')


def run(spark, waves, **times):
    """Pages of every wave (minutes, url, html) land in order of the list."""
    landing = ST._scratch(spark, "test-landing")
    for minutes, url, html in waves:
        df = spark.createDataFrame([(BOOK + url, html)], "url string, html string").coalesce(1)
        STR._land(df, landing, minutes)
    progress = []
    rows = ST.stream_self_check(spark, landing, progress=progress, **times).collect()
    return {r.question.removesuffix("Show"): (r.answer, r.answer_status) for r in rows}, rows, progress


def test_early_late_and_absent_answers(spark):
    got, rows, progress = run(spark, [
        (-60, "1-answers", '<div id="a1">early</div><div id="a2">one <b>two</b></div><div id="a2">!</div>'),
        (0, "1-self-check-questions", page(asks("q1", "a1"), asks("q2", "a2"), asks("q3", "none"), ("q4", "1-answers", ""))),
        (5, "2-self-check-questions", page(asks("q5", "b1", "2-answers"), asks("q6", "c1", "3-answers"))),
        (60, "2-answers", '<div id="b1">late</div>'),
        (61, "2-answers", '<div id="b1">fetched again</div>'),
        (60 * 24, "3-answers", '<div id="c1">after the wait</div>'),
        (60 * 24 * 7, "index", None), (60 * 24 * 8, "index", None)])
    assert got == {"q1": ("early", "found"), "q2": ("one two!", "found"), "q3": ("", "absent"),
                   "q4": ("Answer not found", "no_link"), "q5": ("late", "found"), "q6": ("", "absent")}
    assert len(rows) == 6
    # the watermark has evicted what the join and the de-duplication held
    last = progress[-1]["stateOperators"]
    assert max(op["numRowsTotal"] for p in progress for op in p["stateOperators"]) > 3
    assert sum(op["numRowsTotal"] for op in last if op["operatorName"] == "symmetricHashJoin") == 0
    assert all(op["numRowsTotal"] <= 2 for op in last)


def test_rows_behind_the_watermark_are_dropped(spark):
    got, _, progress = run(spark, [
        (60 * 24, "1-self-check-questions", page(asks("new", "a1"))),
        (60 * 24, "index", None),  # rows are late by the watermark of the batch before
        (0, "2-self-check-questions", page(asks("late", "a1"))),
        (60 * 24, "1-answers", '<div id="a1">yes</div>'), (60 * 24 * 7, "index", None), (60 * 24 * 8, "index", None)])
    assert got == {"new": ("yes", "found")}
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) >= 1


def test_state_stays_bounded_over_waves(spark):
    progress = []
    rows = STR.waiting_answers(spark, SF, progress=progress).collect()
    assert {r.answer_status for r in rows} == {"found", "absent", "no_link"}
    joins = [sum(op["numRowsTotal"] for op in p["stateOperators"] if op["operatorName"] == "symmetricHashJoin")
             for p in progress]
    assert max(joins) > 100 and joins[-1] == 0


def land(path, name, rows):
    with open(f"{path}/{name}.json", "w") as f:
        for i, seq, kind, text in rows:
            f.write(json.dumps({"custom_id": i, "seq": seq, "result_type": kind, "response": text}) + "\n")


def test_last_result_wins_across_batches_and_restarts(spark, tmp_path):
    src, log, ckpt = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "ckpt")
    src.mkdir()
    last = lambda: {r.custom_id: (r.seq, r.response) for r in ST.read_result_log(spark, log).collect()}
    land(src, "1", [("a", 5, "succeeded", "five"), ("b", 1, "succeeded", "one"), ("c", 1, "errored", None)])
    ST.stream_result_log(spark, str(src), log, ckpt)
    assert last() == {"a": (5, "five"), "b": (1, "one")}
    # reordered (seq 2 after 5), repeated, an error after a success, a null seq, a tie
    land(src, "2", [("a", 2, "succeeded", "two"), ("b", 1, "succeeded", "one"), ("b", 9, "errored", None)])
    land(src, "3", [("b", 3, "succeeded", "three"), ("d", None, "succeeded", "x"), ("e", 1, "succeeded", "p"), ("e", 1, "succeeded", "q")])
    ST.stream_result_log(spark, str(src), log, ckpt)
    want = {"a": (5, "five"), "b": (3, "three"), "d": (-1, "x"), "e": (1, "q")}
    assert last() == want
    # a batch that is run again overwrites its folder; nothing new lands on a restart
    again = spark.read.schema(ST.RESULT_SCHEMA).json(str(src / "1.json"))
    ST.last_results(again).write.mode("overwrite").parquet(f"{log}/batch=0")
    ST.stream_result_log(spark, str(src), log, ckpt)
    assert last() == want
    batch = ST.last_results(spark.read.schema(ST.RESULT_SCHEMA).json(str(src)))
    assert {r.custom_id: (r.seq, r.response) for r in batch.collect()} == want


def test_batch_and_stream_read_the_same_answers(spark):
    """On batch input the same function is an ordinary left join."""
    t = F.lit("2024-01-01").cast("timestamp")
    pages = spark.createDataFrame(
        [(BOOK + "1-self-check-questions", page(asks("q1", "a1"), asks("q2", "zz"))), (BOOK + "1-answers", '<div id="a1">A</div>')],
        "url string, html string").withColumn("fetched_at", t)
    got = {r.question: r.answer_status for r in ST.self_check_stream(pages, pages).collect()}
    assert got == {"q1Show": "found", "q2Show": "absent"}


def test_the_answer_sink_holds_no_text_twice(spark, tmp_path, monkeypatch):
    import datetime
    base, at = "https://books.example.org/books/econ-x/pages/", datetime.datetime(2024, 1, 1)
    asks = '<div data-type="problem"><p>Why?</p><a href="1-answers#a1" data-page-fragment="a1">Show</a></div>'
    landing, seen, run = str(tmp_path / "landing"), [], ST.run_available
    spark.createDataFrame([(base + "1-self-check-questions", asks, at), (base + "1-answers", '<div id="a1">So.</div>', at)],
                          ST.PAGE_SCHEMA).coalesce(1).write.parquet(landing)
    monkeypatch.setattr(ST, "run_available", lambda stream, *a: seen.append(stream.columns) or run(stream, *a))
    got = ST.stream_self_check(spark, landing).collect()
    assert seen == [ST.ANSWERED] and "section_text" not in seen[0]
    assert [(r.section_name, r.section_text, r.chapter_name, r.textbook_name, r.answer_status) for r in got] == [
        ("self-check-questions", "Question: Why?Show Answer: So.", "1-self-check-questions", "econ-x", "found")]


def land_pages(spark, landing, rows, files=1):
    import datetime
    df = spark.createDataFrame([(*r, datetime.datetime(2024, 1, 1)) for r in rows], ST.PAGE_SCHEMA)
    df.coalesce(files).write.mode("append").option("parquet.block.size", 1 << 16).parquet(landing)


def test_only_urls_are_shuffled_for_sections(spark, tmp_path, monkeypatch):
    base, landing, seen, once = "https://books.example.org/books/finance-x/pages/", str(tmp_path / "a landing"), [], ST.each_url_once
    text = lambda i: f'<div id="main-content">{i} {"x" * 300}</div>'
    rows = [(f"{base}{i}-summary", text(i)) for i in range(900)]
    land_pages(spark, landing, rows + [(base + "901-summary", None), (None, "x"), ("u", "y")], 3)
    land_pages(spark, landing, rows[:500] + [(base + "902-problems", text(902))] * 2)
    monkeypatch.setattr(ST, "each_url_once", lambda pages, *a: seen.append(pages.columns) or once(pages, *a))
    got = ST.stream_sections(spark, landing, max_files_per_trigger=2).collect()
    assert seen and all("html" not in columns for columns in seen)
    want = {(f"{i}-summary", f'{i} {"x" * 300}') for i in range(900)} | {("901-summary", None), ("902-problems", f'902 {"x" * 300}')}
    assert len(got) == len(want) and {(r.chapter_name, r.section_text) for r in got} == want


def test_sections_of_an_empty_landing(spark, tmp_path):
    land_pages(spark, str(tmp_path / "landing"), [])
    assert ST.stream_sections(spark, str(tmp_path / "landing")).count() == 0


def test_pages_are_found_by_file_and_row(spark, tmp_path):
    landing = str(tmp_path / "landing")
    spark.range(0, 70000, 1, 2).selectExpr("string(id) url", "string(-id) html", "timestamp'2024-01-01' fetched_at").write.parquet(landing)
    pages = spark.read.schema(ST.PAGE_SCHEMA).parquet(landing).select("url", *ST._place())
    some = pages.where("url % 7 = 3 or url in (0, 32767, 32768, 34999, 35000, 69999)")
    want = {(r.url, str(-int(r.url))) for r in some.collect()}
    got = ST.pages_at(landing, some.select("file", "row")).collect()
    assert len(got) == len(want) > 9000 and {(r.url, r.html.replace("-0", "0")) for r in got} == want


def test_what_streams_keep_is_packed(spark, tmp_path, monkeypatch):
    """The landed pages and both sinks of the section counts."""
    import pyarrow.parquet as pq
    monkeypatch.setattr(ST, "_scratch", lambda spark, name: str(tmp_path / name))
    assert STR.stream_section_counts(spark, SF).count() == 8
    for name in ("st1-landing", "st1-sink", "st1-answers"):
        files = list((tmp_path / name).rglob("*.parquet"))
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files
                          if pq.ParquetFile(f).metadata.num_rows} == {"ZSTD"}


def test_a_wave_is_one_micro_batch(spark):
    """More cores write more files of a wave, not more loads and commits of the state."""
    progress = []
    STR.waiting_answers(spark, SF, progress=progress)
    assert STR._files(spark, 2) > 2
    assert sum(p["numInputRows"] > 0 for p in progress) <= len(STR.ANSWER_DELAYS) + 2
