"""Plan-shape checks for the scale properties the operators promise."""
import contextlib
import io
import uuid

import pandas as pd
from pyspark.sql import functions as F

from qbank.operators import evaluate as EV
from qbank.operators.infer import Backend, build_requests, infer
from qbank.operators.joins import semi_join


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_prompt_is_asked_once(spark):
    class UniqueReply(Backend):  # local class: shipped to the workers by value
        """Every backend call returns a fresh id: equal replies mean one call."""
        def complete(self, batch):
            return pd.DataFrame({"response": [uuid.uuid4().hex for _ in range(len(batch))],
                                 "status": "ok", "error": None})

    # a third of the rows carry the same prompt
    rows = [(i, "hot" if i % 3 == 0 else f"p{i}") for i in range(300)]
    df = spark.createDataFrame(rows, ["id", "prompt"])
    out = infer(build_requests(df, request_id="id", prompt="prompt", task="t"), UniqueReply())
    got = out.select("request_id", "response").collect()
    hot = {r.response for r in got if int(r.request_id) % 3 == 0}
    assert len(got) == 300 and len(hot) == 1
    assert len({r.response for r in got}) == 1 + 200


def test_last_wins_pre_aggregates(spark):
    df = spark.createDataFrame([("q", i, i % 2 == 0) for i in range(50)], ["question", "seq", "correct"])
    p = plan(EV.last_wins(df, "question", "seq"))
    assert "partial_max_by" in p and "partial_min" in p


def test_semi_join_broadcasts_by_size_statistics(spark):
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(semi_join(big, small, "k"))
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert semi_join(big, small, "k").count() == 10


def test_no_job_runs_while_links_are_followed(spark, monkeypatch):
    """Building J1 runs the write of the link frontier and nothing else."""
    from qbank.plans import crawl as CR
    pages = CR.site(spark, "/root/testdata/sf0.001")
    wrote = []
    monkeypatch.setattr(CR, "materialize", lambda df, name, **k: wrote.append(name) or df)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("j1", "building J1")
    CR.fetched_html(pages)
    assert wrote == ["links"] and len(tracker.getJobIdsForGroup("j1")) == 0


def test_no_cartesian_products(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("mcq_accuracy", "enriched_log", "spot_check", "econ_self_check", "generated_mcqs"):
        p = plan(qs[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_pages_are_parsed_in_even_tasks(spark):
    """One file of one row group still feeds every core, and no task takes over twice the mean."""
    from qbank.plans import crawl as CR
    got = CR.fetched_html(CR.site(spark, "/root/testdata/sf0.01"))
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 2 * spark.sparkContext.defaultParallelism
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_one_copy_of_a_page(spark):
    from qbank.plans import crawl as CR
    rows = [("u", "a"), ("u", "b"), ("u", "b"), ("v", "c"), ("v", "c"), ("w", None)]
    pages = spark.createDataFrame(rows, "url string, html string")
    assert CR.parse_tasks(pages) == 2 * spark.sparkContext.defaultParallelism
    got = {tuple(r) for k in (1, 5) for r in CR.one_copy(pages.repartition(k), pages, "url").collect()}
    assert len(got) == 3 and {u for u, _ in got} == {"u", "v", "w"}


def test_page_scan_takes_a_bloom_filter_of_the_frontier(spark):
    """Where the page table is large (thresholds lowered here), its scan is filtered by
    the links' URLs before the shuffle of the join."""
    from qbank.plans import crawl as CR
    pages = CR.site(spark, "/root/testdata/sf0.001")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert "might_contain" in plan(CR.fetched_html(pages))
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_the_reply_cache_is_read_in_place_and_answers_a_second_run(spark):
    from qbank.operators.infer import ReplyTable
    from qbank.plans.replay import NoBackend

    class Echo(Backend):
        def complete(self, batch):
            return pd.DataFrame({"response": batch["prompt"].str.upper(), "status": "ok", "error": None})

    def ask(n, backend, cache):
        df = spark.range(n).selectExpr("id", "concat('p', id) AS prompt")
        req = build_requests(df, request_id="id", prompt="prompt", task="t")
        return infer(req, backend, cache=cache.read(), keep_prompt=True, name="cache-test")
    cache = ReplyTable(spark)
    first = ask(50, Echo(), cache)
    cache.add(first)
    again = ask(50, NoBackend(), cache).collect()
    assert {(r.status, r.response) for r in again} == {("ok", f"P{i}") for i in range(50)}
    more = {r.prompt: r.status for r in ask(60, NoBackend(), cache).collect()}
    assert sum(s == "ok" for s in more.values()) == 50 and more["p55"] == "error"
    cache.add(ask(60, Echo(), cache))  # keys stand twice now; still one reply each
    assert ReplyTable(spark, cache.path, cache.buckets).read().count() == 110
    assert len(ask(60, NoBackend(), cache).where("status = 'ok'").collect()) == 60
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.range(10).selectExpr("sha2(cast(id AS string), 256) AS cache_key")
        p = plan(keys.join(cache.read(), "cache_key"))
        scan = p.index(f"Scan parquet spark_catalog.default.{cache.name}")
        assert p[:scan].count("Exchange") == p.count("Exchange") / 2 == 1 or p.count("hashpartitioning") == 1
        assert "Bucketed: true" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_reply_never_meets_itself(spark):
    from qbank.plans.replay import others_replies, turn_requests
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (1, 2, "user", "hi"), (1, 3, "assistant", "b"),
            (2, 0, "user", "hi"), (2, 1, "assistant", "c"), (3, 0, "user", "hi"),
            (4, 0, "user", "alone"), (4, 1, "assistant", "d")]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): r.response for r in others_replies(turn_requests(conv)).collect()}
    assert got == {(1, 0): "c", (1, 2): "c", (2, 0): "b", (3, 0): "c", (4, 0): None}


def test_status_counts_cost_no_job(spark):
    from qbank.operators import keypoints as KP
    rows = [(i, s) for i, s in enumerate(["ok"] * 5 + ["too_few_keypoints"] * 2 + ["failed_distortion"])]
    df, seen = KP.count_statuses(spark.createDataFrame(rows, "seq int, status string"))
    spark.sparkContext.setJobGroup("counts", "one action")
    tracker = spark.sparkContext.statusTracker()
    df.write.format("noop").mode("overwrite").save()
    jobs = len(tracker.getJobIdsForGroup("counts"))
    got = seen.get
    assert len(tracker.getJobIdsForGroup("counts")) == jobs
    assert {k: v for k, v in got.items() if v} == {"ok": 5, "too_few_keypoints": 2, "failed_distortion": 1}
    assert set(got) == set(KP.STATUSES)
