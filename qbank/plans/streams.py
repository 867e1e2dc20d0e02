"""Registered streaming jobs: land derived files, drain them through the
stream, return the sink (checked against the batch oracles)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.operators.infer import RuleBackend, build_requests, infer
from qbank.operators import sections as SEC
from qbank.session import default_parallelism, materialize
from qbank.sources import tables as TB
from qbank.streaming import jobs as ST


def stream_main_texts(spark: SparkSession, sf_dir: str):
    """ST1: content pages land in two waves (the second repeats the first,
    as a re-crawl would); each URL is processed once."""
    from qbank.plans.crawl import site
    landing = ST._scratch(spark, "st1-landing")
    content = site(spark, sf_dir).where(F.col("page") == "content").select("url", "html")
    _land(content.coalesce(_files(spark, 4)), landing, 0)
    _land(content.coalesce(_files(spark, 3)), landing, 30)
    out = ST.stream_sections(spark, landing, max_files_per_trigger=4)
    return out.select("chapter_name", "section_name", "section_text")


def _files(spark: SparkSession, least: int) -> int:
    """Files of a wave: tasks' own, without a shuffle of the pages."""
    return max(least, default_parallelism(spark) or 1)


#: Event time of the first wave, and minutes until the clock has passed every wait.
START, LONG_AFTER = "2024-01-01 00:00:00", 60 * 24 * 7
#: Bytes of a row group of landed pages: a scan cannot split one, and pages are parsed where they lie.
ROW_GROUP = 8 << 20


def _land(pages: DataFrame, landing: str, minutes: int) -> None:
    """Let ``pages`` (url, html) land, fetched so many minutes after the start."""
    at = F.lit(START).cast("timestamp") + F.make_dt_interval(mins=F.lit(minutes))
    (pages.select("url", "html", at.alias(ST.FETCHED_AT)).write.mode("append")
     .option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(landing))


def _clock(spark: SparkSession, landing: str, minutes: int = LONG_AFTER) -> None:
    """A later fetch of pages that nobody asks for: event time goes on."""
    page = spark.range(1).select(F.lit("https://books.example.org/index").alias("url"),
                                 F.lit(None).cast("string").alias("html"))
    _land(page, landing, minutes)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """What the crawl fetches, landed in two waves that overlap; then time passes."""
    from qbank.plans.crawl import site
    landing = ST._scratch(spark, "st1-landing")
    got = site(spark, sf_dir).where(F.col("page").isin("content", "chapter", "answers")).select("url", "html")
    _land(got.coalesce(_files(spark, 4)), landing, 0)
    _land(got.where("url LIKE '%7-%'").coalesce(_files(spark, 2)), landing, 30)
    _clock(spark, landing)
    return landing


#: When a document's answer page is fetched, in minutes after its questions; by
#: doc_id % 5: before them, with them, after them, after the wait, and never.
ANSWER_DELAYS = (-120, 0, 180, 60 * 30, None)


def waiting_answers(spark: SparkSession, sf_dir: str, progress: list | None = None) -> DataFrame:
    """The question-answer join with the answers of ANSWER_DELAYS, in order of event time. A
    micro-batch takes the files of a wave, however many cores wrote them: each of its many
    state stores is loaded and committed once a wave."""
    from qbank.plans.crawl import site
    landing = ST._scratch(spark, "st1-waiting")
    pages = site(spark, sf_dir)
    waves = [(0, pages.where((F.col("page") == "content") & (F.col("kind") == 0)))]
    waves += [(minutes, pages.where((F.col("page") == "answers") & (F.col("doc_id") % len(ANSWER_DELAYS) == k)))
              for k, minutes in enumerate(ANSWER_DELAYS) if minutes is not None]
    for minutes, wave in sorted(waves, key=lambda w: w[0]):
        _land(wave.select("url", "html").coalesce(_files(spark, 2)), landing, minutes)
    _clock(spark, landing)
    return ST.stream_self_check(spark, landing, max_files_per_trigger=_files(spark, 2), progress=progress)


def stream_waiting_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 with event time: early, late, too late and absent answers."""
    return waiting_answers(spark, sf_dir).select("chapter_name", "question", "answer", "answer_status")


def stream_last_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 + A4: the turns of a conversation are the results of its request (an assistant
    turn succeeded); they land out of order and more than once, the stream is stopped
    half-way and resumed, and the last succeeded result of each request stays."""
    turns = TB.conversations(spark, sf_dir).select(
        F.col("conv_id").cast("string").alias("custom_id"), F.col("turn").alias("seq"),
        F.when(F.col("role") == "assistant", "succeeded").otherwise("errored").alias("result_type"),
        F.col("text").alias("response"))
    wave = F.xxhash64("custom_id", "seq") % 3
    landing, log, ckpt = (ST._scratch(spark, x) for x in ("st2-results", "st2-result-log", "st2-result-ckpt"))
    for k in (0, 1):
        turns.where(F.abs(wave) == k).repartition(2).write.mode("append").json(landing)
    ST.stream_result_log(spark, landing, log, ckpt, max_files_per_trigger=2)
    turns.where((F.abs(wave) == 2) | (F.abs(wave) == 0)).repartition(3).write.mode("append").json(landing)
    ST.stream_result_log(spark, landing, log, ckpt, max_files_per_trigger=2)
    return ST.read_result_log(spark, log).select("custom_id", "seq", "response")


def stream_self_check(spark: SparkSession, sf_dir: str):
    """ST1, second hop: questions joined with answer pages as either arrives."""
    out = ST.stream_self_check(spark, _landed(spark, sf_dir), max_files_per_trigger=4)
    return out.select("chapter_name", "question", "answer", "section_text")


def stream_section_counts(spark: SparkSession, sf_dir: str):
    """A1 over all page types of the streamed crawl."""
    landing = _landed(spark, sf_dir)
    rows = ST.stream_sections(spark, landing, max_files_per_trigger=6).select("section_name")
    asked = ST.stream_self_check(spark, landing, max_files_per_trigger=6).select("section_name")
    return SEC.section_counts(rows.unionByName(asked))


def stream_batch_accuracy(spark: SparkSession, sf_dir: str):
    """ST2: batch results land as JSON lines and are scored as they arrive."""
    from qbank.plans.evaluation import batch_requests
    req = materialize(batch_requests(spark, sf_dir), "batch-requests")  # not rebuilt per micro-batch
    p = F.from_json("params", "messages ARRAY<STRUCT<role: STRING, content: STRING>>")
    calls = req.select("custom_id", p.alias("p"))
    res = infer(build_requests(calls, request_id="custom_id", prompt=F.col("p.messages")[0]["content"],
                               task="answer_batch", model="rule-batch", max_tokens=1000),
                RuleBackend(), name="batch-results")
    landing = ST._scratch(spark, "st2-landing")
    (res.select(F.col("request_id").alias("custom_id"), F.lit(0).cast("bigint").alias("seq"),
                F.when(F.col("status") == "ok", "succeeded").otherwise("errored").alias("result_type"),
                "response")
     .repartition(4).write.mode("overwrite").json(landing))
    scored = ST.stream_scored_results(spark, landing, req, max_files_per_trigger=1)
    n_req = req.count()  # one scalar to the driver
    agg = scored.agg(F.lit(n_req).cast("bigint").alias("n_requests"),
                     F.count(F.lit(1)).alias("n_succeeded"),
                     F.coalesce(F.sum(F.col("correct").cast("bigint")), F.lit(0)).cast("bigint")
                     .alias("n_correct"))
    return agg.withColumn(
        "accuracy_pct", F.try_divide(F.col("n_correct").cast("double") * 100.0,
                                     F.col("n_succeeded").cast("double")))
