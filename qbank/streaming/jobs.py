"""Structured Streaming forms (ST1, ST2).

ST1 ``stream_sections``: pages landing as files -> each URL once (state kept for
``delay`` of event time) -> X0 -> extraction routed by the page's own URL -> append
to a Parquet sink. Only URLs and the places of their pages go through the state's
shuffle; the markup is read where it landed (``pages_at``). ``stream_self_check``: a question waits for its answer in a left
outer stream-stream join on (page, element id). The watermark bounds both sides' state,
and a question whose answer does not come within ``wait`` is emitted as ``absent``.

ST2 ``stream_result_log``: model results landing as JSON lines are appended to a log, a
folder per micro-batch that a retried batch overwrites; ``last_results`` reads it with
the last succeeded result of each request winning (A4), whatever the order of arrival.
The stream holds no state, so nothing has to be evicted. ``stream_scored_results`` joins
the log to the request table and scores it.

All run with ``trigger(availableNow=True)`` (drain what has landed, then stop) and keep
their checkpoints under the session's checkpoint folder, so a restarted driver resumes
where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qbank.functions import text as TX
from qbank.functions import url as U
from qbank.operators import evaluate as EV
from qbank.operators import extract as X
from qbank.operators.dom import dom_nodes
from qbank.operators.sections import SELF_CHECK
from qbank.session import checkpoint_dir, materialize
from qbank.sources.io import CATALOG

BOOKS = ("econ", "finance")

PAGE_SCHEMA = T.StructType([T.StructField("url", T.StringType()),
                            T.StructField("html", T.StringType()),
                            T.StructField("fetched_at", T.TimestampType())])
#: ``seq`` orders the results of one request: the number of the poll that brought it.
RESULT_SCHEMA = T.StructType([T.StructField("custom_id", T.StringType()),
                              T.StructField("seq", T.LongType()),
                              T.StructField("result_type", T.StringType()),
                              T.StructField("response", T.StringType())])
FETCHED_AT = "fetched_at"


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def page_book(url_col: str = "url", catalog=CATALOG) -> F.Column:
    """The kind of a page's book: by the subject of its slug in the catalog, else
    the slug's first part where that names a kind."""
    slug = U.textbook_name(url_col)
    kinds = [(s, subject.lower()) for subject, _, _, s in catalog if subject.lower() in BOOKS]
    known = F.create_map(*[F.lit(x) for pair in kinds for x in pair]) if kinds else None
    first = F.split(slug, "-")[0]
    named = F.when(first.isin(*BOOKS), first)
    return F.coalesce(known[slug], named) if known is not None else named


def page_route(url_col: str = "url", book: F.Column | None = None) -> F.Column:
    """Route a landed page by its own URL."""
    cn = U.chapter_name(url_col)
    book = page_book(url_col) if book is None else book
    return F.when(book == "econ", U.route_econ(cn)).when(book == "finance", U.route_finance(cn))


def each_url_once(pages: DataFrame, event_time: str | None, delay: str, which: F.Column | None = None) -> DataFrame:
    """Each URL once; with ``which`` (a condition on the URL alone) only the URLs it holds
    for, so that other pages don't travel. Event time goes on by all pages: the condition
    names its column, or it would be checked before the watermark."""
    if event_time and pages.isStreaming:
        pages = pages.withWatermark(event_time, delay)
        if which is not None:
            pages = pages.where(F.coalesce(F.when(F.col(event_time).isNull(), which), which))
        return pages.dropDuplicatesWithinWatermark(["url"])
    return (pages if which is None else pages.where(which)).dropDuplicates(["url"])


def sections_stream(pages: DataFrame, event_time: str | None = None,
                    delay: str = "1 day") -> DataFrame:
    """The streaming transformation of ST1 (works on batch input too): every routed
    page but the self-check ones, whose questions wait for their answer pages in
    ``self_check_stream``.

    With ``event_time`` (a fetch timestamp column) the URL de-dup keeps state
    only within the watermark delay; without it the state holds every URL seen."""
    return page_sections(section_pages(pages, event_time, delay))


def section_pages(pages: DataFrame, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Each URL of ``sections_stream`` once, with the other columns of its first page."""
    route = page_route("url")
    return each_url_once(pages, event_time, delay, route.isNotNull() & (route != "self_check"))


def page_sections(pages: DataFrame) -> DataFrame:
    """The sections of pages (``url, html``), routed by their own URLs."""
    from qbank.plans.crawl import extract_sections
    routed = pages.withColumn("book", page_book("url")).withColumn("route", page_route("url", F.col("book")))
    parsed = dom_nodes(routed.select(F.col("url").alias("chapter_url"), "route", "book", "html"),
                       keep=["chapter_url", "route", "book"])
    return extract_sections(parsed).drop("problems")


def is_answer_page(url_col: str = "url") -> F.Column:
    """Pages that answers are looked up in: those that no callback claims."""
    return page_route(url_col).isNull()


def self_check_stream(questions: DataFrame, answers: DataFrame, event_time: str = FETCHED_AT,
                      delay: str = "1 hour", wait: str = "6 hours") -> DataFrame:
    """X6 + F4 + J2 + J3 as a stream-stream join: a question waits for its answer, an
    answer for its questions. Both arguments are the landed pages (two reads of one
    source). An answer counts that is fetched within ``wait`` of the question, before
    or after it; rows over ``delay`` behind the newest page are dropped as late.

    ``answer_status``: ``found``; ``no_link`` (no element is named, nothing to wait
    for); ``absent`` (the wait is over; the answer is empty). State: questions without
    an answer so far and the elements of answer pages, for ``wait`` and ``delay``."""
    q = each_url_once(questions, event_time, delay, (page_book("url") == "econ") & (page_route("url") == "self_check"))
    probs = dom_nodes(q.select(F.col("url").alias("chapter_url"), event_time, "html"), keep=["chapter_url", event_time])
    probs = probs.select("chapter_url", F.col(event_time).alias("asked_at"),
                         F.posexplode(X.self_check_problems("nodes")).alias("problem_pos", "p"))
    probs = probs.select("chapter_url", "problem_pos", "asked_at", F.col("p.question").alias("question"),
                         F.col("p.fragment").alias("fragment"),
                         U.resolve_url("chapter_url", "p.answer_link").alias("answer_url"))
    a = each_url_once(answers, event_time, delay, is_answer_page("url")).where(F.col("html").isNotNull())
    a = dom_nodes(a.select("url", event_time, "html"), keep=["url", event_time])
    a = a.select(F.col("url").alias("page_url"), F.col(event_time).alias("found_at"),
                 F.explode(_texts_by_id("nodes")).alias("e"))
    a = a.select("page_url", "found_at", F.col("e.id").alias("element"), F.col("e.text").alias("found"))
    span = F.expr(f"INTERVAL {wait}")
    j = probs.join(a, (F.col("answer_url") == F.col("page_url")) & (F.col("fragment") == F.col("element"))
                   & (F.col("found_at") >= F.col("asked_at") - span) & (F.col("found_at") <= F.col("asked_at") + span),
                   "left_outer" if questions.isStreaming else "left")
    named = X.truthy(F.col("fragment"))
    status = F.when(~named, "no_link").when(F.col("page_url").isNull(), "absent").otherwise("found")
    answer = F.when(~named, F.lit("Answer not found")).otherwise(F.coalesce("found", F.lit("")))
    return answered(j.withColumn("answer", answer).withColumn("answer_status", status).select(*ANSWERED))


#: What the question-answer join finds; the other columns follow from these.
ANSWERED = ["chapter_url", "question", "answer", "problem_pos", "answer_status", "asked_at"]


def answered(found: DataFrame) -> DataFrame:
    """The canonical section columns of ``ANSWERED`` rows."""
    return found.select(F.lit(SELF_CHECK).alias("section_name"), TX.qa_text("question", "answer").alias("section_text"),
                        U.chapter_name("chapter_url").alias("chapter_name"),
                        U.textbook_name("chapter_url").alias("textbook_name"), *ANSWERED)


def _texts_by_id(nodes: str) -> F.Column:
    """(id, text) of a page's elements, one per id: the texts of elements that share an
    id end to end, in document order."""
    found = X.elements_with_id(nodes)
    ids = F.array_distinct(F.transform(found, lambda e: e["elem_id"]))
    text = lambda i: F.array_join(F.transform(F.filter(found, lambda e: e["elem_id"] == i), lambda e: e["text"]), "")
    return F.transform(ids, lambda i: F.struct(i.alias("id"), text(i).alias("text")))


def run_available(stream: DataFrame, sink_path: str, ckpt: str) -> list[dict]:
    """Drain what has landed into a Parquet folder; the progress of the last batches."""
    return _drained(stream.writeStream.format("parquet").option("path", sink_path).option("compression", "zstd")
                    .outputMode("append"), ckpt)


def _drained(writer, ckpt: str) -> list[dict]:
    q = writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q.recentProgress


def _pages(spark: SparkSession, landing: str, max_files_per_trigger: int) -> DataFrame:
    return (spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(landing))


def _place() -> list[F.Column]:
    """Where a landed page lies: its file and its row in it."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


def pages_at(landing: str, places: DataFrame) -> DataFrame:
    """The landed pages (``url, html``) at ``places`` (``file, row``), read where they lie.
    ``places`` is read once; what every task gets of it is a bit for each row of the files."""
    part, bit = F.bitmap_bucket_number("row"), F.bitmap_bit_position("row")
    taken = materialize(places.groupBy(F.col("file").alias("_file"), part.alias("_part"))
                        .agg(F.bitmap_construct_agg(bit).alias("_bits")), "places")
    files = [r[0] for r in taken.select("_file").distinct().collect()]  # of one micro-batch
    pages = places.sparkSession.read.schema(PAGE_SCHEMA).parquet(landing)
    pages = pages.where(F.col("_metadata.file_path").isin(files)).select("url", "html", *_place())
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    here = ((F.col("file") == F.col("_file")) & (part == F.col("_part"))
            & (byte.bitwiseAND(F.expr("shiftleft(1, int(bitmap_bit_position(row) % 8))")) != 0))
    return pages.join(F.broadcast(taken), here, "left_semi").drop("file", "row")


def stream_sections(spark: SparkSession, landing: str, max_files_per_trigger: int = 1) -> DataFrame:
    """ST1: drain the landing folder through the stream, return the sink. A micro-batch
    writes its own folder, which it overwrites if it runs again."""
    src = _pages(spark, landing, max_files_per_trigger).select("url", FETCHED_AT, *_place())
    sink = _scratch(spark, "st1-sink")

    def append(batch: DataFrame, number: int) -> None:
        found = page_sections(pages_at(landing, batch.select("file", "row")))
        found.write.mode("overwrite").option("compression", "zstd").parquet(f"{sink}/batch={number}")
    _drained(section_pages(src, FETCHED_AT).writeStream.foreachBatch(append), _scratch(spark, "st1-ckpt"))
    return spark.read.option("recursiveFileLookup", "true").parquet(sink)


def stream_self_check(spark: SparkSession, landing: str, max_files_per_trigger: int = 1,
                      progress: list | None = None, **times) -> DataFrame:
    """ST1, second hop: drain the landing folder through the question-answer join."""
    read = lambda: _pages(spark, landing, max_files_per_trigger)
    sink = _scratch(spark, "st1-answers")
    # the sink holds no text twice
    seen = run_available(self_check_stream(read(), read(), **times).select(*ANSWERED), sink, _scratch(spark, "st1-answers-ckpt"))
    if progress is not None:
        progress += seen
    return answered(spark.read.parquet(sink))


def stream_result_log(spark: SparkSession, landing: str, log: str, ckpt: str,
                      max_files_per_trigger: int = 1) -> None:
    """ST2: append the results that have landed to ``log``, a folder per micro-batch. A
    batch that runs again (a restart in its middle) overwrites its own folder."""
    src = (spark.readStream.schema(RESULT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
           .json(landing))

    def append(batch: DataFrame, number: int) -> None:
        last_results(batch).write.mode("overwrite").parquet(f"{log}/batch={number}")
    _drained(src.writeStream.foreachBatch(append), ckpt)


def last_results(results: DataFrame) -> DataFrame:
    """A4 over results: the last succeeded one of each request, by ``seq`` (of equal
    ones the greatest response, so that redelivery and order don't matter)."""
    ok = results.where(F.col("result_type") == "succeeded")
    best = F.max(F.struct(F.coalesce("seq", F.lit(-1)).alias("seq"), "response")).alias("r")
    return ok.groupBy("custom_id").agg(best).select(
        "custom_id", "r.seq", F.lit("succeeded").alias("result_type"), "r.response")


def read_result_log(spark: SparkSession, log: str) -> DataFrame:
    """The log's last results (a partial aggregate per batch stands in the log already)."""
    return last_results(spark.read.schema(RESULT_SCHEMA).option("recursiveFileLookup", "true").parquet(log))


def stream_scored_results(spark: SparkSession, landing: str, requests: DataFrame,
                          max_files_per_trigger: int = 1) -> DataFrame:
    """ST2: results arriving as JSON lines, the last of each request joined to it and scored."""
    log = _scratch(spark, "st2-log")
    stream_result_log(spark, landing, log, _scratch(spark, "st2-ckpt"), max_files_per_trigger)
    ok = read_result_log(spark, log)
    return (ok.join(requests.select("custom_id", "gold_index"), "custom_id")
            .withColumn("predicted_index", EV.predicted_index(
                F.from_json("response", EV.ANSWER_SCHEMA)["choice"], "zero_based"))
            .withColumn("correct", F.coalesce(F.col("predicted_index") == F.col("gold_index"), F.lit(False))))
