import datetime as dt
import tempfile

from pyspark.sql import functions as F

from qbank.functions import choices as CH
from qbank.streaming.jobs import run_available, sections_stream

PAGE = ('<html><body><div id="main-content"><section class="section-summary"><h2>H</h2>'
        '<p>A</p></section></div></body></html>')
URL = "https://books.example.org/books/finance-x/pages/3-summary"


def test_watermarked_dedup_stream(spark):
    t = dt.datetime(2024, 1, 1)
    schema = "url string, html string, fetched_at timestamp"
    land = tempfile.mkdtemp(prefix="qbank-land-")
    for k in range(2):  # the same page lands twice, an hour apart
        spark.createDataFrame([(URL, PAGE, t + dt.timedelta(hours=k))], schema) \
            .write.mode("append").parquet(land)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(land)
    sink, ckpt = tempfile.mkdtemp(prefix="qbank-sink-"), tempfile.mkdtemp(prefix="qbank-ck-")
    run_available(sections_stream(src, event_time="fetched_at"), sink, ckpt)
    out = spark.read.parquet(sink).collect()
    assert len(out) == 1
    assert [(q.question, q.answer) for q in out[0].questions_and_answers] == [("H", "A")]
    # batch input falls back to a plain de-dup
    batch = spark.read.parquet(land)
    assert sections_stream(batch, event_time="fetched_at").count() == 1


def test_seed_zero_is_a_seed(spark):
    # Seed 0 gives its own deterministic order (not "unseeded")
    df = spark.createDataFrame([(i, [f"c{j}" for j in range(6)]) for i in range(30)], ["seq", "ch"])
    a = [r[0] for r in df.select(CH.shuffled("ch", F.lit(0), "seq")).collect()]
    b = [r[0] for r in df.select(CH.shuffled("ch", F.lit(0), "seq")).collect()]
    c = [r[0] for r in df.select(CH.shuffled("ch", F.lit(42), "seq")).collect()]
    assert a == b and a != c


def test_enrich_keeps_questions_missing_on_either_side(spark):
    # Full outer join: a question without an answer shows NULL answer fields
    log = spark.createDataFrame([("q1", 0, True)], ["question", "predicted_index", "correct"])
    data = spark.createDataFrame([("q1", "m1", 0), ("q2", "m2", 1)], ["question", "mcq", "row_index"])
    out = {r.question: r for r in log.join(data, "question", "full_outer").collect()}
    assert out["q2"].predicted_index is None and out["q2"].mcq == "m2"
