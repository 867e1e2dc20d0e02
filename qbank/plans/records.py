"""Record forms: generated questions, their audit, sentence delivery, JSON arrays, boxes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.functions import url as U
from qbank.operators import extract as X
from qbank.operators import keypoints as KP
from qbank.operators import mcq as MCQ
from qbank.operators import sections as SEC
from qbank.operators.dom import dom_nodes
from qbank.plans import exports as EXP
from qbank.plans import feed as FD
from qbank.plans.generation import K, SEED, generated
from qbank.sources import fixtures as FX
from qbank.sources import json_array as JA
from qbank.sources import tables as TB
from qbank.sources import textbook_site as TS


def json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC2: the section feed as indented JSON arrays, read back from all splits."""
    path = EXP._path(spark, "json-arrays")
    JA.write_json_arrays(FD.sections(spark, sf_dir), path, indent=2)
    return JA.read_json_array(spark, path, EXP.SECTION_COLS)


def mcq_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the record of every generated question: type, choices, provenance."""
    r = MCQ.mcq_record(generated(spark, sf_dir), SEC.SELF_CHECK)
    return r.withColumn("choices", F.array_join("choices", "\n~\n"))


def prompt_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every call of every generated question, in call order: the prompt's MD5 and
    what the reply told (names of the key points, the new one, or the text itself)."""
    calls = KP.audit_calls(generated(spark, sf_dir))
    names = F.array_join(F.transform(F.from_json("response", KP.KEYPOINTS_SCHEMA)["Keypoints"],
                                     lambda x: x["keypoint"]), ",")
    told = (F.when(F.col("stage") == "extract_keypoints", names)
            .when(F.col("stage") == "distort_keypoint", F.from_json("response", KP.DISTORT_SCHEMA)["new_keypoint"])
            .otherwise(F.col("response")))
    return calls.select("seq", "stage", "pos", F.md5("prompt").alias("prompt_md5"), told.alias("told"))


def unshuffled_mcqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed-order questions of every renderable choice set."""
    sets = FX.choice_sets(TB.documents(spark, sf_dir).select("doc_id", "text", "source"))
    good, _ = MCQ.split_renderable(sets)
    return MCQ.unshuffled_mcq(good).select("seq", "gold_index", "gold_letter", "mcq")


def sampled_keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of S2 drawn from one row per key point; unlike S2 it keeps what a
    question with fewer than k key points has."""
    sets = FX.keypoint_sets(TB.documents(spark, sf_dir).select("doc_id", "text", "source"), duplicate_names=True)
    rows = sets.select("seq", F.posexplode("keypoints").alias("pos", "kp"))
    return KP.sample_rank(rows, K, SEED, "seq", "pos").select("seq", "pos", F.col("kp.keypoint").alias("keypoint"))


def delivery_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery records whose text is split into sentences."""
    env = SEC.delivery_envelope(FD.sections(spark, sf_dir), FD.LOAD_DATE, sentence_split=True)
    return env.select(F.col("record.text").alias("text"), F.col("record.metadata.site url").alias("site_url"))


def page_class_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 on the raw pages: all text of the elements of one class."""
    nodes = dom_nodes(TB.pages(spark, sf_dir).select("page_id", "html"), keep=["page_id"])
    return nodes.select("page_id", X.class_text("nodes", "div", "ad").alias("class_text"))


def box_pages(documents: DataFrame) -> DataFrame:
    """A chapter page per document: a section for every three lines, with a title in
    every second one and a box two levels down, of one of the four classes in turn."""
    d = documents.select("doc_id", TS.TX.lines("text").alias("lines"))
    classes = F.array(*[F.lit(c) for c in X.SPECIAL_SECTIONS + X.IMAGE_SECTIONS])

    def section(g):
        head = F.when(g % 2 == 0, F.concat(F.lit('<h2 data-type="title">'), TS._line(3 * g + 1), F.lit("</h2>"))) \
            .otherwise(F.concat(F.lit("<p>"), TS._line(3 * g + 1), F.lit("</p>")))
        box = F.concat(F.lit('<div><div class="note '), F.get(classes, (g % 4).cast("int")), F.lit('"><span>'),
                       TS._line(3 * g + 3), F.lit("</span></div></div>"))
        return F.concat(F.lit("<section>"), head, F.lit("<p>"), TS._line(3 * g + 2), F.lit("</p>"), box, F.lit("</section>"))
    body = F.concat(F.lit('<div class="chapter-content-module">'), TS._blocks(F.ceil(F.size("lines") / 3).cast("int"), section),
                    F.lit("</div>"))
    return d.select("doc_id", TS._page(body).alias("html"))


def nested_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 + X12: the boxes of all four classes inside sections, then the section without
    them; sections without a title get the default name."""
    pages = box_pages(TB.documents(spark, sf_dir).select("doc_id", "text"))
    n = dom_nodes(pages.repartition(spark.sparkContext.defaultParallelism * 2, "doc_id"), keep=["doc_id"])
    s = n.select("doc_id", F.posexplode(X.section_blocks("nodes")).alias("pos", "s"))
    own = F.struct(F.col("s.section_name").alias("section_name"), F.col("s.section_text").alias("section_text"))
    s = s.select("doc_id", "pos", F.posexplode(F.concat(F.col("s.boxes"), F.array(own))).alias("nth", "r"))
    return s.select("doc_id", "pos", "nth", F.col("r.section_name").alias("section_name"),
                    F.col("r.section_text").alias("section_text"))
