"""End-to-end workflow over your own tables: the three entry points of the
original notebooks (crawl -> feed, feed -> MCQs, MCQs -> accuracy and labels),
as DataFrame functions. Any backend implementing ``Backend`` can be used
(``RuleBackend`` offline, ``ChatHttpBackend`` for a served model).

    feed = crawl(pages, {"econ": econ_start_urls})
    qs = self_check_questions(feed)
    mcqs = shuffle(generate(qs, backend))
    log, acc = evaluate(mcqs, backend)
    labels = classify(mcqs, backend)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qbank.operators import evaluate as EV
from qbank.operators import keypoints as KP
from qbank.operators import sections as SEC
from qbank.operators.infer import Backend
from qbank.operators.mcq import shuffle_choices, split_renderable
from qbank.plans.crawl import crawl_feed, parse_tasks
from qbank.sources.textbook_site import TOC_CLASS

PROVENANCE = ["chapter_name", "textbook_name", "chapter_url"]


def crawl(pages: DataFrame, seeds: dict[str, DataFrame], link_class: str = TOC_CLASS) -> DataFrame:
    """``pages(url, html)`` + start URLs per book kind -> section feed."""
    # a stored table may be one row group, which a scan cannot split
    pages = pages.repartition(parse_tasks(pages), "url")
    return crawl_feed(pages, seeds, link_class)


def self_check_questions(feed: DataFrame) -> DataFrame:
    """the self-check records, with a stable unique row id ``seq``: the page's
    URL and the problem's position on it, in text order, so reruns sample and
    shuffle the same way, joins on it mix nothing and its last row is the last
    problem (a page may repeat a question text)."""
    sc = SEC.split_sections(feed)[SEC.SELF_CHECK]
    place = F.lpad(F.col("problem_pos").cast("string"), 10, "0")
    return sc.select(F.concat_ws("#", "chapter_url", place).alias("seq"), "question", "answer",
                     *PROVENANCE)


def generate(questions: DataFrame, backend: Backend, k: int = 3, seed: int = 42,
             model: str = "rule") -> DataFrame:
    """Key-point distortion -> [gold, k misleading answers] per question."""
    return KP.generate_mcqs(questions, backend, k=k, seed=seed, model=model, carry=PROVENANCE)


def shuffle(generated: DataFrame, seed: int = 42) -> DataFrame:
    """S1 + P11 over the usable generated records (status ``ok``, renderable); the
    rest is in ``quarantined``."""
    good, _ = split_renderable(generated.where(F.col("status") == "ok"))
    return shuffle_choices(good, seed=seed)


def quarantined(generated: DataFrame) -> DataFrame:
    """The generated records that ``shuffle`` leaves out, with their reason."""
    _, bad = split_renderable(generated.where(F.col("status") == "ok"))
    failed = generated.where(F.col("status") != "ok").withColumn("reject_reason", F.col("status"))
    return failed.unionByName(bad)


def evaluate(mcqs: DataFrame, backend: Backend, scoring: str = "one_based",
             model: str = "rule") -> tuple[DataFrame, DataFrame]:
    """Answer log (last answer per question wins) and overall accuracy."""
    answered = EV.answer_questions(mcqs, backend, scoring=scoring, model=model)
    log = EV.last_wins(answered.select("question", "seq", "gold_index", "choice",
                                       "predicted_index", "correct", "reason"), "question", "seq")
    return log, EV.accuracy(log)


def classify(mcqs: DataFrame, backend: Backend, model: str = "rule") -> DataFrame:
    """P9 + M8: quality labels per question (last label wins)."""
    qs = SEC.with_clean_question(mcqs.select("seq", "question"))
    lab = EV.classify_questions(qs, backend, keep=["question"], model=model)
    cols = ["question", "seq", "completeness_choice", "type_choice", "mcq_choice", "codes_valid",
            "completeness_reason", "type_reason", "mcq_reason"]
    return EV.last_wins(lab.select(*cols), "question", "seq").drop("first_seq")
