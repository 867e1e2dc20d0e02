"""The end-to-end workflow on user-shaped tables (pages with url/html and
explicit start URLs), run with the offline rule backend."""
from pyspark.sql import functions as F

from qbank.operators.infer import RuleBackend
from qbank.plans import workflow as WF
from qbank.plans.crawl import site


def test_workflow_end_to_end(spark):
    pages = site(spark, "/root/testdata/sf0.001").select("url", "html")
    econ_start = pages.where(F.col("url").endswith("-contents")
                             & F.col("url").contains("/econ-")).select("url")
    feed = WF.crawl(pages, {"econ": econ_start})
    names = {r.section_name: r.n for r in feed.groupBy("section_name")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(names) == {"keyterms", "keyconceptsandsummary", "self-check-questions"}
    qs = WF.self_check_questions(feed)
    assert qs.count() == names["self-check-questions"]
    backend = RuleBackend()
    gen = WF.generate(qs, backend)
    assert gen.count() == qs.count()
    mcqs = WF.shuffle(gen)
    rows = mcqs.select("choices", "shuffled", "gold_index").collect()
    assert rows and all(r.shuffled[r.gold_index] == r.choices[0] for r in rows)
    log, acc = WF.evaluate(mcqs, backend)
    a = acc.first()
    assert a.n_questions == log.count() and 0.0 <= a.accuracy_pct <= 100.0
    labels = WF.classify(mcqs, backend)
    assert labels.count() == log.count()
