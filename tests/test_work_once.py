"""Pages are parsed once for all that reads them, and only those that are read."""
import pytest
from pyspark.sql import functions as F

from qbank.plans import chapters as CH
from qbank.plans import crawl as CR

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["econ_key_terms_rows", "econ_key_concepts_rows", "finance_problems_rows"])
def test_node_rows_are_parsed_once(spark, name):
    plan = getattr(CR, name)(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan  # the joins read what was parsed


def test_only_problem_pages_are_parsed(spark, monkeypatch):
    parsed = []
    monkeypatch.setattr(CH, "dom_nodes", lambda p, **k: parsed.append(p) or CR.dom_nodes(p, **k))
    CH.econ_problem_texts(spark, SF)
    assert parsed[0].count() == parsed[0].where(F.col("url").endswith("-self-check-questions")).count() > 0


def test_a_projected_feed_is_written_once(spark, monkeypatch):
    from qbank import session
    from qbank.plans import exports, feed  # noqa: F401  imported before the patch

    def no_copy(*a, **k):
        raise AssertionError("written twice")
    with monkeypatch.context() as m:
        m.setattr(session, "materialize", no_copy)
        df = exports.feed_roundtrip(spark, SF)
    assert df.count() > 0


def test_odd_urls_are_looked_for_once(spark):
    pages = CR.site(spark, SF)
    links = CR.frontier(pages, ["finance"], ["chapter"])
    plan = CR.pages_of(pages, links, "resolved_url", once=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation [_bucket" in plan  # what the counts of pages and links by URL tell


def test_terms_are_crawled_once(spark):
    from qbank.plans import variants
    plan = variants.term_distractors(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan


def test_nodes_by_column_are_the_nodes():
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    from qbank.operators import dom
    pages = ["<p id=a class='x y'>1<b>2</b>3<img src=u alt>", None, "", "text", "<![bad[ x><div><ul><li>é<li>", "<br/>"]
    nodes = [dom.parse_html(p) for p in pages]
    for some in (nodes, nodes[1:2], nodes[2:3], [], nodes[::-1]):
        got = dom.node_arrays(some)
        assert got.to_pylist() == some
        assert got.type.equals(pa.array(some, to_arrow_type(dom.NODES)).type)


PAGES = ["<div id=main-content class='x y'>1<b>2</b><p>3</div><div id=a>4", None, "", "text", "<![bad[ x><div id=b id=main-content><div>é", "<br/>"]


def test_asked_fields_are_the_nodes_own(spark):
    """Other fields are null, other nodes left out; pages are parsed whole."""
    from qbank.operators import dom
    from qbank.operators import extract as X
    df = spark.createDataFrame(list(enumerate(PAGES)), "n int, html string")
    whole = {r.n: r for r in dom.dom_nodes(df, status=True).collect()}
    for reads in (X.TOC_LINKS_READ, X.MAIN_TEXT_READ, X.SELF_CHECK_READ, X.WITH_ID_READ, {"fields": ()}):
        fields, only = reads["fields"], reads.get("only", lambda n: bool(reads["fields"]))
        for r in dom.dom_nodes(df, status=True, **reads).collect():
            nodes = whole[r.n].nodes
            want = None if nodes is None else [
                {k: v if k in fields else None for k, v in n.asDict(True).items()} for n in nodes if only(n)]
            assert want == (None if r.nodes is None else [n.asDict(True) for n in r.nodes]), (fields, r.n)
            assert (r.n_faults, r.parse_status) == (whole[r.n].n_faults, whole[r.n].parse_status)
    for reads, expr in ((X.MAIN_TEXT_READ, X.main_text("nodes")), (X.WITH_ID_READ, X.elements_with_id("nodes"))):
        assert dom.dom_nodes(df, **reads).select("n", expr).collect() == dom.dom_nodes(df).select("n", expr).collect()


@pytest.mark.parametrize("name, parses", [("crawl_quarantine", 3), ("main_texts", 3), ("crawl_section_counts", 5), ("seeded_section_counts", 5)])
def test_only_nodes_that_are_read_leave_python(spark, monkeypatch, name, parses):
    from qbank.operators import dom
    from qbank.plans import registry
    asked = []
    monkeypatch.setattr(CR, "dom_nodes", lambda p, **k: asked.append(k.get("fields")) or dom.dom_nodes(p, **k))
    registry.QUERIES[name](spark, SF)
    assert len(asked) == parses and None not in asked
