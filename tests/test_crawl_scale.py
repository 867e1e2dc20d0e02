"""Links are joined to pages where the pages lie, and plain markup is parsed alike."""
import contextlib
import io
import random

from pyspark.sql import functions as F

from qbank.operators import dom
from qbank.plans import chapters as CH
from qbank.plans import crawl as CR

BASE = "https://books.example.org/books/econ-x/pages/"


def test_the_site_is_not_written(spark, monkeypatch):
    wrote = []
    monkeypatch.setattr(CR, "materialize", lambda df, name, **k: wrote.append(name) or df)
    CR.site(spark, "/root/testdata/sf0.001")
    assert wrote == []


def test_pages_of_is_the_plain_join(spark):
    rows = [(f"{BASE}{i}-key-terms", f"<p>{i}") for i in range(40)]
    rows += [(f"{BASE}{i}-summary", f"<b>{i}") for i in range(40)]
    rows += rows[:3] + [(BASE + "5-key-terms", "another"), (None, "x"), (BASE + "7-summary", None), ("u", "alone")]
    pages = spark.createDataFrame(rows, "url string, html string")
    links = [(f"{BASE}{i}-key-terms", "key_terms", "econ") for i in range(38)]  # two pages have no link
    links += [(f"{BASE}{i}-summary", "other" if i == 9 else "summary", "econ") for i in range(45)]
    links += [(BASE + "11-summary", "chapter", "finance"), (None, "summary", "econ")]
    links = spark.createDataFrame(links, "resolved_url string, route string, book string")
    plain = pages.withColumnRenamed("url", "resolved_url").join(links, "resolved_url")
    cols = ["resolved_url", "route", "book", "html"]
    got = CR.pages_of(pages, links, "resolved_url")
    key = lambda r: tuple(map(str, r))
    assert sorted(got.select(*cols).collect(), key=key) == sorted(plain.select(*cols).collect(), key=key)
    once = CR.pages_of(pages, links, "resolved_url", once=True).select(*cols)
    want = CR.one_copy(plain, pages, "resolved_url", "book", "route").select(*cols)
    assert sorted(once.collect(), key=key) == sorted(want.collect(), key=key)


def test_only_odd_pages_are_shuffled(spark):
    """Of the regular site no markup goes through the exchange by URL."""
    pages = CR.site(spark, "/root/testdata/sf0.001")
    links = CR.frontier(pages)
    got = CR.pages_of(pages, links, "resolved_url")
    docs = pages.where("page = 'chapter'").count()
    assert got.count() == 9 * docs
    odd = links.where("resolved_url LIKE '%/7-%'").withColumn("route", F.lit("odd"))
    mixed = links.where("resolved_url NOT LIKE '%/7-%'").unionByName(odd)
    assert CR.pages_of(pages, mixed, "resolved_url").where("route = 'odd'").count() == 9
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "LeftAnti" in buf.getvalue() and "CartesianProduct" not in buf.getvalue()


def explained(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_contents_pages_are_parsed_where_they_lie(spark):
    item = '<li><a class="toc-link" href="{0}">x</a></li>'
    rows = [("contents", f"{BASE}{i}-contents", "<ol>" + item.format(f"{i}-key-terms") * 2 + item.format("0-key-terms#t") + "</ol>")
            for i in range(9)] + [("content", BASE + "0-key-terms", "<ol>" + item.format("7-summary") + "</ol>"), ("contents", None, "")]
    links = CR.routed_links(spark.createDataFrame(rows, "page string, url string, html string"), "econ")
    assert sorted(r.resolved_url for r in links.collect()) == [f"{BASE}{i}-key-terms" for i in range(9)]
    assert "REPARTITION" not in explained(links)


def test_chapters_move_only_the_documents(spark):
    """One exchange, of the documents: rendered chapters are parsed where they are rendered."""
    for query in (CH.econ_chapter_sections, CH.econ_chapter_feed):
        plan = explained(query(spark, "/root/testdata/sf0.001"))
        moved = [line for line in plan.splitlines() if "Exchange" in line]
        assert moved and all("Exchange hashpartitioning(doc_id" in line for line in moved) and "Sort" not in plan


class Standard(dom._TreeBuilder):
    def plain(self, html):
        return False


def test_plain_markup_is_parsed_as_by_the_standard_parser():
    bits = ["<p>", "</p>", '<div id="a">', "</div>", '<DIV CLASS="x y">', "<br>", "<br/>", "<title>", "</title>",
            "<title>a &amp; b</title>", "<style>", "</style>", "<style>x&lt;</style>", "<style>y</style>", "&lt;x", "&",
            "&#1;", "text\n", "<li>", "<ol>", "</ol>", "<dt>", "<dd>", "<!-- c -->", "<", "</", "<![bad[ x>",
            "<p class=x>", "</p >", '</p x="1">', "<plaintext>", '<a href="u#f" href="v">', "</a>", "<td>", "<tr>"]
    r, plain = random.Random(3), 0
    for k in range(6000):
        html = "<!DOCTYPE html>" * (k % 2) + "".join(r.choice(bits) for _ in range(r.randint(0, 9)))
        b = Standard()
        b.parse(html)
        assert dom.parse_page(html) == (b.finish(), b.faults), html
        plain += dom._TreeBuilder().plain(html)
    assert plain > 100


def moved_bytes(df):
    """Bytes that each exchange moved when ``df`` was collected; what is cached is not looked into."""
    def below(p):
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            return below(p.executedPlan())
        if name.endswith("QueryStage"):
            return below(p.plan())
        found = [p.metrics().apply("dataSize").value()] if name == "Exchange" else []
        for i in range(p.children().size()):
            found += below(p.children().apply(i))
        return found
    return below(df._jdf.queryExecution().executedPlan())


def test_extracted_pages_are_not_moved(spark, tmp_path):
    """Rendered pages with one link each are parsed and extracted where they are rendered."""
    text = "\n".join(f"line {i} " + "x" * 2000 for i in range(30))
    docs = [(i, text, "en", f"s{i % 2}", len(text)) for i in range(8)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    for query, rows in ((CR.econ_key_concepts, 80), (CR.finance_key_terms, 120)):
        df = query(spark, str(tmp_path))
        assert len(df.collect()) == rows
        moved = moved_bytes(df)
        assert moved and sum(moved) < len(text), moved
