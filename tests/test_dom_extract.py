from pyspark.sql import functions as F

from qbank.operators import extract as X
from qbank.operators.dom import dom_nodes, parse_html


def els(nodes, tag):
    return [n for n in nodes if n["kind"] == "element" and n["tag"] == tag]


def test_parser_implied_ends_and_text():
    n = parse_html('<div><p>a<b>b<p>c</div><ul><li>x<li>y</ul><dl><dt>t<dd>d1<br>d2</dl>'
                   '<script>var s="</p>";</script><p>&amp;&lt;</p>')
    ps = els(n, "p")
    assert [p["text"] for p in ps] == ["ab", "c", "&<"]
    assert [li["text"] for li in els(n, "li")] == ["x", "y"]
    assert els(n, "dd")[0]["texts"] == ["d1", "d2"]
    assert els(n, "dt")[0]["text"] == "t"
    assert els(n, "script")[0]["text"] == 'var s="</p>";'
    div = els(n, "div")[0]
    assert div["text"] == "abc" and div["n_texts"] == 3
    inside = [m for m in n if div["ord"] < m["ord"] <= div["end"]]
    assert [m["tag"] for m in inside if m["kind"] == "element"] == ["p", "b", "p"]


def page(spark, html):
    return dom_nodes(spark.createDataFrame([(1, html)], ["page_id", "html"]))


def test_key_terms_econ_vs_finance(spark):
    html = ('<div id="main-content"><dl><dt>T1</dt><dd>D1<b>x</b>D1b</dd></dl>'
            '<dl><dt></dt><dd>D2</dd></dl><dl><dt> </dt><dd>D3</dd></dl>'
            '<dl><dt> T4 </dt><dd> D4 </dd></dl></div>')
    r = page(spark, html).select(X.key_terms_by_dl("nodes").alias("e"),
                                 X.key_terms_zipped("nodes").alias("f")).first()
    # empty dt dropped, blank dt kept (non-empty before strip), first dd text only
    assert [(p.term, p.definition) for p in r.e] == [("T1", "D1"), ("", "D3"), ("T4", "D4")]
    # Zip of all dt texts with all dd texts drifts after a dd with two text nodes
    assert [(p.term, p.definition) for p in r.f] == [("T1", "D1"), ("", "D1b"), ("T4", "D2")]


def test_self_check_problems_and_concepts(spark):
    html = ('<div id="main-content"><div data-type="problem"><p>Q1</p>'
            '<a href="ans#a1" data-page-fragment="a1">S</a></div>'
            '<div data-type="problem"><p>Q2 no link</p></div>'
            '<section class="summary"><h2><span class="os-text">C</span></h2><p>p1</p><p>p2</p></section>'
            '</div>')
    r = page(spark, html).select(X.self_check_problems("nodes").alias("p"),
                                 X.key_concepts("nodes").alias("c")).first()
    assert [(p.question, p.answer_link, p.fragment) for p in r.p] == [("Q1S", "ans#a1", "a1")]
    assert [(c.concept, c.definition) for c in r.c] == [("C", "p1 p2")]


def test_finance_blocks(spark):
    html = ('<div id="main-content">'
            '<div class="os-problem-container"><div data-type="question-stem">Q</div><ol>'
            '<li data-type="question-answer"><div data-type="answer-content"> a </div></li>'
            '<li data-type="question-answer"><div data-type="answer-content">b</div></li></ol></div>'
            '<div class="os-problem-container"><div data-type="question-stem">NoChoices</div></div>'
            '<div data-type="exercise-question"><span class="os-number">7</span>'
            '<div data-type="question-stem">P</div></div>'
            '<section class="section-summary"><h2>H</h2><p>A1</p><p>A2</p></section></div>'
            '<div class="chapter-content-module"><h2>T</h2><p></p><p> </p><div><b>x</b>y</div></div>')
    r = page(spark, html).select(X.multiple_choice("nodes").alias("mc"),
                                 X.review_questions_fin("nodes").alias("rq"),
                                 X.problems_fin("nodes").alias("pr"),
                                 X.summary_qa("nodes").alias("sq"),
                                 X.chapter_structured("nodes").alias("ch")).first()
    assert [(q.question, q.choices) for q in r.mc] == [("Q", ["a", "b"])]
    assert [q.question for q in r.rq] == ["Q", "NoChoices"]
    assert [(q.question_number, q.question) for q in r.pr] == [("7", "P")]
    assert [(q.question, q.answer) for q in r.sq] == [("H", "A1")]
    # an empty child is skipped, a blank one is kept
    assert r.ch == "<h2> T </h2>\n<p>  </p>\n<div> xy </div>"


def test_chapter_sections_and_boxes(spark):
    html = ('<div class="chapter-content-module"><h2 data-type="title">Ti</h2><p>intro</p>'
            '<section><h2 data-type="title">S1</h2><p>body</p><div class="clearup">box</div></section>'
            '<section><p>plain</p></section><div class="linkup">lk</div></div>')
    r = page(spark, html).select(X.section_blocks("nodes").alias("s"),
                                 X.special_boxes("nodes").alias("b"),
                                 X.chapter_intro_econ("nodes").alias("c")).first()
    assert [(s.section_name, s.section_text) for s in r.s] == [("S1", "S1body"),
                                                                ("learning obj", "plain")]
    assert [(b.section_name, b.section_text) for b in r.b] == [("linkup", "lk")]
    # Newline inserted after len('Ti') = 2 text nodes; sections and boxes removed
    assert r.c.section_name == "Ti" and r.c.section_text == "Tiintro\n"


def test_toc_links_need_ol_ancestor(spark):
    html = ('<p><a class="toc" href="no">x</a></p><ol><li><a class="toc" href="a">1</a></li>'
            '<li><a class="other" href="b">2</a></li><ol><li><a class="toc" href="c">3</a></li></ol></ol>')
    assert page(spark, html).select(X.toc_links("nodes", "toc")).first()[0] == ["a", "c"]


def test_exploded_node_rows_match_array_form(spark):
    from qbank.operators import extract_rows as XR
    from qbank.operators.dom import dom_node_rows
    html = ('<div id="main-content"><dl><dt>T1</dt><dd>D1<b>x</b>D1b</dd></dl>'
            '<dl><dt></dt><dd>D2</dd></dl><dl><dt> </dt><dd>D3</dd></dl>'
            '<dl><dt> T4 </dt><dd> D4 </dd></dl></div><dl><dt>out</dt><dd>side</dd></dl>')
    df = spark.createDataFrame([(1, html), (2, html.replace("T1", "U1"))], ["page_id", "html"])
    arr = {(r.page_id, i): (p.term, p.definition) for r in
           dom_nodes(df).select("page_id", X.key_terms_by_dl("nodes").alias("k")).collect()
           for i, p in enumerate(r.k)}
    rows = dom_node_rows(df)
    got = {(r.page_id, r.pos): (r.term, r.definition)
           for r in XR.key_terms_by_dl(rows, ["page_id"]).collect()}
    assert got == arr and len(got) == 6
    mt = {r.page_id: r.main_text for r in XR.main_text(rows, ["page_id"]).collect()}
    assert mt[1] == dom_nodes(df).where("page_id = 1").select(X.main_text("nodes")).first()[0]
