"""A textbook web site rendered by Spark from ``documents`` (round-trip fixture).

Every document becomes a small book section in both books: contents pages
whose ``ol`` links lead to its content pages, one content page in each of the
eight layouts the crawl callbacks understand, a chapter page and an answers
page; every text slot holds one line of the document, HTML-escaped. The SQL oracles state the
expected extraction straight from the document lines, so extraction is
checked without an HTML parser on the SQL side.

One document -> a bounded handful of pages: no page collects an unbounded
group of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qbank.functions import text as TX

BOOK_HOST = "https://books.example.org/books/"
# The eight content-page layouts -> (book kind, link slug).
LAYOUTS = [
    ("econ", "self-check-questions"),
    ("econ", "key-terms"),
    ("econ", "key-concepts-and-summary"),
    ("finance", "key-terms"),
    ("finance", "summary"),
    ("finance", "multiple-choice"),
    ("finance", "review-questions"),
    ("finance", "problems"),
]
TOC_CLASS = "toc-link"


def esc(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"),
                               F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _lit_list(items):
    return F.array(*[F.lit(x) for x in items])


def _blocks(n_blocks: Column, render) -> Column:
    """Concatenate ``render(g, lines)`` for block g = 0..n_blocks-1."""
    return F.array_join(F.transform(F.sequence(F.lit(0), n_blocks - 1),
                                    lambda g: render(g)), "")


def _line(i: Column) -> Column:
    """Escaped 1-based line i of the document (empty past its last line)."""
    return esc(F.coalesce(F.get(F.col("lines"), i.cast("int") - 1), F.lit("")))


def _page(body: Column) -> Column:
    return F.concat(F.lit("<!DOCTYPE html><html><head><title>"), _line(F.lit(1)),
                    F.lit("</title><style>p{margin:0}</style></head><body>"), body,
                    F.lit("</body></html>"))


def _main(body: Column) -> Column:
    return F.concat(F.lit('<div id="main-content">'), body, F.lit("</div>"))


def _when_blocks(n: Column, k: int, render) -> Column:
    """All lines in blocks of k; a short last block leaves its other slots empty."""
    nb = F.ceil(n / k).cast("int")
    return F.when(nb > 0, _blocks(nb, render)).otherwise(F.lit(""))


def _self_check_body(doc: Column, n: Column) -> Column:
    nprob = F.ceil(n / 2).cast("int")

    def problem(g):
        i = g + 1
        istr = i.cast("string")
        link = (F.when(2 * i > n, F.lit(""))
                .when(i % 4 == 0, F.concat(F.lit('<a href="'), doc, F.lit('-answers">Show</a>')))
                .when(i % 5 == 0, F.concat(F.lit('<a href="'), doc, F.lit("-answers#missing-"),
                                           istr, F.lit('" data-page-fragment="missing-'), istr,
                                           F.lit('">Show</a>')))
                .otherwise(F.concat(F.lit('<a href="'), doc, F.lit("-answers#answer-"), istr,
                                    F.lit('" data-page-fragment="answer-'), istr,
                                    F.lit('">Show</a>'))))
        return F.concat(F.lit('<div data-type="problem" id="problem-'), istr, F.lit('"><p>'),
                        _line(2 * i - 1), F.lit("</p>"), link, F.lit("</div>"))
    return _main(_blocks(nprob, problem))


def _answers_body(n: Column) -> Column:
    def answer(g):
        i = g + 1
        return F.concat(F.lit('<div id="answer-'), i.cast("string"), F.lit('"><p>'),
                        _line(2 * i), F.lit("</p></div>"))
    return _main(_when_blocks(n, 2, answer))


def _econ_terms_body(n: Column) -> Column:
    return _main(F.concat(F.lit("<h1>Key Terms</h1>"), _when_blocks(n, 2, lambda g: F.concat(
        F.lit("<dl><dt>"), _line(2 * g + 1), F.lit("</dt><dd>"), _line(2 * g + 2),
        F.lit("</dd></dl>")))))


def _concepts_body(n: Column) -> Column:
    return _main(_when_blocks(n, 3, lambda g: F.concat(
        F.lit('<section class="summary"><h2><span class="os-number">'), (g + 1).cast("string"),
        F.lit('</span> <span class="os-text">'), _line(3 * g + 1), F.lit("</span></h2><p>"),
        _line(3 * g + 2), F.lit("</p><p>"), _line(3 * g + 3), F.lit("</p></section>"))))


def _finance_terms_body(n: Column) -> Column:
    def pair(g):
        p = g + 1
        dd = F.when(p % 5 == 0, F.concat(_line(2 * g + 2), F.lit("<br>"), _line(2 * g + 2))) \
            .otherwise(_line(2 * g + 2))
        return F.concat(F.lit("<dt>"), _line(2 * g + 1), F.lit("</dt><dd>"), dd, F.lit("</dd>"))
    return _main(F.concat(F.lit("<dl>"), _when_blocks(n, 2, pair), F.lit("</dl>")))


def _summary_body(n: Column) -> Column:
    return _main(_when_blocks(n, 2, lambda g: F.concat(
        F.lit('<section class="section-summary"><h2>'), _line(2 * g + 1), F.lit("</h2><p>"),
        _line(2 * g + 2), F.lit("</p></section>"))))


def _mc_body(n: Column) -> Column:
    def q(g):
        choices = F.array_join(F.transform(F.sequence(F.lit(2), F.lit(5)), lambda j: F.concat(
            F.lit('<li data-type="question-answer"><div data-type="answer-content">'),
            _line(5 * g + j), F.lit("</div></li>"))), "")
        return F.concat(F.lit('<div class="os-problem-container"><div data-type="question-stem">'),
                        _line(5 * g + 1), F.lit("</div><ol>"), choices, F.lit("</ol></div>"))
    return _main(_when_blocks(n, 5, q))


def _review_body(n: Column) -> Column:
    return _main(_when_blocks(n, 1, lambda g: F.concat(
        F.lit('<div class="os-problem-container"><div data-type="question-stem">'),
        _line(g + 1), F.lit("</div></div>"))))


def _problems_body(n: Column) -> Column:
    return _main(_when_blocks(n, 1, lambda g: F.concat(
        F.lit('<div data-type="exercise-question"><span class="os-number">'),
        (g + 1).cast("string"), F.lit('</span><div data-type="question-stem">'), _line(g + 1),
        F.lit("</div></div>"))))


def _chapter_body(n: Column) -> Column:
    def child(g):
        i = g + 2
        return (F.when(i % 3 == 0, F.concat(F.lit("<p>"), _line(i), F.lit("</p>")))
                .when(i % 3 == 1, F.concat(F.lit('<section><h2 data-type="title">'), _line(i),
                                           F.lit("</h2></section>")))
                .otherwise(F.concat(F.lit('<div class="os-figure"><span>'), _line(i),
                                    F.lit("</span></div>"))))
    rest = F.when(n >= 2, F.array_join(F.transform(F.sequence(F.lit(0), n - 2), child), "")) \
        .otherwise(F.lit(""))
    return F.concat(F.lit('<div class="chapter-content-module"><h2 data-type="title">'),
                    _line(F.lit(1)), F.lit("</h2>"), rest, F.lit("<p></p></div>"))


def _toc_body(doc: Column, slugs: list[str]) -> Column:
    a = lambda href, cls="toc-link": F.concat(
        F.lit(f'<li><a class="{cls}" href="'), href, F.lit('">'), href, F.lit("</a></li>"))
    return F.concat(
        F.lit('<p><a class="toc-link" href="'), doc, F.lit('-preface">Preface</a></p><nav><ol>'),
        *[a(F.concat(doc, F.lit("-" + slug))) for slug in slugs],
        a(F.concat(doc, F.lit(f"-{slugs[0]}#top"))),
        a(F.concat(doc, F.lit("-chapter-intro"))),
        a(F.concat(doc, F.lit("-missing-page"))),
        a(F.concat(doc, F.lit("-glossary")), "nav-other"),
        F.lit("</ol></nav>"))


def site_pages(documents: DataFrame) -> DataFrame:
    """All pages of the rendered site: ``doc_id, kind, page, url, html``.

    Every document appears in every layout: per document an economics and a
    finance contents page, eight content pages (one per layout), a chapter
    page (finance book) and an answers page (economics book)."""
    d = documents.select("doc_id", "source", TX.lines("text").alias("lines"))
    n, doc, number = F.size("lines"), F.col("doc_id").cast("string"), F.col("_number")
    econ_slugs = [s for b, s in LAYOUTS if b == "econ"]
    fin_slugs = [s for b, s in LAYOUTS if b == "finance"]
    bodies = [_self_check_body(doc, n), _econ_terms_body(n), _concepts_body(n), _finance_terms_body(n),
              _summary_body(n), _mc_body(n), _review_body(n), _problems_body(n)]
    # (page, book, slug, body) of the pages of a document
    kinds = [*[("content", book, slug, body) for (book, slug), body in zip(LAYOUTS, bodies)],
             ("chapter", "finance", "chapter-intro", _chapter_body(n)),
             ("answers", "econ", "answers", _answers_body(n))]

    def of_kind(values):
        values = list(values)
        if len(values) == 1:
            return F.lit(values[0])
        out = F.when(number == 0, values[0])
        for i, v in enumerate(values[1:], 1):
            out = out.when(number == i, v)
        return out

    def pages(rows, kind, kinds):
        return rows.select(
            "doc_id", kind.cast("int").alias("kind"), of_kind(k[0] for k in kinds).alias("page"),
            F.concat(F.lit(BOOK_HOST), of_kind(k[1] for k in kinds), F.lit("-"), F.col("source"), F.lit("/pages/"),
                     doc, F.lit("-"), of_kind(k[2] for k in kinds)).alias("url"),
            _page(of_kind(k[3] for k in kinds)).alias("html"))
    # a filter on ``page``, ``kind`` or ``url`` stands below the rendering, so pages that a
    # job doesn't need are numbered, not rendered; seeds are read without the others
    rows = d.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(kinds) - 1))).alias("_number"))
    return (pages(d, F.lit(None), [("contents", "econ", "contents", _toc_body(doc, econ_slugs))])
            .unionByName(pages(d, F.lit(None), [("contents", "finance", "contents", _toc_body(doc, fin_slugs))]))
            .unionByName(pages(rows, F.when(number < len(LAYOUTS), number), kinds)))
