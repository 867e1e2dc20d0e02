"""Extractors over the X0 node array (X1-X19, F4-F6, J6). All are narrow
column expressions (higher-order functions), no shuffle.

Selector meanings kept from the crawl callbacks: a bare ``::text`` is every
descendant text node (``node.text``); ``tag::text`` is only the direct text
children of ``tag`` (``node.texts``); ``.get()`` is the first in document
order or NULL; ``.getall()`` is all of them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qbank.functions.text import py_strip, remove_all
from qbank.functions.util import as_col

# Boxes removed from chapter/section text, in this order.
SPECIAL_SECTIONS = ["bringhome", "clearup", "linkup"]
IMAGE_SECTIONS = ["os-figure"]


# -- node predicates and navigation ------------------------------------------------

def is_el(n, tag: str | None = None) -> Column:
    c = n["kind"] == "element"
    return c & (n["tag"] == tag) if tag else c


def has_class(n, cls: str) -> Column:
    return F.array_contains(n["classes"], cls)


def attr(n, name: str) -> Column:
    """Attribute value or NULL."""
    return F.get(F.transform(F.filter(n["attrs"], lambda a: a["k"] == name),
                             lambda a: a["v"]), 0)


def attr_is(n, name: str, value: str) -> Column:
    return F.exists(n["attrs"], lambda a: (a["k"] == name) & (a["v"] == value))


def inside(n, e) -> Column:
    """``n`` is a descendant of element ``e``."""
    return (n["ord"] > e["ord"]) & (n["ord"] <= e["end"])


def select(nodes, pred) -> Column:
    return F.filter(as_col(nodes), lambda n: pred(n))


def subtree(nodes, e) -> Column:
    """The descendants of element ``e``: ``ord`` is a node's place in the array, so
    they are a slice of it, and scanning every container costs its own size only."""
    return F.slice(as_col(nodes), e["ord"] + 2, e["end"] - e["ord"])


def within(nodes, e, pred) -> Column:
    return F.filter(subtree(nodes, e), pred)


def within_any(nodes, container_pred, pred, scope=None) -> Column:
    """Nodes matching ``pred`` that lie inside some element matching
    ``container_pred`` (optionally only containers inside ``scope``), in
    document order, each once. The outermost containers are disjoint slices of
    the nodes, so each node is looked at once."""
    nodes = as_col(nodes)
    cs = F.filter(nodes if scope is None else subtree(nodes, scope), container_pred)
    outer = F.filter(cs, lambda c: ~F.exists(cs, lambda d: inside(c, d)))
    return F.flatten(F.transform(outer, lambda c: within(nodes, c, pred)))


def first(arr) -> Column:
    return F.get(arr, 0)


def direct_texts(elems) -> Column:
    """``tag::text`` over a list of elements: their direct text nodes, in order."""
    return F.flatten(F.transform(elems, lambda e: e["texts"]))


def all_text(elems) -> Column:
    """``::text`` joined over a list of elements."""
    return F.array_join(F.transform(elems, lambda e: e["text"]), "")


def _div_of_class(c: str):
    return lambda n: is_el(n, "div") & has_class(n, c)


def truthy(c) -> Column:
    """Python truthiness of an optional string."""
    return c.isNotNull() & (c != "")


# -- what extractors read of the nodes (for ``dom_nodes``) ---------------------------------

def main_div(n: dict) -> bool:
    return n["tag"] == "div" and any(a["k"] == "id" and a["v"] == "main-content" for a in n["attrs"])


def div_with_id(n: dict) -> bool:
    return n["tag"] == "div" and n["elem_id"] is not None


TOC_LINKS_READ = {"fields": ("ord", "end", "kind", "tag", "classes", "attrs")}
MAIN_TEXT_READ = {"fields": ("kind", "tag", "attrs", "text"), "only": main_div}
SELF_CHECK_READ = {"fields": ("ord", "end", "kind", "tag", "attrs", "text")}
WITH_ID_READ = {"fields": ("ord", "kind", "tag", "elem_id", "text"), "only": div_with_id}


# -- X1 / X2 / X3 / X8 / X9 ----------------------------------------------------------

def toc_links(nodes, link_class: str) -> Column:
    """``ol a.<class>::attr(href)`` in document order."""
    anchors = within_any(nodes, lambda o: is_el(o, "ol"),
                         lambda n: is_el(n, "a") & has_class(n, link_class))
    return F.filter(F.transform(anchors, lambda a: attr(a, "href")), lambda h: h.isNotNull())


def main_content(nodes) -> Column:
    return select(nodes, lambda n: is_el(n, "div") & attr_is(n, "id", "main-content"))


def main_text(nodes) -> Column:
    """All text of ``div#main-content``."""
    return all_text(main_content(nodes))


def class_text(nodes, tag: str, cls: str) -> Column:
    """All text of ``tag.cls`` (e.g. ``div.introduction``)."""
    return all_text(select(nodes, lambda n: is_el(n, tag) & has_class(n, cls)))


def problems_text(nodes) -> Column:
    """All text of every ``div[data-type=problem]``."""
    return all_text(select(nodes, lambda n: is_el(n, "div") & attr_is(n, "data-type", "problem")))


# -- econ pages ------------------------------------------------------------------------

def _under_main(nodes, pred):
    return within_any(nodes, lambda a: is_el(a, "div") & attr_is(a, "id", "main-content"), pred)


def key_terms_by_dl(nodes) -> Column:
    """X4 (+F5): per ``dl``: first direct text of a ``dt`` and of a ``dd``; the
    pair is kept when both are non-empty before stripping."""
    dls = _under_main(nodes, lambda n: is_el(n, "dl"))
    pairs = F.transform(dls, lambda dl: F.struct(
        first(direct_texts(within(nodes, dl, lambda n: is_el(n, "dt")))).alias("term"),
        first(direct_texts(within(nodes, dl, lambda n: is_el(n, "dd")))).alias("definition")))
    kept = F.filter(pairs, lambda p: truthy(p["term"]) & truthy(p["definition"]))
    return F.transform(kept, lambda p: F.struct(py_strip(p["term"]).alias("term"),
                                                py_strip(p["definition"]).alias("definition")))


def key_concepts(nodes) -> Column:
    """Per ``section.summary``: concept = first direct text of an
    ``.os-text`` under an ``h2``; definition = direct texts of its ``p``s
    joined by a space."""
    secs = _under_main(nodes, lambda n: is_el(n, "section") & has_class(n, "summary"))
    pairs = F.transform(secs, lambda s: F.struct(
        first(direct_texts(within_any(nodes, lambda h: is_el(h, "h2"),
                                      lambda n: has_class(n, "os-text") & is_el(n), scope=s))
              ).alias("concept"),
        F.array_join(direct_texts(within(nodes, s, lambda n: is_el(n, "p"))), " ")
        .alias("definition")))
    kept = F.filter(pairs, lambda p: truthy(p["concept"]) & truthy(p["definition"]))
    return F.transform(kept, lambda p: F.struct(py_strip(p["concept"]).alias("concept"),
                                                py_strip(p["definition"]).alias("definition")))


def self_check_problems(nodes) -> Column:
    """X6 (+F4): per ``div[data-type=problem]``: all text, first ``href`` and
    first ``data-page-fragment`` (self or descendants); problems without a
    link are dropped."""
    probs = select(nodes, lambda n: is_el(n, "div") & attr_is(n, "data-type", "problem"))

    def first_attr(p, name):
        return first(F.transform(
            F.filter(F.slice(as_col(nodes), p["ord"] + 1, p["end"] - p["ord"] + 1),
                     lambda n: is_el(n) & F.exists(n["attrs"], lambda a: a["k"] == name)),
            lambda n: attr(n, name)))
    out = F.transform(probs, lambda p: F.struct(
        p["text"].alias("question"), first_attr(p, "href").alias("answer_link"),
        first_attr(p, "data-page-fragment").alias("fragment")))
    return F.filter(out, lambda q: truthy(q["answer_link"]))


def section_blocks(nodes, default_name: str = "learning obj") -> Column:
    """X12 (+X11): per ``section`` directly under a chapter module: name = first
    direct text of a ``h2[data-type=title]`` inside it (else the default),
    text = its text minus the text of its special boxes (any depth)."""
    mods = select(nodes, lambda n: is_el(n, "div") & has_class(n, "chapter-content-module"))
    secs = F.filter(as_col(nodes), lambda n: is_el(n, "section") & F.exists(
        mods, lambda m: n["parent"] == m["ord"]))
    def boxes(s):  # (class, text) records, class list order then document order
        def of_class(c):
            return F.transform(within(nodes, s, _div_of_class(c)), lambda b: F.struct(
                F.lit(c).alias("section_name"), b["text"].alias("section_text")))
        return F.flatten(F.array(*[of_class(c) for c in SPECIAL_SECTIONS + IMAGE_SECTIONS]))
    return F.transform(secs, lambda s: F.struct(
        F.coalesce(first(direct_texts(within(nodes, s, lambda n: is_el(n, "h2")
                                             & attr_is(n, "data-type", "title")))),
                   F.lit(default_name)).alias("section_name"),
        remove_all(s["text"], F.transform(boxes(s), lambda b: b["section_text"]))
        .alias("section_text"),
        boxes(s).alias("boxes")))


def chapter_records_econ(nodes) -> Column:
    """The economics chapter callback's records in the order it yields them:
    chapter-level boxes, the chapter's own record (X10), then for each
    section its boxes followed by the section record (X11, X12)."""
    intro = chapter_intro_econ(nodes)
    per_section = F.flatten(F.transform(section_blocks(nodes), lambda s: F.concat(
        s["boxes"], F.array(F.struct(s["section_name"].alias("section_name"),
                                     s["section_text"].alias("section_text"))))))
    return F.concat(special_boxes(nodes),
                    F.array(F.struct(intro["section_name"].alias("section_name"),
                                     intro["section_text"].alias("section_text"))),
                    per_section)


def special_boxes(nodes) -> Column:
    """X11 at chapter level: boxes that are direct children of a module, in
    list order of the box class, then document order: (class, text)."""
    mods = select(nodes, lambda n: is_el(n, "div") & has_class(n, "chapter-content-module"))
    def of_class(c):
        is_box = _div_of_class(c)
        return F.transform(
            F.filter(as_col(nodes), lambda n: is_box(n) & F.exists(
                mods, lambda m: n["parent"] == m["ord"])),
            lambda b: F.struct(F.lit(c).alias("section_name"), b["text"].alias("section_text")))
    return F.flatten(F.array(*[of_class(c) for c in SPECIAL_SECTIONS + IMAGE_SECTIONS]))


def chapter_intro_econ(nodes) -> Column:
    """The module's text nodes, with a newline inserted after the first
    ``len(title)`` text nodes when a title exists (T9: a list index equal to
    the title's character length), minus the text of its direct sections and
    of its direct special boxes."""
    mods = select(nodes, lambda n: is_el(n, "div") & has_class(n, "chapter-content-module"))
    texts = F.transform(F.filter(as_col(nodes), lambda n: (n["kind"] == "text") & F.exists(
        mods, lambda m: inside(n, m))), lambda n: n["text"])
    title = first(direct_texts(F.filter(as_col(nodes), lambda n: is_el(n, "h2") & attr_is(
        n, "data-type", "title") & F.exists(mods, lambda m: inside(n, m)))))
    k = F.length(title)
    with_nl = F.when(truthy(title), F.concat(
        F.slice(texts, 1, k), F.array(F.lit("\n")),
        F.when(F.size(texts) > k, F.slice(texts, k + 1, F.size(texts))).otherwise(
            F.array().cast("array<string>")))).otherwise(texts)
    direct_secs = F.transform(F.filter(as_col(nodes), lambda n: is_el(n, "section") & F.exists(
        mods, lambda m: n["parent"] == m["ord"])), lambda s: s["text"])
    boxes = F.transform(special_boxes(nodes), lambda b: b["section_text"])
    return F.struct(title.alias("section_name"),
                    remove_all(remove_all(F.array_join(with_nl, ""), direct_secs), boxes)
                    .alias("section_text"))


# -- finance pages ---------------------------------------------------------------------

def key_terms_zipped(nodes) -> Column:
    """X13 (+J6): all ``dl dt::text`` zipped with all ``dl dd::text``,
    truncated to the shorter list; stripped; no emptiness filter (T11)."""
    mains = main_content(nodes)

    def texts_of(tag):
        return direct_texts(F.flatten(F.transform(mains, lambda m: within_any(
            nodes, lambda a: is_el(a, "dl"), lambda n: is_el(n, tag), scope=m))))
    terms, defs = texts_of("dt"), texts_of("dd")
    z = F.slice(F.arrays_zip(terms.alias("t"), defs.alias("d")), 1,
                F.least(F.size(terms), F.size(defs)))
    return F.transform(z, lambda p: F.struct(py_strip(p["t"]).alias("term"),
                                             py_strip(p["d"]).alias("definition")))


def _stem(nodes, c):
    return first(direct_texts(within(nodes, c, lambda n: is_el(n, "div")
                                     & attr_is(n, "data-type", "question-stem"))))


def summary_qa(nodes) -> Column:
    """Per ``section.section-summary``: first ``h2::text`` and first ``p::text``."""
    secs = _under_main(nodes, lambda n: is_el(n, "section") & has_class(n, "section-summary"))
    pairs = F.transform(secs, lambda s: F.struct(
        first(direct_texts(within(nodes, s, lambda n: is_el(n, "h2")))).alias("question"),
        first(direct_texts(within(nodes, s, lambda n: is_el(n, "p")))).alias("answer")))
    kept = F.filter(pairs, lambda p: truthy(p["question"]) & truthy(p["answer"]))
    return F.transform(kept, lambda p: F.struct(py_strip(p["question"]).alias("question"),
                                                py_strip(p["answer"]).alias("answer")))


def multiple_choice(nodes) -> Column:
    """Per ``div.os-problem-container``: stem + direct texts of the answer
    contents of its answer items; kept when both exist."""
    cons = _under_main(nodes, lambda n: is_el(n, "div") & has_class(n, "os-problem-container"))
    out = F.transform(cons, lambda c: F.struct(
        _stem(nodes, c).alias("question"),
        direct_texts(within_any(nodes, lambda li: is_el(li, "li")
                                & attr_is(li, "data-type", "question-answer"),
                                lambda n: is_el(n, "div") & attr_is(n, "data-type", "answer-content"),
                                scope=c))
        .alias("choices")))
    kept = F.filter(out, lambda q: truthy(q["question"]) & (F.size(q["choices"]) > 0))
    return F.transform(kept, lambda q: F.struct(
        py_strip(q["question"]).alias("question"),
        F.transform(q["choices"], lambda x: py_strip(x)).alias("choices")))


def review_questions_fin(nodes) -> Column:
    """Stems of problem containers (number NULL)."""
    cons = _under_main(nodes, lambda n: is_el(n, "div") & has_class(n, "os-problem-container"))
    stems = F.filter(F.transform(cons, lambda c: _stem(nodes, c)), lambda s: truthy(s))
    return F.transform(stems, lambda s: F.struct(F.lit(None).cast("string").alias("question_number"),
                                                 py_strip(s).alias("question")))


def problems_fin(nodes) -> Column:
    """Per ``div[data-type=exercise-question]``: number + stem, both required."""
    cons = _under_main(nodes, lambda n: is_el(n, "div") & attr_is(n, "data-type", "exercise-question"))
    out = F.transform(cons, lambda c: F.struct(
        first(direct_texts(within(nodes, c, lambda n: is_el(n, "span") & has_class(n, "os-number"))))
        .alias("question_number"), _stem(nodes, c).alias("question")))
    kept = F.filter(out, lambda q: truthy(q["question"]) & truthy(q["question_number"]))
    return F.transform(kept, lambda q: F.struct(py_strip(q["question_number"]).alias("question_number"),
                                                py_strip(q["question"]).alias("question")))


def chapter_structured(nodes) -> Column:
    """X18 (+F6): each direct child element of a chapter module with at least
    one text node, as ``<tag> text </tag>``, joined by newlines."""
    mods = select(nodes, lambda n: is_el(n, "div") & has_class(n, "chapter-content-module"))
    kids = F.filter(as_col(nodes), lambda n: is_el(n) & F.exists(
        mods, lambda m: n["parent"] == m["ord"]) & (n["n_texts"] > 0))
    return F.array_join(F.transform(kids, lambda e: F.concat(
        F.lit("<"), e["tag"], F.lit("> "), py_strip(e["text"]), F.lit(" </"), e["tag"], F.lit(">"))),
        "\n")


def elements_with_id(nodes, tag: str = "div") -> Column:
    """Elements carrying an id, for the answer-fragment lookup."""
    return F.transform(select(nodes, lambda n: is_el(n, tag) & n["elem_id"].isNotNull()),
                       lambda n: F.struct(n["ord"].alias("ord"), n["elem_id"].alias("elem_id"),
                                          n["text"].alias("text")))
