"""Page markup -> an in-row node array (one Python hop per page).

Each page becomes ``ARRAY<STRUCT<...>>`` of its nodes in document order:
elements and text nodes. An element's descendants are the nodes with
``ord < d.ord <= end``; ``text`` of an element is all descendant text joined
(what a bare ``::text`` selector returns, script/style text included),
``texts`` its direct child text nodes (what ``tag::text`` returns) and
``n_texts`` the number of descendant text nodes. Every extractor is then a
narrow column expression over this array.

The parser is the standard library's ``html.parser`` (no lxml in the
environment) with the implied end tags of HTML: ``p`` closed by a block start
tag, ``li``/``dt``/``dd``/``option``/table parts closed by a sibling, void
elements never opened, stray end tags ignored. It runs in ``mapInArrow`` so
the array is built straight into Arrow batches.

No markup raises. A declaration that the parser gives up on is skipped to its
``>`` (as browsers do with bogus comments), an element nested deeper than
``MAX_DEPTH`` gets no children, and any other fault turns the character it
stands at into text; parsing goes on after it, and what was found before stays.
``dom_nodes(..., status=True)`` tells such pages from the others.
"""

from __future__ import annotations

import gc
import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML element classes used for implied end tags.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset",
            "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
            "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
            "table", "ul"}
SIBLING_CLOSE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
                 "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
P, P_STOP = {"p"}, {"div", "section", "body", "html", "table", "li", "dd", "dt", "td", "th", "button"}
SCOPE_STOP = {"ul", "ol", "dl", "table", "div", "section", "body", "html"}

#: Tags in their plainest form, and elements whose content is no markup.
_DOCTYPE = "<!DOCTYPE html>"
_TAG = re.compile(r'<(/(?=[a-zA-Z0-9]+>))?([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9_-]*="[^"<>&]*")*)>')
_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9_-]*)="([^"]*)"')
RAW = {"script", "style", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
RAW_TEXT = {"title", "textarea"}

#: Open elements at most, as in browsers: an element's text is repeated in all its ancestors.
MAX_DEPTH = 512
CHUNK_ROWS = 256

ATTR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
NODE = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("elem_id", T.StringType()),
    T.StructField("classes", T.ArrayType(T.StringType())),
    T.StructField("attrs", T.ArrayType(ATTR)),
    T.StructField("text", T.StringType()),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("n_texts", T.IntegerType()),
])
NODES = T.ArrayType(NODE)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.stack: list[int] = []       # indices of open elements
        self.open: dict[str, int] = defaultdict(int)  # their tags
        self.buf: list[str] = []
        self.faults = 0
        self.done = 0                    # characters of rawdata that are behind the parser

    # -- helpers ---------------------------------------------------------------
    def _flush(self):
        if not self.buf:
            return
        text = "".join(self.buf)
        self.buf = []
        parent = self.stack[-1] if self.stack else -1
        i = len(self.nodes)
        self.nodes.append({"ord": i, "end": i, "parent": parent, "depth": len(self.stack),
                           "kind": "text", "tag": None, "elem_id": None, "classes": None,
                           "attrs": None, "text": text, "texts": None, "n_texts": None})

    def _pop_to(self, tag):
        """Close open elements up to and including the innermost ``tag``."""
        while self.stack:
            i = self.stack.pop()
            self.nodes[i]["end"] = len(self.nodes) - 1
            self.open[self.nodes[i]["tag"]] -= 1
            if self.nodes[i]["tag"] == tag:
                return

    def _close_if_open(self, tags, stop=SCOPE_STOP):
        for t in tags:
            if self.open[t]:
                break
        else:
            return
        for i in reversed(self.stack):
            t = self.nodes[i]["tag"]
            if t in tags:
                self._pop_to(t)
                return
            if t in stop:
                return

    # -- parser events ---------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in CLOSES_P:
            self._close_if_open(P, P_STOP)
        if tag in SIBLING_CLOSE:
            self._close_if_open(SIBLING_CLOSE[tag])
        self._open(tag, [(k, v if v is not None else "") for k, v in attrs])

    def _open(self, tag, attrs):
        amap = dict(attrs)
        i = len(self.nodes)
        self.nodes.append({
            "ord": i, "end": i, "parent": self.stack[-1] if self.stack else -1,
            "depth": len(self.stack), "kind": "element", "tag": tag,
            "elem_id": amap.get("id"),
            "classes": amap["class"].split() if "class" in amap else [],
            "attrs": [{"k": k, "v": v} for k, v in attrs],
            "text": None, "texts": None, "n_texts": None})
        if tag not in VOID:
            if len(self.stack) >= MAX_DEPTH:
                self.faults += 1
                return
            self.stack.append(i)
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.stack and self.stack[-1] == len(self.nodes) - 1:  # it was opened
            self._pop_to(tag)

    def handle_endtag(self, tag):
        self._flush()
        if self.open[tag]:
            self._pop_to(tag)

    def handle_data(self, data):
        self.buf.append(data)

    # -- faults ------------------------------------------------------------------
    def updatepos(self, i, j):
        self.done = j
        return j

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # an unknown keyword, or none
            self.faults += 1
            return self.rawdata.find(">", i) + 1 or -1

    def plain(self, html: str) -> bool:
        """The events of markup of plain tags only, cut by one expression; False (and no
        event) for any other, which the standard parser takes."""
        parts = _TAG.split(html.removeprefix(_DOCTYPE))
        if html.count("<") != len(parts) // 4 + html.startswith(_DOCTYPE):
            return False
        names = [x.lower() for x in parts[2::4]]
        for i, name in enumerate(names):
            if name in RAW or name in RAW_TEXT:  # ends at once
                at = 4 * i + 1
                if parts[at] is None and (name == "plaintext" or names[i + 1:i + 2] != [name] or parts[at + 4] is None
                                          or (name in RAW and "&" in parts[at + 3])):
                    return False
        # as the handlers below do, without a call for each; a text stands between two tags
        nodes, stack, opened = self.nodes, self.stack, self.open
        for i in range(-1, len(names)):
            if i >= 0:
                name, attrs = names[i], parts[4 * i + 3]
                if parts[4 * i + 1]:
                    if opened[name]:
                        self._pop_to(name)
                else:
                    if opened["p"] and name in CLOSES_P:
                        self._close_if_open(P, P_STOP)
                    if name in SIBLING_CLOSE:
                        self._close_if_open(SIBLING_CLOSE[name])
                    attrs = [(k.lower(), v) for k, v in _ATTR.findall(attrs)] if attrs else []
                    self._open(name, attrs)
            text = parts[4 * i + 4]
            if text:
                k = len(nodes)
                nodes.append({"ord": k, "end": k, "parent": stack[-1] if stack else -1, "depth": len(stack),
                              "kind": "text", "tag": None, "elem_id": None, "classes": None, "attrs": None,
                              "text": unescape(text) if "&" in text else text, "texts": None, "n_texts": None})
        return True

    def parse(self, html: str) -> None:
        """Feed all of ``html``; a fault costs the character that it stands at."""
        if self.plain(html):
            return
        while True:
            self.rawdata, self.done = html, 0
            try:
                self.goahead(True)
                return
            except Exception:  # noqa: BLE001  whatever the markup makes the parser do
                self.faults += 1
                at = self.done
                self.handle_data(html[at:at + 1])
                html = html[at + 1:]

    def finish(self, texts: bool = True) -> list[dict]:
        """All nodes; without ``texts`` those of elements are left out."""
        self._flush()
        while self.stack:
            self._pop_to(self.nodes[self.stack[-1]]["tag"])
        if not texts:
            return self.nodes
        # text, direct texts and text counts per element: the texts of an element are
        # neighbours among all texts, so the page's text is joined once and cut
        nodes = self.nodes
        starts, at, whole = [], 0, []  # of each node: texts before it, characters before it
        for n in nodes:
            starts.append((len(whole), at))
            if n["kind"] == "text":
                whole.append(n["text"])
                at += len(n["text"])
                if n["parent"] >= 0:
                    nodes[n["parent"]]["texts"].append(n["text"])
            else:
                n["texts"] = []
        starts.append((len(whole), at))
        joined = "".join(whole)
        for n in nodes:
            if n["kind"] == "element":
                (k, a), (m, z) = starts[n["ord"]], starts[n["end"] + 1]
                n["text"], n["n_texts"] = joined[a:z], m - k
        return nodes


#: Node fields that are put together from the texts below an element.
TEXT_FIELDS = {"text", "texts", "n_texts"}


def parse_page(html: str | None, texts: bool = True) -> tuple[list[dict] | None, int | None]:
    """The nodes of a page and the number of faults in its markup (null: no page)."""
    if html is None:
        return None, None
    b = _TreeBuilder()
    b.parse(html)
    return b.finish(texts), b.faults


def parse_html(html: str | None) -> list[dict] | None:
    return parse_page(html)[0]


def _lists(values: list[list | None], items) -> pa.ListArray:
    """A list array; ``items`` makes the array of all the lists' items."""
    flat, at = [], []
    for v in values:
        at.append(None if v is None else len(flat))
        if v:
            flat += v
    at.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), items(flat))


def _strings(values: list) -> pa.Array:
    return pa.array(values, pa.string())


def node_columns(nodes: list[dict], fields=NODE.names) -> list[pa.Array]:
    """A column per field of ``NODE`` (nulls where not one of ``fields``): a column of plain
    values converts much faster than a row of nested ones."""
    def attrs(flat):
        return pa.StructArray.from_arrays([_strings([a[x] for a in flat]) for x in ("k", "v")], ["k", "v"])
    as_array = {T.IntegerType(): lambda v: pa.array(v, pa.int32()), T.StringType(): _strings,
                T.ArrayType(T.StringType()): lambda v: _lists(v, _strings), T.ArrayType(ATTR): lambda v: _lists(v, attrs)}
    return [as_array[f.dataType]([n[f.name] for n in nodes]) if f.name in fields
            else pa.nulls(len(nodes), as_array[f.dataType]([]).type) for f in NODE.fields]


def node_arrays(pages: list[list[dict] | None], fields=NODE.names) -> pa.ListArray:
    """The node array of each page (null: no page)."""
    return _lists(pages, lambda flat: pa.StructArray.from_arrays(node_columns(flat, fields), NODE.names))


def parse_status(n_faults: Column) -> Column:
    """``ok``, ``recovered`` (faults were skipped) or ``no_markup``."""
    return F.when(n_faults.isNull(), "no_markup").when(n_faults > 0, "recovered").otherwise("ok")


def dom_nodes(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None,
              status: bool = False, fields=NODE.names, only=None) -> DataFrame:
    """``keep`` columns + ``nodes`` (the markup column is dropped); with
    ``status`` also ``n_faults`` and ``parse_status``.

    The planner cannot tell Python what a reader selects, so the reader does: pages are
    parsed whole, then of the nodes for which ``only`` (a function of the node) holds the
    ``fields`` leave Python and the others are null; without any field ``nodes`` are empty."""
    keep = keep or [c for c in pages.columns if c != html_col]
    src = pages.select(*keep, F.col(html_col).alias("__html"))
    out_schema = T.StructType([f for f in src.schema.fields if f.name != "__html"]
                              + [T.StructField("nodes", NODES)]
                              + [T.StructField("n_faults", T.IntegerType())] * status)
    fields, texts = list(fields), not TEXT_FIELDS.isdisjoint(fields)

    def asked(nodes):
        if nodes and (only or not fields):
            return [n for n in nodes if only(n)] if fields else []
        return nodes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # parse in slices so a batch of large pages never holds all of
            # its node arrays in Python memory at once
            for off in range(0, b.num_rows, CHUNK_ROWS):
                s = b.slice(off, CHUNK_ROWS)
                html = s.column(s.schema.get_field_index("__html")).to_pylist()
                cols = [s.column(s.schema.get_field_index(c)) for c in keep]
                with _no_cycles():
                    parsed = [parse_page(h, texts) for h in html]
                    cols.append(node_arrays([asked(n) for n, _ in parsed], fields))
                    if status:
                        cols.append(pa.array([f for _, f in parsed], type=pa.int32()))
                    del parsed
                yield pa.RecordBatch.from_arrays(cols, names=out_schema.names)

    out = src.mapInArrow(run, out_schema)
    return out.withColumn("parse_status", parse_status(F.col("n_faults"))) if status else out


@contextmanager
def _no_cycles():
    """Nodes refer to each other by number: looking for cycles among them is in vain."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


NODE_ROW_FIELDS = NODE.fields
ROWS_PER_BATCH = 8192


def dom_node_rows(pages: DataFrame, html_col: str = "html",
                  keep: list[str] | None = None) -> DataFrame:
    """X0, exploded form: one row per node (``keep`` columns + node fields).

    For pages too large to carry as one array value: no row holds a whole page, and
    "descendant of element e" is ``e.ord < ord <= e.end`` (``extract_rows.inside``)."""
    keep = keep or [c for c in pages.columns if c != html_col]
    src = pages.select(*keep, F.col(html_col).alias("__html"))
    out_schema = T.StructType([f for f in src.schema.fields if f.name != "__html"]
                              + NODE_ROW_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = b.select(keep)
            html = b.column(b.schema.get_field_index("__html")).to_pylist()

            def batch(nodes, at):
                return pa.RecordBatch.from_arrays([*kept.take(pa.array(at, pa.int64())).columns, *node_columns(nodes)],
                                                  names=out_schema.names)
            nodes, at = [], []
            for r, h in enumerate(html):
                found = parse_html(h) or []
                for k in range(0, len(found), ROWS_PER_BATCH):
                    part = found[k:k + ROWS_PER_BATCH]
                    nodes += part
                    at += [r] * len(part)
                    if len(nodes) >= ROWS_PER_BATCH:
                        yield batch(nodes, at)
                        nodes, at = [], []
            if nodes:
                yield batch(nodes, at)

    return src.mapInArrow(run, out_schema)
