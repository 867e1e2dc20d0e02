"""Parser invariants on generated well-formed markup (pure Python, no Spark)."""
import html as H

from hypothesis import given, settings
from hypothesis import strategies as st

from qbank.operators.dom import MAX_DEPTH, parse_html, parse_page

TAGS = ["div", "span", "section", "b", "h2", "ol", "ul", "dl", "a"]
words = st.text(alphabet=st.sampled_from(list("ab <&>\"' é\n")), min_size=1, max_size=6)


def tree():
    return st.recursive(words.map(lambda w: ("text", w)),
                        lambda kids: st.tuples(st.sampled_from(TAGS), st.lists(kids, max_size=4)),
                        max_leaves=25)


def render(node):
    if node[0] == "text":
        return H.escape(node[1], quote=False)
    tag, kids = node
    return f"<{tag}>" + "".join(render(k) for k in kids) + f"</{tag}>"


def text_of(node):
    if node[0] == "text":
        return node[1]
    return "".join(text_of(k) for k in node[1])


@settings(max_examples=150, deadline=None)
@given(st.lists(tree(), min_size=1, max_size=4))
def test_parse_invariants(forest):
    doc = "<body>" + "".join(render(t) for t in forest) + "</body>"
    nodes = parse_html(doc)
    body = nodes[0]
    assert body["tag"] == "body" and body["text"] == "".join(text_of(t) for t in forest)
    for n in nodes:
        assert n["ord"] <= n["end"] < len(nodes)
        if n["parent"] >= 0:
            p = nodes[n["parent"]]
            assert p["ord"] < n["ord"] <= p["end"]
        if n["kind"] == "element":
            inner = [m["text"] for m in nodes[n["ord"] + 1:n["end"] + 1] if m["kind"] == "text"]
            assert n["text"] == "".join(inner) and n["n_texts"] == len(inner)
            kids = [m["text"] for m in nodes if m["kind"] == "text" and m["parent"] == n["ord"]]
            assert n["texts"] == kids


pieces = st.sampled_from(["<", ">", "<!", "<![", "<![bad[", "]]>", "<!--", "-->", "<![=", "<!DOCTYPE [", "<?", "</", "/>", "&", "&#x;",
                          "&#99999999999;", "<p", "<p>", "</p>", "<script>", "</script>", "<a href='", '"', "=", "text ", "é",
                          "\x00", "<div id=x>", "</div>", "<br/>", "<svg/>", "<textarea>", "<plaintext>", "<![CDATA[", "<li>"])


@settings(max_examples=600, deadline=None)
@given(st.one_of(st.lists(pieces, max_size=30).map("".join), st.text(max_size=60)))
def test_no_markup_raises(doc):
    nodes, faults = parse_page(doc)
    assert faults >= 0 and all(n["ord"] <= n["end"] < len(nodes) for n in nodes)


@settings(max_examples=300, deadline=None)
@given(st.lists(tree(), min_size=1, max_size=3), st.sampled_from(["<![bad[ x>", "<![ >", "<![=p q>"]), st.lists(tree(), min_size=1, max_size=3))
def test_a_fault_costs_itself_alone(before, fault, after):
    """The nodes before and after a fault are those of the page without it."""
    a, b = ("".join(render(t) for t in x) for x in (before, after))
    broken, faults = parse_page(f"<body>{a}<i></i>{fault}<i></i>{b}</body>")
    assert faults == 1
    assert broken == parse_html(f"<body>{a}<i></i><i></i>{b}</body>")


def test_what_stands_before_and_after_a_fault_stays():
    nodes, faults = parse_page("<p>a</p><![bad[ b><p>c</p><!--<![=p")
    assert faults >= 1 and [n["text"] for n in nodes if n["tag"] == "p"][:2] == ["a", "c"]
    assert parse_page(None) == (None, None) and parse_page("") == ([], 0)


def test_deep_and_faulty_pages_stay_cheap():
    nodes, faults = parse_page("<b>" * 20_000 + "x" * 1000)
    assert len(nodes) == 20_001 and faults == 20_000 - MAX_DEPTH and max(n["depth"] for n in nodes) == MAX_DEPTH
    assert nodes[0]["text"] == "x" * 1000
    nodes, faults = parse_page("<![a>" * 50_000 + "<p>end")
    assert faults == 50_000 and nodes[-1]["text"] == "end"
    nodes, _ = parse_page("<p><b>" * 3000 + "</i></p>" * 3000)
    assert sum(n["tag"] == "p" for n in nodes) == 3000
