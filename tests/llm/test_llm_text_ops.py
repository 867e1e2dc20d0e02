"""Quality rules, sharding, chat, PII on edge cases against plain Python."""

import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import edge_rows, edges, empty, words, unit

from qbank.llm import chat, pii, quality, sharding


def counts(text):
    w = words(text)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = set()
    for i in range(len(w) - 7):
        if win[tuple(w[i:i + 8])] > 1:
            cover.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(cover))


def test_quality_counts_and_kept(spark):
    df = edges(spark)
    q = quality.quality(df, out="verdict")
    assert q.columns == [*df.columns, "verdict"]
    want = sorted(counts(r[1]) for r in edge_rows())
    rows = [r.verdict for r in q.collect()]
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = quality.filter_quality(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, None}
    assert kept.count() == 5


def test_quality_repeated_windows_overlap(spark):
    texts = ["a b c d e f g h " * 2 + "x", "p q " * 9, "u " * 8, "a b c d e f g h i a b c d e f g h j a b c d e f g h"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.quality.n_repeat_words for r in quality.quality(df).collect()}
    assert got == {k: counts(t)[4] for k, t in enumerate(texts)}


def test_quality_empty(spark):
    assert quality.quality(empty(spark)).count() == 0
    assert quality.filter_quality(empty(spark)).count() == 0


def test_shards(spark):
    rows = [(i, "t" * (i % 50)) for i in range(600)] + [(r[0], r[1]) for r in edge_rows()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sharding.shard_slots(df, "doc_id", "text", [1.0] * 16).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 16
    assert any(r.grown_shard == 16 for r in got)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    by_key = defaultdict(set)
    for r in got:
        by_key[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(s) == 1 for s in by_key.values())
    assert sharding.shard_slots(empty(spark), "doc_id", "text", [1.0] * 16).count() == 0


def test_shards_are_the_winning_bids(spark):
    """The shard of every key recomputed: the largest -weight / ln(u), the lowest name of equals."""
    ids = [*range(500), None, -7, 10 ** 15]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").selectExpr("doc_id", "'t' AS text")
    weights = [1.0, 2.5, 0.0, 1.0, 4.0]

    def winner(i, w):
        return max((-x / math.log(unit(i, n)), -n) for n, x in enumerate(w) if x > 0)[1] * -1
    got = {r.doc_id: r.shard for r in sharding.assign(df, "doc_id", weights).collect()}
    assert got == {i: winner(i, weights) for i in ids}
    slots = {r.doc_id: (r.shard, r.grown_shard) for r in sharding.shard_slots(df, "doc_id", "text", [1.0] * 16).collect()}
    assert slots == {i: (winner(i, [1.0] * 16), winner(i, [1.0] * 17)) for i in ids}


def test_shard_weights(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    got = Counter(r.shard for r in sharding.assign(df, "doc_id", [1.0, 3.0, 0.0]).collect())
    assert 0.2 < got[0] / 4000 < 0.3 and 2 not in got
    # one weight more never moves rows between the others
    a = {r.doc_id: r.shard for r in sharding.assign(df, "doc_id", [1.0, 3.0]).collect()}
    b = {r.doc_id: r.shard for r in sharding.assign(df, "doc_id", [1.0, 3.0, 2.0]).collect()}
    assert all(b[i] in (a[i], 2) for i in a)


def test_write_shards(spark, tmp_path):
    df = edges(spark)
    sharding.write_shards(df, str(tmp_path / "s"), "doc_id", [1.0, 1.0])
    assert spark.read.parquet(str(tmp_path / "s")).count() == df.count()


EVENTS = "conv_id bigint, msg bigint, seq bigint, kind string, role string, text string"


def test_fold_events(spark):
    log = [
        (1, 2, 5, "open", "assistant", None), (1, 2, 6, "delta", None, "dra"), (1, 2, 7, "regenerate", None, None),
        (1, 2, 8, "delta", None, "fi"), (1, 2, 9, "delta", None, "nal"), (1, 2, 9, "delta", None, "nal"),
        (1, 1, 1, "open", "user", None), (1, 1, 2, "delta", None, "hello"), (1, 1, 10, "edit", None, "hi"),
        (None, 1, 1, "open", None, None), (None, 1, 2, "delta", None, None),
    ]
    got = {(r.conv_id, r.msg): (r.role, r.text) for r in chat.messages(spark.createDataFrame(log[::-1], EVENTS)).collect()}
    assert got == {(1, 1): ("user", "hi"), (1, 2): ("assistant", "final"), (None, 1): ("", "")}
    with pytest.raises(Exception, match="unknown kind"):
        chat.messages(spark.createDataFrame([(1, 1, 1, "zap", None, None)], EVENTS)).collect()


TURNS = "conv_id bigint, turn bigint, role string, text string, seq string, msg string"


def test_chat_round_trip(spark):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said * 30), (1, 1, "assistant", said * 30), (1, None, "system", None),
            (None, 0, None, "x"), (2, 0, "a<|b\nc", "<\\|<|nl|>\\"), (2, 1, "assistant", None), (2, 2, "assistant", "é😀" * 400)]
    df = spark.createDataFrame([(*r, "s", "m") for r in rows], TURNS)
    msgs = chat.messages(chat.turn_events(df))
    seg = chat.render(msgs).orderBy("conv_id", "msg").collect()
    by = defaultdict(list)
    for r in seg:
        by[r.conv_id].append(chat.parse_segment(r.segment))
        assert r.segment.count("<|im_start|>") == 1 == r.segment.count("<|im_end|>")
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1] or 0)):
        want[c].append((role or "", text or ""))
    assert by == want
    got = {r.conv_id: r for r in chat.read_back(chat.render(msgs)).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {c: len(x) for c, x in want.items()}
    assert {c: r.loss_chars for c, r in got.items()} == {
        c: sum(len(t) for role, t in x if role == "assistant") for c, x in want.items()}
    none = spark.createDataFrame([], TURNS)
    assert chat.read_back(chat.render(chat.messages(chat.turn_events(none)))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\>a\n", max_size=30))
def test_escape_is_reversible(text):
    escaped = re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert "<|" not in escaped and chat.unescape(escaped) == text


def luhn(d):
    d = [int(x) for x in reversed(d)]
    return sum(d[0::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


BASE = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
]


def plain_spans(text):
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(BASE) for m in re.finditer(p, text) if ok(m[0]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ ()290", max_size=60))
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_edges():
    for t in ["a@b@c.d", "x@y..z a.b@c-d.e.f", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.04", "é a@b.cc\n4539148803436467",
              "4539 1488 0343 6467-1", "+1 (845) 555-1234x", "@@a@b.c@d.e"]:
        assert pii.base_spans(t) == plain_spans(t)


def test_searches_are_linear():
    began = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "1 " * 100_000, "((" * 100_000):
        pii.spans_of(t, None)
        pii.candidates(t)
    assert time.time() - began < 60


def test_candidates_of_many_parts():
    def proposed(text):
        return {(text[s:e], pii.KINDS[k]) for s, k, e in pii.candidates(text)}
    assert {("+33 6 12 34 56 78", "phone"), ("4539 1488 0343 6467", "card")} <= proposed(
        "x +33 6 12 34 56 78 4539 1488 0343 6467 y")
    assert ("06 12 34 56 78", "phone") in proposed("tel 06 12 34 56 78, fax")
    assert {("06-12-34-56-78", "phone"), ("4539-1488-0343-6467", "card")} <= proposed("06-12-34-56-78-4539-1488-0343-6467")
    assert ("(826) 555-4081", "phone") in proposed("call (826) 555-4081.")
    spaced = (" " * 30).join("06 12 34 56 78".split())
    assert (spaced, "phone") in proposed(spaced)
    long = "a" * 100 + "@" + "b-" * 200 + "c"
    assert (long, "email") in proposed(long) and not any(t != long for t, _ in proposed(long))


def test_added_spans_stay_disjoint():
    class Sure:
        def score(self, x):
            return 0.6 + x[:, 2] / 100  # more digits first
    text = "1.2.3.4.5.6 +33 6 12 34 56 78 4539 1488 0343 6467 06 12 34 56 78 a@b.c@d " * 20
    spans = pii.spans_of(text, (Sure(), [0.5] * 4))
    assert any(not own for *_, own, _ in spans)
    for kind in range(4):
        mine = [(s, e) for s, k, e, *_ in spans if k == kind]
        assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, (3000, 4)).astype(float)
    y = ((x[:, 1] > 2) & (x[:, 2] < 4)).astype(float)
    t = pii.Trees().fit(x[:2000], y[:2000])
    s = t.score(x[2000:])
    assert ((s > 0.5) == (y[2000:] > 0)).mean() > 0.97
    cut = pii.calibrate(s, y[2000:])
    assert y[2000:][s >= cut].mean() >= pii.PRECISION
    assert pii.calibrate(s[:5], y[2000:2005]) == 2.0


def test_pii_finds_what_base_misses(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = pii.train(df)
    assert model is not None
    two = "x +1 (826) 555-4081 190.137.223.204 and 7536784127813050 4845168114407329."
    found = {two[s:e] for s, k, e, own, p in pii.spans_of(two, model)}
    assert {"+1 (826) 555-4081", "190.137.223.204"} <= found
    assert found & {"7536784127813050", "4845168114407329"}
    clean = "In 1999 about 12 of 345 people (or 3.5 %) paid 1,200.50 each; see 4.1.2 and 2001-2004."
    assert pii.spans_of(clean, model) == []


def test_pii_adds_other_formats(spark):
    model = pii.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    for part, kind in [("(826) 555-4081", "phone"), ("826-555-4081", "phone"), ("06 12 34 56 78", "phone"),
                       ("826.555.4081", "phone"), ("4539.1488.0343.6467", "card")]:
        text = f"ntle çre. Éçan {part} èaique treé"
        assert [(text[s:e], pii.KINDS[k], own) for s, k, e, own, _ in pii.spans_of(text, model)] == [(part, kind, False)]
    text = "heed ha +33 6 12 34 56 78 4539 1488 0343 6467 thheed"
    assert {text[s:e] for s, _, e, _, _ in pii.spans_of(text, model)} == {"+33 6 12 34 56 78", "4539 1488 0343 6467"}


def test_labels_of_candidates():
    def of(text, *a):
        return {(text[s:e], pii.KINDS[k]): (y, own) for (s, k, e), y, own in pii.labelled(text, *a)}
    # parts of a base span can't be added; what passes the checks is no negative
    assert of("x +1 (826) 555-4081 y") == {("+1 (826) 555-4081", "phone"): (1.0, True)}
    assert ("(826) 555-4081", "phone") not in of("x (826) 555-4081 y")
    assert of("x (826) 555-4081 y")["555-4081", "phone"] == (0.0, False)
    # where base data of another kind stands, a phone is wrong whatever its digits
    assert of("x 190.137.223.204 y")["190.137.223.204", "phone"] == (0.0, False)
    text = "x (826) 555-4081 y"
    assert of(text, [(2, 3, 16)]) == {("(826) 555-4081", "phone"): (1.0, False), ("555-4081", "phone"): (0.0, False)}
    rows = list(pii.examples("x +1 (826) 555-4081 y", 3))
    assert sum(y for _, y, own in rows if not own) >= pii.VARIANTS


def test_pii_of_held_out_documents_alone(spark):
    text = "mail bob@example.com now +1 (845) 555-1234 or 10.0.0.1 and 4539 1488 0343 6467; " * 20
    df = spark.createDataFrame([(0, text)], "doc_id bigint, text string")
    assert pii.train(df) is None
    assert len(pii.find(df, model=pii.train(df)).first().spans) == 80


def test_pii_edges(spark):
    df = edges(spark)
    model = pii.train(df)
    rows = pii.find(df, model=model).collect()
    assert len(rows) == df.count()
    assert {k["kind"] for r in rows if r.doc_id == 14 for k in r.spans} == set(pii.KINDS)
    assert all(r.spans == [] for r in rows if r.doc_id != 14)
    red = pii.redact(df, model)
    assert red.columns == df.columns
    text = next(r.text for r in red.collect() if r.doc_id == 14)
    assert "[email]" in text and "bob" not in text and "[card]" in text
    assert pii.train(empty(spark)) is None and pii.find(empty(spark)).count() == 0


def test_pii_learns_from_all_documents(spark, monkeypatch):
    """The sums that bins, trees and thresholds come from hold every candidate once."""
    docs = [(i, f"mail a{i}@example.com call +1 (845) 555-{1000 + i} from 10.0.0.{i % 300} on {i} 12 345") for i in range(300)]
    docs += [(None, docs[7][1]), (3, docs[3][1])]  # a null and a repeated id
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    seen, held = [], []
    grow, calibrate = pii.Trees.grow, pii.calibrate
    def kept(share, sums):
        return lambda splits: seen.append((share, sums(splits))) or seen[-1][1]
    monkeypatch.setattr(pii.Trees, "grow", lambda t, share, sums: grow(t, share, kept(share, sums)))
    monkeypatch.setattr(pii, "calibrate", lambda s, y, n: held.append((y.sum(), n.sum())) or calibrate(s, y, n))
    trees, least = pii.train(df)
    rows = [(y, own, x[0], pii._share(i or 0) < 0.3) for i, t in docs for x, y, own in pii.examples(t, i or 0)]
    y = np.array([r[0] for r in rows if not r[3]])
    share, (g, h) = seen[0]
    assert share == y.mean() and abs(h[0].sum(1)[0] - len(y) * share * (1 - share)) < 1e-2
    out = [[r[0] for r in rows if r[3] and r[2] == k and not (r[1] and k >= 2)] for k in range(4)]
    assert held == [(sum(v), len(v)) for v in out]
    again = pii.train(df.repartition(3))  # whatever the partitions
    assert again[1] == least and all((a[1] == b[1]).all() and a[0] == b[0] for a, b in zip(again[0].trees, trees.trees))
