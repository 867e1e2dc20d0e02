"""Token alignment against the two libraries and plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import edge_rows, edges, empty

from qbank.llm import align, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), align.byte_alphabet()


@pytest.fixture(scope="module")
def aligner():
    with open(B, "rb") as f:
        return align.Aligner(align.byte_vocabulary(A), align.piece_bytes(B), f.read())


def plain_tokens(libraries, text):
    """(start, end, id) of both sides, or None."""
    a, b, alphabet = libraries
    if not text:
        return None
    raw, out = (" " + text).encode(), []
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    for ids, of in ((a_ids, lambda i: bytes(alphabet[c] for c in a.id_to_token(i))),
                    (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                     else b.id_to_piece(i).replace(align.MARK, " ").encode())):
        spans, at = [], 0
        for i in ids:
            t = of(i)
            if raw[at:at + len(t)] != t:
                return None
            spans.append((at, at + len(t), i))
            at += len(t)
        if at != len(raw):
            return None
        out.append(spans)
    return out


def plain_groups(tokens):
    a, b = tokens
    cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    return [([i for _, e, i in a if lo < e <= hi], [i for _, e, i in b if lo < e <= hi])
            for lo, hi in zip([0, *cuts], cuts)]


def plain_links(tokens):
    return [(i, j) for s, e, i in tokens[0] for u, v, j in tokens[1] if s < v and u < e]


def written_groups(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def plain_align(libraries, rows):
    tokens = [plain_tokens(libraries, t) for _, t in rows]
    links = [plain_links(t) if t else [] for t in tokens]
    held = Counter(p for x in links for p in set(x))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for (i, _), t, x in zip(rows, tokens, links):
        groups = plain_groups(t) if t else []
        text = hashlib.sha256(written_groups(groups).encode()).hexdigest() if t else ""
        out.append((i, len(t[0]) if t else 0, len(t[1]) if t else 0, len(groups), len(x),
                    sum(held[p] == most[p[0]] for p in x), sum(held[p] for p in x), text))
    return Counter(out)


def run(spark, rows, tmp_path):
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_token_alignment(spark, str(tmp_path))
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                   for r in got.collect())


TEXTS = ["the cat sat", " the  cat ", "été 日本語 😀", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", "\n\n\t x",
         "the cat sat on the mat", "x", " ", "﷽ ﬁ ½ İ", "naïve café’s 3,14 ---", "A" * 50, None, ""]


def test_alignment_equals_brute_force(spark, libraries, tmp_path):
    rnd = random.Random(3)
    words = "the cat a of été mat3 sat, 日本 😀 x. <|endoftext|> \n".split(" ")
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "the cat"), (3, "the cat sat"), (3, "the cat sat")]
    rows += [(100 + k, " ".join(rnd.choice(words) for _ in range(rnd.randrange(40)))) for k in range(150)]
    got = run(spark, rows, tmp_path)
    assert got == plain_align(libraries, rows)
    by_id = {r[0]: r for r in got}
    assert by_id[3][1:] == (0, 0, 0, 0, 0, 0, "") or by_id[3][1] > 0
    assert sum(r[1] == 0 for r in got.elements()) >= 3


def test_small_chunks_give_the_same(spark, libraries, tmp_path, monkeypatch):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choice(["ab", "cd", "the", "été", "12"]) for _ in range(30))) for k in range(60)]
    want = plain_align(libraries, rows)
    assert run(spark, rows, tmp_path / "a") == want
    monkeypatch.setattr(align, "CHUNK_BYTES", 300)
    monkeypatch.setattr(align, "SLICE_BYTES", 100)
    assert run(spark, rows, tmp_path / "b") == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abTh '.,!s\n\t<|>0x1é▁İ日😀  ")), min_size=1, max_size=60))
def test_tokens_and_groups_of_any_text(libraries, aligner, text):
    want, got = plain_tokens(libraries, text), aligner.tokens(text)
    assert (want is None) == (got is None)
    if want:
        n_a, n_b, n_groups, n_links, groups, _, pair, links = aligner.align([got])
        assert groups[0].decode() == written_groups(plain_groups(want))
        assert Counter(dict(zip(pair.tolist(), links.tolist()))) == Counter(
            i * aligner.n_b + j for i, j in plain_links(want))
        assert n_links[0] == len(plain_links(want)) and (n_a[0], n_b[0]) == (len(want[0]), len(want[1]))


def test_byte_bpe_equals_the_library_on_every_character(libraries, aligner):
    """Each code point beside letters, digits, spaces and itself: the two libraries
    class characters alike."""
    for low in range(0, 0x110000, 1 << 14):
        texts = [f" a{chr(c)}{chr(c)}1{chr(c)} {chr(c)}a" for c in range(low, low + (1 << 14)) if not 0xD800 <= c < 0xE000]
        ids = libraries[0].encode_batch_fast(texts, add_special_tokens=False)
        assert [e.ids for e in ids] == [aligner.a.encode_ordinary(t) for t in texts]


def test_terminals_of_one_long_component():
    """B is shifted by one byte, so that one chain runs through all tokens."""
    n = 5000
    a, b = np.full(n, 2), np.array([1, *[2] * (n - 1), 1])
    first, last, in_a, in_b = align.terminals(a, b)
    assert in_a.max() == in_b.max() == 0 and (last - first == 1).all()


def test_long_texts_are_cut_without_effect(aligner, libraries, monkeypatch):
    text = ("The cat, of 12 houses; été and x's  two\n" * 40 + "y" * 300 + " ") * 3
    whole = aligner.tokens(text)
    monkeypatch.setattr(align, "SEGMENT_CHARS", 50)
    parts = aligner.tokens(text)
    assert len(whole) == 1 < len(parts)
    one, many = aligner.align([whole]), aligner.align([parts])
    for x, y in zip(one, many):
        assert list(x) == list(y)
    bad = aligner.tokens(text + " a▁b")
    assert bad is None


def test_very_long_text(spark):
    text = "The cat of 12 houses; " * 400_000 + "z" * 200_000  # 9 MB
    got = align.align(spark.createDataFrame([(1, text), (2, "The cat")], "doc_id bigint, text string"), A, B,
                      digests=True).collect()
    assert {r.doc_id: r.n_a > 0 for r in got} == {1: True, 2: True}
    assert next(r for r in got if r.doc_id == 1).n_links == sum(
        getattr(r, c) * s for r in got if r.doc_id == 1 for c, s in (("n_a", 1), ("n_b", 1), ("n_groups", -1)))


def test_align_edges_and_groups(spark, libraries):
    df = edges(spark)
    got = align.align(df, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    rows = got.select("doc_id", "groups", align.group_arrays(got.groups).alias("g")).collect()
    want = Counter((r[0], written_groups(plain_groups(t))) if (t := plain_tokens(libraries, r[1])) else (r[0], "")
                   for r in edge_rows())
    assert Counter((r.doc_id, r.groups) for r in rows) == want
    for r in rows:
        assert written_groups([(x.a, x.b) for x in r.g]) == r.groups
    assert align.align(empty(spark), A, B).count() == 0
