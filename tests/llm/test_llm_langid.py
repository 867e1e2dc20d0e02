"""The language network: plain convolution, gradients, held-out accuracy, edges."""

import zlib

import numpy as np
import pytest
from plain import edge_rows, edges, empty

from qbank.llm import langid, queries

SF = "/root/testdata/sf0.1"


def tiny(seed=0, languages=("aa", "bb", "cc")):
    rng = np.random.default_rng(seed)
    e, f, w = langid.EMBED, langid.FILTERS, langid.WIDTHS
    return langid.Model(list(languages), rng.normal(size=(langid.N_CODES, e)), [rng.normal(size=(k * e, f)) for k in w],
                        [rng.normal(size=f) for _ in w], rng.normal(size=(len(w) * f, len(languages))),
                        rng.normal(size=len(languages)))


def plain_codes(text):
    """Codes of a text, runs of code 0 once (also at the start), in windows."""
    out = []
    for b in text.lower().encode():
        c = b - 96 if 97 <= b <= 122 else b - 101 if b >= 128 else 0
        if c or not out or out[-1]:
            out.append(c)
    out += [0] * (-len(out) % langid.WINDOW)
    return np.array(out).reshape(-1, langid.WINDOW)


def plain_probabilities(m, codes):
    out = []
    for c in codes:
        features = []
        for w, f, b in zip(langid.WIDTHS, m.filters, m.bias):
            places = [sum(m.embed[c[i + k]] @ f[k * langid.EMBED:(k + 1) * langid.EMBED] for k in range(w))
                      for i in range(langid.WINDOW - w + 1)]
            features.append(np.maximum(np.max(places, 0) + b, 0))
        x = np.concatenate(features) @ m.dense + m.offset
        out.append(np.exp(x - x.max()) / np.exp(x - x.max()).sum())
    return np.array(out)


TEXTS = ["The cat SAT on 12 mats -- ÉTÉ 日本", "x", "", None, "12 ## --", "ab " * 300, "  lead", "é"]


def test_windows_equal_plain_codes():
    codes, of = langid.windows(TEXTS)
    for k, t in enumerate(TEXTS):
        mine = codes[of == k]
        if not t or not any(c.isalpha() for c in t):
            assert len(mine) == 0
            continue
        # a leading run of code 0 may be dropped or kept: it holds no letter
        want = plain_codes(t)
        a, b = ("".join(map(chr, x.ravel())).strip("\0") for x in (mine, want))
        assert a == b


def test_scores_equal_the_convolution():
    m = tiny()
    codes, of = langid.windows(TEXTS)
    p = langid.Scorer(m).probabilities(codes)
    assert np.allclose(p, plain_probabilities(m, codes), atol=1e-5)
    got = langid.Scorer(m).predict(TEXTS)
    for k, t in enumerate(TEXTS):
        mine = of == k
        if not mine.any():
            assert got[k] == ("und", 0.0)
            continue
        weight = (codes[mine] > 0).sum(1)
        mean = (p[mine] * weight[:, None]).sum(0) / weight.sum()
        assert got[k][0] == m.languages[int(mean.argmax())] and got[k][1] == pytest.approx(mean.max(), abs=1e-5)


def test_gradients_equal_differences():
    m, rng = tiny(1), np.random.default_rng(2)
    codes = rng.integers(0, langid.N_CODES, (5, langid.WINDOW)).astype(np.uint8)
    label = np.array([0, 1, 2, 0, 1])

    def loss():
        return -np.log(plain_probabilities(m, codes)[np.arange(5), label]).mean()
    for p, g in zip(m.parameters(), langid._gradients(m, codes, label)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        was, step = p[at], 1e-5
        p[at] = was + step
        more = loss()
        p[at] = was - step
        less = loss()
        p[at] = was
        assert (more - less) / (2 * step) == pytest.approx(g[at], rel=1e-3)


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries.op12_language_id(spark, SF).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r.lang_pred == r.lang for r in rows if r.held_out and r.lang]
    assert len(held) > 1500 and np.mean(held) > 0.98


def test_equal_tables_give_equal_models(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = langid.train(df), langid.train(df.repartition(7))
    assert one.languages == two.languages == ["de", "en", "es", "fr"]
    assert all(np.array_equal(a, b) for a, b in zip(one.parameters(), two.parameters()))


def test_held_out_rows_are_never_learnt(spark):
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0][:40]
    df = spark.createDataFrame([(i, "the cat", "en") for i in ids] + [(None, "the cat", "en")],
                               "doc_id bigint, text string, lang string")
    assert langid.train(df) is None
    got = langid.predict(df, None).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)} and len(got) == 41


def test_whole_texts_count(spark):
    """The language of the far end of a text weighs as much as its start."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(df)
    en = "and the heed of thouti with inge thre ation by "
    fr = "leaux des éoireau que mentoiê pour ièreaux èan "
    rows = spark.createDataFrame([(1, en * 40 + fr * 400), (2, en * 400 + fr * 40), (3, fr * 100_000)],
                                 "doc_id bigint, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(rows, model).collect()}
    assert got == {1: "fr", 2: "en", 3: "fr"}


def test_language_edges(spark):
    df = edges(spark)
    model = langid.train(df)
    assert model.languages == ["en"]
    got = langid.predict(df, model)
    assert got.columns == ["doc_id", "lang_pred", "score"]
    rows = got.collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in rows) == sorted(
        (str(i), "en" if t and any(c.isalpha() for c in t) else "und") for i, t, *_ in edge_rows())
    assert {r.score for r in rows if r.lang_pred == "und"} == {0.0}
    assert langid.train(empty(spark)) is None and langid.predict(empty(spark), model).count() == 0
