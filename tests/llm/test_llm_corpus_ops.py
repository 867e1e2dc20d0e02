"""De-duplication, mixing, tokenizing, token files and the pipeline against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import SCHEMA, edge_rows, edges, empty, mix, near, shingles, words

import corpus_pipeline
from qbank.llm import exact, graph, mixing, pieces, substrings, tokenfiles
from qbank.llm import near as nearby
from qbank.llm import rolling

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# -- exact ------------------------------------------------------------------------

def test_exact_decisions(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = exact.decisions(edges(spark), bucket_entries=3).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert Counter((r.doc_id, r.keep_id, r.group_size, sha[r.text_sha256]) for r in got) == Counter(
        (i, keep[t or ""], len(groups[t or ""]), t or "") for i, t in rows)
    kept = Counter(sha[r.text_sha256] for r in got if r.kept)
    assert kept == Counter(dict.fromkeys(groups, 1))  # exactly one row of every text
    assert len({r.bucket for r in got}) > 1


def test_exact_deduplicate(spark):
    df = edges(spark)
    got = exact.deduplicate(df)
    assert got.columns == df.columns
    rows = got.collect()
    assert Counter(r.text or "" for r in rows) == Counter({r[1] or "" for r in edge_rows()})
    assert {r.doc_id for r in rows if r.text and r.text.startswith("The cat") and "again" not in r.text} == {2}
    assert exact.deduplicate(empty(spark)).count() == 0 == exact.decisions(empty(spark)).count()


@pytest.mark.parametrize("keys", ["xxhash64(id)", "shiftrightunsigned(xxhash64(id), 30)", "CASE WHEN id < 900 THEN -5 ELSE id END"])
def test_directory_splits_overfull_buckets(spark, keys):
    """Hashed keys, keys alike in their first 30 bits, and 900 times one key."""
    pages = spark.range(3000).selectExpr(f"{keys} AS key")
    all_keys = [r.key % (1 << 64) for r in pages.collect()]
    held = {r.bucket % (1 << 64): [] for r in exact.directory(pages, 300).collect()}
    for k in all_keys:  # the buckets part the keys: one bucket a key
        own = [b for d in range(64) if (b := (1 << d) + (k >> (64 - d))) in held]
        assert len(own) == 1
        held[own[0]].append(k)
    assert all(len(v) <= 300 or len(set(v)) == 1 for v in held.values())
    for b in held:  # a bucket exists only where its parent was overfull
        if b > 1:
            d = b.bit_length() - 2
            assert sum((1 << d) + (k >> (64 - d)) == b >> 1 for k in all_keys) > 300
    got = exact.placed(pages, exact.directory(pages, 300))
    assert Counter(r.bucket % (1 << 64) for r in got.collect()) == {b: len(v) for b, v in held.items() if v}


def test_combiner_settles_nothing(spark, monkeypatch):
    """Copies in several partitions reach the owner apart and meet in the walk."""
    df = spark.createDataFrame([(i, ["same", "other", None][i % 3]) for i in range(60)], "doc_id bigint, text string")
    df = df.repartition(6, "doc_id")
    pages = exact.entries(df, "doc_id", "text")
    assert pages.where("text = 'same'").count() > 1
    monkeypatch.setattr(exact, "_key", lambda text: text.isNull().cast("bigint"))  # all in one chain
    got = exact.build_index(df)[1].collect()
    assert Counter((r.keep_id, r.group_size) for r in got) == Counter([(57, 20), (58, 20), (59, 20)])
    assert sorted(r.chain for r in got) == [1, 2, 3] and {r.bucket for r in got} == {1}


def test_exact_chains_collisions(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact, "_key", lambda text: F.length(text).cast("bigint") * (1 << 50))
    rows = [(1, "aa"), (2, "bb"), (3, "aa"), (4, "c"), (5, "bb"), (6, "dd")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.decisions(df).collect()}
    assert got == {1: (3, 2, False), 2: (5, 2, False), 3: (3, 2, True), 4: (4, 1, True), 5: (5, 2, True), 6: (6, 1, True)}


# -- near -------------------------------------------------------------------------

def near_docs(n=140, seed=3):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    docs = []
    while len(docs) < n:
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(8, 90))]
        for _ in range(rnd.randrange(1, 7)):
            t = list(base)
            for _ in range(rnd.randrange(0, 1 + len(t) // 14)):
                t[rnd.randrange(len(t))] = rnd.choice(vocab)
            docs.append((len(docs) * 3, " ".join(t).title() if rnd.random() < 0.3 else " ".join(t)))
    return docs + [(1, None), (2, ""), (4, " \n"), (5, "solo"), (7, "SOLO")]


@pytest.mark.parametrize("k", [2, 5])
def test_near_components(spark, k):
    docs = near_docs()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = near(docs, k)
    got = {r.doc_id: r for r in nearby.decisions(df, shingle_words=k).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(shingles(t, k)) for i, t in docs}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert 5 < len(set(want.values())) < len(docs)


def test_near_without_hub_luck(spark, monkeypatch):
    """The pair-by-pair step alone finds the same links."""
    monkeypatch.setattr(nearby, "HUB_ROUNDS", 0)
    docs = near_docs(60, 9)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in nearby.decisions(df, shingle_words=2).collect()} == near(docs, 2)


def test_near_rows_that_share_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(5, a), (5, b), (9, b + " more"), (7, a + " end"), (-3, "c " + b), (-3, "d"), (0, "e")],
                               "doc_id bigint, text string")
    got = Counter((r.doc_id, r.n_shingles > 1, r.component_id) for r in nearby.decisions(df).collect())
    assert got == Counter([(5, True, 5), (5, True, -3), (9, True, -3), (7, True, 5), (-3, True, -3), (-3, False, -3),
                           (0, False, 0)])
    rows = nearby.deduplicate(df).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter([(5, a), (-3, "c " + b), (-3, "d"), (0, "e")])


def test_fine_signatures_part_similar_from_unlike_sets():
    """Sets at the threshold stay within the distance; sets at 0.65 go beyond it."""
    rnd = np.random.default_rng(3)
    far = nearby.fine_distance(80)

    def distances(j):
        for _ in range(40):
            s = rnd.integers(0, 2 ** 63, 900, np.uint64)
            own = int(900 * (1 - j) / 2)
            x, y = nearby.fine_signatures([s[own:], s[:900 - own]]).view(np.uint64)
            yield sum(int(d).bit_count() for d in x ^ y)
    assert max(distances(0.8)) <= far < min(distances(0.6))
    assert np.mean([d > far for d in distances(0.65)]) > 0.9


def test_near_edges(spark):
    df = edges(spark)
    got = nearby.decisions(df)
    assert got.count() == df.count()
    rows = nearby.deduplicate(df)
    assert rows.columns == df.columns
    kept = Counter(r.doc_id for r in rows.collect())
    assert kept[1] == 1 and kept[2] == 0 and kept[3] == 0 and kept[10] == 1 and kept[11] == 0
    assert kept[7] == 2  # two unlike texts under one id
    assert nearby.deduplicate(empty(spark)).count() == 0


def test_signature_distance_shares_a_bucket():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a = rnd.integers(0, 1 << nearby.B_BITS, nearby.COMPONENTS, np.uint64)
        b = a.copy()
        b[rnd.choice(nearby.COMPONENTS, nearby.SIGNATURE_DISTANCE, replace=False)] += np.uint64(1)
        x, y = nearby.index_keys(np.stack([a, b]))
        assert (x == y).any()


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60) if i != 30], "u bigint, v bigint")
    got = {r.id: r.comp for r in graph.components(links).collect()}
    assert got == {i: 1 if i <= 30 else 31 for i in range(1, 61)}


# -- rolling hashes -----------------------------------------------------------------

@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\té", max_size=40), min_size=1, max_size=4))
def test_word_and_window_hashes(texts):
    h, doc, a, z = rolling.words([t.encode() for t in texts])
    flat = [(k, w) for k, t in enumerate(texts) for w in words(t)]
    assert doc.tolist() == [k for k, _ in flat]
    by = {}
    for (_, w), x in zip(flat, h.tolist()):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    v, first = rolling.windows(h, doc, 3)
    want = [i for i in range(len(flat) - 2) if flat[i][0] == flat[i + 2][0]]
    assert first.tolist() == want
    seen = {}
    for i, x in zip(want, v.tolist()):
        assert seen.setdefault(tuple(w for _, w in flat[i:i + 3]), x) == x
    assert len(set(seen.values())) == len(seen)


# -- mixing -------------------------------------------------------------------------

def test_mixing_matches_plain(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join("w" * 3 for _ in range(rnd.randrange(0, 40))), rnd.choice(["a", "b", "c", "d", None])) for i in range(300)]
    docs += [(1000 + i, "z " * 50, "b") for i in range(90)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    want = mix(docs)
    assert {i: r.copies for i, r in got.items()} == {d[0]: n for d, n in zip(docs, want)}
    taken, goal, largest = Counter(), {}, Counter()
    for d in docs:
        r = got[d[0]]
        taken[d[2]] += r.taken
        goal[d[2]] = r.target
        largest[d[2]] = max(largest[d[2]], r["size"])
        assert r.taken <= 2 * r["size"]
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6 for s in goal)
    assert abs(sum(goal.values()) - 1.5 * sum(r["size"] for r in got.values())) < 1e-6
    again = {r.doc_id: r.copies for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {i: r.copies for i, r in got.items()}


def test_mixing_edges(spark):
    df = edges(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count() and all(r.taken == r.copies * r["size"] for r in rows)
    out = mixing.sample(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in rows)
    assert mixing.mix(empty(spark)).count() == 0 == mixing.sample(empty(spark)).count()


def test_mixing_by_importance(spark):
    rows = [(i, "a b c d", "s", float(i % 2) * 2) for i in range(400)] + [(1000 + i, "a b c d", "t", 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, imp double")
    got = mixing.mix(df, importance_col="imp").collect()
    assert all(r.copies == 0 for r in got if r.doc_id < 1000 and r.doc_id % 2 == 0)


# -- token files --------------------------------------------------------------------

def library_ids(text):
    from tokenizers import Tokenizer
    tok = library_ids.__dict__.setdefault("tok", Tokenizer.from_file(TOKENIZER))
    return tok.encode(text or "", add_special_tokens=False).ids


ODD = ["it's 'twas don't l'été", "İstanbul ΣΑΣ Σ", "á éx", "<|endoftext|> x<|startoftext|>y", "\x01 a\x01b \x01",
       "A.B,c!! ...;", "x" * 3000, "日本語 テスト😀!", "tab\tnew\nline\x0b\x0c\r.", " nbsp em", "1234 5a6", "ﬁ Ⅷ ½", "\x1cfs\x1d"]


def test_word_encoder_is_the_library():
    enc = tokenfiles.WordEncoder(open(TOKENIZER, encoding="utf-8").read())
    got = enc.encode([t.encode() for t in ODD]) + enc.encode([t.encode() for t in ODD[::-1]])
    for t, ids in zip(ODD + ODD[::-1], got):
        assert ids.tolist() == library_ids(t), t


def test_word_encoder_on_every_letter():
    """Each letter of Unicode, alone and in a word, before each closing mark."""
    enc = tokenfiles.WordEncoder(open(TOKENIZER, encoding="utf-8").read())
    assert enc.joins is not None
    letters = [chr(c) for c in range(0x110000) if chr(c).isalpha()]
    for tail in (".", "!?"):
        for low in range(0, len(letters), 1 << 14):
            words = [w for c in letters[low:low + (1 << 14)] for w in (c + tail, f"a{c}b" + tail)]
            enc.clear()
            want = enc.tok.encode_batch_fast(words, add_special_tokens=False)
            assert [x.tolist() for x in enc.encode([w.encode() for w in words])] == [e.ids for e in want]


def test_latin_words_join_as_the_tokenizer_does():
    """All tokens of the vocabulary as words, and random runs of letters."""
    rnd = random.Random(8)
    enc = tokenfiles.WordEncoder(open(TOKENIZER, encoding="utf-8").read())
    known = [enc.tok.decode([i]).strip() for i in range(49406)]
    words = [w for w in known if tokenfiles.LATIN.fullmatch(w)]
    words += ["".join(rnd.sample(words, 2)) for _ in range(60_000)]
    words += ["".join(rnd.choice("etaoinshrdlueéèüößñçABCz") for _ in range(rnd.randrange(1, 14))) for _ in range(60_000)]
    words.append("ab" * 20_000)
    want = enc.tok.encode_batch_fast(words, add_special_tokens=False)
    assert [x.tolist() for x in enc.encode([w.encode() for w in words])] == [e.ids for e in want]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abZ é'.,!s\n<|>1İ́Σ")), max_size=40))
def test_word_encoder_on_any_text(text):
    enc = test_word_encoder_on_any_text.__dict__.setdefault(
        "enc", tokenfiles.WordEncoder(open(TOKENIZER, encoding="utf-8").read()))
    assert enc.encode([text.encode()])[0].tolist() == library_ids(text)


def test_words_of_many_batches_are_encoded_once(monkeypatch):
    """Small batches share their distinct words and the worker's encoder; each text keeps its ids."""
    from types import SimpleNamespace
    asked, loaded = [], []
    letters, load = tokenfiles.WordEncoder._letters, tokenfiles.WordEncoder.__init__
    monkeypatch.setattr(tokenfiles.WordEncoder, "_letters", lambda self, units: asked.extend(units.to_pylist()) or letters(self, units))
    monkeypatch.setattr(tokenfiles.WordEncoder, "__init__", lambda self, spec: loaded.append(1) or load(self, spec))
    texts = [*ODD, None, "", " \t ", *(f"The same words, again! {i % 3}" for i in range(60))]
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t], pa.string())], ["id", "text"]) for i, t in enumerate(texts)]
    spec = SimpleNamespace(value=open(TOKENIZER, encoding="utf-8").read())
    for _ in range(2):
        out = [r for b in tokenfiles._encoder(spec, 2, "<u4", None)(iter(batches)) for r in b.to_pylist()]
        assert [(r["id"], np.frombuffer(r["frame"], "<u4").tolist()) for r in out] == [
            (i, [*library_ids(t), 2]) for i, t in enumerate(texts)]
        assert [r["n_tokens"] for r in out] == [len(r["frame"]) // 4 for r in out]
        assert asked.count("same") == 1
        asked.clear()
    assert len(loaded) <= 1


def test_token_files(spark, tmp_path):
    df = edges(spark)
    path = str(tmp_path / "tokens")
    spec = open(TOKENIZER, encoding="utf-8").read()
    tokenfiles.write_token_files(df, path, spec, end_id=2, vocab_size=49408)
    rows = tokenfiles.read_token_files(spark, path).collect()
    assert Counter((r.id, tuple(r.ids)) for r in rows) == Counter(
        (r[0], (*library_ids(r[1]), 2)) for r in edge_rows())
    ordered = sorted(rows, key=lambda r: r.start)
    place = 0
    for r in ordered:
        assert r.start == place and r.n_tokens == len(r.ids)
        place += r.n_tokens
    ids = [r.id for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    few = tokenfiles.read_token_files(spark, path, ids=[10, 14]).collect()
    assert {r.id for r in few} == {10, 14} and {r.start for r in few} <= {r.start for r in rows}
    sums = tokenfiles.read_token_files(spark, path, digests_only=True).collect()
    assert Counter((r.id, r.ids_crc32) for r in sums) == Counter(
        (r.id, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows)
    none = str(tmp_path / "none")
    tokenfiles.write_token_files(empty(spark), none, spec, end_id=2)
    assert tokenfiles.read_token_files(spark, none).count() == 0


def test_token_lookup_reads_few_blocks(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq
    monkeypatch.setattr(tokenfiles, "BLOCK_BYTES", 100)
    df = spark.createDataFrame([(i * 7 % 300, f"text {i} of {i * i}") for i in range(300)], "doc_id bigint, text string")
    path, off = tmp_path / "tokens", "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(off)
    spark.conf.set(off, "false")
    try:
        tokenfiles.write_token_files(df, str(path), open(TOKENIZER, encoding="utf-8").read(), end_id=2)
    finally:
        spark.conf.set(off, before)
    held = [pq.read_table(f, columns=["id"])["id"].to_pylist() for f in sorted((path / "index").glob("*.parquet"))]
    assert len(held) > 1 and sum(held, []) == list(range(300))
    files = [pq.read_table(f, columns=["part", "block"]) for f in (path / "blocks").glob("*.parquet")]
    assert len(files) > 1 and all(len(set(f["part"].to_pylist())) <= 1 for f in files)
    index = spark.read.parquet(str(path / "index"))
    few, blocks = index.where("id in (5, 250)"), spark.read.parquet(str(path / "blocks"))
    named = tokenfiles._named_blocks(blocks, few)
    places = {(r.part, r.block) for r in few.collect()}
    assert places <= {(r.part, r.block) for r in named.collect()} and named.count() <= len(places) ** 2 < blocks.count()
    lookup = tokenfiles.read_token_files(spark, str(path), ids=[5, 250])
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = lookup._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for col in ("part", "block"):
        assert re.search(rf"PushedFilters: .*(In|EqualTo)\({col},", pushed)
    assert {r.id for r in lookup.collect()} == {5, 250}
    assert tokenfiles.read_token_files(spark, str(path), ids=[-1]).count() == 0


# -- SentencePiece ------------------------------------------------------------------

def library():
    import sentencepiece
    return library.__dict__.setdefault("sp", sentencepiece.SentencePieceProcessor(model_file=MODEL))


def encoder():
    return encoder.__dict__.setdefault("e", pieces.Encoder(pieces.load_model(MODEL)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abcthe  \n\t.é▁日😀\x00<>0x")), max_size=300), min_size=1, max_size=3))
def test_pieces_are_the_library(texts):
    for t, ids in zip(texts, encoder().encode(texts)):
        assert ids.tolist() == library().encode(t)
        assert pieces.decode_ids(encoder().m.id_bytes, ids) == t.replace("▁", " ")


def test_pieces_long_units():
    texts = ["x" * 5000, "ab" * 4000 + " tail", " " * 400, "hello" * 900, "日本" * 500, "the " * 300]
    for t, ids in zip(texts, encoder().encode(texts)):
        assert ids.tolist() == library().encode(t)


def test_suffix_index_finds_every_occurrence():
    text = "abracadabra" * 7 + "zab"
    codes = np.array([ord(c) for c in text], np.int64)
    index = pieces.SuffixIndex(codes, 16)
    for p in ("a", "abra", "abracadabraab", "racadabraabracad", "zab", "zabr", "b"):
        row = np.zeros((1, 16), np.int64)
        row[0, :len(p)] = np.searchsorted(index.alphabet, [ord(c) for c in p]) + 1
        low, high = index.find(row, np.array([len(p)]))
        assert sorted(index.suffixes[low[0]:high[0]].tolist()) == [i for i in range(len(text)) if text.startswith(p, i)]


def test_pieces_frames(spark):
    df = edges(spark)
    rows = pieces.decoded(pieces.encode(df, MODEL, keep_text=True), MODEL)
    got = rows.withColumn("same", pieces.reads_back(rows.text, rows.decoded)).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter(
        (r[0], tuple(library().encode(r[1] or ""))) for r in edge_rows())
    assert all(r.same for r in got)
    assert pieces.encode(empty(spark), MODEL).count() == 0


# -- substrings ---------------------------------------------------------------------

def cut(docs):
    first = {}
    for i, t in docs:
        w = words(t)
        for a in range(len(w) - 12) if i is not None else ():
            k = tuple(w[a:a + 13])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = {p for a in range(len(w) - 12) if i is not None and first[tuple(w[a:a + 13])] < i for p in range(a, a + 13)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def test_substrings_match_plain(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 2000)
    rnd = random.Random(11)
    vocab = [f"t{i}" for i in range(5)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randrange(5, 60))] for _ in range(6)]
    docs = []
    for i in rnd.sample(range(1000), 120):
        w = []
        for _ in range(rnd.randrange(0, 5)):
            w += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocab) + str(rnd.randrange(9)) for _ in range(rnd.randrange(20))]
        docs.append((i, " ".join(w)))
    docs += [(5000, "a " * 900), (5001, "a " * 40), (5002, "b a " * 400)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = [tuple(r) for r in substrings.deduplicate(df).collect()]
    assert sorted(got) == sorted(cut(docs))
    assert sum(r[2] for r in got) > 500


def test_substrings_edges(spark):
    docs = [(r[0], r[1]) for r in edge_rows()]
    got = Counter(tuple(r) for r in substrings.deduplicate(edges(spark)).collect())
    # rows that repeat an id are joined by it: their windows are judged together
    same = Counter(r for r in cut(docs))
    assert got == same
    assert substrings.deduplicate(empty(spark)).count() == 0


def test_substrings_of_texts_under_one_id(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 2000)
    passage = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(2)]
    own = [" ".join(f"o{k}w{i}" for i in range(200 * k + 20)) for k in range(4)]
    docs = [(1, f"{passage[0]} {own[0]}"), (7, f"{own[3]} {passage[0]}"), (7, f"{passage[0]} {own[1]}"), (7, own[0]),
            (7, f"{own[2]} {passage[1]}"), (7, f"{passage[1]} {own[1]}"), (8, f"{own[3]} {passage[1]}"), (7, own[0]),
            (-3, "q " + passage[1]), (-3, own[1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = [tuple(r) for r in substrings.deduplicate(df).collect()]
    assert sorted(got) == sorted(cut(docs))


# -- the pipeline ---------------------------------------------------------------------

def test_pipeline_matches_plain(spark, tmp_path):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    df = spark.createDataFrame(
        [(*r, "x") for r in rows] + [(*rows[3], "y"), (None, None, None, None, None, None), (9000, rows[5].text, "en", None, 1, None)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, quality string")
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == df.columns
        path = str(tmp_path / stage.__name__)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    got = [(r.doc_id, tuple(r.ids)) for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()]

    from qbank.llm import quality
    good = [(r.doc_id, r.text, r.source) for r in quality.filter_quality(df).collect()]
    last = {}
    for d in good:
        if d[1] not in last or (d[0] or -1) > (last[d[1]][0] or -1):
            last[d[1]] = d
    single = sorted(last.values(), key=lambda d: d[0])
    boss = near([(i, t) for i, t, _ in single], 5)
    stay = [d for d in single if boss[d[0]] == d[0]]
    want = Counter()
    for (i, t, _), n in zip(stay, mix(stay)):
        if n:
            want[i, tuple(library().encode(t))] = n
    assert Counter(got) == want and len(want) > 100


def test_pipeline_stages_on_edges(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), "").count() == 0
        stage(spark, edges(spark), "").collect()


def test_run_reads_the_table(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) > 100 and all(len(r.ids) == r.n_pieces for r in rows)
    assert SCHEMA
