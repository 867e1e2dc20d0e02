"""Alignment of two tokenizations of the same text, and corpus counts of aligned ids.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), B a SentencePiece BPE with byte
fallback. A encodes space + text, B adds that space itself; both then cover the same
bytes, and a token is an interval of byte offsets. Tokens of the two sides are linked
where their intervals overlap; the connected components are the groups between offsets
at which tokens of both sides end.

Groups come by pointer jumping over all tokens of a slice of texts at once: every token
points to its farthest-right overlapping token on the other side (a token of B that ends
where that token ends points to itself), and successors are doubled, ``next =
next[next]``, until nothing changes. Each token then holds its component's terminal
token, which labels the group; n tokens in a row take log2(n) rounds.

Counts: a chunk of about ``CHUNK_BYTES`` of texts is one row, with its documents, their
distinct (A id, B id) pairs (ranks in the chunk's list of pairs, packed) and, per
distinct pair, in how many of its documents it stands. Spark sums those over all chunks,
finds the highest count of every A id, and joins the sums back by pair; a chunk's sums
and its row meet in one group, whose size the chunk bounds. A pair that stands in every
document is one row per chunk, summed map-side.

A is run by the ``tiktoken`` library over the vocabulary of the file: equal ids, tested
for every code point, and sure because every token encodes to itself (checked when the
file is loaded). Texts of over ``SEGMENT_CHARS`` are cut at a space between two ASCII
letters or digits, where both tokenizers always end a token; memory is bounded by the
longest stretch without such a space, about 100 bytes per byte of it.

Edge cases: null and empty texts, and texts whose joined token bytes differ from space +
text (a literal U+2581), have no tokens: zeros and an empty ``groups``; special strings
are plain text; repeated rows and null ids are documents of their own; other columns
don't matter, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import named, written

#: Bytes of texts in one chunk: bounds a row, a group and a task's memory.
CHUNK_BYTES = 12 << 20
#: Bytes of texts that are aligned at a time.
SLICE_BYTES = 1 << 20
SEGMENT_CHARS = 1 << 20

MARK = "▁"
#: How byte-level BPE splits a text before merging (fixed value of that tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CUT = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

DOC = ("struct<id:bigint,n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,"
       "groups:string,n_pairs:bigint>")
_DOC = pa.struct([("id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
                  ("groups", pa.string()), ("n_pairs", pa.int64())])


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones
    for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_vocabulary(path: str) -> dict[bytes, int]:
    """Bytes -> id of a byte-level BPE file; its ids must be its merge ranks, and every
    token must encode to itself (then ranks of joined bytes and merges agree)."""
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, alphabet = spec["model"], byte_alphabet()
    special = {t["content"] for t in spec["added_tokens"]}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    bpe = Tokenizer.from_file(path).model
    own = [t for t, i in model["vocab"].items() if t not in special and [x.id for x in bpe.tokenize(t)] != [i]]
    if own or merged != sorted(merged) or (merged and merged[0] < 256):
        raise ValueError(f"{path}: ids are not merge ranks")
    return {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in special}


def piece_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a SentencePiece model."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        out.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARK, " ").encode())
        if MARK in p.lstrip(MARK):
            raise ValueError(f"a piece spans words: {p!r}")
    return out


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of every [low, high), end to end."""
    n = high - low
    return np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)


def terminals(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For two runs of token lengths over the same bytes: the first and last token of B
    that each token of A overlaps, and the group number of every token of A and of B."""
    n_a, n_b = len(a_len), len(b_len)
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    a_at = np.repeat(np.arange(n_a), a_len)  # the token over each byte
    b_at = np.repeat(np.arange(n_b), b_len)
    first, last = b_at[a_end - a_len], b_at[a_end - 1]
    far = a_at[b_end - 1]
    nodes = np.arange(n_a, n_a + n_b)
    after = np.concatenate((n_a + last, np.where(a_end[far] == b_end, nodes, far)))
    while True:
        doubled = after[after]
        if np.array_equal(doubled, after):
            break
        after = doubled
    number = np.cumsum(after[n_a:] == nodes) - 1  # terminals are tokens of B, in order
    label = number[after - n_a]
    return first, last, label[:n_a], label[n_a:]


@dataclass
class _Texts:
    """Decimal ids with the sign that stands before them, padded with NUL."""
    width: int
    table: np.ndarray

    @classmethod
    def of(cls, ids: int) -> "_Texts":
        width = len(str(ids)) + 1
        return cls(width, np.array([[f"{sign}{i}".encode() for i in range(ids)] for sign in ";,|"], f"S{width}"))

    def joined(self, sign: np.ndarray, ids: np.ndarray) -> bytes:
        return self.table[sign, ids].tobytes().translate(None, b"\0")


class Aligner:
    def __init__(self, vocabulary: dict[bytes, int], pieces: list[bytes], model: bytes):
        import sentencepiece
        import tiktoken
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n_b = len(pieces)
        self.a_bytes: list[bytes] = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.a_bytes[i] = token
        self.b_bytes = pieces
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.texts = _Texts.of(max(len(self.a_bytes), self.n_b))

    def _tokens(self, part: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, None where they don't cover space + part."""
        raw = b" " + part.encode()
        a, b = self.a.encode_to_numpy(" " + part), self.b.encode(part)
        # tokens of A are slices of its bytes, so that their lengths tell
        if int(self.a_len[a].sum()) != len(raw) or b"".join([self.b_bytes[i] for i in b]) != raw:
            return None
        return a, np.array(b, np.int32)

    def tokens(self, text: str) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """The ids of every segment of a text, None where it has no tokens."""
        out, start = [], 0
        while start < len(text):
            cut = _CUT.search(text, start + SEGMENT_CHARS)
            got = self._tokens(text[start:cut.start() if cut else None])
            if got is None:
                return None
            out.append(got)
            start = cut.end() if cut else len(text)
        return out or None

    def align(self, docs: list[list[tuple[np.ndarray, np.ndarray]]]):
        """Over some documents: n_a, n_b, n_groups and n_links of each, the groups text
        of each, and sorted (document, pair, links) of their distinct pairs."""
        n = len(docs)
        segments = [s for d in docs for s in d]
        a_ids, b_ids = (np.concatenate([s[k] for s in segments]).astype(np.int64) for k in (0, 1))
        n_a = np.array([sum(len(a) for a, _ in d) for d in docs], np.int64)
        n_b = np.array([sum(len(b) for _, b in d) for d in docs], np.int64)
        first, last, a_group, b_group = terminals(self.a_len[a_ids], self.b_len[b_ids])
        # groups text: A of a group, then B of it
        groups = int(b_group[-1]) + 1 if len(b_group) else 0
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        to_a = np.arange(len(a_ids)) + (np.cumsum(in_b) - in_b)[a_group]
        to_b = np.arange(len(b_ids)) + np.cumsum(in_a)[b_group]
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        sign = np.ones(len(order), np.int64)
        order[to_a], order[to_b] = a_ids, b_ids
        sign[to_a[np.diff(a_group, prepend=-1) > 0]] = 0
        sign[to_b[np.diff(b_group, prepend=-1) > 0]] = 2
        ends = np.cumsum(n_a + n_b)
        texts = [self.texts.joined(sign[s:e], order[s:e])[1:] for s, e in zip(ends - n_a - n_b, ends)]
        # links and distinct pairs
        doc_a = np.repeat(np.arange(n), n_a)
        doc_b = np.repeat(np.arange(n), n_b)
        n_groups = np.bincount(doc_b[np.diff(b_group, prepend=-1) > 0], minlength=n)
        width = last - first + 1
        n_links = np.bincount(doc_a, width, n).astype(np.int64)
        code = np.repeat((doc_a << 32) + a_ids * self.n_b, width) + b_ids[_ranges(first, last + 1)]
        code, links = np.unique(code, return_counts=True)
        return n_a, n_b, n_groups, n_links, texts, code >> 32, code & 0xFFFFFFFF, links


def _packed(numbers: np.ndarray) -> bytes:
    """Four-byte numbers, byte planes apart, compressed."""
    import zstandard
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


_CHUNK = f"chunk bigint, docs array<{DOC}>, ranks binary, links binary, pairs array<bigint>, held array<bigint>"


class _Chunk:
    """The documents of one row, and their pairs."""

    def __init__(self, aligner: Aligner, digests: bool):
        self.aligner, self.digests = aligner, digests
        self.docs: list[dict] = []
        self.doc: list[np.ndarray] = []
        self.pair: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def add(self, ids: list[int | None], texts: list[str | None]) -> None:
        found = [self.aligner.tokens(t) if t else None for t in texts]
        some = [k for k, f in enumerate(found) if f]
        base = len(self.docs)
        self.docs += [dict(id=i, n_a=0, n_b=0, n_groups=0, n_links=0, groups="", n_pairs=0) for i in ids]
        if not some:
            return
        n_a, n_b, n_groups, n_links, groups, doc, pair, links = self.aligner.align([found[k] for k in some])
        n_pairs = np.bincount(doc, minlength=len(some))
        for j, k in enumerate(some):
            text = hashlib.sha256(groups[j]).hexdigest() if self.digests else groups[j].decode()
            self.docs[base + k].update(n_a=int(n_a[j]), n_b=int(n_b[j]), n_groups=int(n_groups[j]),
                                       n_links=int(n_links[j]), groups=text, n_pairs=int(n_pairs[j]))
        self.pair.append(pair.astype(np.uint32))
        self.links.append(links.astype(np.uint32))

    def row(self, number: int) -> pa.RecordBatch:
        none = np.zeros(0, np.uint32)
        pair, links = (np.concatenate(x or [none]) for x in (self.pair, self.links))
        pairs, rank, held = np.unique(pair, return_inverse=True, return_counts=True)
        rank = rank.astype(np.int64)
        step = np.diff(rank, prepend=0)
        n = np.array([d["n_pairs"] for d in self.docs], np.int64)
        starts = (np.cumsum(n) - n)[n > 0]
        step[starts] = rank[starts]  # a document starts anew

        def listed(x):
            return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), listed(pa.array(self.docs, _DOC)), pa.array([_packed(step)], pa.binary()),
             pa.array([_packed(links)], pa.binary()), listed(pa.array(pairs.astype(np.int64))),
             listed(pa.array(held.astype(np.int64)))],
            names=["chunk", "docs", "ranks", "links", "pairs", "held"])


def chunks(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
           digests: bool = False) -> DataFrame:
    """One row per chunk of texts; see the module's text."""
    with open(b_path, "rb") as f:
        parts = (byte_vocabulary(a_path), piece_bytes(b_path), f.read())
    sent = df.sparkSession.sparkContext.broadcast(parts)  # the two vocabularies, about 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, aligner, chunk, size = TaskContext.get().partitionId() << 32, None, None, 0
        for b in batches:
            aligner = aligner or Aligner(*sent.value)
            n_bytes = np.diff(np.frombuffer(b.column(1).buffers()[1], np.int32, len(b) + 1, 4 * b.column(1).offset))
            ends, start = np.cumsum(n_bytes.astype(np.int64)), 0
            while start < len(b):
                done = ends[start - 1] if start else 0
                stop = min(len(b), 1 + int(np.searchsorted(ends, done + SLICE_BYTES)))
                chunk = chunk or _Chunk(aligner, digests)
                chunk.add(b.column(0).slice(start, stop - start).to_pylist(),
                          b.column(1).slice(start, stop - start).to_pylist())
                size += int(ends[stop - 1] - done)
                start = stop
                if size >= CHUNK_BYTES:
                    yield chunk.row(number)
                    number, chunk, size = number + 1, None, 0
        if chunk:
            yield chunk.row(number)
    rows = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _CHUNK)


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """pair (A id * ``n_b`` + B id), docs (documents that hold it) and best (whether no
    pair of that A id is held by more) over all chunks."""
    each = rows.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).select("p.pairs", "p.held")
    total = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("docs"))
    of_a = Window.partitionBy(F.floor(F.col("pair") / n_b))  # at most n_b rows
    return total.withColumn("best", F.col("docs") == F.max("docs").over(of_a))


_RESULT = pa.schema([("id", pa.int64()), *[(n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
                     ("groups", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """A chunk and the counts of its pairs: the documents' rows with their sums."""
    docs = left.column("docs").chunk(0).flatten()
    rank, links = (_unpacked(left.column(c)[0].as_py()) for c in ("ranks", "links"))
    n = docs.field("n_pairs").to_numpy()
    starts = np.cumsum(n) - n
    total = np.cumsum(rank)
    some = n > 0
    rank = total - np.repeat(total[starts[some]] - rank[starts[some]], n[some])
    pair = right.column("pair").to_numpy()
    order = np.argsort(pair)
    held = right.column("docs").to_numpy()[order]
    best = right.column("best").to_numpy()[order].astype(np.int64)

    def per_doc(x):
        sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(x)))
        return pa.array(sums[starts + n] - sums[starts])
    return pa.table([*[docs.field(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups")],
                     per_doc(best[rank] * links), per_doc(held[rank] * links)], schema=_RESULT)


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          digests: bool = False) -> DataFrame:
    """Per row of ``df``: its id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;...``,
    or with ``digests`` the hex SHA-256 of that), n_best and count_sum."""
    rows = written(chunks(df, a_path, b_path, id_col, text_col, digests), "aligned")
    counts = pair_counts(rows, len(piece_bytes(b_path)))
    asked = rows.select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair")).join(counts, "pair")
    out = rows.select("chunk", "docs", "ranks", "links").groupBy("chunk").cogroup(
        asked.groupBy("of")).applyInArrow(
            _summed, "id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
                     "n_best bigint, count_sum bigint")
    return out.withColumnRenamed("id", id_col)


def group_arrays(groups: Column) -> Column:
    """The groups text as an array of structs of two id arrays."""
    def ids(text):
        return F.split(text, ",").cast("array<int>")
    one = F.transform(F.split(groups, ";"), lambda g: F.struct(
        ids(F.split_part(g, F.lit("|"), F.lit(1))).alias("a"), ids(F.split_part(g, F.lit("|"), F.lit(2))).alias("b")))
    return F.when(groups == "", F.array().cast("array<struct<a:array<int>,b:array<int>>>")).otherwise(one)
