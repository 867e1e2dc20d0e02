"""SentencePiece BPE encoding and decoding by suffix-array matching.

A text is normalized as the model asks (a leading mark for a space, spaces to marks)
and falls into units that no piece spans: a run of marks with the characters after
it, and single line feeds. Units repeat, so a task encodes each once and keeps it.

The new units of a batch are concatenated and indexed: a suffix array, sorted as deep
as the longest piece, in which every piece is found by binary search, giving its
range of occurrences. The ranges become edges (start, length, piece), sorted by
position. Relaxing then joins symbols along edges: in every unit the best-scored edge
over two neighbouring symbols (the leftmost of equals) is taken, until none is left,
for all units in step; units of over ``LONG_UNIT`` characters use a heap. Characters
without a piece become byte pieces. The ids are those of the sentencepiece library.

Decoding joins pieces and bytes and drops the leading mark. Edge cases: null and
empty texts have no ids and decode to the empty text; a literal mark (U+2581) in a
text decodes to a space, as in the library; repeated rows are encoded alike; an empty
table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qbank.llm.common import named

MARK = "▁"
#: Characters of new units that are indexed at a time.
INDEX_CHARS = 1 << 19
LONG_UNIT = 200
UNIT_STORE = 200_000
GAP = 0x10FFFF  # stands between units; no piece holds it
_NONE = np.int64(1) << 62


@dataclass
class Model:
    """What encoding needs of a model: the pieces that text can match, with their
    ranks (0: joined first), the ids of the 256 byte pieces, and every id's bytes."""
    pieces: list[str]
    ids: list[int]
    ranks: list[int]
    byte_ids: list[int]
    id_bytes: list[bytes]

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))


def load_model(path: str) -> Model:
    """Read a BPE model file with byte fallback."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ids, scores, bytes_of = [], [], [], []
    byte_ids = [0] * 256
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(p[3:5], 16)] = i
            bytes_of.append(bytes([int(p[3:5], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            bytes_of.append(b"")
        else:
            if MARK in p.lstrip(MARK) or ("\n" in p and p != "\n"):
                raise ValueError(f"a piece spans units: {p!r}")
            pieces.append(p)
            ids.append(i)
            scores.append(sp.get_score(i))
            bytes_of.append(p.replace(MARK, " ").encode())
    ranks = np.unique(-np.array(scores), return_inverse=True)[1]
    return Model(pieces, ids, ranks.tolist(), byte_ids, bytes_of)


def normalize(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


_UNITS = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of every [low, high), end to end."""
    n = high - low
    return np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)


class SuffixIndex:
    """Suffix array of a code array, sorted ``depth`` characters deep."""

    def __init__(self, codes: np.ndarray, depth: int):
        self.alphabet, dense = np.unique(codes, return_inverse=True)
        self.n = len(codes)
        self.bits = max(1, int(len(self.alphabet)).bit_length())
        self.width = 62 // self.bits  # characters that fit one sortable number
        padded = np.zeros(self.n + depth + self.width, np.int64)
        padded[:self.n] = dense + 1
        self.block = np.zeros(self.n + depth, np.int64)
        for k in range(self.width):
            self.block = (self.block << self.bits) | padded[k:k + self.n + depth]
        rank, have = np.unique(self.block[:self.n], return_inverse=True)[1], self.width
        while have < depth:
            after = np.zeros(self.n, np.int64)
            after[:max(0, self.n - have)] = rank[have:] + 1
            rank = np.unique(rank * np.int64(self.n + 2) + after, return_inverse=True)[1]
            have *= 2
        self.suffixes = np.argsort(rank, kind="stable")

    def find(self, pieces: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[low, high) of the suffixes that start with each piece: rows of character
        numbers (1 up, padded with 0). Binary search, a block of characters at a time."""
        low, high = np.zeros(len(lens), np.int64), np.full(len(lens), self.n, np.int64)
        one = np.int64((1 << self.bits) - 1)
        for at in range(0, int(lens.max(initial=0)), self.width):
            least, most = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
            for k in range(at, at + self.width):
                c = pieces[:, k] if k < pieces.shape[1] else np.zeros(len(lens), np.int64)
                least = (least << self.bits) | np.where(k < lens, c, 0)
                most = (most << self.bits) | np.where(k < lens, c, one)
            low, high = self._edge(low, high, least, at, False), self._edge(low, high, most, at, True)
        return low, high

    def _edge(self, low, high, want, at, after):
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            seen = self.block[self.suffixes[np.minimum(mid, self.n - 1)] + at]
            right = open_ & ((seen <= want) if after else (seen < want))
            low = np.where(right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)
        return low


class Encoder:
    def __init__(self, model: Model):
        self.m = model
        self.depth = model.longest
        self.lens = np.array([len(p) for p in model.pieces], np.int64)
        self.codes = np.zeros((len(model.pieces), self.depth), np.int64)
        for k, p in enumerate(model.pieces):
            self.codes[k, :len(p)] = [ord(c) for c in p]
        self.rank_of = np.array(model.ranks, np.int64)
        self.id_of = np.array(model.ids, np.int64)
        self.byte_ids = np.array(model.byte_ids, np.uint32)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    # -- matching ---------------------------------------------------------------
    def _edges(self, codes: np.ndarray) -> np.ndarray:
        """piece[start * depth + length - 1], or -1: the edges in order of position."""
        index = SuffixIndex(codes, self.depth)
        place = np.searchsorted(index.alphabet, self.codes)
        place = np.minimum(place, len(index.alphabet) - 1)
        inside = np.arange(self.depth) < self.lens[:, None]
        here = ((index.alphabet[place] == self.codes) | ~inside).all(1)
        which = np.flatnonzero(here)
        low, high = index.find(np.where(inside, place + 1, 0)[which], self.lens[which])
        n = high - low
        start = index.suffixes[_ranges(low, high)]
        length = np.repeat(self.lens[which], n)
        piece = np.repeat(which, n)
        edge = np.full((len(codes) + 1) * self.depth, -1, np.int32)
        edge[start * self.depth + length - 1] = piece
        return edge

    def _rank(self, edge: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The rank of joining [start, end), _NONE where no edge spans it."""
        n = end - start
        ok = (n > 0) & (n <= self.depth)
        piece = edge[np.where(ok, start * self.depth + n - 1, 0)]
        ok &= piece >= 0
        return np.where(ok, self.rank_of[piece], _NONE)

    # -- relaxing ---------------------------------------------------------------
    def _relax(self, edge: np.ndarray, n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """after[p]: the end of the symbol that starts at p, 0 where none starts."""
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        before[first] = -1
        short = np.flatnonzero(last - first <= LONG_UNIT)
        for k in np.flatnonzero(last - first > LONG_UNIT):
            self._relax_long(edge, int(first[k]), int(last[k]), after)
        # best[p]: rank of joining the symbols at p and after it, then p itself
        bits = max(1, int(n).bit_length())
        at = _ranges(first[short], last[short])
        limit = np.zeros(n + 1, np.int64)  # the end of the unit that holds a position
        limit[_ranges(first, last)] = np.repeat(last, last - first)
        best = np.full(n + 1, _NONE)

        def join(p: np.ndarray) -> np.ndarray:
            """The best key of symbols at p with their right neighbours."""
            mid = after[p]
            end = np.where(mid < limit[p], after[np.minimum(mid, n - 1)], 0)
            r = self._rank(edge, p, end)
            return np.where(r < _NONE, (r << bits) | p, _NONE)
        best[at] = join(at)
        # each round looks at the units that may still join something
        unit_of = np.repeat(np.arange(len(short)), (last - first)[short])
        while len(at):
            starts = np.flatnonzero(np.diff(unit_of, prepend=-1))
            top = np.minimum.reduceat(best[at], starts)
            go = top < _NONE
            if not go.any():
                break
            p = top[go] & ((1 << bits) - 1)
            mid = after[p]
            end = after[mid]
            after[p], after[mid], best[mid] = end, 0, _NONE
            right = end < limit[p]
            before[end[right]] = p[right]
            best[p] = join(p)
            left = before[p]
            left = left[left >= 0]
            best[left] = join(left)
            stay = np.repeat(go, np.diff(np.append(starts, len(at)))) & (after[at] > 0)
            at, unit_of = at[stay], unit_of[stay]
        return after

    def _relax_long(self, edge: np.ndarray, a: int, z: int, after: np.ndarray) -> None:
        """The same for one long unit, with a heap of possible joins."""
        depth, rank_of = self.depth, self.rank_of
        nxt = list(range(a + 1, z + 1))
        prev = list(range(a - 1, z - 1))

        def push(p: int) -> None:
            mid = nxt[p - a]
            if mid < z:
                end = nxt[mid - a]
                if end - p <= depth and (piece := edge[p * depth + end - p - 1]) >= 0:
                    heapq.heappush(heap, (int(rank_of[piece]), p, mid, end))
        heap: list[tuple[int, int, int, int]] = []
        for p in range(a, z):
            push(p)
        while heap:
            _, p, mid, end = heapq.heappop(heap)
            if nxt[p - a] != mid or mid >= z or nxt[mid - a] != end:
                continue  # one of the two has joined another meanwhile
            nxt[p - a], nxt[mid - a] = end, 0
            if end < z:
                prev[end - a] = p
            push(p)
            if prev[p - a] >= a:
                push(prev[p - a])
        after[a:z] = nxt

    # -- ids ----------------------------------------------------------------------
    def _segment(self, units: list[str]) -> None:
        """Append the ids of ``units`` to the store."""
        gap = chr(GAP)
        codes = np.frombuffer((gap.join(units) + gap).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        size = np.array([len(u) for u in units], np.int64)
        first = np.cumsum(size + 1) - size - 1
        last = first + size
        edge = self._edges(codes)
        after = self._relax(edge, len(codes), first, last)
        inside = np.zeros(len(codes), bool)
        inside[_ranges(first, last)] = True
        at = np.flatnonzero(inside & (after > 0))
        piece = edge[at * self.depth + after[at] - at - 1].astype(np.int64)
        cp = codes[at]
        width = np.where(piece >= 0, 1, 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000))
        to = np.cumsum(width) - width
        out = np.zeros(int(width.sum()), np.uint32)
        whole = piece >= 0
        out[to[whole]] = self.id_of[piece[whole]]
        for n in range(1, 5):  # UTF-8 bytes of characters without a piece
            some = ~whole & (width == n)
            c = cp[some]
            for k in range(n):
                byte = (c >> (6 * (n - 1 - k))) & 0x3F | 0x80 if n > 1 else c
                if k == 0 and n > 1:
                    byte = (c >> (6 * (n - 1))) | (0xF0 << (4 - n) & 0xFF)
                out[to[some] + k] = self.byte_ids[byte]
        unit = np.searchsorted(first, at, "right") - 1
        sizes = np.bincount(unit, width, len(units)).astype(np.int64)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.ids = np.concatenate((self.ids, out))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.known) > UNIT_STORE:
            self.clear()
        known, new, new_chars = self.known, [], 0
        numbers = []
        for t in texts:
            found = _UNITS.findall(normalize(t))
            row = np.empty(len(found), np.int64)
            for k, u in enumerate(found):
                n = known.get(u)
                if n is None:
                    n = known[u] = len(known)
                    new.append(u)
                    new_chars += len(u) + 1
                row[k] = n
            numbers.append(row)
            if new_chars >= INDEX_CHARS:
                self._segment(new)
                new, new_chars = [], 0
        if new:
            self._segment(new)
        out = []
        for u in numbers:
            out.append(self.ids[_ranges(self.starts[u], self.starts[u] + self.sizes[u])])
        return out


def decode_ids(model_bytes: list[bytes], ids) -> str:
    """The text of a list of ids; unknown and control ids have no text."""
    text = b"".join(model_bytes[i] if 0 <= i < len(model_bytes) else b"" for i in ids).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _text_groups(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    first, group, size = 0, [], 0
    for k in range(len(column)):
        t = column[k].as_py() or ""
        group.append(t)
        size += len(t)
        if size >= most or k + 1 == len(column):
            yield first, group
            first, group, size = k + 1, [], 0


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           keep_text: bool = False) -> DataFrame:
    """Per row of ``df``: the id, n_pieces and ids (with ``keep_text`` the text too)."""
    model = df.sparkSession.sparkContext.broadcast(vars(load_model(model_path)))  # about 3 MB

    def run(batches):
        enc = None
        for b in batches:
            enc = enc or Encoder(Model(**model.value))
            for first, group in _text_groups(b.column(1)):
                found = enc.encode(group)
                edges = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                flat = np.concatenate(found).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(group)), pa.array(np.diff(edges), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(edges), pa.array(flat)),
                     *([b.column(1).slice(first, len(group))] if keep_text else [])],
                    names=["id", "n_pieces", "ids", *(["text"] if keep_text else [])])
    rows = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    shape = "id bigint, n_pieces bigint, ids array<int>" + (", text string" if keep_text else "")
    return rows.mapInArrow(run, shape).withColumnRenamed("id", id_col)


def decoded(df: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids (null ids: null)."""
    pieces = df.sparkSession.sparkContext.broadcast(load_model(model_path).id_bytes)

    @F.pandas_udf("string")
    def text(ids):
        return ids.map(lambda x: None if x is None else decode_ids(pieces.value, x.tolist()))
    return df.withColumn(out, text(named(ids_col)))


def reads_back(text: Column, back: Column) -> Column:
    """Whether a decoded text is the text, literal marks counting as spaces."""
    return back == F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" "))
