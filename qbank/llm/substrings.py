"""Substring de-duplication: windows of words that an earlier document has, removed.

Every window of ``WINDOW`` words gets a Rabin-Karp hash. A window is repeated when
its words also start in a document with a smaller id; repeated windows merge into
maximal intervals, and their words go.

Counting takes two steps, so that windows which occur once are not shuffled:

1. The anchor of a window is the smallest hash of its runs of ``ANCHOR`` words, so
   equal windows have equal anchors, and neighbouring windows mostly share theirs.
   Runs of windows with one anchor are counted; those whose anchor is in two or more
   documents go on. This drops nothing that could repeat.
2. The windows of those runs are hashed (64 + 32 bits) and counted.

A counting step deals keys over hash groups whose number follows the input (about
``GROUP_ENTRIES`` a group). Map tasks sort a few megabytes of text at a time, settle
what they can see themselves and send one packed row per group, in which a key
stands once however often the text repeats it; so a passage in a third of all
documents weighs one entry per few megabytes.

Edge cases: null and empty texts have no words; documents shorter than a window lose
nothing; rows without an id are neither cut nor compared; rows that repeat an id are
not smaller than one another, and each is cut by its own text (where the texts of an id
differ, a hash of the text tells its rows apart); an empty table gives an empty result; other columns
don't matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qbank.llm import rolling
from qbank.llm.common import named, written

WINDOW, ANCHOR = 13, 6
GROUP_ENTRIES = 1_000_000
#: Small inputs have this many groups, so that their tasks stay small too.
LEAST_GROUPS = 64
CHUNK_BYTES = 4 << 20
#: Bits of a position that hold the length of a run.
RUN_BITS = 8


# -- packed rows: byte planes, so that the shuffle's compression finds the zeros ----

def _planes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()


def _steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=np.zeros(1, a.dtype))


def _same(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """The number of each entry's run of equal (key, check) in sorted entries."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    return np.cumsum(new) - 1


def _spread(run: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest id of each entry's run."""
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    return np.minimum.reduceat(ids, starts)[run], np.maximum.reduceat(ids, starts)[run]


_ROWS = pa.schema([("group", pa.int64()), ("keys", pa.binary()), ("checks", pa.binary()), ("docs", pa.binary()), ("rows", pa.binary()),
                   ("entry_doc", pa.binary()), ("places", pa.binary()), ("known", pa.binary()),
                   ("done_id", pa.int64()), ("done_row", pa.int64()), ("done", pa.list_(pa.int64()))])
_SQL_ROWS = ("group bigint, keys binary, checks binary, docs binary, rows binary, entry_doc binary, places binary, "
             "known binary, done_id bigint, done_row bigint, done array<bigint>")


def _settled(ids: np.ndarray, rows: np.ndarray, places: np.ndarray):
    """(id, row, its places) for entries in any order."""
    if not len(ids):
        return [], [], []
    order = np.lexsort((rows, ids))
    ids, rows, places = ids[order], rows[order], places[order]
    at = np.flatnonzero(np.diff(_same(ids, rows), prepend=-1))
    return ids[at], rows[at], np.split(places, at[1:])


def _docs(ids: np.ndarray, rows: np.ndarray):
    """The distinct (id, row) in order, and which of them each entry has."""
    if not rows.any():
        docs, at = np.unique(ids, return_inverse=True)
        return docs, np.zeros(len(docs), np.int64), at
    order = np.lexsort((rows, ids))
    run = _same(ids[order], rows[order])
    at = np.empty(len(ids), np.int64)
    at[order] = run
    first = order[np.flatnonzero(np.diff(run, prepend=-1))]
    return ids[first], rows[first], at


def _deal(key, check, ids, own, places, n_groups: int, later: bool) -> pa.RecordBatch:
    """One chunk's entries as packed rows, plus rows of what is settled already.
    ``own`` tells rows of one id apart; only ids are compared.

    ``later``: wanted are entries that a smaller id has too; else entries whose key
    two or more ids have.
    """
    order = np.lexsort((places, ids, check, key))
    key, check, ids, own, places = key[order], check[order], ids[order], own[order], places[order]
    run = _same(key, check)
    low, high = _spread(run, ids)
    rows = {n: [] for n in _ROWS.names}
    if later:
        done, send, known = ids > low, ids == low, np.zeros(len(ids), bool)
    else:
        done = low < high
        known = done
        send = ~done | (np.diff(run, prepend=-1) > 0)

    def add(**row):
        for n in rows:
            rows[n].append(row.get(n))
    for i, (who, row, where) in enumerate(zip(*_settled(ids[done], own[done], places[done]))):
        # any group will do: spread them
        add(group=int((int(who) * 2654435761 + i) % n_groups), done_id=int(who), done_row=int(row), done=where)
    key, check, ids, own, places, known = (x[send] for x in (key, check, ids, own, places, known))
    width = (1 << 64) // n_groups + 1
    group = (key // np.uint64(width)).astype(np.int64)
    for a, z in zip(*(lambda c: (c, np.append(c[1:], len(group))))(np.flatnonzero(np.diff(group, prepend=-1)))):
        docs, doc_rows, at = _docs(ids[a:z], own[a:z])
        add(group=int(group[a]), keys=_planes(_steps(key[a:z])), checks=_planes(check[a:z]),
            docs=_planes(_steps(docs)), rows=_planes(doc_rows), entry_doc=_planes(at), places=_planes(places[a:z]),
            known=np.packbits(known[a:z]).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in _ROWS], schema=_ROWS)


def _settle(later: bool):
    """applyInArrow body over the packed rows of a group: rows (id, row, places)."""
    def run(table: pa.Table) -> pa.Table:
        ids, rows, places = [], [], []
        key, check, doc, own, place, known = [], [], [], [], [], []
        for row in table.to_pylist():
            if row["keys"] is None:
                ids.append(row["done_id"])
                rows.append(row["done_row"])
                places.append(row["done"])
                continue
            k = np.cumsum(_unplanes(row["keys"]))
            key.append(k)
            check.append(_unplanes(row["checks"]))
            at = _unplanes(row["entry_doc"]).astype(np.int64)
            doc.append(np.cumsum(_unplanes(row["docs"]).astype(np.int64))[at])
            own.append(_unplanes(row["rows"]).astype(np.int64)[at])
            place.append(_unplanes(row["places"]).astype(np.int64))
            known.append(np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(k)).astype(bool))
        if key:
            key, check, doc, own, place, known = map(np.concatenate, (key, check, doc, own, place, known))
            order = np.lexsort((check, key))
            key, check, doc, own, place, known = (x[order] for x in (key, check, doc, own, place, known))
            same = _same(key, check)
            low, high = _spread(same, doc)
            if later:
                out = doc > low
            else:
                some = np.logical_or.reduceat(known, np.flatnonzero(np.diff(same, prepend=-1)))[same]
                out = ((low < high) | some) & ~known
            who, which, where = _settled(doc[out], own[out], place[out])
            ids += list(who)
            rows += list(which)
            places += where
        return pa.table({"id": pa.array(ids, pa.int64()), "row": pa.array(rows, pa.int64()),
                         "places": pa.array(places, pa.list_(pa.int64()))})
    return run


def _runs_of(first: np.ndarray, doc: np.ndarray, anchor: np.ndarray):
    """Starts (indexes of windows) and lengths of runs with one anchor in one text."""
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    # a run longer than its length can say is cut
    n = np.diff(np.append(at, len(anchor)))
    most = 1 << RUN_BITS
    if len(n) and n.max() > most:
        pieces = -(-n // most)
        k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(at, pieces) + k * most
        n = np.diff(np.append(at, len(anchor)))
    return at, n


def _chunk_rows(batches, most=CHUNK_BYTES):
    """(ids, texts as bytes, further columns) of about ``most`` bytes at a time."""
    held, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in b.slice(at, 256).columns)):
                text = (row[1] or "").encode()
                held.append((row[0], text, *row[2:]))
                size += len(text)
                if size >= most:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def _sliding_min(a: np.ndarray, k: int) -> np.ndarray:
    """The minima of every ``k`` neighbours."""
    n = len(a) - k + 1
    out, have = a, 1
    while have < k:
        step = min(have, k - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out[:n]


def _anchor_rows(n_groups: int):
    def run(batches):
        for rows in _chunk_rows(batches):
            key, ids, own, places = [], [], [], []
            at = 0
            for _, group in rolling.groups([r[1].decode() for r in rows]):
                h, doc, _, _ = rolling.words(group)
                grams, gram_first = rolling.windows(h, doc, ANCHOR)
                k = WINDOW - ANCHOR + 1
                if len(grams) >= k:
                    low = _sliding_min(grams, k)
                    d = doc[gram_first]
                    inside = d[:len(low)] == d[k - 1:]
                    anchor, first, d = low[inside], gram_first[:len(low)][inside], d[:len(low)][inside]
                    start, n = _runs_of(first, d, anchor)
                    begin = np.searchsorted(doc, np.arange(len(group)))  # a text's first word
                    key.append(anchor[start])
                    ids.append(np.array([r[0] for r in rows[at:at + len(group)]], np.int64)[d[start]])
                    own.append(np.array([r[2] for r in rows[at:at + len(group)]], np.int64)[d[start]])
                    places.append(((first[start] - begin[d[start]]) << RUN_BITS) | (n - 1))
                at += len(group)
            if key:
                key, ids, own, places = map(np.concatenate, (key, ids, own, places))
                if len(key):
                    yield _deal(key, np.zeros(len(key), np.uint64), ids, own, places, n_groups, False)
    return run


def _window_rows(n_groups: int):
    """The windows of the runs in a text's fourth column."""
    def run(batches):
        for rows in _chunk_rows(batches):
            key, check, ids, own, places = [], [], [], [], []
            for i, text, row, runs in rows:
                h, doc, _, _ = rolling.words([text])
                w, _ = rolling.windows(h, doc, WINDOW)
                v, _ = rolling.windows(rolling.mix64(h ^ np.uint64(0xA5A5_1234_9876_5A5A)), doc, WINDOW)
                r = np.array(runs, np.int64)
                first, n = r >> RUN_BITS, (r & ((1 << RUN_BITS) - 1)) + 1
                pos = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
                key.append(w[pos])
                check.append(v[pos] >> np.uint64(32))
                places.append(pos)
                ids.append(np.full(len(pos), i, np.int64))
                own.append(np.full(len(pos), row, np.int64))
            if key:
                yield _deal(*map(np.concatenate, (key, check, ids, own, places)), n_groups, True)
    return run


def repeated_windows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with an id: id, text, row; their repeated windows: id, row, starts, the
    first words of the windows). ``row`` is 0, or the text's hash where an id has several
    texts."""
    docs = df.where(named(id_col).isNotNull()).select(named(id_col).cast("bigint").alias("id"),
                                                      F.coalesce(named(text_col), F.lit("")).alias("text"))
    texts = docs.select("id", F.xxhash64("text").alias("h")).groupBy("id").agg(F.min("h").alias("a"), F.max("h").alias("z"))
    several = written(texts.where("a < z").select("id", F.lit(True).alias("several")), "substring-ids")
    docs = docs.join(several, "id", "left").select(
        "id", "text", F.when(F.col("several"), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint")).alias("row"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about six bytes a word; an anchor for every 4.5 windows
    per = lambda x: max(LEAST_GROUPS, math.ceil(size / x / GROUP_ENTRIES))
    gathered = "id bigint, row bigint, places array<bigint>"

    def gather(dealt: DataFrame, later: bool, name: str) -> DataFrame:
        found = dealt.groupBy("group").applyInArrow(_settle(later), gathered)
        return found.groupBy("id", "row").agg(F.flatten(F.collect_list("places")).alias(name))
    runs = gather(docs.mapInArrow(_anchor_rows(per(27)), _SQL_ROWS), False, "runs")
    # both joins with the texts read one shuffle of them
    candidates = docs.join(runs, ["id", "row"]).select("id", "text", "row", "runs")
    return docs, gather(candidates.mapInArrow(_window_rows(per(6)), _SQL_ROWS), True, "starts")


def _intervals(starts: list[int] | None, size: int) -> list[tuple[int, int]]:
    """Maximal intervals of words (end exclusive) that windows at ``starts`` cover."""
    out: list[tuple[int, int]] = []
    for s in sorted(starts or []):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + size)
        else:
            out.append((s, s + size))
    return out


def _cut(text: str, starts) -> tuple[int, int, str]:
    """(words, words removed, the words that stay joined by spaces)."""
    words = text.encode().split()  # the six ASCII white characters
    kept, at, gone = [], 0, 0
    for a, z in _intervals(starts, WINDOW):
        kept += words[at:a]
        at, gone = z, gone + z - a
    kept += words[at:]
    return len(words), gone, b" ".join(kept).decode()


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """Per row of ``df``: the id, n_words, n_removed and the text that is left, its
    words joined by single spaces (with ``digests``: its sha256 as kept_sha256)."""
    docs, repeated = repeated_windows(df, id_col, text_col)
    name = "kept_sha256" if digests else "kept_text"

    def run(batches):
        for b in batches:
            cut = [_cut(t or "", s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            left = [hashlib.sha256(c[2].encode()).hexdigest() if digests else c[2] for c in cut]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([c[0] for c in cut], pa.int64()), pa.array([c[1] for c in cut], pa.int64()),
                 pa.array(left, pa.string())], names=[id_col, "n_words", "n_removed", name])
    none = df.where(named(id_col).isNull()).select(
        F.lit(None).cast("bigint").alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"),
        F.lit(None).cast("array<bigint>").alias("starts"))
    rows = docs.join(repeated, ["id", "row"], "left").select("id", "text", "starts").union(none)
    return rows.mapInArrow(run, f"`{id_col}` bigint, n_words bigint, n_removed bigint, {name} string")
