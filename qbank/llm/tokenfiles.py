"""Token-id files: one zstandard frame per document under a shared dictionary.

A token folder has three Parquet parts, so any store that Spark writes can hold it:

* ``dictionary``: one row, the dictionary's bytes and their sha256 (its hash);
* ``blocks``: rows of at most about ``BLOCK_BYTES``: ``part`` and ``block`` in the
  order of the documents, the dictionary hash, and ``blob``, the frames end to end.
  A frame holds one document's ids, little-endian, two or four bytes each;
* ``index``: per document part, block, offset, length, n_tokens and start (the ids
  of all documents before it), sorted by id for short-document access.

A file of ``blocks`` has one part and a Parquet page for each row, so a reader that
filters by part and block skips the other files' pages and the other blocks; only
the files' footers are read of all.

The dictionary is trained on the serialized ids of a bounded sample: the
``SAMPLE_DOCS`` ids with the smallest hashes, of which at most ``SAMPLE_BYTES``,
no document over 64 KB.
Every document of the table is then encoded whole and compressed by itself.

Words (runs without ASCII white space) are encoded once per ``CHUNK_BYTES`` of texts: no
token spans white space, so a text's ids are those of its words in order.

Edge cases: a null text is empty and holds just the end id; null ids come first;
rows with equal ids keep a fixed order by content; an empty table makes a folder
with an empty index; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qbank.llm.common import named, unit_hash

SAMPLE_DOCS = 1000
SAMPLE_BYTES = 4 << 20
DICT_BYTES = 32 << 10
BLOCK_BYTES = 1 << 20
LEVEL = 3
#: Bytes of text that are encoded at once, their distinct words once.
CHUNK_BYTES = 4 << 20
#: Other units than Latin ones kept per worker before the store is emptied.
WORD_STORE = 200_000
#: Closing punctuation that is a unit of its own after letters.
TAIL = ".,!?;:"


#: Letters that are letters to any library, fixed under NFC, with one lower-case letter.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
#: A word of such letters and closing punctuation, to Arrow.
PLAIN = f"^{LATIN.pattern}[{TAIL}]*$"
CLOSE = "\x01"


def _joins(spec: dict):
    """The merges of a lower-casing BPE over bytes with word ends as a ``tiktoken``
    encoding of words that ``CLOSE`` ends, or None."""
    model, norm = spec["model"], spec.get("normalizer") or {}
    kinds = {n["type"] for n in norm.get("normalizers", [norm]) if n}
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = {t: i for t, i in model.get("vocab", {}).items() if t not in special}
    if model.get("end_of_word_suffix") != "</w>" or "Lowercase" not in kinds or not kinds <= {"NFC", "Replace", "Lowercase"}:
        return None
    import tiktoken

    from qbank.llm.align import byte_alphabet
    alphabet, mark = byte_alphabet(), CLOSE.encode()
    ranks = {}
    for t, i in vocab.items():
        word = t.removesuffix("</w>")
        if not word or not set(word) <= alphabet.keys():
            return None
        ranks[bytes(alphabet[c] for c in word) + (mark if t != word else b"")] = i
    if len(ranks) < len(vocab) or any(vocab.get(c, 512) >= 512 or vocab.get(c + "</w>", 512) >= 512 for c in alphabet):
        return None
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged) or min(merged, default=512) < 512:
        return None
    return tiktoken.Encoding("words", pat_str=f"[^{CLOSE}]+{CLOSE}", mergeable_ranks=ranks, special_tokens={})


class WordEncoder:
    """Ids of texts by way of their distinct words.

    A word of plain Latin letters (``LATIN``) is one unit to the tokenizer, and closing
    punctuation after it a second one, so such words share their units; any other word
    is a unit itself. Latin units are joined by the ``tiktoken`` library, where a mark
    (``CLOSE``) stands for the end of a word and is joined to its last letter first:
    the tokenizer's own merges, in the same order. All else, and all units of tokenizers
    that are not of this kind, go to the tokenizer, and are kept in a store.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.closes = np.zeros(self.tok.get_vocab_size() + 1, bool)
        self.closes[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
        self.joins = _joins(json.loads(tokenizer_json))
        self.clear()

    def clear(self) -> None:
        self.store: dict[str, np.ndarray] = {}

    def _each(self, units: list[str]) -> list[np.ndarray]:
        if len(self.store) > WORD_STORE:
            self.clear()
        new = [u for u in units if u not in self.store]
        for u, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False)):
            self.store[u] = np.array(e.ids, np.uint32)
        return [self.store[u] for u in units]

    def _letters(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Units of Latin letters: encoded as one text, measured where a unit closes."""
        if not len(units):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(units)], pa.int32()), units), CLOSE)
        ids = self.joins.encode_to_numpy(whole[0].as_py().lower() + CLOSE)
        return ids, np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words end to end, and how many each has."""
        if self.joins:
            plain = pc.match_substring_regex(words, PLAIN)
            core = pc.if_else(plain, pc.utf8_rtrim(words, TAIL), words)
            closed = pc.and_(plain, pc.not_equal(pc.binary_length(core), pc.binary_length(words)))
            plain, closed = (x.to_numpy(zero_copy_only=False) for x in (plain, closed))
        else:
            core, plain, closed = words, np.zeros(len(words), bool), np.zeros(len(words), bool)
        tails = pc.replace_substring_regex(words.filter(pa.array(closed)), f"^{LATIN.pattern}", "").dictionary_encode()
        core = core.dictionary_encode()
        latin = np.zeros(len(core.dictionary), bool)
        latin[core.indices.to_numpy()[plain]] = True
        ids_a, lens_a = self._letters(core.dictionary.filter(pa.array(latin)))
        others = self._each(core.dictionary.filter(pa.array(~latin)).to_pylist() + tails.dictionary.to_pylist())
        ids = np.concatenate([ids_a, *others])
        lens = np.concatenate((lens_a, np.fromiter(map(len, others), np.int64, len(others)), [0]))
        starts = np.cumsum(lens) - lens
        place = np.empty(len(latin), np.int64)  # of a core among all units
        place[latin], place[~latin] = np.arange(len(lens_a)), len(lens_a) + np.arange(len(latin) - len(lens_a))
        units = np.full((len(words), 2), len(lens) - 1)  # the last unit is the empty one
        units[:, 0] = place[core.indices.to_numpy()]
        units[closed, 1] = len(latin) + tails.indices.to_numpy()
        return _gathered(ids, starts, lens, units.ravel()), lens[units].sum(axis=1)

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none null) end to end, and where each text's end."""
        split = pc.ascii_split_whitespace(texts)  # at the six ASCII white characters
        words = split.flatten().dictionary_encode()
        ids, lens = self._words(words.dictionary)
        which = words.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(lens[which])))[np.cumsum(pc.list_value_length(split).to_numpy())]
        return _gathered(ids, np.cumsum(lens) - lens, lens, which), ends

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        ids, ends = self.encode_flat(pa.array(texts, pa.binary()).cast(pa.string()))
        return np.split(ids, ends[:-1])


def _gathered(ids: np.ndarray, starts: np.ndarray, lens: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``ids`` (from their starts, of their lengths) end to end."""
    n = lens[which]
    ends = np.cumsum(n)
    return ids[np.arange(ends[-1] if len(n) else 0) + np.repeat(starts[which] - ends + n, n)]


def _chunks(batches, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of about ``most`` bytes of text, over the bounds of the batches; a null
    text is empty."""
    def joined():
        return tuple(pa.concat_arrays([b.column(c) for b in held]) for c in (0, 1))
    held, size = [], 0
    for b in batches:
        b = pa.RecordBatch.from_arrays([b.column(0), b.column(1).fill_null("")], ["id", "text"])
        first = 0
        for k, n in enumerate(pc.binary_length(b.column(1)).to_pylist(), 1):
            size += n
            if size >= most:
                held.append(b.slice(first, k - first))
                yield joined()
                held, size, first = [], 0, k
        if first < b.num_rows:
            held.append(b.slice(first))
    if held:
        yield joined()


@lru_cache(maxsize=1)
def _word_encoder(tokenizer_json: str) -> WordEncoder:
    """Loaded once by a Python worker, which runs many tasks."""
    return WordEncoder(tokenizer_json)


def _encoder(tokenizer, end_id: int, width: str, dictionary):
    """mapInArrow body: (id, text) -> (id, n_tokens, frame); without a dictionary
    the frame is the plain serialized ids."""
    def run(batches):
        import zstandard
        if dictionary is not None:
            comp = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary.value))
            pack = comp.compress
        else:
            pack = bytes
        for of, texts in _chunks(batches):
            ids, ends = _word_encoder(tokenizer.value).encode_flat(texts)
            full = memoryview(np.insert(ids, ends, end_id).astype(width)).cast("B")
            ends = ends + np.arange(1, len(ends) + 1)
            cuts = (np.concatenate(([0], ends)) * np.dtype(width).itemsize).tolist()
            frames = [pack(full[a:z]) for a, z in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [of, pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(frames, pa.binary())],
                names=["id", "n_tokens", "frame"])
    return run


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Fewer rows in an Arrow batch while texts are encoded: a Python worker holds a
    batch of whole texts besides its store of words."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "500")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary, or where the samples are too few to train on, their bytes."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES] or b"\0" * 8


def write_token_files(df: DataFrame, path: str, tokenizer_json: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", vocab_size: int = 1 << 17) -> None:
    """Encode every text of ``df`` and write a token folder at ``path``."""
    spark = df.sparkSession
    width = "<u2" if vocab_size <= 1 << 16 else "<u4"
    tok = spark.sparkContext.broadcast(tokenizer_json)
    docs = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    shape = "id bigint, n_tokens bigint, frame binary"
    # at most SAMPLE_DOCS ids, so the broadcast is bounded
    picked = (docs.select("id").where(F.col("id").isNotNull()).dropDuplicates()
              .orderBy(unit_hash(F.lit("dict"), F.col("id")), "id").limit(SAMPLE_DOCS))
    sample = docs.join(F.broadcast(picked), "id", "left_semi")
    samples, held = [], 0
    plain = sample.mapInArrow(_encoder(tok, end_id, width, None), shape)
    rows = plain.where(F.length("frame") <= SAMPLE_BYTES // SAMPLE_DOCS * 16).orderBy("id", "frame").limit(SAMPLE_DOCS)
    for r in rows.toLocalIterator():
        held += len(r.frame)
        if held > SAMPLE_BYTES:
            break
        samples.append(bytes(r.frame))
    data = train_dictionary(samples)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(digest, end_id, width, bytearray(data))],
                          "dict_sha256 string, end_id long, width string, data binary") \
        .coalesce(1).write.parquet(f"{path}/dictionary")
    # frames are written before they are dealt by id, so nothing is encoded twice
    body = _encoder(tok, end_id, width, spark.sparkContext.broadcast(data))
    with _small_batches(spark):
        docs.mapInArrow(body, shape).write.parquet(f"{path}/frames")
    frames = spark.read.schema(shape).parquet(f"{path}/frames")

    def blocks(batches):
        part, block = TaskContext.get().partitionId(), 0
        ids, counts, parts = [], [], []

        def row():
            return pa.RecordBatch.from_pylist(
                [{"part": part, "block": block, "dict_sha256": digest, "ids": ids, "counts": counts,
                  "lengths": [len(x) for x in parts], "blob": b"".join(parts)}], schema=schema)
        schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("dict_sha256", pa.string()),
                            ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                            ("lengths", pa.list_(pa.int64())), ("blob", pa.binary())])
        size = 0
        for b in batches:
            for i, n, f in zip(*(c.to_pylist() for c in b.columns)):
                ids.append(i)
                counts.append(n)
                parts.append(f)
                size += len(f)
                if size >= BLOCK_BYTES:
                    yield row()
                    block, size, ids, counts, parts = block + 1, 0, [], [], []
        if ids:
            yield row()

    (frames.repartitionByRange("id").sortWithinPartitions("id", "frame")
     .mapInArrow(blocks, "part int, block int, dict_sha256 string, ids array<bigint>, "
                         "counts array<bigint>, lengths array<bigint>, blob binary")
     .write.option("compression", "none").option("parquet.page.row.count.limit", "1").parquet(f"{path}/blocks"))
    held = spark.read.parquet(f"{path}/blocks")
    by_part = held.groupBy("part").agg(F.sum(_total("counts")).alias("n"))  # a row per file
    before = by_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("block")
    light = held.select("part", "block", "ids", "counts", "lengths")
    starts = (light.withColumn("start", F.sum(_total("counts")).over(in_part) - _total("counts"))
              .join(before, "part").withColumn("start", F.col("start") + F.col("part_start")))
    rows = starts.select("part", "block", "start", F.posexplode(F.arrays_zip("ids", "counts", "lengths")).alias("at", "x"))
    run = Window.partitionBy("part", "block").orderBy("at")
    (rows.select(
        F.col("x.ids").alias("id"), "part", "block", F.col("x.counts").alias("n_tokens"),
        F.col("x.lengths").alias("length"),
        (F.sum("x.lengths").over(run) - F.col("x.lengths")).alias("offset"),
        (F.col("start") + F.sum("x.counts").over(run) - F.col("x.counts")).alias("start"))
     .repartitionByRange("id", "start").sortWithinPartitions("id", "start")
     .write.parquet(f"{path}/index"))


def _total(col: str):
    return F.aggregate(F.col(col), F.lit(0).cast("bigint"), lambda a, x: a + x)


def _dictionary(spark: SparkSession, path: str):
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(row.data).hexdigest() != row.dict_sha256:
        raise ValueError("the dictionary's bytes don't match their hash")
    return row


def _decoder(data, digest: str, width: str, digests_only: bool):
    """mapInArrow body over rows (id, start, dict_sha256, frame)."""
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data.value)).decompress
        for b in batches:
            if any(d != digest for d in set(b.column(2).to_pylist())):
                raise ValueError("a block was written with another dictionary")
            ids = [np.frombuffer(unpack(f), width).astype("<u4") for f in b.column(3).to_pylist()]
            found = (pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()) if digests_only
                     else pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) for x in ids], pa.int64()), found],
                names=["id", "start", "n_tokens", "found"])
    return run


def _named_blocks(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """The blocks that the few rows of ``index`` name, by filters that the scan takes;
    they let pass what has the part of one and the block of another, the join doesn't."""
    places = index.select("part", "block").distinct().collect()
    return blocks.where(F.col("part").isin(sorted({p.part for p in places}))
                        & F.col("block").isin(sorted({p.block for p in places})))


def read_token_files(spark: SparkSession, path: str, ids: list[int] | None = None,
                     digests_only: bool = False) -> DataFrame:
    """id, start, n_tokens and the ids (or with ``digests_only`` their crc32) of all
    documents, or of the given few: then only the index rows of those ids and the
    blocks they name are read."""
    row = _dictionary(spark, path)
    index = spark.read.parquet(f"{path}/index")
    blocks = spark.read.parquet(f"{path}/blocks").select("part", "block", "dict_sha256", "blob")
    if ids is not None:
        index = index.where(F.col("id").isin(list(ids)))
        blocks = _named_blocks(blocks, index)
    # the index entries of a block meet its blob as one array, so a blob moves once
    per_block = index.groupBy("part", "block").agg(F.collect_list(F.struct("offset", "length", "id", "start")).alias("docs"))
    cut = blocks.join(per_block, ["part", "block"]).select("dict_sha256", "blob", F.explode("docs").alias("d"))
    frames = cut.select("d.id", "d.start", "dict_sha256",
                        F.expr("substring(blob, cast(d.offset + 1 as int), cast(d.length as int))").alias("frame"))
    data = spark.sparkContext.broadcast(bytes(row.data))
    kind = "bigint" if digests_only else "array<bigint>"
    return (frames.mapInArrow(_decoder(data, row.dict_sha256, row.width, digests_only),
                              f"id bigint, start bigint, n_tokens bigint, found {kind}")
            .withColumnRenamed("found", "ids_crc32" if digests_only else "ids"))
