"""Language identification by a byte convolutional network, trained here in numpy.

Input: a text in lower case as UTF-8 bytes; a-z and bytes from 0x80 on keep codes of
their own, all other bytes are one code, whose runs count once. The codes are cut into
windows of ``WINDOW`` bytes, the whole text, the last one padded.

Network: each code has an embedding; filters of ``WIDTHS`` neighbouring bytes slide over
a window, their rectified maximum over the window is a feature, and a softmax layer
gives a probability per language. A text's probabilities are the mean over its windows,
weighted by their letters. Scoring uses tables of two neighbouring codes' contributions
(codes squared rows a table, derived from the weights), so a filter costs one or two
lookups a byte.

Training: of the rows that have a language and are not held out, at most ``TRAIN_DOCS``
of each language, chosen by a hash of the id, at most ``PIECES`` windows of each, spread
over its text, for at most ``LANGUAGES`` languages (those with the most rows). These
bounds are what the driver holds. Adam with a fixed seed; equal tables give equal models.

Edge cases: null texts and texts without a letter are ``und`` with score 0; a null id
counts as held out; a null language is not learnt; without learnable rows all is
``und``; with one language everything with a letter is that one; ties go to the first
language in order; long texts are scored a slice of windows at a time; repeated rows are
scored alike; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import named, unit_hash

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: The bounds of the training sample.
TRAIN_DOCS, PIECES, LANGUAGES = 400, 4, 128
EPOCHS, BATCH, RATE = 8, 64, 0.01
UNKNOWN = "und"
#: Windows that are scored at a time, and bytes of texts that are prepared at a time.
SLICE, GROUP_BYTES = 128, 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
#: 0: neither a letter of ASCII nor a byte of another character.
CODES = np.zeros(256, np.uint8)
CODES[97:123] = np.arange(1, 27)
CODES[128:] = np.arange(27, 155)
N_CODES = 155


def windows(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes [n, WINDOW] of all windows of some texts, and the text of each. Texts
    without a letter have none."""
    raw = [t.lower().encode() if t and _LETTER.search(t) else b"" for t in texts]
    buf = CODES[np.frombuffer(b"\n".join(raw), np.uint8)]
    ends = np.cumsum([len(r) + 1 for r in raw])
    keep = np.ones(len(buf), bool)
    keep[1:] = (buf[1:] > 0) | (buf[:-1] > 0)
    of = np.repeat(np.arange(len(raw)), np.diff(ends, prepend=0))[:len(buf)][keep]
    buf = buf[keep]
    some = np.array([bool(r) for r in raw])
    buf, of = buf[some[of]], of[some[of]]
    size = np.bincount(of, minlength=len(raw))
    n = -(-size // WINDOW)
    out = np.zeros(int(n.sum()) * WINDOW, np.uint8)
    shift = (np.cumsum(n) - n) * WINDOW - (np.cumsum(size) - size)
    out[np.arange(len(buf)) + shift[of]] = buf
    return out.reshape(-1, WINDOW), np.repeat(np.arange(len(raw)), n)


@dataclass
class Model:
    """Languages in order, and the network's weights."""
    languages: list[str]
    embed: np.ndarray            # [N_CODES, EMBED]
    filters: list[np.ndarray]    # per width [width * EMBED, FILTERS]
    bias: list[np.ndarray]       # per width [FILTERS]
    dense: np.ndarray            # [len(WIDTHS) * FILTERS, languages]
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.dense, self.offset]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(codes: np.ndarray, label: np.ndarray, languages: list[str], seed: int = 7) -> Model:
    """Train on windows [n, WINDOW] with the number of each one's language."""
    rng = np.random.default_rng(seed)

    def start(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = Model(languages, start(N_CODES, EMBED) * np.float32(5), [start(w * EMBED, FILTERS) for w in WIDTHS],
              [np.zeros(FILTERS, np.float32) for _ in WIDTHS], start(len(WIDTHS) * FILTERS, len(languages)),
              np.zeros(len(languages), np.float32))
    params = m.parameters()
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps, total = 0, EPOCHS * -(-len(codes) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(codes))
        for s in range(0, len(order), BATCH):
            pick = order[s:s + BATCH]
            grads = _gradients(m, codes[pick], label[pick])
            steps += 1
            rate = RATE * (1 - (steps - 1) / total)
            for p, g, a, b in zip(params, grads, mean, square):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= (rate * (a / (1 - 0.9 ** steps)) / (np.sqrt(b / (1 - 0.99 ** steps)) + 1e-8)).astype(np.float32)
    return m


def _gradients(m: Model, codes: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy, in order of ``parameters``. Only a filter's best place
    in a window gets a share."""
    n = len(codes)
    seen = m.embed[codes]
    features, places = [], []
    for w, f, b in zip(WIDTHS, m.filters, m.bias):
        out = sum(seen[:, k:WINDOW - w + 1 + k] @ f[k * EMBED:(k + 1) * EMBED] for k in range(w))
        best = out.argmax(1)
        places.append(best)
        features.append(np.maximum(np.take_along_axis(out, best[:, None], 1)[:, 0] + b, 0))
    hidden = np.concatenate(features, 1)
    d_out = _softmax(hidden @ m.dense + m.offset)
    d_out[np.arange(n), label] -= 1
    d_out /= n
    d_hidden = (d_out @ m.dense.T) * (hidden > 0)
    d_embed, d_filters, d_bias = np.zeros_like(m.embed), [], []
    for j, (w, f) in enumerate(zip(WIDTHS, m.filters)):
        d = d_hidden[:, j * FILTERS:(j + 1) * FILTERS]
        there = codes[np.arange(n)[:, None, None], places[j][:, :, None] + np.arange(w)]  # [n, FILTERS, w]
        d_filters.append(np.einsum("nf,nfke->kef", d, m.embed[there]).reshape(w * EMBED, FILTERS))
        d_bias.append(d.sum(0))
        np.add.at(d_embed, there, d[:, :, None, None] * f.reshape(w, EMBED, FILTERS).transpose(2, 0, 1))
    return [d_embed, *d_filters, *d_bias, hidden.T @ d_out, d_out.sum(0)]


class Scorer:
    """Probabilities of windows, by lookups of two neighbouring codes."""

    def __init__(self, m: Model):
        self.m = m
        self.parts = []  # per width: (first place, table over pairs or single codes)
        for w, f in zip(WIDTHS, m.filters):
            one = [m.embed @ f[k * EMBED:(k + 1) * EMBED] for k in range(w)]
            tables = [(k, (one[k][:, None] + one[k + 1][None]).reshape(-1, FILTERS)) for k in range(0, w - 1, 2)]
            self.parts.append((w, tables, (w - 1, one[w - 1]) if w % 2 else None))

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), len(self.m.languages)), np.float32)
        for s in range(0, len(codes), SLICE):
            c = codes[s:s + SLICE].astype(np.int32)
            pair = c[:, :-1] * N_CODES + c[:, 1:]
            features = []
            for (w, tables, single), b in zip(self.parts, self.m.bias):
                n = WINDOW - w + 1
                x = tables[0][1].take(pair[:, :n], 0)
                for k, t in tables[1:]:
                    x += t.take(pair[:, k:k + n], 0)
                if single:
                    x += single[1].take(c[:, single[0]:single[0] + n], 0)
                features.append(np.maximum(x.max(1) + b, 0))
            out[s:s + SLICE] = _softmax(np.concatenate(features, 1) @ self.m.dense + self.m.offset)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        codes, of = windows(texts)
        weight = (codes > 0).sum(1)
        p = self.probabilities(codes) * weight[:, None]
        total = np.stack([np.bincount(of, p[:, k], len(texts)) for k in range(p.shape[1])], 1)
        letters = np.bincount(of, weight, len(texts))
        best = total.argmax(1)
        score = np.minimum(1.0, np.round(total[np.arange(len(texts)), best] / np.maximum(letters, 1), 6))
        return [(self.m.languages[k], float(x)) if n else (UNKNOWN, 0.0) for k, x, n in zip(best, score, letters)]


def held_out(id_: Column) -> Column:
    """Every fifth id by crc32 of its decimal form, and null ids."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang and codes (windows end to end) of the training rows."""
    rows = df.select(named(id_col).alias("id"), named(text_col).alias("text"), named(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("id")) & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("draw", unit_hash(F.lit("langid"), F.col("id"), F.length("text")))
    # how many rows a language has decides who is drawn; then some 2 * TRAIN_DOCS remain
    n = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    drawn = rows.join(n, "lang").where(F.col("draw") * F.col("n") < 2 * TRAIN_DOCS + 100)
    order = Window.partitionBy("lang").orderBy("draw", "id", "text")
    drawn = drawn.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TRAIN_DOCS)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(2):
                codes, _ = windows([t.as_py()])
                at = np.unique(np.linspace(0, len(codes) - 1, PIECES).round().astype(int)) if len(codes) else []
                out.append(codes[at].tobytes() if len(codes) else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                             names=["lang", "rank", "codes"])
    return drawn.select("lang", "rank", "text").mapInArrow(pieces, "lang string, rank int, codes binary")


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A network fitted to the sample of ``df`` (None: nothing to learn)."""
    rows = sorted((r.lang, r.rank, bytes(r.codes)) for r in sample(df, id_col, text_col, lang_col).collect() if r.codes)
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    codes = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, WINDOW)
    label = np.repeat([languages.index(r[0]) for r in rows], [len(r[2]) // WINDOW for r in rows])
    return fit(codes, label, languages)


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: its id, lang_pred and score; language, source and id of a row
    are never looked at."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # some 10 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for b in batches:
            if scorer is None and sent.value is not None:
                scorer = Scorer(sent.value)
            start = 0
            while start < len(b):
                texts, size = [], 0
                while start + len(texts) < len(b) and size < GROUP_BYTES:
                    texts.append(b.column(1)[start + len(texts)].as_py())
                    size += len(texts[-1] or "")
                found = scorer.predict(texts) if scorer else [(UNKNOWN, 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(start, len(texts)), pa.array([x for x, _ in found], pa.string()),
                     pa.array([x for _, x in found], pa.float64())], names=["id", "lang_pred", "score"])
                start += len(texts)
    rows = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, lang_pred string, score double").withColumnRenamed("id", id_col)
