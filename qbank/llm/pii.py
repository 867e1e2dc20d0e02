"""PII spans: base patterns plus gradient-boosted candidates.

Base spans are exact patterns with their checks (octets, Luhn, digit counts). Beside
them, high-recall generators propose overlapping spans: anything around an ``@``,
any dotted digits, and in a group of digits with separators all neighbouring runs of
digits that together have as many digits as a phone or a card can (``PHONE_DIGITS``,
``CARD_DIGITS``), each as one of the four kinds. Boosted trees score a candidate by its format and context, and a
threshold per kind, calibrated on held-out candidates, selects the ones to add.

Training needs no labels by hand. Candidates that equal a base span of their kind are
positive. Others are negative, but for those that could be personal data all the same
(they pass their kind's checks and overlap no base span) and those that can't be added
(they overlap a base span of their kind); these are left out. As base spans don't show
what the base patterns miss, each phone and card is also written in ``VARIANTS`` other
ways where it stands (without ``+`` or country code, other separators, beside another
number); there the true span is known, so it is positive and what else overlaps it
negative.
Phones and cards are calibrated without base spans, on what could be added.

The candidates of all documents are used: bins, trees and thresholds come from sums over
them that Spark makes (a null id counts as 0). Candidates that fall into the same bins
are counted, not kept apart, and the driver gets sums of a fixed size: a histogram per
tree level, and per kind the counts by steps of the score (``STEPS``). Sums are of whole
numbers (``UNIT``), so that neither order nor partitions matter. Every text of the table is
searched whole. A kind without enough held-out candidates adds nothing.

Offsets count code points, end exclusive. Edge cases: a null or empty text has no
spans; repeated rows are searched alike; an empty table gives an empty result; other
columns don't matter. Every search is linear in the text's length.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qbank.llm.common import fresh, named, written

KINDS = ("email", "ip", "card", "phone")
ROUNDS, DEPTH, RATE, BINS = 30, 3, 0.3, 32
#: Training examples that a task holds at once, steps of a unit of log-odds that thresholds
#: are told apart by, and the parts of one that gradients are summed in.
EXAMPLES, STEPS, UNIT = 20_000, 256, 1 << 20
#: Share of added held-out candidates that must be right, and how many it takes.
PRECISION, LEAST_HELD = 0.98, 10
#: No candidate below this probability is added, however the threshold falls.
LEAST_SCORE = 0.5
#: Digits of a candidate, least and most; runs of digits are joined up to the most.
PHONE_DIGITS, CARD_DIGITS = (7, 15), (12, 19)
#: Other ways in which each phone or card is written for training.
VARIANTS = 4

# the base patterns; look-behinds only spare a second look at what cannot match
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"\+?\(?(?<![0-9])[0-9][0-9\x20().-]*[0-9]")
_RUN = re.compile(r"[0-9]+")
_LOOSE_HOST = re.compile(r"[A-Za-z0-9._-]+")
_CONTEXT = re.compile(r"tel|phone|call|fax|mail|card|visa|account|addr|host|server|ip\b", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def emails(text: str):
    """(start, end) of emails, leftmost first and disjoint. A match holds exactly one
    ``@`` after the longest run of local characters, so it is enough to look there."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            free = host.end()
        else:
            free = at + 1
        at = text.find("@", free)


def passes(kind: int, s: str) -> bool:
    """Whether ``s`` passes the checks of the kind's base pattern."""
    d = _digits(s)
    if kind == 0:
        return bool(_HOST.fullmatch(s.rpartition("@")[2]))
    if kind == 1:
        return all(int(x[-4:] or 256) <= 255 and not x[:-4].strip("0") for x in s.split(".") if x.isdecimal())
    return 14 <= len(d) <= 19 and luhn(d) if kind == 2 else 10 <= len(d) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, sorted."""
    out = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of everything that could be personal data; spans overlap."""
    out = set()
    at = text.find("@")
    while at >= 0:
        start = at
        while start > 0 and _LOCAL.match(text, start - 1):
            start -= 1
        host = _LOOSE_HOST.match(text, at + 1)
        if host and start < at:
            out.add((start, 0, host.end()))
            whole = _HOST.match(text, at + 1)
            if whole:
                out.add((start, 0, whole.end()))
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        out.add((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if CARD_DIGITS[0] <= len(_digits(m[0])) <= CARD_DIGITS[1]:
            out.add((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        out.add((m.start(), 3, m.end()))
    for m in _DIGITS.finditer(text):
        runs = [r.span() for r in _RUN.finditer(text, m.start(), m.end())]
        dots = [text.count(".", z, a) for (_, z), (a, _) in zip(runs, runs[1:])] + [0]
        for i, (start, _) in enumerate(runs):
            whole = start  # a phone's + and ( belong to it
            while whole > m.start() and text[whole - 1] in "+(":
                whole -= 1
            n = dotted = 0
            for k in range(i, len(runs)):
                n += runs[k][1] - runs[k][0]
                if n > CARD_DIGITS[1]:
                    break
                end = runs[k][1]
                if PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]:
                    out.add((whole, 3, end))
                if CARD_DIGITS[0] <= n:
                    out.add((start, 2, end))
                if dotted == 3:
                    out.add((start, 1, end))
                dotted += dots[k]
    return sorted(out)


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format of the span and what stands around it."""
    s = text[start:end]
    d = _digits(s)
    before, after = text[max(0, start - 24):start], text[end:end + 8]
    parts = s.split(".")
    host = s.rpartition("@")[2]
    runs = _RUN.findall(s) or [""]
    return [
        kind, len(s), len(d), s.count("."), s.count("-"), s.count(" "), s.count("(") + s.count(")"),
        float(s[:1] == "+"), float(luhn(d)) if d else 0.0,
        float(max((len(p) for p in parts), default=0)), float(max((int(p[-6:]) for p in parts if p.isdecimal() and p.isascii()), default=-1)),
        float(host.count(".")), float(len(host.rpartition(".")[2])),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "+@.-_"),
        float(bool(_CONTEXT.search(before))), float(sum(c.isdigit() for c in before)),
        float(sum(c.isdigit() for c in after)),
        float(len(runs)), float(len(runs[0])), float(len(runs[-1])), float(max(map(len, runs))),
    ]


class Trees:
    """Gradient-boosted trees for the logistic loss, on binned features."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        qs = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(c, qs)) for c in x.T]
        b = self._bins(x)
        return self.grow(y.mean(), lambda splits: self.sums(splits, b, np.ones(len(y)), y))

    def grow(self, share: float, sums) -> "Trees":
        """Fits the trees; ``share``: that of the positive rows, ``sums``: of all rows what
        ``Trees.sums`` is of some, for the trees so far and the splits of the next."""
        p = float(np.clip(share, 1e-3, 1 - 1e-3))
        self.bias, self.trees = np.log(p / (1 - p)), []
        for _ in range(ROUNDS):
            splits = []
            for level in range(DEPTH):
                g, h = sums(splits)
                splits.append([self._split(g[k], h[k]) for k in range(1 << level)])
            # what goes left and right of the last splits is in their histograms
            leaf = [a[k, j, part].sum() for a in (g, h) for k, (j, cut) in enumerate(splits[-1])
                    for part in (slice(0, cut + 1), slice(cut + 1, None))]
            leaf = np.array(leaf).reshape(2, 1 << DEPTH)
            self.trees.append((splits, RATE * leaf[0] / (leaf[1] + 1.0)))
        return self

    def sums(self, splits, b: np.ndarray, n: np.ndarray, y: np.ndarray):
        """Gradients and Hessians by node, feature and bin, of ``n`` rows each in the bins
        ``b`` of which ``y`` are positive."""
        p = 1 / (1 + np.exp(-self.margin(b)))
        node, nodes = np.zeros(len(b), np.int64), 1 << len(splits)
        for level in splits:
            node = self._down(b, node, level)
        return [np.stack([np.bincount(node * BINS + c, np.rint(UNIT * v), nodes * BINS).reshape(nodes, BINS) for c in b.T], 1)
                / UNIT for v in (y - n * p, n * p * (1 - p))]

    def _bins(self, x):
        return np.stack([np.searchsorted(c, v, "right") for c, v in zip(self.cuts, x.T)], 1)

    @staticmethod
    def _split(g, h):
        """(feature, bin) of the best cut of a node: rows with a larger bin go right."""
        best, gain = (0, BINS), 1e-9
        for j in range(len(g)):
            gs, hs = np.cumsum(g[j]), np.cumsum(h[j])
            left, right = gs[:-1] ** 2 / (hs[:-1] + 1), (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1)
            won = left + right - gs[-1] ** 2 / (hs[-1] + 1)
            if len(won) and won.max() > gain:
                best, gain = (j, int(won.argmax())), won.max()
        return best

    @staticmethod
    def _down(b, node, splits):
        j, cut = np.array([s[0] for s in splits])[node], np.array([s[1] for s in splits])[node]
        return 2 * node + (b[np.arange(len(b)), j] > cut)

    def margin(self, b: np.ndarray) -> np.ndarray:
        """The log-odds of rows in the bins ``b``."""
        f = np.full(len(b), self.bias)
        for splits, leaf in self.trees:
            node = np.zeros(len(b), np.int64)
            for level in splits:
                node = self._down(b, node, level)
            f += leaf[node]
        return f

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(self._bins(x))))


def calibrate(score: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> float:
    """The smallest threshold above which enough held-out candidates are right; 2 if none.
    ``n``: how many candidates have the score, of which ``y`` are right (one each)."""
    order = np.argsort(-score, kind="stable")
    s, right = score[order], np.cumsum(y[order])
    n = np.cumsum(np.ones(len(s)) if n is None else n[order])
    last = np.append(s[1:] != s[:-1], True)  # ties are taken together
    fit = np.flatnonzero(last & (n >= LEAST_HELD) & (right >= PRECISION * n))
    return max(LEAST_SCORE, float(s[fit[-1]])) if len(fit) else 2.0


def _overlaps(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """``spans``: sorted and disjoint."""
    at = bisect.bisect_left(spans, (end,))
    return at > 0 and spans[at - 1][1] > start


def variant(kind: int, digits: str, form: int) -> list[tuple[int, str]]:
    """(kind, text) of neighbours, to be joined by spaces: a phone or card of these
    digits, written in a way that its base pattern misses."""
    def fours(d):
        return [d[i:i + 4] for i in range(0, len(d), 4)]

    def card(d):  # another card of 16 digits
        d = (d * 2)[:15]
        return next(d + x for x in "0123456789" if luhn(d + x))
    code, a, b, c = digits[:-10] or "1", digits[-10:-7], digits[-7:-4], digits[-4:]
    pairs = "0" + digits[-9:]
    pairs = " ".join(pairs[i:i + 2] for i in range(0, 10, 2))
    phones = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", pairs, f"{code}-{a}-{b}-{c}"]
    if kind == 3:
        forms = [[(3, x)] for x in phones]
        forms.append([(3, f"+{code} ({a}) {b}-{c}"), (2, " ".join(fours(card(digits))))])
        forms.append([(3, f"+{code} {pairs[1:]}"), (2, " ".join(fours(card(digits))))])
    else:
        forms = [[(2, ".".join(fours(digits)))], [(2, digits), (2, card(digits[::-1]))],
                 [(2, " ".join(fours(digits))), (3, pairs)], [(3, phones[0]), (2, "-".join(fours(digits)))]]
    return forms[form % len(forms)]


def labelled(text: str, truth: list[tuple[int, int, int]] | None = None):
    """(candidate, label, whether it is a base span); see the module's text. With
    ``truth``, the personal data at a place, only candidates that overlap it."""
    base = base_spans(text)
    own, by_kind = set(base), [[(s, e) for s, k, e in base if k == kind] for kind in range(len(KINDS))]
    for c in candidates(text):
        s, k, e = c
        if truth is not None and not any(s < z and a < e for a, _, z in truth):
            continue
        if c in own:
            if truth is None or c in truth:
                yield c, 1.0, True
        elif _overlaps(by_kind[k], s, e):
            continue
        elif truth is not None:
            yield c, float(c in truth), False
        elif any(_overlaps(x, s, e) for x in by_kind) or not passes(k, text[s:e]):
            yield c, 0.0, False


def examples(text: str, seed: int):
    """(features, label, whether it is a base span) of a text and its variants."""
    for c, y, own in labelled(text):
        yield features(text, *c), y, own
    for s, kind, e in base_spans(text):
        form = zlib.crc32(b"%d:%d" % (seed, s))
        for n in range(VARIANTS if kind >= 2 else 0):
            pieces = variant(kind, _digits(text[s:e]), form + n)
            before, truth = text[max(0, s - 64):s], []
            at = len(before)
            for k, piece in pieces:
                truth.append((at, k, at + len(piece)))
                at += len(piece) + 1
            local = before + " ".join(x for _, x in pieces) + text[e:e + 64]
            for c, y, own in labelled(local, truth):
                yield features(local, *c), y, own


def _training_rows(batches):
    def batch(rows):
        x, y, own, held = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64()),
                                           pa.array(own, pa.bool_()), pa.array(held, pa.bool_())], names=["x", "y", "own", "held"])
    for b in batches:
        rows = []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held = _share(i or 0) < 0.3
            for x, y, own in examples(text or "", i or 0):
                rows.append((x, y, own, held))
                if len(rows) >= EXAMPLES:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """(trees, threshold per kind), learned from all documents of ``df`` (see the module's
    text); None where one class is missing or all is held out."""
    docs = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    rows = written(docs.mapInArrow(_training_rows, "x array<double>, y double, own boolean, held boolean"), "pii-examples")
    count = {r.held: r for r in rows.groupBy("held").agg(F.count("y").alias("n"), F.sum("y").alias("y")).collect()}
    learn = count.get(False)
    if learn is None or sum(r.n for r in count.values()) < 4 * LEAST_HELD or learn.y in (0, learn.n):
        return None
    qs = [float(q) for q in np.linspace(0, 1, BINS + 1)[1:-1]]
    width = len(features("", 0, 0, 0))
    cuts = rows.where(~F.col("held")).agg(*[F.percentile(F.get("x", F.lit(j)), F.array(*map(F.lit, qs))) for j in range(width)])
    trees = Trees()
    trees.cuts = [np.unique(c) for c in cuts.first()]
    groups = written(rows.mapInArrow(_binned(trees), "bins binary, kind int, y double, own boolean, held boolean")
                     .groupBy("bins", "kind", "own", "held").agg(F.count("y").cast("double").alias("n"), F.sum("y").alias("y")),
                     "pii-bins")
    trees.grow(learn.y / learn.n, lambda splits: _all_sums(groups.where(~F.col("held")), trees, splits, width))
    # a phone or card that base finds is none to add
    held = groups.where("held AND NOT (own AND kind >= 2)").mapInArrow(_steps(trees, width), "kind int, step bigint, n double, y double")
    held = held.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("y").alias("y")).collect()

    def threshold(k):
        step, n, y = np.array([(r.step, r.n, r.y) for r in held if r.kind == k]).reshape(-1, 3).T
        return calibrate(1 / (1 + np.exp(-step / STEPS)), y, n)
    return trees, [threshold(k) for k in range(len(KINDS))]


def _binned(trees: Trees):
    """Examples with their bins, a byte each, in place of the features."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
                bins = [r.tobytes() for r in trees._bins(x).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([pa.array(bins, pa.binary()), pa.array(x[:, 0].astype(np.int32)), *b.columns[1:]],
                                                 names=["bins", "kind", "y", "own", "held"])
    return run


def _bytes(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width).astype(np.int64)


def _all_sums(groups: DataFrame, trees: Trees, splits, width: int):
    """``Trees.sums`` over the groups of a table."""
    shape = (2, 1 << len(splits), width, BINS)

    def run(batches):
        total = np.zeros(shape)
        for b in batches:
            total += trees.sums(splits, _bytes(b.column(0), width), b.column(1).to_numpy(), b.column(2).to_numpy())
        g, h = np.rint(UNIT * total).astype(np.int64).reshape(2, -1)
        at = np.flatnonzero(g | h)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g[at]), pa.array(h[at])], names=["at", "g", "h"])
    sums = groups.select("bins", "n", "y").mapInArrow(run, "at bigint, g bigint, h bigint").groupBy("at")
    out = np.zeros((2, np.prod(shape[1:])))
    for r in sums.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        out[:, r.at] = r.g / UNIT, r.h / UNIT
    return out.reshape(shape)


def _steps(trees: Trees, width: int):
    """Held-out groups with the step of their score."""
    def run(batches):
        for b in batches:
            step = np.floor(STEPS * trees.margin(_bytes(b.column("bins"), width))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("kind"), pa.array(step), b.column("n"), b.column("y")],
                                             names=["kind", "step", "n", "y"])
    return run


def _share(i: int) -> float:
    """Documents are held out whole; a fixed mix of the id decides."""
    return ((i * 2654435761) & 0xFFFFFFFF) / 2.0 ** 32


def spans_of(text: str, model) -> list[tuple[int, int, int, bool, float]]:
    """(start, kind, end, base, score) sorted: all base spans, and the candidates over
    their threshold that overlap no span of their kind already taken, best first."""
    base = base_spans(text)
    out = [(*b, True, 1.0) for b in base]
    if model is not None:
        own = set(base)
        rest = [c for c in candidates(text) if c not in own]
        if rest:
            trees, least = model
            score = trees.score(np.array([features(text, *c) for c in rest]))
            taken = [[(s, e) for s, k, e in base if k == kind] for kind in range(len(KINDS))]
            for p, (s, k, e) in sorted(zip(-score, rest)):
                if -p >= least[k]:
                    # what is taken of a kind is disjoint: only the last start before e can overlap
                    at = bisect.bisect_left(taken[k], (e,))
                    if not at or taken[k][at - 1][1] <= s:
                        taken[k].insert(at, (s, e))
                        out.append((s, k, e, False, float(-p)))
    return sorted(out)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model=None) -> DataFrame:
    """Per row of ``df``: the id and its spans (kind, start, end, base, score), by
    start, then kind. ``model``: from ``train``."""
    span = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"
    shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                ("base", pa.bool_()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e, "base": own, "score": p}
                      for s, k, e, own, p in spans_of(t or "", model)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, shape)], names=["id", "spans"])
    rows = df.select(named(id_col).cast("bigint").alias("id"), named(text_col).alias("text"))
    return rows.mapInArrow(run, f"id bigint, spans {span}").withColumnRenamed("id", id_col)


def redact(df: DataFrame, model=None, text_col: str = "text") -> DataFrame:
    """``df`` with every span of the text replaced by its kind, like ``[email]``.
    Overlapping spans are replaced together, under the kind that starts first."""
    r = fresh(df, "__redacted")

    @F.pandas_udf("string")
    def clean(texts):
        def one(t):
            if t is None:
                return None
            out, at = [], 0
            for s, k, e, *_ in spans_of(t, model):
                if s >= at:
                    out += [t[at:s], f"[{KINDS[k]}]"]
                at = max(at, e)
            return "".join(out) + t[at:]
        return texts.map(one)
    return (df.withColumn(r, clean(named(text_col)))
            .select(*[(F.col(r).alias(c) if c == text_col else named(c)) for c in df.columns]))
