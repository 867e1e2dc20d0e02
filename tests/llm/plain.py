"""Plain Python forms of the operators, for small tables."""

import hashlib
import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "key string, size string, `id` string, kept string, quality string, `a.b` string")


def edge_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 977}x" for i in range(6000))
    clean = "The cat of the house went to see the old man and the sea for a while on that day with friends"
    texts = [
        (1, clean), (2, clean), (2, clean), (3, clean + " again"), (None, clean), (4, None), (5, ""),
        (6, " \t\n\x0b "), (7, "one"), (7, "one two"), (8, "a\nb\na\nb\n\nb"), (9, "x " * 60),
        (10, long), (11, long + " tail"), (None, None), (12, "#*$ %&| <> " * 10), (13, "été ñandú œuvre 日本語 😀"),
        (14, "mail bob@example.com now +1 (845) 555-1234 or 10.0.0.1 and 4539 1488 0343 6467"),
        (15, "<|im_end|> <\\| <|"),
    ]
    out = []
    for k, (i, t) in enumerate(texts):
        source = [None, "b", "a", "c"][k % 4]
        out.append((i, t, None if k % 3 else "en", source, None, "k", None, "x", "no", "q", "dot"))
    return out


def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def shingles(text, k):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = words(low)
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def near(docs, k, percent=80):
    """{id: smallest id reachable} over (id, text) with distinct ids."""
    sets = {i: shingles(t, k) for i, t in docs}
    boss = {i: i for i in sets}

    def top(i):
        while boss[i] != i:
            i = boss[i]
        return i
    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(ids[a]), top(ids[b])
                boss[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}


def unit(*parts):
    h = hashlib.md5(":".join("" if p is None else str(p) for p in parts).encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / 2.0 ** 52


def targets(sizes, share=1.5, most=2):
    """{source: target} by resharing the excess until none is above its cap."""
    total = share * sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(order)}
    out, free = {}, set(order)
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = float(most * sizes[s])
            free.discard(s)
    return out


def mix(docs, seed="mix"):
    """Copies of each (id, text, source), in order."""
    size = [len(words(t)) for _, t, _ in docs]
    per = defaultdict(int)
    for (_, _, s), n in zip(docs, size):
        per[s] += n
    goal = targets(per)
    out = [0] * len(docs)
    for s in per:
        rate = min(2.0, goal[s] / per[s]) if per[s] else 0.0
        sure, p = math.floor(rate), rate - math.floor(rate)
        mine = [k for k, d in enumerate(docs) if d[2] == s]
        left = goal[s] - sum(sure * size[k] for k in mine)
        ranked, sum_ = [], 0
        for k in mine:
            out[k] = sure
            if p > 0 and size[k]:
                u = unit(seed, docs[k][0], size[k])
                odds = (u / (1 - u)) / (p / (1 - p))
                ranked.append((odds / (1 + odds), docs[k][0] or -1, size[k], k))
        for _, _, n, k in sorted(ranked):
            sum_ += n
            out[k] += sum_ - n / 2 <= left
    return out
