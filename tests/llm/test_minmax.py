"""Min-max hashing: unbiased estimates, lossless filters, components against brute force, edge cases."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from feedlens.llm import minmax
from feedlens.llm.bytetext import mix


def shingles(text):
    w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Per row (doc_id, size, smallest id reached)."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def found(docs):
    return sorted((tuple(r) for r in minmax.near_duplicates(docs).collect()), key=str)


def test_estimates_and_sketches():
    pool = mix(np.arange(1, 5001, dtype=np.uint64))
    for common, own in ((900, 50), (400, 100), (60, 4), (3, 0)):
        a, b = np.concatenate((pool[:common], pool[common : common + own])), np.concatenate((pool[:common], pool[2000 : 2000 + own]))
        h, starts = np.concatenate((a, b)), np.array([0, len(a)])
        low, high = minmax.min_max(h, starts, 400)
        true = common / (common + 2 * own)
        for x in (low, high):
            assert abs((x[:, 0] == x[:, 1]).mean() - true) < 0.09
        sketch = minmax.parity_sketches(h, starts)
        assert int(np.bitwise_count(sketch[0] ^ sketch[1]).sum()) <= 2 * own  # a bound from below
        assert (minmax.band_keys(low, high, 5).shape) == (2, 160)


def test_brute_force(spark):
    random.seed(9)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(12):  # groups of near copies around the threshold, of texts long and short
        base = [random.choice(vocabulary) for _ in range(random.choice((6, 12, 60, 300)))]
        for _ in range(12):
            w = list(base)
            for _ in range(random.randint(0, max(1, len(w) // 60) + 1)):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            rows.append((len(rows), " ".join(w[: len(w) - random.randint(0, 2)])))
    chain = [random.choice(vocabulary) for _ in range(200)]
    rows += [(1000 - k, " ".join(chain[3 * k :] + [f"c{i}" for i in range(3 * k)])) for k in range(40)]  # each links with its neighbours only
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(docs)
    assert got == brute(rows) and len({r[2] for r in got}) < 120


def test_large_group_makes_few_rows(spark):
    """A group of near copies: the members meet pivots, not each other."""
    random.seed(2)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for k in range(400):
        w = list(base)
        for _ in range(random.randint(1, 2)):
            w[random.randrange(len(w))] = f"x{k}"
        rows.append((k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = []
    plain = minmax._met

    def counting(members, others, *also):
        pairs = plain(members, others, *also)
        made.append(pairs.count())
        return pairs

    minmax._met = counting
    try:
        assert {r[2] for r in found(docs)} == {0}
    finally:
        minmax._met = plain
    assert sum(made) < 20 * len(rows)  # of 79,800 pairs


def test_edges(spark):
    long = "the and of " * 30_000 + "end"
    rows = [(1, None), (1, ""), (2, " \t\n"), (None, "a b c d e f"), (None, "a b c d e f"), (3, "A  b\nc d e f"), (4, "a b"), (4, "A B"), (5, "a b c"), (6, long), (7, long), (None, "one"), (8, "日本 語 x y z 1"), (8, "other words are here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("key", "ref", "n", "token", "comp", "component", "id", "least", "kept", "bands", "sketch", "g"):
        docs = docs.withColumn(c, F.lit("x"))
    want = [r for r in brute(rows) if r[0] is not None or r[2] is not None] + [(None, 1, None, True)]
    assert found(docs) == sorted([r if r[0] is not None else (*r[:3], r[2] is None) for r in want], key=str)
    assert found(docs.limit(0)) == [] and found(docs.where("text IS NULL")) == [(1, 0, 1, True)]
