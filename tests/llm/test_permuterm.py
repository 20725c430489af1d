"""Spelling variants against brute force on a small vocabulary, and edge cases."""

import random
import re
import zlib

from pyspark.sql import functions as F

from feedlens.llm import permuterm


def counted(rows):
    n = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if c >= 3}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows):
    n = counted(rows)
    form, out = {}, {}
    for w in n:
        near = [v for v in n if distance_one(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = [form[w], None, n[w], len(near), n[form[w]] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def found(docs):
    rows = permuterm.spelling_variants(docs).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_brute_force(spark):
    random.seed(5)
    letters = "aabé×ÿ"  # few letters: many runs of equal ones and many near words
    words = ["".join(random.choice(letters) for _ in range(random.randint(4, 7))) for _ in range(300)]
    rows = [(k, ", ".join(random.choice(words[: 10 + k]).upper() if k % 3 else random.choice(words) for _ in range(60))) for k in range(200)]
    rows += [(None, "aaaaaa aaaaa baaaaa aaaaa " * 9), (7, "aaaaa " * 40)]
    want = brute(rows)
    assert sum(v[3] > 1 for v in want.values()) > 50 and any(v[0] and v[1] != v[0] for v in want.values())
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_edges(spark):
    rows = [(1, None), (1, ""), (None, "Straße straße STRAßE"), (None, None), (2, "漢字 1234567 abcd abcd abcd"), (3, "word" * 50_000 + " wordy" * 4), (4, "naïve naive naive naive naïve naïve, naivE naive naive")]
    rows += [(9, "equal equal equal")] * 3  # repeated rows count each
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("word", "n", "prefix", "form", "root", "run", "best", "whole"):
        docs = docs.withColumn(c, F.lit("x"))
    got = found(docs)
    assert got == brute(rows) and got["naïve"][:2] == ("naive", "naive") and got["equal"][2] == 9 and "straße" in got
    assert permuterm.spelling_variants(docs.limit(0)).count() == 0
    assert permuterm.spelling_variants(docs.where("text IS NULL")).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_each_group_is_bounded_by_the_alphabet(spark):
    words = [(a + b + "cde", 3) for a in "abcdefgh" for b in "abcdefgh"]
    turned = permuterm.rotations(spark.createDataFrame(words, "word string, n long"))
    assert turned.count() == len(words) * 11  # linear in the letters
    assert turned.groupBy("prefix").count().agg(F.max("count")).first()[0] <= 8 + 1
