"""The conversation trie against brute force, at several container sizes; ordered scans; edge cases."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from feedlens.llm import burst_trie
from feedlens.llm.ordered import running

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """rows: (conv_id, turn, role, text), no two of one conversation with the same turn but different texts."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        seqs[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * words
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if seqs[c] == node)))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(turns, **options):
    out = burst_trie.conversation_trie(turns, **options)
    assert out.columns == COLUMNS
    return sorted((tuple(r) for r in out.collect()), key=str)


def sample():
    random.seed(4)
    rows = []
    for c in range(-30, 160):
        if c % 20 == 0 and c % 60 == 0 and c:
            continue  # some bases are absent
        n = random.choice((1, 2, 2, 3, 5, 9))
        for t in range(n):
            common = c % 3 == 0 or random.random() < 0.5
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"shared turn {t} of  many" if common else f"{random.choice('abc')} own\twords {t}"))
    for c in range(500, 520):  # copies, and a long common beginning
        rows += [(c, t, "user", f"long {t}") for t in range(30 + (c % 4 == 0) * (c % 7))]
    return rows


@pytest.mark.parametrize("container_turns", [1, 40, 100_000])
def test_brute_force(spark, container_turns):
    rows = sample()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(turns, container_turns=container_turns) == brute(rows)


def test_edges(spark):
    rows = [(1, None, None, None), (1, 1, "user", ""), (1, 2, "user", "a b"), (2, 0, "user", "x"), (3, 0, None, "x"), (4, 0, "", "x"), (None, 0, "user", "lost"), (5, 5, "u", "same"), (5, 5, "u", "same"), (5, 5, "u", "same"), (6, 0, "u", "w " * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("id", "rank", "words", "depth", "rep", "top", "m", "key", "part", "at_1", "total", "ends"):
        turns = turns.withColumn(c, F.lit("x"))
    for limit in (1, 1000):
        assert found(turns, container_turns=limit) == brute(rows)
    assert found(turns.limit(0)) == [] and found(turns.where("conv_id IS NULL")) == []
    # turns of equal number are ordered in one way, whatever the order of the rows
    tied = [(7, 1, "u", t) for t in "abcdef"]
    one = found(spark.createDataFrame(tied, "conv_id long, turn long, role string, text string"))
    two = found(spark.createDataFrame(tied[::-1], "conv_id long, turn long, role string, text string").repartition(4))
    assert one == two


def test_running_spans_partitions(spark):
    """One group with most rows: it lies in many partitions, its ranks, sums and hashes go through."""
    rows = [(0, k, k * k % 97, k % 5) for k in range(3000)] + [(c, k, k * k % 97, k % 5) for c in range(1, 60) for k in range(c % 4 + 1)] + [(99, k, k * k % 97, k % 5) for k in range(700)]
    random.seed(1)
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, o long, id long, v long").repartition(5)
    got = running(df, "g", ["o"], chain="id", sums=("v",)).collect()
    spread = running(df, "g", ["o"]).select("g", F.spark_partition_id().alias("p")).where("g = 0").distinct().count()
    assert len(got) == len(rows) and spread > 2
    hashes = {}
    for r in got:
        assert r["rank"] == r["o"] + 1 and r["sum_0"] == sum(k % 5 for k in range(r["o"] + 1))
        hashes.setdefault(r["o"], set()).add((r["hash_1"], r["hash_2"]))
        if r["o"] == 0:
            assert (r["before_1"], r["before_2"]) == (0, 0)
        else:
            hashes.setdefault(r["o"] - 1, set()).add((r["before_1"], r["before_2"]))
    assert all(len(h) == 1 for h in hashes.values()) and len({min(h) for h in hashes.values()}) == 3000


def test_containers_burst_until_they_fit(spark):
    rows = [(c, t, "user", f"t{t}" if t < 5 else f"{c} {t}") for c in range(1000, 1200) for t in range(7)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    _, _, nodes = burst_trie.classes_of(*burst_trie.branches(turns))
    resting = burst_trie.burst(nodes, 300)
    size = resting.join(nodes.select("rep", F.col("depth").alias("d")), "rep").where("d >= depth").groupBy("depth", "at_1", "at_2").agg(F.countDistinct("rep").alias("classes"), F.count("*").alias("turns"))
    assert resting.count() == 200 and size.where("classes > 1 AND turns > 300").count() == 0 and size.agg(F.sum("classes")).first()[0] == 200
