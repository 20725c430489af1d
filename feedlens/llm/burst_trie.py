"""A prefix trie of conversations, built as a burst trie.

1. Turns get an id (a 64-bit hash of role and text), conversations are rebuilt and every turn its
   prefix hash (128 bits, of the ids from the first turn on).  Conversations of equal sequences are
   one class; only a class's smallest conversation goes on, with the number of members.
2. All classes start in one container, the root's.  A container of several classes and more than
   ``container_turns`` turns bursts: it becomes a head of the trie and its members move on by their
   next turn id.  Bursts are judged for several depths at a time (1, 2, 4 ...), by grouped counts of
   the prefixes, so deep common beginnings take few rounds; a round only reads the classes that are
   still in an oversized container.
3. Containers are dealt to shards.  In a shard, one container at a time, the suffixes are sorted by
   their turn ids and swept: what a suffix does not share with the one before it opens nodes, and
   nodes are closed, and added to their parents, as soon as a suffix leaves them.  A container of
   one class, of whatever length, is a chain, whose nodes follow from running sums.
4. Heads sum up their subtrees: each head's and container's own value is given to one class that
   runs through it, summed along the class from its deepest head up, and added over the classes
   of each head.

Groups of any size are ranked, hashed and summed in ranges of rows (``ordered``), so no
conversation, class or container passes one task as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.ordered import running
from feedlens.llm.storage import only, partitions, scratch, stored, stored_rows

WORD = "[^\\x20\\x09-\\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends bigint, up_1 bigint, up_2 bigint"
_NODE_NAMES = [c.split()[0] for c in _NODES.split(", ")]
_NODES_ARROW = pa.schema([(c, pa.int64()) for c in _NODE_NAMES])


def lent_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the one it is a branch of: unsigned crc32 of the decimal id, modulo 4."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, id, words) of the turns; rows without a conv_id belong to no conversation and are left out."""
    rows = only(turns, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.xxhash64(role, text).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))


def branches(turns: DataFrame, every: int = 20) -> tuple[DataFrame, DataFrame]:
    """(conversations, their rebuilt turns in order): the first turns of the conversation c - c % every, then their own.

    Returns (conv_id) and (conv_id, place, id, words), ``place`` increasing with gaps.
    """
    own = stored(running(turn_rows(turns), "conv_id", ["turn", "id"]).drop("turn"), "turns")
    convs = stored(own.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id"), "convs")
    h = lent_turns(F.col("conv_id"))
    heads = own.where((F.col("conv_id") % every == 0) & (F.col("rank") <= 3)).withColumnRenamed("conv_id", "base")
    asks = convs.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base")).where("h > 0")
    lent = asks.join(heads, "base").where("rank <= h").select("conv_id", "rank", "id", "words")
    return convs, own.where(F.col("rank") > h).select("conv_id", "rank", "id", "words").unionByName(lent).withColumnRenamed("rank", "place")


def classes_of(convs: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ends, classes, rows).

    ends: (len, end_1, end_2, conv_id, total) per conversation; classes: (rep, len, m, total, end_1, end_2), total
    being the words of all turns; rows: per class and depth, the root included, (rep, len, m, total, depth, id, words,
    so_far, at_1, at_2, up_1, up_2) with the prefix hashes up to and before the turn.
    """
    turns = stored(running(rebuilt, "conv_id", ["place"], chain="id", sums=("words",)), "rebuilt")
    last = turns.groupBy("conv_id").agg(F.max(F.struct("rank", "hash_1", "hash_2", "sum_0")).alias("e"))
    zero = F.lit(0).cast("bigint")
    ends = convs.join(last, "conv_id", "left").select(*[F.coalesce(F.col(f"e.{c}"), zero).alias(n) for c, n in (("rank", "len"), ("hash_1", "end_1"), ("hash_2", "end_2"), ("sum_0", "total"))], "conv_id")
    ends = stored(ends, "ends")
    classes = stored(ends.groupBy("len", "end_1", "end_2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("m"), F.max("total").alias("total")), "classes")
    seq = classes.select("rep", "len", "m", "total")
    rows = turns.join(seq, turns["conv_id"] == seq["rep"]).select(
        *seq.columns, F.col("rank").alias("depth"), "id", "words", F.col("sum_0").alias("so_far"), F.col("hash_1").alias("at_1"), F.col("hash_2").alias("at_2"), F.col("before_1").alias("up_1"), F.col("before_2").alias("up_2")
    )
    root = seq.select("*", *[zero.alias(c) for c in ("depth", "id", "words", "so_far", "at_1", "at_2")], *[F.lit(None).cast("bigint").alias(c) for c in ("up_1", "up_2")])
    return ends, classes, stored(root.unionByName(rows), "suffixes")


def burst(rows: DataFrame, container_turns: int) -> DataFrame:
    """(rep, depth, at_1, at_2): the container each class comes to rest in, named by its topmost node; classes that end in a head have none."""
    rest, live, low, high = [], None, 0, 0
    while True:
        window = rows.where(F.col("depth").between(low, high)).select("rep", "len", "depth", "at_1", "at_2")
        if live is not None:
            window = window.join(live, "rep", "left_semi")
        sizes = window.groupBy("depth", "at_1", "at_2").agg(F.count("*").alias("classes"), F.sum(F.col("len") - F.col("depth") + 1).alias("turns"))
        over = stored(sizes.where((F.col("classes") > 1) & (F.col("turns") > container_turns)).select("depth", "at_1", "at_2", F.lit(True).alias("over")), "oversized")
        marked = window.join(over, ["depth", "at_1", "at_2"], "left")
        first = F.min(F.when(F.col("over").isNull(), F.struct("depth", "at_1", "at_2"))).alias("c")
        moved = stored(marked.groupBy("rep").agg(first, F.max("len").alias("len")), "moved")
        rest.append(moved.where("c IS NOT NULL").select("rep", "c.*"))
        live, n = stored_rows(moved.where(F.col("c").isNull() & (F.col("len") > high)).select("rep"), "live")
        if not n:
            out = rest[0]
            for r in rest[1:]:
                out = out.unionByName(r)
            return out
        low, high = high + 1, 2 * high + 2


def sweep(suffixes: list[tuple[int, int, list[int], list[int]]], top: int) -> list[list]:
    """The nodes of one container: [conv_id, depth, parent's index or None, n_convs, n_children, n_leaves, saved, ends].

    ``suffixes``: (rep, m, ids, words) of each class, from the container's topmost node, of depth ``top``, on.
    """
    nodes: list[list] = []
    path: list[int] = []

    def close(depth: int) -> None:
        while len(path) > depth:
            node = nodes[path.pop()]
            node[5] = node[5] or 1
            node[6] += (node[3] - 1) * node[8]
            if path:
                above = nodes[path[-1]]
                above[0] = node[0] if above[0] is None else min(above[0], node[0])
                above[3] += node[3]
                above[4] += 1
                above[5] += node[5]
                above[6] += node[6]

    before: list[int] = []
    for rep, m, ids, words in sorted(suffixes, key=lambda s: s[2]):
        shared = 0
        for x, y in zip(before, ids, strict=False):
            if x != y:
                break
            shared += 1
        close(shared)
        for k in range(shared, len(ids)):
            nodes.append([None, top + k, path[-1] if path else None, 0, 0, 0, 0, None, words[k]])
            path.append(len(nodes) - 1)
        node = nodes[path[-1]]
        node[0] = rep if node[0] is None else min(node[0], rep)
        node[3] += m
        node[7] = rep
        before = ids
    close(0)
    return nodes


def _swept():
    def nodes_of(columns: dict[str, np.ndarray], lo: int, hi: int) -> list[tuple]:
        reps = columns["rep"][lo:hi]
        cuts = [0, *(np.flatnonzero(reps[1:] != reps[:-1]) + 1).tolist(), hi - lo]
        ids, words = columns["id"][lo:hi].tolist(), columns["words"][lo:hi].tolist()
        suffixes = [(int(reps[a]), int(columns["m"][lo + a]), ids[a:b], words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        nodes = sweep(suffixes, int(columns["top"][lo]))
        above = (columns["up_1"][lo], columns["up_2"][lo]) if columns["top"][lo] else (None, None)  # nothing is above the root
        return [(n[0], n[1], None if n[2] is None else nodes[n[2]][0], *n[3:8], *(above if n[2] is None else (None, None))) for n in nodes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in _and_end(batches):
            if batch is not None:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
                if not len(held):
                    continue
            if held is None or not len(held):
                return
            columns = {c: held[c].fill_null(0).to_numpy() for c in held.column_names}
            new = np.flatnonzero((columns["k_1"][1:] != columns["k_1"][:-1]) | (columns["k_2"][1:] != columns["k_2"][:-1]) | (columns["top"][1:] != columns["top"][:-1])) + 1
            cuts = [0, *new.tolist()] + ([len(held)] if batch is None else [])
            out: list[tuple] = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                out += nodes_of(columns, lo, hi)
                if len(out) >= 20_000:
                    yield _node_batch(out)
                    out = []
            if out:
                yield _node_batch(out)
            held = held.slice(cuts[-1]).combine_chunks() if batch is not None else None

    return run


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_NODES_ARROW)


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(len, end_1, end_2, sha256): per class the digest of its members' decimal ids, ascending, comma-joined.

    Sorted ranges of the ids are joined to long strings first, so the task that hashes a class of
    whatever size reads few rows of bounded length, one after another.
    """
    key = ["len", "end_1", "end_2"]
    n = partitions(ends.sparkSession)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch[c].to_numpy() for c in key]
            new = np.zeros(batch.num_rows, dtype=bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            at = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            ids = batch["conv_id"].to_pylist()
            first = np.array(at[:-1])
            text = [",".join(map(str, ids[a:b])) for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[first]) for c in cols], pa.array([ids[a] for a in at[:-1]], pa.int64()), pa.array(text, pa.string())], names=[*key, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for *k, text in zip(*(batch[c].to_pylist() for c in [*key, "ids"]), strict=True):
                if k == last:
                    state.update(b"," + text.encode())
                    continue
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = k, hashlib.sha256(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=[*key, "sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*last, state.hexdigest())], names=[*key, "sha256"])

    ids = "len bigint, end_1 bigint, end_2 bigint"
    runs = ends.select(*key, "conv_id").repartitionByRange(n, *key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInArrow(joined, f"{ids}, first bigint, ids string")
    return runs.repartition(n, *key).sortWithinPartitions(*key, "first").mapInArrow(hashed, f"{ids}, sha256 string")


def _head_nodes(head_rows: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of the heads, with their place: the columns of nodes, and at_1, at_2."""
    heads = head_rows.groupBy("depth", "at_1", "at_2").agg(
        F.min("rep").alias("conv_id"), F.sum("m").alias("n_convs"), F.max("words").alias("words"), F.max("up_1").alias("up_1"), F.max("up_2").alias("up_2"), F.max(F.when(F.col("len") == F.col("depth"), F.col("rep"))).alias("ends")
    )
    heads = stored(heads, "heads")
    above = lambda t: t.select((F.col("depth") - 1).alias("depth"), F.col("up_1").alias("at_1"), F.col("up_2").alias("at_2")).where("at_1 IS NOT NULL")
    children = above(heads).unionByName(above(tops)).groupBy("depth", "at_1", "at_2").agg(F.count("*").alias("n_children"))
    # each head's and container's own value, given to the smallest class that runs through it
    none = F.lit(0).cast("bigint")
    own = heads.select(F.col("conv_id").alias("rep"), "depth", none.alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    below = tops.select(F.col("conv_id").alias("rep"), "depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    given = own.unionByName(below)
    path = head_rows.select("rep", "depth", none.alias("leaves"), none.alias("saved"), "at_1", "at_2").join(given.select("rep").distinct(), "rep", "left_semi")
    path = path.unionByName(given, allowMissingColumns=True).groupBy("rep", "depth").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved")], *[F.max(c).alias(c) for c in ("at_1", "at_2")])
    numbers = path.select("rep", (-F.col("depth")).alias("back"), "leaves", "saved", *[F.coalesce(c, none).alias(c) for c in ("at_1", "at_2")])
    summed = running(numbers, "rep", ["back"], sums=("leaves", "saved")).select((-F.col("back")).alias("depth"), "at_1", "at_2", "sum_0", "sum_1")
    subtree = summed.groupBy("depth", "at_1", "at_2").agg(F.sum("sum_0").alias("n_leaves"), F.sum("sum_1").alias("saved_tokens"))
    place = ["depth", "at_1", "at_2"]
    return stored(heads.join(children, place).join(subtree, place).withColumn("parent_conv_id", F.lit(None).cast("bigint")).select(*_NODE_NAMES, "at_1", "at_2"), "head_nodes")


def conversation_trie(turns: DataFrame, *, container_turns: int = 50_000, every: int = 20) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the
    smallest member, the node's depth, its parent's smallest member (root: null), members, children,
    childless nodes of the subtree, tokens saved in the subtree by keeping each shared last text
    once, and the digest of the ids of the members that end there.

    Turns are ordered by ``turn`` (null first; equal ones by the hash of role and text); a null role
    or text is empty.  Rows that repeat are turns each; rows without a conv_id are left out.  A
    conversation without turns left ends at the root.  Other columns play no part.  An empty table
    gives no rows.
    """
    spark = turns.sparkSession
    with scratch(spark):
        convs, rebuilt = branches(turns, every)
        ends, classes, rows = classes_of(convs, rebuilt)
        rest = stored(burst(rows, container_turns), "containers")
        place = ["depth", "at_1", "at_2"]
        several = rest.groupBy(*place).agg((F.count("*") > 1).alias("several"))
        # a container's classes are few, but many containers are dealt: no key is hot
        named = stored(rest.join(several, place).select("rep", F.col("depth").alias("top"), F.col("at_1").alias("k_1"), F.col("at_2").alias("k_2"), "several"), "resting")
        placed = stored(rows.join(named, "rep", "left"), "placed")
        head_rows = placed.where("top IS NULL OR depth < top")
        swept = placed.where("several AND depth >= top").select("k_1", "k_2", "top", "rep", "depth", "m", "id", "words", "up_1", "up_2")
        swept = swept.repartition(partitions(spark), "k_1", "k_2", "top").sortWithinPartitions("k_1", "k_2", "top", "rep", "depth").mapInArrow(_swept(), _NODES)
        chain = placed.where("NOT several AND depth >= top").select(
            F.col("rep").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > F.col("top"), F.col("rep")).alias("parent_conv_id"),
            F.col("m").alias("n_convs"),
            (F.col("depth") < F.col("len")).cast("bigint").alias("n_children"),
            F.lit(1).cast("bigint").alias("n_leaves"),
            ((F.col("m") - 1) * (F.col("total") - F.col("so_far") + F.col("words"))).alias("saved_tokens"),
            F.when(F.col("depth") == F.col("len"), F.col("rep")).alias("ends"),
            *[F.when(F.col("depth") == F.col("top"), F.col(c)).alias(c) for c in ("up_1", "up_2")],
        )
        low = stored(swept.unionByName(chain), "low_nodes")
        tops = low.where("parent_conv_id IS NULL")
        heads = _head_nodes(head_rows, tops)
        # heads and the containers' topmost nodes learn their parent's smallest member
        high = tops.unionByName(heads.select(*_NODE_NAMES))
        parents = heads.select((F.col("depth") + 1).alias("depth"), F.col("at_1").alias("up_1"), F.col("at_2").alias("up_2"), F.col("conv_id").alias("parent"))
        root = high.where("up_1 IS NULL")
        under = high.where("up_1 IS NOT NULL").join(parents, ["depth", "up_1", "up_2"]).withColumn("parent_conv_id", F.col("parent")).select(*_NODE_NAMES)
        nodes = low.where("parent_conv_id IS NOT NULL").unionByName(root).unionByName(under)
        key = ["len", "end_1", "end_2"]
        digests = digests_of_ends(ends).join(classes, key).select(F.col("rep").alias("ends"), "sha256")
        out = nodes.where("ends IS NOT NULL").join(digests, "ends").withColumn("ends_sha256", F.col("sha256"))
        inner = nodes.where("ends IS NULL").withColumn("ends_sha256", F.lit(NO_ENDS))
        names = [*_NODE_NAMES[:7], "ends_sha256"]
        return stored(out.select(*names).unionByName(inner.select(*names)), "trie", keep=True)


#: DuckDB SQL of the registered query: every prefix of every rebuilt conversation, as lists (turns of equal number by role and text)
ORACLE = r"""
WITH byte AS (
  SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)::BIGINT[]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256))::BIGINT AS b))
), conv AS (
  SELECT conv_id, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(crc[xor(c, b) % 256 + 1], c // 256))) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), byte
), turn AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce("text", '')) AS pos, {'role': coalesce(role, ''), 'text': coalesce("text", '')} AS t
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT conv_id, pos, t FROM turn JOIN conv USING (conv_id) WHERE pos > h
  UNION ALL SELECT c.conv_id, pos, t FROM conv c JOIN turn b ON b.conv_id = c.conv_id - c.conv_id % 20 WHERE pos <= h
), seq AS (
  SELECT conv_id, coalesce(s, []) AS s FROM conv LEFT JOIN (SELECT conv_id, list(t ORDER BY pos) AS s FROM rebuilt GROUP BY conv_id) USING (conv_id)
), member AS (
  SELECT conv_id, s[:d] AS node, d, len(s) = d AS ends FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM seq)
), node AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM member GROUP BY node, d
), child AS (
  SELECT node[:d - 1] AS node, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), own AS (
  SELECT node, d, coalesce(n_children, 0) = 0 AS leaf, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')) END AS saved FROM node LEFT JOIN child USING (node)
), subtree AS (
  SELECT node[:k] AS node, count_if(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(d + 1)) AS k FROM own) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n LEFT JOIN child USING (node) JOIN subtree USING (node) LEFT JOIN node p ON n.d > 0 AND p.node = n.node[:n.d - 1]
"""
