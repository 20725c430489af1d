"""Set-similarity join on word shingles with rare-first prefix filtering.

A document's set is its distinct word shingles.  Documents with equal sets form one
*class* (its key is a 64-bit hash of the set), so copies meet once whatever their
number.  Steps:

1. One pass over the texts (NumPy over Arrow bytes) makes each class's shingle hashes
   and sends them to hash buckets, as compact runs (class key, 6 bytes per shingle).
2. Each bucket counts in how many classes a shingle occurs.  A shingle of one class
   cannot give a candidate, so only shared shingles go back to their classes.  Buckets are as
   many as the bytes of the texts ask for.  A shingle that a bounded sample of the texts shows
   to be very frequent would be one bucket's load: it counts as most frequent and goes to its
   classes directly (any one order of the shingles serves the prefixes).
3. Each class orders its shingles rare first (unshared ones come first, ties by hash)
   and takes the prefix that any partner must meet: n - ceil(t n) + 1 shingles.  A class
   whose prefix is all unshared is finished here; nearly all of them are.
4. Classes that share a prefix shingle are candidates.  Instead of all pairs of a group,
   each round compares the members with one pivot of the group (linear in the group) and
   merges what links; members that are by then in one component need no comparison.
   Whatever is left between different components of a group is compared in full at the
   end, so no link between components can be missed.
5. A pair passes the length, positional and suffix filters before its sets are
   intersected, once per pair.  The suffix filter bounds the difference of two sets from
   below by their parity sketches; at the end it is part of the join, so that what cannot
   link is no row.

Shingles are compared by 48 bits of a 64-bit hash: within one pair of 1000-shingle
documents a false match has probability below 1e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.bytetext import mix, release_memory, releasing, releasing_groups, shingle_sets, text_blocks
from feedlens.llm.components import components
from feedlens.llm.sketches import SKETCH_WORDS, apart, parity_sketches
from feedlens.llm.storage import fresh_names, only, partitions, scratch, stored, stored_rows, text_batches

#: rounds of pivots before what is left is compared
ROUNDS = 2
#: distinct texts in the sample that finds very frequent shingles, and the share of them, and least number, that makes one
SAMPLE_TEXTS = 20_000
FREQUENT_SHARE, FREQUENT_LEAST = 0.02, 64
#: bytes of text per bucket
BUCKET_BYTES = 64 << 20
#: a bucket's shingles are sorted in a Python worker's memory, this many slices one after another
SLICES = 4
#: shingles gathered by a task before it writes its runs: sorting them takes some 150 bytes each
FLUSH_SHINGLES = 250_000
#: bytes of text that are hashed at a time: their words and shingles take some 50 times as much
HASHED_BYTES = 256 << 10

_RUNS = "part int, docs array<bigint>, refs array<bigint>, keys array<bigint>, counts array<int>, hashes binary, freqs binary"
_RUNS_ARROW = pa.schema(
    [("part", pa.int32()), ("docs", pa.list_(pa.int64())), ("refs", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("hashes", pa.binary()), ("freqs", pa.binary())]
)
_SETS = "kind int, doc_id bigint, ref bigint, key bigint, n int, prefix int, unshared int, shared array<bigint>, sketch array<bigint>"
_SETS_ARROW = pa.schema(
    [("kind", pa.int32()), ("doc_id", pa.int64()), ("ref", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("prefix", pa.int32()), ("unshared", pa.int32()), ("shared", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))]
)


#: the frequency that the most frequent shingles are given
_FREQ_MOST = np.array([65535], "<u2")


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _pack(h: np.ndarray) -> bytes:
    """Six bytes a value: the low 32 bits of all, then the middle 16 bits of all."""
    return (h & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + ((h >> np.uint64(32)) & np.uint64(0xFFFF)).astype("<u2").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    low = np.frombuffer(blob, "<u4", n).astype(np.uint64)
    return low | (np.frombuffer(blob, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _RUNS_ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RUNS_ARROW, strict=True)], schema=_RUNS_ARROW)


def _runs_by(part: np.ndarray, key: np.ndarray, h: np.ndarray) -> Iterator[tuple]:
    """Per value of ``part``: (it, classes, shingles of each, their hashes packed), in the order given."""
    if not len(part):
        return
    order = np.argsort(part.astype(np.uint16) if part.max() < 65536 else part, kind="stable")
    values, at = np.unique(part[order], return_index=True)
    for p, rows in zip(values.tolist(), np.split(order, at[1:]), strict=True):
        k, c = _key_runs(key[rows])
        yield p, k.view(np.int64), c.astype(np.int32), _pack(h[rows])


def _key_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of equal neighbours: (value, length)."""
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.concatenate((at, [len(keys)])))


def _listed(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0), HASHED_BYTES):
                h, n = np.unique(shingle_sets(data, offsets, width)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    return run


def frequent_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """(hashes of the shingles that many of a sample of (ref, text) hold, bytes of all texts).

    At most the mean size of a set divided by ``FREQUENT_SHARE`` shingles can be that frequent.
    """
    n, size = texts.agg(F.approx_count_distinct("ref"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    sample = texts.where(F.pmod("ref", F.lit(max(1, n // SAMPLE_TEXTS))) == 0).groupBy("ref").agg(F.min("text").alias("text"))
    with text_batches(texts.sparkSession):
        held = stored(sample.select("text").mapInArrow(releasing(_listed(width)), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_LEAST), "frequent")
    found = held.where(F.col("n") >= FREQUENT_SHARE * min(n, SAMPLE_TEXTS)).select("h").toArrow()["h"].to_numpy()
    return np.sort(found.view(np.uint64)), int(size)


def _shingle_runs(width: int, parts: int, frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        heads: list[tuple] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            rows: list[tuple] = []
            if held:
                key = np.concatenate([k for k, _ in held])
                h = np.concatenate([x for _, x in held])
                if len(frequent):
                    straight = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
                    rows += [(parts + p, None, None, *run, _FREQ_MOST.tobytes() * int(run[1].sum())) for p, *run in _runs_by(_bucket(key[straight], parts), key[straight], h[straight])]
                    key, h = key[~straight], h[~straight]
                rows += [(p, None, None, *run, None) for p, *run in _runs_by(_bucket(h, parts), key, h)]
            if heads:
                doc_ids, refs, keys, sizes, sketches = (list(x) for x in zip(*heads, strict=True))
                part = _bucket(np.array(keys, np.uint64), parts)
                for p in np.unique(part):
                    at = np.flatnonzero(part == p)
                    rows.append((parts + int(p), [doc_ids[i] for i in at], [refs[i] for i in at], np.array([keys[i] for i in at], np.uint64).view(np.int64), np.array([sizes[i] for i in at], np.int32), b"".join(sketches[i] for i in at), None))
            held.clear()
            heads.clear()
            return _rows(rows)

        for batch in batches:
            ids, refs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, data, offsets in text_blocks(batch.column(2), HASHED_BYTES):
                doc, h, sizes = shingle_sets(data, offsets, width)
                ends = np.cumsum(sizes)
                some = np.flatnonzero(sizes)
                # key of a set: a sum of mixed elements, mixed with its size (order-free); 0 is kept for the empty set
                keys = np.zeros(len(sizes), np.uint64)
                if len(some):
                    keys[some] = mix(np.add.reduceat(mix(h ^ np.uint64(0x9E3779B97F4A7C15)), (ends - sizes)[some]) + sizes[some].astype(np.uint64))
                sketches = np.zeros((len(sizes), SKETCH_WORDS), "<u8")
                if len(some):
                    sketches[some] = parity_sketches(h, (ends - sizes)[some])
                new = np.zeros(len(sizes), dtype=bool)
                for d in range(len(sizes)):
                    k = int(keys[d])
                    heads.append((ids[first + d], refs[first + d], k, int(sizes[d]), sketches[d].tobytes()))
                    if sizes[d] and k not in seen:
                        seen.add(k)
                        new[d] = True
                take = new[doc]
                if take.any():
                    held.append((keys[doc[take]], h[take]))
                    n_held += int(take.sum())
                if n_held >= FLUSH_SHINGLES or len(heads) >= 200_000:
                    yield flush()
                    n_held = 0
        yield flush()

    return run


def _several(runs: list[tuple[np.ndarray, np.ndarray, bytes]], low: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, number of classes) of the shingles of one slice of a bucket that several classes hold."""
    owners, hashes = [], []
    for keys, counts, blob in runs:
        h = _unpack(blob)
        at = np.flatnonzero(h % np.uint64(SLICES) == low)
        owners.append(np.repeat(keys, counts)[at])
        hashes.append(h[at])
    h, owner = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(h)
    h, owner = h[order], owner[order]
    several = np.zeros(len(h), dtype=bool)
    equal = h[1:] == h[:-1]
    several[1:] |= equal
    several[:-1] |= equal
    h, owner = h[several], owner[several]
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    first = np.ones(len(h), dtype=bool)  # a class can come from several tasks
    first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[first], owner[first]
    _, size = _key_runs(h)
    freq = np.repeat(size, size)
    keep = freq > 1
    return h[keep], owner[keep].view(np.uint64), np.minimum(freq[keep], 65535)


def _share(parts: int):
    """Of one bucket: the shingles that several classes hold, sent on by class."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if part >= parts:  # which documents belong to which class: on to the class's bucket
            return table.set_column(0, "part", pa.array(np.full(len(table), part - parts, np.int32)))
        runs = [(np.array(k, np.int64), np.array(c), b) for k, c, b in zip(*(table[x].to_pylist() for x in ("keys", "counts", "hashes")), strict=True)]
        release_memory()
        found = [_several(runs, low) for low in range(SLICES)]
        h, owner, freq = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(owner, kind="stable")
        h, owner, freq = h[order], owner[order], freq[order]
        to = _bucket(owner, parts)
        rows = []
        for p in np.unique(to):
            lo, hi = np.searchsorted(to, (p, p + 1))
            k, c = _key_runs(owner[lo:hi])
            rows.append((int(p), None, None, k.view(np.int64), c.astype(np.int32), _pack(h[lo:hi]), freq[lo:hi].astype("<u2").tobytes()))
        return pa.Table.from_batches([_rows(rows)])

    return releasing_groups(run)


def _order(num: int, den: int):
    """Of one bucket of classes: their documents, and the classes whose rare-first prefix holds a shared shingle."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        docs, refs, owners, sizes, sketches = [], [], [], [], []
        ent_key, ent_h, ent_f = [], [], []
        for d, r, k, c, h, f in zip(*(table[x].to_pylist() for x in ("docs", "refs", "keys", "counts", "hashes", "freqs")), strict=True):
            if d is not None:
                docs += d
                refs += r
                owners.append(np.array(k, np.int64))
                sizes.append(np.array(c, np.int64))
                sketches.append(np.frombuffer(h, "<i8").reshape(-1, SKETCH_WORDS))
            else:
                ent_key.append(np.repeat(np.array(k, np.int64), c))
                ent_h.append(_unpack(h))
                ent_f.append(np.frombuffer(f, "<u2"))
        none = np.zeros(0, np.int64)
        owner, n = (np.concatenate(x) if x else none for x in (owners, sizes))
        out = [_sets(len(docs), kind=np.zeros(len(docs), np.int32), doc_id=docs, ref=refs, key=owner, n=n)]
        if ent_key:
            cls, at = np.unique(owner, return_index=True)
            cls_n, cls_sketch = n[at], np.concatenate(sketches)[at]
            k, h, f = np.concatenate(ent_key), np.concatenate(ent_h), np.concatenate(ent_f)
            order = np.lexsort((h, f, k))
            k, h = k[order], h[order]
            new = np.ones(len(k), dtype=bool)  # a class's frequent shingles can come from several tasks
            new[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
            k, h = k[new], h[new]
            ks, m = _key_runs(k)
            at = np.searchsorted(cls, ks)
            size = cls_n[at]
            prefix = size - (num * size + den - 1) // den + 1
            live = size - m < prefix
            if live.any():
                lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(m[live]))).astype(np.int32), pa.array(h[np.repeat(live, m)].view(np.int64)))
                sketch = pa.FixedSizeListArray.from_arrays(pa.array(cls_sketch[at][live].ravel(), pa.int64()), SKETCH_WORDS).cast(pa.list_(pa.int64()))
                out.append(_sets(int(live.sum()), kind=np.ones(int(live.sum()), np.int32), key=ks[live], n=size[live], prefix=prefix[live], unshared=(size - m)[live], shared=lists, sketch=sketch))
        return pa.concat_tables(out)

    return releasing_groups(run)


def _sets(rows: int, **columns) -> pa.Table:
    def column(f: pa.Field):
        x = columns.get(f.name)
        if x is None:
            return pa.nulls(rows, f.type)
        return x if isinstance(x, pa.Array) else pa.array(x, type=f.type)

    return pa.Table.from_arrays([column(f) for f in _SETS_ARROW], schema=_SETS_ARROW)


def _differ_little(num: int, den: int) -> Column:
    """Suffix filter: the sketches do not exclude that (n, sketch) and (n_2, sketch_2) link."""
    most = F.col("n") + F.col("n_2") - 2 * F.ceil(num * (F.col("n") + F.col("n_2")) / F.lit(num + den))
    return apart("sketch", "sketch_2") <= most


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose classes link: suffix filter, then one intersection per pair."""
    narrow = sets.select("key", "n", "sketch")
    near = pairs.join(narrow.withColumnRenamed("key", "a"), "a").join(_other(narrow).withColumnRenamed("key_2", "b"), "b").where(_differ_little(num, den)).select("a", "b")
    near = stored(near, "near")
    side = lambda s: sets.select(F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("shared").alias(f"set_{s}"))
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    return near.join(side("a"), "a").join(side("b"), "b").where(common * (num + den) >= num * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _other(members: DataFrame) -> DataFrame:
    return members.select(*[F.col(c).alias(f"{c}_2") for c in members.columns])


def _candidates(members: DataFrame, others: DataFrame, num: int, den: int, *also: Column) -> DataFrame:
    """Distinct (a, b) of members and others (columns with _2) that share a token and are in different components.

    Length and positional filters are part of the join: at the first shingle two classes share in the common
    order, what is left of the shorter rest bounds their overlap, so every linking pair passes there.
    """
    bound = F.least(F.col("n") - F.col("pos"), F.col("n_2") - F.col("pos_2")) * (num + den) >= num * (F.col("n") + F.col("n_2"))
    passes = (den * F.least("n", "n_2") >= num * F.greatest("n", "n_2")) & bound
    for condition in also:
        passes = passes & condition
    met = members.join(others, (F.col("token") == F.col("token_2")) & (F.col("comp") != F.col("comp_2")) & passes)
    return met.select(F.least("key", "key_2").alias("a"), F.greatest("key", "key_2").alias("b")).distinct()


def link_classes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) over the class keys in ``sets`` that have a link."""
    index = sets.select("key", "n", F.col("unshared").alias("u"), F.posexplode(F.expr("slice(shared, 1, prefix - unshared)")).alias("j", "token"))
    index = index.select("token", "key", "n", "u", (F.col("u") + F.col("j")).alias("pos"), F.col("key").alias("comp"))
    now, rows = stored_rows(index, "index")
    links = None
    for r in range(ROUNDS + 1):
        if links is not None:  # groups of one component are done
            labels = components(links).withColumnRenamed("node", "key")
            now = stored(now.drop("comp").join(labels, "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component"), "index", rows)
        # per token: the largest component, outside which members are left to compare
        sizes = now.groupBy("token", "comp").agg(F.count("*").alias("c")).groupBy("token").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("comps"))
        mains, left = stored_rows(sizes.where("comps > 1").select("token", F.col("m.comp").alias("main")), "mains", rows)
        if not left:
            break
        now = now.join(mains, "token")
        now = stored(now, "open", rows)
        outside = now.where("comp <> main").drop("main")
        now = now.drop("main")
        if r < ROUNDS:  # pivots: the members with the fewest unshared shingles, as they are nearest to what the group has in common
            near_common = F.struct("u", F.xxhash64("key", F.lit(r)).alias("h"), "key", "n", "pos", "comp")
            pivots = (now if r == 0 else outside).groupBy("token").agg(F.min(near_common).alias("p"))
            pivots = stored(pivots.select(F.col("token").alias("token_2"), *[F.col(f"p.{c}").alias(f"{c}_2") for c in ("key", "n", "pos", "comp")]), "pivots", rows)
            pairs = _candidates(now, pivots, num, den)
        else:  # the exact rest: members outside their group's largest component, against the group's other components
            sketch = sets.select("key", "sketch")
            pairs = _candidates(now.join(sketch, "key"), _other(outside.join(sketch, "key")), num, den, _differ_little(num, den))
        found = stored(_verified(stored(pairs, "pairs", rows), sets, num, den), "links", rows)
        links = found if links is None else links.unionByName(found)
    return components(links if links is not None else sets.select(F.col("key").alias("a"), F.col("key").alias("b")).limit(0))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_shingles, component_id).

    Words are runs of anything but ASCII white space, after lower-casing A-Z; a set
    holds the distinct ``width``-word shingles, or the whole sequence of a shorter
    text.  Two documents link when intersection / union >= threshold; component_id is
    the smallest doc_id reachable by links.

    Null, empty and blank texts have 0 shingles, link with nothing and are their own
    component.  Rows that repeat a doc_id are separate documents with one row each; a
    null doc_id takes part and is never the smallest id (a component of null ids only
    has a null id).  Columns other than the two named play no part.  An empty table
    gives no rows.
    """
    return document_groups(docs, id_col=id_col, text_col=text_col, width=width, threshold=threshold).select("doc_id", "n_shingles", "component_id")


def document_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """``near_duplicates`` with two more columns: ref, xxhash64 of the row's text, and group, a number that the
    documents of one component share (null for texts without shingles)."""
    spark = docs.sparkSession
    num, den = threshold
    texts = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("ref"), F.col("text").cast("string"))
    with scratch(spark):
        frequent, size = frequent_shingles(texts.select("ref", "text"), width)
        parts = max(partitions(spark), -(-size // BUCKET_BYTES))
        runs = texts.mapInArrow(releasing(_shingle_runs(width, parts, frequent)), _RUNS)
        shared = runs.groupBy("part").applyInArrow(_share(parts), _RUNS)
        with text_batches(spark):
            table, rows = stored_rows(shared.groupBy("part").applyInArrow(_order(num, den), _SETS), "sets", keep=True)
        owned = table.where("kind = 0").select("doc_id", "ref", "key", "n")
        sets = table.where("kind = 1").drop("kind", "doc_id", "ref")

        linked = link_classes(sets, num, den).withColumnRenamed("node", "key")
        least = stored(owned.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least")), "least", rows)
        members = stored(linked.join(least, "key"), "members", rows)
        ids = stored(members.groupBy("component").agg(F.min("least").alias("id")), "ids", rows)
        classes = least.join(members.join(ids, "component").select("key", "component", "id"), "key", "left")
        classes = stored(classes.select("key", F.coalesce("component", "key").alias("group"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("id")).alias("id")), "classes", rows, keep=True)
    found = owned.join(classes, "key", "left")
    return found.select("doc_id", "ref", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("n") > 0, F.col("id")).otherwise(F.col("doc_id")).alias("component_id"), "group")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs``, all columns, with one row of every group of near duplicates.

    The row with the smallest id stays (null last; then the smallest text hash; of rows equal in id and text any one).
    Texts without shingles all stay.
    """
    with scratch(docs.sparkSession):
        groups = stored(document_groups(docs, id_col=id_col, text_col=text_col, **options), "groups", keep=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "ref")).alias("first")
    ref, words, stay_id, stay_ref = fresh_names(docs, "ref", "words", "stay_id", "stay_ref")
    stay = groups.where("n_shingles > 0").groupBy("group").agg(first).select(F.col("first.doc_id").alias(stay_id), F.col("first.ref").alias(stay_ref))
    blank = F.btrim(F.coalesce(docs[text_col].cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r")) == ""
    rows = docs.withColumns({ref: F.xxhash64(docs[text_col]), words: ~blank})
    same = rows[id_col].cast("bigint").eqNullSafe(stay[stay_id]) & (rows[ref] == stay[stay_ref])
    worded = rows.where(F.col(words)).join(stay, same, "left_semi").dropDuplicates([id_col, ref])
    return worded.unionByName(rows.where(~F.col(words))).drop(ref, words)


#: DuckDB SQL of the registered query, from the definition (for small tables: it compares all pairs that share a shingle)
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), r AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) USING (doc_id)
"""
