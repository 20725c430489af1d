"""Language-model scoring by prediction by partial matching (PPM).

The model is a trie of byte contexts.  A text is normalised (A-Z lower case, words joined by
one blank) and coded byte by byte, with an end symbol; the code length of a symbol comes
from the longest context seen in training, escaping to shorter ones (method D: a context
escapes with half a count for each of its distinct symbols) with exclusion of the symbols the
longer context already ruled out.  Because every symbol seen after a context is also seen
after each of its suffixes, the excluded set is exactly the symbols of the context escaped
from, so the totals after exclusion are one number per context and scoring is table look-ups.

* ``train``: each task counts (context, symbol) grams of the highest order and words of its
  texts and merges them before the shuffle; Spark sums them over all training texts.
  Lower orders are marginal sums.
* The order is the same at every size.  The most frequent grams of the highest order, at most
  ``max_grams``, travel with their code lengths; all other grams of a document go to hash buckets,
  where they meet the training occurrences of the same contexts and escape as in the whole trie.
* A bucket holds whole contexts: a gram goes by the shortest end of its context that is not heavy
  (has under 1 / 4096 of the training symbols).  The symbols of heavy contexts (at most 4096 of
  each length) travel too, so a bucket knows every context that its grams can escape to.
* Word counts of unbounded vocabularies stay distributed: words with at least 1 / 65536 of
  all tokens (so at most 65536) travel with the model; all other words of a document go
  to hash buckets, where they meet the training occurrences of the same word.

A model can be trained on any corpus and applied to another; ``adaptive_code_length`` scores a
single text by a model that learns as it reads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlens.llm.bytetext import Words, mix, text_blocks
from feedlens.llm.storage import only, partitions, stored

#: bytes that UTF-8 never uses: the context before a text, and the symbol after it
START, END = 0xFF, 0xFE
#: symbols a context can predict: all bytes but START
ALPHABET = 255
#: words with a smaller share of the tokens stay distributed
FREQUENT_SHARE = 1 / 65536
#: contexts with a smaller share of the symbols are kept whole in one bucket
HEAVY_SHARE = 1 / 4096
BUCKETS_PER_PARTITION = 2


def normalised(words: Words, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(stream, doc): per text ``pad`` START bytes, its words each followed by a blank, the last by END.

    ``doc`` is the text's index for symbols to predict and -1 for START.
    """
    n = words.n_docs
    lens = words.ends - words.starts
    size = np.bincount(words.doc, weights=lens + 1, minlength=n).astype(np.int64)
    none = words.counts == 0
    size[none] = 1
    total = size + pad
    begin = np.cumsum(total) - total
    stream = np.full(int(total.sum()), START, np.uint8)
    doc = np.repeat(np.arange(n), total)
    if len(lens):
        run = np.cumsum(lens + 1) - (lens + 1)  # place of a word among all words
        first = np.cumsum(words.counts) - words.counts
        at = run - np.repeat(run[np.minimum(first, len(run) - 1)], words.counts) + np.repeat(begin + pad, words.counts)
        letters = np.cumsum(lens) - lens
        position = np.arange(int(lens.sum())) - np.repeat(letters, lens)
        stream[position + np.repeat(at, lens)] = words.data[position + np.repeat(words.starts, lens)]
        stream[at + lens] = 0x20
    stream[begin + total - 1] = END
    for k in range(pad):
        doc[begin + k] = -1
    return stream, doc


def grams(stream: np.ndarray, order: int) -> np.ndarray:
    """Key of each position of ``stream`` with ``order`` bytes before it: the gram's bytes, oldest highest."""
    key = np.zeros(len(stream), np.uint64)
    for j in range(order + 1):
        key[j:] |= stream[: len(stream) - j].astype(np.uint64) << np.uint64(8 * j)
    return key


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    at = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[at], np.diff(np.concatenate((at, [len(values)])))


class _Counts:
    """Counts of uint64 values, merged now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, values: np.ndarray) -> None:
        self.parts.append(_counted(values))
        self.rows += len(self.parts[-1][0])
        if len(self.parts) > 1 and self.rows > 2 * len(self.parts[0][0]) + 500_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(self.parts) > 1:
            key = np.concatenate([k for k, _ in self.parts])
            n = np.concatenate([c for _, c in self.parts])
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            self.parts = [(key[at], np.add.reduceat(n, at))]
        self.rows = len(self.parts[0][0])
        return self.parts[0]


_COUNTS_ARROW = pa.schema([("kind", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, ends = (_Counts(), _Counts()), 0
        for batch in batches:
            for _, data, offsets in text_blocks(batch.column(0)):
                words = Words(data, offsets)
                stream, doc = normalised(words, order)
                tallies[0].add(grams(stream, order)[doc >= 0])
                tallies[1].add(words.hashes())
                ends += words.n_docs
        for kind, tally in enumerate(tallies):
            key, n = tally.merge()
            for a in range(0, len(key), 100_000):
                k = key[a : a + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[a : a + 100_000])], schema=_COUNTS_ARROW)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array([ends], pa.int64())], schema=_COUNTS_ARROW)

    return run


def train(texts: DataFrame, *, text_col: str = "text", max_order: int = 5) -> DataFrame:
    """Stored table (kind, gram, n) over all texts: kind 0 grams of ``max_order`` + 1 bytes, 1 words by hash, 2 texts."""
    rows = only(texts, text=text_col).select(F.col("text").cast("string"))
    counted = rows.mapInArrow(_count(max_order), "kind int, gram bigint, n bigint")
    return stored(counted.groupBy("kind", "gram").agg(F.sum("n").alias("n")), "ppm")


class Table:
    """Open-addressing hash table from uint64 keys to their place in ``keys``."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            stay = self.slots[slot] != left
            left, slot = left[stay], (slot[stay] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it is not held."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        slot = self._slot(keys)
        at = self.slots[slot].astype(np.int64)
        open_ = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(at[open_] >= 0) & (self.keys[at[open_]] != keys[open_])]
        return at


class Model:
    """The trie as arrays per order, made from the grams of the highest order and their counts.

    ``heavy`` has, for each lower order, contexts and all their grams and counts: these replace
    what ``key`` and ``n``, a part of the grams, say of those contexts.
    """

    def __init__(self, key: np.ndarray, n: np.ndarray, order: int, heavy: list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None) -> None:
        self.order = order
        self.grams: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        for k in range(order, -1, -1):
            cut = key & np.uint64((1 << (8 * (k + 1))) - 1)
            by = np.argsort(cut, kind="stable")
            cut, c = cut[by], n[by]
            at = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1]))) if len(cut) else np.zeros(0, np.int64)
            key, n = cut[at], (np.add.reduceat(c, at) if len(at) else c[:0])
            held, times = key, n
            if heavy and k < order:
                contexts, more, counts = heavy[k]
                own = ~np.isin(key >> np.uint64(8), contexts)
                held, times = np.concatenate((key[own], more)), np.concatenate((n[own], counts))
                by = np.argsort(held)
                held, times = held[by], times[by]
            self.grams.insert(0, held)
            self.counts.insert(0, times)
        self.prepared = False

    def prepare(self) -> Model:
        """Look-up tables and totals (made once by each Python worker)."""
        if self.prepared:
            return self
        self.tables = [Table(g) for g in self.grams]
        self.contexts, self.total, self.distinct, self.context_of = [], [], [], []
        for g, c in zip(self.grams, self.counts, strict=True):
            ctx = g >> np.uint64(8)
            at = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(ctx) else np.zeros(0, np.int64)
            self.contexts.append(Table(ctx[at]))
            self.total.append(np.add.reduceat(c, at) if len(at) else c[:0])
            self.distinct.append(np.diff(np.concatenate((at, [len(ctx)]))) if len(at) else c[:0])
            self.context_of.append(np.repeat(np.arange(len(at)), self.distinct[-1]) if len(at) else c[:0])
        # what an escape from a context of order k leaves in its suffix of order k - 1
        self.left_total, self.left_distinct = [None], [None]
        for k in range(1, self.order + 1):
            ctx = self.contexts[k].keys
            suffix = self.contexts[k - 1].find(ctx & np.uint64((1 << (8 * (k - 1))) - 1))
            below = self.tables[k - 1].find(self.grams[k] & np.uint64((1 << (8 * k)) - 1))
            ruled_out = np.bincount(self.context_of[k], weights=self.counts[k - 1][below], minlength=len(ctx)).astype(np.int64)
            self.left_total.append(self.total[k - 1][suffix] - ruled_out)
            self.left_distinct.append(self.distinct[k - 1][suffix] - self.distinct[k])
        k = self.order
        here = self.context_of[k]
        self.top = np.log10((2 * self.counts[k] - 1) / (2 * self.total[k])[here]) if len(here) else np.zeros(0)
        self.prepared = True
        return self

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol of each gram key after its context."""
        out = np.zeros(len(key))
        at = self.tables[self.order].find(key)
        found = at >= 0
        out[found] = self.top[at[found]]
        rest = np.flatnonzero(~found)
        node = self.contexts[self.order].find(key[rest] >> np.uint64(8))  # the context escaped from, -1: none seen yet
        k = self.order
        seen = node >= 0
        total, distinct = self.total[k][node[seen]], self.distinct[k][node[seen]]
        out[rest[seen]] += np.log10(distinct / (2 * total))
        while k > 0 and len(rest):
            k -= 1
            gram = key[rest] & np.uint64((1 << (8 * (k + 1))) - 1)
            at = self.tables[k].find(gram)
            after = node >= 0
            ctx = self.contexts[k].find(gram >> np.uint64(8))
            there = ctx >= 0
            total, distinct = np.zeros(len(rest), np.int64), np.zeros(len(rest), np.int64)
            total[there], distinct[there] = self.total[k][ctx[there]], self.distinct[k][ctx[there]]
            total[after], distinct[after] = self.left_total[k + 1][node[after]], self.left_distinct[k + 1][node[after]]
            hit = at >= 0
            out[rest[hit]] += np.log10((2 * self.counts[k][at[hit]] - 1) / (2 * total[hit]))
            miss = ~hit & (distinct > 0)
            out[rest[miss]] += np.log10(distinct[miss] / (2 * total[miss]))
            rest, node = rest[~hit], ctx[~hit]
        known = self.distinct[0][0] if len(self.distinct[0]) else 0
        out[rest] -= math.log10(max(1, ALPHABET - known))
        return out


def _ends(contexts: np.ndarray, length: int) -> np.ndarray:
    """The last ``length`` bytes of each context."""
    return contexts & np.uint64((1 << (8 * length)) - 1)


class Spread:
    """What travels of a trie whose grams are spread over buckets: frequent grams and the symbols of heavy contexts."""

    def __init__(self, order: int, parts: int, heavy: list[tuple[np.ndarray, np.ndarray]], frequent: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.order, self.parts = order, parts
        self.heavy = heavy  # per order below the highest: grams sorted, counts
        self.contexts = [np.unique(g >> np.uint64(8)) for g, _ in heavy]
        key, n, total = frequent
        part = self.part(key)
        by = np.argsort(part, kind="stable")
        self.key, self.n, self.logs = key[by], n[by], np.log10((2 * n - 1) / (2 * total))[by]
        self.bounds = np.searchsorted(part[by], np.arange(parts + 1))

    def prepare(self) -> Spread:
        """The look-up table of the frequent grams (made once by each Python worker)."""
        if not hasattr(self, "table"):
            self.table = Table(self.key)
        return self

    def part(self, key: np.ndarray) -> np.ndarray:
        """The bucket of each gram: that of the shortest end of its context that is not heavy."""
        context = key >> np.uint64(8)
        length = np.ones(len(key), np.uint64)
        left = np.arange(len(key))
        for k in range(1, self.order):
            left = left[np.isin(_ends(context[left], k), self.contexts[k])]
            length[left] = k + 1
        end = context & ((np.uint64(1) << (np.uint64(8) * length)) - np.uint64(1))
        return _bucket(mix(end + mix(length)), self.parts)

    def model(self, part: int, key: np.ndarray, n: np.ndarray, wanted: np.ndarray) -> Model:
        """The trie of one bucket, whose other trained grams are ``key``: exact for the grams ``wanted``."""
        a, b = self.bounds[part : part + 2]
        key, n = np.concatenate((self.key[a:b], key)), np.concatenate((self.n[a:b], n))
        context = np.unique(np.concatenate((key, wanted)) >> np.uint64(8))
        heavy = []
        for k, (grams_, counts) in enumerate(self.heavy):
            here = np.intersect1d(_ends(context, k), self.contexts[k])
            at = np.isin(grams_ >> np.uint64(8), here)
            heavy.append((here, grams_[at], counts[at]))
        return Model(key, n, self.order, heavy).prepare()


def _spread(counts: DataFrame, order: int, max_grams: int, parts: int) -> Spread:
    """At most ``max_grams`` grams and 4096 contexts of each length reach the driver, whatever the size of the trie."""
    spark = counts.sparkSession
    top = counts.where("kind = 0").select("gram", "n")

    def low(bytes_: int) -> Column:
        return F.col("gram").bitwiseAND(F.lit((1 << (8 * bytes_)) - 1))

    total = top.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ends = [F.struct(F.lit(k).alias("k"), F.shiftrightunsigned(low(k + 1), 8).alias("context"), low(k + 1).alias("gram")) for k in range(order)]
    each = top.select(F.explode(F.array(*ends)).alias("e"), "n").select("e.k", "e.context", "e.gram", "n")
    contexts = each.groupBy("k", "context").agg(F.sum("n").alias("n")).where((F.col("n") >= total * HEAVY_SHARE) | (F.col("k") == 0)).select("k", "context").collect()
    heavy = spark.createDataFrame([(r["k"], r["context"]) for r in contexts], "k int, context bigint")
    held = each.join(F.broadcast(heavy), ["k", "context"], "left_semi").groupBy("k", "gram").agg(F.sum("n").alias("n")).toArrow()
    k, gram, n = held["k"].to_numpy(), held["gram"].to_numpy().view(np.uint64), held["n"].to_numpy()
    per_order = []
    for i in range(order):
        at = np.flatnonzero(k == i)
        at = at[np.argsort(gram[at])]
        per_order.append((gram[at], n[at]))
    # counts up to 1024 each, then 64 levels for each power of two: the lowest level from which on all grams travel
    level = (F.least("n", F.lit(1024)) + F.floor(F.log2(F.greatest("n", F.lit(1024)).cast("double")) * 64)).cast("bigint")
    sizes = sorted(((r["level"], r["grams"]) for r in top.groupBy(level.alias("level")).agg(F.count("*").alias("grams")).collect()), reverse=True)
    least, room = None, max_grams
    for at, grams_ in sizes:
        room -= grams_
        if room < 0:
            break
        least = at
    if least is None:
        frequent = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    else:
        often = F.collect_list(F.when(level >= least, F.struct("gram", "n")))
        found = top.groupBy(F.shiftrightunsigned("gram", 8).alias("context")).agg(F.sum("n").alias("total"), often.alias("often"))
        found = found.select("total", F.explode("often").alias("g")).select("g.gram", "g.n", "total").toArrow()
        frequent = (found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy(), found["total"].to_numpy())
    return Spread(order, parts, per_order, frequent)


_RUNS = "part int, key array<bigint>, docs array<bigint>, held array<boolean>, ints array<bigint>, sums array<double>, blob binary"
_RUNS_ARROW = pa.schema([("part", pa.int32()), ("key", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("ints", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64())), ("blob", pa.binary())])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in _RUNS_ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _RUNS_ARROW, strict=True)], schema=_RUNS_ARROW)


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _per_text(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values of each text, with their text and how often they stand in it."""
    order = np.argsort(values)
    order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    values, owner = values[order], owner[order]
    at = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])))) if len(values) else np.zeros(0, np.int64)
    return values[at], owner[at], np.diff(np.concatenate((at, [len(values)])))


def _score(shared, parts: int):
    """Of each text: what its frequent grams and words add to its scores; its other words and grams go to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread, frequent, logs = shared.value
        spread.prepare()
        frequent = Table(frequent)
        held_words: list[tuple] = []
        held_grams: list[tuple] = []
        heads: list[tuple] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            rows: list[tuple] = []
            for held, base in ((held_words, 0), (held_grams, 2 * parts)):
                if not held:
                    continue
                key, h, tf, test = (np.concatenate(x) for x in zip(*held, strict=True))
                part = spread.part(h) if base else _bucket(h, parts)
                order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
                bounds = np.searchsorted(part[order], np.arange(parts + 1))
                for p in range(parts):
                    at = order[bounds[p] : bounds[p + 1]]
                    if len(at):  # entries of a text stand together: keys with their number of entries and held-out flag
                        k = key[at]
                        first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
                        size = np.diff(np.concatenate((first, [len(k)])))
                        rows.append((base + p, k[first].view(np.int64), None, test[at][first], size, None, h[at].tobytes() + tf[at].astype("<u4").tobytes()))
            if heads:
                key, docs, test, ints, sums = (list(x) for x in zip(*heads, strict=True))
                part = _bucket(np.array(key, np.int64).view(np.uint64), parts)
                for p in np.unique(part):
                    at = np.flatnonzero(part == p)
                    rows.append((parts + int(p), [key[i] for i in at], [docs[i] for i in at], [test[i] for i in at], [x for i in at for x in ints[i]], [x for i in at for x in sums[i]], None))
            held_words.clear()
            held_grams.clear()
            heads.clear()
            return _rows(rows)

        for batch in batches:
            keys = batch.column(0).to_numpy()
            docs = batch.column(1).to_pylist()
            tests = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for first, data, offsets in text_blocks(batch.column(3)):
                words = Words(data, offsets)
                n = words.n_docs
                own = keys[first : first + n]
                stream, doc = normalised(words, spread.order)
                gram, of = grams(stream, spread.order)[doc >= 0], doc[doc >= 0]
                at = spread.table.find(gram)
                often = at >= 0
                score = np.bincount(of[often], weights=spread.logs[at[often]], minlength=n)
                rare, owner, tf = _per_text(gram[~often], of[~often])
                if len(rare):
                    held_grams.append((own[owner].view(np.uint64), rare, tf, tests[first : first + n][owner]))
                    n_held += len(rare)
                h = words.hashes()
                at = frequent.find(h)
                often = at >= 0
                known = np.bincount(words.doc[often], minlength=n)
                base = np.bincount(words.doc[often], weights=logs[at[often]], minlength=n)
                rare, owner, tf = _per_text(h[~often], words.doc[~often])
                if len(rare):
                    held_words.append((own[owner].view(np.uint64), rare, tf, tests[first : first + n][owner]))
                    n_held += len(rare)
                for d in range(n):
                    heads.append((int(own[d]), docs[first + d], bool(tests[first + d]), (int(words.counts[d]) + 1, int(known[d])), (float(base[d]), float(score[d]))))
                if n_held >= 1_000_000 or len(heads) >= 100_000:
                    yield flush()
                    n_held = 0
        yield flush()

    return run


def _look_up(shared, parts: int):
    """Of one bucket of words or grams: what they add to the texts that hold them, sent on by text."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if parts <= part < 2 * parts:
            return table.set_column(0, "part", pa.array(np.full(len(table), part - parts, np.int32)))
        owners, tests, hs, tfs = [], [], [], []
        for k, test, size, blob in zip(*(table[c].to_pylist() for c in ("key", "held", "ints", "blob")), strict=True):
            m = len(blob) // 12
            owners.append(np.repeat(np.array(k, np.int64), size))
            tests.append(np.repeat(np.array(test, bool), size))
            hs.append(np.frombuffer(blob, "<u8", m))
            tfs.append(np.frombuffer(blob, "<u4", m, 8 * m))
        owner, test, h, tf = (np.concatenate(x) for x in (owners, tests, hs, tfs))
        kinds, word = np.unique(h, return_inverse=True)
        c = np.bincount(word, weights=np.where(test, 0, tf))
        text, at = np.unique(owner, return_inverse=True)
        to = _bucket(text.view(np.uint64), parts)
        if part >= 2 * parts:
            seen, c = c > 0, c.astype(np.int64)
            logs = shared.value[0].model(part - 2 * parts, kinds[seen], c[seen], kinds).log10(kinds)
            score = np.bincount(at, weights=tf * logs[word])
            return pa.Table.from_batches([_rows([(int(p), text[to == p], None, None, None, score[to == p], None) for p in np.unique(to)])])
        c = c[word]
        known = np.bincount(at, weights=np.where(c > 0, tf, 0)).astype(np.int64)
        base = np.bincount(at, weights=tf * np.log10(c + 1))
        return pa.Table.from_batches([_rows([(int(p), text[to == p], None, None, known[to == p], base[to == p], None) for p in np.unique(to)])])

    return run


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_sum double, score double"


def _gather(key: tuple, table: pa.Table) -> pa.Table:
    """Of one bucket of texts: heads with what the word and gram buckets add."""
    heads, of_words, of_grams = [], [], []
    for k, docs, test, ints, sums in zip(*(table[c].to_pylist() for c in ("key", "docs", "held", "ints", "sums")), strict=True):
        if docs is not None:
            heads += zip(k, docs, test, ints[::2], ints[1::2], sums[::2], sums[1::2], strict=True)
        elif ints is not None:
            of_words.append((np.array(k, np.int64), np.array(ints, np.int64), np.array(sums)))
        else:
            of_grams.append((np.array(k, np.int64), np.array(sums)))
    order = np.argsort(np.array([r[0] for r in heads], np.int64), kind="stable")
    # rows equal in id and text share a key: each added the same
    text, at, copies = np.unique(np.array([r[0] for r in heads], np.int64), return_inverse=True, return_counts=True)

    def added(parts: list[tuple], value: int) -> np.ndarray:
        if not parts:
            return np.zeros(len(heads))
        place = np.searchsorted(text, np.concatenate([x[0] for x in parts]))
        return (np.bincount(place, weights=np.concatenate([x[value] for x in parts]), minlength=len(text)) / copies)[at]

    more_known, more_base, more_score = added(of_words, 1), added(of_words, 2), added(of_grams, 1)
    cols = list(zip(*[heads[i] for i in order], strict=True))
    return pa.table(
        {
            "doc_id": pa.array(cols[1], pa.int64()),
            "held_out": pa.array(cols[2], pa.bool_()),
            "n_tokens": pa.array(cols[3], pa.int64()),
            "n_known": pa.array(np.array(cols[4]) + np.rint(more_known[order]).astype(np.int64)),
            "base_sum": pa.array(np.array(cols[5]) + more_base[order]),
            "score": pa.array(np.array(cols[6]) + more_score[order]),
        }
    )


def score_documents(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", max_order: int = 5, max_grams: int = 2_000_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Trains on the rows where ``held_out`` is not true and scores all rows with that model.
    Tokens: words (runs of anything but ASCII white space, A-Z in lower case), then one end.
    ``base_score``: sum over tokens of log10((c + 1) / (N + V + 1)) with c the token's count, N
    all, V distinct tokens in training; ``n_known``: tokens with c > 0.  ``score``: log10 of the
    model's probability of the normalised text and its end, by contexts of up to ``max_order`` bytes;
    ``max_grams`` bounds what travels and does not change it.

    Null and empty texts are the end alone.  Repeated rows are scored, and trained on, each on
    its own; a null id is kept.  Without training rows every symbol has probability 1 / 255.
    Columns other than the two named, and those ``held_out`` reads, play no part.  An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    parts = BUCKETS_PER_PARTITION * partitions(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("test"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = train(rows.where(~F.col("test")), max_order=max_order)
    totals = {r["kind"]: (r["n"], r["c"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("c")).collect()}
    texts = totals.get(2, (0, 0))[0]
    n = totals.get(1, (0, 0))[0] + texts
    v = totals.get(1, (0, 0))[1] + (texts > 0)
    frequent = counts.where((F.col("kind") == 1) & (F.col("n") >= max(1.0, n * FREQUENT_SHARE))).select("gram", "n").toArrow()  # at most 65536 words
    words, often = frequent["gram"].to_numpy().view(np.uint64), frequent["n"].to_numpy()
    shared = spark.sparkContext.broadcast((_spread(counts, max_order, max_grams, parts), words, np.log10(often + 1.0)))
    runs = rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "test", "text").mapInArrow(_score(shared, parts), _RUNS)
    found = runs.groupBy("part").applyInArrow(_look_up(shared, parts), _RUNS).groupBy("part").applyInArrow(_gather, _SCORES)
    each = math.log10(n + v + 1)
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.lit(1 if texts else 0)).cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base_sum") + F.lit(math.log10(texts + 1)) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        "score",
    )


def adaptive_code_length(text: str, max_order: int = 4) -> float:
    """Bits of ``text`` under a model that starts empty and learns each symbol after coding it."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    stream, _ = normalised(Words(data, np.array([0, len(data)])), max_order)
    seen: dict[bytes, dict[int, int]] = {}
    symbols, bits = stream.tobytes(), 0.0
    for i in range(max_order, len(symbols)):
        s, excluded, done = symbols[i], set(), False
        for k in range(max_order, -1, -1):
            held = seen.get(symbols[i - k : i])
            if not done and held:
                left = {x: c for x, c in held.items() if x not in excluded}
                if left:
                    weight = 2 * left[s] - 1 if s in left else len(left)
                    bits -= math.log2(weight / (2 * sum(left.values())))
                    done = s in left
                    excluded |= set(held)
        if not done:
            bits += math.log2(ALPHABET - len(excluded))
        for k in range(max_order + 1):
            held = seen.setdefault(symbols[i - k : i], {})
            held[s] = held.get(s, 0) + 1
    return bits
