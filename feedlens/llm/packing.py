"""Packing documents into sequences by the histogram of their lengths.

A document's ids (its tokens, then the end id) are cut into full pieces of
``max_length`` and one remainder.  The histogram of piece lengths, at most
``max_length`` numbers, goes to the driver.  Lengths are placed there longest first,
each into the pack with the most room left (the shortest pack), by counts of packing
patterns rather than by documents; the work is bounded by the lengths, not by the
corpus.  Pieces then find their place by their rank among the pieces of their length.
Ranks come from counts per (length, bucket) and a row number within each, so a length
that a third of all documents share is still dealt over all buckets.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.llm.bytetext import Words, releasing, text_blocks
from feedlens.llm.storage import only, partitions, stored, text_batches

#: words kept with their ids by each Python worker, three quarters of 2^21 slots (about 40 bytes a word, all told)
CACHE_WORDS = 3 << 19
#: bytes of text taken apart at a time
BLOCK_BYTES = 1 << 19
#: words encoded at a time
LEARN_WORDS = 4096

_STATE: dict[str, "WordTokenizer"] = {}
# letters that normalise to themselves or to one letter each, then a run of sentence marks: one or two pre-tokens
_PLAIN = regex.compile("[A-Za-zÀ-ÖØ-öø-ÿ]{1,40}[.,;:!?]{0,4}")
_LAST = "</w>"
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?")] = True
#: words that a tokenizer must code alike alone and among others
_PROBE = ["the", "The", "naïve,", "don't", "x1", "42", "...", "<|endoftext|>", "日本語", "a", "(b)", "e\u0301", "\U0001f600", "#tag", "'s", "Über."]


class WordIds:
    """Token ids of words by a hash of the word: an open hash table in flat arrays.

    A word is found by its 64-bit hash and its length (modulo 512); an entry's place packs the start of
    its ids, their number and the length.
    """

    def __init__(self, bits: int = 16) -> None:
        self.n = self.used = 0
        self._make(bits)
        self.ids = np.zeros(1 << bits, "<u4")

    def _make(self, bits: int) -> None:
        self.mask = (1 << bits) - 1
        self.key, self.place = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int64)

    def find(self, h: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        while len(left):
            at = slot[left]
            key, place = self.key[at], self.place[at]
            hit = (key == h[left]) & ((place & 511) == (length[left] & 511))
            out[left[hit]] = place[hit]
            left = left[~hit & (key != 0)]
            slot[left] = (slot[left] + 1) & self.mask
        return out

    def _place(self, h: np.ndarray, place: np.ndarray) -> None:
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        left = np.arange(len(h))
        while len(left):
            free = left[self.key[slot[left]] == 0]
            at, first = np.unique(slot[free], return_index=True)
            first = free[first]
            self.key[at], self.place[at] = h[first], place[first]
            placed = np.zeros(len(h), dtype=bool)
            placed[first] = True
            left = left[~placed[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def add(self, h: np.ndarray, length: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """New words, each once: the number of ids of each, and all ids."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.used], np.zeros(max(len(ids), len(self.ids) // 2), "<u4")))
        self.ids[self.used : self.used + len(ids)] = ids
        place = ((self.used + np.cumsum(size) - size) << 33) | (size << 9) | (length & 511)
        self.used, self.n = self.used + len(ids), self.n + len(h)
        if 4 * self.n > 3 * (self.mask + 1):
            held = np.flatnonzero(self.key)
            old = self.key[held], self.place[held]
            self._make((4 * self.n // 3).bit_length())
            self._place(*old)
        self._place(h, place)


class WordTokenizer:
    """Ids of texts by a word-level tokenizer file, a word at a time.

    A text's ids are the ids of its words (between ASCII white space, and cut where a sentence mark
    follows an ASCII letter) in order; each distinct word is encoded once.  Raises for a tokenizer
    whose tokens span white space or such a cut.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # ASCII letters need no normalisation but lower case, and no patterns to be cut by
        with open(path, encoding="utf-8") as f:
            spec = json.load(f) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.plain = Tokenizer.from_str(json.dumps(spec))
        known = sorted(t.removesuffix(_LAST) for t in self.tokenizer.get_vocab())
        sample = [t for t in known if t.isascii() and t.isalpha()][::40]
        sample = " ".join(sample + [a + b.capitalize() for a, b in zip(sample, reversed(sample), strict=True)])
        if self._encode(sample) != self.plain.encode(sample.lower(), add_special_tokens=False).ids:
            self.plain = None
        last = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            last[i] = token.endswith(_LAST)
        self.last = last
        alone = [i for w in _PROBE for i in self._encode(w)]
        marks = [".", ",", "!?", ".b", ":-)"]
        cut = any(self._encode(f"Word{m}") != self._encode("Word") + self._encode(m) for m in marks)
        if cut or any(self._encode(blank.join(_PROBE)) != alone for blank in (" ", "\n", " \t\n ")) or self._encode(" \t\r\n"):
            raise ValueError(f"{path}: tokens span white space; a text's ids are not its words' ids")
        self.kept = WordIds()

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _many(self, text: str, tokens: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray] | None:
        """(number of ids of each word, all ids) of the words of ``text``; ``tokens``: pre-tokens up to and with each."""
        if plain and self.plain is not None:
            found = self.plain.encode_batch_fast([text.lower()], add_special_tokens=False)
        else:
            found = self._encode_fast([text])
        ids = np.array(found[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.last[ids]) + 1  # of the pre-tokens
        if len(ends) != tokens[-1] or ends[-1] != len(ids):
            return None
        return np.diff(ends[tokens - 1], prepend=0), ids

    def _learn(self, h: np.ndarray, length: np.ndarray, spelled: list[bytes]) -> None:
        """Keeps the ids of new words."""
        letters = [w.isalpha() and len(w) <= 40 for w in spelled]  # of bytes: ASCII letters
        others = [k for k, plain in enumerate(letters) if not plain]
        marked = [k for k in others if _PLAIN.fullmatch(spelled[k].decode())]
        groups = [[k for k, plain in enumerate(letters) if plain], marked]
        rest = sorted(set(others).difference(marked))
        for group in groups:
            for i in range(0, len(group), LEARN_WORDS):
                some = group[i : i + LEARN_WORDS]
                text, plain = b" ".join([spelled[k] for k in some]).decode(), group is groups[0]
                tokens = np.arange(1, len(some) + 1) if plain else np.cumsum([1 if w[-1].isalpha() else 2 for w in text.split(" ")])
                found = self._many(text, tokens, plain)
                if found is None:
                    rest += some
                else:
                    self.kept.add(h[some], length[some], *found)
        for i in range(0, len(rest), LEARN_WORDS):
            some = rest[i : i + LEARN_WORDS]
            ids = [np.array(e.ids, "<u4") for e in self._encode_fast([spelled[k].decode() for k in some])]
            self.kept.add(h[some], length[some], np.array([len(x) for x in ids], np.int64), np.concatenate(ids))

    def _encode_fast(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a block in a row, number of ids of each text)."""
        words = Words(data, offsets, lower=False)
        cut = _MARK[data[1:]] & _ASCII_LETTER[data[:-1]]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        cut[inner - 1] = False  # between texts
        cut = np.flatnonzero(cut) + 1
        words.starts, words.ends = np.sort(np.concatenate((words.starts, cut))), np.sort(np.concatenate((words.ends, cut)))
        words.doc = np.repeat(np.arange(words.n_docs), np.diff(np.searchsorted(words.starts, offsets)))
        h, length = np.maximum(words.hashes(), np.uint64(1)), words.ends - words.starts  # 0 marks a free slot
        at = self.kept.find(h, length)
        missing = np.flatnonzero(at < 0)
        if self.kept.n + len(missing) > CACHE_WORDS:
            self.kept, missing = WordIds(), np.arange(len(h))
        raw = data.tobytes() if len(missing) else b""
        while len(missing):  # once, but for words equal in the hash and not in length
            new = missing[np.unique(h[missing], return_index=True)[1]]
            spelled = [raw[a:b] for a, b in zip(words.starts[new].tolist(), words.ends[new].tolist(), strict=True)]
            self._learn(h[new], length[new], spelled)
            at[missing] = self.kept.find(h[missing], length[missing])
            missing = missing[at[missing] < 0]
        size = (at >> 9) & 0xFFFFFF
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.kept.ids[np.repeat((at >> 33) - (ends - size), size) + np.arange(total)]
        return ids, np.bincount(words.doc, weights=size, minlength=words.n_docs).astype(np.int64)


_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _cut(path: str, end_id: int, max_length: int, keep_ids: bool):
    end = np.array([end_id], "<u4").tobytes()
    fields = [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("ids", pa.binary())] * keep_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _STATE.get(path)
        if tok is None:
            tok = _STATE[path] = WordTokenizer(path)
        step = 4 * max_length
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, data, offsets in text_blocks(batch.column(1), BLOCK_BYTES):
                ids, sizes = tok.encode(data, offsets)
                ends, rows = np.cumsum(sizes), []
                for k, (stop, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True), first):
                    blob = ids[stop - size : stop].tobytes() + end
                    n = size + 1
                    for a in range(0, len(blob), step):
                        piece = blob[a : a + step]
                        rows.append((doc_ids[k], a // 4, len(piece) // 4, zlib.crc32(piece), n, piece)[: len(fields)])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def token_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, max_length: int = 4096, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): the pieces of every document.

    ``ids`` holds a piece's ids as little-endian unsigned 32-bit numbers.  A null or
    empty text has the end id alone.
    """
    rows = only(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(releasing(_cut(tokenizer, end_id, max_length, keep_ids)), _PIECES + (", ids binary" if keep_ids else ""))


def pack_histogram(counts: dict[int, int], max_length: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in order, number of packs) by shortest pack first.

    Longest lengths are placed first; a length goes to the packs with the most room,
    a new pack is opened when none has room.  Each step fills a whole pattern or
    finishes a length, so the work follows the number of patterns, not of packs.
    """
    by_room: dict[int, list[tuple[list[int], int]]] = {}
    rooms: list[int] = []  # negated, a heap

    def put(pattern: list[int], n: int, room: int) -> None:
        if room not in by_room:
            by_room[room] = []
            heapq.heappush(rooms, -room)
        by_room[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if rooms and -rooms[0] >= length:
                room = -rooms[0]
                pattern, n = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    heapq.heappop(rooms)
                used = min(n, left)
                if n > used:
                    put(pattern, n - used, room)
                put([*pattern, length], used, room - length)
                left -= used
            else:  # a new pack is the only one with room, so it takes the length as often as it can
                times = min(max_length // length, left)
                put([length] * times, left // times, max_length - times * length)
                left -= left // times * times
    return [x for room in sorted(by_room) for x in by_room[room]]


def _slots(patterns: list[tuple[list[int], int]], max_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key = length * 2^40 + first rank, first sequence id, offset) of each slot of each pattern, by key."""
    taken = np.zeros(max_length + 1, np.int64)
    key, sequence, offset, at = [], [], [], 0
    for pattern, n in patterns:
        place = 0
        for length in pattern:
            key.append((length << 40) + int(taken[length]))
            sequence.append(at)
            offset.append(place)
            taken[length] += n
            place += length
        at += n
    order = np.argsort(np.array(key, np.int64))
    return tuple(np.array(x, np.int64)[order] for x in (key, sequence, offset))


def _place(slots: tuple[np.ndarray, np.ndarray, np.ndarray]):
    keys, sequences, offsets = slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = (batch["length"].to_numpy() << 40) + batch["rank"].to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(sequences[at] + key - keys[at]))
            yield out.append_column("offset", pa.array(offsets[at]))

    return run


def pack_pieces(pieces: DataFrame, max_length: int = 4096) -> DataFrame:
    """``pieces`` with sequence_id and offset: each sequence holds at most ``max_length`` ids, gapless from 0.

    ``pieces`` is read three times: give a stored table.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most max_length rows
    if counts and (min(counts) < 1 or max(counts) > max_length):
        raise ValueError(f"pack_pieces: lengths must lie in 1..{max_length}")
    slots = _slots(pack_histogram(counts, max_length), max_length)
    buckets = partitions(pieces.sparkSession)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")).select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    row = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    ranked = dealt.withColumn("row", row).join(first, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("row") - 1)
    ranked = ranked.select(*pieces.columns, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(releasing(_place(slots)), schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, max_length: int = 4096, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, (ids,) sequence_id,
    offset.  Every id of every document lies in exactly one piece.  Null and empty texts
    give one piece of the end id.  Rows that repeat a doc_id, or are equal in all
    columns, are packed each on its own; a null doc_id is kept as null.  Columns other
    than the two named play no part.  An empty table gives no rows.
    """
    pieces = token_pieces(docs, tokenizer, id_col=id_col, text_col=text_col, end_id=end_id, max_length=max_length, keep_ids=keep_ids)
    with text_batches(docs.sparkSession):
        pieces = stored(pieces, "pieces")
    return pack_pieces(pieces, max_length)


def sequences(packed: DataFrame, max_length: int = 4096, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids array<bigint>, n_ids, doc_ids): the padded sequences of pieces packed with ``keep_ids``."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["offset"].to_pylist(), table["ids"].to_pylist(), table["doc_id"].to_pylist(), strict=True), key=lambda r: r[0])
        ids = np.frombuffer(b"".join(r[1] for r in rows), "<u4").astype(np.int64)
        full = np.full(max_length, pad_id, np.int64)
        full[: len(ids)] = ids
        return pa.table({"sequence_id": [key[0].as_py()], "ids": pa.array([full], pa.list_(pa.int64())), "n_ids": pa.array([len(ids)], pa.int64()), "doc_ids": pa.array([[r[2] for r in rows]], pa.list_(pa.int64()))})

    return packed.select("sequence_id", "offset", "ids", "doc_id").groupBy("sequence_id").applyInArrow(build, "sequence_id bigint, ids array<bigint>, n_ids bigint, doc_ids array<bigint>")
