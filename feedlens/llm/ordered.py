"""Ranks, running sums and prefix hashes of ordered groups of any size, without one task per group.

Rows are dealt by ranges of (key, order) and sorted, so a group may span several partitions.
One pass computes each value from the partition's start; a partition's first group may go on from
the partitions before it, and what it has to add, one row per partition, is found on the driver
from the states at the partitions' ends.  A second pass adds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.bytetext import mix
from feedlens.llm.storage import partitions, stored

_MASK = 2**64 - 1
#: a prefix hash is a polynomial in an odd multiplier; two of them, over differently mixed ids, make 128 bits
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SALTS = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2 ** 64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _element(ids: np.ndarray, k: int) -> np.ndarray:
    return mix(ids.view(np.uint64) ^ np.uint64(_SALTS[k]))


def _ids(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch[column].to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _states(n_sums: int, chain: bool) -> list[str]:
    return ["rank"] + [f"hash_{k}" for k in (1, 2)] * chain + [f"sum_{i}" for i in range(n_sums)]


def _local(key: str, chain: str | None, sums: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, rank0, hash0, sum0 = None, 0, [0, 0], [0] * len(sums)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = _ids(batch, key)
            new = np.ones(n, dtype=bool)
            new[1:] = keys[1:] != keys[:-1]
            new[0] = last is None or keys[0] != last
            at = np.flatnonzero(new)
            start = np.zeros(n, np.int64) if not len(at) else np.where(np.arange(n) < at[0], 0, at[np.maximum(np.searchsorted(at, np.arange(n), side="right") - 1, 0)])
            goes_on = np.arange(n) < (at[0] if len(at) else n)  # rows of the group the batch before ended in
            rank = np.arange(n) - start + 1 + np.where(goes_on, rank0, 0)
            columns = [rank]
            if chain is not None:
                ids = _ids(batch, chain)
                for k, base in enumerate(_BASES):
                    up, down = _powers(base, n), _powers(pow(base, -1, 2**64), n)
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_element(ids, k) * down[:n], dtype=np.uint64)))
                    value = (total[1:] - total[start]) * up[:n] + np.where(goes_on, up[1:] * np.uint64(hash0[k]), np.uint64(0))
                    hash0[k] = int(value[-1])
                    columns.append(value.view(np.int64))
            for i, c in enumerate(sums):
                total = np.concatenate(([0], np.cumsum(_ids(batch, c))))
                value = total[1:] - total[start] + np.where(goes_on, sum0[i], 0)
                sum0[i] = int(value[-1])
                columns.append(value)
            last, rank0 = keys[-1], int(rank[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), *[pa.array(c, pa.int64()) for c in columns]], schema=schema)

    return run


def _carried(ends: list, n_sums: int, chain: bool) -> dict[int, tuple]:
    """Per partition whose first group began before it: (key, state to add)."""
    at: dict[int, dict] = {}
    for r in ends:
        at.setdefault(r["part"], {})[r["key"]] = tuple(r["state"])
    out, carry = {}, None
    for part in sorted(at):
        keys = at[part]
        first, last = min(keys), max(keys)
        if carry is not None and carry[0] == first:
            out[part] = carry
            before, here = carry[1], keys[first]
            both = [before[0] + here[0]]
            if chain:
                both += [(before[1 + k] * pow(base, here[0], 2**64) + here[1 + k]) & _MASK for k, base in enumerate(_BASES)]
            both += [before[i] + here[i] for i in range(len(here) - n_sums, len(here))]
            keys = {**keys, first: tuple(both)}
        carry = (last, keys[last])
    return out


def _added(key: str, chain: str | None, sums: list[str], carried: dict[int, tuple], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            keys, parts, rank = _ids(batch, key), _ids(batch, "part"), _ids(batch, "rank")
            columns = {c: batch[c] for c in batch.schema.names if c != "part"}
            states = {c: _ids(batch, c).copy() for c in _states(len(sums), chain is not None)}
            for part in np.unique(parts).tolist():
                if part not in carried:
                    continue
                owner, state = carried[part]
                rows = np.flatnonzero((parts == part) & (keys == owner))
                states["rank"][rows] += state[0]
                if chain is not None:
                    for k, base in enumerate(_BASES):
                        up = _powers(base, int(rank[rows].max(initial=0)))[rank[rows]]
                        states[f"hash_{k + 1}"][rows] += (up * np.uint64(state[1 + k] & _MASK)).view(np.int64)
                for i in range(len(sums)):
                    states[f"sum_{i}"][rows] += state[len(state) - len(sums) + i]
            columns |= {c: pa.array(v, pa.int64()) for c, v in states.items()}
            if chain is not None:  # the hash before the row
                for k, base in enumerate(_BASES):
                    value = (states[f"hash_{k + 1}"].view(np.uint64) - _element(_ids(batch, chain), k)) * np.uint64(pow(base, -1, 2**64))
                    columns[f"before_{k + 1}"] = pa.array(value.view(np.int64))
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema) if n else pa.RecordBatch.from_pylist([], schema=schema)

    return run


def running(df: DataFrame, key: str, order: list[str], *, chain: str | None = None, sums: tuple[str, ...] = ()) -> DataFrame:
    """``df`` (columns of bigint) with each row's rank in its group and, up to and with the row, its sums and prefix hash.

    Groups are the rows of equal ``key`` (not null), in ascending ``order`` (null first; rows equal
    in it come in any order).  Added columns: rank (from 1); sum_0, sum_1 ... for ``sums`` (not
    null); with ``chain`` hash_1, hash_2, a 128-bit hash of the ids from the group's first row to
    this one, and before_1, before_2, that of the rows before (0, 0 at the first).
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType

    sums = list(sums)
    if any(not isinstance(f.dataType, LongType) for f in df.schema):
        raise TypeError("running: all columns must be bigint")
    fields = list(to_arrow_schema(df.schema))
    fields = [pa.field(f.name, f.type, True) for f in fields]
    states = [pa.field(c, pa.int64()) for c in _states(len(sums), chain is not None)]
    ddl = ", ".join(f"`{c}` bigint" for c in df.columns)
    state_ddl = ", ".join(f"{f.name} bigint" for f in states)
    dealt = df.repartitionByRange(partitions(df.sparkSession), key, *order).sortWithinPartitions(key, *order)
    local = stored(dealt.mapInArrow(_local(key, chain, sums, pa.schema([*fields, pa.field("part", pa.int32()), *states])), f"{ddl}, part int, {state_ddl}"), "ordered")
    outer = local.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))  # one row per partition
    outer = outer.select("part", F.explode(F.array_distinct(F.array("first", "last"))).alias("key"))
    state = F.max(F.struct(*[f.name for f in states])).alias("state")
    named = local.select("part", F.col(key).alias("key"), *[f.name for f in states])
    ends = named.join(F.broadcast(outer), ["part", "key"]).groupBy("part", "key").agg(state).collect()  # two rows per partition at most
    extra = [pa.field(f"before_{k}", pa.int64()) for k in (1, 2)] * (chain is not None)
    out = pa.schema([*fields, *states, *extra])
    return local.mapInArrow(_added(key, chain, sums, _carried(ends, len(sums), chain is not None), out), ", ".join([ddl, state_ddl] + [f"{f.name} bigint" for f in extra]))
