"""Deterministic hashing: experiment splits and pseudo-random draws.

All randomness in the engine is derived from md5 of a text key, so a run is
repeatable, does not depend on partitioning or task retries, and can be
re-computed in plain SQL.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32
TWO_64 = 1 << 64

# fixed values: the five 64-bit primes of xxHash64
XXH_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
#: the seed of Spark's own xxhash64
SPARK_SEED = 42


def _chunk(hexdigest: Column, i: int) -> Column:
    """i-th 32-bit chunk (most significant first) of a 32-hex-digit digest."""
    return F.conv(F.substring(hexdigest, 8 * i + 1, 8), 16, 10).cast("bigint")


def md5_mod(key: Column, n: int) -> Column:
    """``int(md5(key).hexdigest(), 16) % n`` without 128-bit integers.

    The digest is folded 32 bits at a time: acc = (acc * 2^32 + chunk) mod n,
    with 2^32 reduced mod n first so every product fits in a BIGINT.
    """
    if not 1 <= n < (1 << 31):
        raise ValueError("n must be in [1, 2^31)")
    h = F.md5(key)
    step = TWO_32 % n
    acc = _chunk(h, 0) % n
    for i in range(1, 4):
        acc = (acc * F.lit(step) + _chunk(h, i)) % n
    return acc


def split_key(id_col: str | Column, salt: str) -> Column:
    """The text hashed for a split: ``"<id>-<salt>"``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.concat(c.cast("string"), F.lit("-" + salt))


def ab_split(id_col: str | Column, salt: str = "exp_mess_1", n_groups: int = 5) -> Column:
    """Experiment group of a user: md5("<id>-<salt>") as an integer, mod n_groups."""
    return md5_mod(split_key(id_col, salt), n_groups)


def md5_chunks(hexdigest: Column) -> list[Column]:
    """The four 32-bit chunks of an md5 hex digest, each a uniform in [0, 2^32)."""
    return [_chunk(hexdigest, i) for i in range(4)]


def md5_u32(key: Column) -> Column:
    """First 32 bits of md5(key) as a BIGINT in [0, 2^32): a uniform draw."""
    return _chunk(F.md5(key), 0)


def poisson1_thresholds() -> list[int]:
    """Integer thresholds T_k = ceil(P(X <= k) * 2^32) for X ~ Poisson(1).

    A draw u in [0, 2^32) maps to the smallest k with u < T_k (inverse CDF).  The
    list stops once T_k reaches 2^32, so every u is covered.
    """
    out, cdf, term, k = [], 0.0, math.exp(-1.0), 0
    while True:
        cdf += term
        t = min(TWO_32, math.ceil(cdf * TWO_32))
        out.append(t)
        if t >= TWO_32:
            return out
        k += 1
        term /= k


def poisson_thresholds(mean: int) -> list[int]:
    """``poisson1_thresholds`` for X ~ Poisson(mean), in 60-digit decimals, up to the last below 2^32."""
    with localcontext() as context:
        context.prec = 60
        out, term, cdf, k = [], Decimal(-mean).exp(), Decimal(0), 0
        while True:
            cdf += term
            t = math.ceil(cdf * TWO_32)
            if t >= TWO_32:
                return out
            out.append(t)
            k += 1
            term = term * mean / k


def poisson_weight(u32: Column, mean: int) -> Column:
    """Poisson(mean) draw from a uniform 32-bit integer: how many thresholds it has reached."""
    reached = F.array(*[F.lit(t).cast("bigint") for t in poisson_thresholds(mean)])
    return F.size(F.filter(reached, lambda t: t <= u32))


def poisson1_weight(u32: Column) -> Column:
    """Poisson(1) draw from a uniform 32-bit integer (inverse CDF, exact integers)."""
    th = poisson1_thresholds()
    expr = F.when(u32 < F.lit(th[0]), F.lit(0))
    for k, t in enumerate(th[1:-1], start=1):
        expr = expr.when(u32 < F.lit(t), F.lit(k))
    return expr.otherwise(F.lit(len(th) - 1))


def _rotate_right(x: int, n: int) -> int:
    return ((x >> n) | (x << (64 - n))) % TWO_64


def _hashed_to_zero(seed: int) -> int:
    """The signed 64-bit integer whose xxHash64 under ``seed`` is 0.

    For an 8-byte value v every step is invertible: acc = seed + P5 + 8, acc ^= rotl(v * P2, 31) * P1,
    acc = rotl(acc, 27) * P1 + P4, and a final mix that maps only 0 to 0.
    """
    p1, p2, _, p4, p5 = XXH_PRIMES
    inverse = lambda p: pow(p, -1, TWO_64)
    acc = _rotate_right(-p4 * inverse(p1) % TWO_64, 27)
    key = acc ^ ((seed + p5 + 8) % TWO_64)
    v = _rotate_right(key * inverse(p1) % TWO_64, 31) * inverse(p2) % TWO_64
    return v - TWO_64 if v >= TWO_64 // 2 else v


def xxhash64_plain(value: Column) -> Column:
    """xxHash64 (seed 0) of a BIGINT's eight bytes, as the signed BIGINT of the same bits; null of null.

    Spark's xxhash64 starts from seed 42 and takes the hash of each argument as the seed of the next,
    so an argument that hashes to 0 in front makes the seed of ``value`` 0.
    """
    return F.when(value.isNotNull(), F.xxhash64(F.lit(_hashed_to_zero(SPARK_SEED)), value.cast("bigint")))


def unsigned_mod(bits: Column, n: int) -> Column:
    """A BIGINT's bits, read as an unsigned 64-bit integer, modulo n."""
    if not 1 <= n < (1 << 31):
        raise ValueError("n must be in [1, 2^31)")
    half = F.shiftrightunsigned(bits, 1)
    return ((half % n) * 2 + bits.bitwiseAND(F.lit(1).cast("bigint"))) % n
