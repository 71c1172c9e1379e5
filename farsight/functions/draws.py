"""Repeatable pseudo-random draws.

A draw is a pure function of (seed, key), uniform on [0, 2^60).  Because it
is a column expression, a retried task or a re-run micro-batch draws the same
numbers (no driver-side RNG state).

Two hash families.  The method is resolved when the expression is built:
a ``pinned(...)`` block, else the session setting ``farsight.draw.hash``,
else ``xxhash64``.

* ``xxhash64`` (default): Spark's native 64-bit hash of (seed, key), low 60
  bits.  No string building or hex parsing: ~17x cheaper per row than md5
  (measured 50M draws: 0.31 s vs 5.2 s on 8 cores).
* ``md5``: the first 15 hex digits of ``md5('<seed>:<key>')``.  SQL engines
  and plain Python reproduce it bit for bit; the registered queries pin it
  so the DuckDB oracle can check them.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_60 = 1 << 60


HASH_CONF = "farsight.draw.hash"
DEFAULT_METHOD = "xxhash64"
_pinned: list[str] = []


@contextmanager
def pinned(method: str):
    """Build every draw inside the block with ``method``."""
    if method not in ("md5", "xxhash64"):
        raise ValueError(f"draw method must be md5 or xxhash64, got {method!r}")
    _pinned.append(method)
    try:
        yield
    finally:
        _pinned.pop()


def current_method() -> str:
    """The draw method expressions built now will use."""
    if _pinned:
        return _pinned[-1]
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    m = s.conf.get(HASH_CONF, DEFAULT_METHOD) if s is not None else DEFAULT_METHOD
    if m not in ("md5", "xxhash64"):
        raise ValueError(f"{HASH_CONF} must be md5 or xxhash64, got {m!r}")
    return m


def draw(seed, key: Column, method: str | None = None) -> Column:
    method = method or current_method()
    if method == "xxhash64":
        return F.xxhash64(F.lit(str(seed)), key).bitwiseAND(F.lit(TWO_POW_60 - 1))
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def draw_sql(seed, key_sql: str) -> str:
    """The same draw in DuckDB SQL."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 15))::BIGINT"


def threshold_for(p: float) -> int:
    """Integer threshold T with P(draw <= T) ~= p (p clamped to [0, 1])."""
    p = min(1.0, max(0.0, float(p)))
    return min(TWO_POW_60, math.floor(p * TWO_POW_60))


# Fixed values of the bucket hash: the Mersenne prime 2^31 - 1 and
# 1583458089, a primitive root modulo that prime (a large one, so that
# neighbouring and evenly spaced keys wrap around at once).
BUCKET_PRIME = 2147483647
BUCKET_MULT = 1583458089


def bucket_of(key: Column, buckets: int) -> Column:
    """Hash bucket in [0, buckets) of an integer key.

    ((key mod p) * a mod p) mod buckets with p = 2^31 - 1: a few integer
    operations per row (no string hashing), products stay below 2^62, and
    since p is prime, dense or strided key patterns spread evenly.  Only
    balance matters here, not randomness."""
    k = F.pmod(key.cast("bigint"), F.lit(BUCKET_PRIME))
    return F.pmod(F.pmod(k * F.lit(BUCKET_MULT), F.lit(BUCKET_PRIME)), F.lit(int(buckets))).cast("int")


def bucket_sql(key_sql: str, buckets: int) -> str:
    k = f"(((CAST({key_sql} AS BIGINT) % {BUCKET_PRIME}) + {BUCKET_PRIME}) % {BUCKET_PRIME})"
    return f"CAST(((({k} * {BUCKET_MULT}) % {BUCKET_PRIME}) % {int(buckets)}) AS INTEGER)"


def bucket_and_part(key: Column, buckets: int, parts: int) -> tuple[Column, Column]:
    """``bucket_of`` and, from what its modulus leaves of the same hash, a
    part in [0, parts) within the bucket."""
    k = F.pmod(key.cast("bigint"), F.lit(BUCKET_PRIME))
    h = F.pmod(k * F.lit(BUCKET_MULT), F.lit(BUCKET_PRIME))
    part = F.pmod(F.floor(h / F.lit(int(buckets))), F.lit(int(parts)))
    return F.pmod(h, F.lit(int(buckets))).cast("int"), part.cast("bigint")


def part_sql(key_sql: str, buckets: int, parts_sql: str) -> str:
    k = f"(((CAST({key_sql} AS BIGINT) % {BUCKET_PRIME}) + {BUCKET_PRIME}) % {BUCKET_PRIME})"
    return f"(((({k} * {BUCKET_MULT}) % {BUCKET_PRIME}) // {int(buckets)}) % ({parts_sql}))"
