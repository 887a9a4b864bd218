"""Key hashing for sketches.

A sketch stores a 60-bit hash per distinct key instead of the key itself; the
sampling threshold ``theta`` lives on the same 0..2^60 scale.  Two hash kinds:

* ``md5``: the first 15 hex digits of ``md5(key)``.  DuckDB and most SQL
  engines compute exactly the same number, so sketches (even sampled ones) can
  be checked against plain SQL.  Default.
* ``xxhash64``: Spark's ``xxhash64`` shifted to 60 bits.  Several times
  cheaper per key, but only Spark computes it; stored sketches record the kind
  and merging two kinds raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the sketch format.
DEFAULT_K = 4096  # default nominal entries, as in the reference's code
THETA_BITS = 60
THETA_MAX = 1 << THETA_BITS  # "nothing sampled away"
HASH_KINDS = ("md5", "xxhash64")


def key_hash(key: Column, kind: str = "md5") -> Column:
    """60-bit non-negative hash of a string key column."""
    key = key.cast("string")
    if kind == "md5":
        return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
    if kind == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(key), 64 - THETA_BITS)
    raise ValueError(f"unknown hash kind {kind!r}; expected one of {HASH_KINDS}")


def check_hash_kind(kind: str) -> str:
    if kind not in HASH_KINDS:
        raise ValueError(f"unknown hash kind {kind!r}; expected one of {HASH_KINDS}")
    return kind
