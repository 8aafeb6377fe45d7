"""Deterministic per-row hashes for splitting and resampling.

A row's fate (train or test, how many copies) must not depend on
partitioning, task retries or the engine: the hash is a pure function of
the key and a seed.  MD5 is used because every SQL engine has it, which
lets an independent engine check the result row for row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 32-bit hash range: a hash divided by it is in [0, 1).
HASH_RANGE = 4294967296.0


def key_text(keys: Sequence[str | Column], seed: int) -> Column:
    """``seed:key1:key2`` as text, the input of the hashes below."""
    parts = [F.lit(str(seed))] + [
        (F.col(k) if isinstance(k, str) else k).cast("string") for k in keys
    ]
    return F.concat_ws(":", *parts)


def hash32(keys: Sequence[str | Column], seed: int = 42) -> Column:
    """First 32 bits of ``md5(seed:key)`` as a non-negative long."""
    digest = F.md5(key_text(keys, seed))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash32_sql(key_sql: str, seed: int = 42) -> str:
    """The same hash as SQL text (used by the oracle queries)."""
    return (
        f"('0x' || substr(md5('{seed}' || ':' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"
    )
