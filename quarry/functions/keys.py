"""Repeatable keys for splitting, shuffling, batching and sharding.

``rand()`` and ``randomSplit`` depend on partitioning, and ``hash()`` has no
counterpart outside Spark, so every data-derived bucket here comes from MD5
of ``seed ‖ ':' ‖ key``: the first 15 hex digits (60 bits) read as an integer.
The same value is ``('0x' || substr(md5(k), 1, 15))::bigint`` in DuckDB, which
is what the oracle queries use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_key(key: Column | str, seed: int | str = 0) -> Column:
    """60-bit repeatable pseudo-random integer of ``key`` under ``seed``."""
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{seed}:"), k.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def stable_bucket(key: Column | str, n: int | Column, seed: int | str = 0) -> Column:
    """``stable_key(key, seed) mod n`` in ``[0, n)``."""
    n_col = n if isinstance(n, Column) else F.lit(int(n))
    return F.pmod(stable_key(key, seed), n_col.cast("bigint"))


def stable_percent(key: Column | str, seed: int | str = 0) -> Column:
    """Bucket in ``[0, 100)`` used for percentage splits."""
    return stable_bucket(key, 100, seed)


def sql_stable_key(key_sql: str, seed: int | str = 0) -> str:
    """DuckDB text of :func:`stable_key` for oracle queries and tests."""
    return f"('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 15))::BIGINT"
