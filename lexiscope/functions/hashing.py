"""Seeded, partition-independent hashes (same value in Spark and DuckDB)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hex_slice_int(hex_col: Column, start: int, length: int = 8) -> Column:
    """Integer value of ``length`` hex digits of ``hex_col`` starting at 1-based ``start``."""
    return F.conv(F.substring(hex_col, start, length), 16, 10).cast("bigint")


def seeded_hash(key: Column, seed: int | str = 42) -> Column:
    """32-bit hash of ``seed || key``: first 8 hex digits of the md5, as BIGINT."""
    return hex_slice_int(F.md5(F.concat(F.lit(str(seed)), key.cast("string"))), 1)


def seeded_hash_sql(key_sql: str, seed: int | str = 42) -> str:
    """DuckDB spelling of :func:`seeded_hash`."""
    return (f"CAST(('0x' || substr(md5('{seed}' || CAST({key_sql} AS VARCHAR)), 1, 8))"
            f"::UBIGINT AS BIGINT)")
