"""Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` names it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def total(values: Column, zero: str = "bigint") -> Column:
    """Sum of an array; 0 for an empty one."""
    return F.aggregate(values, F.lit(0).cast(zero), lambda left, value: left + value)


def windows(values: Column, size: int) -> Column:
    """A 64-bit hash of every run of ``size`` neighbouring values; none where there are fewer.

    Elements are read by position: ``slice`` would copy the whole array for every window.
    """
    def hashes(h):
        starts = F.sequence(F.lit(0), F.size(h) - size)
        return F.when(
            F.size(h) >= size, F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)]))
        ).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(values, lambda v: F.xxhash64(v)), hashes)


def without(df_columns: list[str], *wanted: str) -> list[str]:
    """Names for helper columns that clash with none of ``df_columns``."""
    taken = {name.lower() for name in df_columns}
    free = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free
