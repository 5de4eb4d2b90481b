"""Joins of many rows to at most one row per key, where a few keys may hold much of the table.

Adaptive skew splitting does not help here: it needs both sides fresh from a shuffle, and the side with
one row per key usually comes out of an aggregation on that key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.operators.ranking import MAX_BUCKETS, ROWS_PER_BUCKET, SAMPLE_PER_BUCKET


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_BUCKET) -> dict[int, int]:
    """Hashes of the keys with more than twice ``rows_per_task`` rows, and the pieces each of them needs.

    Read off a bounded sample: at most half as many keys as the table has tasks' worth of rows. Pieces are powers of two.
    """
    rows = df.count()
    tasks = min(MAX_BUCKETS, math.ceil(rows / rows_per_task))
    if tasks <= 2:
        return {}
    hashes = df.select(F.xxhash64(*keys).alias("key"))
    fraction = SAMPLE_PER_BUCKET * tasks / rows
    taken = (hashes.sample(fraction, seed=13) if fraction < 1.0 else hashes).toArrow().column("key").to_numpy()
    if not len(taken):
        return {}
    seen, hits = np.unique(taken, return_counts=True)
    share = hits * tasks / len(taken)
    return {int(k): 2 ** math.ceil(math.log2(n)) for k, n in zip(seen, share) if n > 2}


def _pieces(keys: Sequence[str], hot: dict[int, int]) -> Column:
    """Into how many pieces the rows of a key are cut: 1 for all but the hot ones."""
    levels: dict[int, list[int]] = {}
    for key, pieces in hot.items():
        levels.setdefault(pieces, []).append(key)
    chosen = [F.when(F.xxhash64(*keys).isin(listed), pieces) for pieces, listed in sorted(levels.items())]
    return F.coalesce(*chosen, F.lit(1))


def _piece(df: DataFrame, pieces: Column) -> Column:
    """A piece number that a repeated task gives a row again, whatever order its rows come in."""
    plain = [f.name for f in df.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    # Equal rows share a hash; the partition they lie in tells copies apart.
    return F.pmod(F.xxhash64(*plain) + F.spark_partition_id(), pieces).cast("int")


def join_to_one(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str,
    rows_per_task: int | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """``many.join(one, keys, how)`` for a ``one`` with at most one row per key.

    Given ``rows_per_task``, keys with more rows than that are looked for (a count and a sampling scan) and their rows
    spread: each is cut into the pieces it needs, and its row of ``one`` repeated as often; nothing else is. They are
    looked for in ``many``, or in ``source`` where that has the same keys and is cheaper to read. Without it this is the
    plain join, and defining it starts no job.
    """
    keys = list(keys)
    hot = hot_keys(many if source is None else source, keys, rows_per_task) if rows_per_task else {}
    if not hot:
        return many.join(one, keys, how)
    pieces = _pieces(keys, hot)
    left = many.withColumn("_piece", _piece(many, pieces))
    right = one.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return left.join(right, [*keys, "_piece"], how).drop("_piece")
