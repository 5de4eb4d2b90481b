"""Status transitions and keyed bulk updates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.derived import elapsed_ms
from ferryline.operators.jobs import latest_state

# Columns a status transition sets.
TRANSITION_COLUMNS = (
    "status", "retry_count", "last_retry_at", "processing_duration_ms",
    "last_processed", "processed_by", "processing_completed",
)


def processing_duration_ms(as_of: Column, started: Column, updated: Column) -> Column:
    """Milliseconds since processing began, or since the last update where no beginning is known."""
    return elapsed_ms(F.coalesce(started, updated), as_of)


def status_transition(
    items: DataFrame, as_of: Column, run_id: str | Column, started: Column | None = None
) -> DataFrame:
    """Every item becomes ``success``; failed ones count a retry, processing ones get their duration."""
    start = started if started is not None else F.lit(None).cast("timestamp_ntz")
    was = F.col("status")
    failed, running = was == "failed", was == "processing"
    return items.withColumns({
        "retry_count": F.when(failed, F.coalesce("retry_count", F.lit(0)) + 1).otherwise(F.col("retry_count")),
        "last_retry_at": F.when(failed, as_of),
        "processing_duration_ms": F.when(running, processing_duration_ms(as_of, start, F.col("updated_at"))),
        "last_processed": as_of,
        "processed_by": F.lit(run_id) if isinstance(run_id, str) else run_id,
        "processing_completed": F.lit(True),
        "status": F.lit("success"),
    })


def one_per_key(updates: DataFrame, key: str, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    if not order:
        return updates.select(key, *cols)
    return latest_state(updates.select(key, *cols, *[o for o in order if o not in cols]), key, order).select(key, *cols)


def update_join(
    target: DataFrame, updates: DataFrame, key: str, cols: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """Match keys of both sides: ``matched``, ``unmatched`` update, or ``untouched`` row, and whether it changes.

    Updates hold one row per key, or name the ``order`` in which the last one wins.
    """
    shared = [c for c in cols if c in target.columns]
    left = target.select(key, F.struct(F.lit(True).alias("_here"), *shared).alias("_old"))
    right = one_per_key(updates, key, cols, order).select(key, F.struct(F.lit(True).alias("_here"), *cols).alias("_new"))
    outcome = (
        F.when(F.col("_new").isNull(), "untouched").when(F.col("_old").isNull(), "unmatched").otherwise("matched")
    )
    differs = [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) if c in shared else F.col(f"_new.{c}").isNotNull()
               for c in cols]
    changed = reduce(lambda a, b: a | b, differs, F.lit(False))
    return left.join(right, key, "full_outer").select(
        key, outcome.alias("outcome"), ((outcome == "matched") & changed).alias("modified")
    )


def update_counts(joined: DataFrame) -> DataFrame:
    """Processed, matched and modified counts of an :func:`update_join` result."""
    return joined.agg(
        F.count_if(F.col("outcome") != "untouched").alias("processed"),
        F.count_if(F.col("outcome") == "matched").alias("matched"),
        F.count_if("modified").alias("modified"),
    )


class Updated(NamedTuple):
    target: DataFrame
    stats: DataFrame


def keyed_update(
    target: DataFrame, updates: DataFrame, key: str, cols: Sequence[str], order: Sequence[str] = ()
) -> Updated:
    """Set ``cols`` in the rows of ``target`` whose key has an update; never insert.

    A set value may be null, so a match is told by the update's presence. Columns the target lacks are
    added. Write the result as a new snapshot; the path being read is never overwritten.

    Both sides are sorted by key: the size of stored messages says little of the updates read out of them, and by that
    size Spark would gather them at the driver to broadcast them.
    """
    right = one_per_key(updates, key, cols, order).select(key, F.struct(*cols).alias("_new")).hint("merge")
    joined = target.join(right, key, "left")
    hit = F.col("_new").isNotNull()
    new = joined.withColumns({
        c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)) if c in target.columns else F.col(f"_new.{c}")
        for c in cols
    }).drop("_new")
    return Updated(new, update_counts(update_join(target, updates, key, cols, order)))
