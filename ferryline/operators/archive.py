"""Archive rows, reconciliation and lookups."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.operators.jobs import latest_state
from ferryline.schemas import ARCHIVE_ACTOR, ARCHIVE_REASON, ARCHIVE_SOURCE


def archive_rows(items: DataFrame, batch: Column, as_of: Column, actor: str = ARCHIVE_ACTOR) -> DataFrame:
    """Items as archive rows: content copied, id and times renamed, provenance added."""
    times = ("item_id", "created_at", "updated_at", "retry_count")
    copied = [c for c in items.columns if c not in times and not c.startswith("_")]
    return items.select(
        *copied,
        F.col("item_id").alias("original_id"),
        as_of.alias("archived_at"),
        batch.alias("archive_batch"),
        F.lit(ARCHIVE_REASON).alias("archive_reason"),
        F.lit(ARCHIVE_SOURCE).alias("source_collection"),
        F.lit(actor).alias("archived_by"),
        F.col("created_at").alias("original_created_at"),
        F.col("updated_at").alias("original_updated_at"),
    )


class Reconciled(NamedTuple):
    missing: DataFrame
    present: DataFrame
    per_batch: DataFrame


def archive_reconcile(source: DataFrame, archive: DataFrame, key: str = "item_id") -> Reconciled:
    """Source rows without and with an archive row, and the archive rows of every batch."""
    ids = archive.select(F.col("original_id").alias(key)).distinct()  # an id archived very often counts once
    per_batch = archive.groupBy("archive_batch").agg(F.count(F.lit(1)).alias("archived"))
    return Reconciled(source.join(ids, key, "left_anti"), source.join(ids, key, "left_semi"), per_batch)


def delete_archived(source: DataFrame, archive: DataFrame, key: str = "item_id", enabled: bool = False) -> DataFrame:
    """The source without its archived rows. Off unless asked for, as removing rows cannot be undone."""
    return archive_reconcile(source, archive, key).missing if enabled else source


def latest_archive(archive: DataFrame) -> DataFrame:
    """The newest archive row per original id."""
    return latest_state(archive, "original_id", ["archived_at", "run_no"])


def find_by_original(archive: DataFrame, ids: DataFrame) -> DataFrame:
    """The newest archive row of each of ``ids`` (one column, ``original_id``).

    A plain semi join: the planner broadcasts the ids where they are few.
    """
    return latest_archive(archive.join(ids.select("original_id").distinct(), "original_id", "left_semi"))


def find_by_batch(archive: DataFrame, batch: str) -> DataFrame:
    """The rows of one batch, newest first."""
    return archive.where(F.col("archive_batch") == batch).orderBy(F.desc("archived_at"), "original_id")


def archive_stats(archive: DataFrame) -> DataFrame:
    """Rows and latest archive time per status."""
    return archive.groupBy("status").agg(
        F.count(F.lit(1)).alias("archived"), F.max("archived_at").alias("latest_archive")
    )
