"""The three end-to-end flows."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.filters import filter_spec
from ferryline.operators.archive import Reconciled, archive_reconcile
from ferryline.operators.batching import make_batches, open_batches, unwrap_batches
from ferryline.operators.failures import dead_letter_triage, split_outcomes
from ferryline.operators.jobs import job_changes, job_transition, latest_state
from ferryline.operators.models import archive_row_rules
from ferryline.operators.routing import publish_batches
from ferryline.operators.updates import TRANSITION_COLUMNS, Updated, keyed_update, status_transition
from ferryline.schemas import ITEM
from ferryline.sources.bodies import mark_undecodable
from ferryline.sources.tables import append_valid
from ferryline.streaming.consumers import ARRIVAL, archivable


def _delivered(sent: DataFrame, path: str) -> DataFrame:
    """Published messages as a table, as a broker would keep them: consumers never repeat the batching."""
    sent.write.mode("overwrite").parquet(path)
    return sent.sparkSession.read.schema(sent.schema).parquet(path).select("correlation_id", "body")


def archive_flow(
    items: DataFrame, size: int, collection: str, path: str, run_id: str, as_of: Column
) -> tuple[DataFrame, Reconciled]:
    """Batch, publish, consume, archive, and compare the archive with its source."""
    sent = publish_batches(make_batches(items, "item_id", size, collection), 0, "archive", 0, as_of)
    opened = open_batches(_delivered(sent, f"{path}/messages"), ITEM)
    rows = archivable(opened, ITEM, as_of, collection).where("error IS NULL").drop("correlation_id", "body", "error")
    # A message delivered twice archives its rows once; the last one sent wins.
    rows = latest_state(rows, "original_id", ARRIVAL).drop("sent_at", "batch_number")
    stored = append_valid(rows, archive_row_rules(), f"{path}/archive", run_id).table
    return stored, archive_reconcile(items, stored)


def bulk_update_flow(
    items: DataFrame, spec: Mapping, size: int, collection: str, priority: int, path: str, as_of: Column
) -> Updated:
    """Select, batch, publish, consume, transition, and update the items by key."""
    work = items.where(filter_spec(spec))
    sent = publish_batches(make_batches(work, "item_id", size, collection), priority, "processing", 0, as_of)
    received = unwrap_batches(_delivered(sent, f"{path}/messages"), ITEM).items
    changed = status_transition(received, as_of, F.col("correlation_id"))
    return keyed_update(items, changed, "item_id", TRANSITION_COLUMNS)


class Failures(NamedTuple):
    outcomes: DataFrame
    triaged: DataFrame
    log: DataFrame


def failure_flow(messages: DataFrame, log: DataFrame, body_schema, as_of: Column) -> Failures:
    """Decode, retry or dead-letter, triage the dead letters, and record it on their jobs."""
    marked = mark_undecodable(messages, body_schema)
    judged = marked.withColumn("handler_failed", F.col("handler_failed") | F.col("undecodable"))
    reason = F.when(F.col("undecodable"), "undecodable body").otherwise("handler failed")
    outcomes = split_outcomes(judged, as_of, reason).drop("content")
    dead = outcomes.where(F.col("outcome") == "dead_letter")
    triaged = dead_letter_triage(
        dead.withColumns({"death_count": F.col("x_death_count"), "original_queue": F.col("x_first_death_queue")})
    )
    steps = F.posexplode(F.array(F.lit("dead_letter_processing"), F.lit("dead_letter_completed"))).alias("seq", "status")
    units = triaged.select(
        "correlation_id", steps, F.lit("deadletter").alias("queue_type"), F.lit(1).alias("items"), "deaths",
        F.lit(None).cast("string").alias("error"), F.lit("deadletter-consumer").alias("processed_by"), "origin",
        F.col("deaths").alias("death_count"), "action",
    ).withColumn("seq", F.col("seq").cast("bigint"))
    log = job_transition(log, job_changes(units, as_of))
    return Failures(outcomes, triaged, log)
