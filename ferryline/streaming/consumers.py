"""Consumers of batch messages: archiving and bulk updates, both kept as logs that are folded when they are read.

A micro-batch writes what it received and reads nothing of earlier ones, so its cost does not grow with them. Batches carry
the time and number at which they were sent, and the fold goes by these: the result does not depend on how the stream was
cut into micro-batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ferryline.functions.derived import as_instant, as_ntz
from ferryline.operators.archive import archive_rows
from ferryline.operators.batching import open_batches
from ferryline.operators.jobs import job_changes, latest_state
from ferryline.operators.models import archive_row_rules
from ferryline.operators.updates import TRANSITION_COLUMNS, Updated, keyed_update, status_transition
from ferryline.streaming.running import each_batch

# In which order batches were sent; the id of the batch settles ties.
ARRIVAL = ("sent_at", "batch_number", "archive_batch")


def archivable(opened: DataFrame, item: T.StructType, as_of: Column, collection: str) -> DataFrame:
    """Items of :func:`open_batches` as archive rows; ``error`` tells what keeps one out.

    That is what could not be read, another collection, or a broken rule of archive rows. Every item gives one row.
    """
    foreign = F.when(F.coalesce(F.col("collection") != collection, F.lit(True)), F.lit("unsupported collection"))
    named = opened.select(*item.names, "batch_id", "correlation_id", "body", "sent_at", "batch_number",
                          F.coalesce("error", foreign).alias("error"))
    rows = archive_rows(named, F.col("batch_id"), as_of).drop("batch_id")
    broken = F.concat_ws(", ", *[F.when(rule.broken, F.lit(rule.name)) for rule in archive_row_rules()])
    return rows.withColumn("error", F.coalesce("error", F.nullif(broken, F.lit(""))))


def archive_stream(
    stream: DataFrame, item: T.StructType, path: str, run_id: str, as_of: Column, collection: str = "someModel"
) -> DataStreamWriter:
    """Envelopes to archive rows; :func:`read_archive` gives each original once.

    Rows land in ``path/rows/run_id=<run>/batch_id=<n>``, and what is refused in ``path/errors``, with the reason, one row
    for each item or unreadable message. A repeated micro-batch replaces its folders.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        received = archivable(open_batches(batch, item), item, as_of, collection).persist()  # parsed once for both
        try:
            place = f"run_id={run_id}/batch_id={batch_id}"
            received.where("error IS NOT NULL").select("correlation_id", "body", "error").write.mode("overwrite").parquet(
                f"{path}/errors/{place}")
            received.where("error IS NULL").drop("correlation_id", "body", "error").write.mode("overwrite").parquet(
                f"{path}/rows/{place}")
        finally:
            received.unpersist()

    return each_batch(stream, store)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive of all runs: of an original that came in several batches, the row of the last one sent."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").drop("run_id", "batch_id")
    return latest_state(rows, "original_id", ARRIVAL).drop("sent_at", "batch_number")


def archive_once(
    stream: DataFrame, item: T.StructType, as_of: Column, delay: str, collection: str = "someModel"
) -> DataFrame:
    """Envelopes to archive rows, each original once within ``delay`` of the time its batch was sent.

    Keyed state drops what was archived before: a redelivered batch, in the same or a later micro-batch, gives no row.
    State is one key per original, and keys older than the watermark go. The first row that arrives counts; refused items
    are left to :func:`archive_stream`. Rows without a sending time cannot be placed and are left out.
    """
    rows = archivable(open_batches(stream, item), item, as_of, collection).where("error IS NULL AND sent_at IS NOT NULL")
    timed = rows.withColumn("sent_at", as_instant(F.col("sent_at").cast("timestamp_ntz"))).withWatermark("sent_at", delay)
    once = timed.dropDuplicatesWithinWatermark(["original_id"])
    return once.drop("correlation_id", "body", "error", "batch_number").withColumn("sent_at", as_ntz(F.col("sent_at")))


def bulk_update_stream(
    stream: DataFrame, item: T.StructType, path: str, as_of: Column, queue_type: str = "processing",
    known: DataFrame | None = None,
) -> DataStreamWriter:
    """Envelopes of a queue to update rows and job transitions: the target is not rewritten per micro-batch.

    Items that cannot be read go to ``path/errors``; a message without any other one fails. Transitions are for the jobs
    in ``known`` (a column ``correlation_id``), never for others; without it, for all. ``seq`` orders those of a job.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        received = open_batches(batch, item).persist()  # parsed once for the steps below
        try:
            good, bad = received.where("error IS NULL"), received.where("error IS NOT NULL")
            changed = status_transition(good, as_of, F.col("correlation_id"))
            changed.select("item_id", *TRANSITION_COLUMNS, "sent_at", "batch_number").write.mode("overwrite").parquet(
                f"{path}/updates/batch_id={batch_id}")
            bad.select("correlation_id", "body", "error").write.mode("overwrite").parquet(f"{path}/errors/batch_id={batch_id}")
            units = received.groupBy("correlation_id").agg(
                F.count_if(F.col("error").isNull()).alias("items"), F.min("error").alias("error"))
            done = F.array(F.lit("processing"), F.lit("completed"))
            steps = units.select("correlation_id", "items", "error", F.posexplode(
                F.when(F.col("items") > 0, done).otherwise(F.array(F.lit("failed")))).alias("seq", "status"))
            steps = steps.withColumns({
                "seq": F.when(F.col("status") == "failed", 1).otherwise(F.col("seq")).cast("bigint"),
                "queue_type": F.lit(queue_type), "deaths": F.lit(None).cast("int"), "processed_by": F.lit(f"{queue_type}-consumer"),
            })
            if known is not None:
                steps = steps.join(known.select("correlation_id").distinct(), "correlation_id", "left_semi")
            job_changes(steps, as_of).write.mode("overwrite").parquet(f"{path}/jobs/batch_id={batch_id}")
        finally:
            received.unpersist()

    return each_batch(stream, store)


def apply_updates(
    spark: SparkSession, target: DataFrame, path: str, cols: Sequence[str] = TRANSITION_COLUMNS
) -> Updated:
    """The target with all logged updates, the last one sent per key; write it as a new snapshot."""
    updates = spark.read.option("basePath", f"{path}/updates").parquet(f"{path}/updates")
    return keyed_update(target, updates, "item_id", cols, ["sent_at", "batch_number", "processed_by"])
