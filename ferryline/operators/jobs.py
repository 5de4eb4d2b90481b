"""Job status as a log of transitions, folded on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.derived import plus_ms
from ferryline.operators.joins import join_to_one
from ferryline.operators.ranking import ROWS_PER_BUCKET, with_next
from ferryline.schemas import JOB_MESSAGES, JOB_TIMEOUT_MS

# What a timeout says, by queue.
TIMEOUT_MESSAGES = {"processing": "Processing worker timeout exceeded", "priority": "Priority worker timeout exceeded"}
TIMEOUT_MESSAGE = TIMEOUT_MESSAGES["processing"]


def latest_state(log: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``: one aggregation, reduced before the shuffle, so hot keys stay cheap.

    The buffer is a struct, so Spark sorts by key before and after the shuffle; the sorts spill, and a key's rows are
    one before they travel.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in log.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return log.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*log.columns)


def job_transition(
    log: DataFrame, changes: DataFrame, key: str = "correlation_id", rows_per_task: int | None = None
) -> DataFrame:
    """The log with ``changes`` appended; changes to unknown jobs are left out, never inserted."""
    known = log.select(key).distinct()
    return log.unionByName(join_to_one(changes, known, [key], "left_semi", rows_per_task), allowMissingColumns=True)


def job_message() -> Column:
    """What the message of a change says, from ``status``, ``queue_type``, ``items``, ``deaths`` and ``error``."""
    chosen = []
    for status, queue, text in JOB_MESSAGES:
        said = F.lit(text)
        for name in ("items", "deaths", "error"):
            if f"{{{name}}}" in text:
                said = F.replace(said, F.lit(f"{{{name}}}"), F.coalesce(F.col(name).cast("string"), F.lit("")))
        chosen.append(F.when((F.col("status") == status) & (F.col("queue_type") == queue), said))
    return F.coalesce(*chosen)


# Who worked on a unit, and where a dead letter came from and what became of it; carried where given.
JOB_DETAILS = ("seq", "processed_by", "origin", "death_count", "action")


def job_changes(units: DataFrame, at: Column) -> DataFrame:
    """Transition rows for units of work; needs the columns :func:`job_message` reads and ``correlation_id``.

    Starting sets a start time; finishing sets an end time, and full progress unless it failed.
    """
    starts = F.col("status").isin("processing", "dead_letter_processing")
    done = F.col("status").isin("completed", "dead_letter_completed")
    ends = done | F.col("status").isin("failed", "dead_letter_failed")
    return units.select(
        "correlation_id", "status", at.alias("event_ts"),
        F.when(starts, at).alias("start_time"),
        F.when(ends, at).alias("end_time"),
        F.when(done, 100.0).alias("progress"),
        F.when(done, F.col("items").cast("bigint")).alias("processed_items"),
        job_message().alias("message"),
        F.when(F.col("status").isin("failed", "dead_letter_failed"), F.col("error")).alias("error"),
        *[F.col(name) for name in JOB_DETAILS if name in units.columns],
    )


def published_jobs(messages: DataFrame, at: Column) -> DataFrame:
    """The pending job every published batch starts as."""
    return messages.select(
        F.col("correlation_id").alias("job_id"), "correlation_id", F.lit("pending").alias("status"),
        F.lit("batch").alias("job_type"), F.col("batch_size").alias("total_items"),
        F.lit(0).cast("bigint").alias("processed_items"), F.lit(0.0).alias("progress"), at.alias("event_ts"),
    )


PROGRESS_COUNTS = ("total_batches", "completed_batches", "failed_batches", "total_items", "processed_items")


def progress_counts() -> list[Column]:
    """The sums of PROGRESS_COUNTS over the current states of jobs."""
    return [
        F.count(F.lit(1)).alias("total_batches"),
        F.count_if(F.col("status") == "completed").alias("completed_batches"),
        F.count_if(F.col("status") == "failed").alias("failed_batches"),
        F.sum(F.col("total_items").cast("bigint")).alias("total_items"),
        F.sum(F.col("processed_items").cast("bigint")).alias("processed_items"),
    ]


def progress_of(totals: DataFrame) -> DataFrame:
    share = F.coalesce(F.try_divide(F.col("processed_items") * 100.0, F.col("total_items")), F.lit(0.0))
    return totals.withColumn("progress", F.round(F.least(F.lit(100.0), share), 4))


def job_progress(log: DataFrame) -> DataFrame:
    """Batches and items done per parent job, from the current state of its jobs."""
    current = latest_state(log, "correlation_id", ["event_ts", "seq"])
    return progress_of(current.groupBy("parent_job_id").agg(*progress_counts()))


def dead_letter_jobs(dead_letters: DataFrame, jobs: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Dead letters with the state of their job, which may be absent. ``jobs`` has one row per job."""
    state = jobs.select(
        "correlation_id", F.col("status").alias("job_status"), F.col("event_ts").alias("job_changed_at")
    )
    return join_to_one(dead_letters, state, ["correlation_id"], "left", rows_per_task)


def timed_out(started: Column, following: Column, as_of: Column, limit_ms: int) -> Column:
    """Whether nothing came up to and including the limit."""
    return F.coalesce(following, as_of) > plus_ms(started, F.lit(limit_ms))


def processing_timeout(
    log: DataFrame, as_of: Column, limit_ms: int = JOB_TIMEOUT_MS, rows_per_bucket: int = ROWS_PER_BUCKET,
    queue_type: str = "processing",
) -> DataFrame:
    """A failure row for every entry into processing that nothing followed within the limit.

    Each entry is compared with the job's next one; an open last entry counts once ``as_of`` is past
    the limit. A job with very many entries is spread over time buckets.
    """
    ahead = with_next(log, "event_ts", ["event_ts", "seq"], ["correlation_id"], "_next", rows_per_bucket)
    late = ahead.where(F.col("status") == "processing").where(
        timed_out(F.col("event_ts"), F.col("_next"), as_of, limit_ms)
    )
    return late.select(
        "correlation_id", "seq",
        F.col("event_ts").alias("started_at"),
        plus_ms(F.col("event_ts"), F.lit(limit_ms)).alias("failed_at"),
        F.lit("failed").alias("status"),
        F.lit(TIMEOUT_MESSAGES[queue_type]).alias("message"),
    )
