"""Queue depth, worker activity, rates and latencies from logs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.derived import elapsed_ms
from ferryline.operators.jobs import latest_state
from ferryline.schemas import QUEUES

# What a log entry says about its worker, and which statuses are judged.
STATUS_OF_ENTRY = {"ready": "ready", "messageProcessed": "processing", "error": "error", "crash": "crashed", "exit": "stopped"}
HEALTHY = ("ready", "processing")
UNHEALTHY = ("error", "crashed")


def queue_depth(
    messages: DataFrame, queue: str | None = None, consumers: DataFrame | None = None,
    known: Sequence[str] = tuple(p.queue_type for p in QUEUES),
) -> DataFrame:
    """Messages, and consumers where given, per queue and in total; or of one queue alone.

    ``known`` queues, and the one asked for, are reported with 0 where nothing waits in them.
    """
    counted = [messages.select("queue_type", F.lit(1).alias("_messages"), F.lit(None).cast("string").alias("_consumer"))]
    if consumers is not None:
        counted.append(consumers.select(
            "queue_type", F.lit(0).alias("_messages"), F.col("consumer").cast("string").alias("_consumer")
        ).distinct())
    listed = [(name,) for name in (known if queue is None else [queue])]
    counted.append(messages.sparkSession.createDataFrame(listed, "queue_type string").select(
        "queue_type", F.lit(0).alias("_messages"), F.lit(None).cast("string").alias("_consumer")))
    rows = reduce(DataFrame.unionByName, counted)
    measures = [F.sum("_messages").alias("messages"), F.count("_consumer").alias("consumers")]
    if queue is not None:
        return rows.where(F.col("queue_type") == queue).groupBy("queue_type").agg(*measures)
    # Counted per queue first, so that the rollup works on a few rows.
    per_queue = rows.groupBy("queue_type").agg(*measures)
    return per_queue.rollup("queue_type").agg(
        F.sum("messages").alias("messages"), F.sum("consumers").alias("consumers"), F.grouping_id().alias("_level")
    ).select(
        F.when(F.col("_level") == 1, "total").otherwise(F.col("queue_type")).alias("queue_type"), "messages", "consumers"
    )


def run_summary(batch_log: DataFrame) -> DataFrame:
    """Rows, batches, seconds and rows per second of every run; the rate is null for a run without duration."""
    totals = batch_log.groupBy("run_id").agg(
        F.sum("row_count").alias("total_rows"),
        F.count(F.lit(1)).alias("batches"),
        F.min("logged_at").alias("_first"), F.max("logged_at").alias("_last"),
    )
    seconds = elapsed_ms(F.col("_first"), F.col("_last")) / 1000
    rate = F.try_divide(F.col("total_rows").cast("double"), seconds)
    return totals.select(
        "run_id", "total_rows", "batches", seconds.alias("seconds"),
        F.round(rate).cast("bigint").alias("rows_per_second"),
        F.round(rate, 6).alias("exact_rate"),
    )


def worker_stats(log: DataFrame, as_of: Column) -> DataFrame:
    """Processed messages, errors, first and last activity and uptime per worker."""
    return log.groupBy("worker_no", "consumer_type").agg(
        F.count_if(F.col("type") == "messageProcessed").alias("messages_processed"),
        F.count_if(F.col("type") == "error").alias("errors"),
        F.min("event_ts").alias("first_activity"),
        F.max("event_ts").alias("last_activity"),
    ).withColumn("uptime_ms", elapsed_ms(F.col("first_activity"), as_of))


def worker_health(log: DataFrame) -> DataFrame:
    """Workers by health of their last status, and the overall verdict."""
    kind = F.col("type")
    status = F.coalesce(*[F.when(kind == entry, name) for entry, name in STATUS_OF_ENTRY.items()])
    known = log.withColumn("status", status).where(F.col("status").isNotNull())
    current = latest_state(known.select("worker_no", "status", "event_ts", "seq"), "worker_no", ["event_ts", "seq"])
    counts = current.agg(
        F.count(F.lit(1)).alias("total_workers"),
        F.count_if(F.col("status").isin(*HEALTHY)).alias("healthy_workers"),
        F.count_if(F.col("status").isin(*UNHEALTHY)).alias("unhealthy_workers"),
    )
    return counts.withColumns({
        "other_workers": F.col("total_workers") - F.col("healthy_workers") - F.col("unhealthy_workers"),
        "status": F.when(F.col("unhealthy_workers") == 0, "healthy").otherwise("unhealthy"),
    })


def worker_counters(log: DataFrame) -> DataFrame:
    """Workers created, active and completed; never below zero."""
    counts = log.agg(
        F.count_if(F.col("type") == "ready").alias("created"), F.count_if(F.col("type") == "exit").alias("_left")
    )
    active = F.greatest(F.lit(0), F.col("created") - F.col("_left"))
    return counts.select(
        "created", active.alias("active"), F.greatest(F.lit(0), F.col("created") - active).alias("completed")
    )


def processing_rate(log: DataFrame, as_of: Column) -> DataFrame:
    """Messages per second of each worker since it started, 0 where it processed none."""
    stats = worker_stats(log, as_of)
    rate = F.coalesce(F.try_divide(F.col("messages_processed") * 1000.0, F.col("uptime_ms")), F.lit(0.0))
    return stats.select(
        "worker_no", "consumer_type", "messages_processed", "errors",
        F.round(rate).cast("bigint").alias("rate"), F.round(rate, 6).alias("exact_rate"),
    )


def batch_latency(log: DataFrame) -> DataFrame:
    """Processed batches with mean and longest processing time per consumer type."""
    return log.where(F.col("type") == "messageProcessed").groupBy("consumer_type").agg(
        F.count(F.lit(1)).alias("batches"),
        F.round(F.avg("processing_ms"), 6).alias("mean_ms"),
        F.max("processing_ms").alias("max_ms"),
    )


def throughput(messages: DataFrame, width: str = "1 minute", at: str = "published_at") -> DataFrame:
    """Messages per queue and time window; on a stream with a watermark the state stays bounded."""
    return messages.groupBy(F.window(at, width).alias("_window"), "queue_type").agg(
        F.count(F.lit(1)).alias("messages")
    ).select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "queue_type", "messages"
    )
