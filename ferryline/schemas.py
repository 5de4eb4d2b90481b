"""Row types and the fixed configuration tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- Row types -----------------------------------------------------------------------------------

ITEM = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("department", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("retry_count", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

BATCH_METADATA = T.StructType([
    T.StructField("batchSize", T.LongType()),
    T.StructField("batchNumber", T.LongType()),
    T.StructField("totalBatches", T.LongType()),
    T.StructField("timestamp", T.StringType()),
])

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def envelope(item: T.StructType) -> T.StructType:
    """The body of a batch message carrying rows of type ``item``."""
    return T.StructType([
        T.StructField("batchId", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("data", T.ArrayType(item)),
        T.StructField("metadata", BATCH_METADATA),
    ])


# ---- Fixed values: statuses, queues, exchanges, bindings, limits ----------------------------------

ITEM_STATUSES = ("pending", "processing", "success", "failed")
JOB_STATUSES = ("pending", "processing", "completed", "failed", "cancelled")
DEAD_LETTER_STATUSES = ("dead_letter_processing", "dead_letter_completed", "dead_letter_failed")
JOB_TYPES = ("migration", "batch")

MAIN_EXCHANGE = "app.topic.exchange"
DEAD_LETTER_EXCHANGE = "app.deadletter.exchange"


@dataclass(frozen=True)
class QueuePolicy:
    queue_type: str
    queue: str
    prefetch: int
    retry: bool
    max_retries: int | None = None
    retry_delay_ms: int | None = None
    exhausted_key: str | None = None  # routing key once retries are used up; None drops the message
    expired_key: str | None = None  # routing key once the time to live is over; None drops the message
    max_priority: int | None = None


QUEUES = (
    QueuePolicy("processing", "app.processing.queue", 1, True, 3, 10_000, "failed.manual", "failed.processing"),
    QueuePolicy("priority", "app.priority.queue", 2, True, 5, 5_000, "failed.manual", None, 10),
    QueuePolicy("deadletter", "app.deadletter.queue", 10, False),
    QueuePolicy("retry", "app.retry.queue", 5, False, expired_key="process.retry"),
    QueuePolicy("archive", "app.archive.queue", 1, True, 3, 15_000, "failed.manual", "failed.archive"),
)

# (pattern, queue): one word per ``*``, any number of words per ``#``.
BINDINGS = (
    ("process.*", "app.processing.queue"),
    ("priority.*", "app.priority.queue"),
    ("archive.*", "app.archive.queue"),
    ("failed.*", "app.deadletter.queue"),
)

# Queue type -> (routing key, queue named in the reply); any other type is treated as processing.
ROUTES = {
    "archive": ("archive.bulkMigration", "app.archive.queue"),
    "priority": ("priority.bulkUpdate", "app.priority.queue"),
    "processing": ("process.bulkUpdate", "app.processing.queue"),
}

HIGH_PRIORITY_ABOVE = 5
MAX_PRIORITY = 10
MAX_BATCH_SIZE = 5_000
JOB_TIMEOUT_MS = 300_000
REQUEUE_DELAY_MS = 5_000
REVIEW_DEATHS = 3
PERMANENT_DEATHS = 5
CLEAR_CONFIRMATION = "DELETE_ALL_DATA"

# What a job's message says: status, kind of queue, text with the number of items, the deaths or the error.
JOB_MESSAGES = (
    ("processing", "processing", "Processing {items} items in worker thread"),
    ("processing", "priority", "Processing {items} high-priority items in worker thread"),
    ("completed", "processing", "Successfully processed {items} items in worker thread"),
    ("completed", "priority", "Successfully processed {items} high-priority items in worker thread"),
    ("failed", "processing", "Processing failed in worker thread: {error}"),
    ("failed", "priority", "Priority processing failed in worker thread: {error}"),
    ("dead_letter_processing", "deadletter", "Processing {items} dead letter items (deaths: {deaths}) in worker thread"),
    ("dead_letter_completed", "deadletter", "Dead letter processing completed for {items} items (deaths: {deaths})"),
    ("dead_letter_failed", "deadletter", "Dead letter processing failed in worker thread: {error}"),
)

ARCHIVE_REASON = "bulk_migration"
ARCHIVE_SOURCE = "somemodels"
ARCHIVE_ACTOR = "archive-worker"
UPDATE_FIELD_DEFAULTS = {
    "priority": 1,
    "category": "normal",
    "department": "general",
    "version": 1,
    "metadata.source": "migration",
}
