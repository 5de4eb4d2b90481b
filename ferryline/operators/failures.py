"""Retries, expiry and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.derived import iso, plus_ms
from ferryline.functions.errors import error_class, error_detail, severity, status_code
from ferryline.operators.ranking import ROWS_PER_BUCKET, number_rows
from ferryline.schemas import (
    DEAD_LETTER_EXCHANGE, MAIN_EXCHANGE, PERMANENT_DEATHS, QUEUES, REQUEUE_DELAY_MS, REVIEW_DEATHS, QueuePolicy,
)


# The settings of a queue as a struct column.
_POLICY_TYPES = {
    "queue": "string", "retry": "boolean", "max_retries": "int", "retry_delay_ms": "bigint",
    "exhausted_key": "string", "expired_key": "string",
}


def policy_of(queue_type: Column, policy: Sequence[QueuePolicy] = QUEUES) -> Column:
    """The settings of the row's queue, null for an unknown one. Policies are configuration: no join."""
    rows = [
        F.when(
            queue_type == p.queue_type,
            F.struct(*[F.lit(getattr(p, name)).cast(kind).alias(name) for name, kind in _POLICY_TYPES.items()]),
        )
        for p in policy
    ]
    return F.coalesce(*rows)


def classify_errors(df: DataFrame, message: str = "message") -> DataFrame:
    """Error text to class, status code and detail."""
    kind = error_class(F.col(message))
    return df.withColumns({
        "error_class": kind, "status_code": status_code(kind), "detail": error_detail(F.col(message), kind),
    })


def error_severity(df: DataFrame) -> DataFrame:
    """Severity from ``status_code`` and ``is_operational``."""
    return df.withColumn("severity", severity(F.col("status_code"), F.col("is_operational")))


def attempt_number(
    failures: DataFrame, key: str, order: Sequence[str], failed_at: str, reason: Column, queue: Column,
    max_retries: int, rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Attempt k of max per message, with the retry headers of that attempt."""
    numbered = number_rows(failures, order, [key], "attempt", rows_per_bucket)
    headers = F.create_map(
        F.lit("x-retries"), F.col("attempt").cast("string"),
        F.lit("x-original-queue"), queue,
        F.lit("x-retry-reason"), reason,
        F.lit("x-retry-timestamp"), iso(F.col(failed_at)),
    )
    return numbered.withColumns({
        "max_retries": F.lit(max_retries).cast("bigint"),
        "exhausted": F.col("attempt") > max_retries,
        "retry_headers": headers,
    })


def retry_policy(
    failures: DataFrame, failed_at: str = "published_at", policy: Sequence[QueuePolicy] = QUEUES
) -> DataFrame:
    """What becomes of each failed message, from the retry count it carries: no state is kept.

    ``retry`` counts one up and expires after the queue's delay; a message out of retries goes to the
    dead letters where its queue has them, and is dropped otherwise. A queue without retries rejects
    the message, which follows the queue's own dead-letter key.
    """
    retries = F.coalesce(F.col("x_retries"), F.lit(0))
    rules = F.col("_policy")
    retrying = F.coalesce(rules["retry"], F.lit(False))
    again = retrying & (retries < rules["max_retries"])
    key = F.when(retrying, rules["exhausted_key"]).otherwise(rules["expired_key"])
    decided = failures.withColumn("_policy", policy_of(F.col("queue_type"), policy)).withColumn(
        "outcome", F.when(again, "retry").when(key.isNotNull(), "dead_letter").otherwise("dropped")
    )
    outcome = F.col("outcome")
    return decided.withColumns({
        "next_retries": F.when(outcome == "retry", retries + 1).otherwise(retries).cast("bigint"),
        "expires_at": F.when(outcome == "retry", plus_ms(F.col(failed_at), rules["retry_delay_ms"])),
        "next_key": F.when(outcome == "retry", F.col("routing_key")).when(outcome == "dead_letter", key),
    }).drop("_policy")


def split_outcomes(
    messages: DataFrame, as_of: Column, reason: Column, policy: Sequence[QueuePolicy] = QUEUES
) -> DataFrame:
    """Every message with one ``outcome``: ok, retry, dead_letter or dropped; dead letters get death headers.

    ``death_count`` is written here, one more than the retries, so that triage finds it later.
    """
    judged = retry_policy(messages, policy=policy)
    judged = judged.withColumn("outcome", F.when(F.col("handler_failed"), F.col("outcome")).otherwise("ok"))
    dead = F.col("outcome") == "dead_letter"
    return judged.withColumns({
        "next_retries": F.when(F.col("handler_failed"), F.col("next_retries")),
        "expires_at": F.when(F.col("handler_failed"), F.col("expires_at")),
        "next_key": F.when(F.col("handler_failed"), F.col("next_key")),
        "x_death_reason": F.when(dead, reason),
        "x_death_at": F.when(dead, as_of),
        "x_original_routing_key": F.when(dead, F.col("routing_key")),
        "x_first_death_queue": F.when(dead, policy_of(F.col("queue_type"), policy)["queue"]),
        "x_death_count": F.when(dead, F.coalesce(F.col("x_retries"), F.lit(0)) + 1),
    })


def requeue(
    judged: DataFrame, message_columns: Sequence[str], reason: Column, failed_at: Column,
    policy: Sequence[QueuePolicy] = QUEUES,
) -> DataFrame:
    """The retries among judged messages as messages again: same id, priority and body, one retry more.

    Written to the folder their queue is read from, they come back with the next trigger; the count
    they carry ends the cycle. ``expires_at`` stays with them.
    """
    again = judged.where(F.col("outcome") == "retry")
    kept = [c for c in message_columns if c != "x_retries"]
    return again.select(
        *kept, F.col("next_retries").alias("x_retries"), "expires_at",
        F.coalesce(policy_of(F.col("queue_type"), policy)["queue"], F.lit("unknown")).alias("x_original_queue"),
        reason.alias("x_retry_reason"), failed_at.alias("x_retry_at"),
    )


def expire_messages(messages: DataFrame, policy: Sequence[QueuePolicy] = QUEUES) -> DataFrame:
    """Messages that waited longer than their time to live leave: to the queue's dead-letter key, or dropped."""
    gone = (F.col("ttl_ms") > 0) & (F.col("wait_ms") > F.col("ttl_ms"))
    key = policy_of(F.col("queue_type"), policy)["expired_key"]
    fate = F.when(~F.coalesce(gone, F.lit(False)), "waiting").when(key.isNotNull(), "dead_letter").otherwise("dropped")
    exchange = F.when(key.startswith("failed."), DEAD_LETTER_EXCHANGE).otherwise(MAIN_EXCHANGE)
    return messages.withColumns({
        "fate": fate,
        "expired_key": F.when(fate == "dead_letter", key),
        "expired_exchange": F.when(fate == "dead_letter", exchange),
    })


def dead_letter_triage(dead_letters: DataFrame) -> DataFrame:
    """Requeue, review or give up, by the number of deaths; works on streams as it is."""
    deaths = F.coalesce(F.col("death_count"), F.lit(1))
    action = (
        F.when(deaths >= PERMANENT_DEATHS, "permanently_failed")
        .when(deaths >= REVIEW_DEATHS, "manual_review")
        .otherwise("requeued")
    )
    return dead_letters.withColumns({
        "deaths": deaths,
        "origin": F.coalesce(F.col("original_queue"), F.lit("unknown")),
        "action": action,
        "requeue_delay_ms": F.when(action == "requeued", deaths.cast("bigint") * REQUEUE_DELAY_MS),
    })


def dead_letter_backlog(messages: DataFrame) -> DataFrame:
    """Messages waiting in the dead-letter queue."""
    waiting = F.count_if(F.col("queue_type") == "deadletter")
    return messages.agg(waiting.alias("available_messages"))
