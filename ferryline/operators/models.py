"""The rules and defaults of the three kinds of rows: items, jobs and archive rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column

from ferryline.operators.validation import Rule, between, one_of, required, unique
from ferryline.schemas import (
    ARCHIVE_ACTOR, ARCHIVE_REASON, ARCHIVE_SOURCE, DEAD_LETTER_STATUSES, ITEM_STATUSES, JOB_STATUSES, JOB_TYPES,
    UPDATE_FIELD_DEFAULTS,
)


def item_rules() -> list[Rule]:
    return [one_of("status", ITEM_STATUSES)]


def job_rules(with_dead_letters: bool = True) -> list[Rule]:
    """Dead-letter handling writes statuses of its own, so the log knows them besides those of a job."""
    statuses = JOB_STATUSES + DEAD_LETTER_STATUSES if with_dead_letters else JOB_STATUSES
    return [
        *required("job_id", "correlation_id"),
        one_of("status", statuses),
        between("progress", 0, 100),
        one_of("job_type", JOB_TYPES),
        unique("correlation_id"),
    ]


def archive_row_rules() -> list[Rule]:
    needed = ("name", "email", "original_id", "archive_batch", "original_created_at", "original_updated_at")
    return [*required(*needed), one_of("status", ITEM_STATUSES)]


def item_defaults() -> Mapping[str, object]:
    return {"status": "pending"}


def job_defaults(as_of: Column) -> Mapping[str, object]:
    return {
        "status": "pending", "total_items": 0, "processed_items": 0, "progress": 0.0, "start_time": as_of,
        "job_type": "batch", "completed_batches": 0, "failed_batches": 0, "total_batches": 0,
    }


def archive_defaults(as_of: Column, nested: str = "update_fields") -> Mapping[str, object]:
    """Defaults of an archive row, with those of the fields inside its ``nested`` struct."""
    inner = {f"{nested}.{name}": value for name, value in UPDATE_FIELD_DEFAULTS.items()}
    return {
        "status": "pending", "archived_at": as_of, "archive_reason": ARCHIVE_REASON,
        "source_collection": ARCHIVE_SOURCE, "archived_by": ARCHIVE_ACTOR, f"{nested}.last_modified": as_of, **inner,
    }
