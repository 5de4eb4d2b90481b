"""Generated items and jobs: the same id always gives the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.functions.derived import below, ntz_micros, pick, plus_ms
from ferryline.schemas import ITEM_STATUSES

# ---- Fixed values: the lists rows are drawn from ---------------------------------------------------

DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "company.com")
FIRST_NAMES = (
    "John", "Jane", "Michael", "Sarah", "David", "Emily", "Chris", "Jessica", "Daniel", "Ashley", "Matthew",
    "Amanda", "James", "Jennifer", "Robert", "Lisa", "William", "Karen", "Richard", "Nancy", "Joseph", "Betty",
    "Thomas", "Helen", "Charles", "Sandra", "Christopher", "Donna",
)
LAST_NAMES = (
    "Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
    "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson", "Thomas", "Taylor", "Moore", "Jackson", "Martin",
    "Lee", "Perez", "Thompson", "White", "Harris", "Sanchez", "Clark",
)
# (priority, category, department)
TEMPLATES = (
    (1, "urgent", "sales"), (2, "normal", "marketing"), (3, "low", "support"),
    (4, "maintenance", "tech"), (5, "review", "admin"),
)
REGIONS = ("US", "EU", "ASIA")
JOB_ERRORS = ("Connection timeout", "Database error", "Validation failed", "Memory limit exceeded")
JOB_DRAWN_STATUSES = ("pending", "processing", "completed", "failed")
DAY_MS = 86_400_000
ITEM_AGE_DAYS = 90
JOB_AGE_DAYS = 30


def items_from_ids(ids: DataFrame, key: str, seed: int, as_of: Column) -> DataFrame:
    """One item per row of ``ids``."""
    k = F.col(key)
    first, last = pick(k, seed, "first", FIRST_NAMES), pick(k, seed, "last", LAST_NAMES)
    template = (below(k, seed, "template", len(TEMPLATES))).cast("int")
    age = below(k, seed, "age", ITEM_AGE_DAYS * DAY_MS // 1000) * 1000
    return ids.select(
        k.alias("item_id"), first.alias("_first"), last.alias("_last"), template.alias("_template"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), below(k, seed, "number", 1000).cast("string"),
                 F.lit("@"), pick(k, seed, "domain", DOMAINS)).alias("email"),
        pick(k, seed, "status", ITEM_STATUSES).alias("status"),
        (below(k, seed, "version", 10) + 1).alias("version"),
        pick(k, seed, "region", REGIONS).alias("region"),
        plus_ms(as_of, -age).alias("created_at"),
    ).select(
        "item_id", F.concat_ws(" ", "_first", "_last").alias("name"), "email", "status",
        F.get(F.array(*[F.lit(t[0]) for t in TEMPLATES]), F.col("_template")).alias("priority"),
        F.get(F.array(*[F.lit(t[1]) for t in TEMPLATES]), F.col("_template")).alias("category"),
        F.get(F.array(*[F.lit(t[2]) for t in TEMPLATES]), F.col("_template")).alias("department"),
        "version",
        F.concat(F.lit("Generated test data for "), F.concat_ws(" ", "_first", "_last")).alias("notes"),
        F.lit("seed-service").alias("source"), "region", "created_at", as_of.alias("updated_at"),
        as_of.alias("last_modified"),
        F.concat(F.lit("batch-"), F.floor(ntz_micros(as_of) / 1000).cast("string")).alias("batch"),
    )


def synth_items(spark: SparkSession, n: int, seed: int, as_of: Column) -> DataFrame:
    return items_from_ids(spark.range(n), "id", seed, as_of)


def jobs_from_ids(ids: DataFrame, key: str, seed: int, as_of: Column) -> DataFrame:
    """One job per row of ``ids``: an end only for finished ones, an error only for failed ones."""
    k = F.col(key)
    status = pick(k, seed, "job-status", JOB_DRAWN_STATUSES)
    number = F.lpad(k.cast("string"), F.greatest(F.lit(6), F.length(k.cast("string"))), F.lit("0"))
    age = below(k, seed, "job-age", JOB_AGE_DAYS * DAY_MS // 1000) * 1000
    run = below(k, seed, "job-run", DAY_MS // 1000) * 1000
    return ids.select(
        F.concat(F.lit("job-"), number).alias("correlation_id"), status.alias("status"),
        plus_ms(as_of, -age).alias("created_at"), run.alias("_run"),
        (below(k, seed, "job-items", 1000) + 1).alias("total_items"),
        F.concat(F.lit("Random error: "), pick(k, seed, "job-error", JOB_ERRORS)).alias("_error"),
    ).select(
        F.col("correlation_id").alias("job_id"), "correlation_id", "status", "created_at",
        F.when(F.col("status").isin("completed", "failed"), plus_ms(F.col("created_at"), F.col("_run"))).alias("completed_at"),
        "total_items", F.when(F.col("status") == "failed", F.col("_error")).alias("error"),
    )


def synth_jobs(spark: SparkSession, n: int, seed: int, as_of: Column) -> DataFrame:
    return jobs_from_ids(spark.range(n), "id", seed, as_of)
