"""The given tables in the shapes the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.schemas import ITEM
from ferryline.sources.collections import table


def _days_later(ts: str, days: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(days=days.cast("int"))


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer's name, segment and region as items."""
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    homes = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    buyers = customer.join(homes, customer.c_nationkey == homes.n_nationkey)
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "P", "pending")
        .when(F.col("o_orderstatus") == "O", "processing")
        .when(key % 2 == 0, "failed")
        .otherwise("success")
    )
    return orders.join(buyers, orders.o_custkey == buyers.c_custkey).select(
        key.alias("item_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        status.alias("status"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.lower(F.substr("o_orderpriority", F.lit(3))).alias("category"),
        F.when(key % 11 != 0, F.lower("c_mktsegment")).alias("department"),
        F.col("r_name").alias("region"),
        F.when(key % 3 != 0, (key % 5).cast("int")).alias("retry_count"),
        F.col("o_orderdate").alias("created_at"),
        _days_later("o_orderdate", key % 7).alias("updated_at"),
    ).select(*ITEM.names)


def messages_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    key = (
        F.when(kind == "click", "process.bulkUpdate").when(kind == "purchase", "priority.bulkUpdate")
        .when(kind == "view", "archive.bulkMigration").when(kind == "error", "failed.manual").otherwise("misc.signup")
    )
    queue = (
        F.when(kind == "click", "processing").when(kind == "purchase", "priority")
        .when(kind == "view", "archive").when(kind == "error", "deadletter").otherwise("unknown")
    )
    number = F.col("event_id")
    return events.select(
        number.alias("message_id"),
        F.concat(F.lit("job-"), F.col("user_id").cast("string")).alias("correlation_id"),
        F.col("ts").alias("published_at"),
        key.alias("routing_key"),
        queue.alias("queue_type"),
        (number % 11).cast("int").alias("priority"),
        (_k() % 7).alias("x_retries"),
        F.nullif(_k() % 8, F.lit(0)).alias("death_count"),
        (_k() * 1000).alias("ttl_ms"),
        ((number % 8).cast("int") * 10000).alias("wait_ms"),
        (number % 5 == 0).alias("handler_failed"),
        F.col("props").alias("body"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as queued messages."""
    return messages_of(table(spark, folder, "events"))


def job_log_of(events: DataFrame) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    return events.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("job-"), user.cast("string")).alias("correlation_id"),
        F.concat(F.lit("parent-"), (user % 10).cast("string")).alias("parent_job_id"),
        F.col("ts").alias("event_ts"),
        F.when(kind == "signup", "pending").when(kind == "purchase", "completed")
        .when(kind == "error", "failed").otherwise("processing").alias("status"),
        (_k() + 1).alias("total_items"),
        F.when(kind == "purchase", _k() + 1).otherwise(F.lit(0)).alias("processed_items"),
    )


def job_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as job status transitions."""
    return job_log_of(table(spark, folder, "events"))


def worker_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as worker activity."""
    user, kind = F.col("user_id"), F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        (user % 20).cast("int").alias("worker_no"),
        F.when(user % 4 == 0, "ProcessingConsumer").when(user % 4 == 1, "PriorityConsumer")
        .when(user % 4 == 2, "DeadLetterConsumer").otherwise("ArchiveConsumer").alias("consumer_type"),
        F.when(kind == "error", "error").when(kind == "signup", "ready")
        .when(kind == "view", "exit").otherwise("messageProcessed").alias("type"),
        F.col("ts").alias("event_ts"),
        F.round(F.col("value") * 100).cast("bigint").alias("processing_ms"),
    )


def archive(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as archive rows of one or two runs."""
    key = F.col("o_orderkey")
    runs = F.when(key % 6 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    kept = table(spark, folder, "orders").where(key % 3 != 0)
    return kept.withColumn("run_no", F.explode(runs)).select(
        key.alias("original_id"),
        F.col("o_orderstatus").alias("status"),
        F.concat(F.lit("someModel_batch_"), (F.floor(key / 100).cast("bigint") + 1).cast("string")).alias("archive_batch"),
        _days_later("o_orderdate", 30 + 30 * F.col("run_no")).alias("archived_at"),
        "run_no",
    )


def errors(spark: SparkSession, folder: str) -> DataFrame:
    """Error events with a broker error text."""
    texts = [
        "NOT_FOUND - no queue app.x", "queue does not exist", "PRECONDITION_FAILED - inequivalent arg",
        "PRECONDITION_FAILED - other", "Channel closed", "Connection closed", "socket hang up",
    ]
    return table(spark, folder, "events").where(F.col("event_type") == "error").select(
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("event_ts"),
        F.get(F.array(*[F.lit(t) for t in texts]), _k() % 7).alias("message"),
    )
