"""Every operator as a query on the given tables. Its SQL counterpart is in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.errors import mask_credentials
from ferryline.functions.filters import filter_spec, free_field
from ferryline.operators import archive as arc
from ferryline.operators import failures as fail
from ferryline.operators import jobs, models, monitoring, routing, synth, updates, validation
from ferryline.operators.batching import allocate_sequence, make_batches, page, unwrap_batches, work_order
from ferryline.plans import flows
from ferryline.schemas import CLEAR_CONFIRMATION, EVENT, ITEM, ITEM_STATUSES, QUEUES
from ferryline.session import work_folder
from ferryline.sources import collections as col
from ferryline.sources import views
from ferryline.sources.bodies import decode_messages
from ferryline.sources.folders import folders_for, update_folders, write_folders
from ferryline.sources.tables import append_valid, queue_folder, send, write_snapshot
from ferryline.streaming import activity as act
from ferryline.streaming import consumers, running
from ferryline.streaming import jobs as job_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BODY = T.StructType([T.StructField("k", T.IntegerType())])
MESSAGE = T.StructType([T.StructField("correlation_id", T.StringType()), T.StructField("body", T.StringType())])
BATCH = 100
SEED = 42


def as_of():
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


def query(f: Query) -> Query:
    """Register ``f`` under its name; a leading ``q_`` only keeps it apart from an operator of that name."""
    QUERIES[f.__name__.removeprefix("q_")] = f
    return f


# ---- Sources and sinks ---------------------------------------------------------------------------


@query
def scan_collection(spark, folder):
    spec = {"o_orderstatus": "F", "o_totalprice": {"$gte": 1000}}
    return col.scan_collection(spark, folder, "orders", spec, ["o_orderkey", "o_custkey", "o_totalprice"])


def _cut_bodies(messages):
    """Every seventh body loses its last character and no longer parses."""
    short = F.substr("body", F.lit(1), F.length("body") - 1)
    return messages.withColumn("body", F.when(F.col("message_id") % 7 == 0, short).otherwise(F.col("body")))


def _partly_broken(spark, folder):
    return _cut_bodies(views.messages(spark, folder)).select("message_id", "body")


@query
def q_decode_messages(spark, folder):
    return decode_messages(_partly_broken(spark, folder), BODY).good.select("message_id", "content.k")


@query
def decode_messages_bad(spark, folder):
    return decode_messages(_partly_broken(spark, folder), BODY).bad


def _events_stream(spark, folder):
    """The events as a stream of several micro-batches in the order of their times."""
    path = work_folder(spark, "events")
    files = running.write_source(col.table(spark, folder, "events"), path, "ts", "event_id")
    return running.stream_scan(spark, path, EVENT, maxFilesPerTrigger=str(files))


@query
def stream_scan(spark, folder):
    home = work_folder(spark, "stream-scan")
    decoded = decode_messages(_events_stream(spark, folder), BODY, "props").good
    rows = decoded.select("event_id", "event_type", "content.k")
    running.run_available(spark, rows.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{home}/rows")


@query
def table_inventory(spark, folder):
    return col.table_inventory(spark, folder)


@query
def q_append_valid(spark, folder):
    rules = [
        *validation.required("name", "department"),
        validation.one_of("status", ITEM_STATUSES),
        validation.between("priority", 1, 4),
        validation.unique("item_id"),
    ]
    done = append_valid(views.items(spark, folder), rules, work_folder(spark, "append-valid"), "first")
    return done.table.select("item_id", "name", "status", "priority", "department", "run_id")


def _order_batches(spark, folder):
    rows = col.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("item_id"), F.col("o_orderstatus").alias("status")
    )
    return make_batches(rows, "item_id", BATCH, "someModel")


@query
def publish_batches(spark, folder):
    sent = routing.publish_batches(_order_batches(spark, folder), 7, "processing", 30_000, as_of())
    return sent.select(
        "correlation_id", "message_id", "exchange", "routing_key", "reported_queue", "delivered_queue", "priority",
        "expiration", F.col("headers")["batchSize"].alias("h_batch_size"), F.col("headers")["priority"].alias("h_priority"),
        F.get_json_object("body", "$.metadata.totalBatches").cast("bigint").alias("total_batches"),
    )


@query
def published_jobs(spark, folder):
    sent = routing.publish_batches(_order_batches(spark, folder), 0, "processing", 0, as_of())
    return jobs.published_jobs(sent, as_of())


STRANGE = 1_000_000_000


def _transitions(items):
    """Updates of all open items; those with odd ids are sent under an id no item has."""
    work = validation.work_set(items, "process_all")
    changed = updates.status_transition(work, as_of(), "run-1")
    return changed.withColumn("item_id", F.col("item_id") + F.when(F.col("item_id") % 2 == 1, STRANGE).otherwise(0))


def numbered(df: DataFrame, *names: str) -> DataFrame:
    """Show missing numbers as -1, so that every reader of the result sees whole numbers."""
    return df.withColumns({name: F.coalesce(name, F.lit(-1)) for name in names})


UPDATED = [
    "item_id", "status", "retry_count", "last_retry_at", "processing_duration_ms", "last_processed", "processed_by",
    "processing_completed", "department",
]


def _shown(items: DataFrame) -> DataFrame:
    shown = numbered(items.select(*UPDATED), "retry_count", "processing_duration_ms")
    return shown.withColumn("processing_completed", F.coalesce("processing_completed", F.lit(False)))


@query
def keyed_update(spark, folder):
    items = views.items(spark, folder)
    new = updates.keyed_update(items, _transitions(items), "item_id", updates.TRANSITION_COLUMNS).target
    return _shown(write_snapshot(new, work_folder(spark, "keyed-update"), 1))


@query
def keyed_update_folders(spark, folder):
    """The same on a table in folders by key, of which an update rewrites only those it touches."""
    items, home = views.items(spark, folder), work_folder(spark, "keyed-folders")
    folders = folders_for(items.count())
    write_folders(items, f"{home}/table", "item_id", folders)
    done = update_folders(
        spark, f"{home}/table", f"{home}/staged", items.schema, _transitions(items), "item_id", updates.TRANSITION_COLUMNS, folders)
    return _shown(done.table)


@query
def job_transition(spark, folder):
    log = views.job_log(spark, folder).select("seq", "correlation_id", "event_ts", "status")
    changes = col.table(spark, folder, "events").select(
        (F.col("event_id") + 1_000_000_000).alias("seq"),
        F.concat(F.lit("job-"), (F.col("user_id") + 1_000_000 * (F.col("event_id") % 2)).cast("string")).alias("correlation_id"),
        as_of().alias("event_ts"),
        F.lit("cancelled").alias("status"),
    )
    return jobs.job_transition(log, changes)


@query
def delete_archived(spark, folder):
    return arc.delete_archived(views.items(spark, folder), views.archive(spark, folder), enabled=True).select("item_id", "status")


@query
def clear_tables(spark, folder):
    home = work_folder(spark, "clear-tables")
    paths = {name: f"{home}/{name}" for name in ("orders", "customer", "events")}
    for name, path in paths.items():
        col.table(spark, folder, name).write.parquet(path)
    return col.clear_tables(spark, paths, CLEAR_CONFIRMATION)


# ---- Filters and rules ---------------------------------------------------------------------------


@query
def q_filter_spec(spark, folder):
    spec = {"$or": [{"status": "failed"}, {"priority": {"$lte": 2}}], "department": {"$ne": "building"}}
    return views.items(spark, folder).where(filter_spec(spec)).select("item_id", "status", "priority", "department")


@query
def filter_free_fields(spark, folder):
    """A filter on paths that no schema declares, beside a declared column; bodies are parsed once, as VARIANT."""
    held = F.to_json(F.struct("priority", F.struct("region", "department").alias("meta"), (F.col("item_id") % 2 == 0).alias("even")))
    loose = views.items(spark, folder).select("item_id", "status", F.try_parse_json(held).alias("fields"))
    spec = {"status": {"$ne": "success"}, "$or": [{"meta.region": "EUROPE", "even": True}, {"priority": {"$gte": 4}, "meta.department": None},
            {"meta.region": {"$in": ["ASIA"]}, "meta.none": {"$exists": False}, "priority": {"$lt": 2}}]}
    return loose.where(filter_spec(spec, free_field("fields", ["status"]))).select("item_id", "status")


@query
def count_where(spark, folder):
    return validation.count_where(views.items(spark, folder), {"status": {"$in": ["pending", "failed"]}, "department": None})


@query
def status_counts(spark, folder):
    return validation.status_counts(views.items(spark, folder))


@query
def validate_rows(spark, folder):
    rules = [
        *validation.required("department"),
        validation.between("priority", 1, 4),
        validation.unique("email", "created_at"),
    ]
    bad = validation.validate_rows(views.items(spark, folder), rules).bad
    return bad.select("item_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def validate_jobs(spark, folder):
    """Every second generated job lacks its id and has a status jobs do not know."""
    made = synth.jobs_from_ids(col.table(spark, folder, "orders"), "o_orderkey", SEED, as_of())
    raw = F.substr("correlation_id", F.length("correlation_id")).cast("int") % 2 == 0
    loose = made.withColumns({
        "job_id": F.when(~raw, F.col("job_id")),
        "status": F.when(raw & (F.col("status") == "completed"), "success").otherwise(F.col("status")),
    })
    filled = validation.fill_defaults(loose, models.job_defaults(as_of()))
    bad = validation.validate_rows(filled, models.job_rules()).bad
    return bad.select("correlation_id", "status", "progress", "job_type", F.array_join("reasons", "; ").alias("reasons"))


@query
def archive_defaults(spark, folder):
    sparse = views.items(spark, folder).select(
        F.col("item_id").alias("original_id"),
        F.when(F.col("item_id") % 4 != 0, F.col("status")).alias("status"),
        F.struct(
            F.when(F.col("item_id") % 3 != 0, F.col("priority")).alias("priority"), "category", "department",
            F.lit(None).cast("int").alias("version"), F.lit(None).cast("timestamp_ntz").alias("last_modified"),
            F.struct(F.lit(None).cast("string").alias("source"), "region").alias("metadata"),
        ).alias("update_fields"),
    )
    return validation.fill_defaults(sparse, models.archive_defaults(as_of())).select(
        "original_id", "status", "archived_at", "archive_reason", "source_collection", "archived_by",
        "update_fields.priority", "update_fields.category", "update_fields.department", "update_fields.version",
        "update_fields.last_modified", "update_fields.metadata.source", "update_fields.metadata.region",
    )


@query
def fill_defaults(spark, folder):
    nested = views.items(spark, folder).select(
        "item_id", "department", F.struct(F.col("department"), F.col("category")).alias("update_fields")
    )
    filled = validation.fill_defaults(
        nested, {"department": "general", "update_fields.department": "general", "archive_reason": "bulk_migration"}
    )
    return filled.select(
        "item_id", "department", F.col("update_fields.department").alias("nested_department"),
        F.col("update_fields.category").alias("category"), "archive_reason",
    )


@query
def work_set(spark, folder):
    return validation.work_set(views.items(spark, folder), "process_all").select("item_id", "status")


# ---- Row transforms ------------------------------------------------------------------------------


@query
def archive_rows(spark, folder):
    batch = F.concat(F.lit("someModel_batch_"), (F.floor(F.col("item_id") / 100).cast("bigint") + 1).cast("string"))
    return arc.archive_rows(views.items(spark, folder), batch, as_of())


@query
def status_transition(spark, folder):
    return _shown(updates.status_transition(views.items(spark, folder), as_of(), "run-1"))


@query
def processing_duration(spark, folder):
    started = F.when(F.col("item_id") % 4 == 0, F.col("created_at"))
    duration = updates.processing_duration_ms(as_of(), started, F.col("updated_at"))
    return views.items(spark, folder).where("status = 'processing'").select("item_id", duration.alias("duration_ms"))


@query
def route_message(spark, folder):
    return routing.route_message(views.messages(spark, folder)).select(
        "message_id", "routing_key", "reported_queue", "delivered_queue"
    )


@query
def message_headers(spark, folder):
    sized = views.messages(spark, folder).withColumns({
        "batch_size": F.col("x_retries") + 1, "delay_ms": F.col("ttl_ms") - 30_000,
    })
    out = routing.message_headers(sized, F.col("published_at"))
    names = {
        "batchSize": "h_batch_size", "source": "h_source", "timestamp": "h_timestamp", "priority": "h_priority",
        "queueType": "h_queue_type", "x-published-at": "h_published_at",
    }
    return out.select("message_id", *[F.col("headers")[k].alias(v) for k, v in names.items()], "expiration")


@query
def ensure_ids(spark, folder):
    number = F.col("message_id")
    sparse = views.messages(spark, folder).select(
        number.alias("number"),
        F.when(number % 4 == 0, "  ").when(number % 4 != 1, F.col("correlation_id")).alias("correlation_id"),
        F.when(number % 5 == 0, "").otherwise(number.cast("string")).alias("message_id"),
    )
    return routing.ensure_ids(sparse, SEED, "number")


@query
def q_unwrap_batches(spark, folder):
    batches = make_batches(views.items(spark, folder), "item_id", BATCH, "someModel")
    sent = routing.publish_batches(batches, 0, "archive", 0, as_of())
    return numbered(unwrap_batches(sent.select("correlation_id", "body"), ITEM).items.drop("collection"), "retry_count")


@query
def unwrap_batches_errors(spark, folder):
    number = F.col("message_id")
    bodies = views.messages(spark, folder).select(
        number,
        F.when(number % 3 == 0, F.concat(F.lit('{"batchId": "b", "collection": "someModel", "data": ['), "body", F.lit("]}")))
        .when(number % 3 == 1, F.concat(F.lit("["), "body", F.lit("]")))
        .otherwise(F.lit('{"batchId": "e", "collection": "someModel", "data": []}')).alias("body"),
    )
    return unwrap_batches(bodies, BODY).errors


@query
def classify_errors(spark, folder):
    return fail.classify_errors(views.errors(spark, folder)).select("error_id", "error_class", "status_code", "detail")


@query
def error_severity(spark, folder):
    graded = fail.classify_errors(views.errors(spark, folder)).withColumns({
        "status_code": F.when(F.col("error_id") % 5 == 0, 200).otherwise(F.col("status_code")),
        "is_operational": F.col("error_id") % 7 != 0,
    })
    return fail.error_severity(graded).select("error_id", "status_code", "severity")


@query
def q_mask_credentials(spark, folder):
    url = F.concat(F.lit("amqp://user"), F.col("page_id").cast("string"), F.lit(":p@ss@"), F.substr("url", F.lit(9)))
    return col.table(spark, folder, "pages").select("page_id", mask_credentials(url).alias("masked"))


@query
def synth_items(spark, folder):
    return synth.items_from_ids(col.table(spark, folder, "orders"), "o_orderkey", SEED, as_of())


@query
def synth_jobs(spark, folder):
    return synth.jobs_from_ids(col.table(spark, folder, "orders"), "o_orderkey", SEED, as_of())


# ---- Joins ---------------------------------------------------------------------------------------

PATTERNS = (
    ("process.*", "app.processing.queue"), ("priority.*", "app.priority.queue"), ("archive.*", "app.archive.queue"),
    ("failed.*", "app.deadletter.queue"), ("#.bulkUpdate", "audit"), ("*.bulkMigration", "audit"),
)


@query
def topic_route(spark, folder):
    return routing.topic_route(views.messages(spark, folder), PATTERNS).select("message_id", "routing_key", "queue")


def _bindings(spark, folder):
    """A binding for every order: exact keys, one free word, and free runs of words at either end or within."""
    kind, first = F.col("o_orderkey") % 6, F.get(F.array(*[F.lit(w) for w in ("process", "priority", "archive", "failed", "misc")]), (F.col("o_orderkey") % 5).cast("int"))
    user, k = F.concat(F.lit("u"), F.col("o_custkey") % 150), F.concat(F.lit("k"), F.col("o_orderkey") % 100)

    def joined(*words):
        return F.concat_ws(".", *[F.lit(w) if isinstance(w, str) else w for w in words])

    pattern = (
        F.when(kind == 0, joined(first, "bulkUpdate", user, k)).when(kind == 1, joined(first, "*", user, "*"))
        .when(kind == 2, joined("#", user, k)).when(kind == 3, joined(first, "#", k, "#", "#"))
        .when(kind == 4, joined("*", "*", user, "#", k)).otherwise(joined(first, "bulkUpdate"))
    )
    queue = F.concat(F.lit("queue-"), F.col("o_orderkey") % 40)
    return col.table(spark, folder, "orders").select(pattern.alias("pattern"), queue.alias("queue"))


@query
def topic_route_table(spark, folder):
    """Messages with their user and number in the key, against as many bindings as there are orders."""
    sent = views.messages(spark, folder).select("message_id", F.concat_ws(
        ".", "routing_key", F.concat(F.lit("u"), F.substr("correlation_id", F.lit(5))),
        F.concat(F.lit("k"), F.col("message_id") % 100)).alias("routing_key"))
    found = routing.topic_route_table(sent, _bindings(spark, folder))
    return found.groupBy("message_id", "routing_key").agg(
        F.count("queue").alias("queues"), F.min("queue").alias("first_queue"), F.max("queue").alias("last_queue"))


@query
def to_kafka_rows(spark, folder):
    rows = routing.to_kafka_rows(routing.publish_batches(_order_batches(spark, folder), 7, "processing", 30_000, as_of()))
    named = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], F.decode(h["value"], "UTF-8"))))
    return rows.select("topic", "key", F.get_json_object("value", "$.batchId").alias("batch_id"),
                       F.get_json_object("value", "$.metadata.batchSize").cast("bigint").alias("items"),
                       F.size("headers").cast("bigint").alias("headers"), named["queueType"].alias("queue_type"))


def _line_updates(spark, folder):
    """Several updates per order, some for orders that do not exist."""
    key = F.col("l_orderkey") + F.when(F.col("l_quantity") > 45, STRANGE).otherwise(0)
    return col.table(spark, folder, "lineitem").select(
        key.alias("item_id"),
        F.when(F.col("l_returnflag") == "R", "failed").otherwise("success").alias("status"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
    )


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


def _line_join(spark, folder):
    return updates.update_join(
        views.items(spark, folder), _line_updates(spark, folder), "item_id", ["status"], LINE_ORDER
    )


@query
def update_join(spark, folder):
    return _line_join(spark, folder)


@query
def archive_reconcile_missing(spark, folder):
    return arc.archive_reconcile(views.items(spark, folder), views.archive(spark, folder)).missing.select("item_id", "email")


@query
def archive_reconcile_present(spark, folder):
    return arc.archive_reconcile(views.items(spark, folder), views.archive(spark, folder)).present.select("item_id", "email")


@query
def archive_reconcile(spark, folder):
    return arc.archive_reconcile(views.items(spark, folder), views.archive(spark, folder)).per_batch


@query
def find_by_original(spark, folder):
    wanted = col.table(spark, folder, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("original_id"))
    return arc.find_by_original(views.archive(spark, folder), wanted)


def _some_unknown(messages):
    """Every third message belongs to a job nobody knows."""
    unknown = F.concat("correlation_id", F.lit("-unknown"))
    return messages.withColumn(
        "correlation_id", F.when(F.col("message_id") % 3 == 0, unknown).otherwise(F.col("correlation_id"))
    )


@query
def dead_letter_jobs(spark, folder):
    dead = _some_unknown(views.messages(spark, folder).where("queue_type = 'deadletter'"))
    state = jobs.latest_state(views.job_log(spark, folder), "correlation_id", ["event_ts", "seq"])
    return jobs.dead_letter_jobs(dead.select("message_id", "correlation_id", "priority"), state)


# ---- Aggregations --------------------------------------------------------------------------------


@query
def archive_stats(spark, folder):
    return arc.archive_stats(views.archive(spark, folder))


@query
def queue_depth(spark, folder):
    queues = {
        "ProcessingConsumer": "processing", "PriorityConsumer": "priority",
        "DeadLetterConsumer": "deadletter", "ArchiveConsumer": "archive",
    }
    queue = F.coalesce(*[F.when(F.col("consumer_type") == kind, name) for kind, name in queues.items()])
    workers = views.worker_log(spark, folder).select(queue.alias("queue_type"), F.col("worker_no").alias("consumer"))
    return monitoring.queue_depth(views.messages(spark, folder), consumers=workers)


@query
def run_summary(spark, folder):
    log = views.worker_log(spark, folder).select(
        F.col("consumer_type").alias("run_id"), (F.col("processing_ms") % 500 + 1).alias("row_count"),
        F.col("event_ts").alias("logged_at"),
    )
    return monitoring.run_summary(log)


@query
def worker_stats(spark, folder):
    return monitoring.worker_stats(views.worker_log(spark, folder), as_of())


@query
def worker_health(spark, folder):
    return monitoring.worker_health(views.worker_log(spark, folder))


@query
def worker_counters(spark, folder):
    return monitoring.worker_counters(views.worker_log(spark, folder))


@query
def processing_rate(spark, folder):
    return monitoring.processing_rate(views.worker_log(spark, folder), as_of())


@query
def job_progress(spark, folder):
    return jobs.job_progress(views.job_log(spark, folder))


@query
def update_counts(spark, folder):
    return updates.update_counts(_line_join(spark, folder))


@query
def batch_latency(spark, folder):
    return monitoring.batch_latency(views.worker_log(spark, folder))


@query
def dead_letter_backlog(spark, folder):
    return fail.dead_letter_backlog(views.messages(spark, folder))


# ---- Batches, order, latest rows -----------------------------------------------------------------


@query
def q_make_batches(spark, folder):
    return _order_batches(spark, folder).select(
        "batch_id", "collection", "metadata.*",
        F.array_join(F.transform("data", lambda d: d["item_id"].cast("string")), ",").alias("item_ids"),
    )


@query
def latest_state(spark, folder):
    return jobs.latest_state(views.job_log(spark, folder), "correlation_id", ["event_ts", "seq"])


@query
def attempt_number(spark, folder):
    failed = views.job_log(spark, folder).where("status = 'failed'")
    out = fail.attempt_number(
        failed, "correlation_id", ["event_ts", "seq"], "event_ts", F.lit("handler failed"),
        F.lit("app.processing.queue"), 3,
    )
    headers = F.col("retry_headers")
    return out.select(
        "correlation_id", "seq", "attempt", "max_retries", "exhausted", headers["x-retries"].alias("x_retries"),
        headers["x-original-queue"].alias("x_original_queue"), headers["x-retry-reason"].alias("x_retry_reason"),
        headers["x-retry-timestamp"].alias("x_retry_timestamp"),
    )


@query
def delivery_order(spark, folder):
    return routing.delivery_order(views.messages(spark, folder)).select("message_id", "queue_type", "delivery_position")


@query
def q_page(spark, folder):
    return page(col.table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 1_000, 500)


@query
def latest_archive(spark, folder):
    return arc.latest_archive(views.archive(spark, folder))


@query
def find_by_batch(spark, folder):
    return arc.find_by_batch(views.archive(spark, folder), "someModel_batch_3")


@query
def q_allocate_sequence(spark, folder):
    counters = col.table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(
        F.count(F.lit(1)).alias("seq")
    )
    rows = col.table(spark, folder, "customer").select("c_custkey", "c_name")
    return allocate_sequence(rows, counters, "F", "c_name").rows


@query
def allocate_sequence_counters(spark, folder):
    counters = col.table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(
        F.count(F.lit(1)).alias("seq")
    )
    rows = col.table(spark, folder, "customer").select("c_custkey")
    return allocate_sequence(rows, counters, "F", "c_custkey").counters


@query
def q_work_order(spark, folder):
    return work_order(views.items(spark, folder)).select("item_id", "work_rank", "created_at")


# ---- Streaming, retries, dead letters ------------------------------------------------------------


@query
def stream_handler(spark, folder):
    home = work_folder(spark, "stream-handler")
    stream = views.messages_of(_events_stream(spark, folder))

    def handle(batch, batch_id):
        return batch.withColumn("handler_failed", F.col("handler_failed") | (F.col("x_retries") > 5))

    writer = running.stream_handler(stream, handle, f"{home}/filed", as_of(), F.lit("handler failed"))
    running.run_available(spark, writer, f"{home}/checkpoint")
    filed = spark.read.parquet(f"{home}/filed").select("message_id", "outcome", "next_retries", "next_key")
    return numbered(filed, "next_retries")


@query
def retry_policy(spark, folder):
    failed = views.messages(spark, folder).where("handler_failed")
    return fail.retry_policy(failed).select("message_id", "queue_type", "outcome", "next_retries", "expires_at", "next_key")


def _split(spark, folder):
    return fail.split_outcomes(views.messages(spark, folder), as_of(), F.lit("handler failed"))


@query
def split_outcomes(spark, folder):
    judged = _split(spark, folder).select(
        "message_id", "outcome", "next_retries", "expires_at", "next_key", "x_death_reason", "x_death_at",
        "x_original_routing_key", "x_first_death_queue", "x_death_count",
    )
    return numbered(judged, "next_retries", "x_death_count")


@query
def requeue(spark, folder):
    columns = ["message_id", "correlation_id", "queue_type", "routing_key", "priority", "x_retries"]
    return fail.requeue(_split(spark, folder), columns, F.lit("handler failed"), as_of())


@query
def outcome_counts(spark, folder):
    return _split(spark, folder).groupBy("queue_type", "outcome").agg(F.count(F.lit(1)).alias("messages"))


@query
def expire_messages(spark, folder):
    return fail.expire_messages(views.messages(spark, folder)).select(
        "message_id", "queue_type", "fate", "expired_key", "expired_exchange"
    )


def _nothing(batch, batch_id):
    """A sink for streams of which only the state is wanted."""
    batch.write.format("noop").mode("overwrite").save()


def _status_state(spark, log):
    home = work_folder(spark, "job-status")
    folded = job_streams.job_status_stream(log)
    running.run_available(spark, running.each_batch(folded, _nothing, "update"), f"{home}/checkpoint")
    return job_streams.status_from_state(spark, f"{home}/checkpoint")


@query
def job_status_stream(spark, folder):
    return _status_state(spark, views.job_log_of(_events_stream(spark, folder)))


HORIZON = "40 days"


def _closing_events_stream(spark, folder):
    """The events as a stream whose last file is one row from a far later time, which moves the watermark past all others."""
    path = work_folder(spark, "closing-events")
    events = col.table(spark, folder, "events")
    # One row: the latest event, a year on, of a job of its own.
    beat = events.agg(F.max("ts").alias("ts")).select(
        F.lit(None).cast("bigint").alias("event_id"), (F.col("ts") + F.make_dt_interval(days=F.lit(365))).alias("ts"),
        F.lit(-1).cast("bigint").alias("user_id"), F.lit("error").alias("event_type"))
    files = running.write_source(events.unionByName(beat, allowMissingColumns=True), path, "ts", "event_id")
    return running.stream_scan(spark, path, EVENT, maxFilesPerTrigger=str(files))


@query
def dead_letter_jobs_stream(spark, folder):
    home, events = work_folder(spark, "dead-letter-jobs"), _closing_events_stream(spark, folder)
    letters = _some_unknown(views.messages_of(events).where("queue_type = 'deadletter'"))
    told = job_streams.dead_letter_jobs_stream(
        letters.select("message_id", "correlation_id", "priority", "published_at"), views.job_log_of(events), "1 hour", HORIZON)
    running.run_available(spark, told.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/checkpoint")
    return spark.read.schema(told.schema).parquet(f"{home}/rows").drop("published_at")


@query
def job_progress_stream(spark, folder):
    home = work_folder(spark, "job-progress")
    told = job_streams.job_progress_stream(views.job_log_of(_closing_events_stream(spark, folder)), "1 hour", HORIZON)
    running.run_available(spark, told.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/checkpoint")
    return job_streams.read_progress(spark.read.schema(told.schema).parquet(f"{home}/rows"))


@query
def processing_timeout(spark, folder):
    return jobs.processing_timeout(views.job_log(spark, folder), as_of())


@query
def processing_timeout_stream(spark, folder):
    home, log = work_folder(spark, "processing-timeout"), views.job_log_of(_events_stream(spark, folder))
    late = job_streams.processing_timeout_stream(log, "1 hour")
    running.run_available(spark, late.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/checkpoint")
    return job_streams.read_timeouts(spark.read.schema(late.schema).parquet(f"{home}/rows"), _status_state(spark, log), as_of())


@query
def dead_letter_triage(spark, folder):
    dead = views.messages(spark, folder).where("queue_type = 'deadletter'").withColumn(
        "original_queue", F.when(F.col("message_id") % 3 != 0, "app.processing.queue")
    )
    triaged = fail.dead_letter_triage(dead).select("message_id", "deaths", "origin", "action", "requeue_delay_ms")
    return numbered(triaged, "requeue_delay_ms")


DELIVERIES = 5


def _files_per_delivery(spark, folder):
    """Files that make up one of DELIVERIES micro-batches: each is a task, and holds about as many items however many there are."""
    return running.files_for(col.table(spark, folder, "orders").count(), DELIVERIES)


def _published(spark, folder, home, queue_type, change=lambda body: body):
    """All items as published batch messages, in the folder of their queue, as a stream of several micro-batches."""
    files = _files_per_delivery(spark, folder)
    batches = make_batches(views.items(spark, folder), "item_id", BATCH, "someModel")
    sent = routing.publish_batches(batches, 0, queue_type, 0, as_of()).select("correlation_id", "body", "delivered_queue")
    sent = sent.withColumn("body", change(F.col("body"))).repartition(DELIVERIES * files, "correlation_id")
    send(sent, f"{home}/queues", "r1")
    return running.stream_scan(
        spark, queue_folder(f"{home}/queues", routing.ROUTES[queue_type][1]), MESSAGE, maxFilesPerTrigger=str(files))


def _some_broken(body):
    """Ids that end in 7 are no numbers, and names of items whose id ends in 3 are missing."""
    return F.regexp_replace(F.regexp_replace(
        body, '"item_id":([0-9]*7),', '"item_id":"x$1",'), '"item_id":([0-9]*3),"name":"[^"]*"', '"item_id":$1,"name":null')


@query
def archive_stream(spark, folder):
    home = work_folder(spark, "archive-stream")
    writer = consumers.archive_stream(_published(spark, folder, home, "archive"), ITEM, f"{home}/archive", "r1", as_of())
    running.run_available(spark, writer, f"{home}/checkpoint")
    rows = consumers.read_archive(spark, f"{home}/archive")
    return rows.select("original_id", "status", "archive_batch", "archived_at", "archived_by", "original_updated_at")


@query
def archive_stream_once(spark, folder):
    """All batches are sent twice, the second time in later micro-batches: every original is archived once."""
    home = work_folder(spark, "archive-once")
    stream = _published(spark, folder, home, "archive")
    queue = queue_folder(f"{home}/queues", routing.ROUTES["archive"][1])
    again = spark.read.schema(MESSAGE).parquet(queue).withColumn("delivered_queue", F.lit(routing.ROUTES["archive"][1]))
    send(again.repartition(DELIVERIES * _files_per_delivery(spark, folder), "correlation_id"), f"{home}/queues", "r2")
    rows = consumers.archive_once(stream, ITEM, as_of(), "1 day")
    running.run_available(spark, rows.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/checkpoint")
    kept = spark.read.schema(rows.schema).parquet(f"{home}/rows")
    return kept.select("original_id", "status", "archive_batch", "archived_at", "archived_by", "original_updated_at")


def _archived_in_part(spark, folder):
    home = work_folder(spark, "archive-errors")
    stream = _published(spark, folder, home, "archive", _some_broken)
    running.run_available(spark, consumers.archive_stream(stream, ITEM, f"{home}/archive", "r1", as_of()), f"{home}/checkpoint")
    return f"{home}/archive"


@query
def archive_stream_errors(spark, folder):
    """What broken items became: refused ones by batch and reason, and those archived."""
    path = _archived_in_part(spark, folder)
    refused = spark.read.parquet(f"{path}/errors").groupBy("correlation_id", "error").agg(F.count("*").alias("items"))
    kept = consumers.read_archive(spark, path).groupBy(F.col("archive_batch").alias("correlation_id")).agg(
        F.lit("archived").alias("error"), F.count("*").alias("items"))
    return refused.unionByName(kept)


def _updated(spark, folder, queue_type):
    home = work_folder(spark, "bulk-update")
    stream = _published(spark, folder, home, queue_type)
    writer = consumers.bulk_update_stream(stream, ITEM, f"{home}/log", as_of(), queue_type)
    running.run_available(spark, writer, f"{home}/checkpoint")
    return f"{home}/log"


@query
def bulk_update_stream(spark, folder):
    return _shown(consumers.apply_updates(spark, views.items(spark, folder), _updated(spark, folder, "processing")).target)


@query
def bulk_update_stream_jobs(spark, folder):
    log = spark.read.parquet(f"{_updated(spark, folder, 'processing')}/jobs")
    return numbered(log.select("correlation_id", "status", "progress", "processed_items", "message"), "processed_items")


@query
def bulk_update_stream_priority(spark, folder):
    """The priority queue's consumer, and the state of its jobs at the end."""
    log = spark.read.parquet(f"{_updated(spark, folder, 'priority')}/jobs")
    current = jobs.latest_state(log, "correlation_id", ["event_ts", "seq"])
    return current.select("correlation_id", "status", "progress", "processed_items", "message", "processed_by")


@query
def throughput(spark, folder):
    return monitoring.throughput(views.messages(spark, folder), "1 hour")


@query
def throughput_stream(spark, folder):
    home = work_folder(spark, "throughput")
    counted = job_streams.throughput_stream(views.messages_of(_events_stream(spark, folder)), "1 day", "1 hour")
    running.run_available(spark, job_streams.status_log(counted, f"{home}/log"), f"{home}/checkpoint")
    return job_streams.read_throughput(spark.read.option("basePath", f"{home}/log").parquet(f"{home}/log"))


LATE_SLICES = 4


@query
def throughput_late(spark, folder):
    """Daily counts of a stream in which three of four slices of the events come late, with what the watermark leaves out."""
    home = work_folder(spark, "throughput-late")
    slice_of = F.coalesce(F.pmod("event_id", F.lit(LATE_SLICES)), F.lit(0)).cast("int")
    running.write_slices(col.table(spark, folder, "events"), f"{home}/events", slice_of, LATE_SLICES)
    stream = views.messages_of(running.stream_scan(spark, f"{home}/events", EVENT, maxFilesPerTrigger="1"))
    writer = job_streams.throughput_with_late(stream, "1 day", 10 * 86_400_000, home)
    running.run_available(spark, writer, f"{home}/checkpoint")
    return job_streams.read_throughput_with_late(spark, home)


LOGGED = (("processing", "ProcessingConsumer"), ("priority", "PriorityConsumer"), ("archive", "ArchiveConsumer"))


@query
def stream_activity(spark, folder):
    """What the consumers of three queues tell of themselves while they run: messages and errors are those of the input."""
    home, log = work_folder(spark, "activity"), None
    files = running.write_source(col.table(spark, folder, "events"), f"{home}/events", "ts", "event_id")
    for number, (queue, consumer) in enumerate(LOGGED):
        source = running.stream_scan(spark, f"{home}/events", EVENT, maxFilesPerTrigger=str(files))
        stream = act.observed(views.messages_of(source).where(F.col("queue_type") == queue), F.col("handler_failed"))
        rows = act.run_logged(spark, running.each_batch(stream, _nothing), f"{home}/{queue}", number, consumer)
        log = rows if log is None else log.unionByName(rows)
    latency = monitoring.batch_latency(log).select("consumer_type", (F.col("mean_ms") <= F.col("max_ms")).alias("timed"))
    ended = log.groupBy("consumer_type").agg(F.max_by("type", "seq").alias("last"))
    return act.activity(log).join(latency, "consumer_type").join(ended, "consumer_type").select(
        "worker_no", "consumer_type", "messages", "errors", "timed", "last")


@query
def processing_timeout_priority(spark, folder):
    return jobs.processing_timeout(views.job_log(spark, folder), as_of(), queue_type="priority").select("correlation_id", "seq", "message")


@query
def make_batches_text_key(spark, folder):
    """Batches of pages by a long text key that begins alike in all rows."""
    pages = col.table(spark, folder, "pages").select(F.concat("url", F.lit("#"), "page_id").alias("page"), "page_id")
    batches = make_batches(pages, "page", BATCH, "pages")
    return batches.select("batch_id", F.size("data").cast("bigint").alias("items"), F.get("data", F.lit(0))["page"].alias("first_page"))


# ---- Flows ---------------------------------------------------------------------------------------


@query
def archive_flow(spark, folder):
    path = work_folder(spark, "archive-flow")
    _, found = flows.archive_flow(views.items(spark, folder), BATCH, "someModel", path, "run-1", as_of())
    return found.per_batch


@query
def archive_flow_missing(spark, folder):
    path = work_folder(spark, "archive-flow")
    _, found = flows.archive_flow(views.items(spark, folder), BATCH, "someModel", path, "run-1", as_of())
    return found.missing.select("item_id")


@query
def bulk_update_flow(spark, folder):
    done = flows.bulk_update_flow(
        views.items(spark, folder), {"status": {"$in": ["pending", "failed"]}}, BATCH, "someModel", 7,
        work_folder(spark, "bulk-update-flow"), as_of(),
    )
    return _shown(done.target)


@query
def bulk_update_flow_stats(spark, folder):
    done = flows.bulk_update_flow(
        views.items(spark, folder), {"status": {"$in": ["pending", "failed"]}}, BATCH, "someModel", 7,
        work_folder(spark, "bulk-update-flow"), as_of(),
    )
    return done.stats


def _failures(spark, folder):
    log = views.job_log(spark, folder).select("seq", "correlation_id", "event_ts", "status")
    return flows.failure_flow(_some_unknown(_cut_bodies(views.messages(spark, folder))), log, BODY, as_of())


@query
def failure_flow(spark, folder):
    return _failures(spark, folder).outcomes.groupBy("queue_type", "outcome").agg(F.count(F.lit(1)).alias("messages"))


@query
def failure_flow_triage(spark, folder):
    triaged = _failures(spark, folder).triaged
    shown = triaged.select("message_id", "deaths", "origin", "action", "requeue_delay_ms", "x_death_reason")
    return numbered(shown, "requeue_delay_ms")


@query
def failure_flow_jobs(spark, folder):
    log = _failures(spark, folder).log
    return log.groupBy("correlation_id", "status", "message").agg(F.count(F.lit(1)).alias("entries"))


@query
def status_overview(spark, folder):
    """Count and latest update per status: the smallest end-to-end query."""
    return views.items(spark, folder).where(filter_spec({})).groupBy("status").agg(
        F.count(F.lit(1)).alias("items"), F.max("updated_at").alias("last_updated")
    )
