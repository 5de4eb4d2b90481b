"""Streams over several micro-batches equal the batch result on the same rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.batching import make_batches
from ferryline.operators.jobs import latest_state
from ferryline.operators.monitoring import throughput
from ferryline.operators.routing import publish_batches
from ferryline.operators.updates import TRANSITION_COLUMNS, keyed_update, status_transition
from ferryline.plans import registry
from ferryline.plans.registry import MESSAGE
from ferryline.schemas import EVENT, ITEM
from ferryline.session import work_folder
from ferryline.sources import views
from ferryline.sources.collections import table
from ferryline.streaming import consumers, running
from ferryline.streaming import jobs as job_streams

FOLDER = "/root/testdata/sf0.001"
SLICES = 4


def as_of():
    return F.lit("2024-02-01").cast("timestamp_ntz")


@pytest.fixture(scope="module")
def slices(spark):
    """The events in time order, one file per slice and micro-batch."""
    path = work_folder(spark, "slices")
    events = table(spark, FOLDER, "events")
    for k in range(SLICES):
        part = events.where((F.col("event_id") >= k * 250) & (F.col("event_id") < (k + 1) * 250))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path, schema=EVENT):
    return running.stream_scan(spark, path, schema, maxFilesPerTrigger="1")


def test_status_stream_equals_the_fold(spark, slices):
    home = work_folder(spark, "status")
    folded = job_streams.job_status_stream(views.job_log_of(stream(spark, slices)))
    running.run_available(spark, job_streams.status_log(folded, f"{home}/log"), f"{home}/check")
    log = spark.read.option("basePath", f"{home}/log").parquet(f"{home}/log")
    assert log.select("batch_id").distinct().count() >= SLICES
    wanted = latest_state(views.job_log(spark, FOLDER), "correlation_id", ["event_ts", "seq"])
    wanted = wanted.select("correlation_id", "event_ts", "seq", "status")
    assert sorted(job_streams.read_status(log).collect()) == sorted(wanted.collect())


def test_throughput_stream_equals_all_windows(spark, slices):
    home = work_folder(spark, "rate")
    counted = job_streams.throughput_stream(views.messages_of(stream(spark, slices)), "1 day", "1 hour")
    running.run_available(spark, job_streams.status_log(counted, f"{home}/log"), f"{home}/check")
    got = job_streams.read_throughput(spark.read.option("basePath", f"{home}/log").parquet(f"{home}/log"))
    wanted = throughput(views.messages(spark, FOLDER), "1 day").select(*got.columns)
    assert sorted(got.collect()) == sorted(wanted.collect()) and got.count() > 100


def test_timeout_at_exactly_the_limit(spark):
    """A change at the limit is in time in both forms, one a microsecond later is not."""
    from ferryline.operators.jobs import processing_timeout

    home = work_folder(spark, "limit")
    schema = "correlation_id string, seq bigint, event_ts timestamp_ntz, status string"
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    offsets = [("a", 0, "processing"), ("a", 300, "completed"), ("b", 0, "processing"), ("b", 299, "completed"),
               ("c", 0, "processing"), ("c", 299, "processing"), ("c", 500, "failed"), ("d", 1, "processing"), ("e", 0, "processing"), ("e", 300.000001, "completed"), ("z", 9_000, "pending")]
    rows = spark.createDataFrame([(j, i, float(o), s) for i, (j, o, s) in enumerate(offsets)], "correlation_id string, seq bigint, o double, status string")
    log = rows.withColumn("event_ts", base + F.make_dt_interval(secs=F.col("o").cast("decimal(18,6)"))).select("correlation_id", "seq", "event_ts", "status")
    log.coalesce(1).write.parquet(f"{home}/in")
    late = job_streams.processing_timeout_stream(stream(spark, f"{home}/in", T._parse_datatype_string(schema)), "1 minute")
    running.run_available(spark, late.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/check")
    streamed = spark.read.schema(late.schema).parquet(f"{home}/rows")
    batch = processing_timeout(log, F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"))
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert sorted(r.correlation_id for r in batch.collect()) == ["d", "e"]


def test_timeout_stream_with_a_busy_job(spark):
    """Half of all entries belong to one job, over several micro-batches."""
    from ferryline.operators.jobs import processing_timeout

    home = work_folder(spark, "busy")
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    log = spark.range(8_000).select(
        F.when(F.col("id") % 2 == 0, "busy").otherwise(F.concat(F.lit("j"), (F.col("id") % 97).cast("string"))).alias("correlation_id"),
        F.col("id").alias("seq"),
        (base + F.make_dt_interval(secs=(F.col("id") * 20 + F.when(F.col("id") % 500 > 480, 400).otherwise(0) * (F.col("id") % 500 - 480)).cast("decimal(18,6)"))).alias("event_ts"),
        F.when(F.col("id") % 3 == 0, "completed").otherwise("processing").alias("status"),
    )
    for k in range(4):
        log.where((F.col("seq") >= k * 2_000) & (F.col("seq") < (k + 1) * 2_000)).coalesce(1).write.mode("append").parquet(f"{home}/in")
    late = job_streams.processing_timeout_stream(stream(spark, f"{home}/in", log.schema), "1 day")
    running.run_available(spark, late.writeStream.format("parquet").option("path", f"{home}/rows"), f"{home}/check")
    last = log.agg(F.max("event_ts")).first()[0]
    closed = processing_timeout(log, F.lit(last), rows_per_bucket=500).where(F.col("failed_at") <= F.lit(last) - F.expr("INTERVAL 1 DAY"))
    assert sorted(spark.read.schema(late.schema).parquet(f"{home}/rows").collect()) == sorted(closed.collect())
    assert closed.where("correlation_id = 'busy'").count() > 0


def test_handler_files_every_message_once(spark, slices):
    home = work_folder(spark, "handler")
    source = views.messages_of(stream(spark, slices))
    seen = []

    def handle(batch, batch_id):
        seen.append(batch_id)
        return batch

    writer = running.stream_handler(source, handle, f"{home}/filed", as_of(), F.lit("e"))
    running.run_available(spark, writer, f"{home}/check")
    filed = spark.read.parquet(f"{home}/filed")
    assert sorted(seen) == list(range(SLICES))
    assert filed.count() == filed.select("message_id").distinct().count() == 1_000
    # A new checkpoint handles the same micro-batches again and replaces their folders.
    running.run_available(spark, running.stream_handler(source, handle, f"{home}/filed", as_of(), F.lit("e")), f"{home}/check2")
    assert spark.read.parquet(f"{home}/filed").count() == 1_000


@pytest.fixture(scope="module")
def published(spark):
    """Batches of all items over several files, the first file twice, and messages no consumer accepts."""
    path = work_folder(spark, "published")
    items = views.items(spark, FOLDER)
    sent = publish_batches(make_batches(items, "item_id", 100, "someModel"), 0, "archive", 0, as_of())
    sent = sent.select("correlation_id", "body")
    number = F.regexp_extract("correlation_id", r"(\d+)$", 1).cast("int")
    for k in (0, 1, 2, 0):
        sent.where(number % 3 == k).coalesce(1).write.mode("append").parquet(path)
    odd = spark.createDataFrame([
        ("empty", '{"batchId": "e", "collection": "someModel", "data": []}'), ("broken", "{"),
        ("foreign", '{"batchId": "f", "collection": "jobStatus", "data": [{"item_id": 1}]}'),
    ], "correlation_id string, body string")
    odd.coalesce(1).write.mode("append").parquet(path)
    return path


def test_archive_stream_keeps_each_item_once(spark, published):
    home = work_folder(spark, "archive")
    items = views.items(spark, FOLDER)
    for check in ("check", "check-again"):
        writer = consumers.archive_stream(stream(spark, published, MESSAGE), ITEM, f"{home}/archive", "r1", as_of())
        running.run_available(spark, writer, f"{home}/{check}")
        rows = consumers.read_archive(spark, f"{home}/archive")
        assert rows.count() == rows.select("original_id").distinct().count() == items.count()
        refused = spark.read.parquet(f"{home}/archive/errors")
        assert {r.correlation_id: r.error for r in refused.collect()} == {
            "empty": "batch must carry a non-empty data array",
            "broken": "batch must carry a non-empty data array",
            "foreign": "unsupported collection",
        }


def test_bulk_update_stream_equals_one_update(spark, published):
    home = work_folder(spark, "bulk")
    items = views.items(spark, FOLDER)
    writer = consumers.bulk_update_stream(stream(spark, published, MESSAGE), ITEM, f"{home}/log", as_of())
    running.run_available(spark, writer, f"{home}/check")
    done = consumers.apply_updates(spark, items, f"{home}/log")
    once = status_transition(items, as_of(), F.lit("x"))
    wanted = keyed_update(items, once, "item_id", TRANSITION_COLUMNS).target.drop("processed_by")
    got = done.target.drop("processed_by").select(*wanted.columns)
    # Item 1 also came in a message of another collection; the update consumer takes any envelope.
    assert got.exceptAll(wanted).where("item_id <> 1").count() == 0 and got.count() == wanted.count()
    log = spark.read.parquet(f"{home}/log/jobs")
    assert sorted(r.correlation_id for r in log.where("status = 'failed'").collect()) == ["broken", "empty"]
    assert log.where("status = 'completed' and progress <> 100").count() == 0


ENVELOPE = '{"batchId": "m_batch_%d", "collection": "someModel", "data": [%s], "metadata": {"batchNumber": %d, "timestamp": "2024-02-01T00:00:00.000Z"}}'
ROW = '{"item_id": %s, "name": "%s", "email": "e", "status": "pending", "created_at": "2024-01-01T00:00:00.000000", ' \
    '"updated_at": "2024-01-01T00:00:00.000000"}'


def sent(spark, bodies, files):
    path = work_folder(spark, "sent")
    for k in range(files):
        rows = [(f"c{i}", b) for i, b in enumerate(bodies) if i * files // len(bodies) == k]
        spark.createDataFrame(rows, "correlation_id string, body string").coalesce(1).write.mode("append").parquet(path)
    return path


def test_no_item_vanishes(spark):
    """Unreadable items, nulls, rows without a name and repeated ids all show up, as rows or as errors."""
    items = [ROW % ('"x1"', "a"), ROW % ('"x2"', "b"), "null", "5", ROW % (7, "c"), ROW % (7, "c"), ROW % (8, "d"),
             '{"item_id": 9, "email": "e", "status": "pending"}', ROW % ("null", "n")]
    bodies = [" \n\t" + ENVELOPE % (1, ",".join(items), 1), "\n [" + ROW % (1, "bare") + "]"]
    path, home = sent(spark, bodies, 1), work_folder(spark, "nothing-lost")
    writer = consumers.archive_stream(stream(spark, path, MESSAGE), ITEM, f"{home}/a", "r1", as_of())
    running.run_available(spark, writer, f"{home}/check")
    kept = consumers.read_archive(spark, f"{home}/a")
    refused = spark.read.parquet(f"{home}/a/errors").groupBy("error").count().collect()
    assert sorted(r.original_id for r in kept.collect()) == [7, 8]
    assert {r["error"]: r["count"] for r in refused} == {
        "item does not fit its fields": 3, "item must not be null": 1, "original_id is required": 1, "unsupported collection": 1,
        "name is required, original_created_at is required, original_updated_at is required": 1}


@pytest.mark.parametrize("files", [1, 2, 4])
def test_last_sent_update_wins_however_the_stream_is_cut(spark, files):
    bodies = [ENVELOPE % (n, ROW % (1, f"n{n}"), n) for n in (9, 10, 2, 1)]
    path, home = sent(spark, bodies, files), work_folder(spark, "cut")
    known = spark.createDataFrame([("c0",), ("c1",), ("c2",)], "correlation_id string")
    writer = consumers.bulk_update_stream(stream(spark, path, MESSAGE), ITEM, f"{home}/log", as_of(), "priority", known)
    running.run_available(spark, writer, f"{home}/check")
    target = spark.createDataFrame([(1, "pending")], "item_id bigint, status string")
    assert [r.processed_by for r in consumers.apply_updates(spark, target, f"{home}/log").target.collect()] == ["c1"]
    state = latest_state(spark.read.parquet(f"{home}/log/jobs"), "correlation_id", ["event_ts", "seq"]).collect()
    assert sorted((r.correlation_id, r.status) for r in state) == [(f"c{i}", "completed") for i in range(3)]
    archive = consumers.archive_stream(stream(spark, path, MESSAGE), ITEM, f"{home}/a", "r1", as_of())
    running.run_available(spark, archive, f"{home}/check-a")
    assert [r.name for r in consumers.read_archive(spark, f"{home}/a").collect()] == ["n10"]


def test_sources_lose_no_event(spark, tmp_path):
    """Events without a number and with a far one come out of every stream on the events, in several micro-batches."""
    events = table(spark, FOLDER, "events").withColumn("event_id", F.when(F.col("event_id") % 10 == 0, None).when(
        F.col("event_id") == 7, 10**15).otherwise(F.col("event_id")))
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{FOLDER}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    assert registry.stream_scan(spark, str(tmp_path)).count() == registry.stream_handler(spark, str(tmp_path)).count() == 1000
    counted = registry.throughput_stream(spark, str(tmp_path)).agg(F.sum("messages")).first()[0]
    late = registry.throughput_late(spark, str(tmp_path)).agg(F.sum("on_time"), F.sum("late")).first()
    assert counted == sum(late) == 1000 and late[1] > 100
    jobs = registry.job_status_stream(spark, str(tmp_path))
    wanted = latest_state(views.job_log_of(events), "correlation_id", ["event_ts", "seq"]).select(*jobs.columns)
    assert sorted(map(repr, jobs.collect())) == sorted(map(repr, wanted.collect()))


def test_source_files_follow_their_order(spark, tmp_path):
    running.write_source(spark.range(1000).select((999 - F.col("id")).alias("n")), f"{tmp_path}/s", "n", parts=5, rows_per_file=90)
    seen = []
    writer = running.each_batch(stream(spark, f"{tmp_path}/s", "n bigint"), lambda b, i: seen.append(sorted(r.n for r in b.collect())))
    running.run_available(spark, writer, f"{tmp_path}/check")
    assert len(seen) >= 11 and [n for batch in seen for n in batch] == list(range(1000))


def test_more_rows_make_more_files_and_no_more_micro_batches(spark, tmp_path):
    """Micro-batches stay as many, and in order."""
    files = running.write_source(spark.range(1000).select("id"), f"{tmp_path}/s", "id", parts=5, rows_per_file=90)
    seen = []
    source = running.stream_scan(spark, f"{tmp_path}/s", "id bigint", maxFilesPerTrigger=str(files))
    writer = running.each_batch(source, lambda b, i: seen.append(sorted(r.id for r in b.collect())))
    running.run_available(spark, writer, f"{tmp_path}/check")
    assert files == 3 and 4 <= len(seen) <= 5 and [n for batch in seen for n in batch] == list(range(1000))


@pytest.mark.parametrize("queue_type", ["processing", "archive"])
def test_published_messages_of_a_micro_batch_lie_in_several_files(spark, monkeypatch, queue_type):
    """1,500 items: 15 messages in five micro-batches as before, of three files each where a file takes 100 items."""
    monkeypatch.setattr(running, "ROWS_PER_FILE", 100)
    home, seen = work_folder(spark, "several"), []
    source = registry._published(spark, FOLDER, home, queue_type)
    writer = running.each_batch(source, lambda b, i: seen.append([r.correlation_id for r in b.collect()]))
    running.run_available(spark, writer, f"{home}/check")
    stored = spark.read.parquet(f"{home}/queues").select("correlation_id", F.input_file_name().alias("file"))
    assert len(seen) <= registry.DELIVERIES < stored.select("file").distinct().count() <= 15
    assert sorted(c for batch in seen for c in batch) == sorted(r.correlation_id for r in stored.collect())


def test_late_rows_after_a_repeated_batch(spark, tmp_path):
    """A row is late if its window ended by the latest time seen before, less the delay; one without a time has no window."""
    rows = [("2024-01-05", 0), ("2024-01-01", 0), ("2024-01-03", 1), ("2024-01-04", 1), ("2024-01-09", 1), (None, 1), ("2024-01-06", 2)]
    made = spark.createDataFrame(rows, "at string, s int").select(F.col("at").cast("timestamp_ntz").alias("published_at"), F.lit("q").alias("queue_type"), "s")
    running.write_slices(made, f"{tmp_path}/in", F.col("s"), 3)
    source = stream(spark, f"{tmp_path}/in", "published_at timestamp_ntz, queue_type string, s int")
    writer = job_streams.throughput_with_late(source, "1 day", 86_400_000, str(tmp_path))
    running.run_available(spark, writer, f"{tmp_path}/check")
    got = {str(r.window_start)[:10]: (r.on_time, r.late) for r in job_streams.read_throughput_with_late(spark, str(tmp_path)).collect()}
    assert got == {"2024-01-05": (1, 0), "2024-01-01": (1, 0), "2024-01-03": (0, 1), "2024-01-04": (1, 0), "2024-01-09": (1, 0),
                   "2024-01-06": (0, 1)}


def test_state_holds_the_status_of_every_job(spark, slices):
    home = work_folder(spark, "state")
    folded = job_streams.job_status_stream(views.job_log_of(stream(spark, slices)))
    running.run_available(spark, running.each_batch(folded, registry._nothing, "update"), f"{home}/check")
    wanted = latest_state(views.job_log(spark, FOLDER), "correlation_id", ["event_ts", "seq"])
    got = job_streams.status_from_state(spark, f"{home}/check")
    assert sorted(got.collect()) == sorted(wanted.select(*got.columns).collect())


def test_letters_meet_the_state_around_them(spark, tmp_path):
    """Redelivered letters come out once; without a job, or with one beyond the horizon, they come out alone."""
    letters = [(1, "a", 5), (1, "a", 5), (2, "b", 5), (3, None, 6), (4, "c", 7), (9, "end", 400)]
    changes = [("a", 4, 1, "processing"), ("a", 6, 3, "failed"), ("a", 6, 2, "completed"), ("c", 60, 1, "pending"), ("end", 400, 1, "x")]
    at = lambda n: F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col(n))
    spark.createDataFrame(letters, "message_id int, correlation_id string, n int").select(
        "message_id", "correlation_id", at("n").alias("published_at")).coalesce(1).write.parquet(f"{tmp_path}/letters")
    spark.createDataFrame(changes, "correlation_id string, n int, seq int, status string").select(
        "correlation_id", at("n").alias("event_ts"), "seq", "status").coalesce(1).write.parquet(f"{tmp_path}/changes")
    told = job_streams.dead_letter_jobs_stream(
        stream(spark, f"{tmp_path}/letters", "message_id int, correlation_id string, published_at timestamp_ntz"),
        stream(spark, f"{tmp_path}/changes", "correlation_id string, event_ts timestamp_ntz, seq int, status string"), "1 hour", "10 days")
    writer = told.writeStream.format("parquet").option("path", f"{tmp_path}/rows")
    running.run_available(spark, writer, f"{tmp_path}/check")
    got = spark.read.schema(told.schema).parquet(f"{tmp_path}/rows").collect()
    assert sorted((r.message_id, r.job_status) for r in got) == [(1, "failed"), (2, None), (3, None), (4, None)]
