"""Retries, expiry, triage, job state, archives and monitoring on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ferryline.operators import archive as arc
from ferryline.operators import failures as fail
from ferryline.operators import jobs, monitoring, synth
from ferryline.plans.flows import archive_flow
from ferryline.schemas import CLEAR_CONFIRMATION
from ferryline.session import work_folder
from ferryline.sources import collections as col
from ferryline.sources import views
from ferryline.sources.tables import append_valid, key_ranges, read_snapshot, write_snapshot
from ferryline.operators.validation import Rule, required

FOLDER = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def as_of(text="2024-02-01 00:00:00"):
    return F.lit(text).cast("timestamp_ntz")


def failed(spark, queue, retries):
    return spark.createDataFrame(
        [(1, queue, retries, "k.x", T0)], "message_id int, queue_type string, x_retries int, routing_key string, published_at timestamp_ntz"
    )


@pytest.mark.parametrize("queue,retries,outcome,count,key,delay", [
    ("processing", None, "retry", 1, "k.x", 10),
    ("processing", 2, "retry", 3, "k.x", 10),
    ("processing", 3, "dead_letter", 3, "failed.manual", None),
    ("priority", 4, "retry", 5, "k.x", 5),
    ("priority", 5, "dead_letter", 5, "failed.manual", None),
    ("archive", 0, "retry", 1, "k.x", 15),
    ("archive", 9, "dead_letter", 9, "failed.manual", None),
    ("deadletter", 0, "dropped", 0, None, None),
    ("retry", 0, "dead_letter", 0, "process.retry", None),
    ("unknown", 0, "dropped", 0, None, None),
])
def test_retry_policy(spark, queue, retries, outcome, count, key, delay):
    row = fail.retry_policy(failed(spark, queue, retries)).first()
    assert (row.outcome, row.next_retries, row.next_key) == (outcome, count, key)
    assert row.expires_at == (T0 + dt.timedelta(seconds=delay) if delay else None)


def test_outcomes_partition_the_input(spark):
    messages = views.messages(spark, FOLDER)
    out = fail.split_outcomes(messages, as_of(), F.lit("r"))
    assert out.where(~F.col("outcome").isin("ok", "retry", "dead_letter", "dropped")).count() == 0
    assert out.count() == messages.count() == out.select("message_id").distinct().count()


@pytest.mark.parametrize("queue,ttl,wait,fate,key", [
    ("processing", 100, 100, "waiting", None), ("processing", 100, 101, "dead_letter", "failed.processing"),
    ("archive", 100, 101, "dead_letter", "failed.archive"), ("priority", 100, 101, "dropped", None),
    ("retry", 100, 101, "dead_letter", "process.retry"), ("processing", 0, 10**6, "waiting", None),
    ("processing", None, 5, "waiting", None),
])
def test_expiry(spark, queue, ttl, wait, fate, key):
    row = fail.expire_messages(spark.createDataFrame([(queue, ttl, wait)], "queue_type string, ttl_ms int, wait_ms int")).first()
    assert (row.fate, row.expired_key) == (fate, key)
    assert row.expired_exchange == {"process.retry": "app.topic.exchange"}.get(key, key and "app.deadletter.exchange")


@pytest.mark.parametrize("deaths,action,delay", [
    (None, "requeued", 5_000), (1, "requeued", 5_000), (2, "requeued", 10_000), (3, "manual_review", None),
    (4, "manual_review", None), (5, "permanently_failed", None), (9, "permanently_failed", None),
])
def test_triage(spark, deaths, action, delay):
    row = fail.dead_letter_triage(spark.createDataFrame([(deaths, None)], "death_count int, original_queue string")).first()
    assert (row.action, row.requeue_delay_ms, row.origin, row.deaths) == (action, delay, "unknown", deaths or 1)


def test_attempts_with_a_hot_message(spark):
    rows = spark.range(5_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("m"),
        F.lit(T0).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"),
    )
    out = fail.attempt_number(rows, "m", ["ts", "seq"], "ts", F.lit("e"), F.lit("q"), 3, rows_per_bucket=300)
    hot = out.where("m = 'hot'").orderBy("seq").collect()
    assert [r.attempt for r in hot] == list(range(1, 2_501))
    assert [r.exhausted for r in hot[:5]] == [False, False, False, True, True]
    assert hot[1].retry_headers == {
        "x-retries": "2", "x-original-queue": "q", "x-retry-reason": "e", "x-retry-timestamp": "2024-01-01T00:00:00.000Z"
    }
    assert out.where("m <> 'hot' and attempt <> 1").count() == 0


def test_timeouts(spark):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    log = spark.createDataFrame(
        [("a", 1, at(0), "processing"), ("a", 2, at(299), "completed"),
         ("b", 3, at(0), "processing"), ("b", 4, at(301), "completed"),
         ("f", 10, at(0), "processing"), ("f", 11, at(300), "completed"), ("g", 12, at(480), "processing"),
         ("c", 5, at(0), "processing"), ("d", 6, at(500), "processing"),
         ("e", 7, at(0), "processing"), ("e", 8, at(10), "processing"), ("e", 9, at(400), "failed")],
        "correlation_id string, seq int, event_ts timestamp_ntz, status string",
    )
    late = jobs.processing_timeout(log, as_of("2024-01-01 00:13:00")).collect()
    assert sorted((r.correlation_id, r.seq) for r in late) == [("b", 3), ("c", 5), ("e", 8)]
    assert {r.failed_at - r.started_at for r in late} == {dt.timedelta(minutes=5)}
    spread = jobs.processing_timeout(views.job_log(spark, FOLDER), as_of(), rows_per_bucket=50)
    assert sorted(spread.collect()) == sorted(jobs.processing_timeout(views.job_log(spark, FOLDER), as_of()).collect())


def test_transitions_never_insert_and_the_last_one_wins(spark):
    log = spark.createDataFrame([("a", 1, T0, "pending")], "correlation_id string, seq int, event_ts timestamp_ntz, status string")
    later = T0 + dt.timedelta(hours=1)
    changes = spark.createDataFrame([("a", 2, later, "processing"), ("a", 3, later, "completed"), ("x", 4, later, "failed")], log.schema)
    state = jobs.latest_state(jobs.job_transition(log, changes), "correlation_id", ["event_ts", "seq"])
    assert [tuple(r) for r in state.collect()] == [("a", 3, later, "completed")]


def test_change_rows(spark):
    units = spark.createDataFrame(
        [("a", "processing", "priority", 5, None, None), ("a", "completed", "priority", 5, None, None),
         ("b", "failed", "processing", 3, None, "boom"), ("c", "dead_letter_completed", "deadletter", 2, 4, None)],
        "correlation_id string, status string, queue_type string, items int, deaths int, error string",
    )
    rows = jobs.job_changes(units, as_of()).collect()
    assert [r.message for r in rows] == [
        "Processing 5 high-priority items in worker thread", "Successfully processed 5 high-priority items in worker thread",
        "Processing failed in worker thread: boom", "Dead letter processing completed for 2 items (deaths: 4)",
    ]
    assert [(r.progress, r.processed_items, r.error) for r in rows] == [(None, None, None), (100.0, 5, None), (None, None, "boom"), (100.0, 2, None)]
    assert [(r.start_time is None, r.end_time is None) for r in rows] == [(False, True), (True, False), (True, False), (True, False)]


def test_progress_of_a_parent_without_items(spark):
    log = spark.createDataFrame(
        [("a", "p", 1, T0, "pending", 0, 0), ("b", "q", 2, T0, "completed", 4, 9)],
        "correlation_id string, parent_job_id string, seq int, event_ts timestamp_ntz, status string, total_items int, processed_items int",
    )
    assert {r.parent_job_id: r.progress for r in jobs.job_progress(log).collect()} == {"p": 0.0, "q": 100.0}


def test_health(spark):
    def verdict(*types):
        rows = [(i, t, T0, i) for i, t in enumerate(types)]
        return monitoring.worker_health(spark.createDataFrame(rows, "worker_no int, type string, event_ts timestamp_ntz, seq int")).first()

    fine = verdict("ready", "messageProcessed", "exit")
    assert (fine.status, fine.healthy_workers, fine.unhealthy_workers, fine.other_workers) == ("healthy", 2, 0, 1)
    assert verdict("ready", "crash").status == "unhealthy"
    assert verdict("error").unhealthy_workers == 1


def test_rates_without_duration_or_work(spark):
    log = spark.createDataFrame([("r", 10, T0), ("s", 5, T0), ("s", 5, T0 + dt.timedelta(seconds=4))], "run_id string, row_count int, logged_at timestamp_ntz")
    assert {r.run_id: r.rows_per_second for r in monitoring.run_summary(log).collect()} == {"r": None, "s": 3}
    idle = spark.createDataFrame([(1, "c", "ready", T0)], "worker_no int, consumer_type string, type string, event_ts timestamp_ntz")
    assert monitoring.processing_rate(idle, as_of()).first().rate == 0
    counters = monitoring.worker_counters(spark.createDataFrame([("exit",), ("exit",), ("ready",)], "type string")).first()
    assert tuple(counters) == (1, 0, 1)


def test_queue_depth_of_one_queue(spark):
    messages = spark.createDataFrame([("a",), ("a",), ("b",)], "queue_type string")
    assert [tuple(r) for r in monitoring.queue_depth(messages, "a").collect()] == [("a", 2, 0)]
    assert {r.queue_type: r.messages for r in monitoring.queue_depth(messages, known=["a", "c"]).collect()} == {
        "a": 2, "b": 1, "c": 0, "total": 3}
    assert [tuple(r) for r in monitoring.queue_depth(messages, "c").collect()] == [("c", 0, 0)]


def test_archive_flow_leaves_nothing_out_and_can_be_repeated(spark):
    items, path = views.items(spark, FOLDER), work_folder(spark, "flow")
    stored, found = archive_flow(items, 70, "someModel", path, "r1", as_of())
    assert found.missing.count() == 0 and found.present.count() == items.count()
    assert stored.where("archive_batch is null or original_id is null").count() == 0
    again, _ = archive_flow(items, 70, "someModel", path, "r1", as_of())
    assert again.count() == items.count()
    other, _ = archive_flow(items, 70, "someModel", path, "r2", as_of())
    assert other.count() == 2 * items.count()
    assert arc.delete_archived(items, other).count() == items.count()  # off unless asked for
    assert arc.delete_archived(items, other, enabled=True).count() == 0


def test_append_reports_both_kinds(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, name string")
    path = work_folder(spark, "append")
    done = append_valid(rows, required("name"), path, "r")
    assert done.inserted == 2 and done.rejected.count() == 1 and done.table.count() == 2
    assert append_valid(rows, required("name"), path, "r").table.count() == 2


def test_snapshots_replace_one_another(spark):
    root = work_folder(spark, "snapshot")
    first = write_snapshot(spark.range(5), root, 1)
    second = write_snapshot(first.where("id > 2"), root, 2)
    assert second.count() == 2 and first.count() == 5
    assert read_snapshot(spark, root).count() == 2


def test_clearing_needs_the_confirmation(spark):
    path = work_folder(spark, "clear")
    spark.range(7).write.parquet(path)
    with pytest.raises(ValueError):
        col.clear_tables(spark, {"t": path}, "yes")
    assert spark.read.parquet(path).count() == 7
    report = col.clear_tables(spark, {"t": path, "system.users": "/nowhere"}, CLEAR_CONFIRMATION)
    assert {r.table_name: r.rows_removed for r in report.collect()} == {"t": 7, "total": 7}
    emptied = spark.read.parquet(path)
    assert emptied.count() == 0 and emptied.columns == ["id"]


def test_declared_schemas_are_those_of_the_files(spark):
    for name in col.COLLECTIONS:
        inferred = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        declared = col.table(spark, FOLDER, name)
        assert declared.dtypes == inferred.dtypes, name
        assert declared.count() == inferred.count()


def test_unknown_collections_are_refused(spark):
    with pytest.raises(ValueError):
        col.scan_collection(spark, FOLDER, "nothing")


def test_generated_rows_are_stable_and_valid(spark):
    items = synth.synth_items(spark, 500, 7, as_of())
    assert sorted(items.collect()) == sorted(synth.synth_items(spark, 500, 7, as_of()).collect())
    assert items.select("status").distinct().count() == 4 and items.select("category").distinct().count() == 5
    assert items.where("version not between 1 and 10 or created_at > updated_at").count() == 0
    made = synth.synth_jobs(spark, 500, 7, as_of())
    assert made.where("(completed_at is null) <> (status in ('pending', 'processing'))").count() == 0
    assert made.where("(error is null) <> (status <> 'failed')").count() == 0
    assert made.where("length(correlation_id) < 10").count() == 0


def test_stored_keys_are_read_by_range(spark, tmp_path):
    """Runs of other keys are skipped, a far key opens no range to itself, and repeated keys of any run are still found."""
    rules, path = [Rule("key is taken", unique=("at",))], f"{tmp_path}/keyed"
    rows = lambda low, high: spark.range(low, high).select(
        (F.lit("2024-03-31 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("at"), "id")
    for run in range(3):
        done = append_valid(rows(run * 1000, run * 1000 + 1000), rules, path, f"r{run}", cluster_by="at")
        assert done.inserted == 1000 and done.rejected.count() == 0
    new = rows(2990, 3010).unionByName(rows(0, 1)).unionByName(spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("at"), "id"))
    asked = spark.read.parquet(path).where(key_ranges(new, "at"))
    assert asked.count() == 11
    done = append_valid(new, rules, path, "r3")
    assert sorted(r.id for r in done.rejected.collect()) == [0, *range(2990, 3000)]
    assert done.inserted == 11 and done.table.count() == 3011


def test_key_ranges_of_no_rows(spark):
    assert spark.range(5).where(key_ranges(spark.range(0), "id")).count() == 0
    far = spark.range(10).unionByName(spark.range(10**9, 10**9 + 1))
    assert spark.range(0, 10**6, 1000).where(key_ranges(far, "id")).count() == 1
