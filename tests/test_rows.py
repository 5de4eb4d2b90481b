"""Filters, rules, defaults, transforms, routing and error classes on literal rows."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from ferryline.functions.errors import mask_credentials
from ferryline.functions.filters import filter_spec, free_field
from ferryline.operators import routing, updates
from ferryline.operators.failures import classify_errors, error_severity
from ferryline.operators.routing import ensure_ids, message_headers, route_message, to_kafka_rows, topic_route
from ferryline.operators.validation import (
    between, count_where, fill_defaults, one_of, required, status_counts, unique, validate_rows, work_set,
)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(1, "pending", 3, ("a",)), (2, "failed", 5, ("b",)), (3, None, None, (None,)), (4, "success", 1, None)],
        "id int, status string, priority int, nested struct<kind: string>",
    )


@pytest.mark.parametrize("spec,ids", [
    ({}, [1, 2, 3, 4]),
    ({"status": "failed"}, [2]),
    ({"status": None}, [3]),
    ({"status": {"$ne": "failed"}}, [1, 3, 4]),
    ({"status": {"$ne": None}}, [1, 2, 4]),
    ({"status": {"$in": ["failed", None]}}, [2, 3]),
    ({"status": {"$in": []}}, []),
    ({"status": {"$nin": ["failed", "success"]}}, [1, 3]),
    ({"status": {"$nin": ["failed", None]}}, [1, 4]),
    ({"priority": {"$gt": 1, "$lte": 3}}, [1]),
    ({"priority": {"$gte": 3}}, [1, 2]),
    ({"priority": {"$lt": 3}}, [4]),
    ({"priority": {"$exists": False}}, [3]),
    ({"priority": {"$exists": True}, "status": "success"}, [4]),
    ({"nested.kind": "b"}, [2]),
    ({"nested.kind": {"$ne": "b"}}, [1, 3, 4]),
    ({"$or": [{"status": "failed"}, {"priority": 1}]}, [2, 4]),
    ({"$and": [{"status": {"$exists": True}}, {"$or": [{"priority": 3}, {"priority": 5}]}]}, [1, 2]),
])
def test_filter_documents(docs, spec, ids):
    assert sorted(r.id for r in docs.where(filter_spec(spec)).collect()) == ids
    assert count_where(docs, spec).first()[0] == len(ids)


@pytest.mark.parametrize("spec", [
    {"status": {"$regex": "x"}}, {"$where": "1"}, {"$nor": [{"a": 1}]}, {"status": {}}, {"$or": []}, {"status": {"a": 1}},
])
def test_other_filters_are_refused(spark, spec):
    with pytest.raises(ValueError):
        filter_spec(spec)


def test_filters_reach_the_scan(spark):
    scan = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    kept = scan.where(filter_spec({"o_orderstatus": "F", "o_totalprice": {"$gte": 5}})).select("o_orderkey")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(" in plan
    assert "o_custkey" not in plan


def test_rules_split_rows_with_all_reasons(spark):
    rows = spark.createDataFrame(
        [(1, "a", "pending", 5), (2, None, "gone", 50), (3, "c", None, None), (4, "d", "failed", 100), (4, "e", "failed", 101), (None, "f", "pending", 0)],
        "id int, name string, status string, progress int",
    )
    rules = [*required("name"), one_of("status", ["pending", "failed"]), between("progress", 0, 100), unique("id")]
    checked = validate_rows(rows, rules)
    assert sorted(r.name for r in checked.ok.collect()) == ["a", "c", "f"]
    assert {(r.id, r.name): r.reasons for r in checked.bad.collect()} == {
        (2, None): ["name is required", "status is not allowed"],
        (4, "d"): ["id is not unique"],
        (4, "e"): ["progress is out of range", "id is not unique"],
    }
    assert checked.ok.columns == rows.columns


def test_a_key_with_very_many_copies_is_found(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    checked = validate_rows(rows, [unique("k")])
    assert checked.bad.count() == 10_000 and checked.ok.count() == 20_000


def test_defaults(spark):
    rows = spark.createDataFrame(
        [(1, None, (None, "x")), (2, "d", ("c", None))], "id int, dep string, f struct<cat: string, more: string>"
    )
    out = fill_defaults(rows, {"dep": "general", "f.cat": "normal", "version": 1}).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, "general", ("normal", "x"), 1), (2, "d", ("c", None), 1)]
    deep = rows.select(F.struct(F.struct(F.lit(None).cast("string").alias("b")).alias("a")).alias("s"))
    assert fill_defaults(deep, {"s.a.b": "z"}).first().s.a.b == "z"


def test_status_counts_and_work_sets(docs):
    assert status_counts(docs).first().asDict() == {
        "total_count": 4, "pending_count": 1, "processing_count": 0, "success_count": 1, "failed_count": 1
    }
    assert [r.id for r in work_set(docs, "retry_failed").collect()] == [2]
    assert sorted(r.id for r in work_set(docs, "process_all").collect()) == [1, 2]
    with pytest.raises(ValueError):
        work_set(docs, "none")


def test_transitions_by_status(spark):
    then = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame(
        [(1, "pending", 2, then), (2, "failed", None, then), (3, "failed", 4, then), (4, "processing", None, then)],
        "item_id int, status string, retry_count int, updated_at timestamp_ntz",
    )
    as_of = F.lit("2024-01-01 00:00:02.345").cast("timestamp_ntz")
    out = {r.item_id: r for r in updates.status_transition(rows, as_of, "batch-001").collect()}
    assert {r.status for r in out.values()} == {"success"}
    assert [out[i].retry_count for i in (1, 2, 3, 4)] == [2, 1, 5, None]
    assert [out[i].last_retry_at is None for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert [out[i].processing_duration_ms for i in (1, 2, 3, 4)] == [None, None, None, 2345]
    assert all(r.processing_completed and r.processed_by == "batch-001" for r in out.values())


def test_durations_do_not_depend_on_the_session_zone(spark):
    from ferryline.functions.derived import elapsed_ms, plus_ms

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.createDataFrame(
            [(dt.datetime(2024, 3, 10, 0, 0), dt.datetime(2024, 3, 10, 5, 0)), (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1, 23, 59, 59, 998_500)),
             (dt.datetime(2020, 2, 28), dt.datetime(2020, 3, 1, 0, 0, 0, 1_999)), (None, dt.datetime(2020, 1, 1))],
            "a timestamp_ntz, b timestamp_ntz",
        )
        out = rows.select(elapsed_ms(F.col("a"), F.col("b")), plus_ms(F.col("a"), F.lit(18_000_000))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in out] == [18_000_000, -1, 172_800_001, None]
    assert out[0][1] == dt.datetime(2024, 3, 10, 5, 0)


def test_keyed_update_sets_only_matches(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id int, x string, y int")
    changes = spark.createDataFrame([(1, None, 9, 1), (3, "old", 8, 1), (3, "c", 3, 2), (7, "z", 7, 1)], "id int, x string, y int, seq int")
    done = updates.keyed_update(target, changes, "id", ["x", "y"], ["seq"])
    assert sorted(map(tuple, done.target.collect())) == [(1, None, 9), (2, "b", 2), (3, "c", 3)]
    assert done.stats.first().asDict() == {"processed": 3, "matched": 2, "modified": 1}
    added = updates.keyed_update(target, changes.select("id", F.lit(True).alias("seen")).distinct(), "id", ["seen"])
    assert sorted((r.id, r.seen) for r in added.target.collect()) == [(1, True), (2, None), (3, True)]


@pytest.mark.parametrize("queue,priority,key,reported,delivered", [
    ("processing", 5, "process.bulkUpdate", "app.processing.queue", "app.processing.queue"),
    ("processing", 6, "priority.bulkUpdate", "app.processing.queue", "app.priority.queue"),
    ("priority", 0, "priority.bulkUpdate", "app.priority.queue", "app.priority.queue"),
    ("archive", 0, "archive.bulkMigration", "app.archive.queue", "app.archive.queue"),
    ("archive", 10, "priority.bulkMigration", "app.archive.queue", "app.priority.queue"),
    ("deadletter", 0, "process.bulkUpdate", "app.processing.queue", "app.processing.queue"),
    (None, 0, "process.bulkUpdate", "app.processing.queue", "app.processing.queue"),
])
def test_routes(spark, queue, priority, key, reported, delivered):
    row = spark.createDataFrame([(queue, priority)], "queue_type string, priority int")
    assert tuple(route_message(row).first())[2:] == (key, reported, delivered)


@pytest.mark.parametrize("pattern,hits", [
    ("process.*", {"process.bulkUpdate", "process."}),
    ("*.bulkUpdate", {"process.bulkUpdate", "priority.bulkUpdate"}),
    ("#", {"process.bulkUpdate", "priority.bulkUpdate", "process", "process.a.b", "process.", "", "xprocess.bulkUpdate.y"}),
    ("process.#", {"process.bulkUpdate", "process", "process.a.b", "process."}),
    ("#.bulkUpdate", {"process.bulkUpdate", "priority.bulkUpdate"}),
    ("process.#.b", {"process.a.b"}),
    ("#.#", {"process.bulkUpdate", "priority.bulkUpdate", "process", "process.a.b", "process.", "", "xprocess.bulkUpdate.y"}),
    ("process.#.#", {"process.bulkUpdate", "process", "process.a.b", "process."}),
    ("*.*.*", {"process.a.b", "xprocess.bulkUpdate.y"}),
    ("process", {"process"}),
    ("*", {"process", ""}),
])
def test_topic_patterns(spark, pattern, hits):
    keys = ["process.bulkUpdate", "priority.bulkUpdate", "process", "process.a.b", "process.", "", "xprocess.bulkUpdate.y"]
    rows = spark.createDataFrame([(k,) for k in keys], "routing_key string")
    out = topic_route(rows, [(pattern, "q"), (pattern, "q")]).collect()
    assert len(out) == len(keys)  # one delivery per queue, unroutable messages kept
    assert {r.routing_key for r in out if r.queue == "q"} == hits


def test_headers_and_ids(spark):
    as_of = F.lit("2024-02-01 01:02:03.004").cast("timestamp_ntz")
    rows = spark.createDataFrame([(1, 10, 6, "archive", 0), (2, 5, 5, "processing", 250)], "n int, batch_size int, priority int, queue_type string, delay_ms int")
    one, two = message_headers(rows, as_of).orderBy("n").collect()
    assert one.headers == {
        "batchSize": "10", "source": "queue-service", "timestamp": "2024-02-01T01:02:03.004Z", "priority": "high",
        "queueType": "archive", "x-published-at": "2024-02-01T01:02:03.004Z",
    }
    assert (one.expiration, two.expiration, two.headers["priority"]) == (None, "250", "normal")
    blank = spark.createDataFrame([(1, None, " "), (2, "", "m"), (3, "c", None)], "n int, correlation_id string, message_id string")
    filled = {r.n: r for r in ensure_ids(blank, 1, "n").collect()}
    assert filled[3].correlation_id == "c" and filled[2].message_id == "m"
    made = [filled[1].correlation_id, filled[1].message_id, filled[2].correlation_id, filled[3].message_id]
    assert all(len(m) == 32 for m in made) and len(set(made)) == 4
    kafka = to_kafka_rows(rows.withColumns({
        "headers": F.create_map(F.lit("a"), F.lit("b")), "delivered_queue": F.lit("q"), "correlation_id": F.lit("k"), "body": F.lit("{}"),
    })).first()
    assert (kafka.topic, kafka.key, kafka.value) == ("q", "k", "{}") and bytes(kafka.headers[0].value) == b"b"


def test_error_classes_and_severity(spark):
    texts = {
        "NOT_FOUND - no queue": ("QueueNotFoundError", 404, "client_error"),
        "x does not exist": ("QueueNotFoundError", 404, "client_error"),
        "PRECONDITION_FAILED - inequivalent arg": ("QueueConfigurationError", 409, "client_error"),
        "PRECONDITION_FAILED": ("QueueConfigurationError", 409, "client_error"),
        "Channel closing": ("ConnectionError", 503, "critical"),
        "socket hang up": ("RabbitMQError", 503, "critical"),
    }
    rows = spark.createDataFrame([(t, True) for t in texts], "message string, is_operational boolean")
    out = error_severity(classify_errors(rows)).collect()
    assert {r.message: (r.error_class, r.status_code, r.severity) for r in out} == texts
    assert [r.message for r in out if r.detail] == ["PRECONDITION_FAILED - inequivalent arg"]
    info = spark.createDataFrame([(200, True), (200, False), (499, True), (500, True)], "status_code int, is_operational boolean")
    assert [r.severity for r in error_severity(info).collect()] == ["info", "critical", "client_error", "critical"]


def test_credentials_are_masked_to_the_last_at(spark):
    rows = spark.createDataFrame([("amqp://u:p@ss@host:5672/a",), ("amqp://host",), (None,)], "u string")
    assert [r[0] for r in rows.select(mask_credentials(F.col("u"))).collect()] == ["amqp://***:***@host:5672/a", "amqp://host", None]


def test_bindings_in_a_table(spark):
    """Every kind of pattern against every short key, as the expression form has it."""
    words = ["a", "b", "#", "*", ""]
    patterns = [".".join(p) for n in (1, 2, 3) for p in itertools.product(words, repeat=n)]
    keys = [".".join(k) for n in (1, 2, 3, 4) for k in itertools.product(["a", "b", "", "#", "c:#"], repeat=n)]
    bindings = [(p, f"q{i % 7}") for i, p in enumerate(patterns)]
    sent = spark.createDataFrame([(i, k) for i, k in enumerate([*keys, keys[0], None])], "n int, routing_key string")
    table = spark.createDataFrame([*bindings, bindings[3], (None, "never"), ("never", None)], "pattern string, queue string")
    found = routing.topic_route_table(sent, table)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    got = {(r.n, r.routing_key, r.queue) for r in found.select("n", "routing_key", "queue").collect()}
    assert got == {(r.n, r.routing_key, r.queue) for r in routing.topic_route(sent, bindings).collect()}
    none = routing.topic_route_table(sent, table.limit(0)).collect()
    assert len(none) == len(keys) + 2 and not any(r.queue for r in none)


def test_bindings_made_often_are_walked_once(spark, monkeypatch):
    """No step meets the copies of a binding; each of them used to meet every key that reached its pattern."""
    held, keep = [], routing.checkpointed

    def seen(df):
        held.append(keep(df))
        return held[-1]

    monkeypatch.setattr(routing, "checkpointed", seen)
    table = spark.range(1000).select(F.lit("a.*").alias("pattern"), F.concat(F.lit("q"), F.col("id") % 2).alias("queue"))
    found = routing.topic_route_table(spark.createDataFrame([(1, "a.b"), (2, "b")], "n int, routing_key string"), table)
    assert sorted((r.n, r.queue) for r in found.collect() if r.queue) == [(1, "q0"), (1, "q1")]
    assert [df.count() for df in held if df.columns == ["pattern", "queue"]] == [2]


def test_updates_are_not_broadcast(spark):
    """A file of messages says nothing of how many updates come out of it, so its size must not choose the join."""
    target = spark.createDataFrame([(1, "a"), (2, "b")], "item_id bigint, status string")
    changed = spark.createDataFrame([(2, None), (3, "c")], "item_id bigint, status string")
    done = updates.keyed_update(target, changed, "item_id", ["status"]).target
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted((r.item_id, r.status) for r in done.collect()) == [(1, "a"), (2, None)]


def test_filters_on_free_fields(spark):
    rows = [(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": "one", "b": {"c": null}}'), (3, "{}"), (4, "no json"), (5, None),
            (6, '{"a": 2.5, "b": {"c": "y"}, "d e": true}'), (7, "[1]")]
    held = spark.createDataFrame(rows, "n int, t string").select("n", F.try_parse_json("t").alias("v"))

    def kept(spec):
        return sorted(r.n for r in held.where(filter_spec(spec, free_field("v", ["n"]))).collect())

    assert kept({"a": 1}) == [1] and kept({"a": {"$gt": 0.5}}) == [1, 6] and kept({"b.c": "x", "n": 1}) == [1]
    assert kept({"b.c": {"$ne": "x"}}) == [2, 3, 4, 5, 6, 7] and kept({"b.c": None, "n": {"$lt": 4}}) == [2, 3]
    assert kept({"d e": True}) == [6] and kept({"b.c": {"$exists": True}}) == [1, 6] and kept({"a": {"$in": [1, 7]}}) == [1]
    with pytest.raises(ValueError):
        kept({"a'b": 1})
