"""Batches, pages and sequences: boundaries, round trips and refusals."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.batching import allocate_sequence, make_batches, open_batches, page, unwrap_batches, work_order
from ferryline.operators.routing import publish_batches

ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def as_of():
    return F.lit("2024-02-01").cast("timestamp_ntz")


def table(spark, n):
    """Ids with gaps, far apart, in no order."""
    i = F.col("id")
    return spark.range(n, numPartitions=5).select(
        (i * i * 7 - 10_000).alias("id"), F.md5(i.cast("string")).alias("text")
    ).orderBy(F.xxhash64("id"))


def listed(batches):
    return {b.metadata.batch_number: b for b in batches.collect()}


@pytest.mark.parametrize("key", ["id", "text", ["text", "id"]], ids=str)
@pytest.mark.parametrize("limit", [None, 0, 1, 999, 1_000, 1_001, 5_000])
def test_batches_cover_the_first_rows_in_order(spark, key, limit):
    rows = table(spark, 2_345)
    keys = [key] if isinstance(key, str) else key
    wanted = [tuple(r[k] for k in keys) for r in rows.orderBy(*keys).collect()][: limit or 2_345]
    got = listed(make_batches(rows, key, 100, "c", limit, rows_per_bucket=300))
    count = -(-len(wanted) // 100)
    assert sorted(got) == list(range(1, count + 1))
    for n, batch in got.items():
        assert batch.batch_id == f"c_batch_{n}" and batch.collection == "c"
        assert batch.metadata.total_batches == count
        assert [tuple(r[k] for k in keys) for r in batch.data] == wanted[(n - 1) * 100 : n * 100]
        assert batch.metadata.batch_size == len(batch.data)


@pytest.mark.parametrize("n,size,sizes", [(0, 10, []), (1, 10, [1]), (10, 10, [10]), (11, 10, [10, 1]), (3, 1, [1, 1, 1])])
def test_short_last_batch(spark, n, size, sizes):
    got = listed(make_batches(table(spark, n), "id", size, "c"))
    assert [len(got[k].data) for k in sorted(got)] == sizes


def test_big_keys_and_missing_keys_take_the_general_way(spark):
    rows = spark.range(500).select((F.col("id") + 2**62).alias("id"))
    got = listed(make_batches(rows, "id", 50, "c", rows_per_bucket=60))
    assert [r.id - 2**62 for n in sorted(got) for r in got[n].data] == list(range(500))
    with_null = spark.range(500).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    got = listed(make_batches(with_null, "id", 50, "c", rows_per_bucket=60))
    assert [r.id for n in sorted(got) for r in got[n].data] == [None, *range(1, 500)]


def test_rows_stay_in_one_exchange(spark):
    batches = make_batches(table(spark, 2_000), "id", 100, "c", rows_per_bucket=300)
    plan = batches._jdf.queryExecution().sparkPlan().toString() + batches._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_repeated_keys_are_refused(spark):
    twice = table(spark, 500).union(table(spark, 500))
    with pytest.raises((PySparkException, ValueError), match="does not identify a row"):
        make_batches(twice, "id", 100, "c", rows_per_bucket=120).collect()


@pytest.mark.parametrize("size", [0, -1, 5_001])
def test_batch_size_is_checked(spark, size):
    with pytest.raises(ValueError):
        make_batches(table(spark, 3), "id", size, "c")


def test_negative_limit_is_refused(spark):
    with pytest.raises(ValueError):
        make_batches(table(spark, 3), "id", 1, "c", limit=-1)


def test_unwrap_returns_what_was_batched(spark):
    rows = table(spark, 777)
    sent = publish_batches(make_batches(rows, "id", 50, "c", rows_per_bucket=200), 0, "processing", 0, as_of())
    back = unwrap_batches(sent.select("body"), ROW)
    assert back.errors.count() == 0
    assert sorted(back.items.select("id", "text").collect()) == sorted(rows.collect())


def test_unwrap_accepts_bare_arrays_and_refuses_empty_ones(spark):
    bodies = {
        1: '[{"id": 1, "text": "a"}, {"id": 2, "text": null}]', 2: ' [{"id": 3}]', 3: "[]", 4: "{}", 5: '{"data": []}',
        6: "not json", 7: None, 8: '{"batchId": "b", "collection": "c", "data": [{"id": 9, "text": "z"}]}', 9: '{"data": 5}',
    }
    messages = spark.createDataFrame(list(bodies.items()), "number int, body string")
    back = unwrap_batches(messages, ROW)
    assert sorted((r.number, r.batch_id, r.id, r.text) for r in back.items.collect()) == [
        (1, None, 1, "a"), (1, None, 2, None), (2, None, 3, None), (8, "b", 9, "z")
    ]
    assert sorted(r.number for r in back.errors.collect()) == [3, 4, 5, 6, 7, 9]
    assert all(r.error for r in back.errors.collect())


def test_pages_agree_shallow_and_deep(spark, monkeypatch):
    rows = table(spark, 2_000)
    shallow = page(rows, "id", 500, 100).collect()
    monkeypatch.setattr("ferryline.operators.batching.DEEP_PAGE", 10)
    deep = page(rows, "id", 500, 100, rows_per_bucket=150).collect()
    assert shallow == deep and len(deep) == 100
    assert page(rows, "id", 1_990, 100).count() == 10
    with pytest.raises(ValueError):
        page(rows, "id", -1, 5)


def test_sequences_continue_and_move_on(spark):
    counters = spark.createDataFrame([("a", 40), ("b", 7)], "name string, seq bigint")
    rows = table(spark, 900)
    done = allocate_sequence(rows, counters, "a", "id", rows_per_bucket=100)
    assert [r.seq for r in done.rows.orderBy("id").collect()] == list(range(41, 941))
    assert {r.name: r.seq for r in done.counters.collect()} == {"a": 940, "b": 7}
    fresh = allocate_sequence(rows, counters, "new", "id")
    assert fresh.rows.agg(F.min("seq"), F.max("seq")).first() == (1, 900)
    assert {r.name: r.seq for r in fresh.counters.collect()} == {"a": 40, "b": 7, "new": 900}


@pytest.mark.parametrize("rows_per_bucket", [100, 10**6])
def test_repeated_keys_are_refused_whatever_their_type(spark, rows_per_bucket):
    i = F.when(F.col("id") == 700, 699).otherwise(F.col("id"))
    for key in (i, i + 2**60, F.concat(F.lit("k" * 60), i.cast("string"))):
        rows = spark.range(1_000).select(key.alias("key"))
        with pytest.raises(Exception, match="does not identify a row"):
            make_batches(rows, "key", 10, "c", rows_per_bucket=rows_per_bucket).collect()


def test_work_order(spark):
    items = spark.createDataFrame(
        [(1, "failed", 1), (2, "pending", 9), (3, "success", 0), (4, "processing", 5), (5, "pending", 2), (6, "pending", 2)],
        "item_id long, status string, created_at int",
    )
    assert [r.item_id for r in work_order(items).collect()] == [5, 6, 2, 4, 1]


def test_an_item_does_not_carry_its_message(spark):
    """What is generated per item holds neither the body nor the other items, or work grows with the square of a batch."""
    messages = spark.createDataFrame([("c", "[1]")], "correlation_id string, body string")
    opened = open_batches(messages, T.StructType([T.StructField("item_id", T.LongType())]))
    lines = opened._jdf.queryExecution().executedPlan().toString().splitlines()
    carried = [line.split("[", 1)[1].split("]")[0] for line in lines if "explode" in line and "(_data#" in line]
    assert len(carried) == 1 and not any(name in carried[0] for name in ("_data", "_parsed", "_sound", "body"))
