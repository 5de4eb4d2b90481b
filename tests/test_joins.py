"""Joins to one row per key with a hot key, against the plain join; pieces and their sizes."""

import pytest
from pyspark.sql import functions as F

from ferryline.operators import jobs, validation
from ferryline.operators.joins import hot_keys, join_to_one

N, PER_TASK = 9_000, 300


@pytest.fixture(scope="module")
def many(spark):
    """One key has a third of the rows, half of them exact copies; one has no key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (i % 700).cast("string")))
    return spark.range(N, numPartitions=12).select(
        key.alias("key"), F.when(i % 6 == 0, F.lit(0)).otherwise(i).alias("n"), F.create_map(F.lit("a"), i % 2).alias("m")
    )


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(500).select(
        F.when(F.col("id") == 0, "hot").when(F.col("id") == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"),
        F.col("id").alias("v"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_equals_the_plain_join(many, one, how):
    flat = many.withColumn("m", F.col("m")["a"])
    got = join_to_one(flat, one, ["key"], how, PER_TASK)
    wanted = flat.join(one, ["key"], how)
    assert got.columns == wanted.columns
    assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0


def test_only_the_hot_key_is_cut_and_evenly(many, one):
    hot = hot_keys(many, ["key"], PER_TASK)
    assert list(hot) == [many.where("key = 'hot'").select(F.xxhash64("key")).first()[0]]
    (pieces,) = hot.values()
    assert 8 <= pieces <= 16
    joined = join_to_one(many, one, ["key"], "left", PER_TASK)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_piece" in plan
    sizes = [r["count"] for r in _pieces(many, pieces).groupBy("p").count().collect()]
    assert len(sizes) == pieces and max(sizes) <= 2 * (N / 3) / pieces


def _pieces(many, pieces):
    from ferryline.operators.joins import _piece

    return many.where("key = 'hot'").withColumn("p", _piece(many, F.lit(pieces)))


def test_even_keys_are_left_alone(many, one):
    assert hot_keys(many.where("key <> 'hot'"), ["key"], PER_TASK) == {}
    assert hot_keys(many, ["key"]) == {}  # a small table


def test_each_key_gets_its_own_pieces(spark):
    i = F.col("id")
    rows = spark.range(40_000).select(F.when(i % 2 == 0, "a").when(i % 16 == 1, "b").otherwise(i.cast("string")).alias("key"))
    names = {r.h: r.key for r in rows.where("key in ('a', 'b')").select("key", F.xxhash64("key").alias("h")).distinct().collect()}
    found = {names[h]: n for h, n in hot_keys(rows, ["key"], 500).items()}
    assert found["a"] >= 4 * found["b"] >= 8
    assert join_to_one(rows, rows.distinct(), ["key"], "inner", 500).count() == 40_000


def test_definitions_start_no_job(spark, many):
    rows = many.select("key", "n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("defining", "none")
    validation.validate_rows(rows, [validation.unique("key")])
    jobs.job_transition(rows.withColumnRenamed("key", "correlation_id"), rows.withColumnRenamed("key", "correlation_id"))
    assert list(tracker.getJobIdsForGroup("defining")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_operators_with_a_hot_key(spark, many):
    rows = many.select("key", "n")
    small, large = (validation.validate_rows(rows, [validation.unique("key")], size) for size in (PER_TASK, None))
    assert small.bad.exceptAll(large.bad).count() == large.bad.exceptAll(small.bad).count() == 0
    assert small.ok.count() == large.ok.count() and small.bad.where("key = 'hot'").count() == N // 3
    dead = rows.withColumnRenamed("key", "correlation_id")
    state = spark.createDataFrame([("hot", "failed", None), ("k5", "completed", None)], "correlation_id string, status string, event_ts timestamp_ntz")
    got = jobs.dead_letter_jobs(dead, state, PER_TASK)
    assert got.count() == N and got.where("job_status = 'failed'").count() == N // 3
    log = state.select("correlation_id", "status")
    changes = dead.select("correlation_id", F.lit("cancelled").alias("status"))
    told = jobs.job_transition(log, changes, rows_per_task=PER_TASK)
    assert told.where("status = 'cancelled' and correlation_id = 'hot'").count() == N // 3
    assert told.count() == 2 + N // 3 + dead.where("correlation_id = 'k5'").count()
