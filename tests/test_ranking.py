"""Exact numbering and neighbours on skewed tables, against a plain one-task window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ferryline.operators.ranking import BUCKET, GROUP, bucketed, number_rows, sort_columns, with_next

N = 6_000
PER_BUCKET = 200


@pytest.fixture(scope="module")
def rows(spark):
    """One group holds half of the rows; one instant and one text hold a third each; some values are missing."""
    i = F.col("id")
    mixed = F.pmod(F.xxhash64("id"), F.lit(1_000_003))
    return spark.range(N, numPartitions=6).select(
        i.alias("seq"),
        F.when(i % 2 == 0, "hot").when(i % 41 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (i % 37).cast("string"))).alias("grp"),
        F.when(i % 3 == 0, 5).when(i % 17 == 0, F.lit(None)).otherwise(mixed % 11).cast("int").alias("prio"),
        (F.when(i % 3 == 1, F.lit("2024-01-05 10:00:00").cast("timestamp_ntz"))
         .otherwise(F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(mixed / 7).cast("decimal(18,6)")))).alias("at"),
        F.when(i % 3 == 2, "prefix-that-many-rows-share-entirely").otherwise(F.concat(F.lit("prefix-"), F.md5(mixed.cast("string")))).alias("text"),
        (mixed * 1_000_003 * 4_000_037 - 4_000_000_000_000_000_000).alias("big"),
        F.when(i % 5 == 0, float("nan")).when(i % 5 == 1, float("inf")).when(i % 5 == 2, -0.0)
        .otherwise(mixed.cast("double") - 500_000).alias("real"),
        (mixed % 400).cast("decimal(12,4)").alias("dec"),
        F.date_add(F.lit("2020-01-01").cast("date"), (mixed % 900).cast("int")).alias("day"),
        (i % 2 == 1).alias("flag"),
    ).cache()


ORDERS = [
    ["seq"], ["-seq"], ["prio", "at", "seq"], ["-prio", "at", "seq"], ["at", "seq"], ["-at", "-seq"], ["text", "seq"],
    ["-text", "seq"], ["big", "seq"], ["-big", "seq"], ["real", "seq"], ["dec", "seq"], ["day", "-seq"],
    ["flag", "prio", "seq"], ["prio", "flag", "-at", "text", "seq"],
]


@pytest.mark.parametrize("partition", [[], ["grp"]], ids=["overall", "per group"])
@pytest.mark.parametrize("order", ORDERS, ids="/".join)
def test_numbers_equal_the_plain_window(rows, order, partition):
    plain = Window.partitionBy(*partition).orderBy(*sort_columns(order))
    wanted = rows.select("seq", F.row_number().over(plain).alias("n")).collect()
    got = number_rows(rows, order, partition, "n", PER_BUCKET).select("seq", "n").collect()
    assert sorted(got) == sorted((r.seq, r.n) for r in wanted)


@pytest.mark.parametrize("order", [["at", "seq"], ["prio", "seq"], ["text", "seq"]], ids="/".join)
def test_next_equals_the_plain_window(rows, order):
    plain = Window.partitionBy("grp").orderBy(*sort_columns(order))
    column = order[0]
    wanted = rows.select("seq", F.lead(column).over(plain).alias("n")).collect()
    got = with_next(rows, column, order, ["grp"], "n", PER_BUCKET).select("seq", "n").collect()
    assert {r.seq: r.n for r in got} == {r.seq: r.n for r in wanted}


@pytest.mark.parametrize("order", ORDERS, ids="/".join)
def test_no_task_gets_a_hot_value(rows, order):
    """The biggest window stays near the bucket size although one value fills a third of the table."""
    cut = bucketed(rows, order, [], PER_BUCKET)
    sizes = [r["count"] for r in cut.frame.groupBy(GROUP, BUCKET).count().collect()]
    assert cut.cut and max(sizes) <= 4 * PER_BUCKET
    assert len(sizes) <= 2 * N // PER_BUCKET


def test_only_large_groups_are_cut(rows):
    cut = bucketed(rows, ["at", "seq"], ["grp"], PER_BUCKET)
    cut_groups = cut.frame.where(F.col(BUCKET) > 0).select("grp").distinct().collect()
    assert [r.grp for r in cut_groups] == ["hot"]
    sizes = [r["count"] for r in cut.frame.groupBy(GROUP, BUCKET).count().collect()]
    assert max(sizes) <= 4 * PER_BUCKET


def test_empty_and_single_row(spark, rows):
    assert number_rows(rows.limit(0), ["seq"], [], "n", 10).count() == 0
    assert [r.n for r in number_rows(rows.where("seq = 7"), ["seq"], [], "n", 10).collect()] == [1]


def test_numbers_do_not_depend_on_the_session_zone(spark, rows):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        day = F.lit("2024-03-10 00:00:00").cast("timestamp_ntz")
        around = rows.select("seq", (day + F.make_dt_interval(secs=(F.col("seq") * 7).cast("decimal(18,6)"))).alias("at"))
        wrong = number_rows(around, ["at"], [], "n", PER_BUCKET).where("n <> seq + 1").count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert wrong == 0
