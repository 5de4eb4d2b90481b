"""Appending valid rows, and snapshots that replace one another."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.validation import Checked, Rule, validate_rows


KEY_RANGES = 64


class Appended(NamedTuple):
    table: DataFrame
    rejected: DataFrame
    inserted: int


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):  # the first run
        return None
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def key_ranges(rows: DataFrame, key: str, ranges: int = KEY_RANGES) -> Column:
    """Whether a value of ``key`` lies in one of the few ranges that hold all those of ``rows``; null values lie in none.

    The ranges follow the rows, so a far value makes a range of its own beside those of the others. Parquet holds the
    condition against the bounds of stored files and row groups before it reads them.
    """
    dealt = rows.select(F.col(key).alias("key")).where("key IS NOT NULL").repartitionByRange(ranges, "key")
    found = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("low"), F.max("key").alias("high"))
    held = rows.schema[key].dataType
    # As text, so that times are not moved by the time zone of the driver.
    told = found if isinstance(held, T.BinaryType) else found.select(F.col("low").cast("string"), F.col("high").cast("string"))
    bounds = [F.col(key).between(F.lit(r.low).cast(held), F.lit(r.high).cast(held)) for r in told.collect()]  # ``ranges`` at most
    return reduce(or_, bounds, F.lit(False))


def _against(checked: Checked, others: DataFrame, rules: Sequence[Rule]) -> Checked:
    """Rows whose key another run has stored go to ``bad``."""
    ok, bad = checked
    for rule in rules:
        taken = others.where(key_ranges(ok, rule.unique[0])).select(*rule.unique).distinct()
        again = ok.join(taken, list(rule.unique), "left_semi").withColumn("reasons", F.array(F.lit(rule.name)))
        ok, bad = ok.join(taken, list(rule.unique), "left_anti"), bad.unionByName(again)
    return Checked(ok, bad)


def append_valid(df: DataFrame, rules: Sequence[Rule], path: str, run_id: str, cluster_by: str | None = None) -> Appended:
    """Append the rows that keep all ``rules``; the others do not stop them and are returned.

    Rows land in ``path/run_id=<run_id>``, which a rerun replaces, so a repeated run adds nothing. What rules call
    unique is compared with the rows of other runs too, of which only files that may hold the new keys are read: runs of
    ascending keys lie apart by themselves; others do if ``cluster_by`` names the key, by which files are then ranges,
    at the cost of one shuffle of the new rows.
    """
    whole = T.StructType([*df.schema.fields, T.StructField("run_id", T.StringType())])
    checked = validate_rows(df, rules)
    others = _stored(df.sparkSession, path, whole)
    if others is not None:
        checked = _against(checked, others.where(F.col("run_id") != run_id), [r for r in rules if r.unique])
    seen = Observation("inserted")
    rows = checked.ok
    if cluster_by is not None:
        rows = rows.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    # Behind the shuffle: finding the ranges reads the rows once more, which must not count.
    counted = rows.observe(seen, F.count(F.lit(1)).alias("inserted"))
    counted.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
    stored = df.sparkSession.read.schema(whole).option("basePath", path).parquet(path)
    return Appended(stored, checked.bad, seen.get["inserted"])


def send(messages: DataFrame, root: str, run_id: str, queue: str = "delivered_queue") -> None:
    """Put messages into one folder per queue, where a stream of that queue finds them.

    Sending a run again replaces nothing and adds files, as a broker would; consumers recognise repeats.
    """
    messages.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy(queue).parquet(root)


def queue_folder(root: str, name: str, queue: str = "delivered_queue") -> str:
    return f"{root}/{queue}={name}"


def write_snapshot(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write version ``version`` of a table next to the earlier ones, then point readers at it.

    The version being read is never overwritten: readers move once the new one is complete.
    """
    spark = df.sparkSession
    path = f"{root}/data/version={version}"
    df.write.mode("overwrite").parquet(path)
    spark.createDataFrame([(version,)], "version bigint").coalesce(1).write.mode("append").parquet(f"{root}/versions")
    return spark.read.schema(df.schema).parquet(path)


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The latest complete version."""
    latest = spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/data/version={latest}")
