"""Keyed updates of a partitioned Parquet table: only the partitions that an update touches are read and written.

The table is partitioned by ``folder``, a hash of its key. An update is joined with its folders, staged beside the table,
and the staged rows replace those folders by Spark's dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.operators.updates import one_per_key

ROWS_PER_FOLDER = 1_000_000
FILES_PER_FOLDER = 4


class Changed(NamedTuple):
    table: DataFrame
    processed: int
    matched: int
    modified: int


def folders_for(rows: int, least: int = 8) -> int:
    """Into how many folders a table of so many rows is best cut; it stays what it was when the table was written."""
    return max(least, -(-rows // ROWS_PER_FOLDER))


def _folder(key: str, folders: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(folders)).cast("int")


def _dealt(df: DataFrame, key: str, folders: int) -> DataFrame:
    """Rows by folder, a folder cut into several tasks, so that a task's share does not grow with the folder's."""
    placed = df.withColumn("folder", _folder(key, folders))
    piece = F.pmod(F.hash(F.col(key), F.lit("piece")), F.lit(FILES_PER_FOLDER))
    return placed.repartition("folder", piece)


def write_folders(df: DataFrame, path: str, key: str, folders: int) -> DataFrame:
    """Store ``df``, which must have no column ``folder``, as a table of ``folders`` folders by ``key``."""
    _dealt(df, key, folders).write.partitionBy("folder").parquet(path)
    return read_folders(df.sparkSession, path, df.schema)


def read_folders(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table; columns of ``schema`` that came later are null in folders written before."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("folder", T.IntegerType())])).parquet(path).select(*schema.names)


def update_folders(
    spark: SparkSession, path: str, staging: str, schema: T.StructType, updates: DataFrame, key: str, cols: Sequence[str],
    folders: int, order: Sequence[str] = (),
) -> Changed:
    """Set ``cols`` in the rows whose key has an update, never insert, and count on the way.

    ``schema`` is that of the table, ``staging`` a new folder beside it. Only folders with a key of ``updates`` are read,
    joined and written anew; a run that breaks off before the last write has changed nothing, and one that repeats gives
    the same rows.
    """
    last = one_per_key(updates, key, cols, order)
    touched = [r.f for r in last.select(_folder(key, folders).alias("f")).distinct().collect()]  # ``folders`` at most
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField("folder", T.IntegerType())])).parquet(path)
    part = whole.where(F.col("folder").isin(touched)) if touched else whole.limit(0)
    if part.isEmpty():
        return Changed(read_folders(spark, path, schema), last.count(), 0, 0)
    left = part.select(F.col(key).alias("_key"), F.struct(*schema.names).alias("_old"))
    right = last.select(F.col(key).alias("_new_key"), F.struct(*cols).alias("_new"))
    joined = left.join(right, F.col("_key") == F.col("_new_key"), "full_outer")
    hit = F.col("_old").isNotNull() & F.col("_new").isNotNull()
    differs = [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) if c in schema.names else F.col(f"_new.{c}").isNotNull() for c in cols]
    seen = Observation("update")
    counted = joined.observe(
        seen, F.count("_new").alias("processed"), F.count_if(hit).alias("matched"),
        F.count_if(hit & reduce(lambda a, b: a | b, differs, F.lit(False))).alias("modified"))
    kept = [c for c in schema.names if c not in cols]
    old = {c: F.col(f"_old.{c}") if c in schema.names else F.lit(None) for c in cols}
    new = counted.where("_old IS NOT NULL").select(
        *[F.col(f"_old.{c}").alias(c) for c in kept],
        *[F.when(hit, F.col(f"_new.{c}")).otherwise(old[c]).alias(c) for c in cols])
    _dealt(new, key, folders).write.mode("overwrite").partitionBy("folder").parquet(staging)
    staged = read_folders(spark, staging, new.schema)
    _dealt(staged, key, folders).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(path)
    found = seen.get
    return Changed(read_folders(spark, path, new.schema), found["processed"], found["matched"], found["modified"])
