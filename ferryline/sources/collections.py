"""Named collections: scan, count, clear."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.functions.filters import filter_spec
from ferryline.schemas import CLEAR_CONFIRMATION

# Declared, so that opening a table starts no job to infer its schema.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
COLLECTIONS = tuple(SCHEMAS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name not in SCHEMAS:
        raise ValueError(f"unsupported collection: {name}")
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def scan_collection(
    spark: SparkSession, folder: str, name: str, spec: Mapping | None = None, cols: Sequence[str] | None = None
) -> DataFrame:
    """Read a named collection; filter and projection reach the Parquet scan."""
    rows = table(spark, folder, name).where(filter_spec(spec or {}))
    return rows.select(*cols) if cols else rows


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_inventory(spark: SparkSession, folder: str, names: Sequence[str] = COLLECTIONS) -> DataFrame:
    """Row count of every named table, ``system.*`` left out."""
    counts = [
        table(spark, folder, name).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in names
        if not name.startswith("system.")
    ]
    return _union(counts)


def clear_tables(spark: SparkSession, paths: Mapping[str, str], confirm: str) -> DataFrame:
    """Empty the tables at ``paths`` and report the rows removed, per table and in total.

    The counts are taken before the first table is emptied; each table keeps its schema.
    """
    if confirm != CLEAR_CONFIRMATION:
        raise ValueError(f"clearing needs the confirmation {CLEAR_CONFIRMATION!r}")
    chosen = {name: path for name, path in paths.items() if not name.startswith("system.")}
    frames = {name: spark.read.parquet(path) for name, path in chosen.items()}
    counted = _union([
        frame.agg(F.count(F.lit(1)).alias("rows_removed")).select(F.lit(name).alias("table_name"), "rows_removed")
        for name, frame in frames.items()
    ])
    report = [(row.table_name, row.rows_removed) for row in counted.collect()]  # one row per named table
    for name, path in chosen.items():
        spark.createDataFrame([], frames[name].schema).write.mode("overwrite").parquet(path)
    removed = spark.createDataFrame(report, "table_name string, rows_removed bigint")
    return removed.rollup("table_name").agg(
        F.sum("rows_removed").alias("rows_removed"), F.grouping_id().alias("_level")
    ).select(F.when(F.col("_level") == 1, "total").otherwise(F.col("table_name")).alias("table_name"), "rows_removed")
