"""Tables in folders: updates equal the plain one and leave untouched folders as they are."""

import os

from pyspark.sql import functions as F

from ferryline.operators.updates import keyed_update
from ferryline.sources.folders import read_folders, update_folders, write_folders


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")}


def test_only_touched_folders_are_written(spark, tmp_path):
    root = str(tmp_path / "t")
    target = spark.range(2_000).select(F.col("id").alias("k"), F.lit("old").alias("s"), (F.col("id") % 7).alias("n"))
    write_folders(target, root, "k", 16)
    before = files(root)
    changes = spark.createDataFrame(
        [(5, "new", 1, 1), (5, "newer", 2, 2), (77, None, 3, 1), (9_999, "none", 4, 1), (6, "old", 6, 1)], "k long, s string, n long, o int")
    done = update_folders(spark, root, str(tmp_path / "staged"), target.schema, changes, "k", ["s", "n"], 16, ["o"])
    wanted = keyed_update(target, changes, "k", ["s", "n"], ["o"])
    assert sorted(done.table.select("k", "s", "n").collect()) == sorted(wanted.target.select("k", "s", "n").collect())
    assert (done.processed, done.matched, done.modified) == tuple(wanted.stats.collect()[0]) == (4, 3, 2)
    after = files(root)
    touched = {os.path.dirname(f) for f in after - before}
    assert 1 <= len(touched) <= 4
    assert {f for f in before if os.path.dirname(f) not in touched} == {f for f in after if os.path.dirname(f) not in touched}


def test_added_columns_and_later_updates(spark, tmp_path):
    root, target = str(tmp_path / "t"), spark.range(100).select(F.col("id").alias("k"))
    write_folders(target, root, "k", 8)
    schema = target.schema
    for key, value in ((2, "a"), (3, "b")):
        changes = spark.createDataFrame([(key, value)], "k long, extra string")
        schema = update_folders(spark, root, f"{tmp_path}/staged{key}", schema, changes, "k", ["extra"], 8).table.schema
    rows = {r.k: r.extra for r in read_folders(spark, root, schema).collect()}
    assert len(rows) == 100 and rows[2] == "a" and rows[3] == "b" and rows[4] is None


def test_empty_table_and_no_update(spark, tmp_path):
    root, none = str(tmp_path / "t"), spark.createDataFrame([], "k long, s string")
    assert write_folders(none, root, "k", 8).count() == 0
    done = update_folders(spark, root, f"{tmp_path}/a", none.schema, spark.createDataFrame([(1, "x")], "k long, s string"), "k", ["s"], 8)
    assert done.table.count() == 0 and (done.processed, done.matched) == (1, 0)
    done = update_folders(spark, root, f"{tmp_path}/b", none.schema, none, "k", ["s"], 8)
    assert done.table.count() == 0 and (done.processed, done.matched) == (0, 0)
