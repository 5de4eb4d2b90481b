"""Starting streams: sources, handlers, and running what is available to its end."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ferryline.operators.failures import split_outcomes
from ferryline.schemas import QUEUES

# State is kept on disk by RocksDB, and session windows are merged before the shuffle so that one busy
# key does not travel row by row.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stream_scan(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", **options: str) -> DataFrame:
    """A folder of files as a stream; a unit is done once the checkpoint has committed it.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound what one micro-batch takes in.
    """
    return spark.readStream.schema(schema).format(file_format).options(**options).load(path)


def _in_name_order(spark: SparkSession, path: str) -> None:
    """Give the files of a folder ascending times: a file stream takes the oldest first, and tasks end in any order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((str(s.getPath().getName()), s.getModificationTime(), s.getPath()) for s in files.listStatus(root) if s.isFile())
    found = [(name, at, place) for name, at, place in found if name.startswith("part-")]
    start = min((at for _, at, _ in found), default=0) - 1000 * len(found)
    for number, (_, _, place) in enumerate(found):
        files.setTimes(place, start + 1000 * number, -1)


ROWS_PER_FILE = 50_000


def files_for(rows: int, parts: int, rows_per_file: int | None = None) -> int:
    """Files that each of ``parts`` equal micro-batches of ``rows`` rows is made of; files are what its tasks share out."""
    return max(1, math.ceil(rows / (parts * (rows_per_file or ROWS_PER_FILE))))


def write_source(rows: DataFrame, path: str, *order: str, parts: int = 4, rows_per_file: int | None = None) -> int:
    """Rows as the files of a stream, in the order of ``order``: all rows in one write, nulls first.

    Returns how many files at a time make ``parts`` micro-batches: their number stays, as each costs a round of commits,
    and their files grow in number with the rows. Files hold shares of the rows, not of the values, so that a far value
    moves no other row. Where the store keeps no times of its own, their order is that in which they were written.
    """
    spark = rows.sparkSession
    files = files_for(rows.count(), parts, rows_per_file)
    dealt = rows.repartitionByRange(parts * files, *[F.col(c) for c in order]).sortWithinPartitions(*order)
    dealt.write.parquet(path)
    _in_name_order(spark, path)
    return files


def write_slices(rows: DataFrame, path: str, slice_of: Column, slices: int) -> None:
    """Rows as files of ``slices`` slices, the rows of slice 0 first; ``slice_of`` must give 0 to ``slices`` - 1."""
    rows.repartitionById(slices, slice_of).write.parquet(path)
    _in_name_order(rows.sparkSession, path)


def run_available(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> None:
    """Handle everything there is, in as many micro-batches as the source asks for, then stop."""
    with _settings(spark, STATE_SETTINGS):
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).foreachBatch(handle)


def stream_handler(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], DataFrame],
    sink: str,
    as_of: Column,
    reason: Column,
    policy=QUEUES,
) -> DataStreamWriter:
    """Apply ``handle`` to every micro-batch and file its rows by outcome.

    ``handle`` returns the rows with ``handler_failed``; failed ones go through the retry policy. All
    outcomes are written in one pass, to ``sink/batch_id=<n>/outcome=<outcome>``; a repeated
    micro-batch replaces its own folder, so nothing is filed twice. A sink belongs to one checkpoint.
    """

    def file(batch: DataFrame, batch_id: int) -> None:
        judged = split_outcomes(handle(batch, batch_id), as_of, reason, policy)
        judged.write.mode("overwrite").partitionBy("outcome").parquet(f"{sink}/batch_id={batch_id}")

    return each_batch(stream, file)
