"""Numbered batches, pages and sequences."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.filters import filter_spec
from ferryline.functions.once import computed_once
from ferryline.operators.ranking import EXACT_IN_DOUBLE, MAX_BUCKETS, ROWS_PER_BUCKET, number_rows, order_stats
from ferryline.schemas import MAX_BATCH_SIZE, envelope

DEEP_PAGE = 100_000


def _take(total: int, limit: int | None) -> int:
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    return min(limit, total) if limit else total


def _cut_points(df: DataFrame, key: str, step: int, rows_per_bucket: int, stats: dict) -> list[int]:
    """The keys at positions 1, 1 + step, 1 + 2 * step ...: only the key column is shuffled."""
    keys = df.select(key)
    if stats["rows"] <= rows_per_bucket:
        numbered = keys.withColumn("position", F.row_number().over(Window.orderBy(key)))  # one bucket of bare keys
    else:
        numbered = number_rows(keys, [key], rows_per_bucket=rows_per_bucket, stats=stats)
    starts = numbered.where((F.col("position") - 1) % step == 0).select(key)
    return sorted(row[0] for row in starts.collect())  # at most MAX_BUCKETS keys, see the choice of step


def _batched(rows: DataFrame, groups: list[Column | str], place: str, carried: Sequence[str]) -> DataFrame:
    """Gather rows into one row per batch, ordered by ``place``. A batch has at most ``size`` rows."""
    gathered = F.array_sort(F.collect_list(F.struct(place, F.struct(*carried).alias("row"))))
    return rows.groupBy(*groups).agg(gathered.alias("_rows"))


def make_batches(
    df: DataFrame,
    key: str | Sequence[str],
    size: int,
    collection: str,
    limit: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Number the rows by ``key`` and cut them into batches of ``size``: one row per batch.

    ``key`` is the column, or the columns, that identify a row. With one integer key the rows are
    shuffled once: the exact keys at which every bucket starts are found on the key column alone, and
    they are chosen so that a bucket holds whole batches. Other keys are ranked first, which costs a
    second shuffle.
    """
    if not 1 <= size <= MAX_BATCH_SIZE:
        raise ValueError(f"batch size must be between 1 and {MAX_BATCH_SIZE}")
    keys = [key] if isinstance(key, str) else list(key)
    carried = df.columns
    stats = order_stats(df, keys)
    total = stats["rows"]
    integral = (
        len(keys) == 1
        and isinstance(df.schema[keys[0]].dataType, T.LongType | T.IntegerType | T.ShortType | T.ByteType)
        and stats["present_0"] == total
        and max(abs(stats.get("min_0") or 0), abs(stats.get("max_0") or 0)) < EXACT_IN_DOUBLE
    )
    wanted = _take(total, limit)
    count = math.ceil(wanted / size)

    if integral:
        per_bucket = max(1, min(rows_per_bucket, math.ceil(total / _parallelism(df))) // size)
        per_bucket = max(per_bucket, math.ceil(total / (size * MAX_BUCKETS)))
        step = per_bucket * size
        starts = _cut_points(df, keys[0], step, rows_per_bucket, stats) if total > step else []
        if len(starts) != len(set(starts)):
            raise ValueError(f"{keys[0]} does not identify a row")
        rows = df
        if wanted < total and starts:
            last_start = (wanted - 1) // step
            if last_start + 1 < len(starts):
                rows = rows.where(F.col(keys[0]) < F.lit(starts[last_start + 1]))
        if len(starts) > 1:
            splits = [float("-inf"), *[float(s) for s in starts[1:]], float("inf")]
            cutter = Bucketizer(splits=splits, inputCol="_key", outputCol="_cut")
            rows = cutter.transform(rows.withColumn("_key", F.col(keys[0]).cast("double")))
            rows = rows.withColumn("_cut", F.col("_cut").cast("bigint"))
        else:
            rows = rows.withColumn("_cut", F.lit(0).cast("bigint"))
        along = Window.partitionBy("_cut").orderBy(keys[0])
        repeated = F.lag(keys[0]).over(along) == F.col(keys[0])
        place = F.col("_cut") * step + F.row_number().over(along).cast("bigint")
        rows = rows.withColumn(
            "_place",
            F.when(repeated, F.raise_error(F.lit(f"{keys[0]} does not identify a row")).cast("bigint")).otherwise(place),
        ).where(F.col("_place") <= wanted)
        number = F.floor((F.col("_place") - 1) / size).cast("bigint") + 1
        # The rows already lie by _cut, and a batch never spans two cuts: no further exchange.
        batches = _batched(rows.withColumn("batch_number", number), ["_cut", "batch_number"], "_place", carried)
    else:
        ranked = number_rows(df, keys, out="_place", rows_per_bucket=rows_per_bucket, stats=stats, unique=True)
        rows = ranked.where(F.col("_place") <= wanted)
        number = F.floor((F.col("_place") - 1) / size).cast("bigint") + 1
        batches = _batched(rows.withColumn("batch_number", number), ["batch_number"], "_place", carried)

    return batches.select(
        F.concat(F.lit(f"{collection}_batch_"), F.col("batch_number").cast("string")).alias("batch_id"),
        F.lit(collection).alias("collection"),
        F.transform("_rows", lambda r: r["row"]).alias("data"),
        F.struct(
            F.size("_rows").cast("bigint").alias("batch_size"),
            "batch_number",
            F.lit(count).cast("bigint").alias("total_batches"),
        ).alias("metadata"),
    )


def _parallelism(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


class Unwrapped(NamedTuple):
    items: DataFrame
    errors: DataFrame


TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_CORRUPT = "_corrupt"


def open_batches(messages: DataFrame, item: T.StructType, body: str = "body") -> DataFrame:
    """Message bodies as one row per item, with ``error`` where there is none to work on.

    A body is an envelope or a bare array, with white space around it or not. Items are read one by one: a null, one
    that is no object or one with a field of the wrong type is an error of its own and spoils no other. ``sent_at`` and
    ``batch_number`` tell the order in which batches were sent. An error carries the text it is about in ``body``.
    """
    bare = F.col(body).rlike(r"\A\s*\[")
    wide = T.StructType([*item.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {**TIMES, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # Sound messages are read with typed items in one go; only the others are read item by item.
    sound = envelope(item)
    whole = T.StructType([*sound.fields, T.StructField(_CORRUPT, T.StringType())])
    once = computed_once(messages, "_sound", F.when(~bare, F.from_json(body, whole, options)))
    fits = F.col("_sound").isNotNull() & F.col(f"_sound.{_CORRUPT}").isNull() & F.coalesce(F.size("_sound.data") > 0, F.lit(False))
    fits = fits & ~F.exists("_sound.data", lambda r: r.isNull())
    texts = F.struct(
        F.when(~bare, F.from_json(body, envelope(T.StringType()))).alias("envelope"),
        F.when(bare, F.from_json(body, T.ArrayType(T.StringType()))).alias("bare"),
    )
    opened = computed_once(once.withColumn("_fits", fits), "_parsed", F.when(~F.col("_fits"), texts))
    read = F.struct(*[F.col(f"_sound.{name}").alias(name) for name in ("batchId", "collection", "metadata")])
    slow = F.struct(*[F.col(f"_parsed.envelope.{name}").alias(name) for name in ("batchId", "collection", "metadata")])
    head = F.when(F.col("_fits"), read).otherwise(slow)
    unread = F.lit(None).cast(T.StructType([*wide.fields]))
    items = F.when(F.col("_fits"), F.transform("_sound.data", lambda r: F.struct(
        F.struct(*[r[name].alias(name) for name in item.names], F.lit(None).cast("string").alias(_CORRUPT)).alias("row"),
        F.lit(None).cast("string").alias("text"))))
    by_text = F.transform(F.coalesce("_parsed.envelope.data", "_parsed.bare"), lambda t: F.struct(unread.alias("row"), t.alias("text")))
    opened = opened.withColumns({
        "_data": F.coalesce(items, by_text),
        "batch_id": head["batchId"],
        "collection": head["collection"],
        "sent_at": head["metadata"]["timestamp"],
        "batch_number": head["metadata"]["batchNumber"],
    })
    readable = F.col("_fits") | F.col("_parsed.envelope").isNotNull() | F.col("_parsed.bare").isNotNull()
    empty = ~F.col("_fits") & F.coalesce(F.size(F.coalesce("_parsed.envelope.data", "_parsed.bare")) == 0, F.lit(True))
    told = ("batch_id", "collection", "sent_at", "batch_number")
    kept = [c for c in messages.columns if c not in (body, *told, *item.names)]
    # Settled below the generator: every item of a message carries these, and must not carry the message with its other items.
    messages_read = opened.select(*kept, *told, F.when(empty, F.col(body)).alias("_whole"), empty.alias("_empty"),
                                  readable.alias("_readable"), "_fits", "_data")
    rows = messages_read.select(*[c for c in messages_read.columns if c != "_data"], F.explode_outer("_data").alias("_held"))
    one = F.when(F.col("_fits"), F.col("_held.row")).otherwise(F.from_json("_held.text", wide, options))
    read = computed_once(rows.withColumn("_item", F.col("_held.text")), "_row", one)
    error = (
        F.when(F.col("_empty") & F.col("_readable"), "batch must carry a non-empty data array")
        .when(F.col("_empty"), "batch must be an array or an envelope")
        .when(F.col("_fits"), None)
        .when(F.col("_item").isNull(), "item must not be null")
        .when(F.col("_row").isNull() | F.col(f"_row.{_CORRUPT}").isNotNull(), "item does not fit its fields")
    )
    return read.select(
        *kept, *told, *[F.col(f"_row.{name}").alias(name) for name in item.names],
        F.when(F.col("_empty"), F.col("_whole")).otherwise(F.col("_item")).alias(body), error.alias("error"),
    )


def unwrap_batches(messages: DataFrame, item: T.StructType, body: str = "body") -> Unwrapped:
    """The items of message bodies as rows, and what could not be read, with the reason: see :func:`open_batches`."""
    opened = open_batches(messages, item, body)
    told = ("collection", "sent_at", "batch_number")
    items = opened.where("error IS NULL").drop(body, "error")
    errors = opened.where("error IS NOT NULL").drop(*told, *item.names)
    return Unwrapped(items, errors)


def page(df: DataFrame, key: str, skip: int, n: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows ``skip + 1`` to ``skip + n`` by ``key``, in its order. ``key`` must identify a row.

    Deep pages are ranked instead of carried to one task; the result is the same.
    """
    if skip < 0 or n < 0:
        raise ValueError("skip and n must not be negative")
    if skip + n <= DEEP_PAGE:
        return df.orderBy(key).offset(skip).limit(n)
    ranked = number_rows(df, [key], out="_place", rows_per_bucket=rows_per_bucket)
    return ranked.where(F.col("_place").between(skip + 1, skip + n)).drop("_place").orderBy(key)


class Allocated(NamedTuple):
    rows: DataFrame
    counters: DataFrame


def allocate_sequence(
    df: DataFrame, counters: DataFrame, name: str, key: str | Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> Allocated:
    """Give every row the next number of counter ``name`` (from 1 if it is new), and move the counter on."""
    keys = [key] if isinstance(key, str) else list(key)
    current = counters.where(F.col("name") == name).agg(F.max("seq")).first()[0] or 0
    ranked = number_rows(df, keys, out="_place", rows_per_bucket=rows_per_bucket, unique=True)
    rows = ranked.withColumn("seq", F.col("_place") + F.lit(current)).drop("_place")
    moved = df.agg((F.count(F.lit(1)) + F.lit(current)).alias("seq")).select(F.lit(name).alias("name"), "seq")
    others = counters.where(filter_spec({"name": {"$ne": name}})).select("name", "seq")
    return Allocated(rows, others.unionByName(moved))


# The order in which statuses are worked off.
WORK_RANKS = {"pending": 1, "processing": 2, "failed": 3}


def work_order(items: DataFrame) -> DataFrame:
    """Open items in the order they are worked off: by status, then age."""
    rank = F.coalesce(*[F.when(F.col("status") == status, place) for status, place in WORK_RANKS.items()])
    ranked = items.withColumn("work_rank", rank).where(F.col("work_rank").isNotNull())
    return ranked.orderBy("work_rank", "created_at", "item_id")
