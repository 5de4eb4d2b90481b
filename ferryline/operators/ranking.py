"""Exact row numbers and neighbours over whole tables, without a one-task window.

``row_number()`` over a global order, or per group when one group holds much of the table, sorts in a
single task. Here the rows of such groups are first cut into buckets of similar size along the order,
so that every window runs over (group, bucket); a small table of rows per (group, bucket) carries the
totals across buckets. Groups of ordinary size keep one window each.

A bounded sample decides which groups are cut, and where. It steers only the balance: whatever it
shows, buckets follow the order and the numbers are exact.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.derived import ntz_micros
from ferryline.functions.once import computed_once

ROWS_PER_BUCKET = 500_000
MAX_BUCKETS = 50_000
ROWS_WORTH_A_TASK = 5_000
SAMPLE_PER_BUCKET = 50
EXACT_IN_DOUBLE = 2**53
FARTHEST = 1.7976931348623157e308  # the largest double
CHUNK = 6  # bytes of a string that fit a double exactly
STRING_CHUNKS = 8

BUCKET = "_bucket"
GROUP = "_group"


def order_name(item: str) -> str:
    """The column of an order item; ``-`` in front of a name means descending."""
    return item[1:] if item.startswith("-") else item


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.col(order_name(o)).desc() if o.startswith("-") else F.col(o).asc() for o in order]


@dataclass(frozen=True)
class Image:
    """A number that never decreases when its order column increases."""

    column: Column
    exact: bool  # equal images mean equal values, so the next order column may refine them


def order_stats(df: DataFrame, order: Sequence[str]) -> dict:
    """Row count, and the ranges that decide the images of the order columns: one narrow scan."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(map(order_name, order)):
        aggregates.append(F.count(name).alias(f"present_{i}"))
        kind = df.schema[name].dataType
        if isinstance(kind, (T.LongType, T.StringType)):
            aggregates += [F.min(name).alias(f"min_{i}"), F.max(name).alias(f"max_{i}")]
        if isinstance(kind, T.StringType):
            aggregates.append(F.max(F.octet_length(name)).alias(f"length_{i}"))
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            aggregates += [F.year(F.min(name)).alias(f"min_{i}"), F.year(F.max(name)).alias(f"max_{i}")]
    return df.agg(*aggregates).first().asDict()


def _images(df: DataFrame, name: str, stats: dict, i: int) -> list[Image]:
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return [Image(c.cast("double"), True)]
    if isinstance(kind, T.LongType):
        reach = max(abs(stats[f"min_{i}"] or 0), abs(stats[f"max_{i}"] or 0))
        if reach < EXACT_IN_DOUBLE:
            return [Image(c.cast("double"), True)]
        return [
            Image(F.shiftright(c, 32).cast("double"), True),
            Image(c.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")).cast("double"), True),
        ]
    if isinstance(kind, T.DateType):
        return [Image(F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double"), True)]
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        # Microseconds fit a double exactly within about 285 years of 1970.
        near = 1700 < (stats[f"min_{i}"] or 1970) and (stats[f"max_{i}"] or 1970) < 2200
        micros = F.unix_micros(c).cast("double") if isinstance(kind, T.TimestampType) else ntz_micros(c)
        return [Image(micros, near)]
    if isinstance(kind, T.BooleanType):
        return [Image(c.cast("int").cast("double"), True)]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        number = c.cast("double")
        inside = F.least(F.lit(FARTHEST), F.greatest(F.lit(-FARTHEST), number))
        beyond = F.when(F.isnan(c), 2.0).when(number > FARTHEST, 1.0).when(number < -FARTHEST, -1.0).otherwise(0.0)
        return [Image(F.when(F.isnan(c), FARTHEST).otherwise(inside), True), Image(F.when(c.isNotNull(), beyond), True)]
    if isinstance(kind, T.DecimalType):
        return [Image(c.cast("double"), kind.precision <= 15)]
    if isinstance(kind, T.StringType):
        low, high = ((stats[f"{end}_{i}"] or "").encode() for end in ("min", "max"))
        shared = len(os.path.commonprefix([low, high]))
        raw = F.encode(c, "UTF-8")
        chunks = []
        for k in range(min(STRING_CHUNKS, max(1, math.ceil(((stats[f"length_{i}"] or 0) - shared) / CHUNK)))):
            digits = F.hex(F.substring(raw, shared + k * CHUNK + 1, CHUNK))
            chunks.append(Image(F.conv(F.rpad(digits, 2 * CHUNK, "0"), 16, 10).cast("double"), True))
        # The length tells apart texts that differ only in trailing zero bytes.
        complete = (stats[f"length_{i}"] or 0) <= shared + STRING_CHUNKS * CHUNK
        return [*chunks, Image(F.octet_length(c).cast("double"), complete)]
    raise TypeError(f"cannot order by {name}: {kind.simpleString()}")


def _levels(df: DataFrame, order: Sequence[str], stats: dict) -> list[Column]:
    """Images of the order columns, first to last, up to the first one that is not exact."""
    levels = []
    for i, item in enumerate(order):
        images = _images(df, order_name(item), stats, i)
        for image in images:
            number = F.coalesce(image.column, F.lit(-FARTHEST))
            # Adding zero turns -0.0 into 0.0, which edges and comparisons would tell apart.
            levels.append((-number if item.startswith("-") else number) + F.lit(0.0))
        if not images[-1].exact:
            break
    return levels


def _numbers(values: np.ndarray, kind: str) -> Column:
    """A literal array. As one text literal, it stays small in the plan however long it is."""
    return F.split(F.lit(",".join(repr(v) for v in values.tolist())), ",").cast(f"array<{kind}>")


@dataclass
class _Step:
    """A stretch of one level, starting at ``value``: the edges before it, and the edges at it."""

    at: float  # where it starts on the Bucketizer's axis
    value: float
    below: int
    here: int
    next: int = -1  # the crowd that tells the edges at ``value`` apart on the next level, if there are several


def _steps(crowds: list[tuple[int, np.ndarray]], level: int, axis: Callable) -> tuple[list[_Step], list]:
    """The steps of one level for every crowd (edges before it, its edges), and the crowds of the next."""
    steps, following = [], []
    for place, (before, edges) in enumerate(crowds):
        steps.append(_Step(axis(place, None), -np.inf, before, 0))
        values, begins, counts = np.unique(edges[:, level], return_index=True, return_counts=True)
        for value, begin, count in zip(values, begins, counts):
            step = _Step(axis(place, value), value, before + int(begin), int(count))
            if count > 1:
                step.next = len(following)
                following.append((step.below, edges[begin : begin + count]))
            steps.append(step)
    return steps, following


def _bucket_column(out: DataFrame, fields: Sequence[str], points: np.ndarray, wanted: int) -> DataFrame:
    """Add ``_bucket``, from 1 up, by the quantiles of the sampled ``points`` (rows of level values).

    A Bucketizer places every row on the first level. A value that fills several buckets by itself is
    crowded: its rows are placed on the next level, and so on. All crowds share one axis there, each
    with its own stretch of it, so the number of Bucketizers depends on the levels, not on the crowds.
    """
    points = points[np.lexsort(points.T[::-1])]
    edges = np.unique(points[(np.arange(1, wanted) * len(points)) // wanted], axis=0)
    crowds, state = [(0, edges)], None
    for level, field in enumerate(fields):
        x = F.col(field)
        if level == 0:
            steps, following = _steps(crowds, level, lambda place, value: -np.inf if value is None else value)
            axis, splits = x, [s.at for s in steps]
        else:
            # The values of all edges of this level, numbered, and a stretch of those numbers per crowd.
            # Rows that are placed already go to the left of all crowds.
            marks = np.unique(np.concatenate([edges[:, level] for _, edges in crowds]))
            stretch = float(len(marks) + 1)
            steps, following = _steps(
                crowds, level,
                lambda place, value: place * stretch + (0 if value is None else 1 + np.searchsorted(marks, value)),
            )
            ruler = Bucketizer(splits=[-np.inf, *marks.tolist(), np.inf], inputCol=field, outputCol="_mark")
            out = ruler.transform(out)
            axis = F.coalesce(F.col(f"{state}.crowd") * F.lit(stretch) + F.col("_mark"), F.lit(-1.0))
            splits = [-np.inf, *[s.at for s in steps]]
        cutter = Bucketizer(splits=[*map(float, splits), np.inf], inputCol="_axis", outputCol="_cut")
        out = cutter.transform(out.withColumn("_axis", axis))
        if level == 0 and not following:
            return computed_once(out, BUCKET, F.col("_cut").cast("bigint") + 1).drop("_axis", "_cut")

        place = F.greatest(F.lit(0), F.col("_cut").cast("int") - (0 if level == 0 else 1))

        def told(kind: str, values: list) -> Column:
            return F.get(_numbers(np.array(values), kind), place)

        value, onward = told("double", [s.value for s in steps]), told("int", [s.next for s in steps])
        below, here = told("int", [s.below for s in steps]), told("int", [s.here for s in steps])
        placed = F.when(x < value, below).when((x > value) | (onward < 0), below + here)
        crowd = F.when((x == value) & (onward >= 0), onward)
        if level:
            open_ = F.col(f"{state}.crowd").isNotNull()
            placed = F.when(open_, placed).otherwise(F.col(f"{state}.placed"))
            crowd = F.when(open_, crowd)
        state, before = f"_state{level}", state
        out = computed_once(out, state, F.struct(placed.alias("placed"), crowd.alias("crowd")))
        out = out.drop("_axis", "_cut", "_mark", *([before] if before else []))
        crowds = following
        if not crowds:
            break
    return out.withColumn(BUCKET, F.col(f"{state}.placed").cast("bigint") + 1).drop(state)


@dataclass(frozen=True)
class Bucketed:
    frame: DataFrame
    cut: bool  # whether any group has more than one bucket


def _grouped(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    # A struct is never null itself, so rows with a null group key still meet in the joins below.
    return df.withColumn(GROUP, F.struct(*partition) if partition else F.lit(0))


def bucketed(
    df: DataFrame,
    order: Sequence[str],
    partition: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    stats: dict | None = None,
) -> Bucketed:
    """Add ``_group`` and ``_bucket``: 0 for the rows of a group that needs no cutting, else 1, 2, ...

    Buckets follow ``order`` and hold about ``rows_per_bucket`` rows. A group is cut once the sample
    finds more than twice that many rows in it, so at most half as many groups as buckets are cut.
    """
    grouped = _grouped(df, partition)
    whole = Bucketed(grouped.withColumn(BUCKET, F.lit(0).cast("bigint")), False)
    stats = stats or order_stats(df, order)
    rows = stats["rows"]
    parallel = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(MAX_BUCKETS, max(math.ceil(rows / rows_per_bucket), min(parallel, rows // ROWS_WORTH_A_TASK)))
    if wanted <= 1:
        return whole

    levels = _levels(df, order, stats)
    fields = [f"_level{i}" for i in range(len(levels))]
    key = F.xxhash64(GROUP)  # groups that share a hash are cut together, which does no harm
    sample = grouped.select(key.alias("key"), *[c.alias(f) for c, f in zip(levels, fields)])
    fraction = SAMPLE_PER_BUCKET * wanted / rows
    if fraction < 1.0:
        sample = sample.sample(fraction, seed=11)
    taken = sample.toArrow()  # about SAMPLE_PER_BUCKET * buckets rows of numbers, whatever the table holds
    points = np.column_stack([taken.column(f).to_numpy() for f in fields]).astype("float64")
    keys = taken.column("key").to_numpy()
    if not len(points):
        return whole
    seen, hits = np.unique(keys, return_counts=True)
    large = seen[hits * wanted > 2 * len(keys)]
    if partition and not len(large):
        return whole

    belongs = np.isin(keys, large) if partition else np.ones(len(keys), bool)
    share = max(2, math.ceil(wanted * belongs.mean()))
    out = _bucket_column(grouped.withColumns(dict(zip(fields, levels))), fields, points[belongs], share)
    if partition:
        out = out.withColumn(BUCKET, F.when(key.isin(large.tolist()), F.col(BUCKET)).otherwise(F.lit(0).cast("bigint")))
    return Bucketed(out.drop(*fields), True)


def _across(rows: DataFrame, facts: Column, carried: Callable[[], Column], out: str) -> DataFrame:
    """Join to every row of a cut group what ``carried`` says about its bucket, from ``facts`` per bucket.

    ``carried`` is a window expression over the buckets of one group, at most MAX_BUCKETS rows.
    """
    facts = rows.where(F.col(BUCKET) > 0).groupBy(F.col(GROUP).alias("_g"), F.col(BUCKET).alias("_b")).agg(facts)
    told = facts.select("_g", "_b", carried().alias(out))
    return rows.join(told, (F.col(GROUP) == F.col("_g")) & (F.col(BUCKET) == F.col("_b")), "left").drop("_g", "_b")


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    partition: Sequence[str] = (),
    out: str = "position",
    rows_per_bucket: int = ROWS_PER_BUCKET,
    stats: dict | None = None,
    unique: bool = False,
) -> DataFrame:
    """``row_number()`` per ``partition`` (or overall) by ``order``, in tasks of bounded size.

    ``order`` must identify a row within its partition; with ``unique``, rows that share it are refused.
    The rows are shuffled once. ``stats`` spares a scan where the caller already has the :func:`order_stats`.
    """
    cut = bucketed(df, order, partition, rows_per_bucket, stats)
    along = Window.partitionBy(GROUP, BUCKET).orderBy(*sort_columns(order))
    inside = F.row_number().over(along).cast("bigint")
    if unique:
        # Equal rows share their bucket, so they are neighbours in one window.
        here = F.struct(*map(order_name, order))
        refused = F.raise_error(F.lit(f"{','.join(map(order_name, order))} does not identify a row")).cast("bigint")
        inside = F.when(F.lag(here).over(along) == here, refused).otherwise(inside)
    if not cut.cut:
        return cut.frame.withColumn(out, inside).drop(GROUP, BUCKET)
    earlier = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    rows = _across(cut.frame, F.count(F.lit(1)).alias("_n"), lambda: F.sum("_n").over(earlier), "_start")
    return rows.withColumn(out, F.coalesce("_start", F.lit(0)) + inside).drop(GROUP, BUCKET, "_start")


def with_next(
    df: DataFrame,
    column: str,
    order: Sequence[str],
    partition: Sequence[str],
    out: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``lead(column)`` per ``partition`` by ascending ``order``, in tasks of bounded size."""
    cut = bucketed(df, order, partition, rows_per_bucket)
    following = F.lead(F.struct(column)).over(Window.partitionBy(GROUP, BUCKET).orderBy(*sort_columns(order)))
    if not cut.cut:
        return cut.frame.withColumn(out, following[column]).drop(GROUP, BUCKET)
    first = F.min(F.struct(*order, F.struct(column).alias("_value"))).alias("_first")
    later = Window.partitionBy("_g").orderBy("_b")
    rows = _across(cut.frame, first, lambda: F.lead("_first").over(later)["_value"], "_beyond")
    return rows.withColumn(out, F.coalesce(following, F.col("_beyond"))[column]).drop(GROUP, BUCKET, "_beyond")
