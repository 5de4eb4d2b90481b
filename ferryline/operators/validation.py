"""Row rules, defaults, and counts by filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.functions.filters import filter_spec
from ferryline.operators.joins import join_to_one


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column | None = None  # true where the rule is broken
    unique: tuple[str, ...] = ()  # or: columns no two rows may share


def required(*columns: str) -> list[Rule]:
    return [Rule(f"{c} is required", F.col(c).isNull()) for c in columns]


def one_of(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"{column} is not allowed", F.coalesce(~F.col(column).isin(list(values)), F.lit(False)))


def between(column: str, low, high) -> Rule:
    return Rule(f"{column} is out of range", F.coalesce(~F.col(column).between(low, high), F.lit(False)))


def unique(*columns: str) -> Rule:
    return Rule(f"{','.join(columns)} is not unique", unique=columns)


class Checked(NamedTuple):
    ok: DataFrame
    bad: DataFrame


def validate_rows(df: DataFrame, rules: Sequence[Rule], rows_per_task: int | None = None) -> Checked:
    """Split rows by ``rules``; ``bad`` carries the names of the broken rules in ``reasons``.

    Uniqueness counts copies per key first (with map-side partial counts) and joins only the repeated
    keys back; given ``rows_per_task``, in pieces where a key has more copies. Null keys are not compared.
    """
    marked, broken = df, []
    for i, rule in enumerate(rules):
        if not rule.unique:
            broken.append(F.when(rule.broken, F.lit(rule.name)))
            continue
        flag = f"_repeated{i}"
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in rule.unique])
        repeated = (
            df.where(whole).groupBy(*rule.unique).agg(F.count(F.lit(1)).alias("_copies"))
            .where("_copies > 1").select(*rule.unique, F.lit(True).alias(flag))
        )
        marked = join_to_one(marked, repeated, rule.unique, "left", rows_per_task, source=df)
        broken.append(F.when(F.col(flag), F.lit(rule.name)))
    judged = marked.withColumn("reasons", F.array_compact(F.array(*broken))).select(*df.columns, "reasons")
    return Checked(judged.where(F.size("reasons") == 0).drop("reasons"), judged.where(F.size("reasons") > 0))


def _value(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _defaulted(field: Column, parts: Sequence[str], value) -> Column:
    """``field`` (a struct) with the nested field at ``parts`` filled."""
    head, rest = parts[0], parts[1:]
    inner = field.getField(head)
    return field.withField(head, _defaulted(inner, rest, value) if rest else F.coalesce(inner, _value(value)))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill missing values; a dotted name fills a field inside a struct, an unknown column is added."""
    for name, value in defaults.items():
        head, *rest = name.split(".")
        if rest:
            df = df.withColumn(head, _defaulted(F.col(head), rest, value))
        elif head in df.columns:
            df = df.withColumn(head, F.coalesce(F.col(head), _value(value)))
        else:
            df = df.withColumn(head, _value(value))
    return df


def count_where(df: DataFrame, spec: Mapping) -> DataFrame:
    return df.where(filter_spec(spec)).agg(F.count(F.lit(1)).alias("row_count"))


def status_counts(df: DataFrame) -> DataFrame:
    """Total and per-status counts in one pass."""
    by_status = {
        "pending_count": "pending", "processing_count": "processing",
        "success_count": "success", "failed_count": "failed",
    }
    return df.agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.count_if(F.col("status") == status).alias(name) for name, status in by_status.items()],
    )


WORK_SETS = {
    "pending": ("pending",),
    "retry_failed": ("failed",),
    "complete_processing": ("processing",),
    "process_all": ("pending", "processing", "failed"),
}


def work_set(df: DataFrame, mode: str) -> DataFrame:
    """The rows a run of the given mode works on."""
    if mode not in WORK_SETS:
        raise ValueError(f"unknown mode: {mode}")
    return df.where(F.col("status").isin(*WORK_SETS[mode]))
