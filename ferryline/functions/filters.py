"""Filters written as documents, and masks built from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def _equals(field: Column, value) -> Column:
    return field.isNull() if value is None else field == F.lit(value)


def _member(field: Column, values) -> Column:
    present = [v for v in values if v is not None]
    found = field.isin(present) if present else F.lit(False)
    return found | field.isNull() if len(present) < len(values) else found


def _no_member(field: Column, values) -> Column:
    present = [v for v in values if v is not None]
    absent = ~field.isin(present) if present else F.lit(True)
    return field.isNotNull() & absent if len(present) < len(values) else field.isNull() | absent


# A missing field never passes a range test, and always passes ``$ne`` and ``$nin``. The tests are plain
# comparisons (null counts as not passed in a filter), so that they reach the Parquet scan.
_TESTS = {
    "$eq": _equals,
    "$ne": lambda field, value: field.isNotNull() if value is None else ~field.eqNullSafe(F.lit(value)),
    "$gt": lambda field, value: field > F.lit(value),
    "$gte": lambda field, value: field >= F.lit(value),
    "$lt": lambda field, value: field < F.lit(value),
    "$lte": lambda field, value: field <= F.lit(value),
    "$in": _member,
    "$nin": _no_member,
    "$exists": lambda field, wanted: field.isNotNull() if wanted else field.isNull(),
}


def _declared(name: str, value) -> Column:
    return F.col(name)


def free_field(column: str, declared: Sequence[str] = ()) -> Callable[[str, object], Column]:
    """Fields for :func:`filter_spec` that no schema declares: paths into the VARIANT ``column``, read as the type of the
    value they are compared with. A field that is missing, null or of another type is null. Names in ``declared`` stay
    columns.
    """
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string"}

    def of(name: str, value) -> Column:
        if name in declared:
            return F.col(name)
        if "'" in name or not all(name.split(".")):
            raise ValueError(f"no path: {name}")
        sample = next((v for v in value if v is not None), "") if isinstance(value, (list, tuple)) else value
        kind = kinds.get(type(sample), "string")
        return F.try_variant_get(F.col(column), "$" + "".join(f"['{part}']" for part in name.split(".")), kind)

    return of


def filter_spec(spec: Mapping, field: Callable[[str, object], Column] = _declared) -> Column:
    """The predicate a filter document stands for; ``{}`` keeps every row.

    ``{"status": "failed"}``, ``{"priority": {"$gte": 3}}``, ``{"$or": [{...}, {...}]}``; dots in a
    name reach into a struct. Anything else is refused rather than ignored. ``field`` finds a field by its name and the
    value it is compared with, a column by default.
    """
    parts = []
    for name, wanted in spec.items():
        if name in ("$and", "$or"):
            branches = [filter_spec(branch, field) for branch in wanted]
            if not branches:
                raise ValueError(f"{name} needs at least one filter")
            parts.append(_all(branches) if name == "$and" else _any(branches))
        elif name.startswith("$"):
            raise ValueError(f"unsupported filter operator: {name}")
        elif isinstance(wanted, Mapping):
            unknown = [op for op in wanted if op not in _TESTS]
            if unknown or not wanted:
                raise ValueError(f"unsupported filter on {name}: {dict(wanted)}")
            parts += [_TESTS[op](field(name, "" if op == "$exists" else value), value) for op, value in wanted.items()]
        else:
            parts.append(_equals(field(name, wanted), wanted))
    return _all(parts)
