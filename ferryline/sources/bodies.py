"""Message bodies: JSON text to typed columns."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.functions.once import computed_once

_CORRUPT = "_corrupt"


class Decoded(NamedTuple):
    good: DataFrame
    bad: DataFrame


def mark_undecodable(df: DataFrame, schema: T.StructType, body: str = "body", out: str = "content") -> DataFrame:
    """Parse ``body`` into ``out`` and tell in ``undecodable`` where that failed: one pass for both kinds."""
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    content = F.from_json(body, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = computed_once(df, out, content)
    broken = F.col(out).isNull() | F.col(f"{out}.{_CORRUPT}").isNotNull()
    return parsed.withColumns({"undecodable": broken, out: F.col(out).dropFields(_CORRUPT)})


def decode_messages(df: DataFrame, schema: T.StructType, body: str = "body", out: str = "content") -> Decoded:
    """Parse ``body``; rows that do not parse go to ``bad`` with the reason and the untouched text."""
    marked = mark_undecodable(df, schema, body, out)
    good = marked.where(~F.col("undecodable")).drop("undecodable")
    bad = marked.where("undecodable").drop(out, "undecodable")
    return Decoded(good, bad.withColumn("error", F.lit("undecodable body")))
