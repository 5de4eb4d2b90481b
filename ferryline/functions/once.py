"""Keeping Catalyst from computing a costly column more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that filters on it do not compute it again.

    Catalyst copies an expression into every filter that is pushed below its projection; it does not
    push filters through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
