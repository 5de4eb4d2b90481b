"""Values derived from ids instead of clocks and random generators, so reruns agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed(key: Column, seed: int, salt: str) -> Column:
    """A non-negative number below 2**32 that depends only on its arguments."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("string"), F.lit(f":{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def below(key: Column, seed: int, salt: str, n: int) -> Column:
    return hashed(key, seed, salt) % n


def pick(key: Column, seed: int, salt: str, values: Sequence[str]) -> Column:
    """One of ``values``, the same one for the same key."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.get(choices, below(key, seed, salt, len(values)).cast("int"))


def filled_id(value: Column, key: Column, seed: int, salt: str) -> Column:
    """``value``, or an id derived from ``key`` where it is null or blank."""
    made = F.md5(F.concat(F.lit(f"{seed}:{salt}:"), key.cast("string")))
    return F.when(value.isNull() | (F.trim(value) == ""), made).otherwise(value)


def iso(ts: Column) -> Column:
    """A timestamp as text with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def elapsed_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds from ``start`` to ``end``, whatever the session zone is."""
    gap = end - start

    def part(name: str) -> Column:
        return F.date_part(F.lit(name), gap)

    minutes = (part("DAY").cast("bigint") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000 + (part("SECOND") * 1000).cast("bigint")


def plus_ms(ts: Column, ms: Column) -> Column:
    """``ts`` moved by ``ms`` milliseconds, with the type of ``ts``."""
    return ts + F.make_dt_interval(secs=(ms.cast("decimal(18,3)") / 1000).cast("decimal(18,6)"))


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    seconds = F.hour(c) * 3600 + F.minute(c) * 60
    return days * 86_400_000_000.0 + seconds.cast("double") * 1e6 + F.round(
        F.date_part(F.lit("SECOND"), c).cast("double") * 1e6
    )


def as_instant(ts: Column) -> Column:
    """A zone-less timestamp as the instant it names in UTC: event time, as watermarks need it."""
    return F.timestamp_micros(ntz_micros(ts).cast("bigint"))


def as_ntz(instant: Column) -> Column:
    """The zone-less timestamp an instant has in UTC."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
