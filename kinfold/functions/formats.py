"""Column expressions that bring values to a declared form and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOUBLE_MAX = 1.7976931348623157e308


def format_datetime(c: Column, pattern: str, zone: str | None = None) -> Column:
    """A time, or a string that holds one, in the declared pattern; null if it cannot be read."""
    t = c.try_cast("timestamp")
    return F.date_format(F.from_utc_timestamp(t, zone) if zone else t, pattern)


def parse_datetime(c: Column, pattern: str) -> Column:
    return F.try_to_timestamp(c, F.lit(pattern))


def date_to_epoch(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp")) / 1e6


def epoch_to_date(c: Column) -> Column:
    return F.timestamp_seconds(c)


def time_to_seconds(c: Column) -> Column:
    """Seconds since midnight of `H:mm`, `H:mm:ss` or `H:mm:ss.f`; null if it is none of them."""
    part = lambda i: F.try_element_at(F.split(c, ":"), F.lit(i)).try_cast("double")
    s = part(1) * 3600 + part(2) * 60 + F.coalesce(part(3), F.lit(0.0))
    return F.when(c.rlike(r"^\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"), s)


def seconds_to_time(c: Column) -> Column:
    s = F.pmod(c, F.lit(86400.0))
    return F.format_string("%02d:%02d:%09.6f", F.floor(s / 3600).cast("int"), F.floor(s / 60 % 60).cast("int"), s % 60)


def to_integer(c: Column, bits: int = 64) -> Column:
    kind = {8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}[bits]
    return F.floor(c.try_cast("double")).try_cast(kind)


def to_boolean(c: Column) -> Column:
    """true, yes, on and (true) in any case are true, other strings false, null stays null."""
    return F.when(c.isNotNull(), F.lower(c.cast("string")).isin("true", "yes", "on", "(true)"))


def to_interval(seconds: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def to_json(c: Column) -> Column:
    return F.when(c.isNotNull(), F.to_json(c))


def from_json(c: Column, schema: T.DataType, as_set: bool = False) -> Column:
    out = F.from_json(c, schema)
    return F.array_distinct(out) if as_set else out


def tokenize(c: Column) -> Column:
    """Words and single punctuation marks in order; empty for an empty text, null for null."""
    return F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_\s])"))


def detokenize(c: Column) -> Column:
    """Words joined by spaces, none before closing marks."""
    return F.regexp_replace(F.array_join(c, " "), r" ([.,;:!?)\]])", "$1")


def infinity(c: Column) -> Column:
    """The largest double stands for infinity."""
    return F.when(c >= DOUBLE_MAX, F.lit(float("inf"))).when(c <= -DOUBLE_MAX, F.lit(float("-inf"))).otherwise(c)


def round_scaled(c: Column, digits: int) -> Column:
    """A double rounded as its product with a power of ten, halves away from zero, as DuckDB does it; Spark's own rounding takes the shortest decimal form, which can lie
    on the other side of a half, and loses the sign of a zero."""
    scaled = c * F.lit(10.0**digits)
    whole = F.round(scaled, 0)
    return F.when(F.abs(scaled) == F.lit(float("inf")), c).when(whole == 0, c * 0.0).otherwise(whole / F.lit(10.0**digits))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def null_to_nan(c: Column) -> Column:
    return F.coalesce(c, F.lit(float("nan")))


def significant(c: Column, digits: int | None = None, places: int | None = None) -> Column:
    """Rounded to significant digits first, then to decimal places."""
    if digits is not None:
        shift = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(c))))
        c = F.when(c == 0, F.lit(0.0)).otherwise(F.round(c * shift) / shift)
    return c if places is None else F.round(c, places)
