"""Column statistics and schema inference: one wide aggregate for sizes and ranges, one unpivoted count for distincts and modes."""

from __future__ import annotations

import math
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W


# Limits of what a profile accepts, and patterns of formatted values.
LAST_DATE = "2262-04-11"
LARGEST = 1.7976931348623157e308
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
CLOCK = r"^\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"


# --- P: statistics


def long_form(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, value): every cell as a string, in one pass."""
    columns = columns or df.columns
    cells = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns))
    return df.select(F.explode(cells).alias("x")).select("x.feature", "x.value")


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, value, n), null being a value. Every distinct, mode and value count is read from here."""
    return long_form(df, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))


def distinct_counts(counts: DataFrame) -> DataFrame:
    """(feature, n_distinct without null, n_distinct_null with it, n_unique values that occur once)."""
    return counts.groupBy("feature").agg(F.count("value").alias("n_distinct"), F.count("*").alias("n_distinct_null"), F.count_if((F.col("n") == 1) & F.col("value").isNotNull()).alias("n_once"))


def distinct_count(df: DataFrame, columns: list[str]) -> DataFrame:
    """(n_distinct): of one column without null, or of combinations, in which null counts as a value."""
    rows = df.select(*columns).distinct()
    return (rows.dropna() if len(columns) == 1 else rows).agg(F.count("*").alias("n_distinct"))


def modes(counts: DataFrame) -> DataFrame:
    """(feature, value, n): all values with the top count, if that is over 1."""
    top = counts.where("value IS NOT NULL").groupBy("feature").agg(F.max("n").alias("n"))
    return counts.join(top, ["feature", "n"]).where("n > 1 AND value IS NOT NULL").select("feature", "value", "n")


def value_count(df: DataFrame, column: str, value) -> DataFrame:
    return df.agg(F.count_if(F.col(column).eqNullSafe(F.lit(value))).alias("n"))


def basics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, n_rows, n, n_null, min, max, avg_bytes) in one pass."""
    columns = columns or df.columns
    kinds = dict(df.dtypes)
    one = [
        F.struct(
            F.lit(c).alias("feature"), F.count("*").alias("n_rows"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("n_null"),
            *((F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max")) if not kinds[c].startswith(("map", "variant")) else (F.lit(None).cast("string").alias("min"), F.lit(None).cast("string").alias("max"))),
            F.avg(F.octet_length(F.col(c).cast("string"))).alias("avg_bytes"),
        )
        for c in columns
    ]
    return df.agg(F.array(*one).alias("all")).select(F.inline("all"))


def first_non_null(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """(value): of the first row in `order` that has one."""
    return df.where(F.col(column).isNotNull()).agg(F.min_by(column, F.struct(*order)).alias("value"))


def random_rows(df: DataFrame, n: int, seed: int = 0, key: str | None = None) -> DataFrame:
    """n rows without replacement, the same for a seed."""
    h = F.xxhash64(F.lit(seed), *([key] if key else df.columns))
    return df.orderBy(h, *([key] if key else [])).limit(n)


def random_values(df: DataFrame, column: str, n: int, seed: int = 0, nulls: bool = False) -> DataFrame:
    rows = df.select(column) if nulls else df.select(column).dropna()
    return rows.distinct().orderBy(F.xxhash64(F.lit(seed), column), column).limit(n)


def decimals(c: Column) -> Column:
    """Decimal places of a number as it is printed in plain notation; 1.0 has none."""
    plain = F.regexp_replace(F.format_string("%.15f", F.round(c.cast("double"), 12)), "0+$", "")
    return F.when(F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")), None).otherwise(F.length(F.substring_index(plain, ".", -1)))


def decimal_places(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.array(*(F.struct(F.lit(c).alias("feature"), F.max(decimals(F.col(c))).cast("long").alias("decimal_places")) for c in columns)).alias("all")).select(F.inline("all"))


def content_hash(c: Column) -> Column:
    return F.xxhash64(F.to_json(F.struct(c.alias("v"))))


def group_numbers(df: DataFrame, column: str, groups: int, seed: int = 0) -> DataFrame:
    """(value, group): each distinct value to one of `groups`."""
    return df.select(F.col(column).alias("value")).distinct().withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "value"), F.lit(groups)))


def chunk_size(n: int, most: int, least: int = 1) -> int:
    """Rows of a chunk: a power of two of even chunks, none over `most` nor under `least` rows if that can be."""
    if n <= 0:
        return 0
    needed = math.ceil(n / most)
    chunks = min(2 ** math.ceil(math.log2(needed)) if needed > 1 else 1, 2 ** max(0, math.floor(math.log2(max(1.0, n / least)))))
    return math.ceil(n / chunks)


def heavy(stats: DataFrame, most_bytes: float) -> DataFrame:
    """Features whose values take more bytes on average than allowed."""
    return stats.where(F.col("avg_bytes") > most_bytes).select("feature", "avg_bytes")


# --- I: inference


@dataclass
class Attributes:
    """What is known about one feature."""

    name: str
    type: str = "nominal"
    data_type: str = "string"
    original: str = "string"
    decimal_places: int | None = None
    cycle_length: float | None = None
    format: str | None = None
    min: object = None
    max: object = None
    observed_min: object = None
    observed_max: object = None
    allowed: list | None = None
    allow_null: bool = False
    nulls_observed: bool = False
    unique: bool = False
    id_feature: bool = False
    time_zone: str | None = None
    sample: object = None
    dependent: list | None = None
    fanout_on: list | None = None
    extra: dict = field(default_factory=dict)

    def as_dict(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v not in (None, {}, [])}


def loose_bounds(low: float, high: float) -> tuple[float, float]:
    """The range widened by e ** 0.5 on either side, not across zero; a point gets e ** 0.5."""
    if low > high:
        raise ValueError("minimum above maximum")
    r = high - low
    wide = math.exp(0.5) if r == 0 else math.exp(math.log(r) + 0.5)
    lo, hi = high - wide, low + wide
    return (max(0.0, lo) if low >= 0 else lo), (min(0.0, hi) if high <= 0 else hi)


def loose_bounds_columns(low: Column, high: Column) -> tuple[Column, Column]:
    r = high - low
    wide = F.when(r == 0, F.exp(F.lit(0.5))).otherwise(F.exp(F.ln(F.nullif(r, F.lit(0.0))) + 0.5))
    lo, hi = high - wide, low + wide
    return F.when(low >= 0, F.greatest(F.lit(0.0), lo)).otherwise(lo), F.when(high <= 0, F.least(F.lit(0.0), hi)).otherwise(hi)


def mode_bounds(bounds: tuple, observed: tuple, top: list[tuple[float, int]], all_unique: bool) -> tuple:
    """A bound stays at the observed one if a mode that occurs more than three times equals it."""
    low, high = bounds
    if not all_unique:
        for value, n in top:
            if n > 3:
                if value == observed[0]:
                    low = value
                elif value == observed[1]:
                    high = value
    return low, high


def integer_threshold(n: int, series: int | None = None, invariant: bool = False) -> int:
    """Distinct values below which an integer is nominal."""
    if invariant and series:
        return math.ceil(math.sqrt(series))
    return math.ceil(math.sqrt(max(series or 1, n / (series or 1))))


def integer_is_nominal(n: int, distinct: int, low: int | None, high: int | None, series: int | None = None, invariant: bool = False) -> bool:
    """Few distinct values, or numbers of one printed length of at least five digits, which look like keys."""
    if not n:
        return False
    if distinct < integer_threshold(n, series, invariant):
        return True
    return low >= -1 and high >= -1 and len(str(low)) == len(str(high)) >= 5


def _string_tests(c: Column) -> list[Column]:
    t = F.trim(c)
    every = lambda test: F.every(c.isNull() | F.coalesce(test, F.lit(False)))  # noqa: E731  nulls say nothing
    return [
        every(F.lower(t).isin("true", "false")).alias("boolean"),
        every(t.rlike(ISO_DATE) & t.try_cast("date").isNotNull()).alias("date"),
        every(t.rlike(ISO_TIME) & t.try_cast("timestamp").isNotNull()).alias("datetime"),
        every(t.rlike(CLOCK)).alias("time"),
        every(t.rlike(r"^[\[{]") & F.try_parse_json(t).isNotNull()).alias("json"),
        every(t.rlike(r"(?m)^[\w-]+:( .*)?\n(.*\n)*?[\w-]+:( .*)?$")).alias("yaml"),
        every(t.try_cast("double").isNotNull()).alias("number"),
        F.max_by(t, F.length(t)).alias("longest"),
    ]


def infer(
    df: DataFrame,
    *,
    types: dict | None = None,
    ordinal_values: dict[str, list] | None = None,
    formats: dict[str, str] | None = None,
    tight_bounds: list[str] = (),
    mode_bound_features: list[str] | None = None,
    ids: list[str] = (),
    series_ids: list[str] = (),
    invariant: list[str] = (),
    dependent: dict[str, list[str]] | None = None,
    time_zone: str | None = None,
    include_sample: bool = False,
) -> dict[str, Attributes]:
    """Attributes of every column of `df`.

    Three jobs whatever the number of columns: basics and string tests in one aggregate, one unpivoted value count, decimals of
    the floats. `types`: feature by type, or type by list of features; a preset type wins, but a boolean stays nominal. `formats`:
    Spark datetime patterns of string columns.
    """
    types = {f: t for k, v in (types or {}).items() for f, t in ([(k, v)] if isinstance(v, str) else [(x, k) for x in v])}
    kinds = {f.name: f.dataType for f in df.schema}
    strings = [c for c, t in kinds.items() if isinstance(t, T.StringType)]
    floats = [c for c, t in kinds.items() if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType))]
    simple = [c for c, t in kinds.items() if not isinstance(t, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    series = df.select(*series_ids).distinct().count() if series_ids else None

    stats = {r.feature: r for r in basics(df, list(kinds)).collect()}
    # of the modes only those that equal an observed bound matter, so no value counts are kept
    ends = {c: (float(s.min), float(s.max)) for c, s in stats.items() if s.n and c in simple and isinstance(kinds[c], T.NumericType)}
    bound = [F.element_at(F.create_map(*(F.lit(x) for c, v in ends.items() for x in (c, v[i]))), F.col("feature")) if ends else F.lit(None).cast("double") for i in (0, 1)]
    number_of = F.col("value").try_cast("double")
    at_bound = [F.max(F.when(number_of == x, F.col("n"))) for x in bound]
    top_n = F.max(F.when(F.col("value").isNotNull(), F.col("n")))
    counted = value_counts(df, simple).groupBy("feature").agg(F.count("value").alias("n_distinct"), top_n.alias("top"), at_bound[0].alias("n_low"), at_bound[1].alias("n_high"))
    distinct = {r.feature: r for r in counted.collect()}
    top = {c: [(x, n) for x, n in zip(ends[c], (r.n_low, r.n_high), strict=True) if n == r.top and n > 1] for c, r in distinct.items() if c in ends and r.top}
    tests = {}
    if strings:
        row = df.agg(*(F.struct(*_string_tests(F.col(c))).alias(f"t{i}") for i, c in enumerate(strings))).first()
        tests = {c: row[f"t{i}"] for i, c in enumerate(strings)}
    samples = {}
    if include_sample:  # a value drawn by its hash
        row = df.agg(*(F.min_by(F.col(c).cast("string"), F.when(F.col(c).isNotNull(), F.xxhash64(F.lit("sample"), F.col(c).cast("string")))).alias(f"s{i}") for i, c in enumerate(simple))).first()
        samples = {c: row[f"s{i}"] for i, c in enumerate(simple)}
    places = {r.feature: r.decimal_places for r in decimal_places(df, floats).collect()} if floats else {}
    ordinal_values, formats, dependent = ordinal_values or {}, formats or {}, dependent or {}
    ranks = {}
    if ordinal_values:  # the places of the observed values among those declared
        place = {c: F.nullif(F.array_position(F.array(*map(F.lit, v)), F.col(c)), F.lit(0)) for c, v in ordinal_values.items()}
        row = df.agg(*(F.struct(F.min(x).alias("a"), F.max(x).alias("b")).alias(f"o{i}") for i, x in enumerate(place.values()))).first()
        ranks = {c: (row[f"o{i}"].a, row[f"o{i}"].b) for i, c in enumerate(place)}

    out: dict[str, Attributes] = {}
    for c, kind in kinds.items():
        s, d = stats[c], distinct.get(c)
        a = Attributes(c, original=kind.simpleString(), nulls_observed=s.n_null > 0, allow_null=True, time_zone=time_zone, dependent=dependent.get(c))
        preset = types.get(c)
        number = None
        if isinstance(kind, T.BooleanType):
            a.type, a.data_type, preset = "nominal", "boolean", None
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            a.data_type, a.decimal_places = "number", 0
            number = (int(s.min), int(s.max)) if s.n else None
            nominal = integer_is_nominal(s.n, d.n_distinct, *(number or (None, None)), series, c in invariant)
            a.type = "nominal" if nominal else "continuous"
        elif c in floats:
            a.data_type = "number"
            number = (float(s.min), float(s.max)) if s.n else None
            a.type = "nominal" if d.n_distinct <= 2 and s.n_rows > 10 and s.n and preset not in ("continuous", "ordinal") else "continuous"
            a.decimal_places = places.get(c) if a.type == "continuous" else None
            if isinstance(kind, T.DecimalType):
                a.format = "decimal"
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            a.type, a.data_type, a.format = "continuous", "formatted_date_time", "yyyy-MM-dd" if isinstance(kind, T.DateType) else "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        elif isinstance(kind, T.DayTimeIntervalType):
            a.type, a.data_type = "continuous", "number"
        elif isinstance(kind, T.StringType):
            t = tests[c]
            if c in formats:
                a.type, a.data_type, a.format = "continuous", "formatted_date_time", formats[c]
            elif s.n and t.boolean:
                a.type, a.data_type, preset = "nominal", "boolean", None
            elif s.n and t.time:
                a.type, a.data_type, a.format, a.cycle_length = "continuous", "formatted_time", time_format(t.longest), float(cycle_length(time_format(t.longest)))
            elif s.n and t.date:
                a.type, a.data_type, a.format = "continuous", "formatted_date_time", "yyyy-MM-dd"
            elif s.n and t.datetime:
                a.type, a.data_type, a.format = "continuous", "formatted_date_time", iso_format(t.longest)
            elif s.n and t.json:
                a.type, a.data_type = "continuous", "json"
            elif s.n and t.yaml:
                a.type, a.data_type = "continuous", "yaml"
            elif preset == "continuous" and not t.number:
                a.type, a.data_type = "continuous", "tokenizable_string"
        else:
            a.type, a.data_type = "continuous", "json"
        if c in ordinal_values:
            a.type, a.data_type, a.allowed = "ordinal", a.data_type, list(ordinal_values[c])
        if preset and c not in ordinal_values:
            a.type = preset
        if c in ids:
            a.type, a.id_feature = "nominal", True
        a.unique = bool(d and s.n and d.n_distinct == s.n)
        if number and a.type == "continuous":
            a.observed_min, a.observed_max = number
            bounds = number if c in tight_bounds else loose_bounds(*map(float, number))
            if c not in tight_bounds and (mode_bound_features is None or c in mode_bound_features):
                bounds = mode_bounds(bounds, tuple(map(float, number)), [(float(v), n) for v, n in top.get(c, ())], a.unique)
            digits = a.decimal_places if a.decimal_places is not None else 12
            a.min, a.max = (round(float(x), digits) if a.decimal_places else (math.floor(bounds[0]) if x is bounds[0] else math.ceil(bounds[1])) if a.decimal_places == 0 else float(x) for x in bounds)
        elif a.data_type == "formatted_time":
            a.min, a.max = 0.0, a.cycle_length
        elif a.data_type == "formatted_date_time" and s.n and isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            a.observed_min, a.observed_max = s.min, s.max
        elif a.allowed:
            a.observed_min, a.observed_max = (None if r is None else a.allowed[r - 1] for r in ranks[c])
        elif number is None and not s.n and isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(kind)]
            a.min, a.max = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
            a.type = preset or "continuous"
        elif number is None and not s.n and isinstance(kind, (T.FloatType, T.DoubleType)) and a.type == "continuous":
            most = 3.4028234663852886e38 if isinstance(kind, T.FloatType) else 1.7976931348623157e308
            a.min, a.max = -most, most
        if include_sample and s.n:
            a.sample = samples.get(c)
        out[c] = a
    written_dates = {c: a.format for c, a in out.items() if c in strings and a.data_type == "formatted_date_time" and a.format and stats[c].n}
    for c, (low, high, lo, hi) in written_bounds(df, written_dates).items():
        a = out[c]
        a.observed_min, a.observed_max = low, high
        a.min, a.max = (low, high) if c in tight_bounds else (lo, hi)
    dates = [c for c, a in out.items() if a.data_type == "formatted_date_time" and a.observed_min is not None and c not in written_dates]
    for c, (lo, hi) in epoch_bounds(df, [c for c in dates if c not in tight_bounds]).items():
        out[c].min, out[c].max = lo, hi
    for c in set(dates) & set(tight_bounds):
        out[c].min, out[c].max = out[c].observed_min, out[c].observed_max
    return out


def epoch_bounds(df: DataFrame, columns: list[str]) -> dict[str, tuple[str, str]]:
    """Loose bounds of times, computed on seconds since the epoch and written back as times."""
    if not columns:
        return {}
    parts = []
    for c in columns:
        e = F.unix_micros(F.col(c).cast("timestamp")) / 1e6
        lo, hi = loose_bounds_columns(F.min(e), F.max(e))
        parts.append(F.struct(F.timestamp_seconds(lo).cast("string").alias("lo"), F.timestamp_seconds(hi).cast("string").alias("hi")).alias(c))
    row = df.agg(*parts).first()
    return {c: (row[c].lo, row[c].hi) for c in columns}


def written_bounds(df: DataFrame, formats: dict[str, str]) -> dict[str, tuple[str, str, str, str]]:
    """Of string columns that hold times in a pattern: least, largest and loose bounds, in the same pattern (offsets are written in the session's zone)."""
    if not formats:
        return {}
    parts = []
    for c, pattern in formats.items():
        t = F.coalesce(F.try_to_timestamp(F.trim(F.col(c)), F.lit(pattern)), F.trim(F.col(c)).try_cast("timestamp"))
        lo, hi = loose_bounds_columns(F.min(F.unix_micros(t) / 1e6), F.max(F.unix_micros(t) / 1e6))
        parts.append(F.array(*(F.date_format(x, pattern) for x in (F.min(t), F.max(t), F.timestamp_seconds(lo), F.timestamp_seconds(hi)))).alias(c))
    row = df.agg(*parts).first()
    return {c: tuple(row[c]) for c in formats}


def infer_tables(tables: dict[str, DataFrame], **options) -> dict[str, dict[str, Attributes]]:
    return {name: infer(df, **options.get(name, {})) for name, df in tables.items()}


def as_table(spark, profile: dict[str, Attributes], table: str | None = None) -> DataFrame:
    """A row per feature."""
    rows = [(table, a.name, a.type, a.data_type, a.original, a.decimal_places, *(None if x is None else str(x) for x in (a.min, a.max)), a.allow_null, a.nulls_observed, a.unique, a.id_feature, a.format, a.cycle_length) for a in profile.values()]
    return spark.createDataFrame(rows, "table_name string, feature string, type string, data_type string, original string, decimal_places int, min string, max string, allow_null boolean, nulls_observed boolean, `unique` boolean, id_feature boolean, format string, cycle_length double")


def names(profile: dict[str, Attributes], *, types=None, data_types=None, without=()) -> list[str]:
    keep = lambda x, want: want is None or x in ([want] if isinstance(want, str) else want)
    return [n for n, a in profile.items() if keep(a.type, types) and keep(a.data_type, data_types) and n not in without]


def merge(old: dict[str, Attributes], new: dict[str, Attributes]) -> dict[str, Attributes]:
    """`new` over `old`, but types preset in `old` stay, those of booleans excepted."""
    out = dict(old)
    for n, a in new.items():
        if n in old and old[n].type and a.data_type != "boolean":
            a = Attributes(**(asdict(a) | {"type": old[n].type}))
        out[n] = a
    return out


def unsupported(profile: dict[str, Attributes]) -> list[tuple[str, str]]:
    """(feature, reason) of what is too large to be represented."""
    out = []
    for n, a in profile.items():
        hi, lo = a.observed_max, a.observed_min
        if isinstance(hi, int) and max(abs(hi), abs(lo)) > 2**53:
            out.append((n, "integer"))
        if isinstance(hi, float) and (math.isinf(hi) or math.isinf(lo)):
            out.append((n, "float"))
        if a.data_type == "formatted_date_time" and isinstance(hi, str) and hi[:10] > LAST_DATE:
            out.append((n, "date"))
    return out


def nearly_unique(stats: dict, distinct: dict, features: list[str]) -> list[str]:
    """Dependent features with so many values that few cases can share one."""
    return [f for f in features if distinct[f] >= stats[f] // 2]


def differences(old: dict[str, Attributes], new: dict[str, Attributes]) -> list[tuple[str, str]]:
    """(feature, what changed): added, removed, or the name of an attribute that matters for a fitted case base."""
    out = [(n, "added") for n in new if n not in old] + [(n, "removed") for n in old if n not in new]
    watched = ("type", "data_type", "cycle_length", "allowed", "dependent", "fanout_on")
    return out + [(n, k) for n in old if n in new for k in watched if getattr(old[n], k) != getattr(new[n], k)]


@dataclass
class Suggestions:
    """Collected proposals by kind and feature; two that differ for one feature are an error."""

    found: dict[tuple[str, str], object] = field(default_factory=dict)

    def add(self, kind: str, feature: str, value) -> None:
        if self.found.get((kind, feature), value) != value:
            raise ValueError(f"{kind} of {feature}: {self.found[kind, feature]} and {value}")
        self.found[kind, feature] = value

    def merge(self, other: Suggestions) -> None:
        for (kind, feature), value in other.found.items():
            self.add(kind, feature, value)

    def apply(self, profile: dict[str, Attributes], kind: str) -> dict[str, Attributes]:
        out = dict(profile)
        for (k, feature), value in self.found.items():
            if k == kind:
                own = {kind: value} if kind in Attributes.__dataclass_fields__ else {"extra": out[feature].extra | {kind: value}}
                out[feature] = Attributes(**(asdict(out[feature]) | own))
        return out


def time_format(sample: str) -> str | None:
    """Pattern of a clock time."""
    if re.fullmatch(r"\d{1,2}:\d{2}:\d{2}\.\d+", sample):
        return "HH:mm:ss." + "S" * len(sample.rsplit(".", 1)[1])
    if re.fullmatch(r"\d{1,2}:\d{2}:\d{2}", sample):
        return "HH:mm:ss"
    return "HH:mm" if re.fullmatch(r"\d{1,2}:\d{2}", sample) else None


def iso_format(sample: str) -> str | None:
    """Pattern of an ISO-8601 date or time as the sample is written: its separator, the digits of its fraction, its offset."""
    m = re.fullmatch(r"(?P<date>\d{4}-\d{2}-\d{2})(?:(?P<sep>[T ])\d{2}:\d{2}(?P<s>:\d{2}(?:\.(?P<f>\d+))?)?(?P<zone>Z|[+-]\d{2}:?\d{2})?)?", sample.strip())
    if not m:
        return None
    if not m["sep"]:
        return "yyyy-MM-dd"
    pattern = "yyyy-MM-dd" + ("'T'" if m["sep"] == "T" else " ") + "HH:mm" + (":ss" if m["s"] else "") + ("." + "S" * len(m["f"]) if m["f"] else "")
    return pattern + (("XXX" if m["zone"] == "Z" or ":" in m["zone"] else "XX") if m["zone"] else "")


def cycle_length(pattern: str) -> int:
    """Seconds after which a clock of this pattern starts anew."""
    return 86400 if re.search("[Hhk]", pattern) else 3600 if "m" in pattern else 60 if "s" in pattern else 1


def to_json(profile: dict[str, Attributes]) -> str:
    """Text form of a profile; tuples, dates and numbers keep their types through `from_json`."""
    import json

    def plain(x):
        return {"__tuple__": list(x)} if isinstance(x, tuple) else {"__text__": str(x)}

    return json.dumps({n: {k: (plain(v) if isinstance(v, tuple) else v) for k, v in a.as_dict().items()} for n, a in profile.items()}, default=plain)


def from_json(text: str) -> dict[str, Attributes]:
    import json

    def back(x):
        return tuple(x["__tuple__"]) if isinstance(x, dict) and "__tuple__" in x else x["__text__"] if isinstance(x, dict) and "__text__" in x else x

    return {n: Attributes(**{k: back(v) for k, v in a.items()}) for n, a in json.loads(text).items()}


def valid_format(df: DataFrame, column: str, pattern: str) -> bool:
    """Whether every non-null value can be read with a datetime pattern."""
    return df.where(F.col(column).isNotNull() & F.try_to_timestamp(F.col(column), F.lit(pattern)).isNull()).isEmpty()


def issues(found: list[tuple[str, str]], spark) -> DataFrame:
    """(kind, features): collected warnings, one row per kind."""
    return spark.createDataFrame(found, "kind string, feature string").groupBy("kind").agg(F.array_sort(F.collect_set("feature")).alias("features"))
