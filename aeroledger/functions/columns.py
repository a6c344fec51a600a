"""Column expressions shared by the operators: all JVM-side, no Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# Spellings that count as "yes" in exported flag columns.
TRUTHY = ("true", "1", "yes", "high")

_STAMPS = (T.TimestampType, T.TimestampNTZType, T.DateType)


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- schema helpers (driver-side metadata only, no job) -----------------------------------------

def resolve_column(columns: Iterable[str], candidates: Sequence[str]) -> str | None:
    """First candidate that exists, or None."""
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail early, naming every missing column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def normalize_headers(df: DataFrame) -> DataFrame:
    """Trim and lower-case all column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def prefer_columns(df: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """Keep the preferred columns that exist, in the preferred order; all columns if none do."""
    kept = [c for c in preferred if c in df.columns]
    return df.select(*kept) if kept else df


# --- numbers ------------------------------------------------------------------------------------

def numeric(c: ColumnLike, default: float | None = 0.0) -> Column:
    """Lenient double: unparsable, NULL and NaN become ``default``."""
    value = as_col(c).try_cast("double")
    value = F.when(F.isnan(value), None).otherwise(value)
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def clean_number(c: ColumnLike) -> Column:
    """Parse text such as ``₹ 1,200`` or ``45 %``; NULL when no number remains."""
    return F.regexp_replace(as_col(c).cast("string"), r"[₹,%\s]", "").try_cast("double")


def round_to(c: ColumnLike, digits: int) -> Column:
    """Round half away from zero on the binary value (no decimal detour, stays in codegen)."""
    unit = 10.0 ** digits
    scaled = as_col(c) * F.lit(unit)
    return F.when(scaled < 0, -F.floor(F.lit(0.5) - scaled)).otherwise(F.floor(scaled + F.lit(0.5))) / F.lit(unit)


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Double division; NULL when the denominator is zero."""
    bottom = as_col(denominator).cast("double")
    return as_col(numerator).cast("double") / F.nullif(bottom, F.lit(0.0))


def exact_sum(c: ColumnLike, digits: int = 6) -> Column:
    """Sum of doubles as decimals of ``digits`` places; NULL and NaN are left out.

    Floating sums change with the order in which tasks finish; decimals give the
    same answer for every partitioning.
    """
    value = as_col(c).cast("double")
    return F.sum(F.when(~F.isnan(value), value).cast(f"decimal(28,{digits})")).cast("double")


def exact_avg(c: ColumnLike, digits: int = 6) -> Column:
    value = as_col(c).cast("double")
    return exact_sum(c, digits) / F.nullif(F.count(F.when(~F.isnan(value), value)), F.lit(0)).cast("double")


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def flag(condition: Column) -> Column:
    """1 when true, else 0 (NULL counts as false)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def clamp(c: ColumnLike, low: float, high: float) -> Column:
    return F.least(F.greatest(as_col(c), F.lit(low)), F.lit(high))


def as_percent(c: ColumnLike) -> Column:
    """Probabilities up to 1 become percentages; larger values already are."""
    p = numeric(c)
    return F.when(p <= 1, p * 100.0).otherwise(p)


def compact_amount(c: ColumnLike) -> Column:
    """1.25M / 3.4K / 120 style text."""
    v = as_col(c).cast("double")
    return (F.when(F.abs(v) >= 1e6, F.format_string("%.2fM", v / 1e6))
            .when(F.abs(v) >= 1e3, F.format_string("%.1fK", v / 1e3))
            .otherwise(F.format_string("%.0f", v)))


def right_closed_bins(c: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by the first upper edge that is not below the value; NULL above the last edge."""
    value = as_col(c)
    branches = [F.when(value <= edge, F.lit(label)) for edge, label in zip(edges, labels)]
    return F.coalesce(*branches)


# --- text ---------------------------------------------------------------------------------------

def truthy(c: ColumnLike, words: Sequence[str] = TRUTHY) -> Column:
    """True when the text form of the value is one of ``words``; NULL is false."""
    return F.coalesce(F.lower(as_col(c).cast("string")).isin(*words), F.lit(False))


def same_text(c: ColumnLike, value: str) -> Column:
    """Case-insensitive equality."""
    return F.upper(as_col(c).cast("string")) == F.lit(value.upper())


def first_filled(*cols: ColumnLike) -> Column:
    """First value that is neither NULL nor an empty string."""
    return F.coalesce(*[F.nullif(as_col(c).cast("string"), F.lit("")) for c in cols])


def contains_any(needle: str, *cols: ColumnLike) -> Column:
    """Case-insensitive substring search over several columns."""
    parts = [F.lower(F.coalesce(as_col(c).cast("string"), F.lit(""))).contains(needle.lower()) for c in cols]
    return reduce(Column.__or__, parts)


def spaced(c: ColumnLike) -> Column:
    return F.replace(as_col(c).cast("string"), F.lit("_"), F.lit(" "))


def short_id(*cols: ColumnLike, length: int = 16) -> Column:
    """Stable id from row content, so a re-run task produces the same id."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


# --- time ---------------------------------------------------------------------------------------

def lenient_timestamp(c: ColumnLike) -> Column:
    return as_col(c).try_cast("timestamp")


def minutes_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Minutes between two stamps, each cut to whole seconds first."""
    return (F.unix_timestamp(as_col(later)) - F.unix_timestamp(as_col(earlier))) / F.lit(60.0)


def exact_minutes_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Minutes between two stamps to the microsecond."""
    micros = (F.unix_micros(as_col(later).cast("timestamp"))
              - F.unix_micros(as_col(earlier).cast("timestamp")))
    return micros / F.lit(60e6)


def boundaries_crossed(unit: str, earlier: ColumnLike, later: ColumnLike) -> Column:
    """How many ``hour`` or ``minute`` boundaries lie between two stamps."""
    seconds = {"hour": 3600, "minute": 60}[unit]
    gap = (F.unix_timestamp(F.date_trunc(unit, as_col(later)))
           - F.unix_timestamp(F.date_trunc(unit, as_col(earlier))))
    return (gap / F.lit(seconds)).cast("long")


def day_of(c: ColumnLike) -> Column:
    """ISO text date id."""
    return F.date_format(as_col(c), "yyyy-MM-dd")


def calendar_parts(c: ColumnLike) -> dict[str, Column]:
    """Calendar attributes of a date dimension row."""
    d = F.to_date(as_col(c))
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d),
            "day_of_week": F.date_format(d, "EEEE"), "is_weekend": F.weekday(d) >= 5}


# --- whole frames -------------------------------------------------------------------------------

def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL, dates and stamps become text."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)
        elif isinstance(field.dataType, _STAMPS):
            c = c.cast("string")
        out.append(c.alias(field.name))
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, so null checks see it."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), None).otherwise(c)
        out.append(c.alias(field.name))
    return df.select(*out)
