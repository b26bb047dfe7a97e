"""Column expressions (``Column -> Column``), all JVM built-ins.

Nothing here runs Python per row; every helper composes
``pyspark.sql.functions`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmart.functions.schemas import EVENT_SCHEMA

# Age bands (lower bound inclusive, upper exclusive) and labels.
AGE_BANDS = [(18, 25, "18-24"), (25, 35, "25-34"), (35, 45, "35-44"), (45, 55, "45-54")]
AGE_TOP_LABEL = ">=55"
AGE_TOP_FROM = 55
AGE_UNKNOWN = "Unknown"

# Work hours are [9, 18), evening hours are [18, 24).
WORK_HOURS = (9, 18)
EVENING_HOURS = (18, 24)

# Weekday labels as produced by the 'E' pattern, lower-cased.
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
WEEKDAY_PREFIX = "web_day_"
HOUR_PREFIX = "web_hour_"
WEEKDAY_COLUMNS = [WEEKDAY_PREFIX + d for d in WEEKDAYS]
HOUR_COLUMNS = [f"{HOUR_PREFIX}{h}" for h in range(24)]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def age_band(age: Column | str) -> Column:
    """Age -> band label; NULL and < 18 fall into ``Unknown``."""
    a = _c(age)
    expr = None
    for lo, hi, label in AGE_BANDS:
        cond = (a >= lo) & (a < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(a >= AGE_TOP_FROM, AGE_TOP_LABEL).otherwise(AGE_UNKNOWN)


def in_hours(hour: Column, bounds: tuple[int, int]) -> Column:
    """1 when ``hour`` lies in [lo, hi), else 0 (NULL hour gives 0)."""
    lo, hi = bounds
    return F.when((hour >= lo) & (hour < hi), F.lit(1)).otherwise(F.lit(0))


def work_hours_flag(ts: Column | str) -> Column:
    return in_hours(F.hour(_c(ts)), WORK_HOURS)


def evening_hours_flag(ts: Column | str) -> Column:
    return in_hours(F.hour(_c(ts)), EVENING_HOURS)


def normalize_name(name: Column | str, prefix: Column | str = "") -> Column:
    """``-`` and space -> ``_``, lower-case, then prefix.

    ``prefix`` is a literal string or a column (e.g. the event type plus
    ``_``). NULL names stay NULL, so callers can drop them before a pivot.
    """
    cleaned = F.lower(F.translate(_c(name), "- ", "__"))
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(p, cleaned)


def url_domain(url: Column | str) -> Column:
    """URL -> host, lower-cased, one leading ``www.`` removed.

    A malformed URL gives NULL (``try_parse_url``) instead of failing the
    job under ANSI mode; the dot after ``www`` is matched literally.
    """
    host = F.try_parse_url(_c(url), F.lit("HOST"))
    return F.regexp_replace(F.lower(host), r"^www\.", "")


def millis_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds (bigint) -> timestamp."""
    return F.timestamp_millis(_c(ms))


def ts_to_millis(ts: Column | str) -> Column:
    """Timestamp (with or without zone; session zone is UTC) -> epoch ms."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def day_key(ts: Column | str) -> Column:
    """Timestamp -> ``yyyyMMdd`` day key (session zone)."""
    return F.date_format(_c(ts), "yyyyMMdd")


def weekday_label(ts: Column | str) -> Column:
    """Timestamp -> ``web_day_mon`` .. ``web_day_sun``."""
    return F.concat(F.lit(WEEKDAY_PREFIX), F.lower(F.date_format(_c(ts), "E")))


def hour_label(ts: Column | str) -> Column:
    """Timestamp -> ``web_hour_0`` .. ``web_hour_23`` (no zero padding)."""
    return F.concat(F.lit(HOUR_PREFIX), F.hour(_c(ts)).cast("string"))


def decode_event(value: Column | str, schema=EVENT_SCHEMA) -> Column:
    """Message payload (binary or string) -> struct; malformed -> NULL fields."""
    return F.from_json(_c(value).cast("string"), schema)


def encode_row(*cols: Column | str) -> Column:
    """Row -> JSON text; NULL fields are left out of the text."""
    if not cols:
        cols = (F.col("*"),)
    return F.to_json(F.struct(*cols))
