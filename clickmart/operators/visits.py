"""Web-log visit operators: flatten, domains, time labels, counts, top-N.

Per-user lists are built from counts per ``(uid, domain)`` first, so a
user's row holds at most one entry per distinct domain, never one entry per
visit: a user with a third of all visits still yields a bounded row, and
the counting itself is partially aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import columns as C
from clickmart.operators.ranking import top_rows

# Fixed value: width of the domain feature (top-N domains).
TOP_DOMAINS = 1000


def flatten_visits(weblogs: DataFrame, keep: tuple[str, ...] = ("uid",)) -> DataFrame:
    """One row per visit: ``keep..., url, timestamp``.

    ``explode`` drops lines whose visit list is NULL or empty.
    """
    keep = tuple(c for c in keep if c in weblogs.columns)
    return weblogs.select(*keep, F.explode("visits").alias("v")).select(
        *keep, F.col("v.url").alias("url"), F.col("v.timestamp").alias("timestamp")
    )


def with_domain(visits: DataFrame, url_col: str = "url") -> DataFrame:
    return visits.withColumn("domain", C.url_domain(url_col))


def visit_domains(weblogs: DataFrame, keep: tuple[str, ...] = ("uid",)) -> DataFrame:
    """``keep..., domain`` per visit (domain NULL for malformed URLs)."""
    v = flatten_visits(weblogs, keep)
    return v.select(*[c for c in keep if c in v.columns], C.url_domain("url").alias("domain"))


def with_time_labels(visits: DataFrame, ts_ms: str = "timestamp") -> DataFrame:
    """Adds ``web_week_day, web_hour, work_hours, evening_hours``."""
    ts = C.millis_to_ts(ts_ms)
    return visits.select(
        "*",
        C.weekday_label(ts).alias("web_week_day"),
        C.hour_label(ts).alias("web_hour"),
        C.work_hours_flag(ts).alias("work_hours"),
        C.evening_hours_flag(ts).alias("evening_hours"),
    )


def clean_visits(weblogs: DataFrame) -> DataFrame:
    """Known users' visits with a domain, plus time labels.

    ``uid, domain, timestamp, web_week_day, web_hour, work_hours, evening_hours``
    """
    v = with_domain(flatten_visits(weblogs))
    v = v.where(F.col("domain").isNotNull() & F.col("uid").isNotNull())
    return with_time_labels(v.select("uid", "domain", "timestamp"))


def domain_counts(visits: DataFrame) -> DataFrame:
    """``domain, count`` (partial aggregation before the shuffle)."""
    return visits.where(F.col("domain").isNotNull()).groupBy("domain").count()


def top_domains(visits: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """The ``n`` most visited domains, returned alphabetically.

    Ties on the count are broken by domain so the set is stable. The limit
    is the feature; a cut-off count is found first (``ranking.top_rows``).
    """
    return top_rows(domain_counts(visits), n, "count", "domain").orderBy("domain")


def visits_to_top_domains(visits: DataFrame, top: DataFrame) -> DataFrame:
    """Visits whose domain is in ``top`` (left semi join).

    Whether the list is broadcast is left to AQE, which knows its size.
    """
    return visits.join(top.select("domain"), "domain", "left_semi")


def user_domain_counts(visits: DataFrame, keys: tuple[str, ...] = ("uid",)) -> DataFrame:
    """``keys..., domain, n``: visits per key and domain (NULL domains kept)."""
    return visits.groupBy(*keys, "domain").agg(F.count(F.lit(1)).alias("n"))


def user_domain_lists(visits: DataFrame, keys: tuple[str, ...] = ("uid",)) -> DataFrame:
    """Per-key domain list as a sorted bag ``domains: array<struct<domain, n>>``.

    Equal, as a multiset, to collecting every visited domain: domain ``d``
    with ``n`` visits stands for ``n`` copies. NULL domains are skipped, so
    a key whose visits all lack a domain gets an empty list.
    """
    counts = user_domain_counts(visits, keys)
    entry = F.when(F.col("domain").isNotNull(), F.struct("domain", "n"))
    return counts.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("domains"))
