"""Per-user feature table.

Columns: ``uid``, ``web_day_<mon..sun>``, ``web_hour_<0..23>``,
``web_fraction_work_hours``, ``web_fraction_evening_hours``,
``domain_features`` (visit counts over the top-N domains, alphabetical),
then the user-item matrix columns. A user must have a visit to a top
domain and a matrix row (inner joins).

Plan: visits are pre-aggregated once to ``(uid, domain, weekday, hour)``
counts, written once to the shared folder; the time features, the domain
counts and the top-N list are all derived from that one aggregate.
Weekday and hour are small integers in the aggregate; their names, and the
work and evening flags that follow from the hour, come after it. The top-N
list carries each domain's place, and a user's dense array is laid out from
its sorted (place, count) entries and the zeros between them. No Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.functions import columns as C
from clickmart.operators import visits as V
from clickmart.operators.ranking import staged, top_rows

TOP_DOMAINS = V.TOP_DOMAINS


def visit_cube(weblogs: DataFrame) -> DataFrame:
    """``uid, domain, day, hour, n``: known users' visits by weekday (0 = Monday) and hour."""
    v = V.with_domain(V.flatten_visits(weblogs)).where(F.col("domain").isNotNull() & F.col("uid").isNotNull())
    ts = C.millis_to_ts("timestamp")
    v = v.select("uid", "domain", F.weekday(ts).cast("tinyint").alias("day"), F.hour(ts).cast("tinyint").alias("hour"))
    return v.groupBy("uid", "domain", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


def time_features(cube: DataFrame) -> DataFrame:
    """Weekday and hour counts (0 when none) and work/evening fractions."""

    def total(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).cast("long")

    agg = cube.groupBy("uid").agg(
        *[total(F.col("day") == i).alias(c) for i, c in enumerate(C.WEEKDAY_COLUMNS)],
        *[total(F.col("hour") == i).alias(c) for i, c in enumerate(C.HOUR_COLUMNS)],
        total(C.in_hours(F.col("hour"), C.WORK_HOURS) == 1).alias("_work"),
        total(C.in_hours(F.col("hour"), C.EVENING_HOURS) == 1).alias("_evening"),
        F.sum("n").alias("_total"),
    )
    return agg.select(
        "uid",
        *C.WEEKDAY_COLUMNS,
        *C.HOUR_COLUMNS,
        F.try_divide(F.col("_work"), F.col("_total")).cast("double").alias("web_fraction_work_hours"),
        F.try_divide(F.col("_evening"), F.col("_total")).cast("double").alias("web_fraction_evening_hours"),
    )


def top_domain_list(cube: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """``domain, place`` of the ``n`` most visited domains, in alphabetical order."""
    counts = cube.groupBy("domain").agg(F.sum("n").alias("count"))
    # At most n entries, as many as every user's array has.
    names = top_rows(counts, n, "count", "domain").agg(F.array_sort(F.collect_list("domain")).alias("names"))
    return names.select(F.posexplode("names").alias("place", "domain")).select("domain", "place")


def domain_feature_array(cube: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """``uid, domain_features array<double>`` over the top-``n`` domains.

    Equal to a count vectoriser fitted on the users' top-domain lists with
    its vocabulary in alphabetical order. Users without a top domain are
    absent.
    """
    top = top_domain_list(cube, n)
    per_domain = cube.groupBy("uid", "domain").agg(F.sum("n").alias("n"))
    kept = per_domain.join(top, "domain")
    entry = F.struct("place", F.col("n").cast("double").alias("n"))
    per_user = kept.groupBy("uid").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    per_user = per_user.withColumn("width", top.select(F.count(F.lit(1))).scalar())
    e = F.col("e")
    before = F.transform(e, lambda x, i: x["place"] - F.when(i == 0, 0).otherwise(F.get(e, i - 1)["place"] + 1))
    per_user = per_user.withColumn("gaps", before)
    cells = F.transform(e, lambda x, i: F.concat(F.array_repeat(F.lit(0.0), F.get(F.col("gaps"), i)), F.array(x["n"])))
    tail = F.array_repeat(F.lit(0.0), (F.col("width") - F.element_at(e, -1)["place"] - 1).cast("int"))
    return per_user.select("uid", F.concat(F.flatten(cells), tail).alias("domain_features"))


def user_features(weblogs: DataFrame, item_matrix: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    cube = staged(visit_cube(weblogs), "visit-cube")
    t = time_features(cube)
    d = domain_feature_array(cube, n)
    return d.join(t, "uid").join(item_matrix, "uid")
