"""Reference-shaped inputs derived from the driver tables.

The reference reads clients, shop visits, web logs and event messages from
external stores. Here they are derived, deterministically and lazily, from
the driver's parquet tables so that every query's work grows with them.
The same rules are restated in SQL in ``clickmart.oracle`` for the DuckDB
check. All derivations are projections, equi-joins and bounded groupings;
nothing is collected to the driver (counts used as modulus are scalar
subqueries evaluated by Spark).

Fixed values (the derivation rules, as documented in FIXTURES.md):
  uid                = 'u' || id
  client gender      = 'F' when c_custkey % 2 = 0 else 'M'
  client age         = NULL when c_custkey % 17 = 0 else 10 + (c_custkey * 37) % 71
  domain category    = 'cat_' || (length(domain) % 5); domains with length % 7 = 0 left out
  shop visit uid     = NULL when o_orderkey % 13 = 0; category = o_orderpriority
  visit page         = event_id % count(pages); malformed URL 'http://a b/[x' when event_id % 97 = 0
  event item         = part row event_id % count(part): item_id = p_name, category = p_type
  event item_price   = round(value); event_type 'purchase' is renamed 'buy'
  event uid          = NULL when event_id % 13 = 0
  edge web-log rows  = one more line per customer: empty visit list when c_custkey % 2 = 0, else NULL
  snapshot ranges    = day index < 2 (earlier snapshot), >= 2 (current)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart.functions import columns as C
from clickmart.functions.schemas import EVENT_SCHEMA, VISIT_STRUCT

# Fixed values (the fixture rules above).
MALFORMED_URL = "http://a b/[x"
# The driver table's name for a purchase event (renamed "buy").
RAW_BUY = "purchase"
MALFORMED_MESSAGE = '{"event_type": "buy", "item_price": '
# A user's visits of one day are grouped in chunks of at most this many
# consecutive event ids, so no web-log row (array) grows with the data.
VISIT_CHUNK = 4096
SNAPSHOT_SPLIT_DAY = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _uid(id_col: Column) -> Column:
    return F.concat(F.lit("u"), id_col.cast("string"))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid, gender, age``."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(
        _uid(k).alias("uid"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(10 + (k * 37) % 71).cast("int").alias("age"),
    )


def page_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, domain`` for every page."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.withColumn("domain", C.url_domain("url"))


def domain_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``domain, category`` (a domain catalogue; some domains absent)."""
    d = page_domains(spark, sf_dir).select("domain").where(F.col("domain").isNotNull()).distinct()
    n = F.length("domain")
    return d.where(n % 7 != 0).select(
        "domain", F.concat(F.lit("cat_"), (n % 5).cast("string")).alias("category")
    )


def shop_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid, category`` (one row per shop order)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(None).cast("string"))
        .otherwise(_uid(F.col("o_custkey")))
        .alias("uid"),
        F.col("o_orderpriority").alias("category"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _day_index(spark: SparkSession, sf_dir: str, ts: Column) -> Column:
    """Days since the first event day (scalar subquery, no driver collect)."""
    # to_date is monotonic, so the day of the earliest timestamp is the first day.
    first_day = _events(spark, sf_dir).select(F.to_date(F.min("ts"))).scalar()
    return F.datediff(F.to_date(ts), first_day)


def visit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat visits ``event_id, uid, url, timestamp, date`` (events x pages)."""
    e = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = table(spark, sf_dir, "pages").select(F.count(F.lit(1))).scalar()
    e = e.withColumn("page_id", F.col("event_id") % n_pages)
    j = e.join(pages, "page_id")
    return j.select(
        "event_id",
        _uid(F.col("user_id")).alias("uid"),
        F.when(F.col("event_id") % 97 == 0, F.lit(MALFORMED_URL)).otherwise(F.col("url")).alias("url"),
        C.ts_to_millis("ts").alias("timestamp"),
        C.day_key(F.col("ts").cast("timestamp")).alias("date"),
    )


def weblogs(spark: SparkSession, sf_dir: str, grouped: bool = False) -> DataFrame:
    """``uid, date, visits array<struct<url, timestamp>>``.

    A line has one visit, which costs no shuffle; with ``grouped``, all visits
    of a user, day and chunk of event ids (bounded arrays). Every customer adds
    one more line whose visit list is empty (even key) or NULL (odd key), which
    flattening must drop.
    """
    v = visit_rows(spark, sf_dir)
    visit = F.struct("url", "timestamp")
    if grouped:
        chunk = F.expr(f"event_id div {VISIT_CHUNK}")
        nested = v.groupBy("uid", "date", chunk.alias("chunk")).agg(F.collect_list(visit).alias("visits"))
        nested = nested.select("uid", "date", "visits")
    else:
        nested = v.select("uid", "date", F.array(visit).alias("visits"))
    c = table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    empty = F.array().cast(T.ArrayType(VISIT_STRUCT))
    edge = c.select(
        _uid(k).alias("uid"),
        F.lit(None).cast("string").alias("date"),
        F.when(k % 2 == 0, empty).otherwise(F.lit(None)).alias("visits"),
    )
    return nested.unionByName(edge)


def labelled_weblogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """web logs with ``gender_age`` = gender || ':' || age band."""
    cl = clients(spark, sf_dir).select(
        "uid", F.concat_ws(":", "gender", C.age_band("age")).alias("gender_age")
    )
    return weblogs(spark, sf_dir).join(cl, "uid")


def shop_events(spark: SparkSession, sf_dir: str, raw_types: tuple[str, ...] | None = None) -> DataFrame:
    """F5 fields as typed columns (the decoded form of the messages).

    ``raw_types`` filters on the driver table's own ``event_type`` values
    before the rename, so the filter reaches the parquet scan.
    """
    e = _events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type", "value")
    if raw_types is not None:
        e = e.where(F.col("event_type").isin(*raw_types))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    n_part = table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    e = e.withColumn("p_partkey", F.col("event_id") % n_part)
    j = e.join(part, "p_partkey")
    return j.select(
        "event_id",
        F.when(F.col("event_type") == RAW_BUY, F.lit("buy")).otherwise(F.col("event_type")).alias("event_type"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("item_id"),
        F.round("value").cast("long").alias("item_price"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None).cast("string"))
        .otherwise(_uid(F.col("user_id")))
        .alias("uid"),
        C.ts_to_millis("ts").alias("timestamp"),
        F.col("ts"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` = JSON text of one event, plus one malformed line."""
    ev = shop_events(spark, sf_dir)
    msgs = ev.select(C.encode_row(*[F.col(f.name) for f in EVENT_SCHEMA.fields]).alias("value"))
    bad = spark.range(1).select(F.lit(MALFORMED_MESSAGE).alias("value"))
    return msgs.unionByName(bad)


def split_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 rows: all views and buys with ``date`` and ``day_index``."""
    ev = shop_events(spark, sf_dir, raw_types=("view", RAW_BUY))
    day = _day_index(spark, sf_dir, F.col("ts"))
    return ev.select(
        *[f.name for f in EVENT_SCHEMA.fields],
        C.day_key(C.millis_to_ts("timestamp")).alias("date"),
        day.alias("day_index"),
    )
