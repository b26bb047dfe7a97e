"""Registered queries: one per operator or job, each with its DuckDB oracle.

Every query reads the driver tables in ``sf_dir`` (or data Spark derives
from them) in full. Queries that write (partitioned splits, snapshots,
models) stage their output under the shared folder from
``spark.checkpoint.dir`` and return the read-back frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import oracle as O
from clickmart.functions import columns as C
from clickmart.functions.schemas import DATED_WEBLOG_SCHEMA, EVENT_SCHEMA
from clickmart.operators import checks, matrix, metrics, pivots, ranking, snapshots, visits
from clickmart.operators import events as E
from clickmart.plans import features, mart, matrix_job, model, split
from clickmart.session import prepare, staging_path
from clickmart.sources import derived as D
from clickmart.sources import files
from clickmart.streaming import metrics_stream, scoring_stream, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return deco


# ---------------------------------------------------------------- metrics

HOURLY_SQL = O.with_ctes(
    ["shop_events"],
    """
SELECT (timestamp // 3600000) * 3600 AS start_ts,
       (timestamp // 3600000) * 3600 + 3600 AS end_ts,
       CAST(sum(CASE WHEN event_type = 'buy' THEN item_price END) AS BIGINT) AS revenue,
       CAST(sum(CASE WHEN uid IS NOT NULL THEN 1 END) AS BIGINT) AS visitors,
       CAST(sum(CASE WHEN event_type = 'buy' THEN 1 END) AS BIGINT) AS purchases,
       CAST(sum(CASE WHEN event_type = 'buy' THEN item_price END) AS DOUBLE)
         / sum(CASE WHEN event_type = 'buy' THEN 1 END) AS aov
FROM shop_events
GROUP BY 1, 2""",
)


@register("hourly_metrics", HOURLY_SQL)
def q_hourly_metrics(spark, sf_dir):
    """Hourly revenue, visitors, purchases, aov (batch)."""
    return metrics.hourly_metrics(D.shop_events(spark, sf_dir))


# ---------------------------------------------------------------- shared SQL

SHOP_CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
WEB_CATEGORIES = [f"cat_{i}" for i in range(5)]


def _shop_col(v: str) -> str:
    return "shop_" + v.replace("-", "_").replace(" ", "_").lower()


SHOP_PIVOT_SQL_COLS = ", ".join(
    f"CAST(sum(CASE WHEN category = '{v}' THEN 1 END) AS BIGINT) AS {_shop_col(v)}" for v in SHOP_CATEGORIES
)
WEB_PIVOT_SQL_COLS = ", ".join(
    f"CAST(sum(CASE WHEN category = '{v}' THEN 1 END) AS BIGINT) AS web_{v}" for v in WEB_CATEGORIES
)

SHOP_PIVOT_CTE = f"""
  shop_pivot AS (
    SELECT uid, {SHOP_PIVOT_SQL_COLS}
    FROM shop_visits WHERE uid IS NOT NULL AND category IS NOT NULL GROUP BY uid)"""
WEB_ROWS_CTE = """
  web_rows AS (
    SELECT v.uid, v.domain, c.category
    FROM visit_domains v JOIN domain_cats c ON c.domain = v.domain
    WHERE v.uid IS NOT NULL)"""
WEB_PIVOT_CTE = f"""
  web_pivot AS (
    SELECT uid, {WEB_PIVOT_SQL_COLS} FROM web_rows GROUP BY uid)"""


def _sql(ctes: list[str], extra: str, body: str) -> str:
    """``with_ctes`` plus extra hand-written CTEs (``extra`` starts with ',')."""
    base = O.with_ctes(ctes, "")
    return base.rstrip("\n") + extra + "\n" + body


def item_cells_sql(where: str = "TRUE") -> str:
    """Non-zero cells of a zero-filled item matrix, with each row's width, zeros and nulls."""
    return f"""
SELECT c.uid, c.item_name, c.n, w.width, w.width - count(*) OVER (PARTITION BY c.uid) AS zeros, CAST(0 AS BIGINT) AS nulls
FROM (SELECT uid, item_name, count(*) AS n FROM item_rows WHERE {where} GROUP BY uid, item_name) c,
     (SELECT count(DISTINCT item_name) AS width FROM item_rows WHERE {where}) w"""


def union_cells_sql() -> str:
    """The same of both parts' matrices under one another: items of the other part only are NULL."""
    return """
SELECT c.uid, c.item_name, c.n, w.width, p.own - count(*) OVER (PARTITION BY c.uid, c.part) AS zeros, w.width - p.own AS nulls
FROM (SELECT uid, item_name, day_index < 2 AS part, count(*) AS n FROM item_rows GROUP BY ALL) c
JOIN (SELECT day_index < 2 AS part, count(DISTINCT item_name) AS own FROM item_rows GROUP BY 1) p ON p.part = c.part,
     (SELECT count(DISTINCT item_name) AS width FROM item_rows) w"""


def found_cells_sql(rows_sql: str) -> str:
    """Cells of a pivot whose columns are found in the data."""
    return f"""
SELECT uid, name, n, width, width - count(*) OVER (PARTITION BY uid) AS nulls
FROM (SELECT uid, name, count(*) AS n FROM ({rows_sql}) GROUP BY uid, name), (SELECT count(DISTINCT name) AS width FROM ({rows_sql}))"""


def _cells(df: DataFrame, names: list[str], keep) -> tuple[Column, Column, Column]:
    """The kept cells of a wide row as sorted structs of column name and value, and how many are zero and NULL."""
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").cast("long").alias("n")) for c in names])
    zeros = F.size(F.filter(cells, lambda x: x["n"] == 0)).cast("long")
    nulls = F.size(F.filter(cells, lambda x: x["n"].isNull())).cast("long")
    return F.array_sort(F.filter(cells, lambda x: keep(x["n"]))), zeros, nulls


def cells_of(df: DataFrame, name: str = "item_name") -> DataFrame:
    """A wide matrix as its non-zero, non-NULL cells, with width, zeros and nulls of the row each is from."""
    names = [c for c in df.columns if c != "uid"]
    cells, zeros, nulls = _cells(df, names, lambda n: n.isNotNull() & (n != 0))
    rows = df.select("uid", cells.alias("cells"), zeros.alias("zeros"), nulls.alias("nulls"))
    rows = rows.select("uid", F.explode("cells").alias("cell"), "zeros", "nulls")
    return rows.select("uid", F.col("cell.name").alias(name), F.col("cell.n").alias("n"), F.lit(len(names)).cast("long").alias("width"), "zeros", "nulls")


# ---------------------------------------------------------------- columns


@register(
    "age_band",
    O.with_ctes(["clients_banded"], "SELECT uid, gender, age, age_cat FROM clients_banded"),
)
def q_age_band(spark, sf_dir):
    """Age bands of all clients."""
    c = D.clients(spark, sf_dir)
    return c.select("uid", "gender", "age", C.age_band("age").alias("age_cat"))


@register(
    "hour_flags",
    O.with_ctes(["clean_visits"], "SELECT uid, timestamp, work_hours, evening_hours FROM clean_visits"),
)
def q_hour_flags(spark, sf_dir):
    """Work / evening hour flags per visit."""
    v = visits.clean_visits(D.weblogs(spark, sf_dir))
    return v.select("uid", "timestamp", "work_hours", "evening_hours")


@register(
    "filter_known_users",
    O.with_ctes(["shop_visits"], "SELECT uid, category FROM shop_visits WHERE uid IS NOT NULL"),
)
def q_filter_known_users(spark, sf_dir):
    """Shop visits with a known uid."""
    return D.shop_visits(spark, sf_dir).where(F.col("uid").isNotNull())


EVENT_COLS = "event_type, category, item_id, item_price, uid, timestamp"


@register(
    "filter_event_type",
    O.with_ctes(["shop_events"], f"SELECT {EVENT_COLS} FROM shop_events WHERE event_type = 'view'"),
)
def q_filter_event_type(spark, sf_dir):
    """P5 + P9: decoded messages of one event type."""
    return E.filter_event_type(E.decode_events(D.event_messages(spark, sf_dir)), "view")


@register(
    "normalize_names",
    O.with_ctes(
        ["shop_visits", "item_rows"],
        """
SELECT DISTINCT category AS raw_name,
       'shop_' || lower(replace(replace(category, '-', '_'), ' ', '_')) AS name
FROM shop_visits WHERE category IS NOT NULL
UNION ALL
SELECT DISTINCT event_type || ':' || item_id AS raw_name,
       event_type || '_' || lower(replace(replace(item_id, '-', '_'), ' ', '_')) AS name
FROM split_visits WHERE item_id IS NOT NULL""",
    ),
)
def q_normalize_names(spark, sf_dir):
    """Cleaned column names for shop categories and items."""
    shop = D.shop_visits(spark, sf_dir).where(F.col("category").isNotNull())
    a = shop.select(F.col("category").alias("raw_name"), C.normalize_name("category", "shop_").alias("name")).distinct()
    sv = D.split_visits(spark, sf_dir).where(F.col("item_id").isNotNull())
    b = sv.select(
        F.concat_ws(":", "event_type", "item_id").alias("raw_name"),
        C.normalize_name("item_id", F.concat(F.col("event_type"), F.lit("_"))).alias("name"),
    ).distinct()
    return a.unionByName(b)


@register("flatten_visits", O.with_ctes(["visits"], "SELECT uid, url, timestamp FROM visits"))
def q_flatten_visits(spark, sf_dir):
    """One row per visit; NULL/empty visit lists give no row."""
    return visits.flatten_visits(D.weblogs(spark, sf_dir, grouped=True))


@register("visit_domains", O.with_ctes(["visit_domains"], "SELECT uid, domain FROM visit_domains"))
def q_visit_domains(spark, sf_dir):
    """URL host -> domain per visit (NULL for malformed URLs)."""
    return visits.visit_domains(D.weblogs(spark, sf_dir))


@register(
    "decode_event_json",
    O.with_ctes(
        ["shop_events"],
        f"""
SELECT {EVENT_COLS} FROM shop_events
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL""",
    ),
)
def q_decode_event_json(spark, sf_dir):
    """JSON messages -> typed events (malformed line -> NULL row)."""
    return E.decode_events(D.event_messages(spark, sf_dir))


@register(
    "event_day_key",
    O.with_ctes(["shop_events"], "SELECT uid, timestamp, strftime(ts, '%Y%m%d') AS date FROM shop_events"),
)
def q_event_day_key(spark, sf_dir):
    """Epoch ms -> yyyyMMdd day key."""
    ev = E.decode_events(D.event_messages(spark, sf_dir)).where(F.col("timestamp").isNotNull())
    return E.with_day_key(ev).select("uid", "timestamp", "date")


@register(
    "visit_time_labels",
    O.with_ctes(["clean_visits"], "SELECT uid, domain, web_week_day, web_hour FROM clean_visits"),
)
def q_visit_time_labels(spark, sf_dir):
    """Weekday and hour labels per visit."""
    v = visits.clean_visits(D.weblogs(spark, sf_dir))
    return v.select("uid", "domain", "web_week_day", "web_hour")


@register(
    "hour_fractions",
    O.with_ctes(
        ["clean_visits"],
        """
SELECT uid,
       CAST(sum(work_hours) AS DOUBLE) / count(*) AS web_fraction_work_hours,
       CAST(sum(evening_hours) AS DOUBLE) / count(*) AS web_fraction_evening_hours
FROM clean_visits GROUP BY uid""",
    ),
)
def q_hour_fractions(spark, sf_dir):
    """Share of a user's visits in work and evening hours."""
    return pivots.hour_fractions(visits.clean_visits(D.weblogs(spark, sf_dir)))


# ---------------------------------------------------------------- joins, pivots, mart


@register(
    "join_domain_category",
    _sql(["visit_domains", "domain_cats"], "," + WEB_ROWS_CTE, "SELECT uid, domain, category FROM web_rows"),
)
def q_join_domain_category(spark, sf_dir):
    """Known users' visits joined to the domain catalogue (inner)."""
    return mart.web_category_visits(D.weblogs(spark, sf_dir), D.domain_categories(spark, sf_dir))


@register(
    "join_domain_category_spread",
    _sql(["visit_domains", "domain_cats"], "," + WEB_ROWS_CTE, "SELECT uid, domain, category FROM web_rows"),
)
def q_join_domain_category_spread(spark, sf_dir):
    """The same join with the visits of hot domains, found by a sketch, spread over tasks."""
    return mart.web_category_visits(D.weblogs(spark, sf_dir), D.domain_categories(spark, sf_dir), spread_hot=True)


@register("shop_category_pivot", _sql(["shop_visits"], "," + SHOP_PIVOT_CTE, "SELECT * FROM shop_pivot"))
def q_shop_category_pivot(spark, sf_dir):
    """A2: user x shop category counts (NULL when none)."""
    return mart.shop_pivot(D.shop_visits(spark, sf_dir), SHOP_CATEGORIES)


@register(
    "web_category_pivot",
    _sql(["visit_domains", "domain_cats"], "," + WEB_ROWS_CTE + "," + WEB_PIVOT_CTE, "SELECT * FROM web_pivot"),
)
def q_web_category_pivot(spark, sf_dir):
    """A2: user x web category counts (NULL when none)."""
    return mart.web_pivot(D.weblogs(spark, sf_dir), D.domain_categories(spark, sf_dir), WEB_CATEGORIES)


MART_SQL = _sql(
    ["clients_banded", "shop_visits", "visit_domains", "domain_cats"],
    "," + SHOP_PIVOT_CTE + "," + WEB_ROWS_CTE + "," + WEB_PIVOT_CTE
    + """,
  mart AS (
    SELECT c.uid, c.gender, c.age_cat, s.* EXCLUDE (uid), w.* EXCLUDE (uid)
    FROM clients_banded c
    LEFT JOIN shop_pivot s ON s.uid = c.uid
    LEFT JOIN web_pivot w ON w.uid = c.uid)""",
    "SELECT * FROM mart",
)


def _mart(spark, sf_dir):
    return mart.customer_mart(
        D.clients(spark, sf_dir),
        D.shop_visits(spark, sf_dir),
        D.weblogs(spark, sf_dir),
        D.domain_categories(spark, sf_dir),
        SHOP_CATEGORIES,
        WEB_CATEGORIES,
    )


@register("customer_mart", MART_SQL)
def q_customer_mart(spark, sf_dir):
    """Every client with shop and web category counts."""
    return _mart(spark, sf_dir)


@register(
    "count_by_segment",
    MART_SQL.replace("SELECT * FROM mart", "SELECT gender, age_cat, count(*) AS count FROM mart GROUP BY gender, age_cat"),
)
def q_count_by_segment(spark, sf_dir):
    """A1: mart rows per (gender, age band)."""
    return mart.count_by_segment(_mart(spark, sf_dir))


@register(
    "domain_counts",
    O.with_ctes(["clean_visits"], "SELECT domain, count(*) AS count FROM clean_visits GROUP BY domain"),
)
def q_domain_counts(spark, sf_dir):
    """A1: visits per domain (known users, parsable URLs)."""
    return visits.domain_counts(visits.clean_visits(D.weblogs(spark, sf_dir)))


TOP_CTE = """,
  top AS (
    SELECT domain, count FROM (SELECT domain, count(*) AS count FROM clean_visits GROUP BY domain)
    ORDER BY count DESC, domain LIMIT 1000)"""


@register("top_domains", _sql(["clean_visits"], TOP_CTE, "SELECT domain, count FROM top"))
def q_top_domains(spark, sf_dir):
    """The 1000 most visited domains, alphabetical."""
    return visits.top_domains(visits.clean_visits(D.weblogs(spark, sf_dir)))


@register(
    "visits_to_top_domains",
    _sql(
        ["clean_visits"],
        TOP_CTE,
        "SELECT uid, domain FROM clean_visits WHERE domain IN (SELECT domain FROM top)",
    ),
)
def q_visits_to_top_domains(spark, sf_dir):
    """Visits restricted to the top domains (left semi join)."""
    clean = visits.clean_visits(D.weblogs(spark, sf_dir))
    return visits.visits_to_top_domains(clean, visits.top_domains(clean)).select("uid", "domain")


@register(
    "user_domain_lists",
    O.with_ctes(
        ["clean_visits"],
        """
SELECT uid, list_sort(list({'domain': domain, 'n': n})) AS domains
FROM (SELECT uid, domain, count(*) AS n FROM clean_visits GROUP BY uid, domain)
GROUP BY uid""",
    ),
)
def q_user_domain_lists(spark, sf_dir):
    """Per-user domain list (as a sorted bag of domain counts)."""
    return visits.user_domain_lists(visits.clean_visits(D.weblogs(spark, sf_dir)))


WEEKDAY_SQL = O.with_ctes(["clean_visits"], f"SELECT uid, {O.weekday_cols()} FROM clean_visits GROUP BY uid")
HOUR_SQL = O.with_ctes(["clean_visits"], f"SELECT uid, {O.hour_cols()} FROM clean_visits GROUP BY uid")


@register("weekday_pivot", WEEKDAY_SQL)
def q_weekday_pivot(spark, sf_dir):
    """A4: user x weekday visit counts."""
    return pivots.weekday_pivot(visits.clean_visits(D.weblogs(spark, sf_dir)))


@register("hour_pivot", HOUR_SQL)
def q_hour_pivot(spark, sf_dir):
    """A4: user x hour visit counts."""
    return pivots.hour_pivot(visits.clean_visits(D.weblogs(spark, sf_dir)))


DFEAT_CTE = TOP_CTE + """,
  ucounts AS (
    SELECT uid, domain, count(*) AS n FROM clean_visits
    WHERE domain IN (SELECT domain FROM top) GROUP BY uid, domain),
  dfeat AS (
    SELECT u.uid, list(CAST(coalesce(c.n, 0) AS DOUBLE) ORDER BY t.domain) AS domain_features
    FROM (SELECT DISTINCT uid FROM ucounts) u CROSS JOIN top t
    LEFT JOIN ucounts c ON c.uid = u.uid AND c.domain = t.domain
    GROUP BY u.uid)"""


@register("domain_feature_array", _sql(["clean_visits"], DFEAT_CTE, "SELECT uid, domain_features FROM dfeat"))
def q_domain_feature_array(spark, sf_dir):
    """M2: per-user visit counts over the top domains, alphabetical order."""
    return features.domain_feature_array(ranking.staged(features.visit_cube(D.weblogs(spark, sf_dir)), "visit-cube"))


_TFEAT_COLS = ", ".join(
    [f"CAST(coalesce(sum(CASE WHEN web_week_day = '{c}' THEN 1 END), 0) AS BIGINT) AS {c}" for c in C.WEEKDAY_COLUMNS]
    + [f"CAST(coalesce(sum(CASE WHEN web_hour = '{c}' THEN 1 END), 0) AS BIGINT) AS {c}" for c in C.HOUR_COLUMNS]
)
FEATURES_SQL = _sql(
    ["clean_visits", "item_rows"],
    DFEAT_CTE
    + f""",
  tfeat AS (
    SELECT uid, {_TFEAT_COLS},
           CAST(sum(work_hours) AS DOUBLE) / count(*) AS web_fraction_work_hours,
           CAST(sum(evening_hours) AS DOUBLE) / count(*) AS web_fraction_evening_hours
    FROM clean_visits GROUP BY uid)""",
    f"""SELECT * FROM dfeat JOIN tfeat USING (uid)
JOIN (SELECT uid, list_sort(list({{'name': item_name, 'n': n}})) AS items, any_value(width) AS width, any_value(zeros) AS zeros, any_value(nulls) AS nulls
      FROM ({item_cells_sql()}) GROUP BY uid) m USING (uid)""",
)


@register("user_features", FEATURES_SQL)
def q_user_features(spark, sf_dir):
    """Feature table = domain counts x time features x item matrix.

    The item columns come back as the row's sorted non-zero cells."""
    return _feature_cells(D.weblogs(spark, sf_dir), matrix.user_item_matrix(D.split_visits(spark, sf_dir)))


def _feature_cells(weblogs: DataFrame, m: DataFrame) -> DataFrame:
    names = [c for c in m.columns if c != "uid"]
    wide = features.user_features(weblogs, m)
    cells, zeros, nulls = _cells(wide, names, lambda n: n.isNotNull() & (n != 0))
    fixed = [c for c in wide.columns if c not in set(names)]
    return wide.select(*fixed, cells.alias("items"), F.lit(len(names)).cast("long").alias("width"), zeros.alias("zeros"), nulls.alias("nulls"))


@register("user_features_bucketed", FEATURES_SQL)
def q_user_features_bucketed(spark, sf_dir):
    """The feature table from a matrix stored in buckets of users, which the join doesn't shuffle."""
    path = staging_path(spark, "matrix-buckets")
    table = "matrix_" + path.rsplit("-", 1)[1]
    m = matrix.user_item_matrix(D.split_visits(spark, sf_dir))
    stored = snapshots.write_bucketed(m, table, path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _feature_cells(D.weblogs(spark, sf_dir), stored)


# ---------------------------------------------------------------- item matrix


@register("user_item_matrix", O.with_ctes(["item_rows"], item_cells_sql()))
def q_user_item_matrix(spark, sf_dir):
    """A3: user x item view/buy counts, item list found by Spark, 0-filled."""
    return cells_of(matrix.user_item_matrix(D.split_visits(spark, sf_dir)))


@register("latest_day", O.with_ctes(["split_visits"], "SELECT max(date) AS max_date FROM split_visits"))
def q_latest_day(spark, sf_dir):
    """A5: newest day key."""
    return matrix.latest_day(D.split_visits(spark, sf_dir))


@register("distinct_days", O.with_ctes(["split_visits"], "SELECT DISTINCT date FROM split_visits"))
def q_distinct_days(spark, sf_dir):
    """Distinct day keys."""
    return E.distinct_days(D.split_visits(spark, sf_dir))


@register("distinct_items", O.with_ctes(["item_rows"], "SELECT DISTINCT item_name FROM item_rows"))
def q_distinct_items(spark, sf_dir):
    """Distinct item column names."""
    return matrix.item_rows(D.split_visits(spark, sf_dir)).select("item_name").distinct()


@register(
    "union_matrices",
    O.with_ctes(["item_rows"], union_cells_sql()),
)
def q_union_matrices(spark, sf_dir):
    """Union of two matrices with different item columns."""
    sv = D.split_visits(spark, sf_dir)
    a = matrix.user_item_matrix(sv.where(F.col("day_index") >= D.SNAPSHOT_SPLIT_DAY))
    b = matrix.user_item_matrix(sv.where(F.col("day_index") < D.SNAPSHOT_SPLIT_DAY))
    return cells_of(matrix.union_matrices(a, b))


@register(
    "events_newest_first",
    O.with_ctes(["split_visits"], f"SELECT {EVENT_COLS}, date FROM split_visits ORDER BY date DESC"),
)
def q_events_newest_first(spark, sf_dir):
    """Events ordered by day, newest first."""
    return E.newest_first(D.split_visits(spark, sf_dir).drop("day_index"))


# ---------------------------------------------------------------- writes and read-backs

SPLIT_COLS = ["event_type", "category", "item_id", "item_price", "uid", "timestamp", "date"]
SPLIT_SQL = O.with_ctes(
    ["shop_events"],
    f"SELECT {EVENT_COLS}, strftime(ts, '%Y%m%d') AS date FROM shop_events WHERE event_type IN ('view', 'buy')",
)


@register("split_events_by_type_day", SPLIT_SQL)
def q_split_events_by_type_day(spark, sf_dir):
    """Messages decoded, written per type/day, read back."""
    out = staging_path(spark, "split")
    split.split_events(D.event_messages(spark, sf_dir), out)
    return files.read_split_events(spark, out).select(*SPLIT_COLS)


@register("overwrite_partitions", SPLIT_SQL)
def q_overwrite_partitions(spark, sf_dir):
    """K3: a rerun over part of the days replaces those partitions only."""
    out = staging_path(spark, "overwrite")
    msgs = D.event_messages(spark, sf_dir)
    split.split_events(msgs, out)
    first_day = split.decoded_events(msgs).select(F.min("date")).scalar()
    rerun = split.decoded_events(msgs).where(F.col("date") == first_day)
    files.write_split_events(rerun, out)
    return files.read_split_events(spark, out).select(*SPLIT_COLS)


def _write_split_visits(spark, sf_dir, name, where=None):
    sv = D.split_visits(spark, sf_dir)
    if where is not None:
        sv = sv.where(where)
    out = staging_path(spark, name)
    files.write_split_events(sv.drop("day_index"), out, types=None)
    return out


@register(
    "scan_visits_json",
    O.with_ctes(["split_visits"], f"SELECT {EVENT_COLS}, date FROM split_visits"),
)
def q_scan_visits_json(spark, sf_dir):
    """Split event files read with a fixed schema (type/day from folders)."""
    out = _write_split_visits(spark, sf_dir, "visits")
    return files.read_split_events(spark, out).select(*SPLIT_COLS)


WEBLOG_SQL = O.with_ctes(
    ["visits"],
    f"""
SELECT uid, date, list_sort(list({{'url': url, 'timestamp': timestamp}})) AS visits
FROM visits GROUP BY uid, date, event_id // {D.VISIT_CHUNK}
UNION ALL
SELECT 'u' || c_custkey AS uid, NULL AS date,
       CASE WHEN c_custkey % 2 = 0 THEN []::STRUCT(url VARCHAR, "timestamp" BIGINT)[] ELSE NULL END AS visits
FROM customer""",
)


@register("scan_weblogs_json", WEBLOG_SQL)
def q_scan_weblogs_json(spark, sf_dir):
    """Web logs written as JSON lines and read back (fixed schema)."""
    out = staging_path(spark, "weblogs")
    files.write_json(D.weblogs(spark, sf_dir, grouped=True), out)
    w = files.read_weblogs(spark, out, DATED_WEBLOG_SCHEMA)
    return w.select("uid", "date", F.array_sort("visits").alias("visits"))


@register("snapshot_roundtrip", O.with_ctes(["item_rows"], item_cells_sql()))
def q_snapshot_roundtrip(spark, sf_dir):
    """K4/S3: matrix written as a dated parquet snapshot and read back."""
    sv = D.split_visits(spark, sf_dir)
    out = staging_path(spark, "matrix")
    day = matrix.latest_day(sv).first()[0]
    path = matrix.write_snapshot(matrix.user_item_matrix(sv), out, day)
    return cells_of(files.read_parquet(spark, path))


def _write_earlier_snapshot(spark, sf_dir):
    sv = D.split_visits(spark, sf_dir).where(F.col("day_index") < D.SNAPSHOT_SPLIT_DAY)
    out = staging_path(spark, "users-items")
    day = matrix.latest_day(sv).first()[0]
    matrix.write_snapshot(matrix.user_item_matrix(sv), out, day)
    return out


@register("previous_snapshot", O.with_ctes(["item_rows"], item_cells_sql("day_index < 2")))
def q_previous_snapshot(spark, sf_dir):
    """Newest snapshot strictly older than the current day."""
    out = _write_earlier_snapshot(spark, sf_dir)
    current = matrix.latest_day(D.split_visits(spark, sf_dir)).first()[0]
    return cells_of(matrix.previous_snapshot(spark, out, current))


@register(
    "carry_over_matrix",
    O.with_ctes(["item_rows"], union_cells_sql()),
)
def q_carry_over_matrix(spark, sf_dir):
    """Current matrix plus the previous snapshot, written and read back."""
    out = _write_earlier_snapshot(spark, sf_dir)
    inp = _write_split_visits(spark, sf_dir, "visits-current", F.col("day_index") >= D.SNAPSHOT_SPLIT_DAY)
    path = matrix_job.users_items(spark, inp, out, update=True)
    return cells_of(files.read_parquet(spark, path))


def _snapshot_days(spark, sf_dir):
    """Both parts of the visits, the earlier written as a snapshot of a dataset; the root, the later part and the newest day."""
    sv = D.split_visits(spark, sf_dir)
    old, new = sv.where(F.col("day_index") < D.SNAPSHOT_SPLIT_DAY), sv.where(F.col("day_index") >= D.SNAPSHOT_SPLIT_DAY)
    root = staging_path(spark, "snapshots")
    snapshots.add_snapshot(spark, matrix.user_item_matrix(old), root, matrix.latest_day(old).first()[0])
    return root, new, matrix.latest_day(new).first()[0]


@register("snapshot_dataset_previous", O.with_ctes(["item_rows"], item_cells_sql("day_index < 2")))
def q_snapshot_dataset_previous(spark, sf_dir):
    """Newest snapshot strictly older than the newest day, from a dataset that already holds that day's own snapshot."""
    root, new, day = _snapshot_days(spark, sf_dir)
    snapshots.add_snapshot(spark, matrix.user_item_matrix(new), root, day)
    return cells_of(snapshots.previous_snapshot(spark, root, day))


@register("snapshot_dataset_carry_over", O.with_ctes(["item_rows"], union_cells_sql()))
def q_snapshot_dataset_carry_over(spark, sf_dir):
    """The newest day's matrix with the rows of the snapshot before, added to a dataset of snapshots."""
    root, new, day = _snapshot_days(spark, sf_dir)
    return cells_of(snapshots.add_snapshot(spark, matrix.user_item_matrix(new), root, day))


# Every snapshot of the dataset read at once: an item that a snapshot lacks is NULL there.
SNAPSHOT_ROWS_SQL = O.with_ctes(
    ["item_rows", "split_visits"],
    """
SELECT CAST(p.day AS INTEGER) AS snapshot, c.uid, c.item_name, c.n
FROM (SELECT uid, item_name, day_index < 2 AS part, count(*) AS n FROM item_rows GROUP BY ALL) c
JOIN (SELECT TRUE AS part, (SELECT max(date) FROM split_visits WHERE day_index < 2) AS day
      UNION ALL SELECT TRUE, (SELECT max(date) FROM split_visits WHERE day_index >= 2)
      UNION ALL SELECT FALSE, (SELECT max(date) FROM split_visits WHERE day_index >= 2)) p ON p.part = c.part""",
)


@register("snapshot_dataset_read", SNAPSHOT_ROWS_SQL)
def q_snapshot_dataset_read(spark, sf_dir):
    """S3/K4: all snapshots of a dataset in one read with one merged schema, as non-zero cells by snapshot."""
    root, new, day = _snapshot_days(spark, sf_dir)
    snapshots.add_snapshot(spark, matrix.user_item_matrix(new), root, day)
    every = snapshots.read_snapshots(spark, root)
    names = [c for c in every.columns if c not in ("uid", snapshots.SNAPSHOT)]
    cells, _, _ = _cells(every, names, lambda n: n.isNotNull() & (n != 0))
    rows = every.select(snapshots.SNAPSHOT, "uid", F.explode(cells).alias("cell"))
    return rows.select(snapshots.SNAPSHOT, "uid", F.col("cell.name").alias("item_name"), F.col("cell.n").alias("n"))


def _json_field(name: str, nullable: bool = True) -> str:
    v = f"',\"{name}\":' || CAST({name} AS VARCHAR)"
    return f"coalesce({v}, '')" if nullable else v


ENCODE_SQL = (
    "SELECT '{\"start_ts\":' || CAST(start_ts AS VARCHAR) || "
    + " || ".join([_json_field("end_ts", False), _json_field("revenue"), _json_field("visitors"),
                   _json_field("purchases"), _json_field("aov")])
    + " || '}' AS value FROM (" + HOURLY_SQL + ") m"
)


@register("encode_metrics_json", ENCODE_SQL)
def q_encode_metrics_json(spark, sf_dir):
    """P10: metrics rows as JSON text (NULL fields left out)."""
    return metrics.metrics_json(metrics.hourly_metrics(D.shop_events(spark, sf_dir)))


# ---------------------------------------------------------------- model

LABEL_USERS_CTE = """,
  users AS (
    SELECT DISTINCT v.uid, c.gender || ':' || c.age_cat AS gender_age
    FROM clean_visits v JOIN clients_banded c ON c.uid = v.uid)"""


def _labelled_bags(spark, sf_dir):
    return model.labelled_bags(D.labelled_weblogs(spark, sf_dir))


@register(
    "label_index",
    _sql(
        ["clean_visits", "clients_banded"],
        LABEL_USERS_CTE,
        """SELECT gender_age,
       CAST(row_number() OVER (ORDER BY count(*) DESC, gender_age) - 1 AS DOUBLE) AS label
FROM users GROUP BY gender_age""",
    ),
)
def q_label_index(spark, sf_dir):
    """M3: label -> index, by user frequency (ties alphabetical)."""
    users = _labelled_bags(spark, sf_dir).select("uid", model.LABEL).distinct()
    idx = model.label_indexer(users).fit(users)
    return idx.transform(users).select(model.LABEL, "label").distinct()


@register(
    "train_test_split",
    _sql(
        ["clean_visits", "clients_banded"],
        LABEL_USERS_CTE,
        """SELECT uid,
       CASE WHEN ('0x' || substr(md5(uid || ':' || '123456789'), 1, 8))::BIGINT % 100 < 70
            THEN 'train' ELSE 'test' END AS split
FROM users""",
    ),
)
def q_train_test_split(spark, sf_dir):
    """M5: seeded 70/30 split by a hash of uid."""
    users = _labelled_bags(spark, sf_dir).select("uid").distinct()
    return users.select("uid", model.split_column().alias("split"))


def _trained(spark, sf_dir):
    """Train, save, load back: the scorers use the loaded model. Also the test predictions and the bags, which are written once."""
    bags = files.read_parquet(spark, files.write_parquet(_labelled_bags(spark, sf_dir), staging_path(spark, "bags")))
    m, test_pred = model.train(bags, written=True)
    path = staging_path(spark, "model")
    m.save(path)
    return model.DomainModel.load(spark, path), test_pred, bags


def _is_label(m: model.DomainModel) -> Column:
    """Whether the predicted label is one the model was fitted on."""
    return F.coalesce(F.col(model.LABEL).isin(m.labels), F.lit(False)).alias("fitted_label")


@register(
    "model_accuracy",
    _sql(
        ["clean_visits", "clients_banded"],
        LABEL_USERS_CTE,
        """SELECT gender_age, count(*) AS n_test, TRUE AS equals_evaluator FROM users
WHERE ('0x' || substr(md5(uid || ':' || '123456789'), 1, 8))::BIGINT % 100 >= 70 GROUP BY gender_age""",
    ),
)
def q_model_accuracy(spark, sf_dir):
    """M4/M7: test users per actual label, and whether the accuracy on the 30% test share is the evaluator's."""
    _, pred, _ = _trained(spark, sf_dir)
    same = abs(model.accuracy(pred).first().accuracy - model.evaluator_accuracy(pred)) < 1e-9
    return pred.groupBy(model.LABEL).agg(F.count(F.lit(1)).alias("n_test")).withColumn("equals_evaluator", F.lit(same))


@register(
    "train_score_roundtrip",
    _sql(["clean_visits", "clients_banded"], LABEL_USERS_CTE, "SELECT uid, TRUE AS fitted_label FROM users"),
)
def q_train_score_roundtrip(spark, sf_dir):
    """Fit, save, load, score every labelled user."""
    loaded, _, bags = _trained(spark, sf_dir)
    return loaded.score(bags.drop(model.LABEL), ("uid",)).select("uid", _is_label(loaded))


@register(
    "score_by_loaded_pipeline",
    _sql(["clean_visits", "clients_banded"], LABEL_USERS_CTE, "SELECT uid, TRUE AS same_as_fitted, TRUE AS fitted_label FROM users"),
)
def q_score_by_loaded_pipeline(spark, sf_dir):
    """K8/M6/M8: the saved artefact read with Spark ML's own ``PipelineModel.load`` scores bag rows as the fitted model does."""
    bags = files.read_parquet(spark, files.write_parquet(_labelled_bags(spark, sf_dir), staging_path(spark, "bags")))
    fitted, _ = model.train(bags, written=True)
    path = staging_path(spark, "model")
    fitted.save(path)
    rows = bags.drop(model.LABEL)
    loaded = PipelineModel.load(path).transform(rows).select("uid", F.col("predictedLabel").alias(model.LABEL))
    both = loaded.join(fitted.score(rows, ("uid",)).withColumnRenamed(model.LABEL, "fitted"), "uid", "full")
    return both.select("uid", F.col(model.LABEL).eqNullSafe(F.col("fitted")).alias("same_as_fitted"), _is_label(fitted))


@register("score_users_by_day", O.with_ctes(["visits"], "SELECT DISTINCT uid, date, TRUE AS fitted_label FROM visits"))
def q_score_users_by_day(spark, sf_dir):
    """Predicted gender/age per user and day from dated web logs (users without a usable domain too)."""
    loaded, _, _ = _trained(spark, sf_dir)
    return model.score_by_day(loaded, D.weblogs(spark, sf_dir)).select("uid", "date", _is_label(loaded))


# ---------------------------------------------------------------- streams


def _stage_text(spark, df, name, files=4):
    """Write a ``value`` column as text files (a message log to replay)."""
    path = staging_path(spark, name)
    df.select("value").repartition(files).write.text(path)
    return path


@register("stream_hourly_metrics", HOURLY_SQL)
def q_stream_hourly_metrics(spark, sf_dir):
    """Hourly metrics as a stream (update mode, checkpointed),
    one message file per micro-batch; final table equals the batch result."""
    src = _stage_text(spark, D.event_messages(spark, sf_dir), "messages")
    stream = sinks.stream_session(spark).readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    return metrics_stream.run_to_table(
        spark, stream, staging_path(spark, "metrics-out"), staging_path(spark, "metrics-ckpt")
    )


@register("stream_score_users", O.with_ctes(["visits"], "SELECT DISTINCT uid, TRUE AS same_as_batch FROM visits"))
def q_stream_score_users(spark, sf_dir):
    """Per-user state updated from a web-log stream, re-scored on change; compared with batch scoring."""
    loaded, _, _ = _trained(spark, sf_dir)
    logs = D.weblogs(spark, sf_dir)
    messages = logs.select(F.to_json(F.struct("uid", "visits")).alias("value"))
    src = _stage_text(spark, messages, "weblog-messages")
    stream = sinks.stream_session(spark).readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    streamed = scoring_stream.run_to_table(
        spark, stream, loaded, staging_path(spark, "score-out"), staging_path(spark, "score-ckpt"),
        partitions=int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    bags = model.domain_bags(visits.visit_domains(logs), ("uid",), keep_null_domains=True)
    batch = loaded.score(bags, ("uid",)).withColumnRenamed(model.LABEL, "batch_label")
    both = streamed.select("uid", model.LABEL).join(batch, "uid", "full")
    return both.select("uid", F.col(model.LABEL).eqNullSafe(F.col("batch_label")).alias("same_as_batch"))


LATE = "1 day"
LATE_EVERY = 11

FINAL_HOURS_SQL = O.with_ctes(
    ["shop_events"],
    f"""
SELECT (timestamp // 3600000) * 3600 AS start_ts,
       (timestamp // 3600000) * 3600 + 3600 AS end_ts,
       CAST(sum(CASE WHEN event_type = 'buy' THEN item_price END) AS BIGINT) AS revenue,
       CAST(sum(CASE WHEN uid IS NOT NULL THEN 1 END) AS BIGINT) AS visitors,
       CAST(sum(CASE WHEN event_type = 'buy' THEN 1 END) AS BIGINT) AS purchases,
       CAST(sum(CASE WHEN event_type = 'buy' THEN item_price END) AS DOUBLE)
         / sum(CASE WHEN event_type = 'buy' THEN 1 END) AS aov
FROM shop_events,
     (SELECT max(timestamp) FILTER (event_id % {LATE_EVERY} <> 0) - 86400000 AS passed, max(timestamp) - 86400000 AS final FROM shop_events)
WHERE (event_id % {LATE_EVERY} <> 0 OR (timestamp // 3600000) * 3600000 + 3600000 > passed)
  AND (timestamp // 3600000) * 3600000 + 3600000 <= final
GROUP BY 1, 2""",
)


@register("stream_final_hours", FINAL_HOURS_SQL)
def q_stream_final_hours(spark, sf_dir):
    """Hours written once, in append mode, when the watermark has passed them. Every eleventh event
    comes a run later: those of hours that are already final are dropped, the others counted."""
    ev = D.shop_events(spark, sf_dir)
    late = F.col("event_id") % LATE_EVERY == 0
    src, out, ckpt = (staging_path(spark, n) for n in ("late-messages", "final-hours", "final-ckpt"))
    own = sinks.stream_session(spark)
    for part in (ev.where(~late), ev.where(late)):
        part.select(C.encode_row(*[F.col(f.name) for f in EVENT_SCHEMA.fields]).alias("value")).repartition(4).write.mode("append").text(src)
        metrics_stream.run_final(own, own.readStream.schema("value string").text(src), out, ckpt, LATE)
    return metrics_stream.final_table(spark, out)


class _Interrupted(Exception):
    """Raised by ``q_stream_restart_metrics`` inside a batch."""


@register("stream_restart_metrics", HOURLY_SQL)
def q_stream_restart_metrics(spark, sf_dir):
    """A metrics stream that ends inside its second batch, after the write and before the commit, and goes on
    from its checkpoint with a processing-time trigger; the batch is replayed and the table equals the batch result."""
    src = _stage_text(spark, D.event_messages(spark, sf_dir), "restart-messages")
    out, ckpt = staging_path(spark, "restart-out"), staging_path(spark, "restart-ckpt")
    own = sinks.stream_session(spark)
    messages = own.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    stream, sink = metrics_stream.hourly_metrics_stream(messages), sinks.VersionedSink(out)
    mark = "interrupted in batch 1"

    def interrupted(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)
        if batch_id == 1:
            raise _Interrupted(mark)

    try:
        sinks.run_available(stream, interrupted, ckpt, "update", state_partitions=metrics_stream.STATE_PARTITIONS)
    except StreamingQueryException as e:
        if mark not in str(e):
            raise
    q = sinks.start(stream, sink, ckpt, "update", processing_time="1 second", state_partitions=metrics_stream.STATE_PARTITIONS)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return sinks.latest(spark, out, metrics_stream.KEYS)


BATCH_COUNTS_SQL = O.with_ctes(
    ["shop_events"],
    """
SELECT CAST(count(*) + 1 AS BIGINT) AS messages, CAST(1 AS BIGINT) AS malformed,
       CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS views,
       CAST(count(*) FILTER (event_type = 'buy') AS BIGINT) AS buys, CAST(4 AS BIGINT) AS batches
FROM shop_events""",
)


@register("stream_batch_counts", BATCH_COUNTS_SQL)
def q_stream_batch_counts(spark, sf_dir):
    """A10: counts of a metrics stream's decoded and malformed messages, reported after each batch as a table; summed over its batches."""
    src = _stage_text(spark, D.event_messages(spark, sf_dir), "counted-messages")
    own = sinks.stream_session(spark)
    messages = own.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    kind = F.col("event_type")
    counts = checks.BatchCounts(
        own, staging_path(spark, "batch-counts"), malformed=F.count_if(F.col("timestamp").isNull()), views=F.count_if(kind == "view"), buys=F.count_if(kind == "buy")
    )
    with counts:
        stream = metrics.hourly_metrics(counts.observed(E.decode_events(messages)))
        q = sinks.run_available(
            stream, sinks.VersionedSink(staging_path(spark, "counted-out")), staging_path(spark, "counted-ckpt"), "update",
            state_partitions=metrics_stream.STATE_PARTITIONS,
        )
        table = counts.table(q)
    return table.agg(*[F.sum(c).alias(n) for c, n in (("rows", "messages"), ("malformed", "malformed"), ("views", "views"), ("buys", "buys"))], F.count(F.lit(1)).alias("batches"))


TYPE_COUNTS_SQL = O.with_ctes(
    ["shop_events"],
    """
SELECT upper(event_type) AS event_type, count(*) AS n FROM shop_events GROUP BY 1
UNION ALL SELECT NULL, 1""",
)


@register("stream_type_counts", TYPE_COUNTS_SQL)
def q_stream_type_counts(spark, sf_dir):
    """Events per type as a stream in complete mode, upper-cased in the sink
    (the malformed message counts as the NULL type); the last batch is the final table."""
    src = _stage_text(spark, D.event_messages(spark, sf_dir), "type-messages")
    stream = sinks.stream_session(spark).readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    counts = E.decode_events(stream).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    out = staging_path(spark, "type-counts")
    sink = sinks.VersionedSink(out, lambda batch: batch.withColumn("event_type", F.upper("event_type")))
    sinks.run_available(counts, sink, staging_path(spark, "type-ckpt"), "complete", state_partitions=metrics_stream.STATE_PARTITIONS)
    return sinks.newest(spark, out).select("event_type", "n")


@register("scan_item_matrix", O.with_ctes(["item_rows"], item_cells_sql()))
def q_scan_item_matrix(spark, sf_dir):
    """S3: the matrix job's parquet output read back (no carry-over)."""
    inp = _write_split_visits(spark, sf_dir, "visits-all")
    path = matrix_job.users_items(spark, inp, staging_path(spark, "users-items-all"), update=False)
    return cells_of(files.read_parquet(spark, path))


# ---------------------------------------------------------------- pivots with values found by Spark


SHOP_ROWS_SQL = (
    "SELECT uid, 'shop_' || lower(replace(replace(category, '-', '_'), ' ', '_')) AS name "
    "FROM shop_visits WHERE uid IS NOT NULL AND category IS NOT NULL"
)
WEB_ROWS_SQL = "SELECT uid, 'web_' || category AS name FROM web_rows WHERE category IS NOT NULL"


def _non_null_cells(df: DataFrame, name: str = "name") -> DataFrame:
    return cells_of(df, name).drop("zeros")


@register("shop_category_pivot_found", O.with_ctes(["shop_visits"], found_cells_sql(SHOP_ROWS_SQL)))
def q_shop_category_pivot_found(spark, sf_dir):
    """A2: user x shop category, the category list found by Spark (as non-NULL cells)."""
    return _non_null_cells(mart.shop_pivot(D.shop_visits(spark, sf_dir)))


@register("web_category_pivot_found", _sql(["visit_domains", "domain_cats"], "," + WEB_ROWS_CTE, found_cells_sql(WEB_ROWS_SQL)))
def q_web_category_pivot_found(spark, sf_dir):
    """A2: user x web category, the category list found by Spark (as non-NULL cells)."""
    return _non_null_cells(mart.web_pivot(D.weblogs(spark, sf_dir), D.domain_categories(spark, sf_dir)))


@register(
    "customer_mart_found",
    _sql(
        ["clients_banded", "shop_visits", "visit_domains", "domain_cats"],
        "," + WEB_ROWS_CTE,
        f"""
SELECT c.uid, c.gender, c.age_cat, coalesce(m.counts, []) AS counts
FROM clients_banded c LEFT JOIN (
  SELECT uid, list_sort(list({{'name': name, 'n': n}})) AS counts
  FROM (SELECT uid, name, count(*) AS n FROM ({SHOP_ROWS_SQL} UNION ALL {WEB_ROWS_SQL}) GROUP BY uid, name) GROUP BY uid) m USING (uid)""",
    ),
)
def q_customer_mart_found(spark, sf_dir):
    """C1 as the reference runs it: both pivots find their own columns (as each client's non-NULL cells)."""
    wide = mart.customer_mart(
        D.clients(spark, sf_dir),
        D.shop_visits(spark, sf_dir),
        D.weblogs(spark, sf_dir),
        D.domain_categories(spark, sf_dir),
    )
    cells, _, _ = _cells(wide, [c for c in wide.columns if c not in ("uid", "gender", "age_cat")], lambda n: n.isNotNull())
    return wide.select("uid", "gender", "age_cat", cells.alias("counts"))


COUNT_VECTORS_SQL = _sql(
    ["clean_visits", "clients_banded"],
    """,
  bags AS (
    SELECT v.uid, v.domain, count(*) AS n
    FROM clean_visits v JOIN clients_banded c ON c.uid = v.uid
    GROUP BY v.uid, v.domain),
  vocab AS (
    SELECT domain, row_number() OVER (ORDER BY sum(n) DESC, domain) - 1 AS idx
    FROM bags GROUP BY domain)""",
    "SELECT b.uid, CAST(v.idx AS INTEGER) AS idx, CAST(b.n AS DOUBLE) AS n FROM bags b JOIN vocab v ON v.domain = b.domain",
)


@register("count_vectors", COUNT_VECTORS_SQL)
def q_count_vectors(spark, sf_dir):
    """M1: labelled users' term-count vectors over the fitted vocabulary."""
    bags = _labelled_bags(spark, sf_dir).drop(model.LABEL)
    vec = model.vectorize(bags, model.fit_vocabulary(bags), ("uid",))
    # The vector as its entries: a dense array would be as wide as the vocabulary for every user.
    parts = vec.select("uid", F.from_json(F.to_json(F.struct("features")), "features struct<indices: array<int>, values: array<double>>").alias("f"))
    return parts.select("uid", F.explode(F.arrays_zip("f.features.indices", "f.features.values")).alias("e")).select("uid", F.col("e.indices").alias("idx"), F.col("e.values").alias("n"))
