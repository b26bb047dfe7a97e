"""Independent DuckDB SQL for the correctness check.

The derivation rules of ``clickmart.sources.derived`` restated as SQL CTEs
over the driver's views (``events``, ``pages``, ``part``, ``customer``,
``orders``). Host extraction uses a regular expression instead of a URL
parser; a URL with characters a URI may not hold (space, brackets) has no
host, as in the Spark rule.
"""

from __future__ import annotations

from clickmart.functions.columns import HOUR_COLUMNS, WEEKDAYS

# Same constants as the Spark derivation.
MALFORMED_URL = "http://a b/[x"

HOST_SQL = (
    "CASE WHEN regexp_matches({u}, '[ \\[\\]<>{{}}|\\\\^`\"]') THEN NULL "
    "ELSE nullif(regexp_replace(regexp_extract(lower({u}), '^[a-z][a-z0-9+.-]*://([^/?#:@]+)', 1), "
    "'^www\\.', ''), '') END"
)


def host(u: str) -> str:
    return HOST_SQL.format(u=u)


CTE = {
    "clients": """
  clients AS (
    SELECT 'u' || c_custkey AS uid,
           CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CAST(CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 10 + (c_custkey * 37) % 71 END AS INTEGER) AS age
    FROM customer)""",
    "clients_banded": """
  clients_banded AS (
    SELECT uid, gender, age,
           CASE WHEN age >= 18 AND age < 25 THEN '18-24'
                WHEN age >= 25 AND age < 35 THEN '25-34'
                WHEN age >= 35 AND age < 45 THEN '35-44'
                WHEN age >= 45 AND age < 55 THEN '45-54'
                WHEN age >= 55 THEN '>=55'
                ELSE 'Unknown' END AS age_cat
    FROM clients)""",
    "page_domains": f"""
  page_domains AS (
    SELECT page_id, url, {host('url')} AS domain FROM pages)""",
    "domain_cats": """
  domain_cats AS (
    SELECT domain, 'cat_' || CAST(length(domain) % 5 AS VARCHAR) AS category
    FROM (SELECT DISTINCT domain FROM page_domains WHERE domain IS NOT NULL)
    WHERE length(domain) % 7 <> 0)""",
    "shop_visits": """
  shop_visits AS (
    SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'u' || o_custkey END AS uid,
           o_orderpriority AS category
    FROM orders)""",
    "visits": f"""
  visits AS (
    SELECT e.event_id,
           'u' || e.user_id AS uid,
           CASE WHEN e.event_id % 97 = 0 THEN '{MALFORMED_URL}' ELSE p.url END AS url,
           (epoch_us(e.ts) // 1000) AS timestamp,
           strftime(e.ts, '%Y%m%d') AS date,
           e.ts AS ts
    FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))""",
    "visit_domains": f"""
  visit_domains AS (
    SELECT uid, date, url, timestamp, ts, {host('url')} AS domain FROM visits)""",
    "clean_visits": """
  clean_visits AS (
    SELECT uid, domain, timestamp,
           'web_day_' || lower(strftime(ts, '%a')) AS web_week_day,
           'web_hour_' || CAST(hour(ts) AS VARCHAR) AS web_hour,
           CASE WHEN hour(ts) >= 9 AND hour(ts) < 18 THEN 1 ELSE 0 END AS work_hours,
           CASE WHEN hour(ts) >= 18 AND hour(ts) < 24 THEN 1 ELSE 0 END AS evening_hours
    FROM visit_domains WHERE domain IS NOT NULL AND uid IS NOT NULL)""",
    "shop_events": """
  shop_events AS (
    SELECT e.event_id,
           CASE WHEN e.event_type = 'purchase' THEN 'buy' ELSE e.event_type END AS event_type,
           p.p_type AS category,
           p.p_name AS item_id,
           CAST(round(e.value) AS BIGINT) AS item_price,
           CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE 'u' || e.user_id END AS uid,
           (epoch_us(e.ts) // 1000) AS timestamp,
           e.ts AS ts
    FROM events e JOIN part p ON p.p_partkey = e.event_id % (SELECT count(*) FROM part))""",
    "split_visits": """
  split_visits AS (
    SELECT event_type, category, item_id, item_price, uid, timestamp,
           strftime(ts, '%Y%m%d') AS date,
           date_diff('day', (SELECT min(ts)::DATE FROM events), ts::DATE) AS day_index
    FROM shop_events
    WHERE event_type IN ('view', 'buy'))""",
    "item_rows": """
  item_rows AS (
    SELECT uid, event_type || '_' || lower(replace(replace(item_id, '-', '_'), ' ', '_')) AS item_name, day_index, date
    FROM split_visits WHERE uid IS NOT NULL AND item_id IS NOT NULL)""",
}

DEPS = {
    "clients_banded": ["clients"],
    "domain_cats": ["page_domains"],
    "visit_domains": ["visits"],
    "clean_visits": ["visit_domains"],
    "split_visits": ["shop_events"],
    "item_rows": ["split_visits"],
}


def with_ctes(names: list[str], body: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [CTE[n] for n in order]
    extra = [c for c in names if c not in CTE]
    assert not extra, extra
    return "WITH" + ",".join(ctes) + "\n" + body


def weekday_cols(src_alias: str = "") -> str:
    p = f"{src_alias}." if src_alias else ""
    return ", ".join(
        f"CAST(sum(CASE WHEN {p}web_week_day = 'web_day_{d}' THEN 1 END) AS BIGINT) AS web_day_{d}" for d in WEEKDAYS
    )


def hour_cols(src_alias: str = "") -> str:
    p = f"{src_alias}." if src_alias else ""
    return ", ".join(
        f"CAST(sum(CASE WHEN {p}web_hour = '{c}' THEN 1 END) AS BIGINT) AS {c}" for c in HOUR_COLUMNS
    )
