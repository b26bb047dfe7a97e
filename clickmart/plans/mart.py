"""Customer data mart = clients x shop categories x web categories.

Plan: the two pivots are aggregates keyed by ``uid`` (partial aggregation
before their shuffles); the domain catalogue join is an equi-join that AQE
broadcasts only when the catalogue's measured size allows it; the two left
joins keep every client, and NULL counts stay NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.functions import columns as C
from clickmart.operators import pivots, visits
from clickmart.operators.hot_join import hot_join
from clickmart.operators.ranking import staged

SHOP_PREFIX = "shop_"
WEB_PREFIX = "web_"


def banded_clients(clients: DataFrame) -> DataFrame:
    """``uid, gender, age_cat``."""
    return clients.select("uid", "gender", C.age_band("age").alias("age_cat"))


def shop_pivot(shop_visits: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """``uid, shop_<category>...`` visit counts (names cleaned)."""
    return pivots.category_pivot(shop_visits, SHOP_PREFIX, values, clean=True)


def web_category_visits(weblogs: DataFrame, domain_cats: DataFrame, spread_hot: bool = False) -> DataFrame:
    """``uid, domain, category``: known users' visits to catalogued domains.

    With ``spread_hot`` the visits are written once to the shared folder, domains
    above an average task's share of them are found there, and their visits are
    joined in several tasks.
    """
    v = visits.visit_domains(weblogs.where(F.col("uid").isNotNull()))
    if spread_hot:
        v = staged(v, "visit-domains")
        return hot_join(v, domain_cats.select("domain", "category"), "domain").select("uid", "domain", "category")
    return v.join(domain_cats.select("domain", "category"), "domain").select("uid", "domain", "category")


def web_pivot(weblogs: DataFrame, domain_cats: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """``uid, web_<category>...`` visit counts (prefix only, no cleaning).

    Visits are counted per user and domain before the catalogue join, so a
    domain with a third of all visits is one row a user there.
    """
    v = visits.visit_domains(weblogs.where(F.col("uid").isNotNull()))
    counts = visits.user_domain_counts(v.where(F.col("domain").isNotNull()))
    rows = counts.join(domain_cats.select("domain", "category"), "domain").select("uid", "category", "n")
    return pivots.category_pivot(rows, WEB_PREFIX, values, clean=False, weight="n")


def customer_mart(
    clients: DataFrame,
    shop_visits: DataFrame,
    weblogs: DataFrame,
    domain_cats: DataFrame,
    shop_values: Sequence[str] | None = None,
    web_values: Sequence[str] | None = None,
) -> DataFrame:
    """``uid, gender, age_cat, shop_*..., web_*...`` for every client."""
    c = banded_clients(clients)
    shop = shop_pivot(shop_visits, shop_values)
    web = web_pivot(weblogs, domain_cats, web_values)
    return c.join(shop, "uid", "left").join(web, "uid", "left")


def count_by_segment(mart: DataFrame) -> DataFrame:
    """``gender, age_cat, count``."""
    return mart.groupBy("gender", "age_cat").count()
