"""A user holding a third of all visits: results stay exact, rows stay bounded."""

from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from clickmart.functions.schemas import WEBLOG_SCHEMA
from clickmart.operators import visits as V
from clickmart.plans import features

DOMAINS = [f"d{i}.com" for i in range(40)]
T0 = 1704067200000


def _skewed_logs(spark):
    rows = []
    # the hot user: 3000 visits over 5 domains, in lines of at most 100 visits
    hot = [(f"http://{DOMAINS[i % 5]}/p", T0 + i * 60_000) for i in range(3000)]
    rows += [("hot", hot[k:k + 100]) for k in range(0, len(hot), 100)]
    # 600 other users with 10 visits each
    for u in range(600):
        rows.append((f"u{u}", [(f"http://{DOMAINS[(u + j) % 40]}/", T0 + (u * 10 + j) * 3_600_000) for j in range(10)]))
    return spark.createDataFrame(rows, WEBLOG_SCHEMA)


def test_feature_arrays_exact_under_skew(spark):
    logs = _skewed_logs(spark)
    got = {r.uid: r.domain_features for r in features.domain_feature_array(features.visit_cube(logs), n=10).collect()}
    # brute force in pandas
    pdf = V.clean_visits(logs).select("uid", "domain").toPandas()
    top = pdf.groupby("domain").size().reset_index(name="c").sort_values(["c", "domain"], ascending=[False, True])
    vocab = sorted(top.head(10)["domain"])
    want = {}
    for uid, g in pdf[pdf.domain.isin(vocab)].groupby("uid"):
        c = Counter(g.domain)
        want[uid] = [float(c.get(d, 0)) for d in vocab]
    assert got == want
    assert got["hot"] == [600.0 if d in DOMAINS[:5] else 0.0 for d in vocab]


def test_domain_list_row_is_bounded_by_distinct_domains(spark):
    lists = V.user_domain_lists(V.clean_visits(_skewed_logs(spark)))
    hot = lists.where(F.col("uid") == "hot").first()
    assert len(hot.domains) == 5 and sum(e.n for e in hot.domains) == 3000
    assert lists.select(F.max(F.size("domains"))).first()[0] <= 10
