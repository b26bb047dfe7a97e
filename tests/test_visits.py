from collections import Counter

from pyspark.sql import functions as F

from clickmart.operators import visits as V

WEBLOG = "uid string, visits array<struct<url:string,timestamp:bigint>>"


def _logs(spark):
    rows = [
        ("u1", [("http://www.a.com/x", 1704067200000), ("http://b.com/", 1704070800000), ("http://a b/[x", 1)]),
        ("u2", [("https://a.com/", 1704067200000)]),
        ("u3", []),
        ("u4", None),
        (None, [("http://c.com/", 1704067200000)]),
    ]
    return spark.createDataFrame(rows, WEBLOG)


def test_flatten_drops_null_and_empty(spark):
    f = V.flatten_visits(_logs(spark))
    assert f.count() == 5
    assert {r.uid for r in f.collect()} == {"u1", "u2", None}


def test_clean_visits_filters(spark):
    c = V.clean_visits(_logs(spark))
    got = sorted((r.uid, r.domain) for r in c.collect())
    assert got == [("u1", "a.com"), ("u1", "b.com"), ("u2", "a.com")]


def test_top_domains_tie_break(spark):
    df = spark.createDataFrame([("u", d) for d in ["b", "a", "c", "c"]], "uid string, domain string")
    top = V.top_domains(df, 2).collect()
    assert [(r.domain, r["count"]) for r in top] == [("a", 1), ("c", 2)]


def test_user_domain_lists_is_collect_list_multiset(spark):
    rows = [("u1", "a"), ("u1", "b"), ("u1", "a"), ("u2", None), ("u2", "c")]
    df = spark.createDataFrame(rows, "uid string, domain string")
    bags = {r.uid: {e.domain: e.n for e in r.domains} for r in V.user_domain_lists(df).collect()}
    lists = {r.uid: Counter(r.l) for r in df.groupBy("uid").agg(F.collect_list("domain").alias("l")).collect()}
    assert bags == {k: dict(v) for k, v in lists.items()}


def test_semi_join_to_top(spark):
    df = spark.createDataFrame([("u1", "a"), ("u2", "b"), ("u3", "a")], "uid string, domain string")
    top = spark.createDataFrame([("a", 2)], "domain string, count long")
    assert sorted(r.uid for r in V.visits_to_top_domains(df, top).collect()) == ["u1", "u3"]
