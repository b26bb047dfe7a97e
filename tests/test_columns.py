import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickmart.functions import columns as C


def test_age_band_edges(spark):
    ages = [None, 0, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 99]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(C.age_band("age")).collect()]
    assert got == ["Unknown", "Unknown", "Unknown", "18-24", "18-24", "25-34", "25-34",
                   "35-44", "35-44", "45-54", "45-54", ">=55", ">=55"]


def test_hour_flags(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "h int")
    ts = F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), F.col("h"), F.lit(0), F.lit(0))
    rows = df.select("h", C.work_hours_flag(ts).alias("w"), C.evening_hours_flag(ts).alias("e")).collect()
    for h, w, e in rows:
        assert w == (1 if 9 <= h < 18 else 0)
        assert e == (1 if 18 <= h < 24 else 0)


def test_url_domain_rules(spark):
    urls = {
        "http://a b/[x": None,
        "https://www.Foo.com:8080/x?y=1": "foo.com",
        "http://wwwabc.com/": "wwwabc.com",  # dot matched literally
        "http://www2.foo.com/": "www2.foo.com",
        "https://m.shop.example.net/en/25#top": "m.shop.example.net",
        None: None,
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = {r[0]: r[1] for r in df.select("u", C.url_domain("u")).collect()}
    assert got == urls


def test_time_labels(spark):
    # 2024-01-01 was a Monday
    df = spark.createDataFrame([(1704067200000 + 5 * 3600 * 1000,)], "ms long")
    ts = C.millis_to_ts("ms")
    r = df.select(C.day_key(ts), C.weekday_label(ts), C.hour_label(ts)).first()
    assert tuple(r) == ("20240101", "web_day_mon", "web_hour_5")


names = st.text(alphabet=string.ascii_letters + "- _" + string.digits, max_size=20)


@settings(max_examples=40, deadline=None)
@given(st.lists(names, min_size=1, max_size=8))
def test_normalize_name_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(C.normalize_name("v").alias("v"))
    twice = once.select(C.normalize_name("v").alias("v"))
    assert [r[0] for r in once.collect()] == [r[0] for r in twice.collect()]
    for r in once.collect():
        assert "-" not in r[0] and " " not in r[0] and r[0] == r[0].lower()


def test_normalize_name_prefix(spark):
    df = spark.createDataFrame([("4-NOT SPECIFIED", "view"), (None, "buy")], "c string, t string")
    r = df.select(
        C.normalize_name("c", "shop_"), C.normalize_name("c", F.concat(F.col("t"), F.lit("_")))
    ).collect()
    assert tuple(r[0]) == ("shop_4_not_specified", "view_4_not_specified")
    assert tuple(r[1]) == (None, None)
