from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.functions import columns as C
from clickmart.operators import pivots as P
from clickmart.plans import mart


def test_pivot_count_absent_is_null(spark):
    df = spark.createDataFrame([("u1", "x"), ("u1", "x"), ("u2", "y")], "uid string, k string")
    got = {r.uid: (r.x, r.y) for r in P.pivot_count(df, "uid", "k").collect()}
    assert got == {"u1": (2, None), "u2": (None, 1)}
    explicit = P.pivot_count(df, "uid", "k", ["x", "y", "z"])
    assert explicit.columns == ["uid", "x", "y", "z"]


def test_shop_pivot_names(spark):
    df = spark.createDataFrame([("u1", "4-NOT SPECIFIED"), (None, "1-URGENT"), ("u1", None)], "uid string, category string")
    m = mart.shop_pivot(df)
    assert m.columns == ["uid", "shop_4_not_specified"]
    assert m.first()["shop_4_not_specified"] == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.integers(0, 23)), min_size=1, max_size=30))
def test_hour_fractions_in_unit_interval(spark, rows):
    data = [(u, 1704067200000 + h * 3600_000) for u, h in rows]
    df = spark.createDataFrame(data, "uid string, timestamp long")
    from clickmart.operators.visits import with_time_labels

    fr = P.hour_fractions(with_time_labels(df)).collect()
    for r in fr:
        assert 0.0 <= r.web_fraction_work_hours <= 1.0
        assert 0.0 <= r.web_fraction_evening_hours <= 1.0
        assert r.web_fraction_work_hours + r.web_fraction_evening_hours <= 1.0


def test_weekday_pivot_fixed_columns(spark):
    df = spark.createDataFrame([("u1", 1704067200000)], "uid string, timestamp long")
    from clickmart.operators.visits import with_time_labels

    p = P.weekday_pivot(with_time_labels(df))
    assert p.columns == ["uid"] + C.WEEKDAY_COLUMNS
    assert p.first()["web_day_mon"] == 1 and p.first()["web_day_tue"] is None


def test_more_than_ten_thousand_found_names(spark):
    rows = spark.range(10_001).selectExpr("concat('u', id % 3) AS uid", "concat('item', id) AS name")
    wide = P.pivot_count(rows, "uid", "name")
    assert len(wide.columns) == 10_002 and wide.count() == 3
