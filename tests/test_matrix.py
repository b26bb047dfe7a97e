from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.operators import matrix as X
from clickmart.plans import matrix_job
from clickmart.session import staging_path
from clickmart.sources import files

VIS = "event_type string, category string, item_id string, item_price long, uid string, timestamp long, date string"


def _visits(spark, rows):
    return spark.createDataFrame(rows, VIS)


def test_matrix_drops_null_items_and_users(spark):
    v = _visits(spark, [("view", "c", "Red-Ball x", 1, "u1", 1, "20240101"),
                        ("buy", "c", None, 1, "u1", 1, "20240101"),
                        ("view", "c", "red-ball x", 1, None, 1, "20240101")])
    m = X.user_item_matrix(v)
    assert m.columns == ["uid", "view_red_ball_x"]
    assert m.first()["view_red_ball_x"] == 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), min_size=1, max_size=3, unique=True),
       st.lists(st.sampled_from(["b", "c", "d"]), min_size=0, max_size=3, unique=True))
def test_union_keeps_rows_and_column_union(spark, ca, cb):
    a = spark.createDataFrame([tuple(["u1"] + [1] * len(ca))], ",".join(["uid string"] + [f"{c} long" for c in ca]))
    b = spark.createDataFrame([tuple(["u2"] + [2] * len(cb))], ",".join(["uid string"] + [f"{c} long" for c in cb]))
    u = X.union_matrices(a, b)
    assert u.count() == 2
    assert set(u.columns) == {"uid"} | set(ca) | set(cb)


def test_union_with_columnless_empty_frame(spark):
    a = spark.createDataFrame([("u1", 1)], "uid string, x long")
    u = X.union_matrices(a, spark.createDataFrame([], "uid string"))
    assert u.count() == 1 and u.columns == ["uid", "x"]


def test_previous_snapshot_strictly_older(spark):
    out = staging_path(spark, "t-snap")
    for day, val in [("20240101", 1), ("20240105", 5), ("20240110", 10)]:
        X.write_snapshot(spark.createDataFrame([("u", val)], "uid string, x long"), out, day)
    assert X.previous_snapshot(spark, out, "20240105").first()["x"] == 1
    assert X.previous_snapshot(spark, out, "20240111").first()["x"] == 10
    assert X.previous_snapshot(spark, out, "20240101") is None
    assert X.previous_snapshot(spark, staging_path(spark, "t-none"), "20240101") is None


def test_users_items_job_carries_over(spark):
    inp = staging_path(spark, "t-in")
    out = staging_path(spark, "t-out")
    v1 = _visits(spark, [("view", "c", "a", 1, "u1", 1, "20240101")])
    files.write_split_events(v1, inp)
    p1 = matrix_job.users_items(spark, inp, out)
    assert p1.endswith("20240101")
    v2 = _visits(spark, [("buy", "c", "b", 1, "u2", 2, "20240102")])
    files.write_split_events(v2, inp)
    p2 = matrix_job.users_items(spark, inp, out)
    res = spark.read.parquet(p2)
    # current matrix covers both days; the previous snapshot's rows are appended
    assert res.count() == 3
    assert set(res.columns) == {"uid", "view_a", "buy_b"}
    no_update = matrix_job.users_items(spark, inp, staging_path(spark, "t-out2"), update=False)
    assert spark.read.parquet(no_update).count() == 2


def test_users_items_observed_count(spark):
    inp = staging_path(spark, "t-obs-in")
    files.write_split_events(_visits(spark, [("view", "c", "a", 1, "u1", 1, "20240101"),
                                             ("view", "c", "a", 1, "u2", 1, "20240101")]), inp)
    stats = {}
    matrix_job.users_items(spark, inp, staging_path(spark, "t-obs-out"), stats=stats)
    assert stats["rows"] == 2


def test_union_new_columns_are_null_unless_filled(spark):
    a = spark.createDataFrame([("u1", 1)], "uid string, view_a long")
    b = spark.createDataFrame([("u1", 2)], "uid string, buy_b long")
    rows = {(r.view_a, r.buy_b) for r in X.union_matrices(a, b).collect()}
    assert rows == {(1, None), (None, 2)}  # the user appears twice
    filled = {(r.view_a, r.buy_b) for r in X.union_matrices(a, b, fill_missing=True).collect()}
    assert filled == {(1, 0), (0, 2)}


def test_snapshot_uid_lookup_is_pushed(spark):
    out = staging_path(spark, "t-lookup")
    m = spark.createDataFrame([(f"u{i}", i) for i in range(50)], "uid string, view_a long")
    path = X.write_snapshot(m, out, "20240101")
    q = spark.read.parquet(path).where("uid = 'u7'")
    assert "PushedFilters: [IsNotNull(uid), EqualTo(uid,u7)]" in q._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert q.first().view_a == 7


def test_event_without_timestamp_does_not_name_the_snapshot(spark):
    from clickmart.plans import matrix_job
    from clickmart.sources import files

    cols = "event_type string, category string, item_id string, item_price long, uid string, timestamp long, date string"
    rows = [("view", "c", "A", 1, "u1", 1704067200000, "20240101"), ("buy", "c", "A", 1, "u1", None, None)]
    inp, out = staging_path(spark, "t-null-day"), staging_path(spark, "t-null-day-out")
    files.write_split_events(spark.createDataFrame(rows, cols), inp)
    path = matrix_job.users_items(spark, inp, out)
    assert path.endswith("/20240101") and X.snapshot_days(spark, out) == ["20240101"]
    assert spark.read.parquet(path).first().asDict() == {"uid": "u1", "view_a": 1, "buy_a": 1}


def test_day_with_buys_only(spark):
    """A day folder may be missing for one type: the matrix has both types' columns all the same."""
    from clickmart.plans import matrix_job
    from clickmart.sources import files

    cols = "event_type string, category string, item_id string, item_price long, uid string, timestamp long, date string"
    rows = [("view", "c", "A", 1, "u1", 1704067200000, "20240101"), ("buy", "c", "B", 1, "u2", 1704153600000, "20240102")]
    inp = staging_path(spark, "t-buy-day")
    files.write_split_events(spark.createDataFrame(rows, cols), inp)
    path = matrix_job.users_items(spark, inp, staging_path(spark, "t-buy-day-out"))
    assert path.endswith("/20240102")
    assert {r.uid: (r.view_a, r.buy_b) for r in spark.read.parquet(path).collect()} == {"u1": (1, 0), "u2": (0, 1)}
