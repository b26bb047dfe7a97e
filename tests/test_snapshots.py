import re

from pyspark.sql import functions as F

from clickmart.operators import snapshots as S
from clickmart.session import staging_path


def _m(spark, rows, *items):
    return spark.createDataFrame(rows, ", ".join(["uid string", *[f"{c} long" for c in items]]))


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_previous_is_strictly_older_with_its_own_columns(spark):
    root = staging_path(spark, "t-set")
    assert S.previous_snapshot(spark, root, "20240105") is None
    assert S.read_snapshots(spark, root) is None
    S.write_snapshot(_m(spark, [("u", 1, None)], "a", "b"), root, "20240101")
    S.write_snapshot(_m(spark, [("u", 5)], "c"), root, "20240105")
    S.write_snapshot(_m(spark, [("u", 9)], "d"), root, "20240110")
    assert S.previous_snapshot(spark, root, "20240101") is None
    first = S.previous_snapshot(spark, root, "20240105")
    assert first.columns == ["uid", "a", "b"] and [tuple(r) for r in first.collect()] == [("u", 1, 0)]
    last = S.previous_snapshot(spark, root, "20240111")
    assert last.columns == ["uid", "d"] and last.first()["d"] == 9


def test_read_merges_columns_and_reads_one_folder_by_filter(spark):
    root = staging_path(spark, "t-merge")
    S.write_snapshot(_m(spark, [("u", 1)], "a"), root, "20240101")
    S.write_snapshot(_m(spark, [("u", 2), ("v", 3)], "b"), root, "20240102")
    every = S.read_snapshots(spark, root)
    rows = sorted((r.snapshot, r.uid, r.a, r.b) for r in every.collect())
    assert rows == [(20240101, "u", 1, None), (20240102, "u", None, 2), (20240102, "v", None, 3)]
    one = every.where(F.col("snapshot") == 20240102)
    assert re.search(r"PartitionFilters: \[[^]]*snapshot", _plan(one))
    assert len(one.inputFiles()) >= 1 and one.select(F.input_file_name().alias("f")).distinct().where("f not like '%snapshot=20240102%'").count() == 0


def test_rerun_replaces_one_snapshot(spark):
    root = staging_path(spark, "t-rerun")
    S.add_snapshot(spark, _m(spark, [("u", 1)], "a"), root, "20240101")
    for n in (2, 3):  # the second run must not carry the first run's rows of the same day
        got = S.add_snapshot(spark, _m(spark, [("v", n)], "b"), root, "20240102")
        assert sorted(map(tuple, got.select("uid", "a", "b").collect())) == [("u", 1, None), ("v", None, n)]
    assert S.read_snapshots(spark, root).where("snapshot = 20240101").count() == 1
    alone = S.add_snapshot(spark, _m(spark, [("w", 1)], "b"), root, "20240103", update=False)
    assert alone.columns == ["uid", "b"] and alone.count() == 1


def test_empty_snapshot(spark):
    root = staging_path(spark, "t-empty")
    S.write_snapshot(_m(spark, [("u", 1)], "a"), root, "20240101")
    got = S.add_snapshot(spark, _m(spark, [], "a"), root, "20240102")
    assert [tuple(r) for r in got.collect()] == [("u", 1)]


def test_join_with_buckets_shuffles_the_other_side_only(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = spark.range(2000).select(F.concat(F.lit("u"), F.col("id") % 500).alias("uid"), F.col("id").alias("a"))
    t = S.write_bucketed(m.dropDuplicates(["uid"]), "t_buckets", staging_path(spark, "t-buckets"), n)
    other = spark.range(3000).select(F.concat(F.lit("u"), F.col("id") % 700).alias("uid"), F.lit(1).alias("one"))
    per_user = other.groupBy("uid").agg(F.sum("one").alias("n"))
    both = per_user.join(t.hint("shuffle_merge"), "uid")
    assert both.count() == 500
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
