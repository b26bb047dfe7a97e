from pyspark.sql import functions as F

from clickmart.session import staging_path
from clickmart.sources import files


def test_weblogs_schema_inference(spark):
    path = staging_path(spark, "t-infer")
    rows = [('{"uid":"u1","visits":[{"url":"http://a.com/","timestamp":1704067200000}]}',), ('{"uid":null,"visits":[]}',)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(path)
    inferred = files.read_weblogs(spark, path, schema=None)
    assert dict(inferred.dtypes)["visits"] == "array<struct<timestamp:bigint,url:string>>"
    fixed = files.read_weblogs(spark, path)
    assert dict(fixed.dtypes)["visits"] == "array<struct<url:string,timestamp:bigint>>"
    assert fixed.where(F.col("uid") == "u1").first().visits[0].url == "http://a.com/"


def test_split_files_in_plain_type_day_folders(spark):
    base = staging_path(spark, "t-plain")
    ev = spark.createDataFrame(
        [("view", "c", "i", 1, "u1", 1704067200000, "20240101"), ("buy", "c", "i", 2, "u2", 1704153600000, "20240102")],
        "event_type string, category string, item_id string, item_price long, uid string, timestamp long, date string",
    )
    for t, d in [("view", "20240101"), ("buy", "20240102")]:
        ev.where((F.col("event_type") == t) & (F.col("date") == d)).write.json(f"{base}/{t}/{d}")
    back = files.read_split_events(spark, f"{base}/*/*")
    assert sorted((r.event_type, r.date, r.item_price) for r in back.collect()) == [("buy", "20240102", 2), ("view", "20240101", 1)]


def test_partition_values_from_listing(spark):
    base = staging_path(spark, "t-pv")
    ev = spark.createDataFrame(
        [("view", "20240101"), ("buy", "20240103"), ("view", "20240102")], "event_type string, date string"
    ).withColumn("x", F.lit(1))
    ev.write.partitionBy("event_type", "date").parquet(base)
    assert files.partition_values(spark, base, "date") == ["20240101", "20240102", "20240103"]
    assert files.partition_values(spark, base, "event_type") == ["buy", "view"]
    assert files.partition_values(spark, staging_path(spark, "t-none"), "date") == []
