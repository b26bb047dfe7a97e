import os

from pyspark.sql import functions as F

from clickmart.operators import events as E
from clickmart.plans import split
from clickmart.session import staging_path
from clickmart.sources import files


def test_decode_malformed_and_wrong_type(spark):
    msgs = spark.createDataFrame(
        [('{"event_type":"buy","item_price":5,"uid":"u1","timestamp":1}',),
         ('{"event_type": "buy", "item_price": ',),
         ('{"event_type":"view","item_price":"cheap","timestamp":2}',)],
        "value string",
    )
    rows = E.decode_events(msgs).collect()
    assert rows[0].item_price == 5 and rows[0].uid == "u1"
    assert all(v is None for v in rows[1])
    assert rows[2].item_price is None


def _msgs(spark):
    evs = [("view", 1704067200000), ("buy", 1704067200000), ("buy", 1704153600000)]  # buy-only second day
    df = spark.createDataFrame(evs, "event_type string, timestamp long")
    return df.select(F.to_json(F.struct("event_type", F.lit("u1").alias("uid"), "timestamp")).alias("value"))


def test_split_writes_every_day_of_every_type(spark):
    out = staging_path(spark, "t-split")
    split.split_events(_msgs(spark), out)
    parts = sorted(
        os.path.relpath(d, out.removeprefix("file:"))
        for d, _, fs in os.walk(out.removeprefix("file:")) if any(f.endswith(".json") for f in fs)
    )
    assert parts == ["event_type=buy/date=20240101", "event_type=buy/date=20240102", "event_type=view/date=20240101"]
    back = files.read_split_events(spark, out)
    assert back.count() == 3 and dict(back.dtypes)["date"] == "string"


def test_rerun_replaces_only_its_partitions(spark):
    out = staging_path(spark, "t-rerun")
    split.split_events(_msgs(spark), out)
    split.split_events(_msgs(spark).limit(1), out)  # rerun for the first view day only
    back = files.read_split_events(spark, out)
    assert back.count() == 3  # no duplicates, other partitions untouched


def test_split_observes_counts(spark):
    out = staging_path(spark, "t-split-obs")
    msgs = _msgs(spark).unionByName(spark.createDataFrame([("not json",)], "value string"))
    stats = {}
    split.split_events(msgs, out, stats=stats)
    assert stats == {"rows": 4, "malformed": 1}
