import json

from pyspark.sql import functions as F

from clickmart.operators import metrics as M
from clickmart.streaming import metrics_stream
from clickmart.session import staging_path

EV = "event_type string, item_price long, uid string, timestamp long"
H = 3600_000
T0 = 1704067200000


def _events(spark):
    rows = [
        ("view", 5, "u1", T0 + 10),
        ("buy", 10, "u1", T0 + 20),
        ("buy", 20, None, T0 + 30),
        ("view", 7, None, T0 + H + 5),  # hour without a uid and without a buy
    ]
    return spark.createDataFrame(rows, EV)


def test_hourly_metrics_semantics(spark):
    got = {r.start_ts: r for r in M.hourly_metrics(_events(spark)).collect()}
    a, b = got[T0 // 1000], got[T0 // 1000 + 3600]
    assert (a.end_ts, a.revenue, a.visitors, a.purchases, a.aov) == (T0 // 1000 + 3600, 30, 2, 2, 15.0)
    assert (b.revenue, b.visitors, b.purchases, b.aov) == (None, None, None, None)


def test_metrics_json_omits_nulls(spark):
    rows = M.metrics_json(M.hourly_metrics(_events(spark))).collect()
    docs = [json.loads(r.value) for r in rows]
    empty = [d for d in docs if d["start_ts"] == T0 // 1000 + 3600][0]
    assert set(empty) == {"start_ts", "end_ts"}


def _write_messages(spark, df, path):
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").text(path)


def test_stream_equals_batch_and_resumes(spark):
    src = staging_path(spark, "t-msgs")
    out = staging_path(spark, "t-out")
    ck = staging_path(spark, "t-ck")
    ev = _events(spark)
    _write_messages(spark, ev.limit(2), src)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    metrics_stream.run_to_table(spark, stream, out, ck)
    # more data arrives, including a late row for the first hour; restart from the checkpoint
    _write_messages(spark, ev.subtract(ev.limit(2)), src)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    final = metrics_stream.run_to_table(spark, stream, out, ck)
    batch = M.hourly_metrics(ev)
    cols = batch.columns
    assert sorted(map(tuple, final.select(*cols).collect())) == sorted(map(tuple, batch.collect()))


def test_watermark_without_late_rows_changes_nothing(spark):
    src = staging_path(spark, "t-wm-msgs")
    _write_messages(spark, _events(spark), src)
    stream = spark.readStream.schema("value string").text(src)
    with_wm = metrics_stream.run_to_table(
        spark, stream, staging_path(spark, "t-wm-out"), staging_path(spark, "t-wm-ck"), watermark="1 day"
    )
    batch = M.hourly_metrics(_events(spark))
    assert sorted(map(tuple, with_wm.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_compaction_keeps_the_table_and_bounds_reads(spark):
    from clickmart.streaming import sinks

    src, out, ck = (staging_path(spark, f"t-cmp-{k}") for k in ("src", "out", "ck"))
    ev = _events(spark)
    batch = M.hourly_metrics(ev)
    cols = batch.columns

    def run():
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        return metrics_stream.run_to_table(spark, stream, out, ck)

    _write_messages(spark, ev.limit(2), src)
    run()
    upto = sinks.compact(spark, out, metrics_stream.KEYS)
    assert upto is not None
    assert sinks.compact(spark, out, metrics_stream.KEYS) == upto  # rerun is harmless
    _write_messages(spark, ev.subtract(ev.limit(2)), src)
    final = run()
    assert sorted(map(tuple, final.select(*cols).collect())) == sorted(map(tuple, batch.collect()))
    plan = sinks.latest(spark, out, metrics_stream.KEYS)._jdf.queryExecution().optimizedPlan().toString()
    assert f"batch#" in plan and f"> {upto}" in plan  # old batch folders are pruned
