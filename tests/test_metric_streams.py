import json

import pytest
from pyspark.sql import functions as F

from clickmart.operators import checks
from clickmart.operators import events as E
from clickmart.operators import metrics as M
from clickmart.session import staging_path
from clickmart.streaming import metrics_stream, sinks

HOUR = 3_600_000


def _message(hour, kind="buy", price=10, uid="u1", minute=0):
    return json.dumps({"event_type": kind, "item_price": price, "uid": uid, "timestamp": hour * HOUR + minute * 60_000})


def _append(spark, src, *messages):
    spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(src)


def _read(spark, src):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)


def test_final_hours_come_once_and_leave_the_state(spark):
    own = sinks.stream_session(spark)
    src, out, ck = (staging_path(spark, n) for n in ("t-fin-in", "t-fin-out", "t-fin-ck"))

    def run():
        return metrics_stream.run_final(own, _read(own, src), out, ck, "2 hours", state_partitions=2)

    _append(spark, src, *[_message(h) for h in range(10)], "{broken")
    q = run()  # newest event at hour 9: the watermark is at hour 7, hours 0 to 6 are final
    assert sorted(r.start_ts // 3600 for r in metrics_stream.final_table(spark, out).collect()) == list(range(7))
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 3
    _append(spark, src, _message(3, price=1000), _message(8, price=5, minute=30))  # too late; in time
    run()
    assert metrics_stream.final_table(spark, out).count() == 7
    _append(spark, src, _message(20))
    q = run()
    rows = metrics_stream.final_table(spark, out).collect()
    assert sorted(r.start_ts // 3600 for r in rows) == list(range(10))  # each hour once
    revenue = {r.start_ts // 3600: r.revenue for r in rows}
    assert revenue[3] == 10 and revenue[8] == 15
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 1


def test_batch_counts_are_one_row_a_batch(spark):
    own = sinks.stream_session(spark)
    src, path, out, ck = (staging_path(spark, n) for n in ("t-cnt-in", "t-cnt", "t-cnt-out", "t-cnt-ck"))
    _append(spark, src, _message(1), _message(2), "{broken")
    _append(spark, src, _message(3))
    counts = checks.BatchCounts(own, path, malformed=F.count_if(F.col("timestamp").isNull()))
    with counts:
        stream = M.hourly_metrics(counts.observed(E.decode_events(_read(own, src))))
        q = sinks.run_available(stream, sinks.VersionedSink(out), ck, "update", state_partitions=2)
        rows = counts.table(q).collect()
    assert sorted((r.rows, r.malformed) for r in rows) == [(1, 0), (3, 1)]
    assert sorted(r.batch for r in rows) == [0, 1]


def test_batch_counts_wait_for_the_end(spark):
    class Never:
        runId = "none"  # noqa: N815 - Spark's name

    with pytest.raises(TimeoutError):
        checks.BatchCounts(spark, staging_path(spark, "t-none")).table(Never(), timeout=0.1)


def test_restart_query_is_interrupted_and_replays(spark):
    from clickmart import queries as Q

    seen = []

    class Spy(sinks.VersionedSink):
        def __call__(self, batch, batch_id):
            seen.append(batch_id)
            super().__call__(batch, batch_id)

    old, sinks.VersionedSink = sinks.VersionedSink, Spy
    try:
        Q.QUERIES["stream_restart_metrics"](spark, "/root/testdata/sf0.001")
    finally:
        sinks.VersionedSink = old
    assert seen == [0, 1, 1, 2, 3]
