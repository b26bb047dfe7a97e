import pytest
from pyspark.sql import functions as F

from clickmart.plans import model as Mo
from clickmart.session import staging_path
from clickmart.sources import derived as D
from clickmart.sources import step_counter as S
from clickmart.streaming import scoring_stream


def test_step_counter_counts(spark):
    df = S.read_stream(spark, 10, max_batches=4).groupBy("foo").count()
    out = staging_path(spark, "t-counter")
    q = (df.writeStream.outputMode("complete").foreachBatch(S.UpperCaseSink(out))
         .option("checkpointLocation", staging_path(spark, "t-counter-ck"))
         .trigger(processingTime="100 milliseconds").start())
    q.processAllAvailable()
    q.stop()
    rows = sorted((r.batch, r.foo, r["count"]) for r in spark.read.parquet(out).collect())
    assert [c for _, _, c in rows] == [1, 11, 21, 31]
    assert {f for _, f, _ in rows} == {"HELLO WORLD"}


@pytest.mark.parametrize("step,batches", [(1, 3), (7, 5), (S.ROWS_PER_PARTITION + 1, 3)])
def test_step_counter_ids_once(spark, step, batches):
    df = S.read_stream(spark, step, max_batches=batches)
    out = staging_path(spark, "t-ids")
    q = (df.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", staging_path(spark, "t-ids-ck"))
         .trigger(processingTime="100 milliseconds").start())
    q.processAllAvailable()
    q.stop()
    ids = spark.read.parquet(out)
    n = (batches - 1) * step + 1
    stats = ids.agg(F.count("id").alias("c"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    assert (stats.c, stats.d, stats.lo, stats.hi) == (n, n, 0, n - 1)


def test_scoring_stream_state_is_bag(spark):
    rows = [
        ('{"uid":"u1","visits":[{"url":"http://a.com/","timestamp":1},{"url":"http://a.com/x","timestamp":2}]}',),
        ('{"uid":"u1","visits":[{"url":"http://b.com/","timestamp":3}]}',),
        ('{"uid":"u2","visits":[{"url":"http://a b/[x","timestamp":4}]}',),
    ]
    src = staging_path(spark, "t-logs")
    for r in rows:
        spark.createDataFrame([r], "value string").coalesce(1).write.mode("append").text(src)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    out = staging_path(spark, "t-bags")
    from clickmart.streaming import sinks

    # every domain is kept, whatever a model's vocabulary holds
    bags = scoring_stream.user_bag_stream(stream)
    sinks.run_available(bags, sinks.VersionedSink(out), staging_path(spark, "t-bags-ck"), state_partitions=2, conf=scoring_stream.STATE_CONF)
    final = sinks.latest(spark, out, ("uid", "domain")).collect()
    got = sorted((r.uid, r.domain or "", r.n) for r in final)
    assert got == [("u1", "a.com", 2), ("u1", "b.com", 1), ("u2", "", 0)]


def test_processing_time_trigger_start(spark):
    from clickmart.streaming import sinks

    df = S.read_stream(spark, 3, max_batches=2)
    out = staging_path(spark, "t-pt")
    q = sinks.start(df, S.UpperCaseSink(out), staging_path(spark, "t-pt-ck"), "append", "100 milliseconds")
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]


def test_step_counter_clock_mode_resumes(spark):
    import time as _t

    start = int(_t.time() * 1000) - 10_000  # ten 1-second intervals ago
    out = staging_path(spark, "t-resume")
    ck = staging_path(spark, "t-resume-ck")

    def run(max_batches):
        df = S.read_stream(spark, 5, max_batches=max_batches, start_ms=start, interval_ms=1000)
        q = (df.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", ck).trigger(processingTime="100 milliseconds").start())
        q.processAllAvailable()
        q.stop()

    run(2)  # ids 0..5
    run(4)  # resumed from the checkpoint: ids 6..15 only
    ids = sorted(r.id for r in spark.read.parquet(out).collect())
    assert ids == list(range(0, 16))


def test_stream_scoring_equals_batch_scoring(spark):
    from clickmart.operators import visits as V

    sf = "/root/testdata/sf0.001"
    model, _ = Mo.train(Mo.labelled_bags(D.labelled_weblogs(spark, sf)), max_iter=10)
    logs = D.weblogs(spark, sf)
    src = staging_path(spark, "t-score-src")
    logs.select(F.to_json(F.struct("uid", "visits")).alias("value")).repartition(3).write.text(src)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
    streamed = scoring_stream.run_to_table(
        spark, stream, model, staging_path(spark, "t-score-out"), staging_path(spark, "t-score-ck"), partitions=4
    )
    bags = Mo.domain_bags(V.visit_domains(logs), ("uid",), keep_null_domains=True)
    batch = model.score(bags, ("uid",))
    assert sorted(map(tuple, streamed.select("uid", "gender_age").collect())) == sorted(map(tuple, batch.collect()))


def test_scoring_stream_resumes_with_state(spark):
    from clickmart.operators import visits as V
    from clickmart.streaming import sinks

    sf = "/root/testdata/sf0.001"
    model, _ = Mo.train(Mo.labelled_bags(D.labelled_weblogs(spark, sf)), max_iter=10)
    logs = D.weblogs(spark, sf).withColumn("_h", F.abs(F.xxhash64("uid", "date")) % 2)
    src, out, ck = (staging_path(spark, f"t-resume-{k}") for k in ("src", "out", "ck"))

    def run():
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        sinks.run_available(scoring_stream.user_bag_stream(stream),
                            scoring_stream.scoring_sink(model, out), ck, "update", conf=scoring_stream.STATE_CONF)

    for half in (0, 1):  # a user's lines arrive in both halves
        part = logs.where(F.col("_h") == half).select(F.to_json(F.struct("uid", "visits")).alias("value"))
        part.coalesce(1).write.mode("append").text(src)
        run()
    streamed = sinks.latest(spark, out, ("uid",)).select("uid", "gender_age")
    bags = Mo.domain_bags(V.visit_domains(logs), ("uid",), keep_null_domains=True)
    batch = model.score(bags, ("uid",))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_scoring_state_ttl_forgets_idle_users(spark):
    import time as _t

    from clickmart.streaming import sinks

    src, out, ck = (staging_path(spark, f"t-ttl-{k}") for k in ("src", "out", "ck"))

    def add(uid, n):
        visits = ",".join('{"url":"http://a.com/","timestamp":1}' for _ in range(n))
        spark.createDataFrame([(f'{{"uid":"{uid}","visits":[{visits}]}}',)], "value string").coalesce(1) \
            .write.mode("append").text(src)

    def run():
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        bags = scoring_stream.user_bag_stream(stream, state_ttl_ms=1000)
        sinks.run_until_caught_up(bags, sinks.VersionedSink(out), ck, conf=scoring_stream.STATE_CONF)

    add("u1", 2)
    run()
    _t.sleep(2.5)
    add("u2", 1)  # this batch finds u1 idle for longer than the TTL
    run()
    add("u1", 1)
    run()
    got = {(r.uid, r.n) for r in sinks.latest(spark, out, ("uid", "domain")).collect()}
    assert got == {("u1", 1), ("u2", 1)}  # u1 restarted from an empty bag


def _message(uid, *domains):
    visits = ",".join(f'{{"url":"http://{d}/","timestamp":1}}' for d in domains)
    return f'{{"uid":"{uid}","visits":[{visits}]}}'


def test_retrained_model_reads_an_old_checkpoint(spark):
    """State holds domains: a model whose vocabulary has another order sees the same bags."""
    from clickmart.streaming import sinks

    src, out, ck = (staging_path(spark, f"t-retrain-{k}") for k in ("src", "out", "ck"))
    seen = []
    for vocabulary, message in (({"a.com": 0, "b.com": 1}, _message("u", "a.com")), ({"b.com": 0, "c.com": 1, "a.com": 2}, _message("u", "c.com", "z.com"))):
        spark.createDataFrame([(message,)], "value string").coalesce(1).write.mode("append").text(src)
        vocab = spark.createDataFrame(list(vocabulary.items()), "domain string, idx int")
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        sink = sinks.VersionedSink(out, lambda batch, vocab=vocab: Mo.index_domains(batch, vocab))
        sinks.run_available(scoring_stream.user_bag_stream(stream), sink, ck, conf=scoring_stream.STATE_CONF)
        seen.append({(r.domain, r.idx, r.n) for r in sinks.newest(spark, out).collect()})
    assert seen == [{("a.com", 0, 1)}, {("a.com", 2, 1), ("c.com", 1, 1), ("z.com", None, 1)}]


def test_drain_reads_new_input_after_an_unfinished_batch(spark):
    """A batch that was planned but not committed is replayed, and what came later is still read."""
    import time as _t

    from clickmart.streaming import sinks

    src, out, ck = (staging_path(spark, f"t-unfinished-{k}") for k in ("src", "out", "ck"))

    def bags():
        stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
        return scoring_stream.user_bag_stream(stream, state_ttl_ms=60_000)

    def add(*uids):
        spark.createDataFrame([(_message(u, "a.com"),) for u in uids], "value string").coalesce(1).write.mode("append").text(src)

    add("u1")
    fail = {"on": False}

    def sink(batch, batch_id):
        if fail["on"] and batch_id > 0:
            raise RuntimeError("lost")
        sinks.VersionedSink(out)(batch, batch_id)

    sinks.run_until_caught_up(bags(), sink, ck, state_partitions=2, conf=scoring_stream.STATE_CONF)
    fail["on"] = True
    q = sinks.start(bags(), sink, ck, processing_time="100 milliseconds", state_partitions=2, conf=scoring_stream.STATE_CONF)  # plans a batch without data, which fails
    deadline = _t.monotonic() + 60
    while q.isActive and _t.monotonic() < deadline:
        _t.sleep(0.2)
    q.stop()
    fail["on"] = False
    add("u2")
    sinks.run_until_caught_up(bags(), sink, ck, state_partitions=2, conf=scoring_stream.STATE_CONF)
    assert {r.uid for r in sinks.latest(spark, out, ("uid", "domain")).collect()} == {"u1", "u2"}


def test_busy_user_is_counted_before_the_shuffle(spark):
    """A user with a third of all visits sends one row a domain and Arrow batch to the state."""
    lines = [_message("hot", *["a.com", "b.com"] * 50) for _ in range(20)] + [_message(f"u{i}", "a.com") for i in range(100)]
    visits = scoring_stream.visit_domain_stream(spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1))
    counted = visits.mapInArrow(scoring_stream._combine, scoring_stream.BAG_SCHEMA).collect()
    hot = [r for r in counted if r.uid == "hot"]
    assert len(hot) == 2 and sum(r.n for r in hot) == 2000 and len(counted) == 102


def test_state_writes_follow_the_changes(spark):
    """One more visit of a user with 3,000 domains writes one entry, not the bag."""
    import os

    from clickmart.streaming import sinks

    src, out, ck = (staging_path(spark, f"t-delta-{k}") for k in ("src", "out", "ck"))
    written = []
    for domains in ([f"d{i}.com" for i in range(3000)], ["d7.com"]):
        spark.createDataFrame([(_message("u", *domains),)], "value string").coalesce(1).write.mode("append").text(src)
        stream = spark.readStream.schema("value string").text(src)
        sinks.run_available(scoring_stream.user_bag_stream(stream), sinks.VersionedSink(out), ck, state_partitions=1, conf=scoring_stream.STATE_CONF)
        logs = [os.path.join(d, f) for d, _, fs in os.walk(ck.removeprefix("file:") + "/state") for f in fs if f.endswith(".changelog")]
        written.append(sum(os.path.getsize(f) for f in logs))
    bag = {r.domain: r.n for r in sinks.newest(spark, out).collect()}
    assert len(bag) == 3000 and bag["d7.com"] == 2 and sum(bag.values()) == 3001
    assert 0 < written[1] - written[0] < written[0] / 20


def test_stream_settings_stay_in_their_session(spark):
    from clickmart.streaming import sinks

    own = sinks.stream_session(spark)
    assert own.conf.get("spark.sql.session.timeZone") == "UTC" and own.conf.get("spark.sql.shuffle.partitions") == "4"
    with sinks.starting_with(own, 9, scoring_stream.STATE_CONF):
        assert own.conf.get("spark.sql.shuffle.partitions") == "9"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    assert own.conf.get("spark.sql.shuffle.partitions") == "4"
    assert "RocksDB" not in own.conf.get("spark.sql.streaming.stateStore.providerClass")


class _ListState:
    def __init__(self):
        self.rows, self.calls, self.written = [], 0, 0

    def get(self):
        return iter(list(self.rows))

    def put(self, rows):
        self.rows, self.calls, self.written = list(rows), self.calls + 1, self.written + len(rows)

    def appendList(self, rows):  # noqa: N802 - Spark's name
        self.rows, self.calls, self.written = self.rows + list(rows), self.calls + 1, self.written + len(rows)


def test_a_users_batch_is_one_write_and_the_list_stays_short():
    """Many domains cost one call, a few changes write a few entries, and what repeats is folded in time."""
    import pandas as pd

    class Handle:
        def getListState(self, name, schema):  # noqa: N802 - Spark's name
            return state

    state, bag = _ListState(), scoring_stream.DomainBag()
    bag.init(Handle())

    def batch(domains):
        frame = pd.DataFrame({"uid": "u", "domain": domains, "n": [1] * len(domains)})
        return {r.domain: r.n for f in bag.handleInputRows(("u",), iter([frame]), None) for r in f.itertuples()}

    first = batch([f"d{i}" for i in range(500)] + [None])
    assert len(first) == 500 and state.calls == 1 and state.written == 500
    for i in range(1, 1200):
        got = batch(["d7"])
        assert got["d7"] == i + 1 and len(got) == 500
        assert len(state.rows) <= 1000
    assert state.written <= 500 + 1199 + 2 * 500 + 500 and sum(n for _, n in state.rows) == 1699
