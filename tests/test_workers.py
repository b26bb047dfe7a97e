"""Python workers need no installed clickmart: run from an unrelated directory."""

import os
import subprocess
import sys
import tempfile
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {repo!r})
    from pyspark.sql import SparkSession, functions as F
    from clickmart.sources import step_counter as S
    from clickmart.plans import model as Mo
    from clickmart.streaming import scoring_stream, sinks
    from clickmart.session import staging_path

    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # 1. Python data source (class shipped to workers)
    q = (S.read_stream(spark, 3, max_batches=2).writeStream.format("memory").queryName("c")
         .trigger(processingTime="100 milliseconds").start())
    q.processAllAvailable(); q.stop()
    assert sorted(r.id for r in spark.table("c").collect()) == [0, 1, 2, 3]
    # 2. pandas UDF building vectors
    bags = spark.createDataFrame([("u1", "a.com", 2), ("u2", "b.com", 1)], "uid string, domain string, n long")
    vocab = Mo.fit_vocabulary(bags)
    assert Mo.vectorize(bags, vocab, ("uid",)).count() == 2
    # 3. streaming state function
    src = staging_path(spark, "w-src")
    spark.createDataFrame([('{{"uid":"u1","visits":[{{"url":"http://a.com/","timestamp":1}}]}}',)], "value string").write.text(src)
    stream = spark.readStream.schema("value string").text(src)
    out = staging_path(spark, "w-out")
    sinks.run_available(scoring_stream.user_bag_stream(stream), sinks.VersionedSink(out), staging_path(spark, "w-ck"), state_partitions=2, conf=scoring_stream.STATE_CONF)
    assert spark.read.parquet(out).count() == 1
    print("WORKERS-OK")
    """
)


def test_workers_run_without_installed_package():
    cwd = tempfile.mkdtemp(prefix="clickmart-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=cwd, env=env,
        capture_output=True, text=True, timeout=600,
    )
    assert "WORKERS-OK" in r.stdout, r.stderr[-3000:]
