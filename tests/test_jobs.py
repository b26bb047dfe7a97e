"""The job entry points run end to end on files staged from the small tables."""

from pyspark.sql import functions as F

from clickmart import jobs
from clickmart.session import staging_path
from clickmart.sources import derived as D

SF = "/root/testdata/sf0.001"


def test_job_chain(spark):
    p = {k: staging_path(spark, f"t-job-{k}") for k in
         ["weblogs", "clients", "cats", "shop", "msgs", "split", "ui", "feat", "mart", "lab", "model", "dash",
          "agg", "agg-ck", "wmsg", "score", "score-ck"]}
    D.weblogs(spark, SF).write.json(p["weblogs"])
    D.clients(spark, SF).write.parquet(p["clients"])
    D.domain_categories(spark, SF).write.parquet(p["cats"])
    D.shop_visits(spark, SF).write.parquet(p["shop"])
    D.event_messages(spark, SF).write.text(p["msgs"])
    D.labelled_weblogs(spark, SF).write.json(p["lab"])
    D.weblogs(spark, SF).select(F.to_json(F.struct("uid", "visits")).alias("value")).write.text(p["wmsg"])

    run = lambda *argv: jobs.main(list(argv), spark=spark)
    run("mart", "--weblogs", p["weblogs"], "--clients-parquet", p["clients"], "--domain-cats-parquet", p["cats"],
        "--shop-parquet", p["shop"], "--out-parquet", p["mart"])
    assert spark.read.parquet(p["mart"]).count() == D.clients(spark, SF).count()

    run("split", "--messages", p["msgs"], "--out", p["split"])
    run("users_items", "--input-dir", p["split"], "--out-dir", p["ui"], "--update", "0")
    matrix = spark.read.parquet(p["ui"] + "/*")
    assert matrix.count() > 0

    run("features", "--weblogs", p["weblogs"], "--matrix", p["ui"] + "/*", "--out", p["feat"])
    feat = spark.read.parquet(p["feat"])
    assert feat.count() > 0 and "domain_features" in feat.columns and "web_day_mon" in feat.columns

    run("train", "--input", p["lab"], "--model", p["model"])
    run("dashboard", "--model", p["model"], "--data", p["weblogs"], "--out-parquet", p["dash"])
    assert set(spark.read.parquet(p["dash"]).columns) == {"uid", "gender_age", "date"}

    run("agg", "--messages", p["msgs"], "--out", p["agg"], "--checkpoint", p["agg-ck"], "--available-now",
        "--trigger", "100 milliseconds")
    assert spark.read.parquet(p["agg"]).select("start_ts").distinct().count() > 0

    run("test", "--model", p["model"], "--messages", p["wmsg"], "--out", p["score"], "--checkpoint", p["score-ck"],
        "--available-now", "--trigger", "100 milliseconds")
    assert spark.read.parquet(p["score"]).count() > 0
