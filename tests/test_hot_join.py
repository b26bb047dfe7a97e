import pytest
from pyspark.sql import functions as F

from clickmart.operators.hot_join import hot_join, hot_keys

VISITS = "domain string, uid string"


def _visits(spark, n=30_000):
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot.com").when(i % 100 == 1, None).otherwise(F.concat(F.lit("d"), i % 997))
    return spark.range(n).repartition(8).select(key.alias("domain"), F.concat(F.lit("u"), i % 50).alias("uid"))


def _catalogue(spark):
    names = spark.range(0, 997, 2).select(F.concat(F.lit("d"), F.col("id")).alias("domain"))
    names = names.unionByName(spark.createDataFrame([("hot.com",), (None,)], "domain string"))
    return names.withColumn("category", F.length("domain"))


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(spark, how):
    v, c = _visits(spark), _catalogue(spark)
    got = hot_join(v, c, "domain", how)
    assert got.columns == v.join(c, "domain", how).columns
    assert _rows(got) == _rows(v.join(c, "domain", how))


def test_repeated_rows_on_both_sides_and_clashing_names(spark):
    v = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)] * 3, "domain string, _salt int")
    c = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "domain string, _salts string")
    assert _rows(hot_join(v, c, "domain")) == _rows(v.join(c, "domain"))


def test_empty_sides(spark):
    v, c = _visits(spark, 300), _catalogue(spark)
    assert hot_join(v.limit(0), c, "domain").count() == 0
    assert hot_join(v, c.limit(0), "domain").count() == 0
    assert hot_join(v, c.limit(0), "domain", "left").count() == 300


def test_only_keys_above_the_share_are_hot(spark):
    assert [r.domain for r in hot_keys(_visits(spark), "domain", 0.05).collect()] == ["hot.com"]


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        hot_join(_visits(spark, 10), _catalogue(spark), "domain", "full")


def test_hot_domain_is_spread_over_tasks(spark):
    own = spark.newSession()
    for k, v in {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}.items():
        own.conf.set(k, v)
    v, c = _visits(own, 120_000), _catalogue(own)

    def largest_over_median(df):
        sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        return sizes[-1] / sizes[len(sizes) // 2]

    assert largest_over_median(v.join(c, "domain")) > 8
    assert largest_over_median(hot_join(v, c, "domain")) < 2.5
