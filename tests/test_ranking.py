"""Top rows by a cut-off: equal to a full sort, also where many rows tie."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clickmart.operators import ranking
from clickmart.operators.ranking import top_rows, with_place
from clickmart.plans.model import fit_vocabulary


@pytest.mark.parametrize("n", [1, 7, 50, 500, 5000])
def test_top_rows_equal_a_sort(spark, n):
    rng = random.Random(n)
    rows = [(f"k{i:05d}", int(rng.paretovariate(0.7))) for i in range(3000)]
    df = spark.createDataFrame(rows, "domain string, count long").repartition(8)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:n]
    assert sorted(map(tuple, top_rows(df, n, "count", "domain").collect())) == sorted(want)


def test_all_tied_and_empty(spark):
    df = spark.createDataFrame([(f"k{i}", 1) for i in range(100)], "domain string, count long")
    assert sorted(r.domain for r in top_rows(df, 10, "count", "domain").collect()) == sorted(f"k{i}" for i in range(100))[:10]
    assert top_rows(df.where("count > 5"), 10, "count", "domain").count() == 0


@pytest.mark.parametrize("n", [1, 40, 99, 100, 101, 3000])
def test_places_are_those_of_a_sort(spark, n):
    rng = random.Random(n)
    rows = [(f"k{i:05d}", rng.randint(1, 5)) for i in range(1000)]
    df = spark.createDataFrame(rows, "domain string, count long").repartition(7)
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))[:n])}
    assert {r.domain: r.at for r in top_rows(df, n, "count", "domain", place="at").collect()} == want


def test_places_of_an_empty_table(spark):
    df = spark.createDataFrame([], "domain string, count long")
    assert top_rows(df, 3, "count", "domain", place="at").columns == ["domain", "count", "at"]
    assert with_place(df, F.col("domain")).count() == 0


def test_a_million_ties_at_the_vocabulary_edge(spark):
    """Vocabulary of 2^18 where 10^6 domains tie: the alphabetically first fill it, numbered without gaps."""
    bags = spark.range(1_000_000).select(F.format_string("d%07d", "id").alias("domain"), F.lit(1).cast("long").alias("n"))
    bags = bags.unionByName(spark.createDataFrame([("z.com", 5), ("y.com", 9)], "domain string, n long"))
    vocab = fit_vocabulary(bags)
    n, low, high, names = vocab.agg(F.count("*"), F.min("idx"), F.max("idx"), F.countDistinct("idx")).first()
    assert (n, low, high, names) == (1 << 18, 0, (1 << 18) - 1, 1 << 18)
    assert [r.domain for r in vocab.where("idx < 4").orderBy("idx").collect()] == ["y.com", "z.com", "d0000000", "d0000001"]
    assert vocab.where("idx > 1").agg(F.max("domain")).first()[0] == f"d{(1 << 18) - 3:07d}"


def test_no_task_sees_all_keys(spark, monkeypatch):
    """The whole ranking in one plan: sorted ranges, and a window over partition sizes only."""
    monkeypatch.setattr(ranking, "staged", lambda df, name: df)
    df = spark.createDataFrame([(f"k{i}", 1) for i in range(50)], "domain string, count long")
    plan = top_rows(df, 10, "count", "domain", place="at")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "rangepartitioning(count" in plan
    windows = re.findall(r"Window \[.*", plan)
    assert windows and all("_part" in w and "domain" not in w for w in windows)
