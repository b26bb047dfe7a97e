import json

import pytest

from clickmart.sources import connectors as K


def test_kafka_offsets_per_partition():
    assert K.kafka_offsets("t", "earliest") == "earliest"
    assert json.loads(K.kafka_offsets("t", {1: 5, 0: 3})) == {"t": {"0": 3, "1": 5}}


def test_jdbc_partitioned_options():
    o = K.jdbc_options("jdbc:x", "t", "u", "p", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=8)
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        K.jdbc_options("jdbc:x", "t", "u", "p", partition_column="id")


def test_mart_job_passes_jdbc_flags(monkeypatch):
    from clickmart import jobs

    seen = {}
    monkeypatch.setattr(K, "read_jdbc", lambda spark, **kw: seen.update(K.jdbc_options(**kw)))
    a = jobs.parser().parse_args(
        ["mart", "--weblogs", "w", "--jdbc-url", "jdbc:x", "--jdbc-table", "t", "--jdbc-user", "u", "--jdbc-driver", "org.x.Driver",
         "--jdbc-partition-column", "id", "--jdbc-lower", "0", "--jdbc-upper", "100", "--jdbc-partitions", "4"]
    )
    jobs._read_domain_cats(None, a)
    assert seen["driver"] == "org.x.Driver" and seen["numPartitions"] == "4" and seen["lowerBound"] == "0"


def test_elastic_options_auth():
    o = K.elastic_options("n1", port="9200", user="a", password="b")
    assert o["es.net.http.auth.user"] == "a" and o["es.nodes.wan.only"] == "true"
