"""Options for the external stores the reference talks to.

Kafka, JDBC, Cassandra and Elasticsearch connectors are separate packages
(not bundled with PySpark), so these helpers build the reader/writer
options and apply them; the payload logic they feed (JSON decode/encode,
partitioned writes) is tested on files. Credentials are passed in by the
caller and never logged.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

KAFKA = "kafka"
JDBC = "jdbc"
CASSANDRA = "org.apache.spark.sql.cassandra"
ELASTIC = "org.elasticsearch.spark.sql"


def kafka_offsets(topic: str, offsets: Mapping[int, int] | str) -> str:
    """``startingOffsets`` value: ``earliest``/``latest`` or a per-partition map."""
    if isinstance(offsets, str):
        return offsets
    return json.dumps({topic: {str(p): int(o) for p, o in sorted(offsets.items())}})


def kafka_read_options(servers: str, topic: str, offsets: Mapping[int, int] | str | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if offsets is not None:
        opts["startingOffsets"] = kafka_offsets(topic, offsets)
    return opts


def kafka_write_options(servers: str, topic: str, checkpoint: str | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    return opts


def read_kafka(spark: SparkSession, servers: str, topic: str, offsets=None) -> DataFrame:
    """Batch read of a topic (``value`` is binary; decode with ``decode_events``)."""
    return spark.read.format(KAFKA).options(**kafka_read_options(servers, topic, offsets)).load()


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, offsets=None) -> DataFrame:
    return spark.readStream.format(KAFKA).options(**kafka_read_options(servers, topic, offsets)).load()


def write_kafka_stream(values: DataFrame, servers: str, topic: str, checkpoint: str,
                       output_mode: str = "update", processing_time: str = "5 seconds", available_now: bool = False):
    """Start a ``value``-column stream into a topic (checkpoint never wiped)."""
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    return (
        values.writeStream.format(KAFKA)
        .options(**kafka_write_options(servers, topic, checkpoint))
        .outputMode(output_mode)
        .trigger(**trigger)
        .start()
    )


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> dict:
    """JDBC options; with a partition column the read runs as parallel range
    queries instead of one task."""
    opts = {"url": url, "dbtable": table, "user": user, "password": password}
    if driver:
        opts["driver"] = driver
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs bounds and numPartitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_jdbc(spark: SparkSession, **kw) -> DataFrame:
    return spark.read.format(JDBC).options(**jdbc_options(**kw)).load()


def append_jdbc(df: DataFrame, **kw) -> None:
    df.write.mode("append").format(JDBC).options(**jdbc_options(**kw)).save()


def cassandra_options(keyspace: str, table: str) -> dict:
    return {"keyspace": keyspace, "table": table}


def read_cassandra(spark: SparkSession, keyspace: str, table: str) -> DataFrame:
    """Host/port come from the session (``spark.cassandra.connection.*``)."""
    return spark.read.format(CASSANDRA).options(**cassandra_options(keyspace, table)).load()


def elastic_options(nodes: str, port: str | None = None, user: str | None = None, password: str | None = None,
                    wan_only: bool = True) -> dict:
    opts = {"es.nodes": nodes, "es.batch.write.refresh": "false"}
    if port:
        opts["es.port"] = port
    if wan_only:
        opts["es.nodes.wan.only"] = "true"
    if user:
        opts["es.net.http.auth.user"] = user
    if password:
        opts["es.net.http.auth.pass"] = password
    return opts


def read_elastic(spark: SparkSession, index: str, **kw) -> DataFrame:
    return spark.read.format(ELASTIC).options(**elastic_options(**kw)).load(index)


def append_elastic(df: DataFrame, index: str, **kw) -> None:
    df.write.mode("append").format(ELASTIC).options(**elastic_options(**kw)).save(f"{index}/_doc")
