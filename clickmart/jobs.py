"""Command-line entry points for the eight jobs (``python -m clickmart.jobs <job> ...``).

Each job takes its inputs and outputs as arguments: file paths, or connector
settings where the data lives in Kafka, a JDBC database, Cassandra or
Elasticsearch (those need their connector packages on the classpath).
Passwords are read from an environment variable named by the caller and
are never printed. The session's ``spark.checkpoint.dir`` (or
``--checkpoint``) holds stream checkpoints; they are never wiped.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.functions.schemas import DATED_WEBLOG_SCHEMA, LABELLED_WEBLOG_SCHEMA, WEBLOG_SCHEMA
from clickmart.session import apply_scale, get_session, input_bytes
from clickmart.sources import connectors as K
from clickmart.sources import files


def _secret(env: str | None) -> str | None:
    return os.environ.get(env) if env else None


def _read_clients(spark: SparkSession, a) -> DataFrame:
    if a.clients_parquet:
        return spark.read.parquet(a.clients_parquet)
    return K.read_cassandra(spark, a.cassandra_keyspace, a.cassandra_table)


def _read_domain_cats(spark: SparkSession, a) -> DataFrame:
    if a.domain_cats_parquet:
        return spark.read.parquet(a.domain_cats_parquet)
    split = {}
    if a.jdbc_partition_column:
        split = {"partition_column": a.jdbc_partition_column, "lower_bound": a.jdbc_lower, "upper_bound": a.jdbc_upper, "num_partitions": a.jdbc_partitions}
    return K.read_jdbc(spark, url=a.jdbc_url, table=a.jdbc_table, user=a.jdbc_user, password=_secret(a.jdbc_password_env), driver=a.jdbc_driver, **split)


def _read_shop(spark: SparkSession, a) -> DataFrame:
    if a.shop_parquet:
        return spark.read.parquet(a.shop_parquet)
    return K.read_elastic(spark, a.es_index, nodes=a.es_nodes, port=a.es_port)


def job_mart(spark: SparkSession, a) -> None:
    """Clients x shop categories x web categories -> parquet or JDBC append."""
    from clickmart.plans import mart

    m = mart.customer_mart(
        _read_clients(spark, a),
        _read_shop(spark, a),
        files.read_weblogs(spark, a.weblogs, WEBLOG_SCHEMA),
        _read_domain_cats(spark, a),
    )
    if a.out_parquet:
        m.write.mode("overwrite").parquet(a.out_parquet)
    else:
        K.append_jdbc(m, url=a.out_jdbc_url, table=a.out_jdbc_table, user=a.jdbc_user,
                      password=_secret(a.jdbc_password_env), driver=a.jdbc_driver)


def job_split(spark: SparkSession, a) -> None:
    """Event messages (Kafka topic or text files) -> JSON per type and day."""
    from clickmart.plans import split

    if a.messages:
        msgs = spark.read.text(a.messages)
    else:
        offsets = a.offset if a.offset in ("earliest", "latest") else json.loads(a.offset)
        if isinstance(offsets, dict):
            offsets = {int(k): int(v) for k, v in offsets.items()}
        msgs = K.read_kafka(spark, a.kafka_servers, a.topic, offsets)
    split.split_events(msgs, a.out)


def job_agg(spark: SparkSession, a) -> None:
    """Streaming hourly metrics, Kafka (or a text folder) -> Kafka (or files)."""
    from clickmart.streaming import metrics_stream, sinks

    src = (spark.readStream.schema("value string").text(a.messages) if a.messages
           else K.read_kafka_stream(spark, a.kafka_servers, a.topic))
    metrics = metrics_stream.hourly_metrics_stream(src, a.watermark)
    n = metrics_stream.STATE_PARTITIONS
    if a.out_topic:
        with sinks.starting_with(spark, n):
            q = K.write_kafka_stream(metrics_stream.kafka_value_stream(metrics), a.kafka_servers, a.out_topic,
                                     a.checkpoint, "update", a.trigger, available_now=a.available_now)
        q.awaitTermination()
    elif a.available_now:
        sinks.run_available(metrics, sinks.VersionedSink(a.out), a.checkpoint, "update", state_partitions=n)
    else:
        sink = sinks.VersionedSink(a.out, compact_every=a.compact_every, keys=metrics_stream.KEYS)
        sinks.start(metrics, sink, a.checkpoint, "update", a.trigger, state_partitions=n).awaitTermination()


def job_users_items(spark: SparkSession, a) -> None:
    """C4: user x item matrix with optional carry-over -> <out>/<max day>."""
    from clickmart.plans import matrix_job

    print(matrix_job.users_items(spark, a.input_dir, a.out_dir, update=a.update == 1))


def job_features(spark: SparkSession, a) -> None:
    """Feature table from web logs and an item matrix snapshot."""
    from clickmart.plans import features

    f = features.user_features(
        files.read_weblogs(spark, a.weblogs, WEBLOG_SCHEMA), spark.read.parquet(a.matrix), a.top
    )
    f.sortWithinPartitions("uid").write.mode("overwrite").parquet(a.out)


def job_train(spark: SparkSession, a) -> None:
    """Fit the classifier on labelled web logs; print accuracy; save."""
    from clickmart.plans import model

    logs = files.read_json(spark, a.input, LABELLED_WEBLOG_SCHEMA)
    m, pred = model.train(model.labelled_bags(logs), seed=a.seed, vocab_size=a.vocab_size)
    print(json.dumps(model.accuracy(pred).first().asDict()))
    m.save(a.model)


def job_test(spark: SparkSession, a) -> None:
    """Streaming scoring, Kafka (or a text folder) -> Kafka (or files)."""
    from clickmart.plans import model
    from clickmart.streaming import scoring_stream, sinks

    m = model.DomainModel.load(spark, a.model)
    src = (spark.readStream.schema("value string").text(a.messages) if a.messages
           else K.read_kafka_stream(spark, a.kafka_servers, a.topic, "latest"))
    bags = scoring_stream.user_bag_stream(src, a.state_ttl_ms)
    if a.out_topic:

        def sink(batch: DataFrame, batch_id: int) -> None:
            # scored per micro-batch and sent as JSON lines
            out = m.score(batch, ("uid",)).select(F.to_json(F.struct("uid", "gender_age")).alias("value"))
            out.write.format(K.KAFKA).options(**K.kafka_write_options(a.kafka_servers, a.out_topic)).save()

    else:
        sink = scoring_stream.scoring_sink(m, a.out, a.compact_every if not a.available_now else None)
    n = a.state_partitions
    if a.available_now:
        # timeouts would keep batches without data coming
        drain = sinks.run_until_caught_up if a.state_ttl_ms else sinks.run_available
        drain(bags, sink, a.checkpoint, "update", state_partitions=n, conf=scoring_stream.STATE_CONF)
    else:
        sinks.start(bags, sink, a.checkpoint, "update", a.trigger, state_partitions=n, conf=scoring_stream.STATE_CONF).awaitTermination()


def job_dashboard(spark: SparkSession, a) -> None:
    """Score dated web logs per user and day -> parquet or Elasticsearch."""
    from clickmart.plans import model

    m = model.DomainModel.load(spark, a.model)
    scored = model.score_by_day(m, files.read_json(spark, a.data, DATED_WEBLOG_SCHEMA))
    if a.out_parquet:
        scored.write.mode("overwrite").parquet(a.out_parquet)
    else:
        K.append_elastic(scored, a.es_index, nodes=a.es_nodes, port=a.es_port, user=a.es_user, password=_secret(a.es_password_env))


# Arguments that name input files; their total size sets the shuffle width.
INPUTS = ("weblogs", "clients_parquet", "domain_cats_parquet", "shop_parquet", "messages", "input_dir", "matrix", "input", "data")

JOBS = {
    "mart": job_mart,
    "split": job_split,
    "agg": job_agg,
    "users_items": job_users_items,
    "features": job_features,
    "train": job_train,
    "test": job_test,
    "dashboard": job_dashboard,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clickmart.jobs")
    p.add_argument("--master")
    p.add_argument("--checkpoint-dir", help="shared folder when spark.checkpoint.dir is unset")
    p.add_argument("--input-bytes", type=int, help="size of the input where it isn't files (Kafka, JDBC, ...); else it is measured")
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("mart")
    s.add_argument("--weblogs", required=True)
    s.add_argument("--clients-parquet")
    s.add_argument("--cassandra-keyspace")
    s.add_argument("--cassandra-table")
    s.add_argument("--domain-cats-parquet")
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-table")
    s.add_argument("--jdbc-user")
    s.add_argument("--jdbc-password-env")
    s.add_argument("--jdbc-driver")
    s.add_argument("--jdbc-partition-column", help="numeric column to split the catalogue read by")
    s.add_argument("--jdbc-lower", type=int)
    s.add_argument("--jdbc-upper", type=int)
    s.add_argument("--jdbc-partitions", type=int)
    s.add_argument("--shop-parquet")
    s.add_argument("--es-index")
    s.add_argument("--es-nodes")
    s.add_argument("--es-port")
    s.add_argument("--out-parquet")
    s.add_argument("--out-jdbc-url")
    s.add_argument("--out-jdbc-table")

    s = sub.add_parser("split")
    s.add_argument("--messages", help="text files with one JSON message per line")
    s.add_argument("--kafka-servers")
    s.add_argument("--topic")
    s.add_argument("--offset", default="earliest", help='"earliest", "latest" or {"<partition>": <offset>, ...}')
    s.add_argument("--out", required=True)

    for name in ("agg", "test"):
        s = sub.add_parser(name)
        s.add_argument("--messages")
        s.add_argument("--kafka-servers")
        s.add_argument("--topic")
        s.add_argument("--out-topic")
        s.add_argument("--out")
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--trigger", default="5 seconds" if name == "agg" else "10 seconds")
        s.add_argument("--available-now", action="store_true")
        s.add_argument("--compact-every", type=int, default=1000, help="batches between compactions of a file table")
        if name == "agg":
            s.add_argument("--watermark")
        else:
            s.add_argument("--model", required=True)
            s.add_argument("--state-ttl-ms", type=int, help="forget users idle for longer (default: keep for ever)")
            s.add_argument("--state-partitions", type=int, default=200, help="of a new checkpoint; fixed for its life")

    s = sub.add_parser("users_items")
    s.add_argument("--input-dir", required=True)
    s.add_argument("--out-dir", required=True)
    s.add_argument("--update", type=int, default=1)

    s = sub.add_parser("features")
    s.add_argument("--weblogs", required=True)
    s.add_argument("--matrix", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--top", type=int, default=1000)

    s = sub.add_parser("train")
    s.add_argument("--input", required=True)
    s.add_argument("--model", required=True)
    s.add_argument("--seed", type=int, default=123456789)
    s.add_argument("--vocab-size", type=int, default=1 << 18)

    s = sub.add_parser("dashboard")
    s.add_argument("--model", required=True)
    s.add_argument("--data", required=True)
    s.add_argument("--out-parquet")
    s.add_argument("--es-index")
    s.add_argument("--es-nodes")
    s.add_argument("--es-port")
    s.add_argument("--es-user")
    s.add_argument("--es-password-env")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    extra = {"spark.checkpoint.dir": a.checkpoint_dir} if a.checkpoint_dir else None
    spark = spark or get_session(app=f"clickmart-{a.job}", master=a.master, extra=extra)
    bytes_in = a.input_bytes if a.input_bytes is not None else input_bytes(spark, *(getattr(a, k, None) for k in INPUTS))
    if bytes_in:
        apply_scale(spark, bytes_in)
    JOBS[a.job](spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
