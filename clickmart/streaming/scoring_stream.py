"""Streaming scoring of users from web-log messages.

Messages (``value`` = JSON web-log line) -> visits -> domains. Visits are
counted per ``(uid, domain)`` inside each Arrow batch before the shuffle, so
a busy user sends one row a domain and batch to the state, not one a visit.
A user's state is a list of domains with counts (``transformWithState``, keyed
by uid, RocksDB with a change log; a map where entries expire): a batch adds
the entries that it changes in one call, and doesn't write the user's whole
bag. Every domain seen is kept, as in the
reference; the state knows no model, so a retrained one can be used on an old
checkpoint. After each micro-batch the full bags of the users that changed are
emitted; the micro-batch sink looks the domains up in the model's vocabulary,
scores the vectors with the fitted pipeline and writes ``uid, gender_age``
(update semantics: newest row per user).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clickmart.functions import columns as C
from clickmart.functions.schemas import WEBLOG_SCHEMA
from clickmart.plans.model import LABEL, DomainModel
from clickmart.streaming import sinks

BAG_SCHEMA = "uid string, domain string, n long"
# Settings a query with map state must be started with: RocksDB, with a log of
# the changed entries for each batch.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Rows of one emitted frame: a bag of any size leaves in pieces.
EMIT_ROWS = 10_000
# Visits that are counted together where the session's Arrow batches are smaller.
COUNT_ROWS = 10_000
# Entries up to which a user's list is not written anew.
MIN_REWRITE = 16
# State partitions of a new checkpoint (fixed for its life): enough for a
# large cluster, whatever number of cores is there when the query first starts.
STATE_PARTITIONS = 200


def visit_domain_stream(messages: DataFrame) -> DataFrame:
    """``uid, domain`` per visit (NULL uid / domain kept)."""
    logs = messages.select(F.from_json(F.col("value").cast("string"), WEBLOG_SCHEMA).alias("j")).select("j.*")
    v = logs.select("uid", F.explode("visits").alias("v"))
    return v.select("uid", C.url_domain(F.col("v.url")).alias("domain"))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Visits per ``(uid, domain)`` of each Arrow batch; small batches are counted together, up to ``COUNT_ROWS`` visits."""

    def counted(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        counts = pa.Table.from_batches(held).group_by(["uid", "domain"]).aggregate([([], "count_all")])
        return counts.select(["uid", "domain", "count_all"]).rename_columns(["uid", "domain", "n"]).to_batches()

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= COUNT_ROWS:
            yield from counted(held)
            held = []
    if held:
        yield from counted(held)


def _new_counts(rows) -> dict[str, int]:
    """Visits per domain of a user's new rows (NULL domains left out)."""
    new: dict[str, int] = {}
    for pdf in rows:
        for d, n in zip(pdf["domain"].tolist(), pdf["n"].tolist(), strict=True):
            if isinstance(d, str):
                new[d] = new.get(d, 0) + n
    return new


class DomainBag(StatefulProcessor):
    """A user's counts per domain, as a list of entries to which a batch adds its own.

    A user's batch costs one read and one write, whatever the number of its
    domains: a map's entries would be written one call each. A domain's
    entries add up; a list twice as long as its bag is written anew, so the
    bytes written follow the changes.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("counts", "domain string, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        new = _new_counts(rows)
        bag: dict[str, int] = {}
        held = 0
        for domain, n in self.entries.get():
            bag[domain] = bag.get(domain, 0) + n
            held += 1
        for domain, n in new.items():
            bag[domain] = bag.get(domain, 0) + n
        anew = held + len(new) > max(MIN_REWRITE, 2 * len(bag))
        entries = list((bag if anew else new).items())
        for at in range(0, len(entries), EMIT_ROWS):
            part = entries[at : at + EMIT_ROWS]
            self.entries.put(part) if anew and at == 0 else self.entries.appendList(part)
        domains, counts = list(bag), list(bag.values())
        for at in range(0, len(domains), EMIT_ROWS):
            yield pd.DataFrame({"uid": key[0], "domain": domains[at : at + EMIT_ROWS], "n": counts[at : at + EMIT_ROWS]})
        if not domains:
            # A user without any usable domain is still scored (empty bag).
            yield pd.DataFrame({"uid": [key[0]], "domain": pd.array([None], dtype="string"), "n": [0]})

    def close(self) -> None:
        pass


class ExpiringDomainBag(StatefulProcessor):
    """A user's counts per domain in a map; entries idle for longer than the time-to-live are forgotten."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bag = handle.getMapState("domains", "domain string", "n long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        new = _new_counts(rows)
        uid, empty = key[0], True
        domains, counts = [], []
        for (domain,), (n,) in self.bag.iterator():
            if domain in new:
                new[domain] += n
                continue
            domains.append(domain)
            counts.append(n)
            if len(domains) == EMIT_ROWS:
                yield pd.DataFrame({"uid": uid, "domain": domains, "n": counts})
                domains, counts, empty = [], [], False
        for domain, n in new.items():
            self.bag.updateValue((domain,), (n,))
            domains.append(domain)
            counts.append(n)
        if domains:
            yield pd.DataFrame({"uid": uid, "domain": domains, "n": counts})
        elif empty:
            # A user without any usable domain is still scored (empty bag).
            yield pd.DataFrame({"uid": [uid], "domain": pd.array([None], dtype="string"), "n": [0]})

    def close(self) -> None:
        pass


def user_bag_stream(messages: DataFrame, state_ttl_ms: int | None = None) -> DataFrame:
    """``uid, domain, n``: full current bag of every user updated in a batch.

    Start it with ``STATE_CONF`` (``sinks``' functions take it as ``conf``). By
    default a user's state is kept for ever (as in the reference).
    ``state_ttl_ms`` bounds it instead: a domain that a user hasn't visited for
    longer (processing time) leaves the bag, and a user idle for longer starts a
    fresh one.
    """
    counted = visit_domain_stream(messages).mapInArrow(_combine, BAG_SCHEMA)
    mode = "None" if state_ttl_ms is None else "ProcessingTime"
    processor = DomainBag() if state_ttl_ms is None else ExpiringDomainBag(int(state_ttl_ms))
    return counted.groupBy("uid").transformWithStateInPandas(processor, BAG_SCHEMA, "Update", mode)


def scoring_sink(model: DomainModel, out: str, compact_every: int | None = None) -> sinks.VersionedSink:
    def score(batch: DataFrame) -> DataFrame:
        return model.score(batch, ("uid",)).select("uid", LABEL)

    return sinks.VersionedSink(out, score, compact_every, ("uid",))


def run_to_table(
    spark: SparkSession,
    messages: DataFrame,
    model: DomainModel,
    out: str,
    checkpoint: str,
    partitions: int = STATE_PARTITIONS,
    state_ttl_ms: int | None = None,
) -> DataFrame:
    stream = user_bag_stream(messages, state_ttl_ms)
    drain = sinks.run_available if state_ttl_ms is None else sinks.run_until_caught_up
    drain(stream, scoring_sink(model, out), checkpoint, "update", state_partitions=partitions, conf=STATE_CONF)
    return sinks.latest(spark, out, ("uid",))
