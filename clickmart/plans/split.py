"""Decode event messages and write them split by event type and day.

One partitioned write replaces the reference's driver loop of one job per
day: every (type, day) present is written in the same job, and rewriting
replaces only the partitions present in the new data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.operators import events as E
from clickmart.operators.checks import counted_with
from clickmart.sources import files

SPLIT_TYPES = ("view", "buy")


def decoded_events(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """``value`` -> event columns plus ``date`` (yyyyMMdd, UTC)."""
    return E.with_day_key(E.decode_events(messages, value_col))


def split_events(
    messages: DataFrame,
    out_dir: str,
    types: Sequence[str] | None = SPLIT_TYPES,
    replace: bool = True,
    stats: dict | None = None,
) -> str:
    """Write ``<out_dir>/event_type=<t>/date=<yyyyMMdd>/`` JSON files.

    ``stats`` (optional dict) receives the decoded message count and the
    count of malformed messages, observed during the write itself.
    """
    ev = decoded_events(messages)
    obs = None
    if stats is not None:
        ev, obs = counted_with(ev, "split", malformed=F.count_if(F.col("timestamp").isNull()))
    path = files.write_split_events(ev, out_dir, types, replace)
    if obs is not None:
        stats.update(obs.get)
    return path
