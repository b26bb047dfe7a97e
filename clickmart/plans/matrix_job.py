"""C4: user x item matrix with carry-over of the previous snapshot.

Reads the split event files, pivots known users' views and buys per item,
adds the rows of the newest earlier snapshot when ``update`` is set, and
writes ``<out_dir>/<newest day>/`` as parquet.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from clickmart.operators import matrix
from clickmart.operators.checks import counted
from clickmart.sources import files


def users_items(
    spark: SparkSession,
    input_dir: str,
    out_dir: str,
    update: bool = True,
    fill_missing: bool = False,
    stats: dict | None = None,
) -> str:
    """Run the job; returns the written snapshot path.

    ``stats`` (optional dict) receives the written row count, observed
    during the write itself.
    """
    visits = files.read_split_events(spark, input_dir)
    # The newest day names the snapshot: taken from the day folders (a
    # listing, no data read); for files that carry the day inside, one
    # scalar aggregate.
    days = files.partition_values(spark, input_dir, "date")
    max_day = days[-1] if days else visits.agg(F.max("date")).first()[0]
    current = matrix.user_item_matrix(visits)
    result = matrix.carry_over(spark, current, out_dir, max_day, update, fill_missing)
    result, obs = counted(result, "users_items")
    path = matrix.write_snapshot(result, out_dir, max_day)
    if stats is not None:
        stats["rows"] = obs.get["rows"]
    return path
