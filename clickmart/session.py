"""Session set-up and shared-folder helpers.

Every entry point pins the session time zone to UTC first: day keys, hour
labels and window bounds all depend on it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC_CONF = {"spark.sql.session.timeZone": "UTC"}

MB = 1 << 20
TARGET_PARTITION_BYTES = 256 * MB
MIN_SHUFFLE_PARTITIONS = 200


def scale_conf(
    input_bytes: int,
    target_partition_bytes: int = TARGET_PARTITION_BYTES,
    min_partitions: int = MIN_SHUFFLE_PARTITIONS,
    max_partitions: int | None = None,
) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of input.

    Scan splits and shuffle partitions aim at ``target_partition_bytes``
    each (the shuffle count is the upper bound; AQE coalesces small ones at
    run time and splits skewed ones in joins). At 100 TB this gives about
    370,000; at a few GB the 200 floor. ``max_partitions`` is a cap for
    clusters that need one; there is none by default.
    """
    n = max(min_partitions, -(-int(input_bytes) // int(target_partition_bytes)))
    if max_partitions is not None:
        n = min(n, max_partitions)
    t = str(int(target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": t,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": t,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": t,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def get_session(
    app: str = "clickmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Return a session with UTC, AQE and Arrow on.

    ``master`` is only applied when no session exists yet (on a cluster the
    launcher decides). The UI stays off for batch runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        **UTC_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if input_bytes:
        conf.update(scale_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def input_bytes(spark: SparkSession, *paths: str | None) -> int:
    """Total size of the files under ``paths`` (globs allowed; a listing, no data read)."""
    total = 0
    for path in paths:
        if path:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
            total += sum(fs.getContentSummary(st.getPath()).getLength() for st in fs.globStatus(p) or [])
    return total


def apply_scale(spark: SparkSession, size: int) -> None:
    """Set ``scale_conf`` on a session; a local session keeps its own smaller shuffle width."""
    conf = scale_conf(size)
    if is_local(spark.sparkContext.master):
        conf.pop("spark.sql.shuffle.partitions")
    for k, v in conf.items():
        spark.conf.set(k, v)


def prepare(spark: SparkSession) -> SparkSession:
    """Pin UTC on an existing session (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[...]``)."""
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and staged outputs.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir) as
    the cluster names it. Only when neither is set, a local master gets a
    fresh local folder; on a cluster that folder would be one machine's own,
    so there it is an error.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None
        )
        if not root:
            if not is_local(sc.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="clickmart-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/clickmart-staging/{name}-{uuid.uuid4().hex[:12]}"
