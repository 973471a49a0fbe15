"""Sessions with the settings that the layers rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Scratch folders that this process has been given.
SCRATCH: list[str] = []

# Hours are cut in the session time zone; UTC keeps them the same everywhere. The
# adaptive settings size shuffle partitions from what was really shuffled and split
# the skewed ones, so no partition count is fixed for a particular data size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state on local disk with changelogs rather than on the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

DELTA_SETTINGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
MEBIBYTE = 1 << 20
BYTES_PER_SHUFFLE_PARTITION = 512 * MEBIBYTE
MIN_SHUFFLE_PARTITIONS = 200
BYTES_PER_SCAN_TASK = 128 * MEBIBYTE
#: Scan tasks beyond which they grow rather than multiply.
SCAN_TASKS = 200_000


def sizing(input_bytes: int) -> dict[str, str]:
    """Settings for a run over a table of about ``input_bytes``.

    Adaptive execution merges shuffle partitions that turn out small but does not
    divide those of an aggregate or a window, so a run starts with enough of them,
    however large the table. Shuffle blocks number scan tasks times shuffle partitions,
    so past 24 TiB scan tasks read more instead of becoming more.
    """
    partitions = max(-(-input_bytes // BYTES_PER_SHUFFLE_PARTITION), MIN_SHUFFLE_PARTITIONS)
    scan = max(BYTES_PER_SCAN_TASK, -(-input_bytes // SCAN_TASKS))
    return {
        INITIAL_PARTITIONS: str(partitions),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MEBIBYTE),
        SCAN_BYTES: str(scan),
    }


def size_for(spark: SparkSession, path: str) -> None:
    """Sizes the session's next jobs for the table at ``path``, from the size of its files.

    Partition counts and scan tasks only grow beyond what the session has been given;
    a smaller table gets these back.
    """
    wanted = sizing(stored_bytes(spark, path))
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if int(wanted[INITIAL_PARTITIONS]) > max(given, MIN_SHUFFLE_PARTITIONS):
        spark.conf.set(INITIAL_PARTITIONS, wanted[INITIAL_PARTITIONS])
        spark.conf.set(SCAN_BYTES, wanted[SCAN_BYTES])
    else:
        spark.conf.unset(INITIAL_PARTITIONS)
        spark.conf.unset(SCAN_BYTES)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``; none where nothing is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def build_session(
    app: str,
    table_format: str = "parquet",
    packages: str | None = None,
    input_bytes: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session for the layers. Master and memory come from spark-submit.

    ``packages`` are Maven coordinates of connectors (Delta, Kafka) that are not on
    the class path yet; ``input_bytes`` sizes the run, see :func:`sizing`.
    """
    builder = SparkSession.builder.appName(app)
    chosen = dict(SETTINGS)
    if input_bytes is not None:
        chosen.update(sizing(input_bytes))
    if table_format == "delta":
        chosen.update(DELTA_SETTINGS)
    if packages:
        chosen["spark.jars.packages"] = packages
    chosen.update(settings or {})
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for intermediate tables, in the cluster's shared folder.

    Every executor must see it, so a cluster has to name the folder in
    ``spark.checkpoint.dir``. Only a local session falls back to its own disk. What was
    written there is removed when the process ends.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        shared = tempfile.gettempdir()
    path = f"{shared.rstrip('/')}/tidemark-{purpose}-{uuid.uuid4().hex}"
    if not SCRATCH:
        atexit.register(remove_scratch)
    SCRATCH.append(path)
    return path


def remove_scratch() -> None:
    """Removes all scratch folders of this process; results read from them are gone then."""
    paths = [SCRATCH.pop() for _ in range(len(SCRATCH))]
    spark = SparkSession.getActiveSession()
    for path in paths:
        parts = urlparse(path)
        if parts.scheme in ("", "file"):
            shutil.rmtree(parts.path, ignore_errors=True)
        elif spark is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
