"""Session construction and shared-storage locations.

On a cluster the checkpoint / lake folders must live on shared storage named
by the cluster (``spark.checkpoint.dir``). Only a local-mode session without
that setting (tests, laptop runs) gets a private scratch folder.
"""

from __future__ import annotations

import atexit
import logging
import math
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every barlake job relies on: UTC wall clock (bars carry naive
# timestamps), ANSI errors instead of silent overflow, AQE for runtime
# re-planning (broadcast demotion, partition coalescing, skew splitting) and
# dynamic partition overwrite so re-runs replace only the days they touch.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # AQE never coalesces below this size; kept small so a write fanning out
    # to many day partitions keeps several tasks even when the data is small
    # (large inputs are unaffected: their partitions are far above it)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove reliable checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

log = logging.getLogger(__name__)

LAKE_ROOT_CONF = "spark.barlake.lake.root"


def build_session(
    master: str | None = None,
    app_name: str = "barlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the barlake defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control on a
    cluster. ``shuffle_partitions`` should be sized so one post-shuffle
    partition stays around 128-256 MB at the target scale; AQE coalesces it
    down for small inputs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    return spark


def cluster_conf(input_bytes: int, *, shuffled_share: float = 1.0, partition_bytes: int = 256 << 20,
                 scan_split_bytes: int = 512 << 20, min_partitions: int = 200,
                 max_blocks: int = 2_000_000_000) -> dict[str, str]:
    """Settings sized from the input volume for a cluster run.

    ``shuffled_share`` of the input (what filters and pruned columns leave)
    crosses a shuffle, in partitions of about ``partition_bytes``; AQE coalesces
    small ones and splits skewed ones. A shuffle has scan tasks x partitions
    blocks; where these would pass ``max_blocks``, scan splits and partitions both
    grow, so that neither the blocks nor the driver's map statuses do."""
    partitions = max(min_partitions, -(-int(input_bytes * shuffled_share) // partition_bytes))
    splits = max(1, -(-input_bytes // scan_split_bytes))
    if (excess := splits * partitions / max_blocks) > 1:
        scan_split_bytes = int(scan_split_bytes * math.sqrt(excess)) + 1
        partitions = max(min_partitions, int(partitions / math.sqrt(excess)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def _is_local(spark: SparkSession) -> bool:
    try:
        return re.match(r"local(\[|$)", spark.sparkContext.master) is not None  # local-cluster is a cluster
    except Exception:  # Spark Connect: no driver-side SparkContext
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only when it
    is unset on a local-mode session (tests) is a private folder created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared "
            "checkpoint folder"
        )
    folder = tempfile.mkdtemp(prefix="barlake-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def fingerprint(spark: SparkSession, path: str) -> tuple:
    """Bytes, files and last change of a table's folder or file: another value means
    that its content may have changed."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(location)
    return size.getLength(), size.getFileCount(), fs.getFileStatus(location).getModificationTime()


def lake_root(spark: SparkSession) -> str:
    """Root folder for written layers: ``spark.barlake.lake.root`` when set,
    else a ``lake`` folder beside the checkpoint data (shared on a cluster)."""
    configured = spark.conf.get(LAKE_ROOT_CONF, None)
    if configured:
        return configured.rstrip("/")
    return checkpoint_dir(spark).rstrip("/") + "/lake"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique table location under the lake root."""
    return f"{lake_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new location for a table that only this application reads. The application's
    scratch folder is deleted when the driver ends; that of a driver that was killed
    can be told by the application's id in its name."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = folder = f"{lake_root(spark)}/scratch-{app}"
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        atexit.register(_delete_at_exit, files, location)
    return f"{_scratch[app]}/{name}-{uuid.uuid4().hex[:12]}"


def _delete_at_exit(files, location) -> None:
    try:
        files.delete(location, True)
    except Exception as gone:  # the JVM may have ended before the driver's Python
        log.warning("scratch tables are left in %s (%s)", location, type(gone).__name__)
