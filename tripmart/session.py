"""Session construction and the shared scratch location.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
we only set our own when it is unset (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: AQE hashes a shuffled join side whose partitions are all at most this large
HASH_JOINS = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tripmart") -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def cluster_settings(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the input instead of Spark's fixed defaults.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least 2x the cores) and AQE coalesces them at run time to the
    same advisory size, so a 100 TB month back-fill gets ~400k initial
    partitions of 256 MiB, each well inside an executor's memory, while a
    small month collapses to a few. Skewed partitions (a hot month, base or
    trip key) are split by AQE's skew handling for joins and REBALANCE writes.
    """
    parts = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on (time zone for second arithmetic); shuffle joins whose partitions turn
    out small enough to be hashed are not sorted, unless the session says otherwise."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(HASH_JOINS, "0b") in ("0", "0b"):
        spark.conf.set(HASH_JOINS, "64m")
    shared_dir(spark)
    return spark


_LOCAL_DIRS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or a checkpoint folder already set on the
    context). Only when neither exists and the master is local (a test) do we choose
    a folder ourselves; on a cluster that is an error. It is registered with the
    context, since that setting cannot be changed through the runtime conf.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, the conf is all there is
        sc = None
    d = spark.conf.get(CHECKPOINT_KEY, None) or (sc.getCheckpointDir() if sc else None) or _LOCAL_DIRS.get(id(spark))
    if not d:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tripmart-ckpt-")
        _LOCAL_DIRS[id(spark)] = d
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_root(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared directory for one run's tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tripmart/{label}-{uuid.uuid4().hex[:12]}"
