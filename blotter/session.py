"""Session construction and shared scratch space.

Everything the library writes for itself (converted files, lineage cuts) goes
under ``spark.checkpoint.dir``, which on a cluster must name a shared folder.
We only invent a folder when the setting is absent *and* the master is local
(tests, benches); on a cluster a missing setting is an error, never a silent
fallback to a machine-local path.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: runtime re-planning (AQE) picks broadcast vs
# shuffle joins from measured sizes, coalesces small shuffle partitions and
# splits skewed ones.  Session time zone is pinned so calendar functions agree
# with the SQL oracle.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small shuffle partitions up to the advisory size instead of
    # keeping one per core: fewer tiny tasks on a busy cluster
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where the aggregate above could reuse the join's
    # partitioning (join key = group key), at the price of one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints are removed once no DataFrame uses them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Local-mode fallback folders, one per application.
_LOCAL_BASES: dict[str, str] = {}


def _local_cores(master: str) -> int | None:
    """Thread count of a ``local[N]`` / ``local[*]`` / ``local[N,F]`` master."""
    match = re.fullmatch(r"local(?:\[(\*|\d+)(?:,\s*\d+)?\])?", master.strip())
    if not match:
        return None
    n = match.group(1)
    if n is None:
        return 1
    return (os.cpu_count() or 1) if n == "*" else int(n)


def build_session(
    master: str = "local[8]",
    app: str = "blotter",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's scale settings.

    ``shuffle_partitions`` defaults to the core count of a local master; on a
    cluster it is left to the cluster's configuration (see
    :func:`partition_conf` for sizing it from the expected shuffle volume).
    """
    builder = SparkSession.builder.master(master).appName(app)
    settings = dict(SCALE_CONF)
    if shuffle_partitions is None:
        shuffle_partitions = _local_cores(master)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_base(spark)
    return spark


def partition_conf(
    shuffle_bytes: int, total_cores: int, target_bytes: int = 256 * 1024 * 1024
) -> dict[str, str]:
    """Sizing for a cluster run, from the expected shuffle volume.

    The initial shuffle partition count is high enough that each partition
    is about ``target_bytes`` (so sorts and hash tables fit in an executor's
    memory and spill little), and at least two waves of tasks; AQE then
    coalesces small partitions and splits skewed ones at runtime.
    """
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }


def checkpoint_base(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    base = _LOCAL_BASES.get(sc.applicationId)
    if base is None:
        base = tempfile.mkdtemp(prefix="blotter-ckpt-")
        _LOCAL_BASES[sc.applicationId] = base
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint directory."""
    return f"{checkpoint_base(spark)}/blotter-scratch/{name}-{uuid.uuid4().hex[:12]}"
