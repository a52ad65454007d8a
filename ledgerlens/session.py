"""Session construction and the shared folder for checkpoints and sinks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every ledgerlens job relies on.  Adaptive execution re-plans joins
# and coalesces shuffle partitions from runtime statistics and splits skewed
# join partitions; the session time zone is pinned so naive dates never move.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lets ``row_number() <= k`` keep k rows per task before the shuffle for k
    # up to this value (Spark's default stops at 1000); see operators.ranking.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerlens",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the ledgerlens defaults.

    On a cluster leave ``master`` unset and let the launcher decide; tests and
    the benchmark pass ``local[N]``.
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
    spark.sparkContext.setLogLevel("WARN")
    return spark


MIB = 1024 * 1024


def cluster_conf(
    shuffle_bytes: int,
    total_cores: int,
    target_partition_mib: int = 256,
    broadcast_mib: int = 64,
) -> dict[str, str]:
    """Sizing for a large cluster run (pass as ``extra_conf`` to ``build_session``).

    ``shuffle_bytes`` is the expected size of the largest shuffle (for the
    star view: the projected line columns, roughly a third of the lineitem
    bytes).  The initial partition count keeps each shuffle partition near
    ``target_partition_mib`` so it fits executor memory without spilling; AQE
    then coalesces small partitions and splits skewed ones at runtime.
    Broadcasts stay behind Spark's size check (``autoBroadcastJoinThreshold``).
    """
    partitions = max(2 * total_cores, -(-shuffle_bytes // (target_partition_mib * MIB)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mib}m",
        # Coalesce to the advisory size rather than keep many tiny partitions
        # (measured slower on one machine, where idle cores cost more).
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mib}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mib}m",
        "spark.sql.autoBroadcastJoinThreshold": f"{broadcast_mib}m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": f"{broadcast_mib}m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


def _context(spark: SparkSession):
    """The SparkContext of a classic session, or None (e.g. Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def application_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", "") or ""


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; it is read from the
    session.  Only a local session without that setting (tests, a laptop) gets
    a fresh folder of its own, which is then registered as the checkpoint dir.
    """
    sc = _context(spark)
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # not readable through the SQL conf on every version
            configured = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if sc is None or not (sc.master or "").startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for "
            "checkpoints and stream state"
        )
    base = os.environ.get("TMPDIR", "/tmp")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=base))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint root.

    Its folder is deleted when the application ends.
    """
    folder = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    sc = _context(spark)
    if sc is not None:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{folder}/data"
