"""Session defaults and shared-folder helpers.

Nothing here starts a server: the Spark UI stays off.  Durable intermediate output
(checkpoints, snapshots written by the registered queries) goes to the folder the
cluster names in ``spark.checkpoint.dir``; a local fallback is only used for
``local[...]`` masters (tests and benchmarks).
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCALE_DEFAULTS = {
    # Runtime re-planning: broadcast only when the measured build side is small,
    # coalesce small shuffle partitions, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of unreferenced frames are removed, not left in the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(
    input_bytes: int,
    *,
    split_bytes: int = 256 << 20,
    shuffle_bytes: int = 1 << 30,
    max_shuffle_partitions: int = 50_000,
) -> dict[str, str]:
    """Partition sizing for a given input volume.

    Scan splits target ``split_bytes`` (256 MiB per task).  The shuffle starts with
    one partition per ``shuffle_bytes`` of input (a shuffle carries only the pruned,
    filtered columns, so real partitions are smaller), capped so the driver's map-
    output metadata stays small; AQE then coalesces partitions to the advisory size
    and splits any partition over 4x the median and 1 GiB (skew).
    """
    n = max(200, min(max_shuffle_partitions, -(-input_bytes // shuffle_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    }


def get_session(
    master: str | None = None,
    app_name: str = "martkit",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it.  Only a local-mode session
    without that setting gets a private folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
        )
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder, deleted when the driver ends."""
    sc = spark.sparkContext
    path = f"{checkpoint_dir(spark).rstrip('/')}/martkit-scratch/{name}-{uuid.uuid4().hex}"
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def release_heap(spark: SparkSession) -> None:
    """Give back what the driver's heap no longer uses.

    Saving, loading or sending out a model of many trees leaves serialized copies of it on the
    heap, which otherwise grows to its limit before they are collected.
    """
    gc.collect()  # else Python still refers to models that are out of use
    spark.sparkContext._jvm.System.gc()


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts lineage and survives lost executors like a checkpoint, but later passes read only
    the columns and row groups that they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
