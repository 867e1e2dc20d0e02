"""Session helpers: building a local session for tests and benches, and
finding the shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "qbank") -> SparkSession:
    """A session tuned the way the library expects: AQE on (runtime coalescing
    and skew-join splitting), UTC, Arrow for the two pandas boundaries, UI off."""
    master = master or os.environ.get("QBANK_MASTER", "local[8]")
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # page markup is CPU-heavy per byte (parsing in Python): smaller scan
        # splits and shuffle targets keep tasks short and spill-free
        .config("spark.sql.files.maxPartitionBytes", "64m")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # rows per Arrow batch into the Python hops: pages can be large
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("QBANK_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )


def _context(spark: SparkSession):
    """The SparkContext of a classic session, None for a remote one."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def app_key(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else str(id(spark))


def default_parallelism(spark: SparkSession) -> int | None:
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets a scratch
    folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = _context(spark)
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:  # a remote (Connect) session: only the conf can name the folder
        if conf:
            return conf
        raise RuntimeError("spark.checkpoint.dir is not set on this session")
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running stages that must not be recomputed")
    path = tempfile.mkdtemp(prefix="qbank-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialize(df: DataFrame, name: str = "stage",
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    Used after every model-inference stage: the replies are costly, so a retry
    of a later stage (or a lost executor) must re-read them, not re-ask the
    backend. A reliable ``checkpoint`` is used (never ``localCheckpoint``).
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)
