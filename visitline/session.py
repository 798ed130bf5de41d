"""Session settings the operators are designed for, and lineage cuts.

On a cluster the session comes from the platform; ``configure`` only sets
what the plans rely on (AQE with skew-join splitting). Tests and the bench
build a local session with ``local_session``.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

PLAN_CONF = {
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs an extra shuffle above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


MB = 1024 * 1024


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Shuffle and scan sizing for an input of ``input_bytes`` (compressed Parquet).

    The first shuffle gets one partition per ``target_partition_bytes`` of
    input (at least 200); AQE then coalesces partitions that
    the projections and partial aggregates made small, towards 128 MB each.
    Scans split files at 256 MB. At 100 TB that is about
    400,000 initial shuffle partitions and as many scan tasks.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
    }


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply ``PLAN_CONF`` and, when the input size is known, ``scale_conf``."""
    conf = dict(PLAN_CONF)
    if input_bytes is not None:
        conf.update(scale_conf(input_bytes))
    for k, v in conf.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "visitline") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``).

    Only a local session (one process) without one gets a fresh temporary
    folder, removed when it ends; a cluster session must name a shared folder. On a Spark Connect client,
    which has no SparkContext, the configured folder is used as it is.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder to cut lineage") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder to cut lineage on a cluster")
        configured = tempfile.mkdtemp(prefix="visitline-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


_job_folder: ContextVar[str | None] = ContextVar("visitline_job_folder", default=None)


def scratch_folder(spark: SparkSession) -> str:
    """A new path under the job's folder if there is one (``job_scratch``), else under the checkpoint folder."""
    base = _job_folder.get() or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/visitline-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """One folder for all cuts made inside, removed at the end: what the job returns must be written by then."""
    folder = scratch_folder(spark)
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def cut_lineage(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table under the checkpoint folder and read it back.

    Used where a chain of shuffles feeds several consumers: each consumer's
    plan starts at a file scan (with column pruning and real size statistics
    for AQE), and a lost executor recomputes from these files, not from the
    raw forms. Unlike an eager RDD ``checkpoint()``, which runs its input
    once to count and again to save, the table is computed once. Inside
    ``job_scratch`` the files go with the job; else they stay in the checkpoint folder.
    ``partition_by`` lays the table out by columns, so that a consumer of one value reads only its files.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
