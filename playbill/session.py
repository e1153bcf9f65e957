"""Session settings and the shared folder for intermediate files."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are planned for. AQE splits skewed join partitions and
# resizes shuffles, so no operator fixes a partition count of its own.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_local_dir: str | None = None


def tuned_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session with the recommended settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where they share the driver's disk.

    On a cluster the package goes along with ``--py-files`` instead.
    """
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (_ROOT, env.get("PYTHONPATH")) if x)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a session in one process (``local`` or ``local[n]``) without that setting
    gets a temporary folder, removed when it ends; on a cluster, ``local-cluster``
    included, a machine-local folder would lose data with its executor.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="playbill-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/playbill-{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let boosted trees cut their lineage: they checkpoint only when a folder is set."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
