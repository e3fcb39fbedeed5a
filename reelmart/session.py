"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on; a cluster may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Filters of supported titles and named people below the shuffle of the big sources. The defaults
    # give up on key sets beyond 10 MB; here the key side may be any catalogue, the filter has 8 MB (64 at most).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1tb",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "10000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "50000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
}


def get_session(master: str | None = None, app_name: str = "reelmart",
                shuffle_partitions: int | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a cluster
    leave them to ``spark-submit`` so AQE sizes partitions from the data.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stored tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only on a local master, where all
    tasks share one disk, a scratch folder is created when that is unset.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="reelmart-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["DEFAULT_CONF", "get_session", "checkpoint_root", "scratch_path"]
