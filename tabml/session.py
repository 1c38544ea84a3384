"""Session helpers.

The library never creates or stops the session it works on; callers inject one.  ``local_session`` exists for
tests, the benchmark and the command line.  ``scratch_dir`` hands out folders under the shared checkpoint
directory the cluster names in ``spark.checkpoint.dir``; only a local session without that setting gets a
folder under the machine's temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution re-plans shuffles at run time, coalesces small partitions,
# splits skewed join partitions; ANSI stays on so bad casts fail loudly unless ``try_cast`` is used on purpose.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tabml") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TABML_DRIVER_MEMORY", "4g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, registering it with the SparkContext.

    Uses ``spark.checkpoint.dir`` from the session.  Only a local session without that setting gets a fresh
    folder of its own; a cluster session without it is an error (a machine-local folder would not be shared).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster session")
        conf_dir = tempfile.mkdtemp(prefix="tabml-ckpt-")
        try:  # recorded for readers of the setting; the context below is what Spark uses
            spark.conf.set("spark.checkpoint.dir", conf_dir)
        except Exception:  # noqa: BLE001 — some session modes refuse core settings at run time
            pass
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint directory (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabml-{name}-{uuid.uuid4().hex}"
