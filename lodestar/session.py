"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill
in settings that are unset (tests, bench, local runs).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on.  Applied only when building a local session.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Local mode runs every task inside the driver JVM.
    "spark.driver.memory": "16g",
    # Static broadcast only for tables whose estimated size is tiny; larger
    # joins are planned as shuffle joins and AQE turns them into broadcasts
    # when the measured shuffle output is small (a runtime size check).
    "spark.sql.autoBroadcastJoinThreshold": str(2 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lodestar", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Catalog tables of a local run go to a scratch folder, not the working directory.
    conf["spark.sql.warehouse.dir"] = tempfile.mkdtemp(prefix="lodestar-warehouse-")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (a bare local test session) a scratch folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's setting applies
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder shared by all executors") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables written by the library.

    Lives next to the cluster's checkpoint folder so that every executor
    can reach it; never a machine-local temp folder on a cluster.
    """
    base = spark.conf.get("lodestar.scratch.dir", None)
    if base:
        return base
    ckpt = ensure_checkpoint_dir(spark)
    return ckpt.rstrip("/") + "/lodestar-scratch"
