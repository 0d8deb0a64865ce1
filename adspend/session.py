"""Session set-up and the shared folder for lineage cuts."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at scale; every one is a plain Spark setting.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Spark's own checked broadcast: a join side is broadcast only when its
    # (estimated or, under AQE, measured) size is below this bound; beyond it
    # the join stays a shuffled sort-merge / hash join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[*]", *, shuffle_partitions: int = 8,
                  app_name: str = "adspend", driver_memory: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Where it is unset a fresh folder is made, but only
    for a local master (tests): on a cluster a folder of one machine is no
    shared folder, so the setting is asked for.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="adspend-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared one, for a table that a job writes and reads again."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark removes a query's shuffle files when the query ends (else when the driver happens to collect garbage).
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """The session's setting meanwhile."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Queries that run meanwhile leave no shuffle files."""
    return setting(spark, CLEAN_UP, "true")


def workers_import(spark: SparkSession) -> None:
    """Let Python workers find this package where it is not installed: its folder goes on the path they start with
    (local runs; on a cluster it is installed or passed with --py-files)."""
    home, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if home not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [home, env.get("PYTHONPATH")]))
