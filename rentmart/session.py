"""Session construction and the shared scratch / checkpoint location.

The cluster decides: the master, the memory, the shuffle width and every other
setting that ``spark-submit`` (or ``PYSPARK_SUBMIT_ARGS``, or the defaults file)
names is left as it is. Only settings nobody made get a value here.

On a cluster the checkpoint folder is the shared location the cluster names in
``spark.checkpoint.dir``; it is read from the session and never invented. Only a
``local[...]`` session without that setting (tests, the bench) gets a fresh
folder of its own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: SQL settings given a value where the session's configuration names none
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, cpus: int | None = None,
                  app: str = "rentmart", extra: dict | None = None) -> SparkSession:
    """The session of the launcher, with ``DEFAULTS`` where it is silent.

    ``master`` or ``cpus`` ask for a session of one's own (the bench, tests): a
    local one on ``cpus`` threads unless ``master`` names another. ``extra``
    settings are the caller's and are always made. A local session whose
    shuffle width nobody set gets about twice its cores.
    """
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ     # started by spark-submit
    b = SparkSession.builder.appName(app)
    if master or cpus:
        b = b.master(master or f"local[{cpus}]")
    if not submitted:
        # checkpoint files of numbered dimensions are removed once unreferenced
        b = (b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    sc = spark.sparkContext
    defaults = dict(DEFAULTS)
    if sc.master.startswith("local"):
        defaults["spark.sql.shuffle.partitions"] = str(max(8, 2 * sc.defaultParallelism))
    made = sc.getConf()
    for k, v in defaults.items():
        if not made.contains(k) and k not in (extra or {}):
            spark.conf.set(k, v)
    sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local sessions."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/ABFS) "
            "for checkpoints and scratch tables")
    folder = tempfile.mkdtemp(prefix="rentmart-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def let_go(spark: SparkSession) -> None:
    """Asks for the files of plans that are done with.

    Spark removes the shuffle files of a plan, and its checkpoints where the session says so, once the driver has collected it
    as garbage, which it cannot while Python still holds one of its frames.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
