"""Session helpers: building a session, the shared checkpoint folder, scratch paths.

The cluster names its shared checkpoint folder in ``spark.checkpoint.dir``; every
lineage cut (``checkpoint()``) and every scratch table of this package lives below
it. Only a local session with no such setting gets a private temporary folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Set only where the submitted configuration says nothing.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "seedwise",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session that keeps what was submitted.

    Only what the caller passes overrides the submitted configuration; the SQL defaults
    above fill keys that nobody set. Without ``master`` (or SEEDWISE_MASTER) the master
    comes from ``spark-submit`` or the cluster's defaults. A session with a master given
    here is a local or test session: its web page is off and its checkpoint files go when
    they are no longer referenced.
    """
    master = master or os.environ.get("SEEDWISE_MASTER")
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (builder.master(master).config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    submitted = dict(spark.sparkContext.getConf().getAll())
    for key, value in SQL_DEFAULTS.items():
        if key not in submitted:
            spark.conf.set(key, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, set on the context if only the conf names it.

    A plain ``local`` or ``local[n]`` session with no setting at all gets a fresh
    temporary folder (tests); any other master, ``local-cluster`` included, without
    ``spark.checkpoint.dir`` is an error, because a machine-local folder is not
    visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="seedwise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, below the shared checkpoint folder; the folder
    at that path is deleted when the session's JVM ends."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/seedwise-scratch/{name}-{uuid.uuid4().hex[:12]}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return f"{path}/data"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder, so a lost
    executor never forces a recomputation that could assign rows differently."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
