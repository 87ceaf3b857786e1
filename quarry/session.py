"""Session construction and the shared scratch folder.

Intermediate tables, stream checkpoints and sink outputs go under the folder the cluster names
in ``spark.checkpoint.dir`` (a shared file system on a cluster). Only a local session with no
such setting gets a private temporary folder, which keeps tests self-contained.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # word directories such as "007" must stay strings when a fan-out is read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_session(master: str | None = None, app: str = "quarry", shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir). When it is
    unset, a local session gets a fresh temporary folder; a cluster session must configure one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not root:
        cur = sc.getCheckpointDir()
        if cur:
            root = cur.rsplit("/", 1)[0]
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="quarry-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared root (one per run and purpose)."""
    return f"{shared_root(spark)}/quarry/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (Hadoop) file system; metadata only."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
