"""Spark session set-up and shared-storage locations.

Everything that must survive executor loss (streaming checkpoints, replay
copies, written intermediate tables) lives under the folder the cluster names
in ``spark.checkpoint.dir``.  Only when that setting is absent *and* Spark runs
in local mode (tests, laptops) do we create one under the system temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, app: str = "clickflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session tuned for this library; cluster settings come from spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.unix.domain.socket.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",   # no call-site capture for every column
    }
    if master and master.startswith("local"):
        conf["spark.driver.host"] = "127.0.0.1"
        conf["spark.driver.bindAddress"] = "127.0.0.1"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Event times are epoch milliseconds rendered in UTC (the reference's
    display zone is the JVM default; we pin it)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Reads ``spark.checkpoint.dir``; sets a local one only when it is unset and
    the master is local (a machine-local folder is useless on a cluster).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so checkpoints survive executor loss")
        root = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path below the checkpoint root (never reused between runs)."""
    leaf = "/".join(parts)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}"
    return f"{checkpoint_root(spark)}/clickflow/{leaf}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) of `path`; without a scheme it is the default file
    system's, as it is for Spark's readers and writers."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)
