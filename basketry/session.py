"""Session helpers for tests, the bench and the query registry.

Library functions never build a session; callers own it.  ``local_session``
exists for tests and ``bench.py`` only.  ``shared_dir`` returns a folder that
every executor can reach: the cluster names it in ``spark.checkpoint.dir``;
only when that is unset (local tests) do we create one under /tmp.
"""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

# Settings every job here assumes: UTC hours (no DST shifts), AQE on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "basketry") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove checkpoint files once the frames that read them are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Pin the session setting the jobs' results depend on (UTC hours).  The
    other settings of ``REQUIRED_CONF`` are Spark's defaults and only matter
    for speed; ``jobs.py`` sets them all when it creates the session."""
    spark.conf.set("spark.sql.session.timeZone", REQUIRED_CONF["spark.sql.session.timeZone"])


def shared_base(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one ``spark.checkpoint.dir``
    names, else the context's checkpoint folder.  Where neither is set, Spark
    itself must run in this one process (tests, the bench) for a folder of our
    own to be good enough; otherwise the job stops."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    in_process = context._jsc.sc().isLocal()
    if base:
        if not in_process and base.startswith("file:"):
            warnings.warn(f"spark.checkpoint.dir is {base}: every executor must see the same folder there", stacklevel=2)
        return base
    if not in_process:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach (e.g. on HDFS or object storage)")
    base = tempfile.mkdtemp(prefix="basketry-ckpt-")
    context.setCheckpointDir(base)
    return context.getCheckpointDir() or base


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have Hadoop's file system remove ``path`` when the application ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique (not yet existing) path under the shared folder, for
    jobs that write a table and read it back; removed when the application
    ends, unless it is killed."""
    base = shared_base(spark)
    path = f"{base}{'' if base.endswith('/') else '/'}{name}-{uuid.uuid4().hex}"
    remove_at_exit(spark, path)
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and return a frame
    that reads it back.  Used where a result feeds several passes (a fit and a
    transform): the passes read only the columns they need of the written
    table, and a lost executor costs a re-read, not a recomputation."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
