"""Session construction and shared-folder helpers.

Iterative and multi-pass operators cut lineage with tables written
(``materialize``) into the folder the cluster names in
``spark.checkpoint.dir``: one computation, a columnar copy, and a plan that
restarts from files after an executor loss.  That setting is read
from the session; a folder of our own is only chosen when it is unset and
the master is local (tests, notebooks).  On a cluster an unset value is an
error: a machine-local folder would not survive the loss of an executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import SparkSession

#: Scratch folders handed out, by application.
_WRITTEN: dict[str, list[str]] = {}

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "framewise",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE on and UTC timestamps."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir")
    if named:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="framewise-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is unset: name a shared folder (HDFS, S3, ...) "
        "so iterative operators can cut lineage")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint area for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/framewise-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_written(spark: SparkSession) -> int:
    """Number of scratch folders handed out so far: a mark for ``release_scratch``."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession, since: int = 0, keep: Sequence[str] = ()) -> None:
    """Delete the scratch folders handed out after the mark ``since``, but for
    those in ``keep``.  Call it once the results that were built on them have
    been written or read."""
    written = _WRITTEN.get(spark.sparkContext.applicationId, [])
    for path in written[since:]:
        if path not in keep:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    written[since:] = [p for p in written[since:] if p in keep]


def materialize(df, name: str, by: str | None = None):
    """Write ``df`` as parquet to a fresh folder in the shared checkpoint area
    and return the table read back: one computation, a columnar copy, and a
    plan that starts from files (lineage cut, survives executor loss).  With
    ``by`` the rows of each value of that column have a folder of their own."""
    path = scratch_path(df.sparkSession, name)
    if by is None:
        df.write.parquet(path)
        out = df.sparkSession.read.parquet(path)
    else:
        df.write.partitionBy(by).parquet(path)
        out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def shared_place(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system and path of a folder in the shared area, for tasks that read it by themselves."""
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return (fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")) if uri.startswith("file:") else fs.FileSystem.from_uri(uri)


def drop_materialized(df) -> None:
    """Delete a table of ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of finished queries.  Spark
    does so when the driver's JVM has collected the plans that wrote them,
    which by itself may happen long after a loop has filled the disks."""
    spark._jvm.System.gc()


__all__ = ["get_spark", "checkpoint_dir", "scratch_path", "materialize", "drop_materialized", "drop_shuffles",
           "shared_place", "release_scratch",
           "scratch_written"]
