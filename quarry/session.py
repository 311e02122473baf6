"""Session construction and the shared scratch / checkpoint folder.

On a cluster the folder named by ``spark.checkpoint.dir`` is shared by all
executors (HDFS, S3, ...). We read it from the session and only fall back to a
private temporary folder when the session runs in local mode (tests).
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or attach to) a SparkSession with AQE and UTC session time.

    ``shuffle_partitions`` should be sized to the data: about one partition per
    128-256 MB of shuffled data on a cluster; AQE coalesces the small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM: a local folder is shared by all tasks (``local-cluster`` has executors of its own)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` when the session names one. Only a local-mode
    session without that setting gets a private temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        if root:
            return root
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that every executor shares")
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that every executor shares"
        )
    root = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(root)
    return root


#: Paths of written tables: those of the innermost scope, and those of no scope.
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)
_unscoped: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared checkpoint folder. What is written there belongs to the scratch scope
    around the call, or to the process: it is removed at the end of either."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/quarry-{label}-{uuid.uuid4().hex}"
    paths = _scope.get()
    (_unscoped if paths is None else paths).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the tables and files that queries called inside write; they are removed at the end.

    Queries are lazy and read their intermediate tables when the result is computed, so that must happen
    inside as well: ``with scratch_scope(spark): query(spark, sf_dir).write...``. Scopes may be nested.
    """
    token = _scope.set([])
    try:
        yield
    finally:
        paths = _scope.get() or []
        _scope.reset(token)
        remove_scratch(spark, paths)


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete the paths through Hadoop's file system, which also reaches shared stores. A Spark Connect client has none and leaves them."""
    try:
        found = [(path, hadoop_fs(spark, path)) for path in paths]
    except Exception:  # noqa: BLE001 - no JVM on the client, or the session has ended
        return
    for path, fs in found:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)
    paths.clear()


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, with the session's settings."""
    jvm = spark.sparkContext._jvm
    conf = jvm.org.apache.spark.deploy.SparkHadoopUtil.get().newConfiguration(spark.sparkContext._jsc.sc().conf())
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)


def _remove_unscoped() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _unscoped:
        remove_scratch(spark, _unscoped)


atexit.register(_remove_unscoped)
