"""Session construction and the shared scratch / checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on: UTC event time, AQE with skew-join
# splitting, Arrow transfer for operators that run Python in tasks.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Shard-partitioned writes open one file per shard per task instead of
    # sorting each task's rows by shard first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(master: str | None = None, app: str = "orderflow",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`DEFAULT_CONF` applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Taken from the session (``spark.checkpoint.dir`` or an already set
    checkpoint folder). Only a local-mode session without one gets a private
    temporary folder, removed when the program ends; a cluster session must
    name a shared folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        own = tempfile.mkdtemp(prefix="orderflow-ckpt-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
    else:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return sc.getCheckpointDir()


#: Open scopes, innermost last: the paths handed out in each.
_SCOPES: list[list[str]] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def write_scratch(df: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to ``path`` and read it back; the job's shuffle files go as soon as the table is there."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def scoped(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as a written table; tables that it wrote on the way are removed once this one is there.

    If it fails they stay, and go with the scope around it.
    """
    own: list[str] = []
    _SCOPES.append(own)
    try:
        df = build()
    except BaseException:
        _SCOPES.pop()
        if _SCOPES:
            _SCOPES[-1].extend(own)
        raise
    _SCOPES.pop()
    out = write_scratch(df, scratch_path(spark, name))
    for path in own:
        drop_path(spark, path)
    return out


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table folder, if there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def key_bloom(writer, key: str = "order_id"):
    """A Parquet writer that adds a Bloom filter on ``key`` to each row group, sized by its keys (64 KB to 1 MB)."""
    return writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``orderflow`` importable in Python workers (as ``--py-files`` would).

    Operators that run Python inside tasks pickle functions of this package by
    reference, so the executors need the package itself; it is zipped once per
    SparkContext and distributed with ``addPyFile``.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import orderflow
    pkg = os.path.dirname(os.path.abspath(orderflow.__file__))
    fd, path = tempfile.mkstemp(prefix="orderflow-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
