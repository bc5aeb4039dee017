"""Session construction and the shared scratch folder.

On a cluster the session is supplied by the platform; ``build_session`` is
for local runs and tests. ``scratch_root`` is where written tables and
checkpoints go: the cluster-wide ``spark.checkpoint.dir`` when it is set,
else (local runs only) a fresh folder that is then registered as the
checkpoint dir, so both code paths read the same setting.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "laborlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables: ``spark.checkpoint.dir`` of the session.

    Only when a session with a local master has none (tests, local bench) is a fresh
    local folder created and registered; on a cluster that names none this raises.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _LOCAL_ROOTS:
        return _LOCAL_ROOTS[app]
    root = sc.getConf().get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{_CHECKPOINT_KEY} is not set: a cluster needs a shared folder for written tables")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(root)
    _LOCAL_ROOTS[app] = root.rstrip("/")
    return _LOCAL_ROOTS[app]


_LOCAL_ROOTS: dict[str, str] = {}


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, never-used location under the scratch root (one per call)."""
    base = "/".join([scratch_root(spark), *parts])
    return f"{base}/{uuid.uuid4().hex}"


def _target(spark: SparkSession, path: str):
    """A path and its file system, through Spark's Hadoop configuration."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own, through Spark's file system."""
    target, fs = _target(spark, path)
    fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target, fs = _target(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _target(spark, path)
    return fs.exists(target)


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file; it is there or not, nothing in between."""
    target, fs = _target(spark, path)
    fs.create(target, False).close()


_SPLIT_KEY, _SPLIT = "spark.sql.files.maxPartitionBytes", 16 << 20
_PART_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def _at_most(spark: SparkSession, key: str, size: int) -> Iterator[None]:
    """A setting in bytes is ``size`` at most for the jobs begun here. The session's own returns at the end; a smaller one holds."""
    own = spark.conf.get(key)
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own) <= size:
        yield
        return
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, own)


def small_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs begun here read files in splits of 16 MB at most, so that a task that sorts or groups its split's rows holds few of them.

    Columnar files may unfold to thirty times their size.
    """
    return _at_most(spark, _SPLIT_KEY, _SPLIT)


def small_parts(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Jobs begun here take up to ``size`` shuffled bytes a task together, where AQE would merge partitions to larger ones."""
    return _at_most(spark, _PART_KEY, size)


def clear_scratch(spark: SparkSession) -> None:
    """Drop what was written under the scratch root, and databases whose tables lie there. Frames read from there are void then."""
    root = scratch_root(spark)
    for db in [d.name for d in spark.catalog.listDatabases() if (d.locationUri or "").replace("file:///", "file:/").removeprefix("file:").startswith(
            root.replace("file:///", "file:/").removeprefix("file:"))]:
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    for name in list_names(spark, root):
        drop_path(spark, f"{root}/{name}")
