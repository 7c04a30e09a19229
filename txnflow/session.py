"""Spark session defaults and the shared staging area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Staged tables of this process, in order, so that drop_staged() can release them.
_staged: dict[str, None] = {}
_local_roots: dict[str, str] = {}


# Methods beyond 8000 bytes are never compiled by HotSpot; smaller generated units are.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Thousands of folders, such as those of saved batches, are listed by a few tasks; Spark's own setting starts one for each, up to 10,000.
LISTED = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}

# State of a stream in RocksDB: on the executors' disks, with little of it in memory for each partition, and saved as the changes of a micro-batch.
_ROCKS = "spark.sql.streaming.stateStore.rocksdb"
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKS}.changelogCheckpointing.enabled": "true",
    f"{_ROCKS}.trackTotalNumberOfRows": "false",
    f"{_ROCKS}.writeBufferSizeMB": "4",
    f"{_ROCKS}.blockCacheSizeMB": "4",
}


def build_session(app: str = "txnflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and a UTC clock."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **COMPILED,
        **LISTED,
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def keep_compiled(spark: SparkSession) -> None:
    """Set for a session that was built elsewhere what :func:`build_session` sets so that generated code is compiled and folders are listed in few tasks."""
    for key, value in {**COMPILED, **LISTED}.items():
        spark.conf.set(key, value)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside the block keep their state in RocksDB; a stream takes its settings when it starts, so they are put back at the end."""
    before = {key: spark.conf.get(key, None) for key in STATE_ON_DISK}
    try:
        for key, value in STATE_ON_DISK.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a ``local`` master falls back to a temporary folder; on a cluster a
    machine-local folder would be lost with its executor, so the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/") + "/txnflow"
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="txnflow-")
    return _local_roots[context.applicationId]


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the staging root."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    _staged[path] = None
    scope = _scope.get()
    if scope:
        scope.paths.append(path)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives lost executors.

    Parquet keeps later passes column-pruned and filter-pushed, which an
    RDD checkpoint would not.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    configuration = spark._jsc.hadoopConfiguration()
    dropped = 0
    for name in paths:
        path = hadoop_path(name)
        dropped += bool(path.getFileSystem(configuration).delete(path, True))
        _staged.pop(name, None)
    return dropped


def delete_paths(spark: SparkSession, paths: list[str]) -> int:
    """Delete files or folders, those that exist, through Spark's own file systems; how many there were."""
    return _delete(spark, paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    candidate = spark._jvm.org.apache.hadoop.fs.Path(path)
    return candidate.getFileSystem(spark._jsc.hadoopConfiguration()).exists(candidate)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables this process staged; call it when their readers are done."""
    return _delete(spark, list(_staged))


class Scope:
    """The tables that one job stages. Jobs that run side by side, in threads of one driver, have a scope each."""

    def __init__(self, spark: SparkSession, outer: Scope | None):
        self._spark, self._outer = spark, outer
        self.paths: list[str] = []

    def release(self, *labels: str) -> None:
        """Delete the tables staged under these labels: their last reader is done."""
        gone = [path for path in self.paths if path.rsplit("/", 1)[-1].rsplit("-", 1)[0] in labels]
        _delete(self._spark, gone)
        self.paths = [path for path in self.paths if path not in gone]

    def result(self, df: DataFrame, label: str = "result") -> DataFrame:
        """Stage ``df`` so that it outlives the scope."""
        token = _scope.set(self._outer)
        try:
            return stage(df, label)
        finally:
            _scope.reset(token)


_scope: ContextVar[Scope | None] = ContextVar("txnflow_scope", default=None)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[Scope]:
    """Delete what the caller stages inside the block at its end, for jobs that run again and again."""
    scope = Scope(spark, _scope.get())
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        _delete(spark, scope.paths)
