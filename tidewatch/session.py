"""Session settings, the shared working folder and staged tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on; all of them can be changed on a live session.
RUNTIME_SETTINGS = {
    # Log times are UTC text; a local zone would shift them and skip hours at DST changes.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM leaves methods above 8000 bytes of bytecode uncompiled; wide events exceed that when
    # a whole stage is one method, and run twice as fast operator by operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A packet with a repeated key keeps the last value instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keyed stream state with timers and expiry needs this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and make sure a checkpoint folder is known."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    work_dir(spark)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for what is started inside the block; a stream keeps what it was started with."""
    kept = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, kept)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder; on a cluster a missing setting is an error, because
    executors could not see a folder on the driver's disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="tidewatch-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/staged/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several branches read the same expensive result: the branches then scan only
    the columns they need, and a lost executor re-reads files instead of replaying lineage.
    With ``by``, rows of a value lie in a folder, and a reader that asks for some values opens only theirs.
    """
    path = _new_path(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_all(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """``stage`` for the union of ``parts``, at least one, each of which is written before the next is made."""
    path, last = None, None
    for last in parts:
        path = path or _new_path(last.sparkSession, name)
        last.write.mode("append").parquet(path)
    return last.sparkSession.read.schema(last.schema).parquet(path)


def _new_path(spark: SparkSession, name: str) -> str:
    path = stage_path(spark, name)
    scope = getattr(_scopes, "paths", None)
    if scope is not None:
        scope.append(path)
    return path


_scopes = threading.local()


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside the block at its end, when their readers have finished.

    Streams use it for every micro-batch; a batch job may put its writes inside one.
    """
    outer = getattr(_scopes, "paths", None)
    _scopes.paths = []
    try:
        yield
    finally:
        paths, _scopes.paths = _scopes.paths, outer
        for path in paths:
            remove(spark, path)


@contextmanager
def staged_paths() -> Iterator[list[str]]:
    """List the tables staged inside the block; its user removes them when they are no longer read."""
    outer = getattr(_scopes, "paths", None)
    _scopes.paths = mine = []
    try:
        yield mine
    finally:
        _scopes.paths = outer
        if outer is not None:
            outer.extend(mine)


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system a path is on, whatever its kind, and the path as that knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote."""
    system, folder = file_system(spark, path)
    system.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = file_system(spark, path)
    return system.exists(folder)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Move a folder that is written to the end to where readers look; done again, it changes nothing.

    Files keep their names, so a reader that remembers names takes each of them once, also
    where a move is a copy and was cut short.
    """
    system, folder = file_system(spark, path)
    if system.exists(folder):
        source = file_system(spark, staged)[1]
        if not system.exists(source):
            return
        for status in system.listStatus(source):
            target = spark._jvm.org.apache.hadoop.fs.Path(folder, status.getPath().getName())
            if not system.exists(target):
                system.rename(status.getPath(), target)
        system.delete(source, True)
        return
    system.mkdirs(folder.getParent())
    if not system.rename(file_system(spark, staged)[1], folder):
        raise OSError(f"{staged} can't be moved to {path}")


def computed_once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` plus costly ``columns`` that later filters use but never repeat.

    Spark moves a filter below the projection it reads from by copying the projected
    expressions into it, so a parsed or searched column would be worked out twice, and nested
    ones many times. A one-row generator gives the same rows and stops that.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))
