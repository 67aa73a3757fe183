"""Shared scratch space: tables and files that must outlive the executor that wrote them."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession

_scopes: dict[str, list[tuple[SparkSession, str]]] = {}
_scope = ["session"]


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where it is unset, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else None
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="rinkframe-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, noted for `release`."""
    path = f"{shared_dir(spark)}/rinkframe/{label}-{uuid.uuid4().hex}"
    _scopes.setdefault(_scope[-1], []).append((spark, path))
    return path


def table(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back, which cuts its lineage."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def checkpointed(rdd: RDD) -> RDD:
    """An RDD held by a reliable checkpoint in the shared folder, computed once, and noted for `release`."""
    spark = SparkSession.active()
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    rdd = rdd.persist(StorageLevel.MEMORY_AND_DISK)
    rdd.checkpoint()
    rdd.count()
    rdd.unpersist()
    _scopes.setdefault(_scope[-1], []).append((spark, rdd.getCheckpointFile()))
    return rdd


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `table`; nothing that still has to run may read them."""
    for df in tables:
        drop(df.sparkSession, df._folder)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system, so that any store works."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scope(name: str):
    """Folders made inside belong to `name`, for one later call of `release`."""
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def release(name: str = "session") -> None:
    """Delete the folders of a scope; call it once no DataFrame that reads them is needed."""
    for spark, path in _scopes.pop(name, []):
        drop(spark, path)
