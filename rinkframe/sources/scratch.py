"""Folders and small files in the store that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A fresh folder in the one named by spark.checkpoint.dir; a temporary one only where that is unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="rinkframe-")
    return f"{base.rstrip('/')}/rinkframe/{label}-{uuid.uuid4().hex}"


def hadoop(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_files(rows: DataFrame, to: str, path: str = "path", text: str = "text") -> int:
    """Write each row as one file below a folder, as captures do; a null text writes none. Returns the number of files.

    A task that runs again writes the same files again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(to)
        for b in batches:
            n = 0
            for name, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if body is None:
                    continue
                place = f"{root}/{name}"
                store.create_dir(place.rpartition("/")[0], recursive=True)
                with store.open_output_stream(place) as f:
                    f.write(body.encode())
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    counts = rows.select(path, text).mapInArrow(write, "n long")
    return counts.agg({"n": "sum"}).first()[0] or 0
