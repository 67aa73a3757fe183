"""Keyed tables in buckets, of which a write replaces only those that it touches.

    <path>/data/<write>/bucket_=<k>/...   Parquet, written by Spark's commit
    <path>/versions/<number>.json         which folders hold each bucket, and which run made the version

A version counts once its manifest has its name, which one rename gives it; what a killed write leaves behind
is named by no manifest and goes with the next `rotate`. Readers of a version are not disturbed by later ones.
One writer at a time: a second one that ends later fails on the name of its version, and writes again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import changes
from ..sources import scratch

Combine = Callable[[DataFrame, DataFrame], DataFrame]

#: A bucket of so many folders is written anew by the next append that falls into it.
FOLDERS = 16


class KeyedTable:
    """A table of rows by key. buckets: fixed when the table is made; a write touches at most one for each of its keys."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), list(key), buckets

    # Versions.

    def versions(self) -> list[int]:
        fs, p = scratch.hadoop(self.spark, f"{self.path}/versions")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """What a version, the last by default, holds."""
        if version is None:
            found = self.versions()
            if not found:
                return {"version": -1, "schema": None, "folders": {}, "run": None, "buckets": self.buckets}
            version = found[-1]
        text = self.spark.read.text(f"{self.path}/versions/{version:09d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        m = self.manifest(version)
        if m["schema"] is None:
            raise FileNotFoundError(f"no version in {self.path}")
        return self._folders(m, self._named(m))

    def runs(self) -> list[str]:
        """Runs that the kept versions come from, in order."""
        return [r for v in self.versions() if (r := self.manifest(v)["run"])]

    def _named(self, m: dict, buckets: Sequence[str] | None = None) -> list[str]:
        """Folders of some buckets, or all: the last one of each, and the earlier ones that appends left in place."""
        return [f for k, last in m["folders"].items() if buckets is None or k in buckets for f in (*m.get("earlier", {}).get(k, []), last)]

    def _folders(self, m: dict, folders: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    # Writes.

    def write(self, rows: DataFrame, combine: Combine, run: str | None = None) -> int:
        """A new version, in which buckets that rows fall into hold combine(their old rows, rows). Returns its number.

        A run that made one of the kept versions is not done again. combine gets None for the old rows of a new table,
        and must keep each row in its bucket, that is, not change keys.
        """
        return self._write(rows, combine, run)

    def _write(self, rows: DataFrame, combine: Combine, run: str | None, added: Combine | None = None) -> int:
        """`added` gives only the rows that come to the old ones, which then stay in their folders."""
        m = self.manifest()
        if run is not None and run in self.runs():
            return m["version"]
        self.buckets = m["buckets"]
        at = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).alias("bucket_")
        write = f"data/{uuid.uuid4().hex}"
        # Rows may come from a stream or a costly plan: they are computed once.
        rows.select("*", at).write.parquet(f"{self.path}/{write}-rows")
        held = self.spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("bucket_", T.LongType())])).parquet(f"{self.path}/{write}-rows")
        touched = sorted(str(r[0]) for r in held.select("bucket_").distinct().collect())  # at most as many as there are buckets
        held = held.drop("bucket_")
        old = self._folders(m, self._named(m, touched)) if m["schema"] else None
        earlier = m.get("earlier", {})
        stays = added is not None and old is not None and dict(old.dtypes) == dict(held.dtypes) and all(len(earlier.get(k, [])) < FOLDERS - 1 for k in touched)
        out = added(old, held).select(*old.columns) if stays else combine(old, held)
        # Large buckets are written by several tasks.
        out.select("*", at).hint("rebalance", F.col("bucket_")).write.partitionBy("bucket_").parquet(f"{self.path}/{write}")
        fs, p = scratch.hadoop(self.spark, f"{self.path}/{write}")
        made = {f.getPath().getName().split("=")[1] for f in fs.listStatus(p) if f.isDirectory() and "=" in f.getPath().getName()}
        last = m["folders"]
        if stays:
            earlier = earlier | {k: [*earlier.get(k, []), last[k]] for k in made if k in last}
        else:
            last, earlier = ({k: v for k, v in x.items() if k not in touched} for x in (last, earlier))
        self._delete(f"{write}-rows")
        schema = m["schema"] if stays else out.schema.jsonValue()
        return self._commit({"version": m["version"] + 1, "schema": schema, "folders": last | {k: f"{write}/bucket_={k}" for k in made}, "earlier": earlier, "run": run, "buckets": self.buckets})

    def _commit(self, m: dict) -> int:
        name = f"{self.path}/versions/{m['version']:09d}.json"
        fs, target = scratch.hadoop(self.spark, name)
        _, draft = scratch.hadoop(self.spark, f"{self.path}/drafts/{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        stream.write(json.dumps(m).encode())
        stream.close()
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(draft, target):
            raise FileExistsError(f"another write made version {m['version']}")
        return m["version"]

    def _delete(self, place: str) -> None:
        fs, p = scratch.hadoop(self.spark, f"{self.path}/{place}")
        fs.delete(p, True)

    def append(self, rows: DataFrame, run: str | None = None) -> int:
        """Add rows under keys that the table lacks; of several rows under a key one is added, the least.

        Rows of the table are not written again, but for a bucket of many folders.
        """

        def combine(old: DataFrame | None, new: DataFrame) -> DataFrame:
            new = changes.last_wins(new, self.key, [F.asc_nulls_first(c) for c in new.columns])
            if old is None:
                return new
            # Keys that are null are one key too.
            held = old.select(*[F.col(c).alias(f"held_{k}") for k, c in enumerate(self.key)])
            fresh = new.join(held, [F.col(c).eqNullSafe(F.col(f"held_{k}")) for k, c in enumerate(self.key)], "left_anti")
            return old.unionByName(fresh)

        def added(old: DataFrame, new: DataFrame) -> DataFrame:
            # Keys that the table has come before all others: one shuffle, no join.
            both = new.withColumn("new_", F.lit(True)).unionByName(old.select(*self.key, F.lit(False).alias("new_")), allowMissingColumns=True)
            return changes.last_wins(both, self.key, [F.asc("new_"), *[F.asc_nulls_first(c) for c in new.columns]]).where("new_").drop("new_")

        return self._write(rows, combine, run, added)

    def merge(self, rows: DataFrame, watched: Sequence[str], run: str | None = None) -> int:
        """Merge a snapshot by the single key: a row changes where a watched column gains a value or changes."""
        (key,) = self.key

        def combine(old: DataFrame | None, new: DataFrame) -> DataFrame:
            new = changes.last_wins(new, [key], [F.desc(c) for c in new.columns if c != key])
            return new if old is None else changes.merge_snapshots(old, new, key, list(watched)).drop("change_type")

        return self.write(rows, combine, run)

    def rotate(self, keep: int = 10) -> int:
        """Keep the last versions and what they name; the rest goes. Returns how many versions went."""
        found = self.versions()
        gone = found[:-keep] if keep else found
        for v in gone:
            self._delete(f"versions/{v:09d}.json")
        named = {f.split("/")[1] for v in self.versions() for f in self._named(self.manifest(v))}
        fs, p = scratch.hadoop(self.spark, f"{self.path}/data")
        for f in fs.listStatus(p) if fs.exists(p) else []:
            if f.getPath().getName() not in named:
                self._delete(f"data/{f.getPath().getName()}")
        self._delete("drafts")
        return len(gone)
