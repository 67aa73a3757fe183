"""Merkle manifest of a dataset: a tree a source, and one over the sources, by supersteps.

Rows are numbered within their source by a range-partitioned sort. A vertex stands for a
run of 81 nodes of a level and of the levels up to its own node, so a superstep climbs
four levels: vertices receive the digests of their children, hash once all are there, and
send their own digest upward. When a tree has one vertex left, its node is the subroot; the
subroots climb by the same supersteps to the root. Then reverse supersteps send each
vertex the siblings above it, and the lowest vertices make each leaf's proof and fold it
up to the root again.

A vertex receives 81 digests at most, whatever the sizes of sources, and a path reaches
81 leaves in one message, so a source that holds a third of all rows is as many vertices
as its rows need. Each superstep's vertices are an RDD with a reliable checkpoint; their
number falls by 81 from step to step. The driver gets one row a partition of the sort.

Defined cases: null fields are marked as such, unlike empty ones; a null doc_id comes
first in its source; rows with one doc_id are ordered by their digests; the null source is
a source of its own, the first; a source of one row has that leaf as its subroot, and a
single source's subroot is the root; texts of any length are hashed as they are; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage
from .words import arrow_bytes

#: Nodes that are hashed together, levels that a vertex spans, and so its children at most.
ARITY, LEVELS = 3, 4
SPAN = ARITY**LEVELS
#: Rows in a partition of the sort, and vertices in a partition of a superstep, about.
SORT_ROWS, PART_VERTICES = 1 << 20, 1 << 13

_LEAF = np.dtype([("doc_id", "<i8"), ("none", "u1"), ("leaf", "V32"), ("shown", "V32")])
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

#: A step of a proof: place among the run, and the others' digests, left to right.
Step = tuple[int, bytes]


def field(value: Column) -> Column:
    """A field as the leaves hold it: a mark for null, else its length in bytes and its text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def digest(parts: bytes) -> bytes:
    """Digests are hex text throughout, as they are hashed."""
    return hashlib.sha256(parts).hexdigest().encode()


def climb(children: list[bytes], first: bool) -> list[list[bytes]]:
    """Levels of a vertex from its children up to its own node.

    The first vertex of a level stops where one node is left: no other vertex is beside it then.
    """
    levels = [children]
    while len(levels) <= LEVELS and not (first and len(levels[-1]) == 1):
        now = levels[-1]
        levels.append([digest(b"".join(now[i : i + ARITY])) for i in range(0, len(now), ARITY)])
    return levels


def siblings(levels: list[list[bytes]], at: int) -> tuple[Step, ...]:
    """Steps from child number `at` up to the vertex's node."""
    out = []
    for level in levels[:-1]:
        place = at % ARITY
        run = level[at - place : at - place + ARITY]
        out.append((place, b"".join(run[:place] + run[place + 1 :])))
        at //= ARITY
    return tuple(out)


def fold(node: bytes, steps: Sequence[Step]) -> bytes:
    """The node that a proof leads to."""
    for place, others in steps:
        node = digest(others[: 64 * place] + node + others[64 * place :])
    return node


def numbered(leaves: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, int]], int]:
    """Leaves in order with their partition, run of a source, and place in it; where each partition begins; number of sources.

    leaves: group (the source), doc_id, leaf, shown. A partition begins at a number of a source and a place in it.
    """
    spark = leaves.sparkSession
    leaves = storage.table(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), leaves.count() // SORT_ROWS)
    order = ["group", "doc_id", "leaf", "row"]
    dealt = leaves.repartitionByRange(n, *order).sortWithinPartitions(*order)
    named = F.when(F.col("group").isNull(), F.lit("")).otherwise(F.sha2("group", 256)).alias("name")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, run, place = None, -1, 0
        for b in batches:
            runs, places = np.empty(len(b), np.int64), np.empty(len(b), np.int64)
            for k, name in enumerate(b.column(1).to_pylist()):
                if name != last:
                    last, run, place = name, run + 1, 0
                runs[k], places[k] = run, place
                place += 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(runs), pa.array(places), *b.columns[1:]], names=["part", "run", "place", "name", "doc_id", "leaf", "shown"])

    out = dealt.select(F.spark_partition_id().alias("part"), named, "doc_id", "leaf", "shown").mapInArrow(count, "part int, run long, place long, name string, doc_id long, leaf binary, shown binary")
    out = storage.table(out, "numbered")
    edge = F.struct("run", "place", "name")
    parts = out.groupBy("part").agg(F.min(edge).alias("first"), F.max(edge).alias("last"), F.sum((F.col("run") == 0).cast("long")).alias("head")).collect()
    starts, source, rows, name = {}, -1, 0, None
    for p in sorted(parts, key=lambda p: p.part):
        if p.first.name != name:
            source, rows = source + 1, 0
        starts[p.part] = (source, rows)
        rows = rows + p.head if p.last.run == 0 else p.last.place + 1
        source, name = source + p.last.run, p.last.name
    return out, starts, source + 1


def packed(rows: DataFrame, starts: dict[int, tuple[int, int]]) -> RDD:
    """Leaves put together by vertex: ((source, vertex), (first place in it, leaves))."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, run, place = (b.column(k).to_numpy() for k in range(3))
            begin = np.array([starts[p] for p in part.tolist()], np.int64).reshape(-1, 2)
            tree, at = begin[:, 0] + run, place + np.where(run == 0, begin[:, 1], 0)
            held = np.zeros(len(b), _LEAF)
            held["doc_id"], held["none"] = b.column(3).fill_null(0).to_numpy(), b.column(3).is_null().to_numpy(zero_copy_only=False)
            for k, name in ((4, "leaf"), (5, "shown")):
                held[name] = arrow_bytes(b.column(k))[0].view("V32")
            vertex = at // SPAN
            cuts = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (vertex[1:] != vertex[:-1])]))[: len(b)]
            bodies = [held[x:y].tobytes() for x, y in zip(cuts, np.append(cuts, len(b))[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(tree[cuts]), pa.array(vertex[cuts]), pa.array(at[cuts] % SPAN), pa.array(bodies, pa.binary())], names=["tree", "vertex", "place", "leaves"])

    out = rows.select("part", "run", "place", "doc_id", "leaf", "shown").mapInArrow(scan, "tree long, vertex long, place long, leaves binary")
    return out.rdd.map(lambda r: ((r.tree, r.vertex), (r.place, bytes(r.leaves))))


def _gather(messages: RDD, parts: int) -> RDD:
    """Vertices with what their children sent, in order."""
    return storage.checkpointed(messages.groupByKey(parts).mapValues(lambda sent: b"".join(x for _, x in sorted(sent))))


def _leaf_digests(body: bytes) -> list[bytes]:
    return [x.hex().encode() for x in np.frombuffer(body, _LEAF)["leaf"].tolist()]


def _digests(body: bytes) -> list[bytes]:
    return [body[i : i + 64] for i in range(0, len(body), 64)]


def _parts(rows: int, most: int) -> int:
    return max(1, min(most, rows // PART_VERTICES + 1))


def upward(vertices: RDD, children, nodes: int, most: int) -> list[RDD]:
    """Supersteps from the lowest vertices until each tree has one: the vertices of each step."""
    steps = [vertices]
    while (nodes := -(-nodes // SPAN)) > 1:
        send = lambda kv, read=children: ((kv[0][0], kv[0][1] // SPAN), (kv[0][1] % SPAN, climb(read(kv[1]), kv[0][1] == 0)[-1][0]))
        vertices, children = _gather(vertices.map(send), _parts(nodes, most)), _digests
        steps.append(vertices)
    return steps


def downward(steps: list[RDD], paths: RDD) -> RDD:
    """Reverse supersteps: from what is above the highest vertices to what is above the lowest."""

    def send(kv):
        (tree, vertex), (body, (above, *rest)) = kv
        children = _digests(body)
        levels = climb(children, vertex == 0)
        for k in range(len(children)):
            yield (tree, vertex * SPAN + k), (siblings(levels, k) + above, *rest)

    for vertices in reversed(steps[1:]):
        parts = vertices.getNumPartitions()
        paths = vertices.join(paths.partitionBy(parts), parts).flatMap(send)
    return paths


def _proofs(kv) -> Iterator[tuple]:
    """Rows of the leaves of one of the lowest vertices."""
    (_, vertex), (body, (above, subroot, root)) = kv
    held, leaves = np.frombuffer(body, _LEAF), _leaf_digests(body)
    levels, tail, folded = climb(leaves, vertex == 0), b"".join(x for _, x in above), {}
    subroot, root = subroot.decode(), root.decode()
    ids, none, shown = held["doc_id"].tolist(), held["none"].tolist(), held["shown"].tolist()
    for k, own in enumerate(leaves):
        steps = siblings(levels, k)
        node = fold(shown[k].hex().encode(), steps)
        if node not in folded:
            folded[node] = fold(node, above).decode()
        proof = hashlib.sha256(b"".join(x for _, x in steps) + tail).hexdigest()
        yield None if none[k] else ids[k], own.decode(), subroot, root, proof, folded[node], folded[node] == root


def prove(leaves: DataFrame) -> DataFrame:
    """Proof of each row and what it leads to (RESULT). leaves: group, doc_id (long), leaf, shown (the leaf as it is presented)."""
    spark = leaves.sparkSession
    rows, starts, sources = numbered(leaves)
    if not sources:
        return spark.createDataFrame([], RESULT)
    n, most = rows.count(), max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lowest = _gather(packed(rows, starts), max(most, n // SPAN // PART_VERTICES))
    steps = upward(lowest, _leaf_digests, n, most)
    read = _leaf_digests if len(steps) == 1 else _digests
    subroots = steps[-1].map(lambda kv: ((0, kv[0][0] // SPAN), (kv[0][0] % SPAN, climb(read(kv[1]), True)[-1][0])))
    tops = upward(_gather(subroots, _parts(-(-sources // SPAN), most)), _digests, sources, most)
    # The highest vertex knows the root; what is above it is nothing.
    paths = downward(tops, tops[-1].map(lambda kv: (kv[0], ((), climb(_digests(kv[1]), True)[-1][0]))))

    def to_sources(kv):
        (_, vertex), (body, (above, root)) = kv
        children = _digests(body)
        levels = climb(children, vertex == 0)
        for k, subroot in enumerate(children):
            yield (vertex * SPAN + k, 0), (siblings(levels, k) + above, subroot, root)

    parts = tops[0].getNumPartitions()
    paths = downward(steps, tops[0].join(paths.partitionBy(parts), parts).flatMap(to_sources))
    parts = lowest.getNumPartitions()
    found = lowest.join(paths.partitionBy(parts), parts).flatMap(_proofs)
    return spark.createDataFrame(found, RESULT, verifySchema=False)


def manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), doc_id: str = "doc_id", source: str = "source", shown: dict[str, Column] | None = None) -> DataFrame:
    """Leaves, subroots, root and proofs of all rows; each is verified as it is shown: with the columns in `shown` in place of its own."""
    own = leaf([F.col(c) for c in fields])
    seen = leaf([(shown or {}).get(c, F.col(c)) for c in fields]) if shown else own
    return prove(docs.select(F.col(source).cast("string").alias("group"), F.col(doc_id).cast("long").alias("doc_id"), own.alias("leaf"), seen.alias("shown")))
