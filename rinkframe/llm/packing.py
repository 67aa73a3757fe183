"""Best-fit packing under conflicts.

Documents are packed into bins of a fixed number of words; no bin holds two documents
of one source or of one duplicate cluster. Bins are kept in order of what they have
left, each with a bitmap of its sources and of its clusters; a document goes to the
first compatible bin from the tightest that can hold it upwards, else to a new bin.
A document longer than a bin is cut into pieces, of which all but the last fill a bin.

Documents are dealt by a hash into groups of about `group_rows`, each packed by itself,
largest first; only sizes and codes travel, so a group takes a few MB. A source or
cluster with a third of all rows spreads over all groups.

Defined cases: a null text has no words and yields one piece of size 0; a null source
is a source like any other; a null cluster conflicts with nothing; rows that tie are
ordered by doc_id and hash; repeated rows are packed each on their own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage
from .words import squeeze, word_count

CAPACITY, GROUP_ROWS = 2048, 2048

_SCHEMA = "doc_id long, piece long, first_word long, n_words long, bin_id long, bin_words long"


class Bins:
    """Open bins in order of residual, then age; bitmaps of one word per 63 codes."""

    def __init__(self, n_sources: int, n_clusters: int):
        self.wide = (n_sources + 62) // 63 + 1
        self.keys: list[tuple[int, int]] = []  # residual and number of each bin
        self.maps = np.zeros((64, self.wide + (n_clusters + 62) // 63 + 1), np.int64)
        self.n = 0

    def bits(self, source: int, cluster: int) -> list[tuple[int, int]]:
        out = [(source // 63, 1 << source % 63)]
        if cluster >= 0:
            out.append((self.wide + cluster // 63, 1 << cluster % 63))
        return out

    def fit(self, size: int, bits: list[tuple[int, int]]) -> int:
        """Place in `keys` of the tightest compatible bin, or -1; successors are searched in growing strides."""
        at, stride = bisect_left(self.keys, (size, -1)), 8
        while at < len(self.keys):
            near = np.fromiter((b for _, b in self.keys[at : at + stride]), np.int64)
            clash = np.zeros(len(near), bool)
            for word, bit in bits:
                clash |= (self.maps[near, word] & bit) != 0
            free = int(clash.argmin())
            if not clash[free]:
                return at + free
            at, stride = at + stride, stride * 4
        return -1

    def put(self, size: int, bits: list[tuple[int, int]], capacity: int) -> int:
        """Place a piece and return the number of its bin."""
        at = self.fit(size, bits)
        if at < 0:
            left, number = capacity, self.n
            self.n += 1
            if number == len(self.maps):
                self.maps = np.concatenate([self.maps, np.zeros_like(self.maps)])
        else:
            left, number = self.keys.pop(at)
        for word, bit in bits:
            self.maps[number, word] |= bit
        key = (left - size, number)
        self.keys.insert(bisect_left(self.keys, key), key)
        return number


def pack_group(sizes: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Bin numbers of pieces that come largest first, and the number of bins."""
    bins = Bins(int(sources.max(initial=0)) + 1, int(clusters.max(initial=-1)) + 1)
    out = [bins.put(s, bins.bits(a, b), capacity) for s, a, b in zip(sizes.tolist(), sources.tolist(), clusters.tolist(), strict=True)]
    return np.array(out, np.int64), bins.n


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cluster: Column | None = None, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin_id, bin_words.

    cluster: the duplicate cluster of each row; texts that are equal without white space by default.
    """
    cluster = F.xxhash64(squeeze(F.col(text))) if cluster is None else F.xxhash64(cluster.cast("string"))
    d = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.coalesce(F.col(source).cast("string"), F.lit("\0none"))).alias("source"),
        cluster.alias("cluster"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("mark"),
    )
    d = storage.table(d, "sizes")
    n = max(1, -(-d.count() // group_rows))

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        whole = (rows["size"] // capacity).to_numpy()
        rest = (rows["size"] % capacity).to_numpy()
        has = (rest > 0) | (whole == 0)
        tail = rows[has].assign(piece=whole[has], part=rest[has])
        tail = tail.sort_values(["part", "doc_id", "mark"], ascending=[False, True, True], kind="stable", na_position="last")
        sources = pd.factorize(tail["source"])[0]
        # A cluster with one row in the group can conflict with nothing.
        several = tail["cluster"].duplicated(keep=False) & tail["cluster"].notna()
        clusters = np.full(len(tail), -1, np.int64)
        clusters[several.to_numpy()] = pd.factorize(tail["cluster"][several])[0]
        number, used = pack_group(tail["part"].to_numpy(), sources, clusters, capacity)
        filled = np.bincount(number, weights=tail["part"], minlength=max(used, 1)).astype(np.int64)
        last = pd.DataFrame({"doc_id": tail["doc_id"], "piece": tail["piece"], "n_words": tail["part"], "bin": number, "bin_words": filled[number] if len(number) else filled[:0]})
        full = rows[whole > 0].sort_values(["doc_id", "mark"], kind="stable", na_position="last")
        times = (full["size"] // capacity).to_numpy()
        piece = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        first = pd.DataFrame({"doc_id": full["doc_id"].repeat(times).to_numpy(), "piece": piece, "n_words": capacity, "bin": used + np.arange(len(piece)), "bin_words": capacity})
        out = pd.concat([last, first], ignore_index=True)
        out["first_word"] = out["piece"] * capacity
        out["bin_id"] = (int(key[0]) << 32) + out["bin"]
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out[["doc_id", "piece", "first_word", "n_words", "bin_id", "bin_words"]]

    return d.groupBy(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(n)).alias("group")).applyInPandas(run, _SCHEMA)
