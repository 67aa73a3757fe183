"""Exact duplicates: counting quotient filters, merged by block, then byte verification.

Each task builds counting quotient filters over the fingerprints of its own rows, cut
into blocks by the top bits of the fingerprint. Filters of one block merge without
loss by their sorted remainders. Only texts whose fingerprint counts above one are
compared byte by byte. Equal texts are those that are identical without white space.

Defined cases: a null text counts as empty and empty texts are equal; a null doc_id
sorts after all others; of rows that tie in everything one stays; an empty table gives
an empty result; other columns are not read (`duplicate_classes`) or pass through
unchanged (`drop_duplicates`), whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage
from .words import set_aside, squeeze

#: Fingerprints in one filter while it is built, which bounds a task's memory.
FILTER_ROWS = 1 << 20
#: Distinct fingerprints in a merged block, about.
BLOCK_ROWS = 1 << 17


def block_bits(n_rows: int) -> int:
    """Bits of the fingerprint that name its block."""
    return min(24, max(6, math.ceil(math.log2(max(1, n_rows) / BLOCK_ROWS))))


def pack_filter(prints: np.ndarray, counts: np.ndarray, prefix: int) -> bytes:
    """A counting quotient filter of sorted, distinct fingerprints that share their top `prefix` bits."""
    n = len(prints)
    q = max(1, math.ceil(math.log2(n + 1)))
    r = 64 - prefix - q
    quotient = (prints << np.uint64(prefix)) >> np.uint64(64 - q)
    remainder = prints & np.uint64((1 << r) - 1)
    occupied = np.bincount(quotient.astype(np.int64), minlength=1 << q) > 0
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    several = counts > 1
    width = (r + 7) // 8
    low = remainder.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    head = np.array([n, q, width, int(several.sum())], dtype="<u4")
    return b"".join(x.tobytes() for x in (head, np.packbits(occupied), np.packbits(run_end), np.packbits(several), low, counts[several].astype("<u8")))


def unpack_filter(data: bytes, block: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter and their counts."""
    n, q, width, n_several = (int(x) for x in np.frombuffer(data, "<u4", 4))
    at = 16

    def bits(size: int) -> np.ndarray:
        nonlocal at
        out = np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool)
        at += (size + 7) // 8
        return out

    occupied, run_end, several = bits(1 << q), bits(n), bits(n)
    full = np.zeros((n, 8), np.uint8)
    full[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    run = np.concatenate([[0], np.cumsum(run_end[:-1])]).astype(np.int64)
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    prints = (np.uint64(block) << np.uint64(64 - prefix)) | (quotient << np.uint64(64 - prefix - q)) | full.view("<u8").reshape(n)
    counts = np.ones(n, np.int64)
    counts[several] = np.frombuffer(data, "<u8", n_several, at).astype(np.int64)
    return prints, counts


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted fingerprints of several filters, adding the counts of equal ones."""
    prints = np.concatenate([p for p, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


def filters(prints: DataFrame, prefix: int) -> DataFrame:
    """Counting quotient filters (block, filter) of a column fp of 64-bit fingerprints."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[np.ndarray]) -> pa.RecordBatch:
            unique, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
            block = (unique >> np.uint64(64 - prefix)).astype(np.int64)
            cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            ends = np.append(cuts[1:], len(unique))
            return pa.RecordBatch.from_arrays(
                [pa.array(block[cuts], pa.int64()), pa.array([pack_filter(unique[a:b], counts[a:b], prefix) for a, b in zip(cuts, ends, strict=True)], pa.binary())],
                names=["block", "filter"],
            )

        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            n += len(held[-1])
            if n >= FILTER_ROWS:
                yield emit(held)
                held, n = [], 0
        if n:
            yield emit(held)

    return prints.select("fp").mapInArrow(build, "block long, filter binary")


def repeated_prints(prints: DataFrame, n_rows: int) -> DataFrame:
    """Fingerprints that occur more than once (fp, n), from filters merged block by block."""
    prefix = block_bits(n_rows)

    def merge(key, group):
        parts: list = []
        for data in group["filter"]:
            parts.append(unpack_filter(data, int(key[0]), prefix))
            if sum(len(p) for p, _ in parts) > 4 * FILTER_ROWS:
                parts = [merge_counts(parts)]
        unique, counts = merge_counts(parts)
        again = counts > 1
        return group.iloc[:0].assign(fp=None, n=None)[["fp", "n"]] if not again.any() else _frame(unique[again], counts[again])

    return filters(prints, prefix).groupBy("block").applyInPandas(merge, "fp long, n long")


def _frame(prints: np.ndarray, counts: np.ndarray):
    import pandas as pd

    return pd.DataFrame({"fp": prints.view(np.int64), "n": counts})


def _digest(docs: DataFrame, doc_id: str, text: str, *more) -> DataFrame:
    """One row per document: doc_id, its normalised text's fingerprint and SHA-256, and the text's code points."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("raw"))
    d = d.withColumn("norm", squeeze(F.col("raw")))
    return d.select("doc_id", F.xxhash64("norm").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"), F.char_length("raw").alias("n_chars"), *more)


def _classes(base: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Of each text that occurs more than once: fp, sha, the row that stays and the group's size."""
    repeated = storage.table(repeated_prints(base, base.count()), "repeated")
    candidates = _digest(docs, doc_id, text, "norm").join(repeated.select("fp"), "fp", "left_semi")
    # Bytes decide: rows that agree in fingerprint and digest must hold one and the same text.
    verified = candidates.groupBy("fp", "sha").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    verified = verified.select("fp", "sha", F.when(F.col("low") == F.col("high"), F.lit(True)).otherwise(F.raise_error(F.lit("texts differ in bytes but not in SHA-256")).cast("boolean")).alias("same"))
    groups = base.join(repeated.select("fp"), "fp", "left_semi").groupBy("fp", "sha").agg(F.count("*").alias("group_size"), F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("best"))
    return groups.join(verified.where("same"), ["fp", "sha"]).where("group_size > 1").select("fp", "sha", "group_size", "best")


def duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points before normalising stays, then
    the one with the smallest doc_id.
    """
    base = storage.table(_digest(docs, doc_id, text).withColumn("rid", F.monotonically_increasing_id()), "prints")
    classes = storage.table(_classes(base, docs, doc_id, text), "classes")
    out = base.join(classes.drop("fp"), "sha", "left")
    return out.select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("best").isNull() | (F.col("best.rid") == F.col("rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    base = storage.table(_digest(docs, doc_id, text).withColumn("rid", F.monotonically_increasing_id()), "prints")
    classes = storage.table(_classes(base, docs, doc_id, text), "classes")
    rows = base.join(classes.drop("fp"), "sha")
    best = F.col("best")
    tied = (best["less"] == -F.col("n_chars")) & best["doc_id"].eqNullSafe(F.col("doc_id"))
    gone = rows.where(~tied).select(F.col("doc_id").alias("gone_id"), F.col("sha").alias("gone_sha"), F.col("n_chars").alias("gone_chars")).distinct()
    d, (i, t) = set_aside(docs, doc_id, text)
    sha, raw = F.sha2(squeeze(F.col(t)), 256), F.coalesce(F.col(t), F.lit(""))
    same = F.col(i).eqNullSafe(F.col("gone_id")) & (F.unhex(sha) == F.col("gone_sha")) & (F.char_length(raw) == F.col("gone_chars"))
    kept = d.join(gone, same, "left_anti")
    if rows.where(tied & (best["rid"] != F.col("rid"))).limit(1).count():
        # Rows with one doc_id and one text repeat; only then does a second pass remove all but one.
        of = {"id_": F.col(i), "sha_": sha, "len_": F.char_length(raw)}
        kept = kept.withColumns(of).dropDuplicates(list(of)).select(*d.columns)
    return kept.toDF(*docs.columns)
