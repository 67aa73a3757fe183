"""Repeated passages, by merging Burrows-Wheeler transforms of shards.

A window is a string of `span` bytes. It takes the smallest hash of its grams of `gram`
bytes, so that equal windows fall into one bucket; neighbouring windows with one
smallest hash form a segment. Segments that are equal are one class from the start, and
a bucket with one occurrence, whose windows all differ, holds no repeat. The classes of the other buckets are dealt
into groups of bounded size. Each group sorts the suffixes of two shards of its
segments and merges the two transforms by refining their interleave: a pass extends the
known order by one symbol, and marks where neighbours come to differ. Suffixes that
differ from all others are settled and take no part in later passes; the pass in which
that happens is the longest prefix that they have in common with another suffix. Where
that prefix is `span` bytes long a window repeats. A symbol is 16 bytes, taken at every
offset, so that 25 passes see 400 bytes.

A bucket of more than `BUCKET_ROWS` classes is cut again by windows with longer grams,
and at last by the windows themselves, so no bucket meets in one task.

Defined cases: a null text is empty; texts shorter than a window repeat nothing; rows
that repeat are repeats of one another, with or without doc_id; matches never cross
texts; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import storage
from .words import arrow_bytes, mix64

SPAN, SYMBOL = 400, 16
#: Lengths of grams: of the first buckets, and of those into which hot ones are cut.
GRAMS = (200, 390, 400)
#: Classes in a bucket that one group takes, and bytes of segments in a group, about.
BUCKET_ROWS, GROUP_BYTES = 256, 1 << 18
#: Groups of one task, about.
TASK_GROUPS = 4
#: Windows of one segment and bytes of text looked at together, at most.
SEGMENT_WINDOWS, PIECE = 512, 1 << 20

_BASE = np.uint64(0xC6A4A7935BD1E995)
_INVERSE = np.uint64(pow(0xC6A4A7935BD1E995, -1, 1 << 64))
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(11 << 40))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, PIECE + SPAN + 1), _powers(_INVERSE, PIECE + SPAN + 1)


def segments(data: np.ndarray, gram: int, span: int = SPAN) -> tuple[np.ndarray, ...]:
    """Segments of one text: bucket hash, content hash, first window, number of windows, whether two of its windows are equal."""
    parts = []
    for low in range(0, max(1, len(data) - span + 1), PIECE):
        part = data[low : low + PIECE + span - 1]
        if len(part) >= span:
            parts.append(_segments(part, gram, span, low))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, np.int64),) * 5


def _segments(data: np.ndarray, gram: int, span: int, low: int) -> tuple[np.ndarray, ...]:
    n = len(data)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * _UP[:n], dtype=np.uint64)])
    least = mix64((sums[gram:] - sums[:-gram]) * _DOWN[: n - gram + 1])
    width, have = span - gram + 1, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    cut = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    sizes = np.diff(np.append(cut, len(least)))
    if sizes.max() > SEGMENT_WINDOWS:
        # A long run of one hash, as of a repeated character, is cut into segments of its own.
        times = -(-sizes // SEGMENT_WINDOWS)
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        cut = np.repeat(cut, times) + nth * SEGMENT_WINDOWS
        sizes = np.diff(np.append(cut, len(least)))
    end = cut + sizes - 1 + span
    content = mix64((sums[end] - sums[cut]) * _DOWN[cut] ^ (sizes.astype(np.uint64) * _BASE))
    inner = _inner_repeats((sums[span:] - sums[:-span]) * _DOWN[: n - span + 1], sizes)
    return least[cut].view(np.int64), content.view(np.int64), cut + low, sizes.astype(np.int64), inner


def _inner_repeats(windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether a segment has two equal windows. windows: hashes of the windows of segments of these sizes."""
    found = np.zeros(len(sizes), bool)
    ordered = np.sort(windows)
    if (ordered[1:] == ordered[:-1]).any():
        owner = np.repeat(np.arange(len(sizes)), sizes)
        # Stable: the windows of one segment stay neighbours among equal ones.
        order = np.argsort(windows, kind="stable")
        same = (windows[order[1:]] == windows[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        found[owner[order[1:][same]]] = True
    return found


def _order(keys: np.ndarray, bound: int) -> np.ndarray:
    """The stable order of keys below bound. Where both fit into 63 bits, keys are sorted together with their places, which is faster."""
    bits = len(keys).bit_length()
    if bound.bit_length() + bits > 63:
        return np.argsort(keys, kind="stable")
    packed = keys.astype(np.int64) << bits
    packed |= np.arange(len(keys))
    packed.sort()
    packed &= (1 << bits) - 1
    return packed


def _numbered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of keys below bound, and for each key how many smaller ones there are, equal ones counted once."""
    order = _order(keys, bound)
    ordered = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))[: len(keys)]
    return order, out


class Shard:
    """The transform of a shard of strings: suffixes in order, with the symbol before each.

    A symbol is a rank among the 16-byte strings of the group; a suffix too short for one
    more symbol ends there and equals no other.
    """

    def __init__(self, ranks: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int):
        """ranks: of the 16 bytes from each place (-1: fewer are left in the string)."""
        n = len(ranks)
        self.n = n
        # Suffixes without a symbol come first, each on its own.
        key = np.where(ranks < 0, n - 1 - np.arange(n), ranks + n)
        self.suffixes, order = _numbered(key, n + int(ranks.max(initial=0)) + 1)
        left = np.repeat(ends, ends - starts) - np.arange(n)
        known = 1
        while known < depth:
            after = np.zeros(n, np.int64)
            step = known * SYMBOL
            inside = np.flatnonzero(left > step)
            after[inside] = order[inside + step] + 1
            self.suffixes, order = _numbered(order * (n + 1) + after, n * (n + 1))
            known *= 2
        self.place = np.empty(n, np.int64)
        self.place[self.suffixes] = np.arange(n)
        # By place: the symbol before the suffix, and the place of the suffix that begins with it.
        reach = np.flatnonzero(np.arange(n) - np.repeat(starts, ends - starts) >= SYMBOL)
        before, earlier = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        before[reach], earlier[reach] = ranks[reach - SYMBOL], self.place[reach - SYMBOL]
        self.symbols, self.earlier = before[self.suffixes], earlier[self.suffixes]


def merge(left: Shard, right: Shard, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Refine the interleave of two transforms for `depth` symbols.

    Returns the common prefix of each suffix, those of the left shard first: the most symbols,
    up to `depth`, that it begins with in common with any other. Then, in merged order, the
    suffixes of which it is `depth`, and the interval (block) that each lies in.
    """
    symbols = np.concatenate([left.symbols, right.symbols])
    earlier = np.concatenate([left.earlier, right.earlier + left.n])
    suffixes = np.concatenate([left.suffixes, right.suffixes + left.n])
    bound = int(symbols.max(initial=0)) + 1
    # Rows are known by their place, those of the right shard after all of the left; before the first pass all prefixes are empty, hence equal.
    place = np.arange(len(symbols))
    block = np.zeros(len(symbols), np.int64)
    common = np.zeros(len(symbols), np.int16)
    for known in range(1, depth + 1):
        symbol = symbols[place]
        keep = np.flatnonzero(symbol >= 0)
        symbol = symbol[keep]
        order = _order(symbol, bound)
        symbol, rows = symbol[order], keep[order]
        under = block[rows]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (under[1:] != under[:-1])
        # Rows that are left begin with `known` symbols that another row begins with too.
        again = np.flatnonzero(~(new[:-1] & new[1:]))
        block = np.cumsum(new[again])
        # The suffixes that begin one symbol earlier.
        place = earlier[place[rows[again]]]
        common[place] = known
        if not len(place):
            break
    out = np.empty(len(symbols), np.int16)
    out[suffixes] = common
    return out, suffixes[place], block


def _ranks(data: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranks of the 16 bytes from each place; -1 where they reach the last place of the string, its end mark."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(SYMBOL, np.uint8)])
    word = np.zeros(n + 8, np.uint64)
    for k in range(8):
        word <<= np.uint64(8)
        word |= padded[k : k + n + 8]
    half = np.unique(word, return_inverse=True)[1].astype(np.int64)
    _, ranks = _numbered(half[:n] * (n + 9) + half[8:], (n + 9) ** 2)
    return np.where(np.repeat(ends - 1, sizes) - np.arange(n) >= SYMBOL, ranks, -1)


def common_prefixes(strings: list[bytes], weights: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For each place of each string, how many symbols of 16 bytes, up to `span` bytes, begin another place too.

    weights: how often each string occurs; one that occurs again has all that is left of it in common.
    """
    if not strings:
        return []
    # Each string has an end mark, whose place stands for the empty suffix.
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    ranks = _ranks(data, ends, sizes)
    depth = span // SYMBOL
    half = int(np.searchsorted(ends, ends[-1] / 2, "right")) or 1
    cut = int(ends[half - 1])
    left = Shard(ranks[:cut], (ends - sizes)[:half], ends[:half], depth)
    right = Shard(ranks[cut:], (ends - sizes)[half:] - cut, ends[half:] - cut, depth)
    common, _, _ = merge(left, right, depth)
    rest = np.minimum((np.repeat(ends - 1, sizes) - np.arange(len(data))) // SYMBOL, depth)
    common = np.where(np.repeat(weights > 1, sizes), rest, common)
    return [common[e - n : e - 1] for e, n in zip(ends, sizes, strict=True)]


def repeated_windows(strings: list[bytes], weights: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For each string, whether the window at each of its places has another occurrence.

    weights: how often each string occurs.
    """
    return [(c == span // SYMBOL)[: max(len(s) - span + 1, 0)] for c, s in zip(common_prefixes(strings, weights, span), strings, strict=True)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Half-open runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


_FOUND = "h long, s long, m long, starts array<struct<a: long, b: long>>"


def _occurrences(texts: DataFrame, gram: int) -> DataFrame:
    """Segments of texts: k1, k2 (of the text), weight, p, h, s, m, inner. texts: k1, k2, weight, data."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = arrow_bytes(b.column(3))
            rows, held, n = [], [], 0
            for i in range(len(b)):
                h, s, p, m, inner = segments(data[at[i] : at[i + 1]], gram)
                if len(h):
                    rows.append((np.full(len(h), i), p, h, s, m, inner))
                    n += len(h)
                if n >= 50_000 or i == len(b) - 1 and rows:
                    own, p, h, s, m, inner = (np.concatenate(x) for x in zip(*rows, strict=True))
                    own = pa.array(own)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(1).take(own), b.column(2).take(own), pa.array(p.astype(np.int64)), pa.array(h), pa.array(s), pa.array(m), pa.array(inner)], names=["k1", "k2", "weight", "p", "h", "s", "m", "inner"])
                    rows, n = [], 0

    return texts.select("k1", "k2", "weight", "data").mapInArrow(scan, "k1 long, k2 long, weight long, p long, h long, s long, m long, inner boolean")


def _cut(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of segments: wanted has k1, k2, h, s, m, p, weight. A text gives each of its segments once."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "s", "m", "p", "weight")).alias("list"))
    # Equal texts collapse before they are shuffled, so copies cost nothing.
    both = texts.select("k1", "k2", "data").dropDuplicates(["k1", "k2"]).join(lists, ["k1", "k2"]).select("data", "list")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "s", "m", "weight", "data"]
        types = [pa.int64()] * 4 + [pa.binary()]
        for b in batches:
            out, n = [], 0
            for text, found in zip(b.column(0), b.column(1), strict=True):
                whole = memoryview(text.as_buffer())
                for x in found.as_py():
                    part = bytes(whole[x["p"] : x["p"] + x["m"] - 1 + SPAN])
                    out.append((x["h"], x["s"], x["m"], x["weight"], part))
                    n += len(part)
                    if n >= 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                        out, n = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return both.mapInArrow(scan, "h long, s long, m long, weight long, data binary")


def _merged(rows: DataFrame, n_groups: int) -> DataFrame:
    """Repeated windows of the classes in small buckets, by groups."""

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        # Texts that share a key may give one class twice.
        group = group.drop_duplicates(["h", "s", "m"]).sort_values(["h", "s", "m"], kind="stable")
        flags = repeated_windows(list(group["data"]), group["weight"].to_numpy())
        out = group[["h", "s", "m"]].assign(starts=[[{"a": a, "b": b} for a, b in runs(f)] for f in flags])
        return out[[len(x) > 0 for x in out["starts"]]]

    # The work of a group is in its suffixes, not in its bytes, by which small partitions would be put together.
    n_tasks = min(-(-n_groups // TASK_GROUPS), 16 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("h"), F.lit(n_groups))).repartition(n_tasks, "group")
    return dealt.groupBy("group").applyInPandas(run, _FOUND)


def _found(texts: DataFrame, level: int = 0) -> tuple[DataFrame, DataFrame]:
    """Occurrences of segments in texts, and the repeated windows of each class: h, s, m, starts."""
    seen = storage.table(_occurrences(texts, GRAMS[level]), "segments")
    best = F.min(F.struct("k1", "k2", "p")).alias("best")
    classes = seen.groupBy("h", "s", "m").agg(F.sum("weight").alias("weight"), F.max("inner").alias("inner"), best)
    classes = storage.table(classes.select("h", "s", "m", "weight", "inner", "best.*"), "classes")
    buckets = classes.groupBy("h").agg(F.sum("weight").alias("total"), F.count("*").alias("kinds"), F.sum(F.col("m") + SPAN).alias("bytes"), F.max("inner").alias("some_inner"))
    buckets = buckets.where("total > 1 or some_inner").drop("some_inner")
    classes = storage.table(classes.drop("inner").join(buckets, "h"), "met")
    # Where a bucket has one class that occurs again, all of its windows repeat; nothing is left to compare.
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("m").alias("b")))
    if level == len(GRAMS) - 1:
        # A bucket is one window here, met more than once; its classes are runs of that window, of whatever lengths.
        return seen, classes.select("h", "s", "m", whole.alias("starts"))
    single = classes.where("kinds = 1 and total > 1").select("h", "s", "m", whole.alias("starts"))
    several = classes.where("kinds > 1 or total = 1")
    bytes_ = several.where(F.col("kinds") <= BUCKET_ROWS).agg(F.coalesce(F.sum(F.col("m") + SPAN), F.lit(0)).alias("n")).first()["n"]
    cut = storage.table(_cut(texts, several).join(several.select("h", "kinds").distinct(), "h"), "cut")
    found = single.unionByName(_merged(cut.where(F.col("kinds") <= BUCKET_ROWS).drop("kinds"), max(1, -(-int(bytes_) // GROUP_BYTES))))
    hot = cut.where(F.col("kinds") > BUCKET_ROWS)
    if hot.limit(1).count():
        # The segments of hot buckets are texts of their own, each with its weight.
        names = hot.dropDuplicates(["h", "s", "m"]).select(F.col("h").alias("k1"), F.col("s").alias("k2"), "m", "weight", "data")
        names = storage.table(names, "hot")
        inner, again = _found(names, level + 1)
        placed = inner.join(again, ["h", "s", "m"]).groupBy("k1", "k2").agg(F.collect_list(_moved(0)).alias("starts"))
        placed = placed.select("k1", "k2", _joined(F.sort_array(F.flatten("starts"))).alias("starts"))
        found = found.unionByName(names.select("k1", "k2", "m").join(placed, ["k1", "k2"]).select(F.col("k1").alias("h"), F.col("k2").alias("s"), "m", "starts"))
    return seen, storage.table(found, "found")


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Half-open byte spans that repeated windows cover, by text: k1, k2 (hashes of the text), spans.

    The spans of a text are in order and may touch or overlap.
    """
    seen, found = _found(_texts(docs, text))
    rows = seen.join(found, ["h", "s", "m"]).groupBy("k1", "k2").agg(F.collect_set(_moved(SPAN - 1)).alias("spans"))
    return rows.select("k1", "k2", F.sort_array(F.flatten("spans")).alias("spans"))


def _moved(reach: int) -> Column:
    """Runs of windows of a segment, moved to its place p; `reach` is added to their ends."""
    return F.transform("starts", lambda r: F.struct((F.col("p") + r["a"]).alias("a"), (F.col("p") + r["b"] + reach).alias("b")))


def _joined(runs_: Column) -> Column:
    """Runs in order, with those that touch made one."""
    none = F.array().cast("array<struct<a: bigint, b: bigint>>")

    def add(done: Column, x: Column) -> Column:
        last, n = F.try_element_at(done, F.lit(-1)), F.size(done)
        longer = F.concat(F.slice(done, F.lit(1), n - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))
        return F.when((n > 0) & (last["b"] >= x["a"]), longer).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(runs_, none, add)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    """Rows of docs as bytes, under two hashes of their content."""
    data = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(data).alias("k1"), F.xxhash64(F.lit(1), data).alias("k2"), F.lit(1).cast("long").alias("weight"), data.cast("binary").alias("data"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans removed (start, end), kept (bytes)."""
    spans = storage.table(repeated_spans(docs, text), "spans")
    data = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(data).alias("k1"), F.xxhash64(F.lit(1), data).alias("k2"), data.cast("binary").alias("data"))
    rows = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "data", "spans")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            removed, kept, sizes = [], [], []
            for value, found in zip(b.column(1), b.column(2), strict=True):
                whole, out, gone, last = memoryview(value.as_buffer()), [], [], 0
                for x in found.as_py() or []:
                    if gone and x["a"] <= gone[-1]["end"]:
                        gone[-1]["end"] = max(gone[-1]["end"], x["b"])
                    else:
                        gone.append({"start": x["a"], "end": x["b"]})
                for x in gone:
                    out.append(whole[last : x["start"]])
                    last = x["end"]
                removed.append(gone)
                kept.append(b"".join([*out, whole[last:]]))
                sizes.append(len(whole))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "removed", "kept"])

    return rows.mapInArrow(scan, "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")

