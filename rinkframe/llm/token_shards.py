"""Token ids in binary shards with a minimal perfect hash index.

A shard is a file of raw ids, little-endian, and an index file. The index maps each
document key to a slot by a cascade of bit arrays; the slot holds the key's
fingerprint and the place of its documents, so that a lookup takes constant time and
tells absent keys from present ones up to the fingerprint's 32 bits.

Defined cases: a null text is empty and yields the end id only; documents without a
key come first, in the payload but not in the index; documents that share a key lie
side by side, ordered by text, and the slot counts them; an empty table gives no
shard; keys that no shard holds give no row (up to the fingerprint's 32 bits); other
columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import files, storage
from .words import arrow_bytes, mix64, slices

MAGIC = b"RFTOKMPH"
#: Bits per remaining key at each level of the hash.
ROOM = 2.0
#: Encoded parts that a worker keeps, before it begins anew, and bytes of texts encoded together.
CACHED_WORDS, ENCODED_BYTES = 800_000, 1 << 23
#: Documents that are looked up and read at once.
READ_DOCS = 4096
#: Bytes of text and documents of a shard, about, beyond the session's own number of shards.
SHARD_BYTES, SHARD_DOCS = 1 << 28, 1 << 20


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit keys: one bit array a level."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [np.unpackbits(x, bitorder="little") for x in levels]
        self.bits = [x.astype(bool) for x in ones]
        self.rank, before = [], 0
        for x in ones:
            total = np.cumsum(x, dtype=np.int64)
            self.rank.append(total - x + before)
            before += int(total[-1])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys ^ np.uint64((level + 1) * 0xA24BAED4963EE407 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(64, int(ROOM * len(keys)) // 8 * 8 + 8)
            at = cls.place(keys, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; -1 for those that cannot be in the set."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            at = self.place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.rank[level][at[hit]]
            left = left[~hit]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


class Index:
    """Keyed access to one shard's documents."""

    def __init__(self, keys: np.ndarray, n_null: int, ends: np.ndarray, levels: list[np.ndarray] | None = None, slots: np.ndarray | None = None):
        """keys: of all documents in order, without the first n_null. ends: token offsets, 0 first."""
        self.keys, self.n_null, self.ends = keys, n_null, ends
        if levels is None:
            distinct, first, n = np.unique(keys.view(np.uint64), return_index=True, return_counts=True)
            self.hash = PerfectHash.build(distinct)
            slots = np.zeros(len(distinct), dtype=[("print", "<u4"), ("first", "<u4"), ("n", "<u4")])
            at = self.hash.slots(distinct)
            slots["print"][at], slots["first"][at], slots["n"][at] = fingerprints(distinct), first + n_null, n
        else:
            self.hash = PerfectHash(levels)
        self.slots = slots

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; number 0 where the key is absent."""
        keys = keys.astype(np.int64).view(np.uint64)
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = self.hash.slots(keys)
        slot = self.slots[np.maximum(at, 0)]
        there = (at >= 0) & (slot["print"] == fingerprints(keys))
        return slot["first"].astype(np.int64), np.where(there, slot["n"], 0).astype(np.int64)

    def to_bytes(self) -> bytes:
        sizes = [len(x) for x in self.hash.levels]
        head = np.array([self.n_null, len(self.keys), len(self.slots), len(sizes), *sizes], dtype="<u8")
        return b"".join([MAGIC, head.tobytes(), *(x.tobytes() for x in self.hash.levels), self.slots.tobytes(), self.ends.astype("<u8").tobytes(), self.keys.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        if data[:8] != MAGIC:
            raise ValueError("not an index of token shards")
        n_null, n_keys, n_slots, n_levels = (int(x) for x in np.frombuffer(data, "<u8", 4, 8))
        sizes = np.frombuffer(data, "<u8", n_levels, 40).astype(np.int64)
        at, levels = 40 + 8 * n_levels, []
        for size in sizes:
            levels.append(np.frombuffer(data, np.uint8, int(size), at))
            at += int(size)
        slots = np.frombuffer(data, [("print", "<u4"), ("first", "<u4"), ("n", "<u4")], n_slots, at)
        at += 12 * n_slots
        ends = np.frombuffer(data, "<u8", n_null + n_keys + 1, at).astype(np.int64)
        return cls(np.frombuffer(data, "<i8", n_keys, at + 8 * len(ends)), n_null, ends, levels, slots)


class _Pool:
    """Ids of encoded parts, one after another, and the number of each part."""

    def __init__(self, dtype: np.dtype):
        self.numbers: dict[bytes, int] = {}
        self.ids, self.ends = np.empty(1 << 20, dtype), np.zeros(1 << 18, np.int64)

    def add(self, parts: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, low = len(self.numbers), int(self.ends[len(self.numbers)])
        while low + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n + len(parts) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[low : low + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(parts)] = low + np.cumsum(sizes)
        self.numbers.update(zip(parts, range(n, n + len(parts)), strict=True))


#: Encoded parts by tokenizer file, kept for later tasks of the same Python worker; begun anew when full.
_pools: dict[tuple[str, str], _Pool] = {}

# Bytes of white space (with the four separators \x1c to \x1f, to be safe), and white space of two and of three bytes in UTF-8.
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WHITE_2 = np.array([0xC285, 0xC2A0])
_WHITE_3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def lone_spaces(data: np.ndarray) -> np.ndarray:
    """Places of ASCII white space between two characters that are not white space."""
    white = _WHITE[data]
    # The four separators keep cuts away, but are no white space to every pattern.
    at = np.flatnonzero(white & ((data < 28) | (data == 32)))
    at = at[(at > 0) & (at < len(data) - 1)]
    at = at[~white[at - 1] & ~white[at + 1]]
    padded = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(3, np.uint8)]).astype(np.int64)
    p = at + 3
    before, after = padded[p - 2] << 8 | padded[p - 1], padded[p + 1] << 8 | padded[p + 2]
    white = np.isin(before, _WHITE_2) | np.isin(after, _WHITE_2)
    return at[~(white | np.isin(padded[p - 3] << 16 | before, _WHITE_3) | np.isin(after << 8 | padded[p + 3], _WHITE_3))]


def cuts_at_spaces(tokenizer_file: str) -> bool:
    """Whether a tokenizers file may be given texts cut before lone white space.

    True for byte-level pre-tokenizers with their own pattern and no prefix space: a lone
    white space begins a piece there, and no pattern looks back. Normalizers and added
    tokens with white space, or that take it in, could see the cut.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])) for t in spec.get("added_tokens") or [])
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and not spec.get("normalizer") and plain


class Encoder:
    """Ids of texts by a tokenizers file; equal parts of texts are encoded once.

    Where the file allows it, texts are cut before lone white space, the parts of a batch are
    dictionary-encoded, and only parts that are new to the worker go to the library.
    """

    def __init__(self, tokenizer_file: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.cuts = cuts_at_spaces(tokenizer_file)
        self.key, self.dtype = (tokenizer_file, dtype), np.dtype(dtype)
        if self.cuts:
            # A character of a byte-level token stands for one byte; added tokens are plain text.
            added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
            lengths = {i: len(t) for t, i in self.tokenizer.get_vocab().items()} | added
            self.bytes_of = np.array([lengths.get(i, 0) for i in range(max(lengths) + 1)], np.int64)

    def _coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after another, and their numbers."""
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(coded), self.dtype), np.fromiter(map(len, coded), np.int64, len(coded))

    def _pool(self, parts: list[bytes], inner: np.ndarray, end_id: int) -> tuple[_Pool, np.ndarray]:
        """The pool and in it the numbers of parts, all of which it holds then; last the number of the end id.

        inner: which parts lie between cuts. They may follow one another in one text, and the
        lengths of the tokens tell whose they are.
        """
        pool = _pools.get(self.key)
        if pool is None or len(pool.numbers) > CACHED_WORDS:
            pool = _pools[self.key] = _Pool(self.dtype)
        new = [(p, i) for p, i in zip(parts, inner.tolist(), strict=True) if p not in pool.numbers]
        between, others = [p for p, i in new if i], [p for p, i in new if not i]
        joined = [b"".join(between[at : at + 1000]).decode() for at in range(0, len(between), 1000)]
        if between:
            ids, _ = self._coded(joined)
            last = np.cumsum(np.fromiter(map(len, between), np.int64, len(between)))
            pool.add(between, ids, np.diff(np.searchsorted(np.cumsum(self.bytes_of[ids]), last, "right"), prepend=0))
        pool.add(others, *self._coded([p.decode() for p in others]))
        # No part is one of this form.
        end = b"\xff%d" % end_id
        if end not in pool.numbers:
            pool.add([end], np.array([end_id], self.dtype), np.ones(1, np.int64))
        return pool, np.fromiter(map(pool.numbers.__getitem__, [*parts, end]), np.int64, len(parts) + 1)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that lie one after another, an end id behind each, and the numbers of ids by text."""
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        if self.cuts:
            edge[lone_spaces(data)] = True
        bounds = np.flatnonzero(edge)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        which, next_ = coded.indices.to_numpy(), np.searchsorted(bounds, offsets)
        inner = np.full(len(coded.dictionary), self.cuts)
        at_edge = np.concatenate([next_, next_ - 1])
        inner[which[at_edge[(at_edge >= 0) & (at_edge < len(which))]]] = False
        pool, numbers = self._pool(coded.dictionary.to_pylist(), inner, end_id)
        # An end after the last part of each text.
        codes = numbers[np.insert(which, next_[1:], len(numbers) - 1)]
        begin = pool.ends[codes]
        many = pool.ends[codes + 1] - begin
        total = np.concatenate([[0], np.cumsum(many)])
        out = pool.ids[np.arange(total[-1]) + np.repeat(begin - total[:-1], many)]
        ends = total[np.flatnonzero(codes == numbers[-1]) + 1]
        return out, np.diff(np.concatenate([[0], ends]))


def write(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0) -> DataFrame:
    """Write docs as shards in ascending key order; returns the manifest, one row per shard.

    Shards are bounded by bytes of text and by documents, and with them an index, so that their
    number grows with the corpus; only one key's documents are never parted.
    """
    spark = docs.sparkSession
    folder = storage.new_folder(spark, "tokens")
    total = docs.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0)).alias("bytes")).first()
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), total["bytes"] // SHARD_BYTES, total["docs"] // SHARD_DOCS)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, keys, sizes, n_null, out, path = None, [], [], 0, None, ""
        for batch in batches:
            ids = batch.column(0)
            if out is None:
                from tokenizers import Tokenizer

                small = Tokenizer.from_file(tokenizer_file).get_vocab_size() <= 1 << 16
                encoder = Encoder(tokenizer_file, "<u2" if small else "<u4")
                path = files.attempt(folder, f"shard-{TaskContext.get().partitionId():07d}")
                out = files.create(path + ".bin")
            n_null += ids.null_count
            keys.append(ids.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            data, at = arrow_bytes(batch.column(1))
            for low, high in slices(at, ENCODED_BYTES):
                coded, many = encoder.encode(data[at[low] : at[high]], at[low : high + 1] - at[low], end_id)
                sizes.append(many)
                out.write(coded.tobytes())
        if out is not None:
            out.close()
            width, held = encoder.dtype.itemsize, np.concatenate(keys)
            ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
            with files.create(path + ".idx") as index:
                index.write(Index(held, n_null, ends).to_bytes())
            last = int(held[-1]) if len(held) else None
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((TaskContext.get().partitionId(), path, width, len(ends) - 1, int(ends[-1]), last), (pa.int64(), pa.string(), *[pa.int64()] * 4), strict=True)], names=["shard", "path", "width", "n_docs", "n_tokens", "last_key"])

    key = F.col("doc_id").asc_nulls_first()
    # Documents without a key are in no index, so they may spread over shards; those of one key stay together.
    spread = F.when(F.col("doc_id").isNull(), F.substring("text", 1, 64)).asc_nulls_first()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange(n, key, spread).sortWithinPartitions(key, "text")
    return storage.table(rows.mapInArrow(shard, "shard long, path string, width long, n_docs long, n_tokens long, last_key long"), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """Add start, the ids of all shards before; a window over one row per shard."""
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def read_index(path: str) -> Index:
    with files.open_file(path + ".idx") as f:
        return Index.from_bytes(f.read())


def read_ids(path: str, width: int, first: int, last: int) -> np.ndarray:
    """Ids of a shard from token `first` up to `last`."""
    with files.open_file(path + ".bin") as f:
        return np.frombuffer(f.read_at((last - first) * width, first * width), f"<u{width}").astype("<u4")


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the shards by way of the index: doc_id, start, n_tokens, ids_crc32."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index = read_index(row["path"])
                n_null, keys = index.n_null, index.keys
                for at in range(0, n_null + len(keys), READ_DOCS):
                    many = min(READ_DOCS, n_null + len(keys) - at)
                    place = np.arange(at, at + many)
                    keyed = place >= n_null
                    first, n = index.lookup(keys[place[keyed] - n_null])
                    if not n.all():
                        raise ValueError("a key is missing from the index")
                    # Documents with one key follow the first of them in the payload.
                    run = place[keyed] - n_null
                    place[keyed] = first + run - np.searchsorted(keys, keys[run], "left") if len(run) else first
                    a, b = index.ends[place], index.ends[place + 1]
                    low = int(a.min())
                    ids = read_ids(row["path"], row["width"], low, int(b.max()))
                    crc = [zlib.crc32(ids[x - low : y - low].tobytes()) for x, y in zip(a, b, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(keys[p - n_null]) if p >= n_null else None for p in range(at, at + many)], pa.int64()), pa.array(a + row["start"], pa.int64()), pa.array(b - a, pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    rows = with_starts(manifest)
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n).mapInArrow(look, "doc_id long, start long, n_tokens long, ids_crc32 long")


def get(manifest: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents by key, one row for each document of each distinct key that the shards hold: doc_id, ids.

    Keys find their shard by its last key (one number and path a shard, of SHARD_BYTES or more
    of text, sorted, at the driver and in the task), then
    their slot in the shard's hash; only their documents' ids are read from the payload.
    """
    shards = manifest.where("last_key is not null").orderBy("last_key").select("shard", "path", "width", "last_key").toPandas()
    last, paths, widths = shards["last_key"].to_numpy(np.int64), shards["path"].tolist(), shards["width"].tolist()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(last, b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at)], names=["doc_id", "at"]).filter(pa.array(at < len(last)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = None, -1
        for b in batches:
            found, ids = [], []
            for key_, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if at != held:
                    index, held = read_index(paths[at]), at
                first, n = (int(x[0]) for x in index.lookup(np.array([key_])))
                for d in range(first, first + n):
                    found.append(key_)
                    ids.append(read_ids(paths[at], widths[at], int(index.ends[d]), int(index.ends[d + 1])).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    wanted = keys.select(F.col(key).cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    # Keys of one shard come one after another, so that a task reads an index once.
    routed = wanted.mapInArrow(route, "doc_id long, at long").repartitionByRange("at", "doc_id").sortWithinPartitions("at", "doc_id")
    return routed.mapInArrow(look, "doc_id long, ids array<long>")
