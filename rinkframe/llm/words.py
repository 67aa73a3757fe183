"""Words and texts, as Spark expressions and as numpy passes over Arrow batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space that parts words, [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
SPACES_PATTERN = "[ \\t-\\r]+"

#: Lower-cases A-Z only.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES_PATTERN), "")


def word_count(text: Column) -> Column:
    """Number of words as a long; a null text has none."""
    return F.size(words(text)).cast("long")


def squeeze(text: Column) -> Column:
    """The text without any white space; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def set_aside(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str]]:
    """docs with columns c0, c1, …, so that no name clashes in a join, and the new names of the wanted columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    lower = [c.lower() for c in docs.columns]
    at = [docs.columns.index(w) if w in docs.columns else lower.index(w.lower()) for w in wanted]
    return docs.toDF(*names), [names[i] for i in at]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift), so that all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def odd_multipliers(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(7 << 40))
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE.encode())] = True
_FOLD = np.frombuffer(LOWER, dtype=np.uint8)
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[:1] = 1
    out[1:] = _BASE
    return np.cumprod(out, dtype=np.uint64)


#: Bytes hashed at once, which bounds the arrays; a longer word is taken whole.
HASH_BYTES = 1 << 20


def word_hashes(data: np.ndarray, starts_of_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of texts that lie one after another in `data`.

    starts_of_docs: offsets of the texts and, last, the end. Returns the hashes in
    order, and for each text the offset of its first word (last: their number).
    """
    hashes, begins, low = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while low < len(data):
        high = low + HASH_BYTES
        while high < len(data) and not (gap := np.flatnonzero(_IS_SPACE[data[high : high + HASH_BYTES]])).size:
            high += HASH_BYTES
        high = min(len(data), high + int(gap[0])) if high < len(data) else len(data)
        inner = starts_of_docs[(starts_of_docs > low) & (starts_of_docs < high)] - low
        found, at = _hashes(data[low:high], inner)
        hashes.append(found)
        begins.append(at + low)
        low = high
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), starts_of_docs).astype(np.int64)


def _hashes(data: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and where they begin. inner: where further texts begin."""
    space = _IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[inner] = True
    inside = ~space
    begins = np.flatnonzero(inside & np.concatenate([[True], space[:-1] | edge[1:-1]]))
    ends = np.flatnonzero(inside & np.concatenate([space[1:] | edge[1:-1], [True]])) + 1
    if not len(begins):
        return np.empty(0, np.uint64), begins
    length = ends - begins
    bounds = np.concatenate([[0], begins[1:], [len(data)]])
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(begins, np.diff(bounds))
    longest = int(length.max())
    value = _BYTE[_FOLD[data]]
    value *= _powers(longest + 1)[np.clip(place, 0, longest)]
    value[space] = 0
    hashes = np.add.reduceat(value, begins)
    return mix64(hashes + length.astype(np.uint64) * np.uint64(_BASE)), begins


def slices(offsets: np.ndarray, most: int = 1 << 22) -> list[tuple[int, int]]:
    """Half-open ranges of texts of about `most` bytes together, one text at least."""
    cuts, low = [], 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        cuts.append((low, high))
        low = high
    return cuts


def arrow_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column, nulls as empty, and the offsets of its texts."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64)


def shingle_hashes(words_hashed: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `width` words inside each text, in order, and offsets like `first`.

    A text with fewer words (but one at least) has its whole sequence as its only shingle.
    """
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    if not offsets[-1]:
        return np.empty(0, np.uint64), offsets
    at = np.arange(offsets[-1], dtype=np.int64) + np.repeat(first[:-1] - offsets[:-1], n)
    have = np.repeat(np.minimum(count, width), n)
    by = odd_multipliers(width, 3)
    out = have.astype(np.uint64) * np.uint64(_BASE)
    for k in range(width):
        there = have > k
        out[there] = mix64(out[there] ^ words_hashed[at[there] + k]) * by[k] if not there.all() else mix64(out ^ words_hashed[at + k]) * by[k]
    return mix64(out), offsets
