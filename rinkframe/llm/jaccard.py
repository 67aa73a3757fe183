"""Near duplicates by Jaccard similarity of word shingles, with PartEnum signatures.

Sets are banded by size so that similar sets lie in one band or in neighbours. For two
bands taken together, sets as similar as asked differ in at most k elements. The
domain of elements is dealt into first-level parts, more than floor(k / (k2 + 1)), so
that in some part at most k2 elements differ; each part has n2 cells, and in that part
some choice of n2 - k2 cells is free of differences. A signature is the hash of the
elements in one such choice. `slack` further parts make sure that a similar pair
shares a signature that is not empty, so that empty ones need not be given out. The same
slack lets sets leave out signatures that very many sets share, as of a common passage.

Equal sets are one class from the start. Only signatures that occur twice leave the first
pass. Sets that share fewer of them than their slack demands of any similar pair are set
aside. Among the classes that share a signature, the one with the most shared signatures leads; the others are compared with it by the
exact sizes of sets. Of those that are near to the leader but that links leave apart,
the pairs compared are the ones that differ from it alike; those far from it are led by
the next, and so on; what no leader is near to is paired by its rarest elements. A pair is compared unless links already join it.

Defined cases: a null or wordless text has the empty set and links with nothing; a text
with fewer words than a shingle has its whole sequence as its only element; a null
doc_id takes part, but is never the smallest; rows that repeat are linked; an empty
table gives an empty result; other columns are not read (`near_duplicates`) or pass
through unchanged (`keep_one`), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import storage
from .components import components
from .words import arrow_bytes, mix64, set_aside, shingle_hashes, slices, word_hashes

#: Bytes of texts signed together, and bytes of all texts for each bucket of the space of signatures.
BLOCK_BYTES, BUCKET_BYTES = 1 << 23, 1 << 24
#: Rounds in which each bucket has one leader; then what is far from all of them is paired by its rarest elements.
LEADERS = 2
#: Similarity to a leader, in per cent, from which classes are paired by the elements in which they differ from it.
NEAR = 50
#: Rows above which a signature is frequent, and left out where that loses nothing.
FREQUENT = 64


class Bands:
    """Size bands and the parameters of each pair of neighbouring bands."""

    def __init__(self, per_cent: int):
        self.per_cent, self.lows, self.plans = per_cent, [1], {}

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.lows[-1] <= sizes.max(initial=0):
            self.lows.append(self.lows[-1] * 100 // self.per_cent + 1)
        return np.searchsorted(self.lows, sizes, "right") - 1

    def differ(self, most: int) -> int:
        """Elements in which similar sets of at most `most` elements can differ."""
        return 2 * most * (100 - self.per_cent) // (100 + self.per_cent)

    def plan(self, g: int) -> tuple[int, int, int, int]:
        """Parts, cells a part, free cells and slack for bands g - 1 and g."""
        if g not in self.plans:
            while len(self.lows) <= g + 1:
                self.lows.append(self.lows[-1] * 100 // self.per_cent + 1)
            k = self.differ(self.lows[g + 1] - 1)
            n2, free = (3, 1) if k < 16 else (1, 0)
            least = k // (free + 1) + 1
            slack = 0
            for t in range(2 * least + 8):
                # Parts with an empty choice to be expected in the smallest sets, a margin, and room for frequent signatures.
                empty = (least + t) * min(1.0, n2 * np.exp(-self.lows[max(g - 1, 0)] * (n2 - free) / n2 / (least + t)))
                if empty + 3 * np.sqrt(empty) + 0.1 * least + 2 <= t:
                    slack = t
                    break
            self.plans[g] = (least + slack, n2, free, slack) if k else (0, 0, 0, 0)
        return self.plans[g]


def text_sets(column, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, distinct shingle hashes of each text, one after another, and their offsets."""
    data, offsets = arrow_bytes(column)
    hashes, first = word_hashes(data, offsets)
    found, at = shingle_hashes(hashes, first, width)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            found[a:b].sort()
    fresh = np.ones(len(found), bool)
    if len(found):
        fresh[1:] = found[1:] != found[:-1]
        fresh[at[:-1][at[:-1] < len(found)]] = True
    return found[fresh], np.concatenate([[0], np.cumsum(fresh)])[at].astype(np.int64)


def _sums(values: np.ndarray, cells: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values by cell, modulo 2**64."""
    low = np.bincount(cells, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(cells, (values >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def set_keys(elements: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each set."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    return tuple(mix64(_sums(mix64(elements ^ np.uint64(seed)), owner, len(at) - 1)).view(np.int64) for seed in (0x1B873593CC9E2D51, 0x38495AB5A1B2C3D4))


def signatures(elements: np.ndarray, at: np.ndarray, bands: Bands) -> tuple[np.ndarray, ...]:
    """PartEnum signatures of sets: signature, number of its set, shift (0 or 1), and rooms by set and shift.

    With shift 0 a set signs for its band and the one below, with shift 1 for its band and the
    one above. Similar sets share more signatures of that pair of bands than the room of either.
    """
    sizes = np.diff(at)
    band = bands.of(sizes)
    spread, value = mix64(elements ^ np.uint64(0x6A09E667F3BCC908)), mix64(elements ^ np.uint64(0xBB67AE8584CAA73B))
    marks, owners, shifts = [], [], []
    rooms = np.zeros((len(sizes), 2), np.int32)
    for shift in (0, 1):
        groups = np.where(sizes > 0, band + shift, -1)
        for n2 in (1, 3):
            plans = {g: bands.plan(int(g)) for g in np.unique(groups[groups >= 0])}
            chosen = np.flatnonzero([g >= 0 and plans[g][1] == n2 for g in groups])
            if not len(chosen):
                continue
            parts = np.array([plans[groups[i]][0] for i in chosen], np.int64)
            slack = np.array([plans[groups[i]][3] for i in chosen], np.int64)
            base = np.concatenate([[0], np.cumsum(parts)])
            many = sizes[chosen]
            own = np.repeat(np.arange(len(chosen)), many)
            take = np.arange(many.sum()) + np.repeat(at[chosen] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
            cell = (spread[take] % (parts * n2).astype(np.uint64)[own]).astype(np.int64) + base[own] * n2
            total = _sums(value[take], cell, base[-1] * n2).reshape(-1, n2)
            count = np.bincount(cell, minlength=base[-1] * n2).reshape(-1, n2)
            holder = np.repeat(np.arange(len(chosen)), parts)
            place = np.arange(base[-1]) - base[holder]
            choices = list(combinations(range(n2), max(1, n2 - 1)))
            empty = np.stack([count[:, c].sum(1) == 0 for c in choices], 1)
            weak = np.bincount(holder, empty.any(1), len(chosen)).astype(np.int64)
            rooms[chosen, shift] = slack - weak
            for k, c in enumerate(choices):
                where = mix64(groups[chosen][holder].astype(np.uint64) << np.uint64(40) | place.astype(np.uint64) << np.uint64(4) | np.uint64(k * 4 + n2))
                mark = mix64(total[:, c].sum(1, dtype=np.uint64) ^ where)
                give = ~empty[:, k] | (weak > slack)[holder]
                marks.append(mark[give])
                owners.append(chosen[holder[give]])
                shifts.append(np.full(len(owners[-1]), shift))
    join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    return join(marks, np.uint64), join(owners, np.int64), join(shifts, np.int64), rooms


def bounded(batches: Iterator[pa.RecordBatch], text: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut batches so that their texts, column number `text`, are of a few MB together, and of 2**15 rows at most."""
    for b in batches:
        _, offsets = arrow_bytes(b.column(text))
        for low, high in slices(offsets, most):
            for at in range(low, high, 1 << 15):
                yield b.slice(at, min(high - at, 1 << 15))


_MEMBER = np.dtype([("doc_id", "<i8"), ("none", "<i8"), ("mark", "<i8"), ("place", "<i8"), ("n", "<i8"), ("k1", "<i8"), ("k2", "<i8"), ("room0", "<i8"), ("room1", "<i8")])
_MET = "sig long, block long, owner int, shift int, doc_id long, mark long, n long, k1 long, k2 long, room0 int, room1 int"


def _signed(docs: DataFrame, width: int, per_cent: int, n_buckets: int) -> DataFrame:
    """Signatures that occur twice (sig, block, owner, shift), and a row without sig for each row of docs.

    Texts are signed in blocks. A block sends one message to each bucket of the space of
    signatures, with 32 bits of each signature, and the number of its set in the block: six bytes
    a signature instead of a row. A signature that is repeated inside the block is sent
    once, so that a bucket takes it once from each block at most; its rows, and the members of
    the block, travel in a message of their own. Two signatures that agree in their bucket and
    in 32 bits count as one, which can only bring further candidates.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(per_cent)
        for b in bounded(batches, 2, BLOCK_BYTES):
            elements, at = text_sets(b.column(2), width)
            k1, k2 = set_keys(elements, at)
            # Equal sets of a block sign once.
            first, place = np.unique(k1, return_index=True, return_inverse=True)[1:]
            sizes = np.diff(at)[first]
            take = np.arange(sizes.sum()) + np.repeat(at[first] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            sig, owner, shift, rooms = signatures(elements[take], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), bands)
            members = np.zeros(len(b), _MEMBER)
            ids = b.column(0)
            members["doc_id"], members["none"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            members["mark"], members["place"], members["n"], members["k1"], members["k2"] = b.column(1).to_numpy(), place, np.diff(at), k1, k2
            members["room0"], members["room1"] = rooms[place, 0], rooms[place, 1]
            block = int(mix64(_sums(mix64(k1.view(np.uint64) + np.arange(len(k1), dtype=np.uint64)), np.zeros(len(k1), np.int64), 1)).view(np.int64)[0])
            bucket = (sig >> np.uint64(32)) % np.uint64(n_buckets)
            key = bucket << np.uint64(32) | sig & np.uint64(0xFFFFFFFF)
            order = np.argsort(key, kind="stable")
            key, who = key[order], (owner * 2 + shift)[order].astype(np.uint16)
            begins = np.append(True, key[1:] != key[:-1])[: len(key)]
            again = ~begins | np.append(~begins[1:], False)[: len(key)]
            rows = [(-1, block, key[again].tobytes(), who[again].tobytes(), members.tobytes())]
            key, who = key[begins], who[begins]
            cut = np.flatnonzero(np.append(True, (key[1:] ^ key[:-1]) >> np.uint64(32) != 0)[: len(key)])
            # A block of blank or short texts has no signature, and then only its members travel.
            for x, y in zip(cut.tolist(), np.append(cut, len(key))[1:].tolist(), strict=True):
                rows.append((int(key[x] >> np.uint64(32)), block, key[x:y].astype(np.uint32).tobytes(), who[x:y].tobytes(), None))
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["bucket", "block", "prints", "who", "members"])

    def met(rows: pa.Table) -> pa.Table:
        bucket, blocks = rows.column("bucket")[0].as_py(), rows.column("block").to_numpy()
        who = [np.frombuffer(x.as_buffer(), np.uint16) for x in rows.column("who")]
        kind = np.uint64 if bucket < 0 else np.uint32
        prints = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in rows.column("prints")])
        block, who = np.repeat(blocks, [len(x) for x in who]), np.concatenate(who)
        if bucket >= 0:
            order = np.argsort(prints, kind="stable")
            same = prints[order[1:]] == prints[order[:-1]]
            keep = order[np.append(same, False)[: len(order)] | np.append(False, same)[: len(order)]]
            prints, block, who = prints[keep].astype(np.uint64) | np.uint64(bucket << 32), block[keep], who[keep]
        found = {"sig": prints.view(np.int64), "block": block, "owner": who >> 1, "shift": who & 1}
        out = [pa.table({k: pa.array(v.astype(np.int64)) for k, v in found.items()})]
        if bucket < 0:
            x = np.concatenate([np.frombuffer(m.as_buffer(), _MEMBER) for m in rows.column("members")])
            of = np.repeat(blocks, [len(m.as_buffer()) // _MEMBER.itemsize for m in rows.column("members")])
            table = {k: pa.array(x[k]) for k in ("mark", "n", "k1", "k2", "room0", "room1")}
            out.append(pa.table(table | {"block": pa.array(of), "owner": pa.array(x["place"]), "doc_id": pa.array(x["doc_id"], mask=x["none"] > 0)}))
        schema = pa.schema([(c.split()[0], pa.int32() if c.endswith("int") else pa.int64()) for c in _MET.split(", ")])
        return pa.concat_tables([pa.table({f.name: t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(len(t), f.type) for f in schema}) for t in out])

    sent = docs.mapInArrow(scan, "bucket long, block long, prints binary, who binary, members binary")
    own = F.when(F.col("bucket") < 0, F.col("block")).otherwise(F.lit(0)).alias("own")
    return sent.groupBy("bucket", own).applyInArrow(met, _MET)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """The sets themselves: k1, k2, elements (sorted 64-bit numbers)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in bounded(batches, 0):
            elements, at = text_sets(b.column(0), width)
            k1, k2 = set_keys(elements, at)
            yield pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array([elements[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["k1", "k2", "elements"])

    return docs.select("text").mapInArrow(scan, "k1 long, k2 long, elements binary")


def _compare(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Of pairs (a, b) of classes, those at least `least` per cent similar.

    a, b, their sizes na and nb, shared (common elements), delta (elements in which they differ).
    """
    left = sets.select(F.col("c").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("c").alias("b"), F.col("elements").alias("eb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ea", "eb")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, found = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                z = np.concatenate([u, v]).view(np.uint64)
                z.sort(kind="stable")
                same = z[1:] == z[:-1]
                shared = int(same.sum())
                good.append(100 * shared >= least * (len(z) - shared))
                if good[-1]:
                    alone = np.ones(len(z), bool)
                    alone[1:] &= ~same
                    alone[:-1] &= ~same
                    found.append((len(u), len(v), shared, z[alone].view(np.int64)))
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))
            sizes = [pa.array([f[k] for f in found], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *sizes, pa.array([f[3] for f in found], pa.list_(pa.int64()))], names=["a", "b", "na", "nb", "shared", "delta"])

    return both.mapInArrow(scan, "a long, b long, na long, nb long, shared long, delta array<long>")


def _differing_alike(near: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) of the classes next to one leader that may be similar though links do not join them.

    near: a (the leader), b, na, nb, shared, delta, label (of b). Let D be the elements in which
    a class differs from the leader. Similar classes with disjoint D are each similar to the
    leader; so a pair that is not yet joined shares elements of D, and where a side is not
    similar to the leader, so many that they share one of the rarest few (a prefix filter).
    """
    more, less = 100 + per_cent, 100 - per_cent
    n, d = F.col("nb"), F.size("delta")
    apart = near.groupBy("a").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("a")
    # Elements of D in common: at least these with any similar class, and with one that is not similar to the leader.
    any_ = F.greatest(F.lit(1), d - F.floor(n * less / per_cent))
    other = F.greatest(any_, F.floor((less * (F.col("na") - n) + more * d) / (2 * more)) + 1)
    rows = near.join(apart, "a", "left_semi").select(F.col("a").alias("leader"), F.col("b").alias("c"), "nb", "label", (100 * F.col("shared") < per_cent * (F.col("na") + n - F.col("shared"))).alias("off"), (d - any_ + 1).alias("p_any"), (d - other + 1).alias("p_off"), F.explode("delta").alias("element"))
    rows = storage.table(rows, "differing")
    common = rows.groupBy("leader", "element").agg(F.count("*").alias("many")).where("many > 1")
    rank = F.row_number().over(W.partitionBy("leader", "c").orderBy("many", "element"))
    ranked = rows.join(common, ["leader", "element"], "left").withColumn("many", F.coalesce("many", F.lit(1))).withColumn("rank", rank)
    # What only one class differs in meets nothing.
    ranked = ranked.where((F.col("many") > 1) & (F.col("rank") <= F.when(F.col("off"), F.greatest("p_any", "p_off")).otherwise(F.col("p_off"))))
    ranked = storage.table(ranked, "differing")
    x, y = ranked.where("off").alias("x"), ranked.alias("y")
    both_off = F.col("y.off") & (F.col("x.rank") <= F.col("x.p_off")) & (F.col("y.rank") <= F.col("y.p_off")) & (F.col("x.c") < F.col("y.c"))
    one_off = ~F.col("y.off") & (F.col("x.rank") <= F.col("x.p_any"))
    on = (F.col("x.leader") == F.col("y.leader")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.label") != F.col("y.label"))
    fits = 100 * F.least("x.nb", "y.nb") >= per_cent * F.greatest("x.nb", "y.nb")
    return x.join(y, on & fits & (both_off | one_off)).select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")).distinct()


def _sharing(rows: DataFrame, need: Column) -> DataFrame:
    """Rows whose set shares as many signatures as `need` in its pair of bands, and whose signature two classes or more hold."""
    for _ in range(2):
        two = rows.groupBy("sig").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("sig")
        held = rows.join(two, "sig", "left_semi")
        enough = held.groupBy("c", "shift").agg(F.count("*").alias("many"), F.first(need).alias("need")).where("many >= need").select("c", "shift")
        held = storage.table(held.join(enough, ["c", "shift"], "left_semi"), "sharing")
        storage.discard(rows)
        rows = held
    return rows


def _buckets(met: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes by signature: sig, c, n, degree (signatures of the class)."""
    owners = met.where("sig is null and n > 0").select("block", "owner", "k1", "k2", "room0", "room1").distinct().join(classes.select("k1", "k2", "c", "n"), ["k1", "k2"])
    rows = met.where("sig is not null").select("sig", "block", "owner", "shift").join(owners, ["block", "owner"])
    rows = rows.select("sig", "c", "n", "shift", F.when(F.col("shift") == 0, F.col("room0")).otherwise(F.col("room1")).alias("room")).distinct()
    rows = _sharing(storage.table(rows, "signed"), F.greatest(F.lit(1), F.col("room") + 1))
    # A set whose frequent signatures are few enough shares another one with each similar set, and leaves them out.
    frequent = rows.groupBy("sig").agg((F.count("*") > FREQUENT).alias("frequent"))
    marked = rows.join(frequent, "sig")
    count = marked.groupBy("c", "shift").agg(F.count_if("frequent").alias("n_frequent"))
    marked = marked.join(count, ["c", "shift"]).where(~F.col("frequent") | (F.col("n_frequent") > F.col("room")))
    left = storage.table(marked.select("sig", "c", "n", "shift", F.greatest(F.lit(1), F.col("room") + 1 - F.col("n_frequent")).alias("need")), "buckets")
    storage.discard(rows)
    left = _sharing(left, F.col("need"))
    degree = left.groupBy("c").agg(F.count("*").alias("degree"))
    out = storage.table(left.join(degree, "c").select("sig", "c", "n", "degree"), "buckets")
    storage.discard(left)
    return out


def _rare_pairs(left: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b) of classes that may be similar and have unlike labels, by a prefix filter over their rarest elements.

    left: c, n, label. Similar classes share one of the n - ceil(per_cent n / 100) + 1 elements
    of each that come first in one order of all elements; here the order is by how many
    classes hold them, so that what many share brings no pairs.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, high in slices(arrow_bytes(b.column(1))[1]):
                part = b.slice(low, high - low)
                data, at = arrow_bytes(part.column(1))
                own = pa.array(np.repeat(np.arange(len(part)), np.diff(at) // 8))
                yield pa.RecordBatch.from_arrays([part.column(0).take(own), pa.array(np.frombuffer(data.tobytes(), np.int64))], names=["c", "element"])

    rows = storage.table(sets.join(left, "c", "left_semi").select("c", "elements").mapInArrow(spread, "c long, element long"), "elements")
    common = rows.groupBy("element").agg(F.count("*").alias("many")).where("many > 1")
    rank = F.row_number().over(W.partitionBy("c").orderBy("many", "element"))
    held = F.count("*").over(W.partitionBy("c"))
    ranked = rows.join(common, "element").withColumn("rank", rank).withColumn("held", held).join(left, "c")
    # Elements of one class alone come first in the order, and meet nothing.
    first = F.col("n") - F.ceil(F.col("n") * per_cent / 100) + 1 - (F.col("n") - F.col("held"))
    ranked = storage.table(ranked.where(F.col("rank") <= first).select("c", "n", "label", "element"), "prefixes")
    x, y = ranked.alias("x"), ranked.alias("y")
    fits = 100 * F.least("x.n", "y.n") >= per_cent * F.greatest("x.n", "y.n")
    both = x.join(y, (F.col("x.element") == F.col("y.element")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.label") != F.col("y.label")) & fits)
    return both.select(F.col("x.c").alias("a"), F.col("y.c").alias("b")).distinct()


def _links(docs: DataFrame, met: DataFrame, classes: DataFrame, width: int, per_cent: int) -> DataFrame:
    """Links (a, b) between classes c that join all classes which similar pairs join."""
    rows = _buckets(met, classes)
    near = rows.select("c").distinct().join(classes, "c")
    texts = docs.join(near.select(F.col("doc_id").alias("near_id"), F.col("mark").alias("near_mark")), F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("mark") == F.col("near_mark")), "left_semi")
    sets = storage.table(_sets(texts, width).join(near.select("k1", "k2", "c"), ["k1", "k2"]).dropDuplicates(["c"]).select("c", "elements"), "sets")
    links = candidates = None
    alive = rows.withColumn("label", F.col("c"))
    before = rows
    for _ in range(LEADERS):
        # A bucket's leader: of its classes, the one with the most signatures shared.
        first = alive.groupBy("sig").agg(F.min(F.struct((-F.col("degree")).alias("d"), "c", "n")).alias("l"))
        first = storage.table(first.select("sig", F.col("l.c").alias("a"), F.col("l.n").alias("na")), "leaders")
        led = alive.withColumnRenamed("c", "b").join(first, "sig").where("a <> b")
        pairs = storage.table(led.where(100 * F.least("n", "na") >= NEAR * F.greatest("n", "na")).select("a", "b").distinct(), "pairs")
        near = storage.table(_compare(pairs, sets, NEAR), "near")
        union = F.col("na") + F.col("nb") - F.col("shared")
        good = near.where(100 * F.col("shared") >= per_cent * union).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        good = storage.table(good if links is None else links.union(good), "links")
        if links is not None:
            storage.discard(links)
        links = good
        labels = components(links).select(F.col("node").alias("b"), F.col("label").alias("l"))
        labelled = near.join(labels, "b", "left").withColumn("label", F.coalesce("l", "b"))
        alike = storage.table(_differing_alike(labelled, per_cent), "pairs")
        candidates = alike if candidates is None else candidates.union(alike)
        # Of two similar classes, one nearer to the leader than NEAR has the other within the margin: both are dealt with, or both stay.
        close = near.where(100 * F.col("shared") >= (100 + NEAR - per_cent) * union).select("a", "b")
        left = led.select("sig", "a", "b", "n", "degree", "label").join(close, ["a", "b"], "left_anti")
        left = left.join(labels, "b", "left").select("sig", F.col("b").alias("c"), "n", "degree", F.coalesce("l", "label").alias("label"))
        left = storage.table(left, "alive")
        apart = left.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("sig")
        alive = storage.table(left.join(apart, "sig", "left_semi"), "alive")
        storage.discard(before, first, pairs, near, left)
        before = alive
        if not alive.limit(1).count():
            break
    # What is yet apart, and far from every leader.
    if alive.limit(1).count():
        candidates = candidates.union(_rare_pairs(alive.select("c", "n", "label").distinct(), sets, per_cent))
    pairs = storage.table(candidates.distinct(), "pairs")
    return links.union(storage.table(_compare(pairs, sets, per_cent).select("a", "b"), "links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, per_cent: int = 80) -> DataFrame:
    """One row per document: doc_id, mark (a hash of its text), n_shingles, component_id, label.

    Two documents link when 100 * intersection >= per_cent * union of their sets of
    `width`-word shingles; component_id is the smallest doc_id that links lead to, null where
    none of them has one. label is unique to each component of more than one row, null elsewhere.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = d.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    met = storage.table(_signed(d, width, per_cent, 1 + int(size) // BUCKET_BYTES), "met")
    members = met.where("sig is null").select("doc_id", "mark", "n", "k1", "k2")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    classes = members.where("n > 0").groupBy("k1", "k2", "n").agg(F.count("*").alias("copies"), best.alias("best"))
    classes = storage.table(classes.select("k1", "k2", "n", "copies", F.col("best.doc_id").alias("doc_id"), F.col("best.mark").alias("mark")).withColumn("c", F.monotonically_increasing_id()), "classes")
    labels = components(_links(d, met, classes, width, per_cent))
    joined = classes.join(labels, classes["c"] == labels["node"], "left").withColumn("label", F.coalesce("label", "c")).where((F.col("copies") > 1) | F.col("node").isNotNull())
    lowest = joined.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = storage.table(joined.join(lowest, "label").select("k1", "k2", "component_id", "label"), "components")
    out = members.join(of_class, ["k1", "k2"], "left")
    return out.select("doc_id", "mark", F.col("n").alias("n_shingles"), F.when(F.col("label").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of docs without near duplicates: of each component the row with the smallest doc_id stays."""
    found = storage.table(near_duplicates(docs, doc_id, text, width, per_cent).where(F.col("label").isNotNull()).select("doc_id", "mark", "label"), "found")
    # Of a component's rows, by partial minimum, the first by doc_id and hash stays.
    first = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("f"))
    rows = found.join(first, "label")
    stays = F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("mark") == F.col("f.mark"))
    gone = storage.table(rows.where(~stays).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct(), "gone")
    d, (i, t) = set_aside(docs, doc_id, text)
    kept = d.join(gone, F.col(i).eqNullSafe(F.col("gone_id")) & (F.xxhash64(F.col(t)) == F.col("gone_mark")), "left_anti")
    if rows.where(stays).groupBy("doc_id", "mark").count().where("count > 1").limit(1).count():
        # Rows with one doc_id and one text repeat; only then does a second pass remove all but one.
        words_in = F.coalesce(F.col(t), F.lit("")).rlike("[^ \\t-\\r]")
        once = kept.where(words_in).withColumns({"id_": F.col(i), "mark_": F.xxhash64(F.col(t))}).dropDuplicates(["id_", "mark_"]).select(*d.columns)
        kept = once.unionByName(kept.where(~words_in))
    return kept.toDF(*docs.columns)
