"""Divergence of the sources of each language, by joint histograms of term counts.

Terms are runs of letters (A-Z and all beyond ASCII). A group, one source of a language,
gives a kept term of its c occurrences the rate p(c) = 1 + floor(10**9 (c + 5) / (N + 5 V)),
so that a sum of f = |p - q| over all terms depends only on how often each pair of counts
occurs. The terms are dealt into chunks and the groups into blocks; for two blocks and a
chunk the pairs of counts are tallied, terms that only one of two groups has included,
and the tallies of the chunks are added. What is left of V are the terms that neither
has. f is evaluated once for each pair of counts and multiplied.

No row is made for a term and two groups: a table of a chunk's terms and a block's groups
is filled from one row for each count. Its size is bounded; a group that holds a third of
all rows is spread over all chunks.

Defined cases: a null text, language or source is an empty string; an empty language or
source is one like others; a group without kept terms takes part with counts of zero; a
language with no kept term has divergences of zero; ties are ordered by name; rows that
repeat count as documents of their own; other columns are not read; an empty table gives
an empty result. Numbers are integers throughout, in decimals where they may pass 64 bits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import storage
from .words import LOWER, arrow_bytes, slices

#: A term, in UTF-8; rates are parts of 10**9, counts are raised by 5.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
NOT_TERM = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
SCALE, RAISE = 1_000_000_000, 5
#: Counts that a task holds before it gives them out; bytes of a text that are searched together.
HELD, LONG = 1 << 19, 1 << 20
#: Terms in a chunk and groups in a block, about.
CHUNK, BLOCK = 2048, 32


def _runs(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in runs of bounded length."""
    low = 0
    while low < len(data):
        gap = NOT_TERM.search(data, low + LONG)
        high = gap.start() if gap else len(data)
        yield TERM.findall(data, low, high)
        low = high


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Occurrences n and documents df of each term: lang, source, term, n, df. Each group also has a row with a null term."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def give() -> pa.RecordBatch:
            rows = [(*group, term, k, df[term]) for group, (n, df) in held.items() for term, k in n.items()] + [(*group, None, 0, 0) for group in held]
            held.clear()
            columns = zip(*rows, strict=True)
            types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays[:2], arrays[2].cast(pa.string()), *arrays[3:]], names=["lang", "source", "term", "n", "df"])

        for b in batches:
            langs, sources = b.column(0).to_pylist(), b.column(1).to_pylist()
            data, offsets = arrow_bytes(b.column(2))
            for low, high in slices(offsets):
                lowered = data[offsets[low] : offsets[high]].tobytes().translate(LOWER)
                at = (offsets[low : high + 1] - offsets[low]).tolist()
                for k in range(high - low):
                    n, df = held.setdefault((langs[low + k], sources[low + k]), (Counter(), Counter()))
                    distinct: set[bytes] = set()
                    for run in _runs(lowered[at[k] : at[k + 1]]):
                        n.update(run)
                        distinct.update(run)
                    df.update(distinct)
                if sum(len(n) for n, _ in held.values()) > HELD:
                    yield give()
        if held:
            yield give()

    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]
    found = docs.select(*names, F.col(text).alias("text")).mapInArrow(scan, "lang string, source string, term string, n long, df long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def rate(n: Column, total: Column, kept: Column) -> Column:
    """The rate of a count n in a group of `total` occurrences, of `kept` terms; null where there is no term."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(RAISE)).cast("decimal(19,0)")
    below = F.nullif(total + F.lit(RAISE) * kept, F.lit(0).cast("long"))
    # What a division by a long leaves is exact: from the quotient's remainder, not from a rounded fraction.
    below = below.cast("decimal(19,0)")
    return (F.lit(1) + ((above - above % below) / below).cast("decimal(38,0)").cast("long")).cast("long")


class Audit:
    """Tables of one audit: groups with their totals, kept terms with their counts."""

    def __init__(self, docs: DataFrame, lang: str, source: str, text: str, least: int):
        counts = storage.table(term_counts(docs, lang, source, text), "term-counts")
        kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("df").alias("df")).where(F.col("df") >= least)
        kept = storage.table(kept.select("lang", "term", "n_lang", F.monotonically_increasing_id().alias("tid")), "kept-terms")
        sizes = storage.table(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang")), "kept-sizes")
        held = counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(kept, ["lang", "term"])
        self.counts = storage.table(held, "kept-counts")
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "v", "total_lang"])
        self.groups = storage.table(groups.withColumn("gid", F.monotonically_increasing_id()), "groups")
        most = sizes.agg(F.max("v")).first()[0] or 0
        widest = self.groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
        self.chunks, self.blocks = max(1, -(-most // CHUNK)), max(1, -(-widest // BLOCK))

    def joint_counts(self) -> DataFrame:
        """How many kept terms of a language have a pair of counts, not both zero, in two groups: lang, i, j, ci, cj, terms.

        Each unordered pair of groups comes in one order, and has a row of zero counts and no terms too.
        """
        chunks, blocks = self.chunks, self.blocks
        groups = self.groups.select("lang", "source", "gid", F.pmod(F.xxhash64("gid"), F.lit(blocks)).alias("block"))
        cells = self.counts.join(groups, ["lang", "source"]).select("lang", "gid", "block", "tid", "n", F.pmod(F.xxhash64("tid"), F.lit(chunks)).alias("chunk"))
        # A group is in every chunk, with or without a count there.
        seeds = groups.select("lang", "gid", "block", F.lit(None).cast("long").alias("tid"), F.lit(0).cast("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"))
        cells = cells.unionByName(seeds).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        cells = cells.select("lang", "chunk", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "gid", "tid", "n")

        def tally(table: pa.Table) -> pa.Table:
            get = lambda name: table.column(name).to_numpy()
            a, b, chunk = (table.column(c)[0].as_py() for c in ("a", "b", "chunk"))
            gid, n, block = get("gid"), get("n"), get("block")
            has = table.column("tid").is_valid().to_numpy()
            tids, column = np.unique(table.column("tid").drop_null().to_numpy(), return_inverse=True)
            values, code = np.unique(np.append(n, 0), return_inverse=True)
            sides = [np.unique(gid[block == x]) for x in ((a,) if a == b else (a, b))]
            full = np.zeros((sum(map(len, sides)), len(tids)), np.int64)
            ordered = np.concatenate(sides)
            place = np.argsort(ordered)
            full[place[np.searchsorted(ordered[place], gid[has])], column] = code[:-1][has]
            out: list[list[np.ndarray]] = []
            for x in range(len(sides[0])):
                y = np.arange(x + 1 if a == b else len(sides[0]), len(ordered))
                if not len(y):
                    continue
                width = len(values)
                key = (np.arange(len(y))[:, None] * width + full[x]) * width + full[y]
                found, many = np.unique(key, return_counts=True)
                cx, cy = found // width % width, found % width
                some = (cx > 0) | (cy > 0)
                found, many, cx, cy = found[some], many[some], cx[some], cy[some]
                to = y[found // width // width]
                if chunk == 0:
                    to, many, cx, cy = np.append(to, y), np.append(many, np.zeros(len(y), np.int64)), np.append(cx, np.zeros(len(y), np.int64)), np.append(cy, np.zeros(len(y), np.int64))
                out.append([np.full(len(to), ordered[x]), ordered[to], values[cx], values[cy], many])
            columns = [np.concatenate(c) if c else np.empty(0, np.int64) for c in (zip(*out, strict=True) if out else [()] * 5)]
            lang = pa.array([table.column("lang")[0].as_py()] * len(columns[0]), pa.string())
            return pa.table([lang, *(pa.array(c.astype(np.int64)) for c in columns)], names=["lang", "i", "j", "ci", "cj", "terms"])

        found = cells.groupBy("lang", "chunk", "a", "b").applyInArrow(tally, "lang string, i long, j long, ci long, cj long, terms long")
        return found.groupBy("lang", "i", "j", "ci", "cj").agg(F.sum("terms").alias("terms"))

    def pairs(self) -> DataFrame:
        """Divergence of every two sources of a language, both ways: lang, source, part, item, value, rank."""
        side = lambda s: self.groups.select(F.col("gid").alias(s), F.col("source").alias(f"source_{s}"), F.col("total").alias(f"total_{s}"), *(["v"] if s == "i" else []))
        cells = self.joint_counts().join(side("i"), "i").join(side("j"), "j")
        p, q = (lambda c, s=s: rate(c, F.col(f"total_{s}"), F.col("v")) for s in "ij")
        zero = F.lit(0).cast("long")
        sums = cells.groupBy("lang", "i", "j", "source_i", "source_j", "total_i", "total_j", "v").agg(
            F.sum(F.col("terms") * F.abs(p(F.col("ci")) - q(F.col("cj")))).alias("value"), F.sum("terms").alias("some")
        )
        rest = (F.col("v") - F.col("some")) * F.abs(p(zero) - q(zero))
        value = F.when(F.col("v") == 0, zero).otherwise(F.col("value") + rest)
        both = F.explode(F.array(F.struct(F.col("source_i").alias("source"), F.col("source_j").alias("item")), F.struct(F.col("source_j").alias("source"), F.col("source_i").alias("item"))))
        out = sums.select("lang", value.alias("value"), both.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
        return out.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    def terms(self, top: int) -> DataFrame:
        """The `top` kept terms of each group that it has most above its language's rate: lang, source, part, item, value, rank."""
        rows = self.counts.where("n > 0").join(self.groups.select("lang", "source", "total", "total_lang", "v"), ["lang", "source"])
        value = rate(F.col("n"), F.col("total"), F.col("v")) - rate(F.col("n_lang"), F.col("total_lang"), F.col("v"))
        rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")).where("value > 0")
        return rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = 30, top: int = 50) -> DataFrame:
    """Both parts of the audit. least: documents of its language that a kept term is in; top: terms listed for each group."""
    held = Audit(docs, lang, source, text, least)
    return held.pairs().unionByName(held.terms(top))
