"""Mix sources to target weights with DataFrame operations only.

Words are summed per source; targets share the whole by weight, no source above
`most` times its size, the excess shared anew until none is above. A document comes
floor(rate) times, and once more where a hash of a seed and its doc_id falls below
the rate's fraction. Each source takes, of a few seeds, the one whose draws come
nearest to its target, so that small sources do not stray. Given the seed, draws are as
independent as the hash; the choice makes the number of extra copies of a source vary
less than that of one seed's draws would, and favours no document beforehand.

Defined cases: a null text has size 0; the null source is a source of its own, ranked
last; a source without words has rate 0; rows that share a doc_id get the same draw; a
null doc_id draws as the text "null"; an empty table gives an empty result; other
columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import storage
from .words import word_count


#: Seeds of which each source takes one.
SEEDS = 16


def draw(doc_id: Column, seed: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the document only."""
    digest = F.md5(F.concat(seed.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def ranked(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add for each name in sums the sum of its column over the rows before, in this order, without one task that holds all rows."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.withColumns(sums).repartitionByRange(n, *order).withColumn("part_", F.spark_partition_id())
    dealt = storage.table(dealt, "ranked")
    before = lambda name, w: F.coalesce(F.sum(name).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = dealt.groupBy("part_").agg(*[F.sum(k).alias(k) for k in sums])
    # A window over one row per partition, at most n.
    parts = parts.select("part_", *[before(k, W.orderBy("part_")).alias(f"{k}_") for k in sums])
    inside = W.partitionBy("part_").orderBy(*order)
    out = dealt.withColumns({k: before(k, inside) for k in sums}).join(parts, "part_")
    return out.withColumns({k: F.col(k) + F.col(f"{k}_") for k in sums}).drop("part_", *[f"{k}_" for k in sums])


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Target of each source: source, source_size, target, rate. sized: columns source and size."""
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = [F.col("source").isNull(), F.col("source")]
    sources = ranked(sources, by_name, {"rank_": F.lit(1)})
    sources = storage.table(sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank_") % len(weights) + 1).cast("int"))).drop("rank_"), "sources")
    cap = F.col("source_size") * F.lit(float(most))
    whole = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
    # Sources by the level at which they are full: the first that is not full at the level of those before it sets the level of all.
    full_at = F.when(F.col("weight") > 0, cap / F.nullif(F.col("weight"), F.lit(0.0))).otherwise(F.lit(float("inf")))
    filled = ranked(sources, [full_at, *by_name], {"full_": F.col("source_size"), "shut_": F.col("weight")})
    level = (F.lit(float(whole["n"])) - F.lit(float(most)) * F.col("full_").cast("double")) / F.nullif(F.lit(whole["w"]) - F.col("shut_"), F.lit(0.0))
    level = filled.where(full_at >= level).agg(F.min_by(level, F.struct(full_at, *by_name)).alias("level")).first()["level"]
    level = float("inf") if level is None else level
    target = F.least(F.col("weight") * F.lit(level), cap)
    return sources.select("source", "source_size", target.alias("target"), F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"))


def copies(rate: Column, doc_id: Column, seed: Column) -> Column:
    """Times that a document comes: the whole part of the rate, and a draw for the rest."""
    whole = F.floor(rate)
    return whole + F.when(draw(doc_id, seed) < rate - whole, 1).otherwise(0)


def plan(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 0) -> DataFrame:
    """Target, rate and seed of each source. sized: columns doc_id, source and size."""
    targets = storage.table(source_targets(sized, weights, most), "targets")
    of = targets.select(F.col("source").alias("of_"), "target", "rate")
    rows = sized.join(of, F.col("source").eqNullSafe(F.col("of_")))
    tries = [F.sum(copies(F.col("rate"), F.col("doc_id"), F.lit(seed + k)) * F.col("size")).alias(f"t{k}") for k in range(SEEDS)]
    taken = rows.groupBy("source", "target").agg(*tries)
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{k}").cast("double") - F.col("target")).alias("off"), F.lit(seed + k).alias("seed")) for k in range(SEEDS)]))
    taken = taken.select(F.col("source").alias("of_"), best["seed"].alias("seed"))
    return storage.table(targets.join(taken, F.col("source").eqNullSafe(F.col("of_"))).drop("of_"), "plan")


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, n_copies."""
    sized = _sized(docs, doc_id, text, source)
    targets = plan(sized, weights, most, seed).withColumnRenamed("source", "of_")
    out = sized.join(targets, F.col("source").eqNullSafe(F.col("of_")))
    return out.select("doc_id", "size", "source_size", "target", copies(F.col("rate"), F.col("doc_id"), F.col("seed")).cast("long").alias("n_copies"))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return storage.table(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")), "sizes")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 0) -> DataFrame:
    """The mixed corpus: rows of docs, each as often as the mix takes it."""
    rates = plan(_sized(docs, doc_id, text, source), weights, most, seed).select(F.col("source").alias("mix_source"), F.col("rate").alias("mix_rate"), F.col("seed").alias("mix_seed"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    held = dict(zip(docs.columns, names, strict=True))
    out = docs.toDF(*names).join(rates, F.col(held[source]).eqNullSafe(F.col("mix_source")))
    times = copies(F.col("mix_rate"), F.col(held[doc_id]), F.col("mix_seed")).cast("int")
    out = out.where(times > 0).select(*names, F.explode(F.sequence(F.lit(1), times)).alias("mix_copy"))
    return out.select(*names).toDF(*docs.columns)
