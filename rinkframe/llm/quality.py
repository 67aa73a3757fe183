"""Quality rules and robust multivariate outliers, with DataFrame operations only.

Rules on counts come first. Of the rows that pass them, statistics are transformed and
their minimum-covariance-determinant estimate is fitted per language and source by
concentration steps: a step sums the statistics by bucket of Mahalanobis distance, and
the buckets nearest to the centre that hold `share` of the rows give the next mean and
covariance. Steps run from three fixed starts about the medians at once, and the smallest
determinant is the estimate. Rows far from the centre of their group are rejected. A group of fewer than
`least` rows is judged by its language's estimate, or by that of all rows.

Sums are of integers, so that repeated runs agree bit by bit. A variance never counts
as less than its floor, below which differences mean nothing.

Defined cases: a null text has no words and fails the rules; null languages and sources
are groups of their own; equal rows get equal verdicts; without any row that passes the
rules nothing is estimated; an empty table gives an empty result; other columns pass
through `keep` unchanged, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import storage
from .words import SPACES_PATTERN, set_aside, squeeze, words

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Words in a window, bits of a position in a packed number, and units of a statistic.
WINDOW, PLACE_BITS, UNIT = 3, 21, 4096

#: Floors of the standard deviations: of the logarithm of the mean word length, and of
#: the angles arcsin(sqrt(share)) for symbols, repeated lines and repeated words.
FLOORS = (0.1, 0.05, 0.2, 0.2)
SHARE, TAIL, LEAST, STEPS = 0.75, 1e-5, 100, 20
#: A step that changes no logarithm of a determinant by more is the last.
SETTLED = 1e-3


def _covered(places: Column) -> Column:
    """Words covered by windows that begin at sorted, distinct places."""
    n = F.size(places)
    gaps = F.zip_with(F.slice(places, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(places, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.least(b - a, F.lit(WINDOW).cast("long")))
    return F.when(n == 0, F.lit(0).cast("long")).otherwise(F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda s, x: s + x))


def _pairs(ordered: Column, both) -> Column:
    """Sorted, distinct places of neighbours in an ordered array that `both` gives a pair for."""
    n = F.greatest(F.size(ordered) - 1, F.lit(0))
    found = F.zip_with(F.slice(ordered, F.lit(1), n), F.slice(ordered, F.lit(2), n), both)
    return F.sort_array(F.array_distinct(F.flatten(F.filter(found, lambda x: x.isNotNull()))))


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    d = docs.withColumn("t_", F.coalesce(F.col(text), F.lit(""))).withColumn("w_", words(F.col("t_"))).withColumn("n_", F.size("w_"))
    w, n = F.col("w_"), F.col("n_")
    low = (1 << PLACE_BITS) - 1
    windows = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    packed = F.transform(windows, lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    d = d.withColumn("p_", F.when(n <= low, F.sort_array(packed)))
    top, at = lambda x: F.shiftright(x, PLACE_BITS), lambda x: x.bitwiseAND(F.lit(low)).cast("int")

    def same(a: Column, b: Column) -> Column:
        i, j = at(a), at(b)
        return (w[i] == w[j]) & (w[i + 1] == w[j + 1]) & (w[i + 2] == w[j + 2])

    # Equal hashes of unequal windows lead to the slower way, which sorts the windows themselves.
    clash = F.exists(F.zip_with("p_", F.slice("p_", F.lit(2), F.greatest(F.size("p_"), F.lit(1))), lambda a, b: F.coalesce((top(a) == top(b)) & ~same(a, b), F.lit(False))), lambda x: x)
    quick = _pairs(F.col("p_"), lambda a, b: F.when(top(a) == top(b), F.array(at(a).cast("long"), at(b).cast("long"))))
    spelled = F.sort_array(F.transform(windows, lambda i: F.struct(F.array(w[i], w[i + 1], w[i + 2]).alias("s"), i.cast("long").alias("i"))))
    slow = _pairs(spelled, lambda a, b: F.when(a["s"] == b["s"], F.array(a["i"], b["i"])))
    places = F.when(F.col("p_").isNull() | clash, slow).otherwise(quick)
    lines = F.filter(F.split("t_", "\n"), lambda x: F.regexp_replace(x, SPACES_PATTERN, "") != "")
    d = d.withColumn("d_", places).withColumn("l_", lines)
    return d.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.char_length(squeeze(F.col("t_"))).cast("long").alias("word_chars"),
        (F.char_length("t_") - F.char_length(F.translate("t_", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("l_").cast("long").alias("n_lines"),
        (F.size("l_") - F.size(F.array_distinct("l_"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("d_")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    """The transformed statistics, in whole units."""
    share = lambda a, b: F.asin(F.sqrt(F.least(F.col(a) / F.greatest(F.col(b), F.lit(1)), F.lit(1.0))))
    parts = [F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    return [F.round(x * UNIT).cast("long") for x in parts]


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return high


KEY = ["level", "g_lang", "g_source"]
#: A chain of concentration steps: a group and its start.
RUN = [*KEY, "start"]
N = len(FLOORS)
X = [f"x{i}" for i in range(N)]
PAIRS = [(i, j) for i in range(N) for j in range(i + 1)]


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. under mean m* and Cholesky factor c*."""
    z: list[Column] = []
    for i in range(N):
        rest = reduce(lambda a, b: a - b, [F.col(f"c{i}{j}") * z[j] for j in range(i)], F.col(X[i]) / UNIT - F.col(f"m{i}"))
        z.append(rest / F.col(f"c{i}{i}"))
    return reduce(lambda a, b: a + b, [x * x for x in z])


def _factor(params: DataFrame, key: list[str]) -> DataFrame:
    """Cholesky factor c* of covariance columns s* with the floors added, and the logarithm of the determinant."""
    for i in range(N):
        for j in range(i + 1):
            s = F.col(f"s{i}{j}") + F.lit(FLOORS[i] ** 2 if i == j else 0.0)
            s = reduce(lambda a, b: a - b, [F.col(f"c{i}{k}") * F.col(f"c{j}{k}") for k in range(j)], s)
            # Rounding must not make a pivot fall below its floor.
            params = params.withColumn(f"c{i}{j}", F.sqrt(F.greatest(s, F.lit(FLOORS[i] ** 2))) if i == j else s / F.col(f"c{j}{j}"))
    det = reduce(lambda a, b: a + b, [F.log(f"c{i}{i}") for i in range(N)])
    return params.select(*key, "n", *[f"m{i}" for i in range(N)], *[f"c{i}{j}" for i, j in PAIRS], det.alias("log_det"))


def _moments(sums: DataFrame, scale: float) -> DataFrame:
    """Mean and scaled covariance of each group from counts and sums."""
    k = F.col("k").cast("double")
    out = sums.withColumns({f"m{i}": F.col(f"a{i}").cast("double") / k / UNIT for i in range(N)})
    exact = lambda i, j: (F.col(f"b{i}{j}").cast("double") / k - (F.col(f"a{i}").cast("double") / k) * (F.col(f"a{j}").cast("double") / k)) / UNIT**2
    return _factor(out.withColumns({f"s{i}{j}": exact(i, j) * scale for i, j in PAIRS}), RUN)


def _starts(spread: DataFrame, scales: DataFrame) -> DataFrame:
    """First estimates of each group: medians, and median deviations with three correlations.

    These are none, that of the statistics' hyperbolic tangents, and that of their directions
    from the medians. scales: n, q* (medians) and d* (deviations) of each group.
    """
    z = [(F.col(X[i]) - F.col(f"q{i}")) / F.greatest(F.col(f"d{i}") * 1.4826, F.lit(FLOORS[i] * UNIT)) for i in range(N)]
    length = F.sqrt(reduce(lambda a, b: a + b, [x * x for x in z]))
    rows = _by_group(spread, scales).withColumns({f"t{i}": F.tanh(z[i]) for i in range(N)} | {f"u{i}": F.coalesce(z[i] / F.nullif(length, F.lit(0.0)), F.lit(0.0)) for i in range(N)})
    whole = lambda x: F.sum(F.round(x * UNIT**2).cast("long").cast("decimal(19,0)")).cast("double")
    sums = rows.groupBy(*KEY).agg(*[F.first(c).alias(c) for c in scales.columns if c not in KEY], *[whole(F.col(f"{k}{i}") * F.col(f"{k}{j}")).alias(f"{k}{i}{j}") for k in "tu" for i, j in PAIRS])
    deviation = [F.col(f"d{i}") * 1.4826 / UNIT for i in range(N)]

    def covariance(kind: str | None, i: int, j: int) -> Column:
        if i == j:
            return F.pow(deviation[i], 2)
        if kind is None:
            return F.lit(0.0)
        both = F.sqrt(F.col(f"{kind}{i}{i}") * F.col(f"{kind}{j}{j}"))
        return F.coalesce(F.col(f"{kind}{i}{j}") / F.nullif(both, F.lit(0.0)), F.lit(0.0)) * deviation[i] * deviation[j]

    each = [F.struct(F.lit(k).alias("start"), *[covariance(kind, i, j).alias(f"s{i}{j}") for i, j in PAIRS]) for k, kind in enumerate([None, "t", "u"])]
    means = [(F.col(f"q{i}") / UNIT).alias(f"m{i}") for i in range(N)]
    return _factor(sums.select(*KEY, "n", *means, F.explode(F.array(*each)).alias("s")).select(*KEY, "n", *[f"m{i}" for i in range(N)], "s.*"), RUN)


def estimate(points: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimates of all groups: n, mean m*, factor c*.

    points: columns g_lang, g_source and x0.. of whole units.
    """
    levels = F.array(
        F.struct(F.lit(0).alias("level"), "g_lang", "g_source"),
        F.struct(F.lit(1).alias("level"), "g_lang", F.lit(None).cast("string").alias("g_source")),
        F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("g_lang"), F.lit(None).cast("string").alias("g_source")),
    )
    spread = points.select(F.explode(levels).alias("g"), *X).select("g.*", *X)
    middle = [F.percentile_approx(x, F.lit(0.5), F.lit(10000)).alias(f"q{i}") for i, x in enumerate(X)]
    centre = storage.table(spread.groupBy(*KEY).agg(F.count("*").alias("n"), *middle), "medians")
    off = [F.percentile_approx(F.abs(F.col(x) - F.col(f"q{i}")), F.lit(0.5), F.lit(10000)).alias(f"d{i}") for i, x in enumerate(X)]
    scales = _by_group(spread, centre).groupBy(*KEY).agg(F.first("n").alias("n"), *[F.first(f"q{i}").alias(f"q{i}") for i in range(N)], *off)
    params = storage.table(_starts(spread, storage.table(scales, "scales")), "start")
    scale = share / chi_square(chi_square_quantile(share, N), N + 2)
    whole = lambda x: F.sum(x.cast("decimal(19,0)"))
    sums = [whole(F.col(X[i])).alias(f"a{i}") for i in range(N)] + [whole(F.col(X[i]) * F.col(X[j])).alias(f"b{i}{j}") for i, j in PAIRS]
    for _ in range(steps):
        bucket = F.floor(F.log(_distance() + 1e-3) * 64).cast("int")
        near = _by_group(spread, params).withColumn("bucket", bucket).groupBy(*RUN, "bucket").agg(F.count("*").alias("k"), *sums)
        # A window over the buckets of a run, of which there are a few thousand at most.
        inner = W.partitionBy(*RUN).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        all_ = W.partitionBy(*RUN)
        near = near.withColumn("n", F.sum("k").over(all_)).withColumn("before", F.coalesce(F.sum("k").over(inner), F.lit(0)))
        near = near.where(F.col("before") < F.ceil(F.col("n") * share))
        near = near.groupBy(*RUN).agg(F.first("n").alias("n"), F.sum("k").alias("k"), *[F.sum(f"a{i}").alias(f"a{i}") for i in range(N)], *[F.sum(f"b{i}{j}").alias(f"b{i}{j}") for i, j in PAIRS])
        new = storage.table(_moments(near, scale), "step")
        old = params.select(*[F.col(k).alias(f"o_{k}") for k in RUN], F.col("log_det").alias("o_det"))
        moved = _on(new, old, "o_").where(F.col("start") == F.col("o_start")).where(F.abs(F.col("log_det") - F.col("o_det")) > SETTLED).limit(1).count()
        params = new
        if not moved:
            break
    # Of starts that settle alike, the first.
    least = F.min_by(F.struct(*[c for c in params.columns if c not in RUN]), F.struct(F.round("log_det", 6), "start"))
    return storage.table(params.groupBy(*KEY).agg(least.alias("p")).select(*KEY, "p.*"), "least")


def _on(left: DataFrame, right: DataFrame, prefix: str, how: str = "inner") -> DataFrame:
    return left.join(right, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in KEY]), how)


def _by_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    right = groups.select(*[F.col(k).alias(f"j_{k}") for k in KEY], *[c for c in groups.columns if c not in KEY])
    return _on(rows, right, "j_").drop(*[f"j_{k}" for k in KEY])


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", share: float = SHARE, tail: float = TAIL, least: int = LEAST, more: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed, kept and distance.

    tail: share of well-formed rows that a cut at this distance would reject. more: further columns to carry.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("g_lang"), F.col(source).cast("string").alias("g_source"), F.col(text).alias("text"), *[c.alias(k) for k, c in (more or {}).items()])
    d = with_counts(d, "text").drop("text")
    d = storage.table(d.withColumn("base_failed", base_failed()).withColumns(dict(zip(X, _vector(), strict=True))), "counts")
    params = estimate(d.where(~F.col("base_failed")).select("g_lang", "g_source", *X), share)
    # Each group takes its own estimate, its language's, or that of all.
    own = d.select("g_lang", "g_source").distinct()
    bands = [(0, F.col("g_lang"), F.col("g_source")), (1, F.col("g_lang"), F.lit(None).cast("string")), (2, F.lit(None).cast("string"), F.lit(None).cast("string"))]
    wide = own.select(F.col("g_lang").alias("p_lang"), F.col("g_source").alias("p_source"), F.explode(F.array(*[F.struct(F.lit(k).alias("level"), a.alias("g_lang"), b.alias("g_source")) for k, a, b in bands])).alias("g")).select("p_lang", "p_source", "g.*")
    usable = _by_group(wide, params).where((F.col("n") >= least) | (F.col("level") == 2))
    best = usable.groupBy("p_lang", "p_source").agg(F.min_by(F.struct(*[c for c in params.columns if c not in KEY]), "level").alias("b")).select("p_lang", "p_source", "b.*")
    best = storage.table(best, "estimates")
    out = d.join(best, F.col("g_lang").eqNullSafe(F.col("p_lang")) & F.col("g_source").eqNullSafe(F.col("p_source")), "left")
    distance = _distance()
    cut = chi_square_quantile(1 - tail, N)
    return out.select("doc_id", F.col("g_lang").alias("lang"), F.col("g_source").alias("source"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.coalesce(distance <= cut, F.lit(True))).alias("kept"), distance.alias("distance"), *(more or {}))


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", **options) -> DataFrame:
    """The rows of docs that pass, with all their columns."""
    found = verdicts(docs, doc_id, text, lang, source, more={"text_hash": F.xxhash64(F.col(text))}, **options)
    gone = storage.table(found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("lang").alias("gone_lang"), F.col("source").alias("gone_source"), F.col("text_hash").alias("gone_hash")).distinct(), "rejected")
    d, (i, l, o, t) = set_aside(docs, doc_id, lang, source, text)
    same = F.col(i).eqNullSafe(F.col("gone_id")) & F.col(l).cast("string").eqNullSafe(F.col("gone_lang")) & F.col(o).cast("string").eqNullSafe(F.col("gone_source")) & (F.xxhash64(F.col(t)) == F.col("gone_hash"))
    return d.join(gone, same, "left_anti").toDF(*docs.columns)
