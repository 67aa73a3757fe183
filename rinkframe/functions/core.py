"""Expressions on scores, ratios, ranks and clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column, scale: float = 1.0) -> Column:
    """top / bottom, 0 where bottom is 0."""
    return F.coalesce(top.cast("double") * F.lit(scale) / F.nullif(bottom.cast("double"), F.lit(0.0)), F.lit(0.0))


def result(own: Column, other: Column) -> Column:
    return F.when(own > other, "W").when(own < other, "L").otherwise("T")


def points(own: Column, other: Column) -> Column:
    return F.when(own > other, 2).when(own == other, 1).otherwise(0)


def record(w: Column, losses: Column, t: Column) -> Column:
    return F.concat_ws("-", w.cast("string"), losses.cast("string"), t.cast("string"))


def ordinal_suffix(n: Column) -> Column:
    """st, nd, rd or th; 10 to 20 take th."""
    last = F.pmod(n, F.lit(10))
    return F.when(F.pmod(n, F.lit(100)).between(10, 20), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")


def percentile(rank: Column, total: Column) -> Column:
    """Percentage of entries at or below a rank; 0 without entries."""
    return F.when(total == 0, F.lit(0.0)).otherwise((total - rank + 1).cast("double") / total.cast("double") * 100)


# Bands of a percentile and their words.
BANDS = [(90, "Elite - Top 10%"), (75, "Above Average - Top 25%"), (50, "Average - Top 50%"), (25, "Below Average - Bottom 50%")]


def interpret(p: Column) -> Column:
    """The band of a percentile in words."""
    out = F
    for least, words in BANDS:
        out = out.when(p >= least, words)
    return out.otherwise("Poor - Bottom 25%")


def in_context(value: Column, rank: Column, total: Column) -> Column:
    """A statistic with its rank, suffix, percentile and reading."""
    p = percentile(rank, total)
    return F.struct(value.cast("double").alias("value"), rank.alias("rank"), ordinal_suffix(rank).alias("suffix"), p.alias("percentile"), interpret(p).alias("reading"))


def period_number(label: Column) -> Column:
    """1 to 3 for periods, 4 for overtime, else 0."""
    x = F.lower(label)
    has = lambda *names: F.greatest(*[F.coalesce(x.contains(n), F.lit(False)) for n in names]) if len(names) > 1 else F.coalesce(x.contains(names[0]), F.lit(False))
    return F.when(has("1st", "first"), 1).when(has("2nd", "second"), 2).when(has("3rd", "third"), 3).when(has("ot", "overtime"), 4).otherwise(0)


def game_seconds(period: Column, clock: Column, length: int = 780) -> Column:
    """Elapsed seconds from the clock MM:SS that counts down; null for a malformed clock or no period."""
    m, s = F.regexp_extract(clock, "^(\\d+):(\\d+)$", 1), F.regexp_extract(clock, "^(\\d+):(\\d+)$", 2)
    left = m.try_cast("int") * 60 + s.try_cast("int")
    return F.when(period > 0, (period - 1) * length + length - left)


def final(status: Column) -> Column:
    return F.lower(status).isin("final", "complete")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def leading_int(c: Column) -> Column:
    """The whole number that a text begins with, else 0."""
    return F.coalesce(F.regexp_extract(c, "^\\s*([+-]?[0-9]+)", 1).try_cast("int"), F.lit(0))


def game_day(ts: Column) -> Column:
    """Whether games are likely on: Friday from 17:00, weekends, other evenings 18:00 to 21:00."""
    day, at = F.weekday(ts), F.date_format(ts, "HH:mm:ss")
    return (day >= 5) | ((day == 4) & (at >= "17:00:00")) | ((day < 4) & at.between("18:00:00", "21:00:00"))


def refresh_minutes(ts: Column) -> Column:
    return F.when(game_day(ts), 15).otherwise(240)
