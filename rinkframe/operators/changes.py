"""Snapshots: merges, change reports, upserts and work lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import core


def merge_snapshots(previous: DataFrame, new: DataFrame, key: str, watched: list[str]) -> DataFrame:
    """Previous and new rows by key with change_type: new, updated, unchanged or kept.

    A row is updated where a watched column gains a value or changes; then, and only
    then, the new row wins.
    """
    cols = previous.columns
    p, n = previous.withColumn("was_", F.lit(True)).alias("p"), new.withColumn("is_", F.lit(True)).alias("n")
    both = p.join(n, F.col(f"p.{key}") == F.col(f"n.{key}"), "full_outer")
    moved = F.lit(False)
    for c in watched:
        moved = moved | (F.col(f"n.{c}").isNotNull() & ~F.col(f"n.{c}").eqNullSafe(F.col(f"p.{c}")))
    kind = F.when(F.col("was_").isNull(), "new").when(F.col("is_").isNull(), "kept").when(moved, "updated").otherwise("unchanged")
    wins = F.col("was_").isNull() | (F.col("is_").isNotNull() & moved)
    return both.select(*[F.when(wins, F.col(f"n.{c}")).otherwise(F.col(f"p.{c}")).alias(c) for c in cols], kind.alias("change_type"))


def change_report(merged: DataFrame) -> DataFrame:
    return merged.groupBy("change_type").agg(F.count("*").alias("n"))


def last_wins(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row a key, the last by order."""
    return rows.withColumn("nth_", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where("nth_ = 1").drop("nth_")


def upsert(old: DataFrame, new: DataFrame, key: list[str], preserve: bool = True, null_safe: bool = False) -> DataFrame:
    """New values over old ones by key; where `preserve`, a null does not overwrite; where `null_safe`, nulls of keys are equal."""
    rest = [c for c in old.columns if c not in key]
    o = old.select(*key, *[F.col(c).alias(f"o_{c}") for c in rest], F.lit(True).alias("o_"))
    n = new.select(*key, *[F.col(c).alias(f"n_{c}") for c in rest], F.lit(True).alias("n_"))
    if null_safe:
        n = n.withColumnsRenamed({c: f"k_{c}" for c in key})
        same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in key]
        both = o.join(n, same, "full_outer").withColumns({c: F.coalesce(c, f"k_{c}") for c in key})
    else:
        both = o.join(n, key, "full_outer")
    pick = lambda c: F.coalesce(f"n_{c}", f"o_{c}") if preserve else F.when(F.col("n_"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}"))
    return both.select(*key, *[pick(c).alias(c) for c in rest])


def insert_or_ignore(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new join only under keys that old lacks."""
    return old.unionByName(new.dropDuplicates(key).join(old.select(*key), key, "left_anti"))


def fill_blanks(rows: DataFrame, lookup: DataFrame, key: str, column: str) -> DataFrame:
    """Fill blank texts of a column from a lookup; of several entries for a key the smallest."""
    best = lookup.where(~core.blank(F.col(column))).groupBy(key).agg(F.min(column).alias("fill_"))
    return rows.join(best, key, "left").withColumn(column, F.when(core.blank(F.col(column)), F.coalesce("fill_", column)).otherwise(F.col(column))).drop("fill_")


def update_from(rows: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with columns set from values where their key is there, else as they were; of several values for a key the greatest."""
    best = values.groupBy(key).agg(F.max(F.struct(*columns)).alias("set_"))
    out = rows.join(best, key, "left")
    return out.withColumns({c: F.when(F.col("set_").isNotNull(), F.col(f"set_.{c}")).otherwise(F.col(c)) for c in columns}).select(*rows.columns)


def schedule_state(games: DataFrame, as_of) -> DataFrame:
    """Counts by state, and games of the day and the day after."""
    day = F.to_date(F.lit(as_of))
    return games.agg(F.count("*").alias("total"), F.count_if(core.final(F.col("status"))).alias("finals"), F.count_if(F.lower("status") == "scheduled").alias("scheduled"), F.count_if(F.col("game_date") == day).alias("today"), F.count_if(F.col("game_date") == F.date_add(day, 1)).alias("tomorrow"))


def needing_box_scores(games: DataFrame, goals: DataFrame) -> DataFrame:
    """Final games without a goal event."""
    return games.where(core.final(F.col("status"))).join(goals.select("game_id"), "game_id", "left_anti")


def upsert_games(old: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or update games by game_id, or where it is blank by (team, date, opponent).

    Both tables have the columns game_id, team, date, opponent and others; of new rows under
    one key the greatest row counts.
    """
    fallback = F.to_json(F.struct("team", F.col("date").cast("string").alias("date"), "opponent"), {"ignoreNullFields": "false"})
    keyed = lambda d: d.withColumn("key_", F.when(core.blank(F.col("game_id")), F.concat(F.lit("g"), fallback)).otherwise(F.concat(F.lit("i"), F.trim("game_id"))))
    rows = last_wins(keyed(new), ["key_"], [F.desc_nulls_last(c) for c in new.columns])
    return upsert(keyed(old), rows, ["key_"]).select(*old.columns)


def schedule_changes(before: DataFrame, after: DataFrame, as_of) -> DataFrame:
    """New games, changes of the number of finals, and their sum, between two states of a schedule."""
    b, a = (schedule_state(d, as_of).select(F.struct("total", "finals").alias(n)) for d, n in ((before, "b"), (after, "a")))
    new, moved = F.col("a.total") - F.col("b.total"), F.abs(F.col("a.finals") - F.col("b.finals"))
    # One row each.
    return b.crossJoin(a).select(new.alias("new_games"), moved.alias("status_changes"), (new + moved).alias("updated"))


def keep_first(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key; rows with a blank key all stay."""
    named = ~core.blank(F.col(key))
    first = last_wins(rows.where(named), [key], order)
    return first.unionByName(rows.where(~named))


def replace_season(df: DataFrame, path: str) -> None:
    """Write only the seasons in df, leaving the others in place."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("season_id").parquet(path)
