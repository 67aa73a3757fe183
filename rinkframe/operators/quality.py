"""Scores and issues of the quality of players, games and teams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core
from . import teams
from .league import League, goal_roles

KEY = ["season_id", "team_id", "player_id"]


def number_consistency(league: League) -> DataFrame:
    """Scorers who wore more than one number in a season: numbers, games and 1 / numbers."""
    worn = league.goals.where("scorer_id is not null").groupBy("season_id", F.col("scorer_id").alias("player_id"), F.col("scorer_number").alias("number"), "team_id").agg(F.countDistinct("game_id").alias("games"), F.count("*").alias("goals"))
    out = worn.groupBy("season_id", "player_id").agg(F.countDistinct("number").alias("n_numbers"), F.sum("games").alias("total_games"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "goals"))), lambda x: F.concat(x["number"].cast("string"), F.lit("("), x["goals"].cast("string"), F.lit("g)"))), ",").alias("details"))
    return out.where("n_numbers > 1").withColumn("score", F.round(1.0 / F.col("n_numbers"), 3))


def duplicate_numbers(league: League) -> DataFrame:
    """Numbers that more than one scorer of a team wore."""
    g = league.goals.where("scorer_id is not null")
    out = g.groupBy("season_id", "team_id", F.col("scorer_number").alias("number")).agg(F.countDistinct("scorer_id").alias("n_players"), F.array_join(F.array_sort(F.collect_set("scorer_id")), ",").alias("players"))
    return out.where("n_players > 1")


def player_confidence(league: League) -> DataFrame:
    """Half for one number, .3 for a name, .2 for a plausible total; assists are counted per player over all teams."""
    g = league.goals.where("scorer_id is not null")
    scored = g.groupBy("season_id", "team_id", F.col("scorer_id").alias("player_id")).agg(F.count("*").alias("goals"), F.countDistinct("game_id").alias("games"))
    assists = goal_roles(league.goals, twice=True).where("role = 'a'").groupBy("season_id", "player_id").agg(F.count("*").alias("assists"))
    numbers = g.groupBy("season_id", F.col("scorer_id").alias("player_id")).agg(F.countDistinct("scorer_number").alias("n_numbers"))
    out = scored.join(assists, ["season_id", "player_id"], "left").join(numbers, ["season_id", "player_id"], "left").fillna(0, ["assists"])
    pts = F.col("goals") + F.col("assists")
    consistent = 1.0 / F.greatest(F.col("n_numbers"), F.lit(1))
    named = ~core.blank(F.col("player_id"))
    plausible = (pts > 0) & (pts < 100)
    score = consistent * 0.5 + F.when(named, 0.3).otherwise(0.0) + F.when(plausible, 0.2).otherwise(0.1)
    flags = F.array_compact(F.array(F.when(F.col("n_numbers") > 1, F.lit("many_numbers")), F.when(~named, F.lit("no_name")), F.when(~plausible, F.lit("odd_total"))))
    return out.select(*KEY, "goals", "assists", "games", F.round(score, 3).alias("confidence"), F.array_join(flags, ",").alias("flags"))


def _goals_per_game(league: League) -> DataFrame:
    counts = league.goals.groupBy("season_id", "game_id").agg(F.count("*").alias("n_goals"))
    return league.games.where(core.final(F.col("status"))).join(counts, ["season_id", "game_id"], "left").fillna(0, ["n_goals"])


def game_issues(league: League, many: int = 20) -> DataFrame:
    """Final games without scores, without events, or with too many goals; the last rule that holds sets the severity."""
    g = _goals_per_game(league)
    missing = F.col("home_score").isNull() | F.col("visitor_score").isNull()
    total = F.coalesce(F.col("home_score") + F.col("visitor_score"), F.lit(0))
    no_box = ~missing & (total > 0) & (F.col("n_goals") == 0)
    high = total > many
    severity = F.when(high | no_box, "warning").when(missing, "critical")
    text = F.concat_ws(", ", F.when(missing, "missing_scores"), F.when(no_box, "box_score_missing"), F.when(high, F.concat(F.lit("high_total "), total.cast("string"))))
    return g.where(missing | no_box | high).select("season_id", "game_id", severity.alias("severity"), text.alias("description"))


def game_scores(league: League) -> DataFrame:
    """Scores .35, box score .30, plausibility .20 and metadata .15 of final games."""
    g = _goals_per_game(league)
    scored = F.col("home_score").isNotNull() & F.col("visitor_score").isNotNull()
    total = F.coalesce(F.col("home_score") + F.col("visitor_score"), F.lit(0))
    box = F.when(F.col("n_goals") == total, 1.0).when(F.col("n_goals") > 0, 0.7).otherwise(0.3)
    sane = F.when(total > 20, 0.5).when(total > 15, 0.8).otherwise(1.0)
    meta = F.lit(1.0) - F.when(F.col("game_date").isNull(), 0.3).otherwise(0.0) - F.when(F.col("home_id").isNull() | F.col("visitor_id").isNull(), 0.4).otherwise(0.0)
    score = F.when(scored, 0.35).otherwise(0.0) + box * 0.30 + sane * 0.20 + meta * 0.15
    return g.select("season_id", "game_id", "n_goals", F.round(score, 3).alias("score"))


def team_scores(league: League) -> DataFrame:
    """Record .40, roster .40 and statistics .20 of teams."""
    r = teams.record(league)
    sizes = league.goals.where("scorer_id is not null").groupBy("season_id", "team_id").agg(F.countDistinct("scorer_id").alias("n_players"))
    r = r.join(sizes, ["season_id", "team_id"], "left").fillna(0, ["n_players"])
    record = F.when(F.col("gp") == 0, 0.0).when(F.col("w") + F.col("l") + F.col("t") != F.col("gp"), 0.7).otherwise(1.0)
    n = F.col("n_players")
    roster = F.when(n == 0, 0.0).when(n < 8, 0.5).when(n > 25, 0.6).otherwise(1.0)
    stats = F.when((F.col("gpg") > 15) | (F.col("gapg") > 15), 0.5).otherwise(1.0)
    return r.select("season_id", "team_id", "gp", "n_players", F.round(record * 0.4 + roster * 0.4 + stats * 0.2, 3).alias("score"))


def missing_data(league: League) -> DataFrame:
    """Counts and percentages of rows without a needed value, one row a table."""
    final = core.final(F.col("status"))
    parts = [
        (league.games.where(final), F.col("home_score").isNull() | F.col("visitor_score").isNull(), "games"),
        (league.goals, core.blank(F.col("scorer_id")), "goals"),
        (league.penalties, core.blank(F.col("player_id")), "penalties"),
    ]
    out = None
    for df, bad, name in parts:
        n, m = F.count("*"), F.count_if(bad)
        row = df.agg(F.lit(name).alias("entity"), n.alias("total"), m.alias("missing"), F.round(m * 100.0 / F.greatest(n, F.lit(1)), 1).alias("percentage"))
        out = row if out is None else out.unionByName(row)
    return out


def overall(league: League, low: float = 0.7) -> DataFrame:
    """One number: 1 less capped shares for each kind of issue."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    parts = count(number_consistency(league), "inconsistent").select("inconsistent", F.lit(0).alias("low"), F.lit(0).alias("critical"), F.lit(0).alias("holes"))
    for df, name in ((player_confidence(league).where(F.col("confidence") < low), "low"), (game_issues(league).where("severity = 'critical'"), "critical"), (missing_data(league).where("percentage > 50"), "holes")):
        parts = parts.unionByName(count(df, name), allowMissingColumns=True)
    s = parts.agg(*[F.sum(c).alias(c) for c in ("inconsistent", "low", "critical", "holes")])
    off = F.least(F.lit(0.2), F.col("inconsistent") * 0.01) + F.least(F.lit(0.2), F.col("low") * 0.005) + F.least(F.lit(0.3), F.col("critical") * 0.02) + F.col("holes") * 0.1
    return s.withColumn("score", F.round(F.greatest(F.lit(0.0), 1.0 - off), 3))


def issues(league: League) -> DataFrame:
    """All issues in one shape with their impact."""
    a = number_consistency(league).select(F.lit("player").alias("entity"), F.col("player_id").alias("id"), F.lit("number_inconsistency").alias("issue"), (1 - F.col("score")).alias("impact"))
    b = game_issues(league).select(F.lit("game").alias("entity"), F.col("game_id").cast("string").alias("id"), F.col("description").alias("issue"), F.when(F.col("severity") == "critical", 0.5).otherwise(0.2).alias("impact"))
    c = duplicate_numbers(league).select(F.lit("team").alias("entity"), F.concat_ws("_", "team_id", "number").alias("id"), F.lit("duplicate_number").alias("issue"), F.lit(0.3).alias("impact"))
    band = F.when(F.col("impact") > 0.5, "critical").when(F.col("impact") >= 0.2, "warning").otherwise("info")
    return a.unionByName(b).unionByName(c).withColumn("band", band)


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of children without a parent; an anti join, so nulls are orphans too."""
    return children.join(parents.select(F.col(parent_key).alias("parent_")).distinct(), F.col(child_key) == F.col("parent_"), "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    return out
