"""Monitoring scores of players, unresolved and new issues, and the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import core

#: Weights of the parts of a player's score. Fixed values.
WEIGHTS = {"number": 0.30, "name": 0.20, "completeness": 0.20, "reasonable": 0.25, "penalties": 0.05}


def player_scores(players: DataFrame) -> DataFrame:
    """Score and recommendations. players: player_id, name, n_numbers, gp, g, a, pim and any key columns."""
    pts, gp = F.col("g") + F.col("a"), F.col("gp")
    number = 1.0 / F.greatest(F.col("n_numbers"), F.lit(1))
    named = ~core.blank(F.col("name"))
    complete = F.when(gp == 0, 0.0).when(pts == 0, 0.5).otherwise(1.0)
    rate = core.ratio(pts, gp)
    sane = F.when(pts > 100, 0.3).when(pts > 50, 0.7).otherwise(1.0)
    sane = F.when(rate > 10, F.least(sane, F.lit(0.2))).otherwise(sane)
    fouls = F.when(F.col("pim") > 100, 0.5).otherwise(1.0)
    score = number * WEIGHTS["number"] + named.cast("double") * WEIGHTS["name"] + complete * WEIGHTS["completeness"] + sane * WEIGHTS["reasonable"] + fouls * WEIGHTS["penalties"]
    advice = F.array_compact(F.array(F.when(F.col("n_numbers") > 1, F.lit("check numbers")), F.when(~named, F.lit("add name")), F.when(complete < 1, F.lit("complete statistics")), F.when(sane < 1, F.lit("review totals")), F.when(fouls < 1, F.lit("review penalties"))))
    return players.withColumn("score", F.round(score, 3)).withColumn("recommendations", advice)


def basic_scores(players: DataFrame) -> DataFrame:
    """The score without events: .4 number, .3 name, .2 games, .1 points. players: number, name, gp, pts."""
    part = lambda c, w: F.when(c, w).otherwise(0.0)
    score = part(F.col("number").isNotNull(), 0.4) + part(~core.blank(F.col("name")), 0.3) + part(F.col("gp") > 0, 0.2) + part(F.col("pts") > 0, 0.1)
    return players.withColumn("score", F.round(score, 3))


def basic_confidence(players: DataFrame) -> DataFrame:
    """Half for a number, .3 for a name, .2 for a plausible total, else .1. players: number, name, pts."""
    score = F.when(F.col("number").isNotNull(), 0.5).otherwise(0.0) + F.when(~core.blank(F.col("name")), 0.3).otherwise(0.0) + F.when((F.col("pts") > 0) & (F.col("pts") < 100), 0.2).otherwise(0.1)
    return players.withColumn("confidence", F.round(score, 3))


def severity(impact: Column) -> Column:
    return F.when(impact > 0.5, "critical").when(impact >= 0.2, "warning").otherwise("info")


def unresolved(issues: DataFrame, level: str | None = None) -> DataFrame:
    """Issues that nobody has resolved, of one severity or all. issues: resolved_at, impact."""
    out = issues.where(F.col("resolved_at").isNull()).withColumn("severity", severity(F.col("impact")))
    return out if level is None else out.where(F.col("severity") == level)


def resolve_issue(issues: DataFrame, issue_id, by: str, notes: str, as_of) -> DataFrame:
    """The issues with one marked as resolved."""
    hit = F.col("issue_id") == issue_id
    return issues.withColumns({"resolved_at": F.when(hit, F.lit(as_of).cast("timestamp")).otherwise(F.col("resolved_at")), "resolved_by": F.when(hit, F.lit(by)).otherwise(F.col("resolved_by")), "notes": F.when(hit, F.lit(notes)).otherwise(F.col("notes"))})


def new_issues(issues: DataFrame, log: DataFrame) -> DataFrame:
    """Issues created after the last run in the log; before a first run there are none."""
    return issues.where(F.col("created_at") > log.agg(F.max("run_at")).scalar())


def histogram(scores: DataFrame) -> DataFrame:
    """Scores by band: poor under .5, fair under .8, good."""
    band = F.when(F.col("score") < 0.5, "poor").when(F.col("score") < 0.8, "fair").otherwise("good")
    return scores.groupBy(band.alias("band")).agg(F.count("*").alias("n"))


def top_recommendations(scores: DataFrame, below: float = 0.7, limit: int = 10) -> DataFrame:
    """The most frequent recommendations of low scores."""
    return scores.where(F.col("score") < below).select(F.explode("recommendations").alias("recommendation")).groupBy("recommendation").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "recommendation").limit(limit)


def report(players: DataFrame, games: DataFrame, teams: DataFrame) -> DataFrame:
    """Average score of each kind, 0 without any, and their mean. Each has a column score."""
    mean = lambda df, name: df.agg(F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 3).alias(name), F.coalesce(F.avg("score"), F.lit(0.0)).alias(f"{name}_"))
    parts = [mean(players, "player_average"), mean(games, "game_average"), mean(teams, "team_average")]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    out = out.agg(*[F.max(c).alias(c) for c in out.columns])
    return out.select("player_average", "game_average", "team_average", F.round((F.col("player_average_") + F.col("game_average_") + F.col("team_average_")) / 3, 3).alias("overall"))
