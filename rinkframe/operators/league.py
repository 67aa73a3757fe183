"""The canonical tables of a league, and team games, their building block."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import core


@dataclass(frozen=True)
class League:
    """Tables of all seasons; every one has season_id.

    teams: season_id, team_id, team_name, division_id. games: season_id, game_id,
    game_date, home_id, visitor_id, home_score, visitor_score, status. goals: season_id,
    game_id, team_id, period, scorer_id, scorer_number, assist1_id, assist2_id, pp, sh,
    gw, en. penalties: season_id, game_id, team_id, player_id, player_number, minutes.
    """

    teams: DataFrame
    games: DataFrame
    goals: DataFrame
    penalties: DataFrame

    def season(self, season_id: int | None) -> League:
        """The tables of one season, or all of them."""
        if season_id is None:
            return self
        cut = lambda df: df.where(F.col("season_id") == season_id)
        return League(cut(self.teams), cut(self.games), cut(self.goals), cut(self.penalties))


def team_games(games: DataFrame, scored: bool = True, finals: bool = True) -> DataFrame:
    """Two rows a game, one for each side, instead of a join on either side."""
    g = games.where(core.final(F.col("status"))) if finals else games
    if scored:
        g = g.where(F.col("home_score").isNotNull() & F.col("visitor_score").isNotNull())
    side = lambda own, other, home: F.struct(F.col(f"{own}_id").alias("team_id"), F.col(f"{other}_id").alias("opponent_id"), F.col(f"{own}_score").alias("own"), F.col(f"{other}_score").alias("other"), F.lit(home).alias("is_home"))
    return g.select("season_id", "game_id", "game_date", "status", F.inline(F.array(side("home", "visitor", True), side("visitor", "home", False))))


def goal_roles(goals: DataFrame, twice: bool = False) -> DataFrame:
    """One row for each player on a goal: role g or a. An assist listed twice counts once unless `twice`."""
    assists = F.array_compact(F.array("assist1_id", "assist2_id"))
    if not twice:
        assists = F.array_distinct(assists)
    roles = F.concat(F.array(F.struct(F.col("scorer_id").alias("player_id"), F.lit("g").alias("role"))), F.transform(assists, lambda a: F.struct(a.alias("player_id"), F.lit("a").alias("role"))))
    return goals.select("season_id", "game_id", "team_id", "pp", "sh", "gw", "en", F.inline(roles)).where("player_id is not null")


def teams_with_games(league: League) -> DataFrame:
    """Teams that are a side of some game of their season."""
    played = league.games.select("season_id", F.explode(F.array("home_id", "visitor_id")).alias("team_id"))
    return league.teams.join(played, ["season_id", "team_id"], "left_semi")
