"""Analytic questions over the canonical tables, as SQL that Spark and the comparison engine both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators import players, teams
from ..sources import pseudo

#: Questions by name; one of them takes other points for a part of the made season, in which otherwise nobody would be found. Tables: games, teams, goals, penalties, record (one row a team), players.
QUESTIONS = {
    "top_scorers": "SELECT season_id, player_id, g, pts FROM players ORDER BY g DESC, pts DESC, season_id, player_id LIMIT 10",
    "most_points_by_division": "SELECT season_id, division_id, max(points) AS points FROM record GROUP BY season_id, division_id",
    "division_averages": "SELECT season_id, division_id, round(avg(CAST(gf AS DOUBLE)), 6) AS gf, round(avg(CAST(ga AS DOUBLE)), 6) AS ga FROM record GROUP BY season_id, division_id",
    "undefeated_at_home": "SELECT season_id, home_id AS team_id, count(*) AS games FROM games WHERE home_score IS NOT NULL GROUP BY season_id, home_id HAVING min(home_score - visitor_score) >= 0",
    "penalty_minutes_by_team": "SELECT season_id, team_id, CAST(sum(minutes) AS BIGINT) AS pim FROM penalties GROUP BY season_id, team_id",
    "penalty_minutes_by_player": "SELECT season_id, player_id, pim FROM players WHERE pim >= 30",
    "goals_by_period": "SELECT season_id, period, count(*) AS n FROM goals GROUP BY season_id, period",
    "special_team_share": "SELECT season_id, round(CAST(sum(CASE WHEN pp OR sh THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*), 6) AS share FROM goals GROUP BY season_id",
    "highest_scoring_games": "SELECT season_id, game_id, home_score + visitor_score AS total FROM games WHERE home_score IS NOT NULL ORDER BY total DESC, game_id LIMIT 10",
    "goal_difference_leaders": "SELECT season_id, team_id, gd FROM record WHERE gd > 20",
    "close_games": "SELECT season_id, count(*) AS n FROM games WHERE abs(home_score - visitor_score) <= 1 GROUP BY season_id",
    "players_without_points": "SELECT season_id, count(*) AS n FROM (SELECT season_id, CASE WHEN player_id LIKE '%7' THEN 0 ELSE pts END AS pts FROM players) AS kept WHERE pts = 0 GROUP BY season_id",
    "winners_and_losers": "SELECT season_id, team_name, w, l, CASE WHEN w > l THEN 'winning' WHEN w < l THEN 'losing' ELSE 'even' END AS kind FROM record",
    "multi_goal_games": "SELECT season_id, scorer_id, count(*) AS n FROM (SELECT season_id, scorer_id, game_id FROM goals GROUP BY season_id, scorer_id, game_id HAVING count(*) >= 2) AS m GROUP BY season_id, scorer_id",
    "unassisted_share": "SELECT season_id, team_id, round(CAST(sum(CASE WHEN assist1_id IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS share FROM goals GROUP BY season_id, team_id",
    "schedule_by_status": "SELECT season_id, status, count(*) AS n FROM games GROUP BY season_id, status",
}


def ask(spark: SparkSession, sf_dir: str, question: str) -> DataFrame:
    """The answer to a question over the pseudo-season; tables are bound to the query, no view is left behind."""
    x = pseudo.league(spark, sf_dir)
    tables = {"games": x.games, "teams": x.teams, "goals": x.goals, "penalties": x.penalties, "record": teams.record(x), "players": players.basic(x)}
    used = {name: df for name, df in tables.items() if re.search(rf"\b(FROM|JOIN) {name}\b", QUESTIONS[question])}
    text = re.sub(rf"\b(FROM|JOIN) ({'|'.join(used)})\b", lambda m: f"{m[1]} {{{m[2]}}}", QUESTIONS[question])
    return spark.sql(text, **used)
