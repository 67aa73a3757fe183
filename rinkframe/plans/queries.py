"""Queries over the pseudo-season of the driver's tables, with SQL for comparison."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import core
from ..operators import changes, directory, logos, monitor, players, quality, resolve, strength, teams
from ..sources import documents, pseudo
from ..streaming import events
from . import captures, clubs, corpus, lookups, resolving, stores

#: The adapter of sources.pseudo as common table expressions.
BASE = """
WITH games AS (
  SELECT CAST(year(o_orderdate) AS BIGINT) AS season_id, o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
    o_orderkey % 25 AS home_id, (o_orderkey % 25 + 1 + CAST(floor(o_orderkey / 25) AS BIGINT) % 24) % 25 AS visitor_id,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 7 END AS home_score,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0 THEN CAST(floor(o_totalprice / 7) AS BIGINT) % 7 END AS visitor_score,
    CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'scheduled' ELSE 'in_progress' END AS status
  FROM orders
), teams AS (
  SELECT season_id, CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name, CAST(n_regionkey AS BIGINT) AS division_id
  FROM (SELECT DISTINCT season_id FROM games) CROSS JOIN nation
), events_ AS (
  SELECT g.season_id, g.game_id, l.*, CASE WHEN l_linestatus = 'F' THEN home_id ELSE visitor_id END AS team_id
  FROM lineitem l JOIN games g ON l.l_orderkey = g.game_id
), goals AS (
  SELECT season_id, game_id, team_id, CASE l_linenumber % 4 WHEN 0 THEN '1st' WHEN 1 THEN '2nd' WHEN 2 THEN '3rd' ELSE 'OT' END AS period,
    'p' || team_id || '_' || (l_suppkey % 20) AS scorer_id, l_suppkey % 20 + CASE WHEN l_quantity = 1 THEN 50 ELSE 0 END AS scorer_number,
    CASE WHEN l_returnflag = 'A' THEN 'p' || team_id || '_' || (l_partkey % 20) END AS assist1_id,
    CASE WHEN l_returnflag = 'A' AND l_linenumber % 2 = 0 THEN 'p' || team_id || '_' || ((l_partkey + 7) % 20) END AS assist2_id,
    l_linenumber = 1 AS pp, l_linenumber = 2 AS sh, l_linenumber = 3 AS gw, l_linenumber = 7 AS en
  FROM events_ WHERE l_returnflag IN ('A', 'N')
), penalties AS (
  SELECT season_id, game_id, team_id, 'p' || team_id || '_' || (l_suppkey % 20) AS player_id,
    CASE l_linenumber % 4 WHEN 0 THEN 10 WHEN 3 THEN 5 ELSE 2 END AS minutes
  FROM events_ WHERE l_returnflag = 'R'
), sides AS (
  SELECT season_id, game_id, game_date, status, home_id AS team_id, visitor_id AS opponent_id, home_score AS own, visitor_score AS other, true AS is_home FROM games
  UNION ALL
  SELECT season_id, game_id, game_date, status, visitor_id, home_id, visitor_score, home_score, false FROM games
), finals AS (SELECT * FROM sides WHERE status = 'final'),
tg AS (SELECT * FROM finals WHERE own IS NOT NULL AND other IS NOT NULL),
rec AS (
  SELECT t.season_id, t.team_id, any_value(team_name) AS team_name, any_value(division_id) AS division_id, count(game_id) AS gp,
    CAST(count_if(own > other) AS BIGINT) AS w, CAST(count_if(own < other) AS BIGINT) AS l, CAST(count_if(own = other) AS BIGINT) AS t,
    CAST(coalesce(sum(own), 0) AS BIGINT) AS gf, CAST(coalesce(sum(other), 0) AS BIGINT) AS ga
  FROM teams t LEFT JOIN tg USING (season_id, team_id) GROUP BY t.season_id, t.team_id
), record AS (
  SELECT *, gf - ga AS gd, 2 * w + t AS points, coalesce(CAST(2 * w + t AS DOUBLE) / nullif(2 * gp, 0), 0) AS points_pct,
    coalesce(CAST(gf AS DOUBLE) / nullif(gp, 0), 0) AS gpg, coalesce(CAST(ga AS DOUBLE) / nullif(gp, 0), 0) AS gapg FROM rec
), roles AS (
  SELECT season_id, game_id, team_id, scorer_id AS player_id, 'g' AS role, pp, sh, gw, en FROM goals
  UNION ALL SELECT season_id, game_id, team_id, assist1_id, 'a', pp, sh, gw, en FROM goals WHERE assist1_id IS NOT NULL
  UNION ALL SELECT season_id, game_id, team_id, assist2_id, 'a', pp, sh, gw, en FROM goals WHERE assist2_id IS NOT NULL AND assist2_id IS DISTINCT FROM assist1_id
), apps AS (
  SELECT season_id, team_id, player_id, count(DISTINCT game_id) AS gp FROM (SELECT season_id, team_id, player_id, game_id FROM roles UNION ALL SELECT season_id, team_id, player_id, game_id FROM penalties) GROUP BY ALL
), scoring AS (
  SELECT season_id, team_id, player_id, CAST(count_if(role = 'g') AS BIGINT) AS g, CAST(count_if(role = 'a') AS BIGINT) AS a, CAST(count_if(role = 'g' AND pp) AS BIGINT) AS pp_g, CAST(count_if(role = 'a' AND pp) AS BIGINT) AS pp_a,
    CAST(count_if(role = 'g' AND sh) AS BIGINT) AS sh_g, CAST(count_if(role = 'a' AND sh) AS BIGINT) AS sh_a, CAST(count_if(role = 'g' AND gw) AS BIGINT) AS gwg, CAST(count_if(role = 'g' AND en) AS BIGINT) AS en_g FROM roles GROUP BY ALL
), fouls AS (
  SELECT season_id, team_id, player_id, count(*) AS penalties, CAST(sum(minutes) AS BIGINT) AS pim, CAST(count_if(minutes >= 5) AS BIGINT) AS majors FROM penalties GROUP BY ALL
), players AS (
  SELECT season_id, team_id, player_id, gp, coalesce(g, 0) AS g, coalesce(a, 0) AS a, coalesce(pp_g, 0) AS pp_g, coalesce(pp_a, 0) AS pp_a, coalesce(sh_g, 0) AS sh_g, coalesce(sh_a, 0) AS sh_a,
    coalesce(gwg, 0) AS gwg, coalesce(en_g, 0) AS en_g, coalesce(penalties, 0) AS penalties, coalesce(pim, 0) AS pim, coalesce(majors, 0) AS majors, coalesce(g, 0) + coalesce(a, 0) AS pts
  FROM apps LEFT JOIN scoring USING (season_id, team_id, player_id) LEFT JOIN fouls USING (season_id, team_id, player_id)
)
"""


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _q(make):
    """A query from a function of the league."""
    return lambda spark, sf_dir: make(pseudo.league(spark, sf_dir))


def _t(make, *names: str):
    """A query from a function of driver tables."""
    return lambda spark, sf_dir: make(*[pseudo.read(spark, sf_dir, n) for n in names])


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None, base: bool = True) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = (BASE if base else "") + sql


_add("d01_team_record", _q(lambda x: _rounded(teams.record(x).drop("row_wins"), "points_pct", "gpg", "gapg")), "SELECT * REPLACE (round(points_pct, 6) AS points_pct, round(gpg, 6) AS gpg, round(gapg, 6) AS gapg) FROM record")
_add(
    "d19_standings",
    _q(lambda x: teams.standings(x).select("season_id", "division_id", "place", "team_id", "team_name", "gp", "points", "gf", "ga", "record")),
    "SELECT season_id, division_id, row_number() OVER (PARTITION BY season_id, division_id ORDER BY points DESC, w DESC, gf DESC, team_id) AS place, team_id, team_name, gp, points, gf, ga, w || '-' || l || '-' || t AS record FROM record",
)
_add("d02_player_basic", _q(lambda x: _rounded(players.basic(x), "pts_per_game", "pim_per_game")), "SELECT *, round(coalesce(CAST(pts AS DOUBLE) / nullif(gp, 0), 0), 6) AS pts_per_game, round(coalesce(CAST(pim AS DOUBLE) / nullif(gp, 0), 0), 6) AS pim_per_game FROM players")
_add("d03_player_import", _q(lambda x: _rounded(players.scorers_only(x), "goals_per_game")), "SELECT season_id, team_id, scorer_id AS player_id, count(*) AS g, count(DISTINCT game_id) AS gp, count(*) AS pts, round(CAST(count(*) AS DOUBLE) / count(DISTINCT game_id), 6) AS goals_per_game FROM goals GROUP BY ALL")
_PERIODS = ", ".join(f"CAST(count_if(period = '{p}') AS BIGINT) AS {n}_{{k}}" for p, n in (("1st", "p1"), ("2nd", "p2"), ("3rd", "p3"), ("OT", "ot")))
_ZEROS = ", ".join(f"coalesce({n}_{k}, 0) AS {n}_{k}" for k in ("for", "against") for n in ("p1", "p2", "p3", "ot"))
_add(
    "d04_period_goals",
    _q(teams.period_goals),
    f", f AS (SELECT season_id, team_id, {_PERIODS.format(k='for')} FROM goals GROUP BY ALL), a AS (SELECT s.season_id, s.team_id, {_PERIODS.format(k='against')} FROM sides s JOIN goals g ON g.game_id = s.game_id AND g.team_id = s.opponent_id GROUP BY ALL) SELECT season_id, team_id, {_ZEROS} FROM teams LEFT JOIN f USING (season_id, team_id) LEFT JOIN a USING (season_id, team_id)",
)
_SPECIAL = """, pg AS (SELECT season_id, team_id, CAST(count_if(pp) AS BIGINT) AS n FROM goals GROUP BY ALL), pc AS (SELECT s.season_id, s.team_id, count(*) AS n FROM sides s JOIN penalties p ON p.game_id = s.game_id AND p.team_id = s.opponent_id WHERE minutes >= 2 GROUP BY ALL),
ka AS (SELECT s.season_id, s.team_id, count(*) AS n FROM sides s JOIN goals p ON p.game_id = s.game_id AND p.team_id = s.opponent_id WHERE pp GROUP BY ALL), ks AS (SELECT season_id, team_id, count(*) AS n FROM penalties WHERE minutes >= 2 GROUP BY ALL)
"""
_add("d05_power_play", _q(lambda x: _rounded(teams.power_play(x), "pp_pct")), _SPECIAL + "SELECT season_id, team_id, coalesce(pg.n, 0) AS pp_goals, coalesce(pc.n, 0) AS pp_chances, round(coalesce(CAST(coalesce(pg.n, 0) AS DOUBLE) * 100e0 / nullif(pc.n, 0), 0), 6) AS pp_pct FROM teams LEFT JOIN pg USING (season_id, team_id) LEFT JOIN pc USING (season_id, team_id)")
_add("d06_penalty_kill", _q(lambda x: _rounded(teams.penalty_kill(x), "pk_pct")), _SPECIAL + "SELECT season_id, team_id, coalesce(ka.n, 0) AS pp_against, coalesce(ks.n, 0) AS times_short, round(coalesce(CAST(coalesce(ks.n, 0) - coalesce(ka.n, 0) AS DOUBLE) * 100e0 / nullif(ks.n, 0), 0), 6) AS pk_pct FROM teams LEFT JOIN ka USING (season_id, team_id) LEFT JOIN ks USING (season_id, team_id)")
_SPLIT = ", ".join(f"CAST(count_if({s} AND own {o} other) AS BIGINT) AS {n}_{r}" for n, s in (("home", "is_home"), ("away", "NOT is_home")) for r, o in (("w", ">"), ("l", "<"), ("t", "=")))
_SPLIT += "".join(f", CAST(coalesce(sum(CASE WHEN {s} THEN {c} END), 0) AS BIGINT) AS {n}_{r}" for n, s in (("home", "is_home"), ("away", "NOT is_home")) for r, c in (("gf", "own"), ("ga", "other")))
_add("d07_splits", _q(teams.splits), f"SELECT t.season_id, t.team_id, {_SPLIT} FROM teams t LEFT JOIN tg USING (season_id, team_id) GROUP BY t.season_id, t.team_id")
_FORM = """, n AS (SELECT *, CASE WHEN own > other THEN 'W' WHEN own < other THEN 'L' ELSE 'T' END AS r, row_number() OVER (PARTITION BY {key} ORDER BY game_date DESC, game_id DESC) AS nth FROM {src}),
z AS (SELECT *, first_value(r) OVER (PARTITION BY {key} ORDER BY nth) AS newest FROM n),
form AS (SELECT {key}, CAST(count_if(r = 'W' AND nth <= {k}) AS BIGINT) || '-' || CAST(count_if(r = 'L' AND nth <= {k}) AS BIGINT) || '-' || CAST(count_if(r = 'T' AND nth <= {k}) AS BIGINT) AS last_record, any_value(newest) || coalesce(min(nth) FILTER (r <> newest) - 1, count(*)) AS streak FROM z GROUP BY ALL)
"""
_add("d18_recent_form", _q(teams.recent_form), _FORM.format(key="season_id, team_id", src="tg", k=10) + "SELECT * FROM form")
_REST = ", gaps AS (SELECT season_id, team_id, date_diff('day', lag(game_date) OVER (PARTITION BY season_id, team_id ORDER BY game_date, game_id), game_date) - 1 AS days FROM finals) "
_add("d16_rest", _q(teams.rest), _REST + "SELECT season_id, team_id, CAST(count_if(days >= 2) AS BIGINT) AS on_rest, CAST(count_if(days = 0) AS BIGINT) AS back_to_back, CAST(count_if(days >= 2) AS BIGINT) - CAST(count_if(days = 0) AS BIGINT) AS differential FROM gaps GROUP BY ALL")
_add(
    "d08_season_stats",
    _q(lambda x: teams.season_stats(x).select("season_id", "team_id", "points", "p1_for", "ot_against", "pp_goals", "times_short", "home_w", "away_ga", "last_record", "back_to_back")),
    _SPECIAL + _FORM.format(key="season_id, team_id", src="tg", k=10) + _REST
    + ", b AS (SELECT season_id, team_id, CAST(count_if(days = 0) AS BIGINT) AS back_to_back FROM gaps GROUP BY ALL), p AS (SELECT season_id, team_id, CAST(count_if(period = '1st') AS BIGINT) AS p1_for FROM goals GROUP BY ALL), o AS (SELECT s.season_id, s.team_id, CAST(count_if(period = 'OT') AS BIGINT) AS ot_against FROM sides s JOIN goals g ON g.game_id = s.game_id AND g.team_id = s.opponent_id GROUP BY ALL), h AS (SELECT season_id, team_id, CAST(count_if(is_home AND own > other) AS BIGINT) AS home_w, CAST(coalesce(sum(CASE WHEN NOT is_home THEN other END), 0) AS BIGINT) AS away_ga FROM tg GROUP BY ALL) "
    "SELECT season_id, team_id, points, coalesce(p1_for, 0) AS p1_for, coalesce(ot_against, 0) AS ot_against, coalesce(pg.n, 0) AS pp_goals, coalesce(ks.n, 0) AS times_short, coalesce(home_w, 0) AS home_w, coalesce(away_ga, 0) AS away_ga, last_record, back_to_back FROM record LEFT JOIN p USING (season_id, team_id) LEFT JOIN o USING (season_id, team_id) LEFT JOIN pg USING (season_id, team_id) LEFT JOIN ks USING (season_id, team_id) LEFT JOIN h USING (season_id, team_id) LEFT JOIN form USING (season_id, team_id) LEFT JOIN b USING (season_id, team_id)",
)
_SOS = """, edges AS (SELECT DISTINCT season_id, team_id, opponent_id FROM finals),
sos AS (SELECT e.season_id, e.team_id, avg(coalesce(points_pct, 0)) AS sos, count(*) AS n_opponents FROM edges e LEFT JOIN record r ON r.season_id = e.season_id AND r.team_id = e.opponent_id GROUP BY ALL),
two AS (SELECT e.season_id, e.team_id, avg(coalesce(sos, 0)) AS opp_opp FROM edges e LEFT JOIN sos r ON r.season_id = e.season_id AND r.team_id = e.opponent_id GROUP BY ALL),
vic AS (SELECT g.season_id, g.team_id, avg(points_pct) AS sov FROM tg g JOIN record r ON r.season_id = g.season_id AND r.team_id = g.opponent_id WHERE own > other GROUP BY ALL),
str AS (SELECT t.season_id, t.team_id, coalesce(sos, 0) AS sos, coalesce(n_opponents, 0) AS n_opponents, coalesce(opp_opp, 0) AS opp_opp, coalesce(sov, 0) AS sov FROM teams t LEFT JOIN sos USING (season_id, team_id) LEFT JOIN two USING (season_id, team_id) LEFT JOIN vic USING (season_id, team_id))
"""
_add("d10_sos", _q(lambda x: _rounded(strength.schedule(x), "sos", "opp_opp", "adjusted")), _SOS + "SELECT season_id, team_id, round(sos, 6) AS sos, n_opponents, round(opp_opp, 6) AS opp_opp, round(sos * 2 / 3 + opp_opp / 3, 6) AS adjusted FROM str")
_add("d13_sov", _q(lambda x: _rounded(strength.victory(x), "sov")), _SOS + "SELECT season_id, team_id, round(sov, 6) AS sov FROM str")
_add("d15_strength_ranks", _q(lambda x: strength.ranks(x).select("season_id", "team_id", "sos_rank", "sov_rank")), _SOS + "SELECT season_id, team_id, row_number() OVER (PARTITION BY season_id ORDER BY round(sos, 9) DESC, team_id) AS sos_rank, row_number() OVER (PARTITION BY season_id ORDER BY round(sov, 9) DESC, team_id) AS sov_rank FROM str")
_THIRD = """, pl AS (SELECT season_id, team_id, division_id, row_number() OVER (PARTITION BY season_id, division_id ORDER BY round(points_pct, 9) DESC, team_id) AS place, count(*) OVER (PARTITION BY season_id, division_id) // 3 AS cut, count(*) OVER (PARTITION BY season_id, division_id) AS n FROM record),
th AS (SELECT season_id, division_id, team_id AS opponent_id, CASE WHEN place <= cut THEN 'top' WHEN place > n - cut THEN 'bottom' ELSE 'middle' END AS third FROM pl),
ga_ AS (SELECT season_id, team_id, CAST(count_if(third = 'top') AS BIGINT) AS games_top, CAST(count_if(third = 'middle') AS BIGINT) AS games_middle, CAST(count_if(third = 'bottom') AS BIGINT) AS games_bottom FROM (SELECT DISTINCT season_id, team_id, opponent_id FROM finals) JOIN teams USING (season_id, team_id) JOIN th USING (season_id, division_id, opponent_id) GROUP BY ALL),
po AS (SELECT season_id, team_id, third, CASE WHEN own > other THEN 2 WHEN own = other THEN 1 ELSE 0 END AS p FROM finals JOIN teams USING (season_id, team_id) JOIN th USING (season_id, division_id, opponent_id)),
pp_ AS (SELECT season_id, team_id, CAST(coalesce(sum(p) FILTER (third = 'top'), 0) AS BIGINT) AS points_top, CAST(coalesce(sum(p) FILTER (third = 'middle'), 0) AS BIGINT) AS points_middle, CAST(coalesce(sum(p) FILTER (third = 'bottom'), 0) AS BIGINT) AS points_bottom FROM po GROUP BY ALL)
"""
_add("d14_thirds", _q(strength.against_thirds), _THIRD + "SELECT t.season_id, t.team_id, coalesce(games_top, 0) AS games_top, coalesce(games_middle, 0) AS games_middle, coalesce(games_bottom, 0) AS games_bottom, coalesce(points_top, 0) AS points_top, coalesce(points_middle, 0) AS points_middle, coalesce(points_bottom, 0) AS points_bottom FROM teams t LEFT JOIN ga_ USING (season_id, team_id) LEFT JOIN pp_ USING (season_id, team_id)")
_add(
    "d17_head_to_head",
    _q(lambda x: _rounded(teams.head_to_head(x), "points_pct", "pp_pct")),
    ", pairs AS (SELECT * FROM tg WHERE team_id < opponent_id)" + _FORM.format(key="season_id, team_id, opponent_id", src="pairs", k=5)
    + ", x AS (SELECT p.season_id, p.team_id, p.opponent_id, count(*) AS pp_goals FROM pairs p JOIN goals g ON g.game_id = p.game_id AND g.team_id = p.team_id WHERE pp GROUP BY ALL), y AS (SELECT p.season_id, p.team_id, p.opponent_id, count(*) AS pp_chances FROM pairs p JOIN penalties q ON q.game_id = p.game_id AND q.team_id = p.opponent_id WHERE minutes >= 2 GROUP BY ALL), b AS (SELECT season_id, team_id, opponent_id, count(*) AS gp, CAST(count_if(own > other) AS BIGINT) AS w, CAST(count_if(own < other) AS BIGINT) AS l, CAST(count_if(own = other) AS BIGINT) AS t, CAST(sum(own) AS BIGINT) AS gf, CAST(sum(other) AS BIGINT) AS ga FROM pairs GROUP BY ALL) "
    "SELECT b.*, 2 * w + t AS points, last_record, streak, coalesce(pp_goals, 0) AS pp_goals, coalesce(pp_chances, 0) AS pp_chances, round(coalesce(CAST(coalesce(pp_goals, 0) AS DOUBLE) * 100e0 / nullif(pp_chances, 0), 0), 6) AS pp_pct, round(CAST(2 * w + t AS DOUBLE) / (2 * gp), 6) AS points_pct, gf - ga AS gd FROM b JOIN form USING (season_id, team_id, opponent_id) LEFT JOIN x USING (season_id, team_id, opponent_id) LEFT JOIN y USING (season_id, team_id, opponent_id)",
)
_add(
    "d20_team_profile",
    _q(lambda x: _rounded(teams.profile(x).select("season_id", "team_id", "rank", "division_gpg", "streak", F.array_join(F.transform("recent", lambda g: F.concat_ws(":", g["game_id"].cast("string"), g["score"])), ",").alias("recent"), F.col("goals_in_context.percentile").alias("percentile"), F.col("goals_in_context.suffix").alias("suffix"), F.col("goals_in_context.reading").alias("reading")), "division_gpg", "percentile")),
    ", five AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY season_id, team_id ORDER BY game_date DESC, game_id DESC) AS k FROM tg) WHERE k <= 5)" + _FORM.format(key="season_id, team_id", src="(SELECT * EXCLUDE (k) FROM five)", k=5)
    + ", lst AS (SELECT season_id, team_id, string_agg(game_id || ':' || own || '-' || other, ',' ORDER BY k) AS recent FROM five GROUP BY ALL), rk AS (SELECT season_id, team_id, rank() OVER (PARTITION BY season_id, division_id ORDER BY points DESC, gf DESC) AS rank, count(*) OVER (PARTITION BY season_id, division_id) AS n, avg(CASE WHEN gp > 0 THEN CAST(gf AS DOUBLE) / gp END) OVER (PARTITION BY season_id, division_id) AS division_gpg FROM record), pc AS (SELECT *, CAST(n - rank + 1 AS DOUBLE) / n * 100 AS p FROM rk) "
    "SELECT season_id, team_id, rank, round(division_gpg, 6) AS division_gpg, streak, recent, round(p, 6) AS percentile, CASE rank WHEN 1 THEN 'st' WHEN 2 THEN 'nd' WHEN 3 THEN 'rd' ELSE 'th' END AS suffix, CASE WHEN p >= 90 THEN 'Elite - Top 10%' WHEN p >= 75 THEN 'Above Average - Top 25%' WHEN p >= 50 THEN 'Average - Top 50%' WHEN p >= 25 THEN 'Below Average - Bottom 50%' ELSE 'Poor - Bottom 25%' END AS reading FROM pc LEFT JOIN lst USING (season_id, team_id) LEFT JOIN form USING (season_id, team_id)",
)
for _c, _cols in players.LEADERS.items():
    _by = ", ".join(f"{c} DESC" for c in _cols)
    _add(f"d21_leaders_{_c}", _q(lambda x, c=_c: _rounded(players.leaders(players.basic(x), c, limit=25, min_games=5).select("season_id", "player_id", "value", "rank", "total_qualified", "percentile", "reading"), "percentile")), f", q AS (SELECT season_id, player_id, {_cols[0]} AS value, row_number() OVER (PARTITION BY season_id ORDER BY {_by}, player_id, team_id) AS rank, count(*) OVER (PARTITION BY season_id) AS total_qualified FROM players WHERE gp >= 5), r AS (SELECT *, CAST(total_qualified - rank + 1 AS DOUBLE) / total_qualified * 100 AS p FROM q WHERE rank <= 25) SELECT season_id, player_id, value, rank, total_qualified, round(p, 6) AS percentile, CASE WHEN p >= 90 THEN 'Elite - Top 10%' WHEN p >= 75 THEN 'Above Average - Top 25%' WHEN p >= 50 THEN 'Average - Top 50%' WHEN p >= 25 THEN 'Below Average - Bottom 50%' ELSE 'Poor - Bottom 25%' END AS reading FROM r")
_add("d22_player_card", _q(lambda x: _rounded(players.card(players.basic(x)), "pts_per_game", "pim_per_game")), "SELECT season_id, team_id, player_id, gp, pts, round(CAST(pts AS DOUBLE) / gp, 6) AS pts_per_game, round(CAST(pim AS DOUBLE) / gp, 6) AS pim_per_game, rank() OVER (PARTITION BY season_id, team_id ORDER BY pts DESC, g DESC) AS team_rank FROM players")
_USUAL = ", un AS (SELECT season_id, team_id, scorer_id AS player_id, scorer_number AS number, count(*) AS n FROM goals GROUP BY ALL), us AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY season_id, team_id, player_id ORDER BY n DESC, number) AS nth FROM un) WHERE nth = 1) "
_add("w10_usual_number", _q(players.usual_number), _USUAL + "SELECT season_id, team_id, player_id, number FROM us")
_add("d23_player_search", _q(lambda x: players.search(players.basic(x).join(players.usual_number(x), players.KEY), number=7, name="P1").select("season_id", "player_id", "number", "pts", "confidence", "matches")), _USUAL + "SELECT season_id, player_id, number, pts, 0.9e0 AS confidence, 'number,name' AS matches FROM players JOIN us USING (season_id, team_id, player_id) WHERE number = 7 AND player_id ILIKE '%P1%' ORDER BY pts DESC, season_id, player_id LIMIT 50")
_add("d27_roster", _q(lambda x: players.roster(players.basic(x))), "SELECT season_id, team_id, player_id, gp, g, a, pts, row_number() OVER (PARTITION BY season_id, team_id ORDER BY pts DESC, g DESC, player_id) AS place FROM players")
_add("d24_team_schedule", _q(lambda x: teams.team_games(x.games, scored=False, finals=False).select("season_id", "team_id", "game_id", F.col("game_date").cast("string").alias("game_date"), "opponent_id", "is_home", "status")), "SELECT season_id, team_id, game_id, CAST(game_date AS VARCHAR) AS game_date, opponent_id, is_home, status FROM sides")
_add("d25_game_summary", _q(lambda x: x.games.join(x.goals.groupBy("game_id").agg(F.count("*").alias("n_goals"), F.count_if("pp").alias("n_pp")), "game_id", "left").join(x.penalties.groupBy("game_id").agg(F.count("*").alias("n_penalties"), F.sum("minutes").cast("long").alias("pim")), "game_id", "left").fillna(0, ["n_goals", "n_pp", "n_penalties", "pim"]).select("season_id", "game_id", "n_goals", "n_pp", "n_penalties", "pim", (F.col("home_score") + F.col("visitor_score")).alias("total_goals"))), "SELECT season_id, game_id, coalesce(n_goals, 0) AS n_goals, coalesce(n_pp, 0) AS n_pp, coalesce(n_penalties, 0) AS n_penalties, coalesce(pim, 0) AS pim, home_score + visitor_score AS total_goals FROM games LEFT JOIN (SELECT game_id, count(*) AS n_goals, CAST(count_if(pp) AS BIGINT) AS n_pp FROM goals GROUP BY ALL) USING (game_id) LEFT JOIN (SELECT game_id, count(*) AS n_penalties, CAST(sum(minutes) AS BIGINT) AS pim FROM penalties GROUP BY ALL) USING (game_id)")
_add("d26_season_info", _q(lambda x: x.games.groupBy("season_id").agg(F.count("*").alias("n_games"), F.count_if(core.final(F.col("status"))).alias("n_finals"), F.min("game_date").cast("string").alias("first_day"), F.max("game_date").cast("string").alias("last_day")).join(x.teams.groupBy("season_id").agg(F.count("*").alias("n_teams"), F.countDistinct("division_id").alias("n_divisions")), "season_id")), "SELECT season_id, n_games, n_finals, first_day, last_day, n_teams, n_divisions FROM (SELECT season_id, count(*) AS n_games, CAST(count_if(status = 'final') AS BIGINT) AS n_finals, CAST(min(game_date) AS VARCHAR) AS first_day, CAST(max(game_date) AS VARCHAR) AS last_day FROM games GROUP BY ALL) JOIN (SELECT season_id, count(*) AS n_teams, count(DISTINCT division_id) AS n_divisions FROM teams GROUP BY ALL) USING (season_id)")
_add("a13_penalties_by_minutes", _q(lambda x: x.penalties.groupBy("season_id", "minutes").agg(F.count("*").alias("n"))), "SELECT season_id, CAST(minutes AS BIGINT) AS minutes, count(*) AS n FROM penalties GROUP BY ALL")
_add("d33_most_goals_in_game", _q(lambda x: x.goals.groupBy("season_id", "scorer_id", "game_id").agg(F.count("*").alias("n")).groupBy("season_id").agg(F.max("n").alias("most"))), "SELECT season_id, max(n) AS most FROM (SELECT season_id, scorer_id, game_id, count(*) AS n FROM goals GROUP BY ALL) GROUP BY ALL")
# Quality
_add("q01_number_consistency", _q(quality.number_consistency), ", w AS (SELECT season_id, scorer_id AS player_id, scorer_number AS number, team_id, count(DISTINCT game_id) AS games, count(*) AS goals FROM goals GROUP BY ALL) SELECT season_id, player_id, count(DISTINCT number) AS n_numbers, CAST(sum(games) AS BIGINT) AS total_games, string_agg(number || '(' || goals || 'g)', ',' ORDER BY number, goals) AS details, round(1e0 / count(DISTINCT number), 3) AS score FROM w GROUP BY season_id, player_id HAVING count(DISTINCT number) > 1")
# In every tenth game all of the first five numbers wear one.
_add("q04_duplicate_numbers", _q(lambda x: quality.duplicate_numbers(dataclasses.replace(x, goals=x.goals.withColumn("scorer_number", F.when((F.col("game_id") % 10 == 3) & (F.col("scorer_number") < 5), 7).otherwise(F.col("scorer_number")))))), "SELECT season_id, team_id, number, count(DISTINCT scorer_id) AS n_players, string_agg(DISTINCT scorer_id, ',' ORDER BY scorer_id) AS players FROM (SELECT *, CASE WHEN game_id % 10 = 3 AND scorer_number < 5 THEN 7 ELSE scorer_number END AS number FROM goals) GROUP BY season_id, team_id, number HAVING count(DISTINCT scorer_id) > 1")
_CONF = ", sc AS (SELECT season_id, team_id, scorer_id AS player_id, count(*) AS goals, count(DISTINCT game_id) AS games FROM goals GROUP BY ALL), ab AS (SELECT season_id, p AS player_id, count(*) AS assists FROM (SELECT season_id, assist1_id AS p FROM goals UNION ALL SELECT season_id, assist2_id FROM goals) WHERE p IS NOT NULL GROUP BY ALL), nu AS (SELECT season_id, scorer_id AS player_id, count(DISTINCT scorer_number) AS n FROM goals GROUP BY ALL), co AS (SELECT season_id, team_id, player_id, goals, coalesce(assists, 0) AS assists, games, n, goals + coalesce(assists, 0) BETWEEN 1 AND 99 AS ok FROM sc LEFT JOIN ab USING (season_id, player_id) LEFT JOIN nu USING (season_id, player_id)) "
_add("q02_player_confidence", _q(quality.player_confidence), _CONF + "SELECT season_id, team_id, player_id, goals, assists, games, round(1e0 / n * 0.5e0 + 0.3e0 + CASE WHEN ok THEN 0.2e0 ELSE 0.1e0 END, 3) AS confidence, concat_ws(',', CASE WHEN n > 1 THEN 'many_numbers' END, CASE WHEN NOT ok THEN 'odd_total' END) AS flags FROM co")
_GQ = ", gq AS (SELECT g.*, coalesce(n, 0) AS n_goals, home_score IS NULL OR visitor_score IS NULL AS missing, coalesce(home_score + visitor_score, 0) AS total FROM games g LEFT JOIN (SELECT game_id, count(*) AS n FROM goals GROUP BY ALL) USING (game_id) WHERE status = 'final') "
_add("q05_game_issues", _q(lambda x: quality.game_issues(x, many=10)), _GQ + "SELECT season_id, game_id, CASE WHEN total > 10 OR (NOT missing AND total > 0 AND n_goals = 0) THEN 'warning' ELSE 'critical' END AS severity, concat_ws(', ', CASE WHEN missing THEN 'missing_scores' END, CASE WHEN NOT missing AND total > 0 AND n_goals = 0 THEN 'box_score_missing' END, CASE WHEN total > 10 THEN 'high_total ' || total END) AS description FROM gq WHERE missing OR (NOT missing AND total > 0 AND n_goals = 0) OR total > 10")
_add("q06_missing_data", _q(quality.missing_data), "SELECT 'games' AS entity, count(*) AS total, CAST(count_if(home_score IS NULL OR visitor_score IS NULL) AS BIGINT) AS missing, round(CAST(count_if(home_score IS NULL OR visitor_score IS NULL) AS BIGINT) * 100e0 / greatest(count(*), 1), 1) AS percentage FROM games WHERE status = 'final' UNION ALL SELECT 'goals', count(*), CAST(count_if(scorer_id IS NULL) AS BIGINT), 0e0 FROM goals UNION ALL SELECT 'penalties', count(*), CAST(count_if(player_id IS NULL) AS BIGINT), 0e0 FROM penalties")
_add("q10_game_quality", _q(quality.game_scores), _GQ + "SELECT season_id, game_id, n_goals, round(CASE WHEN missing THEN 0e0 ELSE 0.35e0 END + CASE WHEN n_goals = total THEN 1e0 WHEN n_goals > 0 THEN 0.7e0 ELSE 0.3e0 END * 0.3e0 + CASE WHEN total > 20 THEN 0.5e0 WHEN total > 15 THEN 0.8e0 ELSE 1e0 END * 0.2e0 + 0.15e0, 3) AS score FROM gq")
_add("q11_team_quality", _q(quality.team_scores), ", sz AS (SELECT season_id, team_id, count(DISTINCT scorer_id) AS n FROM goals GROUP BY ALL), s AS (SELECT season_id, team_id, gp, gpg, gapg, coalesce(n, 0) AS n_players FROM record LEFT JOIN sz USING (season_id, team_id)) SELECT season_id, team_id, gp, n_players, round(CASE WHEN gp = 0 THEN 0e0 ELSE 1e0 END * 0.4e0 + CASE WHEN n_players = 0 THEN 0e0 WHEN n_players < 8 THEN 0.5e0 WHEN n_players > 25 THEN 0.6e0 ELSE 1e0 END * 0.4e0 + CASE WHEN gpg > 15 OR gapg > 15 THEN 0.5e0 ELSE 1e0 END * 0.2e0, 3) AS score FROM s")
_MANY = "(SELECT season_id, scorer_id, count(DISTINCT scorer_number) AS n FROM goals GROUP BY ALL HAVING count(DISTINCT scorer_number) > 1)"
_HOLES = "(SELECT CAST(count_if(home_score IS NULL OR visitor_score IS NULL) AS BIGINT) * 100e0 / greatest(count(*), 1) AS p FROM games WHERE status = 'final' UNION ALL SELECT count_if(scorer_id IS NULL) * 100e0 / greatest(count(*), 1) FROM goals UNION ALL SELECT count_if(player_id IS NULL) * 100e0 / greatest(count(*), 1) FROM penalties)"
_add(
    "q07_overall",
    _q(lambda x: quality.overall(x).select("inconsistent", "low", "critical", "holes", "score")),
    _CONF + _GQ + f", k AS (SELECT (SELECT count(*) FROM {_MANY}) AS inconsistent, (SELECT count(*) FROM co WHERE round(1e0 / n * 0.5e0 + 0.3e0 + CASE WHEN ok THEN 0.2e0 ELSE 0.1e0 END, 3) < 0.7e0) AS low, (SELECT count(*) FROM gq WHERE missing) AS critical, (SELECT count(*) FROM {_HOLES} WHERE round(p, 1) > 50) AS holes) "
    "SELECT *, round(greatest(0e0, 1e0 - (least(0.2e0, inconsistent * 0.01e0) + least(0.2e0, low * 0.005e0) + least(0.3e0, critical * 0.02e0) + holes * 0.1e0)), 3) AS score FROM k",
)
_add(
    "q14_issues",
    _q(lambda x: quality.issues(x).groupBy("entity", "band").agg(F.count("*").alias("n"))),
    _GQ + f", i AS (SELECT 'player' AS entity, 1 - round(1e0 / n, 3) AS impact FROM {_MANY} UNION ALL SELECT 'game', CASE WHEN missing THEN 0.5e0 ELSE 0.2e0 END FROM gq WHERE missing OR (total > 0 AND n_goals = 0) OR total > 20 UNION ALL SELECT 'team', 0.3e0 FROM (SELECT 1 FROM goals GROUP BY season_id, team_id, scorer_number HAVING count(DISTINCT scorer_id) > 1)) SELECT entity, CASE WHEN impact > 0.5e0 THEN 'critical' WHEN impact >= 0.2e0 THEN 'warning' ELSE 'info' END AS band, count(*) AS n FROM i GROUP BY ALL",
)
_POINTS = ", y AS (SELECT season_id, team_id, player_id, gp, g, a, pts, pim, coalesce(n, 0) AS n FROM players LEFT JOIN (SELECT season_id, team_id, scorer_id AS player_id, count(DISTINCT scorer_number) AS n FROM goals GROUP BY ALL) USING (season_id, team_id, player_id)) "


def _scored(x) -> DataFrame:
    worn = x.goals.groupBy("season_id", "team_id", F.col("scorer_id").alias("player_id")).agg(F.countDistinct("scorer_number").alias("n_numbers"))
    p = players.basic(x).join(worn, players.KEY, "left").fillna(0, ["n_numbers"])
    return p.withColumn("name", F.when(F.col("gp") % 3 != 0, F.col("player_id")))


_SCORE = "round(1e0 / greatest(n, 1) * 0.3e0 + CASE WHEN gp % 3 <> 0 THEN 1e0 ELSE 0e0 END * 0.2e0 + CASE WHEN gp = 0 THEN 0e0 WHEN pts = 0 THEN 0.5e0 ELSE 1e0 END * 0.2e0 + least(CASE WHEN pts > 100 THEN 0.3e0 WHEN pts > 50 THEN 0.7e0 ELSE 1e0 END, CASE WHEN gp > 0 AND pts > 10 * gp THEN 0.2e0 ELSE 1e0 END) * 0.25e0 + CASE WHEN pim > 100 THEN 0.5e0 ELSE 1e0 END * 0.05e0, 3)"
_add("q08_player_scores", _q(lambda x: monitor.player_scores(_scored(x)).select(*players.KEY, "score", F.array_join("recommendations", ",").alias("advice"))), _POINTS + f"SELECT season_id, team_id, player_id, {_SCORE} AS score, concat_ws(',', CASE WHEN n > 1 THEN 'check numbers' END, CASE WHEN gp % 3 = 0 THEN 'add name' END, CASE WHEN gp = 0 OR pts = 0 THEN 'complete statistics' END, CASE WHEN pts > 50 OR pts > 10 * gp THEN 'review totals' END, CASE WHEN pim > 100 THEN 'review penalties' END) AS advice FROM y")
_add("q09_basic_scores", _q(lambda x: monitor.basic_scores(_scored(x).withColumn("number", F.nullif("n_numbers", F.lit(0)))).select(*players.KEY, "score")), _POINTS + "SELECT season_id, team_id, player_id, round(CASE WHEN n > 0 THEN 0.4e0 ELSE 0e0 END + CASE WHEN gp % 3 <> 0 THEN 0.3e0 ELSE 0e0 END + CASE WHEN gp > 0 THEN 0.2e0 ELSE 0e0 END + CASE WHEN pts > 0 THEN 0.1e0 ELSE 0e0 END, 3) AS score FROM y")
_add("q03_basic_confidence", _q(lambda x: monitor.basic_confidence(_scored(x).withColumn("number", F.nullif("n_numbers", F.lit(0)))).select(*players.KEY, "confidence")), _POINTS + "SELECT season_id, team_id, player_id, round(CASE WHEN n > 0 THEN 0.5e0 ELSE 0e0 END + CASE WHEN gp % 3 <> 0 THEN 0.3e0 ELSE 0e0 END + CASE WHEN pts > 0 AND pts < 100 THEN 0.2e0 ELSE 0.1e0 END, 3) AS confidence FROM y")
_add("q12_histogram", _q(lambda x: monitor.histogram(monitor.player_scores(_scored(x)))), _POINTS + f"SELECT CASE WHEN s < 0.5e0 THEN 'poor' WHEN s < 0.8e0 THEN 'fair' ELSE 'good' END AS band, count(*) AS n FROM (SELECT {_SCORE} AS s FROM y) GROUP BY ALL")
_add("j08_orphans", _t(lambda o, li: quality.orphans(o.select("o_orderkey"), li, "o_orderkey", "l_orderkey"), "orders", "lineitem"), "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", base=False)
_add("t02_needing_box_scores", _q(lambda x: changes.needing_box_scores(x.games, x.goals).select("season_id", "game_id")), "SELECT season_id, game_id FROM games WHERE status = 'final' AND game_id NOT IN (SELECT game_id FROM goals)")
_add("a15_schedule_state", _q(lambda x: changes.schedule_state(x.games, "1997-03-01")), "SELECT count(*) AS total, CAST(count_if(status = 'final') AS BIGINT) AS finals, CAST(count_if(status = 'scheduled') AS BIGINT) AS scheduled, CAST(count_if(game_date = DATE '1997-03-01') AS BIGINT) AS today, CAST(count_if(game_date = DATE '1997-03-02') AS BIGINT) AS tomorrow FROM games")


def _snapshots(x) -> DataFrame:
    g = x.games.select("game_id", "home_score", "visitor_score", "status")
    new = g.withColumn("home_score", F.when(F.col("game_id") % 13 == 0, F.col("home_score") + 1).otherwise(F.col("home_score")))
    return changes.change_report(changes.merge_snapshots(g.where("game_id % 11 <> 0"), new, "game_id", ["home_score", "visitor_score", "status"]))


_add("d30_change_report", _q(_snapshots), "SELECT CASE WHEN game_id % 11 = 0 THEN 'new' WHEN game_id % 13 = 0 AND home_score IS NOT NULL THEN 'updated' ELSE 'unchanged' END AS change_type, count(*) AS n FROM games GROUP BY ALL")
_add("t03_game_day", _t(lambda e: e.groupBy(core.game_day(F.col("ts")).alias("game_day"), core.refresh_minutes(F.col("ts")).alias("minutes")).agg(F.count("*").alias("n")), "events"), "SELECT d AS game_day, CASE WHEN d THEN 15 ELSE 240 END AS minutes, count(*) AS n FROM (SELECT isodow(ts) >= 6 OR (isodow(ts) = 5 AND strftime(ts, '%H:%M:%S') >= '17:00:00') OR (isodow(ts) < 5 AND strftime(ts, '%H:%M:%S') BETWEEN '18:00:00' AND '21:00:00') AS d FROM events) GROUP BY ALL", base=False)
_add("o03_page", _t(lambda c: players.listing(c.select("c_custkey", "c_name", "c_mktsegment"), [F.col("c_mktsegment") == "BUILDING", None, F.contains(F.lower("c_name"), F.lit("customer"))], ["c_name", "c_custkey"], limit=20, offset=40), "customer"), "SELECT c_custkey, c_name, c_mktsegment, (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS total, (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') > 60 AS has_more FROM customer WHERE c_mktsegment = 'BUILDING' AND c_name ILIKE '%customer%' ORDER BY c_name, c_custkey LIMIT 20 OFFSET 40", base=False)
_add("s03_parallel_arrays", _t(resolve.parallel_arrays_round_trip, "nation"), "SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name AS team_name, CAST(n_regionkey AS BIGINT) AS division_id FROM nation", base=False)
#: Team names in the forms that sources use, in both dialects.
_TEAM = "CASE p_partkey % 11 WHEN 0 THEN p_name || ' - U10B (White)' WHEN 1 THEN p_name || '-Red' WHEN 2 THEN 'WHK Black' WHEN 3 THEN p_name || ' U10 B1' WHEN 4 THEN upper(p_name) || ' 1' WHEN 5 THEN p_name || ' Red Black' WHEN 6 THEN p_name || ' Girls' WHEN 7 THEN 'ssc Blue' WHEN 8 THEN p_name || ' A' WHEN 9 THEN 'HULL (Gold)  2' ELSE p_name || ' Pee Wee 2' END"


def _club_sql() -> str:
    x = "CASE WHEN contains(t, ' - ') THEN trim(split_part(t, ' - ', 1)) WHEN contains(t, '-') AND NOT starts_with(t, 'U') THEN trim(split_part(t, '-', 1)) ELSE t END"
    colours = [rf"(?i)\s+{c}$" for c in resolve.COLOURS]
    levels = [rf"(?i)\s+{v}.*$" for v in resolve.LEVELS]
    for pattern in [r"\s*\([^)]*\)", r"(?i)\s+U\d+[ABC]?\d?", r"(?i)\s+Girls?$", *colours, r"\s+[A-Z]$", r"\s+\d$", *levels]:
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    known = ", ".join(f"'{a}'" for a in resolve.ACRONYMS)
    title = r"array_to_string(list_transform(regexp_extract_all(x, '\p{L}+|\P{L}+'), lambda p: upper(p[1]) || lower(p[2:])), '')"
    return rf"SELECT p_partkey, trim(regexp_replace(CASE WHEN upper(x) IN ({known}) THEN upper(x) ELSE {title} END, '\s+', ' ', 'g')) AS club FROM (SELECT p_partkey, {x} AS x FROM (SELECT p_partkey, trim({_TEAM}) AS t FROM part))"


_add("r01_club_name", _t(lambda p: p.select("p_partkey", resolve.club_name(F.expr(_TEAM)).alias("club")), "part"), _club_sql(), base=False)
_add(
    "r07_strip_words",
    _t(lambda p: p.select("p_partkey", logos.strip_words(F.expr(_TEAM)).alias("bare")), "part"),
    rf"SELECT p_partkey, trim(regexp_replace(regexp_replace({_TEAM}, '(?i)\b({'|'.join(logos.WORDS)})\b', '', 'g'), '\s+', ' ', 'g')) AS bare FROM part",
    base=False,
)
#: Pages with marks of platforms, and lines of penalties, in both dialects.
_PAGE = "CASE p_partkey % 7 WHEN 0 THEN '<a href=/CLUBTEAMS/x>' WHEN 1 THEN '<app ng-version=\"9\">' WHEN 2 THEN 'Crossbar LeagueApps' WHEN 3 THEN '<li class=\"theme-nav-item\"> crossbar' WHEN 4 THEN 'la-team angular' WHEN 5 THEN p_name ELSE 'ng-star-inserted' END"
_LINE = "'1st ' || (p_partkey % 13) || ':05 ' || p_name || ' ' || CASE p_partkey % 6 WHEN 0 THEN 'Cross-Checking' WHEN 1 THEN 'Charging, Hooking' WHEN 2 THEN 'high-sticking' WHEN 3 THEN 'High-Sticking' WHEN 4 THEN 'Holding Roughing' ELSE 'Other' END || ' ' || (p_partkey % 9) || ' min'"
_add(
    "s23_platform",
    _t(lambda p: p.select("p_partkey", resolve.platform(F.expr(_PAGE)).alias("platform")), "part"),
    "SELECT p_partkey, CASE " + " ".join(f"WHEN {' OR '.join(f'contains(x, {m!r})' for m in marks)} THEN '{name}'" for name, marks in resolve.PLATFORMS.items()) + f" ELSE 'sportsengine' END AS platform FROM (SELECT p_partkey, lower({_PAGE}) AS x FROM part)",
    base=False,
)
_add(
    "s15_penalty_lines",
    _t(lambda p: documents.penalty_lines(p.select("p_partkey", F.expr(_LINE).alias("line"))).select("p_partkey", "time", "penalty", "minutes"), "part"),
    "SELECT p_partkey, regexp_extract(line, '[0-9]+:[0-9]+') AS time, CASE " + " ".join(f"WHEN contains(line, '{k}') THEN '{k}'" for k in documents.PENALTIES) + f" ELSE 'Unknown' END AS penalty, CAST(p_partkey % 9 AS INTEGER) AS minutes FROM (SELECT p_partkey, {_LINE} AS line FROM part)",
    base=False,
)
_add("r04_jersey_match", _q(lambda x: resolve.match_by_number(players.usual_number(x), players.usual_number(x).withColumn("number", F.floor(F.col("number") / 2) * 2)).select("season_id", "team_id", "player_id", "matched_id")), _USUAL + "SELECT a.season_id, a.team_id, a.player_id, max(b.player_id) AS matched_id FROM us a JOIN (SELECT season_id, team_id, player_id, CAST(floor(number / 2) AS BIGINT) * 2 AS number FROM us) b USING (season_id, team_id, number) GROUP BY ALL")
_add("j15_jaccard", _q(lambda x: _rounded(resolve.roster_overlap(x.goals.select(F.concat_ws("_", "season_id", "team_id").alias("set_id"), "scorer_number"), x.penalties.select(F.concat_ws("_", "season_id", "team_id").alias("set_id"), F.col("player_number").alias("scorer_number")), "set_id", "scorer_number"), "overlap")), ", ga AS (SELECT DISTINCT season_id || '_' || team_id AS set_id, scorer_number AS m FROM goals), pa AS (SELECT DISTINCT season_id || '_' || team_id AS set_id, l_suppkey % 20 + CASE WHEN l_quantity = 1 THEN 50 ELSE 0 END AS m FROM events_ WHERE l_returnflag = 'R'), sh AS (SELECT set_id, count(*) AS n FROM ga JOIN pa USING (set_id, m) GROUP BY ALL), na AS (SELECT set_id, count(*) AS n FROM ga GROUP BY ALL), nb AS (SELECT set_id, count(*) AS n FROM pa GROUP BY ALL) SELECT set_id, round(coalesce(sh.n, 0) / CAST(na.n + nb.n - coalesce(sh.n, 0) AS DOUBLE), 6) AS overlap FROM na JOIN nb USING (set_id) LEFT JOIN sh USING (set_id)")
_add("k08_table_counts", lambda spark, sf_dir: quality.table_counts({n: pseudo.read(spark, sf_dir, n) for n in ("orders", "lineitem", "nation", "part")}), "SELECT 'orders' AS name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'part', count(*) FROM part", base=False)
for _name, _sql in corpus.QUESTIONS.items():
    _add(f"d34_{_name}", lambda spark, sf_dir, q=_name: corpus.ask(spark, sf_dir, q), _sql)
_add("o02_top_spenders", _t(lambda o: o.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"), F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(25).select("o_custkey", "n"), "orders"), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 25", base=False)
_add("d28_rollup", _t(lambda n, c, s: n.select(F.col("n_nationkey").alias("club_id")).join(c.groupBy(F.col("c_nationkey").alias("club_id")).agg(F.count("*").alias("n_customers")), "club_id", "left").join(s.groupBy(F.col("s_nationkey").alias("club_id")).agg(F.count("*").alias("n_suppliers")), "club_id", "left").fillna(0), "nation", "customer", "supplier"), "SELECT n_nationkey AS club_id, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n_customers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS n_suppliers FROM nation", base=False)
_add("f13_page_paths", _t(lambda p: p.select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), F.length(F.parse_url("url", F.lit("PATH"))).cast("long").alias("path_chars")), "pages"), "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, CAST(length(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)) AS BIGINT) AS path_chars FROM pages", base=False)
_LINKS = "'<a href=\"mailto:' || c_name || '@x.org?subject=1\">m</a><a href=\"mailto:' || upper(c_name) || '@X.org\">' || CASE WHEN c_custkey % 3 = 0 THEN '<a href=\"tel:555-' || c_custkey || '\">' ELSE '' END"
_add(
    "s22_contacts",
    _t(lambda c: resolve.contacts(c.select("c_custkey", F.expr(_LINKS).alias("html")), "c_custkey", "html"), "customer"),
    "SELECT c_custkey, 'email' AS kind, least(c_name || '@x.org', upper(c_name) || '@X.org') AS value FROM customer UNION ALL SELECT c_custkey, 'phone', '555-' || c_custkey FROM customer WHERE c_custkey % 3 = 0",
    base=False,
)
_add("t_windowed_events", _t(lambda e: events.windowed_counts(e).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 4).alias("total")), "events"), "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL", base=False)
_add("a20_league_summary", _q(lambda x: directory.league_summary(teams.record(x))), "SELECT season_id, count(DISTINCT division_id) AS n_divisions, count(*) AS n_teams, CAST(round(sum(gp) / 2e0) AS BIGINT) AS n_games FROM record GROUP BY season_id")
_add("a22_box_score_share", _q(lambda x: x.games.join(x.goals.select("game_id").distinct().withColumn("has", F.lit(True)), "game_id", "left").groupBy("season_id").agg(F.count_if("has").alias("with_goals"), F.count("home_score").alias("scored")).withColumn("share", directory.share_text(F.col("with_goals"), F.col("scored")))), "SELECT *, CASE WHEN scored = 0 THEN 'N/A' ELSE printf('%.1f%%', with_goals * 100e0 / scored) END AS share FROM (SELECT season_id, CAST(count_if(h) AS BIGINT) AS with_goals, count(home_score) AS scored FROM games LEFT JOIN (SELECT DISTINCT game_id, true AS h FROM goals) USING (game_id) GROUP BY season_id)")
_add("t06_schedule_changes", _q(lambda x: changes.schedule_changes(x.games.where("game_id % 11 <> 0").withColumn("status", F.when(F.col("game_id") % 7 == 0, "scheduled").otherwise(F.col("status"))), x.games, "1997-03-01")), "SELECT *, new_games + status_changes AS updated FROM (SELECT CAST(count_if(game_id % 11 = 0) AS BIGINT) AS new_games, abs(CAST(count_if(status = 'final') AS BIGINT) - CAST(count_if(status = 'final' AND game_id % 11 <> 0 AND game_id % 7 <> 0) AS BIGINT)) AS status_changes FROM games)")
for _module in (clubs, captures, stores, lookups, resolving):
    for _name, _make in _module.QUERIES.items():
        _add(_name, _make, _module.ORACLE[_name], base=_name in getattr(_module, "BASED", ()))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["d19_standings"](spark, sf_dir)
