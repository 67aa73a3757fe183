"""Queries of keyed tables, logs, reports and integrity checks, with SQL for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import players, teams
from ..sinks import reports
from ..sinks.tables import KeyedTable
from ..sources import pseudo, scratch

#: Queries; those of BASED need the common table expressions of the pseudo-season.
QUERIES: dict = {}
ORACLE: dict[str, str] = {}
BASED: set[str] = set()


def _add(name: str, make, sql: str, base: bool = False) -> None:
    QUERIES[name] = make
    ORACLE[name] = sql
    if base:
        BASED.add(name)


def _table(spark: SparkSession, label: str, key: list[str], buckets: int = 8) -> KeyedTable:
    return KeyedTable(spark, scratch.folder(spark, label), key, buckets)


_EVENT = "l_orderkey AS game_id, l_linenumber AS seq"


def _appended_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches, of which the first is sent three times; then all of it again."""
    items = pseudo.read(spark, sf_dir, "lineitem")
    one = items.where("l_orderkey % 3 <> 0").selectExpr(*_EVENT.split(", "), "l_suppkey AS scorer", "'one' AS batch")
    two = items.where("l_orderkey % 3 <> 1").selectExpr(*_EVENT.split(", "), "l_partkey AS scorer", "'two' AS batch")
    t = _table(spark, "events", ["game_id", "seq"])
    for rows, run in ((one, "1"), (one, "1"), (one, "2"), (two, "3"), (one.unionByName(two), "4")):
        t.append(rows, run)
    return t.read()


_add(
    "m02_appended_events",
    _appended_events,
    f"SELECT {_EVENT}, min(CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey ELSE l_partkey END) AS scorer, CASE WHEN l_orderkey % 3 <> 0 THEN 'one' ELSE 'two' END AS batch FROM lineitem GROUP BY l_orderkey, l_linenumber",
)


def _issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o, s = (pseudo.read(spark, sf_dir, t) for t in ("customer", "orders", "supplier"))
    numbers = c.where("c_custkey % 4 = 0").selectExpr("c_custkey AS player_id", "'numbers' AS issue_type", "c_mktsegment AS details", "(c_custkey % 5) / 4e0 AS consistency")
    games = o.where("o_orderkey % 9 = 0").selectExpr("o_orderkey AS game_id", "CASE o_orderstatus WHEN 'F' THEN 'no goals' ELSE 'odd' END AS issue_type", "o_orderpriority AS description", "CASE WHEN o_orderkey % 2 = 0 THEN 'critical' ELSE 'warning' END AS severity")
    twice = s.selectExpr("CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS players", "'same' AS issue_type", "s_name AS description")
    return reports.issue_rows(numbers, games, twice)


def _saved_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, issues, at = _table(spark, "issues", ["issue_id"]), _issues(spark, sf_dir), F.lit("2024-01-01 00:00:00")
    for rows, run in ((issues, "a"), (issues, "a"), (issues.where("entity_type = 'game'"), "b"), (issues.where("entity_type = 'game'"), "b")):
        reports.save_issues(t, rows, run, at)
    return t.read().select("run_id", "entity_type", "entity_id", "game_id", "issue_type", "issue_description", "confidence_impact")


_ISSUES = """
WITH i AS (
  SELECT 'player' AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id, CAST(NULL AS VARCHAR) AS game_id, 'numbers' AS issue_type, c_mktsegment AS issue_description, 1 - (c_custkey % 5) / 4e0 AS confidence_impact FROM customer WHERE c_custkey % 4 = 0
  UNION ALL SELECT 'game', CAST(o_orderkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), CASE o_orderstatus WHEN 'F' THEN 'no goals' ELSE 'odd' END, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN 0.5e0 ELSE 0.2e0 END FROM orders WHERE o_orderkey % 9 = 0
  UNION ALL SELECT 'player', CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END, NULL, 'same', s_name, 0.3e0 FROM supplier
)
"""
_add("k04_saved_issues", _saved_issues, _ISSUES + "SELECT 'a' AS run_id, * FROM i UNION ALL SELECT 'b', * FROM i WHERE entity_type = 'game'")


def _logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, issues = _table(spark, "log", ["run_id"], 1), _issues(spark, sf_dir)
    resolved = issues.withColumn("resolved_at", F.when(F.col("entity_id") == "", F.lit("2024-01-01").cast("timestamp")))
    scores = issues.agg(F.round(F.avg("confidence_impact"), 6).alias("overall"))
    for run in ("a", "b", "b"):
        log.append(reports.monitoring_row(run, scores, reports.issue_summary(resolved), F.lit("2024-01-01 00:00:00")), run)
    part = F.from_json("report_data", "overall_statistics struct<overall: double>, issue_summary struct<warning: long, info: long>")
    return log.read().select("run_id", "overall_score", "total_issues", "critical_issues", "resolved_issues", part["issue_summary"]["warning"].alias("warnings"), part["issue_summary"]["info"].alias("infos"), (part["overall_statistics"]["overall"] == F.col("overall_score")).alias("same"))


_add(
    "k05_monitoring_log",
    _logged,
    _ISSUES
    + """
SELECT run_id, round(avg(confidence_impact), 6) AS overall_score, count_if(entity_id <> '') AS total_issues, count_if(entity_id <> '' AND confidence_impact > 0.5) AS critical_issues, count_if(entity_id = '') AS resolved_issues,
  count_if(entity_id <> '' AND confidence_impact BETWEEN 0.2 AND 0.5) AS warnings, count_if(entity_id <> '' AND confidence_impact < 0.2) AS infos, true AS same
FROM i CROSS JOIN (VALUES ('a'), ('b')) AS r(run_id) GROUP BY run_id
""",
)


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four snapshots of a schedule, of which two versions are kept; each row of both with its version."""
    o = pseudo.read(spark, sf_dir, "orders")
    game = lambda status, score: o.selectExpr("o_orderkey AS game_id", f"{status} AS status", f"{score} AS score", "o_orderpriority AS place")
    t = _table(spark, "snapshots", ["game_id"], 32)
    t.merge(game("'scheduled'", "CAST(NULL AS BIGINT)").where("game_id % 5 <> 0"), ["status", "score"])
    t.merge(game("'final'", "o_custkey").where("game_id % 7 = 0"), ["status", "score"])
    t.merge(game("CAST(NULL AS STRING)", "CAST(NULL AS BIGINT)").where("game_id % 11 = 0"), ["status", "score"])
    t.merge(game("'final'", "o_custkey + 1").where("game_id = 7 or game_id = 14"), ["status", "score"])
    t.rotate(2)
    return t.read(2).withColumn("version", F.lit(2)).unionByName(t.read(3).withColumn("version", F.lit(3)))


_add(
    "k06_snapshots",
    _snapshots,
    """
WITH s AS (
  SELECT o_orderkey AS game_id, CASE WHEN o_orderkey % 7 = 0 THEN 'final' WHEN o_orderkey % 5 <> 0 THEN 'scheduled' END AS status, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey END AS score, o_orderpriority AS place
  FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0
)
SELECT *, CAST(2 AS INTEGER) AS version FROM s UNION ALL SELECT game_id, status, score + CASE WHEN game_id IN (7, 14) THEN 1 ELSE 0 END, place, 3 FROM s
""",
)


def _integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The season with broken references: some teams are unknown, some have no statistics, some goals have no game."""
    x = pseudo.league(spark, sf_dir)
    known = x.teams.select("team_id").distinct().where("team_id % 6 <> 5")
    stats = teams.record(x).select("team_id").distinct().where("team_id % 4 <> 3")
    tables = {"games": x.games.where("game_id % 13 <> 0"), "goals": x.goals, "teams": known, "team_stats": stats, "penalties": x.penalties, "divisions": x.teams.where("division_id < 0")}
    return reports.integrity(tables, ["games", "goals", "teams", "team_stats", "penalties", "divisions", "player_stats"])


_add(
    "d32_integrity",
    _integrity,
    """
, g AS (SELECT * FROM games WHERE game_id % 13 <> 0), c AS (
  SELECT 'table games' AS "check", count(*) AS n, 'ok' AS level FROM g UNION ALL SELECT 'table goals', count(*), 'ok' FROM goals UNION ALL SELECT 'table penalties', count(*), 'ok' FROM penalties
  UNION ALL SELECT 'table teams', count(DISTINCT team_id), 'ok' FROM teams WHERE team_id % 6 <> 5 UNION ALL SELECT 'table team_stats', count(DISTINCT team_id), 'ok' FROM teams WHERE team_id % 4 <> 3
  UNION ALL SELECT 'table divisions', 0, 'warning' UNION ALL SELECT 'table player_stats', NULL, 'error'
  UNION ALL SELECT 'orphan_games', count(*), NULL FROM g WHERE home_id % 6 = 5 OR visitor_id % 6 = 5
  UNION ALL SELECT 'orphan_goals', count(*), NULL FROM goals WHERE game_id NOT IN (SELECT game_id FROM g)
  UNION ALL SELECT 'teams_without_stats', count(DISTINCT team_id), NULL FROM (SELECT home_id AS team_id FROM g UNION ALL SELECT visitor_id FROM g) WHERE team_id % 6 <> 5 AND team_id % 4 = 3
)
SELECT "check", n, coalesce(level, CASE WHEN n > 0 THEN 'warning' ELSE 'ok' END) AS level FROM c
""",
    base=True,
)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = pseudo.league(spark, sf_dir)
    season = F.col("season_id") == 1996
    who = players.basic(x).where(season).select(F.col("player_id").alias("name"), F.regexp_extract("player_id", "_(.*)", 1).alias("number"), "g", "a", "pts", "gp")
    table = teams.record(x).where(season).select("team_name", "gp", "w", "l", "t", F.col("points").alias("pts"), "gf", "ga")
    counted = {n: df.where(season) for n, df in (("games", x.games), ("goals", x.goals), ("penalties", x.penalties), ("teams", x.teams))}
    return reports.season_summary(counted, who, table)


_add(
    "k03_season_summary",
    _summary,
    """
, n AS (
  SELECT 'games' AS name, count(*) AS n FROM games WHERE season_id = 1996 UNION ALL SELECT 'goals', count(*) FROM goals WHERE season_id = 1996
  UNION ALL SELECT 'penalties', count(*) FROM penalties WHERE season_id = 1996 UNION ALL SELECT 'teams', count(*) FROM teams WHERE season_id = 1996
), p AS (
  SELECT *, row_number() OVER (ORDER BY pts DESC, g DESC, player_id) AS place FROM players WHERE season_id = 1996
), r AS (
  SELECT *, row_number() OVER (ORDER BY points DESC, w DESC, gd DESC, team_name) AS place FROM record WHERE season_id = 1996
)
SELECT 'records' AS section, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS place, printf('%-20s %6d', name, n) AS line FROM n
UNION ALL SELECT 'scorers', CAST(place AS INTEGER), printf('%2d. #%3s %-25s - %3d pts (%dG, %dA) in %d GP', place, split_part(player_id, '_', 2), player_id, pts, g, a, gp) FROM p WHERE place <= 10
UNION ALL SELECT 'standings', CAST(place AS INTEGER), printf('%-25s %3d %3d %3d %3d %4d %3d %3d', team_name, gp, w, l, t, points, gf, ga) FROM r WHERE place <= 10
""",
    base=True,
)


def _match_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reconciliation's counters as JSON lines."""
    c, s = pseudo.read(spark, sf_dir, "customer"), pseudo.read(spark, sf_dir, "supplier")
    matched = s.selectExpr("CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END AS matched_id", "s_suppkey % 7 = 0 AS skipped")
    who = c.selectExpr("CASE WHEN c_custkey % 5 <> 0 THEN c_custkey END AS matched_id", "c_acctbal", "c_nationkey")
    return reports.report_json(reports.match_report(matched, who, {"goals": F.col("c_acctbal") < 0, "rosters": F.col("c_nationkey") < 5}))


_add(
    "r06_match_report",
    _match_report,
    """
WITH n AS (
  SELECT 'teams_matched' AS c, count_if(s_suppkey % 3 <> 0 AND s_suppkey % 7 <> 0) AS n FROM supplier UNION ALL SELECT 'teams_unmatched', count_if(s_suppkey % 3 = 0 AND s_suppkey % 7 <> 0) FROM supplier
  UNION ALL SELECT 'teams_skipped', count_if(s_suppkey % 7 = 0) FROM supplier UNION ALL SELECT 'players_matched', count_if(c_custkey % 5 <> 0) FROM customer UNION ALL SELECT 'players_unmatched', count_if(c_custkey % 5 = 0) FROM customer
  UNION ALL SELECT 'names_backfilled.goals', count_if(c_acctbal < 0) FROM customer UNION ALL SELECT 'names_backfilled.rosters', count_if(c_nationkey < 5) FROM customer
)
SELECT '{"counter":"' || c || '","n":' || n || '}' AS value FROM n
""",
)


def _written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report written as JSON and read again."""
    o = pseudo.read(spark, sf_dir, "orders")
    report = o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max(F.when(F.col("o_orderkey") < 0, F.col("o_orderkey"))).alias("none"), F.struct(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")).alias("keys"))
    to = scratch.folder(spark, "report")
    reports.write_json(report, to)
    return spark.read.text(to)


_add("k02_written_report", _written_report, """SELECT '{"o_orderpriority":"' || o_orderpriority || '","n":' || count(*) || ',"none":null,"keys":{"low":' || min(o_orderkey) || ',"high":' || max(o_orderkey) || '}}' AS value FROM orders GROUP BY o_orderpriority""")
