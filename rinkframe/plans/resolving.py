"""Queries of matching, monitoring and upserts whose operators had unit tests only, with SQL for comparison."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes, league, logos, monitor, resolve
from ..serving import Serving
from ..sources import documents, pseudo, scratch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
BASED: set[str] = set()


def _add(name: str, make, sql: str, base: bool = False) -> None:
    QUERIES[name] = make
    ORACLE[name] = sql
    if base:
        BASED.add(name)


def _of(make, *tables: str):
    return lambda spark, sf_dir: make(*[pseudo.read(spark, sf_dir, t) for t in tables])


def _league(make):
    return lambda spark, sf_dir: make(pseudo.league(spark, sf_dir))


def _replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasons written once, of which two are then replaced by fewer and other rows."""
    o = pseudo.read(spark, sf_dir, "orders").selectExpr("CAST(year(o_orderdate) AS BIGINT) AS season_id", "o_orderkey", "o_orderstatus AS state")
    to = scratch.folder(spark, "seasons")
    changes.replace_season(o, to)
    changes.replace_season(o.where("season_id in (1994, 1996) and o_orderkey % 3 = 0").withColumn("state", F.lit("new")), to)
    return spark.read.parquet(to).select(F.col("season_id").cast("long").alias("season_id"), "o_orderkey", "state")


_add("k01_replace_season", _replaced, "SELECT CAST(year(o_orderdate) AS BIGINT) AS season_id, o_orderkey, CASE WHEN year(o_orderdate) IN (1994, 1996) THEN 'new' ELSE o_orderstatus END AS state FROM orders WHERE year(o_orderdate) NOT IN (1994, 1996) OR o_orderkey % 3 = 0")

# Issues: orders with an impact, of which some are resolved.
_ISSUE = "o_orderkey AS issue_id, (o_orderkey % 10) / 10e0 AS impact, CAST(o_orderdate AS DATE) AS created_at, CASE WHEN o_orderkey % 4 = 0 THEN CAST('2024-01-01' AS TIMESTAMP) END AS resolved_at, CAST(NULL AS STRING) AS resolved_by, CAST(NULL AS STRING) AS notes"
_LEVEL = "CASE WHEN impact > 0.5 THEN 'critical' WHEN impact >= 0.2 THEN 'warning' ELSE 'info' END"


def _issues(o: DataFrame) -> DataFrame:
    return o.sparkSession.sql(f"SELECT {_ISSUE} FROM {{o}}", o=o)


_add("p13_unresolved", _of(lambda o: monitor.unresolved(_issues(o)).select("issue_id", "severity").union(monitor.unresolved(_issues(o), "critical").select("issue_id", F.lit("only critical"))), "orders"), f"WITH i AS (SELECT {_ISSUE} FROM orders) SELECT issue_id, {_LEVEL} AS severity FROM i WHERE resolved_at IS NULL UNION ALL SELECT issue_id, 'only critical' FROM i WHERE resolved_at IS NULL AND impact > 0.5")
_add(
    "m07_resolve_issue",
    _of(lambda o: monitor.resolve_issue(_issues(o), 7, "me", "done", "2024-05-05 00:00:00").select("issue_id", F.col("resolved_at").cast("date").cast("string").alias("day"), "resolved_by", "notes"), "orders"),
    f"WITH i AS (SELECT {_ISSUE} FROM orders) SELECT issue_id, CASE WHEN issue_id = 7 THEN '2024-05-05' ELSE CAST(CAST(resolved_at AS DATE) AS VARCHAR) END AS day, CASE WHEN issue_id = 7 THEN 'me' END AS resolved_by, CASE WHEN issue_id = 7 THEN 'done' END AS notes FROM i",
)
_add("t05_new_issues", _of(lambda o: monitor.new_issues(_issues(o), o.where("o_orderkey % 50 = 7 and year(o_orderdate) < 1996").selectExpr("CAST(o_orderdate AS DATE) AS run_at")).select("issue_id"), "orders"), "SELECT o_orderkey AS issue_id FROM orders WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderkey % 50 = 7 AND year(o_orderdate) < 1996)")
_add(
    "m06_update_from",
    _of(lambda c, o: changes.update_from(c.selectExpr("c_custkey AS id", "c_nationkey AS goals", "c_name AS name"), o.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("goals")), "id", ["goals"]), "customer", "orders"),
    "SELECT c_custkey AS id, coalesce((SELECT nullif(count(*), 0) FROM orders WHERE o_custkey = c_custkey), c_nationkey) AS goals, c_name AS name FROM customer",
)


# Scores of monitoring: players by orders of customers.
def _players(c: DataFrame) -> DataFrame:
    return monitor.player_scores(c.selectExpr("c_custkey AS player_id", "CASE WHEN c_custkey % 6 = 0 THEN ' ' ELSE c_name END AS name", "c_custkey % 3 AS n_numbers", "c_custkey % 8 AS gp", "c_custkey % 70 AS g", "c_custkey % 50 AS a", "c_custkey % 130 AS pim"))


_SCORED = """
WITH x AS (
  SELECT c_custkey AS id, c_custkey % 3 > 1 AS many, c_custkey % 6 = 0 AS bare, c_custkey % 8 AS gp, c_custkey % 70 + c_custkey % 50 AS pts, c_custkey % 130 > 100 AS fouls FROM customer
), y AS (
  SELECT *, CASE WHEN gp = 0 THEN 0e0 WHEN pts = 0 THEN 0.5e0 ELSE 1e0 END AS complete, least(CASE WHEN pts > 100 THEN 0.3e0 WHEN pts > 50 THEN 0.7e0 ELSE 1e0 END, CASE WHEN gp > 0 AND pts > 10 * gp THEN 0.2e0 ELSE 1e0 END) AS sane FROM x
), z AS (
  SELECT *, round(CASE WHEN many THEN 0.5e0 ELSE 1e0 END * 0.3e0 + CASE WHEN bare THEN 0e0 ELSE 0.2e0 END + complete * 0.2e0 + sane * 0.25e0 + CASE WHEN fouls THEN 0.5e0 ELSE 1e0 END * 0.05e0, 3) AS score FROM y
)
"""
_add(
    "a16_recommendations",
    _of(lambda c: monitor.top_recommendations(_players(c)), "customer"),
    _SCORED
    + """
SELECT recommendation, count(*) AS n FROM (
  SELECT unnest(list_filter([CASE WHEN many THEN 'check numbers' END, CASE WHEN bare THEN 'add name' END, CASE WHEN complete < 1 THEN 'complete statistics' END, CASE WHEN sane < 1 THEN 'review totals' END, CASE WHEN fouls THEN 'review penalties' END], lambda v: v IS NOT NULL)) AS recommendation FROM z WHERE score < 0.7
) GROUP BY ALL ORDER BY n DESC, recommendation LIMIT 10
""",
)
_add(
    "q13_report",
    _of(lambda c, o, n: monitor.report(_players(c), o.selectExpr("(o_orderkey % 5) / 4e0 AS score"), n.where("n_nationkey < 0").selectExpr("1e0 AS score")), "customer", "orders", "nation"),
    _SCORED + ", g AS (SELECT avg((o_orderkey % 5) / 4e0) AS a FROM orders) SELECT round(avg(score), 3) AS player_average, round(any_value(a), 3) AS game_average, 0e0 AS team_average, round((avg(score) + any_value(a) + 0) / 3, 3) AS overall FROM z, g",
)
_add("a14_scores_by_band", _of(lambda c: monitor.histogram(_players(c)), "customer"), _SCORED + "SELECT CASE WHEN score < 0.5 THEN 'poor' WHEN score < 0.8 THEN 'fair' ELSE 'good' END AS band, count(*) AS n FROM z GROUP BY ALL")

# Nested details of games: sums of periods, numbers of goals and missing fields that disagree here and there.
_DETAILS = """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) END AS game_id, CAST(o_orderdate AS STRING) AS date, o_orderpriority AS home_team, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'v' END AS visitor_team,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 4 AS STRING) END AS home_score, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 3 AS STRING) END AS visitor_score,
  CASE WHEN o_orderkey % 7 <> 0 THEN map('1st', named_struct('visitor', CAST(o_orderkey % 3 AS INT), 'home', CAST(NULL AS INT)), '2nd', named_struct('visitor', CAST(o_orderkey % 2 AS INT), 'home', CAST(o_orderkey % 4 AS INT))) END AS period_scores,
  CASE WHEN o_orderkey % 5 <> 0 THEN array_repeat(named_struct('player', 'p'), CAST(o_orderkey % 6 AS INT)) END AS scoring_summary
FROM {orders}
"""
_add(
    "d31_validate_details",
    lambda spark, sf_dir: documents.validate_details(spark.sql(_DETAILS, orders=pseudo.read(spark, sf_dir, "orders"))),
    """
WITH o AS (SELECT *, CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS game_id FROM orders)
SELECT game_id, 'visitor_period_sum' AS error FROM o WHERE o_orderstatus = 'F' AND o_orderkey % 7 <> 0 AND o_orderkey % 2 = 1
UNION ALL SELECT game_id, 'goal_count' FROM o WHERE o_orderstatus = 'F' AND o_orderkey % 5 <> 0 AND o_orderkey % 6 <> o_orderkey % 4 + o_orderkey % 3
UNION ALL SELECT game_id, 'missing_game_id' FROM o WHERE o_orderkey % 50 = 0 UNION ALL SELECT game_id, 'missing_visitor_team' FROM o WHERE o_orderkey % 9 = 0
""",
)

# Structured matches: suppliers are teams whose names end in digits that clubs' patterns ask for.
_CLUBS = "SELECT 'n' || n_nationkey AS club_team, 'U' || (n_nationkey % 5) AS age, CASE WHEN n_nationkey % 3 <> 0 THEN 'B' || n_nationkey % 3 END AS level, CASE WHEN n_nationkey % 4 = 1 THEN 'r#00' ELSE 'R#' || lpad(CAST(n_nationkey AS STRING), 9, '0') END AS pattern FROM nation"
_LISTED = "SELECT s_suppkey AS team_id, s_name AS team_name, 'U' || (s_suppkey % 5) AS age, CASE s_suppkey % 4 WHEN 0 THEN 'b' WHEN 2 THEN 'c' END AS level FROM supplier"


def _structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    ask = lambda q, t: spark.sql(q.replace(f"FROM {t}", "FROM {t}"), t=pseudo.read(spark, sf_dir, t))
    listed = ask(_LISTED, "supplier")
    return resolve.structured_match(ask(_CLUBS, "nation"), listed)


_add(
    "r02_structured_match",
    _structured,
    f"""
WITH c AS ({_CLUBS.replace("AS STRING", "AS VARCHAR")}), t AS ({_LISTED}), h AS (
  SELECT DISTINCT club_team, team_id FROM c JOIN t ON c.age = t.age AND contains(lower(team_name), lower(pattern)) AND coalesce(upper(regexp_replace(c.level, '[0-9]+$', '')) = upper(regexp_replace(t.level, '[0-9]+$', '')), true)
)
SELECT club_team, any_value(team_id) AS team_id FROM h GROUP BY club_team HAVING count(*) = 1
""",
)
# Overlaps: the parts of an order and of the next one that shares its priority, as sets of small numbers.
_add(
    "r03_best_overlap",
    _of(lambda li: resolve.best_overlap(*[li.where(f"l_linenumber {s} 4").selectExpr("l_returnflag AS block", "l_suppkey AS set_id", "l_partkey % 40 AS member") for s in ("<", ">=")], "block", "set_id", "member", least=0.2), "lineitem"),
    """
WITH a AS (SELECT DISTINCT l_returnflag AS block, l_suppkey AS id, l_partkey % 40 AS m FROM lineitem WHERE l_linenumber < 4), b AS (SELECT DISTINCT l_returnflag AS block, l_suppkey AS id, l_partkey % 40 AS m FROM lineitem WHERE l_linenumber >= 4),
na AS (SELECT block, id, count(*) AS n FROM a GROUP BY ALL), nb AS (SELECT block, id, count(*) AS n FROM b GROUP BY ALL), s AS (SELECT a.block, a.id AS left_id, b.id AS right_id, count(*) AS n FROM a JOIN b USING (block, m) GROUP BY ALL),
o AS (SELECT s.block, left_id, right_id, CAST(s.n AS DOUBLE) / (na.n + nb.n - s.n) AS overlap FROM s JOIN na ON na.block = s.block AND na.id = left_id JOIN nb ON nb.block = s.block AND nb.id = right_id WHERE na.n >= 3)
SELECT block, left_id, right_id, overlap FROM o WHERE overlap >= 0.2 QUALIFY row_number() OVER (PARTITION BY block, left_id ORDER BY overlap DESC, right_id) = 1
""",
)

# Names of which no two are alike, so that what is similar to one is known: the name with one letter changed.
_WORD = "translate(substr(md5(CAST(s_suppkey AS STRING)), 1, 12), '0123456789abcdef', 'ghijklmnopqrstuv')"
_TYPED = f"substr({_WORD}, 1, CAST(s_suppkey % 12 AS INT)) || 'a' || substr({_WORD}, CAST(s_suppkey % 12 AS INT) + 2)"
_SQL_WORD, _SQL_TYPED = (x.replace("AS STRING", "AS VARCHAR").replace("AS INT)", "AS INTEGER)") for x in (_WORD, _TYPED))
_add(
    "j14_similar_names",
    _of(lambda s: resolve.fuzzy_match(s.where("s_suppkey % 4 <> 0").selectExpr(f"CASE WHEN s_suppkey % 5 = 0 THEN {_WORD} ELSE {_TYPED} END AS name"), s.where("s_suppkey % 3 <> 0").selectExpr(f"{_WORD} AS other")).select("name", "other", F.round("similarity", 6).alias("similarity")), "supplier"),
    f"SELECT CASE WHEN s_suppkey % 5 = 0 THEN {_SQL_WORD} ELSE {_SQL_TYPED} END AS name, {_SQL_WORD} AS other, CASE WHEN s_suppkey % 5 = 0 THEN 1e0 ELSE round(22e0 / 24, 6) END AS similarity FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0",
)


def _cascade(s: DataFrame) -> DataFrame:
    """Five forms of names against files and aliases, with what the league has itself."""
    form = f"CASE s_suppkey % 5 WHEN 0 THEN 'The ' || {_WORD} WHEN 1 THEN upper({_WORD}) WHEN 2 THEN {_WORD} || ' U12 Gold' WHEN 3 THEN {_TYPED} ELSE 'nobody ' || md5({_WORD}) END"
    found = logos.match(s.selectExpr(f"{form} AS team_name"), s.where("s_suppkey % 3 <> 0").selectExpr(f"{_WORD} AS logo_name", "s_suppkey || '.svg' AS file"), s.selectExpr(f"'the ' || {_WORD} AS alias", "'a' || s_suppkey AS file"))
    return logos.manifest(found, s.where("s_suppkey % 7 = 0").selectExpr(f"{form} AS team_name", "CASE WHEN s_suppkey % 2 = 0 THEN 'http://l' ELSE ' ' END AS logo_url"))


_FORM = f"CASE s_suppkey % 5 WHEN 0 THEN 'The ' || {_SQL_WORD} WHEN 1 THEN upper({_SQL_WORD}) WHEN 2 THEN {_SQL_WORD} || ' U12 Gold' WHEN 3 THEN {_SQL_TYPED} ELSE 'nobody ' || md5({_SQL_WORD}) END"
_CASCADE = f"""
WITH m AS (
  SELECT s_suppkey, {_FORM} AS team_name, CASE WHEN s_suppkey % 5 = 0 THEN 'alias' WHEN s_suppkey % 5 = 4 OR s_suppkey % 3 = 0 THEN 'none' WHEN s_suppkey % 5 = 1 THEN 'name' WHEN s_suppkey % 5 = 2 THEN 'stripped' ELSE 'similar' END AS how FROM supplier
), f AS (
  SELECT *, CASE how WHEN 'alias' THEN 'a' || s_suppkey WHEN 'none' THEN NULL ELSE s_suppkey || '.svg' END AS file, CASE how WHEN 'alias' THEN 1e0 WHEN 'name' THEN 1e0 WHEN 'stripped' THEN 0.95e0 WHEN 'similar' THEN round(22e0 / 24, 3) END AS confidence,
    s_suppkey % 14 = 0 AS there FROM m
)
"""
_add("r07_logo_cascade", _of(lambda s: _cascade(s).select("team_name", "file", "confidence", "how", "found"), "supplier"), _CASCADE + "SELECT team_name, file, confidence, how, CASE WHEN file IS NOT NULL AND there THEN 'both' WHEN file IS NOT NULL THEN 'local' WHEN there THEN 'league' ELSE 'none' END AS found FROM f")
_add("r09_logo_coverage", _of(lambda s: logos.coverage(_cascade(s)), "supplier"), _CASCADE + "SELECT CASE WHEN file IS NOT NULL AND there THEN 'both' WHEN file IS NOT NULL THEN 'local' WHEN there THEN 'league' ELSE 'none' END AS found, count(*) AS n FROM f GROUP BY ALL")


def _searched(s: DataFrame) -> DataFrame:
    import hashlib

    word = hashlib.md5(b"4").hexdigest()[:12].translate(str.maketrans("0123456789abcdef", "ghijklmnopqrstuv"))
    names = s.selectExpr(f"explode(array({_WORD}, upper({_WORD}), {_TYPED})) AS logo_name", "s_suppkey")
    return logos.search(f" {word}! ", names.select("logo_name", F.concat(F.col("s_suppkey").cast("string"), F.lit("/"), F.substring("logo_name", 1, 2)).alias("file")), least=0.85).select("file", F.round("similarity", 6).alias("similarity"))


_add("r08_logo_search", _of(_searched, "supplier"), f"SELECT least('4/' || substr({_SQL_WORD}, 1, 2), '4/' || upper(substr({_SQL_WORD}, 1, 2))) AS file, 1e0 AS similarity FROM supplier WHERE s_suppkey = 4 UNION ALL SELECT '4/' || substr({_SQL_TYPED}, 1, 2), round(22e0 / 24, 6) FROM supplier WHERE s_suppkey = 4")
_add("j07_teams_with_games", _league(lambda x: league.teams_with_games(replace(x, games=x.games.where("home_id % 7 <> 3 and visitor_id % 7 <> 3 and home_id < 20")))), "SELECT * FROM teams t WHERE EXISTS (SELECT 1 FROM games g WHERE g.home_id % 7 <> 3 AND g.visitor_id % 7 <> 3 AND g.home_id < 20 AND g.season_id = t.season_id AND (g.home_id = t.team_id OR g.visitor_id = t.team_id))", base=True)
_DUMP = """'{"' || n_regionkey || '": [{"date": "2024-01-0' || (n_regionkey + 1) || '", "games": [{"id": "' || n_nationkey || '", "homeTeam": {"title": "' || n_name || '"}, "visitor": {"name": "T' || n_nationkey % 6 || '"}}, {"id": "x' || n_nationkey || '", "home": {"title": "T' || n_nationkey % 4 || '"}}, {"id": "y", "status": "none"}]}]}'"""
_add(
    "s11_dump_teams",
    _of(lambda n: documents.schedule_teams(n.select(F.col("n_nationkey").alias("page"), F.expr(_DUMP).alias("json")), "page"), "nation"),
    """
WITH t AS (SELECT n_nationkey AS page, 0 AS place, n_name AS team_name FROM nation UNION ALL SELECT n_nationkey, 1, 'T' || n_nationkey % 6 FROM nation UNION ALL SELECT n_nationkey, 2, 'T' || n_nationkey % 4 FROM nation)
SELECT team_name, page FROM t QUALIFY row_number() OVER (PARTITION BY team_name ORDER BY page, place) = 1
""",
)
_add(
    "k09_served_games",
    _league(lambda x: Serving(x).get("games/{id}", shown={"goals": ["scorer_id"]}).select("season_id", "game_id", "n_goals", "n_penalties", F.array_join(F.transform("goals", lambda g: g["scorer_id"]), ",").alias("scorers"))),
    """
SELECT season_id, game_id, coalesce(n, 0) AS n_goals, coalesce(m, 0) AS n_penalties, coalesce(x, '') AS scorers FROM games
LEFT JOIN (SELECT game_id, count(*) AS n, string_agg(scorer_id, ',' ORDER BY period, scorer_id) AS x FROM goals GROUP BY game_id) USING (game_id) LEFT JOIN (SELECT game_id, count(*) AS m FROM penalties GROUP BY game_id) USING (game_id)
""",
    base=True,
)
_add(
    "k09_served_teams",
    _league(lambda x: Serving(x).get("teams/{id}/roster", id=3, season_id=1996).select("season_id", "team_id", "player_id", "place").union(Serving(x).get("teams/{id}/schedule", id=4, season_id=1995).select("season_id", "team_id", F.col("game_id").cast("string"), F.col("opponent_id")))),
    """
SELECT season_id, team_id, player_id, row_number() OVER (ORDER BY pts DESC, g DESC, player_id) AS place FROM players WHERE season_id = 1996 AND team_id = 3
UNION ALL SELECT season_id, team_id, CAST(game_id AS VARCHAR), opponent_id FROM sides WHERE season_id = 1995 AND team_id = 4
""",
    base=True,
)
