"""Queries of lookups, nested answers and logo tables, with SQL for comparison.

Clubs are nations, their teams suppliers, their players customers, their coaches and contacts parts, their games orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import answers, logos
from ..sources import pseudo, scratch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, make, sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: make(_club(spark, sf_dir))
    ORACLE[name] = f"WITH {_WITH}\n{sql}"


# Tables of a club's directory as SQL that both engines read.
_SOURCES = {
    "clubs": "SELECT n_nationkey AS club_id, n_name AS club_name, CASE WHEN n_nationkey % 3 <> 0 THEN 'AB' || n_nationkey END AS abbreviation, 'Town ' || n_regionkey AS town FROM nation",
    "teams": "SELECT s_suppkey AS team_id, s_nationkey AS club_id, s_name AS team_name, CASE s_suppkey % 3 WHEN 0 THEN 'U8' WHEN 1 THEN 'U10' END AS age_group, CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'B' END AS division_level, s_suppkey % 5 <> 0 AS is_active, 'http://t/' || s_suppkey AS team_page_url FROM supplier",
    "players": "SELECT c_custkey AS player_id, c_nationkey AS club_id, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 120 END AS team_id, c_mktsegment AS first_name, c_name AS last_name, CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 30) || CASE WHEN c_custkey % 5 = 0 THEN 'b' ELSE '' END END AS jersey_number FROM customer",
    "coaches": "SELECT p_partkey AS coach_id, p_partkey % 25 AS club_id, p_partkey % 110 AS team_id, p_name AS name FROM part WHERE p_size < 20",
    "contacts": "SELECT p_partkey % 25 AS club_id, p_brand AS contact_type, p_name AS value FROM part WHERE p_size >= 40",
    "games": "SELECT o_orderkey AS game_id, o_custkey % 25 AS club_id, o_custkey % 110 AS team_id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS date, o_orderpriority AS time, CASE o_orderstatus WHEN 'F' THEN 'final' ELSE 'scheduled' END AS status FROM orders",
}
_WITH = ", ".join(f"{n} AS ({q})" for n, q in _SOURCES.items())


def _club(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    names = ["nation", "supplier", "customer", "part", "orders"]
    tables = {n: pseudo.read(spark, sf_dir, n) for n in names}
    bind = lambda q: q.rsplit("FROM ", 1)[0] + "FROM {" + q.rsplit("FROM ", 1)[1].split(" ")[0] + "} " + " ".join(q.rsplit("FROM ", 1)[1].split(" ")[1:])
    return {n: spark.sql(bind(q), **tables) for n, q in _SOURCES.items()}


_COUNTED = ["teams", "players", "coaches", "games", "contacts"]
_add(
    "d28_club_detail",
    lambda x: answers.club_detail(x["clubs"], {n[:-1] if n != "coaches" else "coach": x[n] for n in _COUNTED}),
    "SELECT *, " + ", ".join(f"(SELECT count(*) FROM {n} x WHERE x.club_id = clubs.club_id) AS {'coach' if n == 'coaches' else n[:-1]}_count" for n in _COUNTED) + " FROM clubs",
)
_add(
    "d29_team_with_roster",
    lambda x: answers.team_with_roster(x["teams"], x["players"], x["coaches"]).select("team_id", "n_players", "n_coaches", F.array_join(F.transform("players", lambda p: p["last_name"]), ",").alias("players"), F.array_join(F.transform("coaches", lambda p: p["coach_id"].cast("string")), ",").alias("coaches")),
    """
SELECT t.team_id, coalesce(p.n, 0) AS n_players, coalesce(c.n, 0) AS n_coaches, coalesce(p.x, '') AS players, coalesce(c.x, '') AS coaches FROM teams t
LEFT JOIN (SELECT team_id, count(*) AS n, string_agg(last_name, ',' ORDER BY coalesce(CAST(nullif(regexp_extract(jersey_number, '^[0-9]+'), '') AS INTEGER), 0), last_name, first_name, player_id) AS x FROM players GROUP BY team_id) p USING (team_id)
LEFT JOIN (SELECT team_id, count(*) AS n, string_agg(coach_id, ',' ORDER BY name, coach_id) AS x FROM coaches GROUP BY team_id) c USING (team_id)
""",
)
_add("d29_find_clubs", lambda x: answers.find_clubs(x["clubs"], "b1").select("club_id", "club_name"), "SELECT club_id, club_name FROM clubs WHERE club_name ILIKE '%b1%' OR abbreviation ILIKE '%b1%' OR town ILIKE '%b1%'")
_add(
    "d29_player_search",
    lambda x: answers.club_players(x["players"], x["teams"], x["clubs"], name="ing cust", club="AB1").select("player_id", "club_name", "club_abbreviation", "team_name"),
    "SELECT player_id, club_name, abbreviation AS club_abbreviation, team_name FROM players JOIN clubs USING (club_id) LEFT JOIN teams USING (team_id) WHERE first_name || ' ' || last_name ILIKE '%ing cust%' AND (club_name ILIKE '%ab1%' OR abbreviation ILIKE '%ab1%')",
)
_add(
    "d29_club_lists",
    lambda x: answers.club_teams(x["teams"], 3).select(F.lit("team").alias("kind"), F.col("team_name").alias("name")).union(answers.club_coaches(x["coaches"], x["teams"], 3).select(F.lit("coach"), F.concat_ws("/", "name", "team_page_url"))).union(answers.club_contacts(x["contacts"], 3).select(F.lit("contact"), "value")).union(answers.club_games(x["games"], 3, 28, "final").select(F.lit("game"), "date")),
    """
SELECT 'team' AS kind, team_name AS name FROM teams WHERE is_active AND club_id = 3 UNION ALL SELECT 'coach', concat_ws('/', name, team_page_url) FROM coaches LEFT JOIN teams USING (team_id) WHERE coaches.club_id = 3
UNION ALL SELECT 'contact', value FROM contacts WHERE club_id = 3 UNION ALL SELECT 'game', date FROM games WHERE club_id = 3 AND team_id = 28 AND status = 'final'
""",
)
_add(
    "k09_page_after",
    lambda x: answers.page_after(answers.players(x["players"].withColumnsRenamed({"first_name": "division"}), division="BUILDING"), ["team_id", "last_name"], 40, (17, "Customer#000000137")).select("player_id", "team_id", "last_name", "place", "has_more"),
    "SELECT player_id, team_id, last_name, place, n > 40 AS has_more FROM (SELECT *, row_number() OVER (ORDER BY team_id NULLS FIRST, last_name) AS place, count(*) OVER () AS n FROM players WHERE first_name = 'BUILDING' AND (team_id > 17 OR (team_id = 17 AND last_name > 'Customer#000000137'))) WHERE place <= 40",
)
_add(
    "k09_envelope",
    lambda x: answers.envelope(x["players"].where("club_id = 4"), "players", [F.asc("last_name"), F.asc("player_id")], 20, 10).select(F.array_join(F.transform("players", lambda p: p["player_id"].cast("string")), ",").alias("players"), "pagination.*"),
    "SELECT string_agg(player_id, ',' ORDER BY place) AS players, any_value(n) AS total, CAST(20 AS INTEGER) AS \"limit\", CAST(10 AS INTEGER) AS \"offset\", any_value(n) > 10 + count(*) AS has_more FROM (SELECT *, row_number() OVER (ORDER BY last_name, player_id) AS place, count(*) OVER () AS n FROM players WHERE club_id = 4) WHERE place BETWEEN 11 AND 30",
)
_AT = "TIMESTAMP '2024-01-10 12:00:00'"


def _league(query):
    """Evaluations and events of a league, from the stream of events."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = pseudo.read(spark, sf_dir, "events")
        events = e.selectExpr("event_id", "event_type AS title", "ts AS start_time", "CAST(NULL AS TIMESTAMP_NTZ) AS end_time", "user_id % 9 AS team_id")
        marks = e.selectExpr("event_id AS evaluation_id", "user_id AS player_id", "ts AS created_at", "event_type AS tryout_color", "CAST(floor(value) AS BIGINT) AS total_score")
        return query(events, marks, F.expr("TIMESTAMP_NTZ '2024-01-10 12:00:00'"))

    return run


QUERIES["d29_schedule"] = _league(lambda events, marks, at: answers.schedule_items(events, at, 2, 4).select("id", "title", "team_id", "status").union(answers.schedule_items(events, at, None, 5).select("id", "title", "team_id", F.lit("today"))).union(answers.team_schedule(events, 6, at).select(F.col("event_id").cast("string"), "title", "team_id", F.lit("later"))))
ORACLE["d29_schedule"] = f"""
WITH e AS (SELECT event_id, event_type AS title, ts, user_id % 9 AS team_id FROM events)
SELECT 'event_' || event_id AS id, title, team_id, 'scheduled' AS status FROM e WHERE team_id = 4 AND ts BETWEEN {_AT} AND {_AT} + INTERVAL 2 DAY
UNION ALL SELECT 'event_' || event_id, title, team_id, 'today' FROM e WHERE team_id = 5 AND CAST(ts AS DATE) = DATE '2024-01-10'
UNION ALL SELECT CAST(event_id AS VARCHAR), title, team_id, 'later' FROM e WHERE team_id = 6 AND ts >= {_AT}
"""
QUERIES["d29_evaluations"] = _league(lambda events, marks, at: answers.player_with_evaluations(marks.select("player_id").distinct(), answers.evaluations(marks, min_score=20)).select("player_id", "n_evaluations", F.array_join(F.transform("evaluations", lambda m: m["evaluation_id"].cast("string")), ",").alias("newest")))
ORACLE["d29_evaluations"] = """
WITH m AS (SELECT event_id, user_id AS player_id, ts, CAST(floor(value) AS BIGINT) AS s FROM events)
SELECT player_id, count(event_id) FILTER (WHERE s >= 20) AS n_evaluations, coalesce(string_agg(event_id, ',' ORDER BY ts DESC, event_id) FILTER (WHERE s >= 20), '') AS newest FROM m GROUP BY player_id
"""

# Names of which no two are alike, and the forms in which they are asked for.
_WORD = "translate(substr(md5(CAST(s_suppkey AS STRING)), 1, 12), '0123456789abcdef', 'ghijklmnopqrstuv')"
_FILES = f"SELECT substr({_WORD}, 1, 5) || '_' || substr({_WORD}, 6) || CASE WHEN s_suppkey % 6 = 1 THEN '.txt' ELSE '.svg' END AS file FROM supplier WHERE s_suppkey % 3 <> 0"
_TEAMS = f"SELECT {_WORD} || ' Blue U10B' AS team_name, s_suppkey AS team_id, CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE 'http://l/' || s_suppkey END AS logo_url FROM supplier WHERE s_suppkey % 4 <> 0"
_MANUAL = f"SELECT 'By hand, ' || {_WORD} AS alias, substr({_WORD}, 1, 5) || '_' || substr({_WORD}, 6) || '.svg' AS file FROM supplier WHERE s_suppkey % 5 = 0"
_ASKED = f"SELECT CASE WHEN s_suppkey % 4 = 0 THEN {_WORD} ELSE {_WORD} || ' Blue U10B' END AS team_name, CASE s_suppkey % 4 WHEN 1 THEN s_suppkey WHEN 3 THEN s_suppkey + 100000 END AS team_id FROM supplier UNION ALL SELECT 'By hand, ' || {_WORD}, NULL FROM supplier WHERE s_suppkey % 5 = 0"


def _logos(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = pseudo.read(spark, sf_dir, "supplier")
        ask = lambda q: spark.sql(q.replace("FROM supplier", "FROM {s}"), s=s)
        return query(logos.build(ask(_FILES), ask(_TEAMS), ask(_MANUAL)), ask(_ASKED))

    return run


_BUILT = f"""
WITH files AS ({_FILES}), teams AS ({_TEAMS}), manual AS ({_MANUAL}), asked AS ({_ASKED}), f AS (
  SELECT replace(split_part(file, '.', 1), '_', '') AS canonical_name, file FROM files WHERE file LIKE '%.svg'
), t AS (
  SELECT split_part(team_name, ' ', 1) AS canonical_name, * FROM teams WHERE logo_url <> ''
), l AS (
  SELECT canonical_name, f.file AS local_file, t.logo_url, CASE WHEN file IS NOT NULL AND logo_url IS NOT NULL THEN 'both' WHEN file IS NOT NULL THEN 'local' ELSE 'league' END AS source FROM f FULL JOIN t USING (canonical_name)
), a AS (
  SELECT team_name, team_id, canonical_name, false AS is_manual FROM t UNION ALL SELECT alias, NULL, canonical_name, true FROM manual JOIN f USING (file)
)
"""
QUERIES["r10_logo_tables"] = _logos(lambda built, asked: built[0].select("canonical_name", "local_file", "logo_url", "source", "is_league"))
ORACLE["r10_logo_tables"] = _BUILT + "SELECT *, false AS is_league FROM l"
QUERIES["r10_aliases_and_coverage"] = _logos(lambda built, asked: built[1].select("team_name", "team_id", "canonical_name", "confidence", "is_manual").unionByName(logos.statistics(*built).select(F.col("counter").alias("team_name"), F.col("n").alias("team_id")), allowMissingColumns=True))
ORACLE["r10_aliases_and_coverage"] = (
    _BUILT
    + """
SELECT team_name, team_id, canonical_name, 1e0 AS confidence, is_manual FROM a
UNION ALL SELECT 'total_logos', count(*), NULL, NULL, NULL FROM l UNION ALL SELECT 'with_local', count(local_file), NULL, NULL, NULL FROM l UNION ALL SELECT 'with_league', count(logo_url), NULL, NULL, NULL FROM l
UNION ALL SELECT 'with_both', count_if(source = 'both'), NULL, NULL, NULL FROM l UNION ALL SELECT 'total_aliases', count(*), NULL, NULL, NULL FROM a UNION ALL SELECT 'manual_overrides', count_if(is_manual), NULL, NULL, NULL FROM a
"""
)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """The table as it is kept: written and read again."""
    to = scratch.folder(df.sparkSession, label)
    df.write.parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)


QUERIES["r11_logo_lookup"] = _logos(lambda built, asked: logos.lookup(asked, _stored(built[0], "logos"), _stored(built[1], "aliases")))
ORACLE["r11_logo_lookup"] = (
    _BUILT
    + """
, x AS (
  SELECT q.team_name, q.team_id, CASE WHEN a.canonical_name IS NOT NULL THEN 'alias' WHEN k.canonical_name IS NOT NULL THEN 'canonical' ELSE 'none' END AS how, coalesce(a.canonical_name, k.canonical_name) AS canonical_name
  FROM asked q LEFT JOIN a ON a.team_name = q.team_name AND (q.team_id IS NULL OR a.team_id = q.team_id) LEFT JOIN l k ON k.canonical_name = split_part(q.team_name, ' ', 1)
)
SELECT x.team_name, x.team_id, local_file, logo_url, CASE how WHEN 'alias' THEN 1e0 WHEN 'canonical' THEN 0.9e0 END AS confidence, coalesce(source, 'none') AS source, how FROM x LEFT JOIN l USING (canonical_name)
"""
)
_KEYS, _PATTERNS = {"building": "b.svg", "auto": "a.svg"}, {r"house\w*": "h.svg", "BUILD|mach": "m.svg"}
QUERIES["r12_picture"] = lambda spark, sf_dir: pseudo.read(spark, sf_dir, "customer").select("c_custkey", logos.picture(F.expr("CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END"), _KEYS, _PATTERNS).alias("picture"))
ORACLE["r12_picture"] = "SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'b.svg' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'a.svg' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'h.svg' WHEN c_mktsegment = 'MACHINERY' THEN 'm.svg' END AS picture FROM customer"
