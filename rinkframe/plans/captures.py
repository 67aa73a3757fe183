"""Queries of captured pages and files, with SQL for comparison.

Pages and files are made from the driver's tables; what they hold changes from row to row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import captured, club_files, documents, pages, pseudo, scratch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, make, sql: str) -> None:
    QUERIES[name] = make
    ORACLE[name] = sql


def _pages(make, html: str):
    return lambda spark, sf_dir: make(pseudo.read(spark, sf_dir, "pages").select("page_id", F.expr(html).alias("html")))


def _row(*cells: str, tag: str = "td", attrs: str = "''") -> str:
    return f"'<tr' || {attrs} || '>' || " + " || ".join(f"'<{tag}>' || {c} || '</{tag}>'" for c in cells) + " || '</tr>'"


def _team(name: str) -> str:
    return f"'<a class=\"teamName\" href=\"/t\"> ' || {name} || ' </a>'"


# Games: two rows a page, of which the second has too few cells on odd pages; ids come again every 700 pages.
_DIVISION = "(page_id % 9) || 'A - Bears'"
_SCORE = "CASE WHEN page_id % 3 = 0 THEN '-' ELSE '' || page_id % 4 END"
_STATUS = "CASE page_id % 3 WHEN 0 THEN '7:15 PM EST' ELSE 'Final' END"
_GAMES = (
    "'<html><title>Games 1/' || (page_id % 28 + 1) || '/2024</title><table class=\"nav\"><tr><td>x</td></tr></table><table class=\"statTable wide\"><thead><tr><th>V</th></tr></thead><tbody>' || "
    + _row(_team(_DIVISION), "' ' || (page_id % 5)", _team("'Foxes ' || page_id % 11"), _SCORE, "'Rink &amp; ' || page_id % 6", _STATUS, "'<a href=\"/game/show/' || page_id || '\">box</a>'", attrs="' id=\"game_list_row_' || page_id % 700 || '\"'")
    + " || "
    + "CASE WHEN page_id % 2 = 0 THEN "
    + _row("'Plain'", "'-'", "'Other'", "'-'", "''", "'TBD'")
    + " ELSE '<tr><td>few</td></tr>' END || '</tbody></table><table class=\"statTable\"><tr><td>later</td>'"
)
_add(
    "s12_game_rows",
    _pages(lambda p: pages.first_seen(pages.game_rows(p, "https://l.org"), ["page_id", "place"]).select("page_id", "place", "game_id", "date", "time", "visitor_team", "home_team", "visitor_score", "home_score", "location", "status", "division", "game_url"), _GAMES),
    f"""
SELECT page_id, CAST(0 AS INTEGER) AS place, CAST(page_id % 700 AS VARCHAR) AS game_id, '1/' || (page_id % 28 + 1) || '/2024' AS date, CASE WHEN page_id % 3 = 0 THEN '7:15 PM EST' ELSE '' END AS time,
  {_DIVISION} AS visitor_team, 'Foxes ' || page_id % 11 AS home_team, CAST(page_id % 5 AS VARCHAR) AS visitor_score, nullif({_SCORE}, '-') AS home_score, 'Rink & ' || page_id % 6 AS location,
  {_STATUS} AS status, page_id % 9 || 'A' AS division, 'https://l.org/game/show/' || page_id AS game_url
FROM pages QUALIFY row_number() OVER (PARTITION BY page_id % 700 ORDER BY page_id) = 1
UNION ALL
SELECT page_id, 1, '', '1/' || (page_id % 28 + 1) || '/2024', '', 'Plain', 'Other', NULL, NULL, '', 'TBD', NULL, '' FROM pages WHERE page_id % 2 = 0
""",
)

# Period scores: the first table lacks numbers on every third page, so that the next one counts; the order of periods changes.
_HOME2 = "CASE WHEN page_id % 4 = 0 THEN 'x' ELSE '' || page_id % 6 END"
_PERIODS = (
    "'<table class=\"boxscore\"><thead>' || CASE WHEN page_id % 3 = 0 THEN "
    + _row("'Team'", "'1'", tag="th")
    + " ELSE "
    + _row("'Team'", "'2'", "'1'", "'OT'", "'T'", tag="th")
    + " END || '</thead><tbody>' || "
    + _row("'V'", "'' || page_id % 5", "'1'", "CASE WHEN page_id % 2 = 0 THEN '1' ELSE '-' END", "'9'")
    + " || "
    + _row("'H'", _HOME2, "'' || page_id % 7", "'0'", "'9'")
    + " || '</tbody></table><table class=\"statTable\"><thead>' || "
    + _row("''", "'3'", "'Total'", tag="th")
    + " || '</thead>' || CASE WHEN page_id % 5 = 0 THEN "
    + _row("'Goals'", "'8'", "'8'")
    + " ELSE "
    + _row("'<b>Shots</b> of V'", "'' || page_id % 30", "CASE WHEN page_id % 2 = 0 THEN '31' ELSE '' END")
    + " END || "
    + _row("'H'", "'4'", "'5'")
    + " || '</table>'"
)
_add(
    "s13_period_scores",
    _pages(lambda p: pages.game_details(p).select("page_id", *[F.expr(f"period_scores['{k}'].{s}").alias(f"{s}_{k}") for k in ("1st", "2nd", "3rd", "OT") for s in ("visitor", "home")]), _PERIODS),
    """
SELECT page_id, CAST(CASE WHEN page_id % 3 <> 0 THEN 1 END AS INTEGER) AS visitor_1st, CAST(CASE WHEN page_id % 3 <> 0 THEN page_id % 7 END AS INTEGER) AS home_1st,
  CAST(CASE WHEN page_id % 3 <> 0 AND page_id % 4 <> 0 THEN page_id % 5 END AS INTEGER) AS visitor_2nd, CAST(CASE WHEN page_id % 3 <> 0 AND page_id % 4 <> 0 THEN page_id % 6 END AS INTEGER) AS home_2nd,
  CAST(CASE WHEN page_id % 15 = 0 THEN 3 WHEN page_id % 3 = 0 THEN 3 END AS INTEGER) AS visitor_3rd, CAST(CASE WHEN page_id % 15 = 0 THEN 8 WHEN page_id % 3 = 0 THEN page_id % 30 END AS INTEGER) AS home_3rd,
  CAST(CASE WHEN page_id % 3 <> 0 AND page_id % 2 = 0 THEN 1 END AS INTEGER) AS "visitor_OT", CAST(CASE WHEN page_id % 3 <> 0 AND page_id % 2 = 0 THEN 0 END AS INTEGER) AS "home_OT"
FROM pages
""",
)
_add(
    "s16_shots",
    _pages(lambda p: pages.game_details(p).select("page_id", F.expr("shots_on_goal['3rd']").alias("third"), F.expr("shots_on_goal['total']").alias("total"), F.size("shots_on_goal").alias("n")), _PERIODS),
    "SELECT page_id, CAST(CASE WHEN page_id % 5 <> 0 THEN page_id % 30 END AS INTEGER) AS third, CAST(CASE WHEN page_id % 5 <> 0 AND page_id % 2 = 0 THEN 31 END AS INTEGER) AS total, CAST(CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 2 = 0 THEN 2 ELSE 1 END AS INTEGER) AS n FROM pages",
)

# Statistics: three orders of headers, bad numbers, names with and without a link.
_NAME = "CASE page_id % 4 WHEN 0 THEN '<a class=\"playerName\"> P <i>' || page_id || '</i></a>' WHEN 1 THEN 'Player ' || page_id WHEN 2 THEN '' ELSE 'xy' END"
_CLUB = "CASE page_id % 2 WHEN 0 THEN " + _team("'8B - Club ' || page_id % 13") + " ELSE 'Club' END"
_GOALS, _PIM = "'' || page_id % 17", "CASE page_id % 3 WHEN 0 THEN '' || page_id % 40 WHEN 1 THEN '2.0' ELSE '' END"


def _ordered(headers: dict[str, str]) -> str:
    """A table of one row whose columns begin at another one from page to page."""
    names, n = list(headers), len(headers)
    turns = [[*names[k:], *names[:k]] for k in range(n)]
    of = lambda t: f"'<table class=\"statTable\"><thead>' || {_row(*[repr(x) for x in t], tag='th')} || '</thead><tbody>' || {_row(*[headers[x] for x in t])} || '</tbody></table>'"
    return f"CASE page_id % {n} " + " ".join(f"WHEN {k} THEN {of(t)}" for k, t in enumerate(turns)) + " END"


_STATS = _ordered({"Player": _NAME, "G": "'0'", "Goals": _GOALS, "PIM": _PIM, "+/-": "'-' || page_id % 3"})
_add(
    "s17_player_stats",
    _pages(lambda p: pages.player_stat_rows(p).select("page_id", "name", "team", "division", "goals", "penalty_minutes", "plus_minus", "points"), "CASE WHEN page_id % 6 = 5 THEN '<table class=\"statTable\"><tbody><tr><td>no head</td><td>a</td><td>b</td></tr></tbody></table>' ELSE " + _STATS + " END"),
    # Only the first three cells can hold a name, so that depends on where the columns begin.
    """
WITH p AS (
  SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'P' || page_id WHEN 1 THEN 'Player ' || page_id END AS own, CASE page_id % 3 WHEN 0 THEN page_id % 40 ELSE 0 END AS pim, page_id % 17 AS g, (5 - page_id % 5) % 5 AS spot
  FROM pages WHERE page_id % 6 <> 5
), n AS (
  -- The other texts that are longer than two characters and no digits: bad minutes before the name, or after a name that is none.
  SELECT *, CASE WHEN page_id % 3 = 1 THEN (3 - page_id % 5 + 5) % 5 END AS bad FROM p
), m AS (
  SELECT *, CASE WHEN own IS NOT NULL AND spot < 3 AND (bad IS NULL OR bad > spot) THEN own WHEN bad < 3 THEN '2.0' END AS name FROM n
)
SELECT page_id, name, 'Unknown' AS team, CAST(NULL AS VARCHAR) AS division, CAST(g AS INTEGER) AS goals, CAST(pim AS INTEGER) AS penalty_minutes, CAST(-(page_id % 3) AS INTEGER) AS plus_minus, CAST(0 AS INTEGER) AS points FROM m WHERE name IS NOT NULL
""",
)
_STANDINGS = "CASE WHEN page_id % 4 = 0 THEN '<h3>Gold <b>' || page_id % 5 || '</b></h3>' ELSE '' END || " + _ordered({"Club": _CLUB, "W": "'' || page_id % 9", "L": "'3'", "OTL": "'' || page_id % 2", "Record": "CASE WHEN page_id % 6 = 0 THEN '9-9-9' ELSE '' END"})
_add(
    "s18_standings",
    _pages(lambda p: pages.standing_rows(p.where("page_id % 5 = 0")).select("page_id", "team_name", "team_abbrev", "division", "wins", "losses", "ties", "record"), _STANDINGS),
    """
SELECT page_id, CASE page_id % 2 WHEN 0 THEN '8B - Club ' || page_id % 13 ELSE 'Club' END AS team_name,
  CAST(page_id % 9 AS VARCHAR) AS team_abbrev, CASE WHEN page_id % 4 = 0 THEN 'Gold' || page_id % 5 WHEN page_id % 2 = 0 THEN '8B' END AS division,
  CAST(page_id % 9 AS INTEGER) AS wins, CAST(3 AS INTEGER) AS losses, CAST(page_id % 2 AS INTEGER) AS ties, CASE WHEN page_id % 6 = 0 THEN '9-9-9' ELSE (page_id % 9) || '-3-' || (page_id % 2) END AS record
FROM pages WHERE page_id % 5 = 0
""",
)
_add(
    "s19_calendar",
    _pages(
        lambda p: pages.calendar_dates(p, "https://l.org/x").select("page_id", "place", "day", "url"),
        "'<ul class=\"games-slider-inner\"><li class=\"a\" id=\"slider_day_2024_0' || (page_id % 9 + 1) || '_15\"><span></span><a href=\"/day/' || page_id || '\">x</a></li><li id=\"slider_day_2024_1_1\"><a href=\"/no\">x</a></li><li id=\"slider_day_2023_12_3' || page_id % 2 || '\">' || CASE WHEN page_id % 3 = 0 THEN '' ELSE '<a href=\"day?p=1\">y</a>' END || '</li></ul><li id=\"slider_day_2024_01_01\"><a href=\"/no\">'",
    ),
    "SELECT page_id, CAST(0 AS INTEGER) AS place, '2024_0' || (page_id % 9 + 1) || '_15' AS day, 'https://l.org/day/' || page_id AS url FROM pages UNION ALL SELECT page_id, 2, '2023_12_3' || page_id % 2, 'https://l.org/day?p=1' FROM pages WHERE page_id % 3 <> 0",
)
_ROSTER = (
    "CASE WHEN page_id % 3 = 0 THEN '<table><thead>' || "
    + _row("'Pos.'", "'Player Name'", "'Number'", "'USAH #'", tag="th")
    + " || '</thead><tbody>' || "
    + _row("CASE WHEN page_id % 2 = 0 THEN 'LW' ELSE 'Wing' END", "'<a href=\"/p/' || page_id || '\"> Al B</a> Jr'", "CASE WHEN page_id % 4 = 0 THEN '12a' ELSE '' || page_id % 99 END", "'u' || page_id")
    + " || "
    + _row("'G'", "''", "'1'", "''")
    + " || '</tbody></table>' WHEN page_id % 3 = 1 THEN '<table>' || "
    + _row("'7'", "'Cy  D ' || page_id", "'D'")
    + " || "
    + _row("'8'", "'img'", "'Eve'", "'F'")
    + " || '</table>' ELSE '<table><thead>' || "
    + _row("'#'", "'Position'", tag="th")
    + " || '</thead>' || "
    + _row("'9'", "'C'", "'<a>99</a>'", "'<a href=\"q\">Fay ' || page_id || '</a>'")
    + " || '</table>' END"
)
_add(
    "s20_roster_rows",
    _pages(lambda p: pages.roster_rows(p, F.lit("https://c.org/a/b")).select("page_id", "place", "name", "first_name", "last_name", "jersey_number", "position", "usah_number", "player_profile_url"), _ROSTER),
    """
SELECT page_id, CAST(0 AS INTEGER) AS place, 'Al B' AS name, 'Al' AS first_name, 'B' AS last_name, CASE WHEN page_id % 4 <> 0 THEN CAST(page_id % 99 AS VARCHAR) END AS jersey_number, CASE WHEN page_id % 2 = 0 THEN 'LW' END AS position, 'u' || page_id AS usah_number, 'https://c.org/p/' || page_id AS player_profile_url FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT page_id, 0, 'Cy  D ' || page_id, 'Cy', 'D ' || page_id, '7', 'D', NULL, NULL FROM pages WHERE page_id % 3 = 1
UNION ALL SELECT page_id, 1, 'Eve', 'Eve', '', '8', 'F', NULL, NULL FROM pages WHERE page_id % 3 = 1
UNION ALL SELECT page_id, 1, 'Fay ' || page_id, 'Fay', CAST(page_id AS VARCHAR), '9', 'C', NULL, 'https://c.org/a/q' FROM pages WHERE page_id % 3 = 2
""",
)
_SCHEDULE = (
    "'<table class=\"statTable\">' || CASE WHEN page_id % 2 = 0 THEN '<tr><th colspan=\"5\">Saturday, January ' || (page_id % 28 + 1) || ', 2024</th></tr>' ELSE '' END || "
    + _row("CASE WHEN page_id % 3 = 0 THEN '@' ELSE '' END", "'<a href=\"/game/show/' || page_id || '\">Foxes ' || page_id || '</a>'", "CASE WHEN page_id % 5 = 0 THEN 'vs' ELSE (page_id % 4) || ' - ' || (page_id % 6) END", "'Hall ' || page_id", "'Town Arena'", "'West Wing'", "'7:15 PM EST'")
    + " || '<tr><td colspan=2>1/9/24</td></tr>' || "
    + _row("'<a>Elks</a>'", "'<a>The Bears A team</a>'", "'Pond'")
    + " || '</table>'"
)
_add(
    "s21_club_schedule",
    _pages(lambda p: pages.club_schedule_rows(p, F.lit("https://c.org/s/"), F.lit("Bears A"), F.lit("Bears")).select("page_id", "date", "opponent", "is_home", "home_score", "away_score", "status", "time", "location", "game_id"), _SCHEDULE),
    """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN strftime(DATE '2024-01-01' + CAST(page_id % 28 AS INTEGER), '%Y-%m-%d') ELSE '' END AS date, 'Foxes ' || page_id AS opponent, page_id % 3 <> 0 AS is_home,
  CAST(CASE WHEN page_id % 5 <> 0 THEN page_id % 6 END AS INTEGER) AS home_score, CAST(CASE WHEN page_id % 5 <> 0 THEN page_id % 4 END AS INTEGER) AS away_score, CASE WHEN page_id % 5 <> 0 THEN 'final' ELSE 'scheduled' END AS status,
  '7:15 PM EST' AS time, 'Town Arena' AS location, CAST(page_id AS VARCHAR) AS game_id FROM pages
UNION ALL SELECT page_id, '2024-01-09', 'Elks', true, NULL, NULL, 'scheduled', '', 'Pond', NULL FROM pages
""",
)


# Directories of clubs: a nation is a club, its customers are players. Some directories lack a file, or have a bad one.
def _club_folder(spark: SparkSession, sf_dir: str) -> str:
    n = pseudo.read(spark, sf_dir, "nation")
    slug = "'club-' || n_nationkey || '/'"
    info = n.selectExpr(f"{slug} || 'club_info.json' AS path", "CASE n_nationkey % 10 WHEN 9 THEN NULL WHEN 8 THEN '{\"club_name\": \"Half\"}' ELSE to_json(named_struct('club_name', n_name, 'club_slug', 'c' || n_nationkey, 'website_url', 'http://c/' || n_nationkey, 'unknown', n_regionkey)) END AS text")
    c = pseudo.read(spark, sf_dir, "customer")
    item = "CASE WHEN c_custkey % 13 = 0 THEN 'a text' WHEN c_custkey % 11 = 0 THEN to_json(named_struct('club_name', 'x', 'team_name', 'y')) ELSE to_json(named_struct('club_name', 'x', 'team_name', c_mktsegment, 'name', c_name, 'jersey_number', c_custkey % 99, 'extra', array(1))) END"
    items = c.selectExpr("c_nationkey AS n_nationkey", "c_custkey", f"{item} AS item").groupBy("n_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", F.when(F.startswith("item", F.lit("{")), F.col("item")).otherwise(F.concat(F.lit('"'), "item", F.lit('"'))).alias("item")))).alias("x"))
    listed = F.concat(F.lit("["), F.array_join("x.item", ",\n"), F.lit("]"))
    players = items.select(F.expr(f"{slug} || 'players.json'").alias("path"), F.when(F.col("n_nationkey") % 10 == 7, F.concat(F.lit("["), listed)).when(F.col("n_nationkey") % 10 == 6, F.lit('{"name": "no list"}')).otherwise(listed).alias("text"))
    to = scratch.folder(spark, "clubs")
    scratch.write_files(info.unionByName(players), to)
    return to


_CLUBS = "n_nationkey % 10 < 8"
_add(
    "s25_club_players",
    lambda spark, sf_dir: club_files.read_list(spark, _club_folder(spark, sf_dir), "players").select("club", "team_name", "name", "jersey_number", "position", "source_url"),
    f"SELECT 'club-' || c_nationkey AS club, c_mktsegment AS team_name, c_name AS name, CAST(c_custkey % 99 AS VARCHAR) AS jersey_number, CAST(NULL AS VARCHAR) AS position, '' AS source_url FROM customer WHERE c_nationkey % 10 < 6 AND c_custkey % 13 <> 0 AND c_custkey % 11 <> 0",
)
_add(
    "s25_clubs_and_bad_files",
    lambda spark, sf_dir: _clubs_and_bad(spark, _club_folder(spark, sf_dir)),
    f"""
SELECT 'club-' || n_nationkey AS club, n_name AS club_name, CAST(CASE WHEN n_nationkey % 10 < 6 THEN (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_custkey % 13 <> 0 AND c_custkey % 11 <> 0) ELSE 0 END AS BIGINT) AS players, CAST(0 AS BIGINT) AS teams, CAST(NULL AS VARCHAR) AS why FROM nation WHERE {_CLUBS}
UNION ALL SELECT 'club-' || n_nationkey, NULL, NULL, NULL, CASE n_nationkey % 10 WHEN 7 THEN 'no JSON' ELSE 'no list' END FROM nation WHERE n_nationkey % 10 IN (6, 7) AND n_nationkey IN (SELECT c_nationkey FROM customer)
UNION ALL SELECT 'club-' || n_nationkey, NULL, NULL, NULL, 'keys are missing' FROM nation WHERE n_nationkey % 10 = 8
""",
)


def _clubs_and_bad(spark: SparkSession, folder: str) -> DataFrame:
    good = club_files.counts(spark, folder).select("club", "club_name", "players", "teams")
    return good.unionByName(club_files.bad_files(spark, folder).select("club", "why"), allowMissingColumns=True)


_add(
    "s26_configuration",
    lambda spark, sf_dir: _configured(pseudo.read(spark, sf_dir, "region")),
    """
SELECT '2025' AS season, 'club ' || r_regionkey AS name, 'http://c/' || r_regionkey AS key FROM region
UNION ALL SELECT '2025', r_name, NULL FROM region UNION ALL SELECT 's' || r_regionkey, 'U8  - ' || r_name, '6' || r_regionkey FROM region
""",
)


def _configured(region: DataFrame) -> DataFrame:
    clubs = region.selectExpr("""'{"season": "2025", "more": {}, "clubs": [{"name": "club ' || r_regionkey || '", "url": "http://c/' || r_regionkey || '", "x": 1}, {"name": "' || r_name || '"}]}' AS value""")
    divisions = region.selectExpr("""'{"season_info": {"season_id": "s' || r_regionkey || '", "title": "t"}, "divisions": {"U8  - ' || r_name || '": "6' || r_regionkey || '"}, "division_count": 1}' AS value""")
    named = club_files.configured_clubs(clubs).select("season", "name", F.col("url").alias("key"))
    return named.unionByName(club_files.configured_divisions(divisions).select(F.col("season_id").alias("season"), F.col("division_name").alias("name"), F.col("division_id").alias("key")))


# Paged schedules: ten suppliers' numbers are divisions, the others pages of ten games, of which some are short and some are absent.
def _paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pseudo.read(spark, sf_dir, "supplier").selectExpr("s_suppkey % 10 AS division", "CAST(floor(s_suppkey / 10) AS BIGINT) * 10 AS page_offset", "CASE WHEN s_suppkey % 41 = 40 THEN NULL WHEN s_suppkey % 37 = 36 THEN 4 ELSE 10 END AS n")
    games = """array_join(transform(sequence(1, n), k -> '{"id": "' || division || '-' || (page_offset + k) || '"}'), ', ')"""
    text = f"""CASE WHEN n IS NOT NULL THEN '{{"days": [{{"date": "2024-01-01", "games": [' || {games} || ']}}, {{"games": [{{"status": "no id"}}]}}]}}' END"""
    to = scratch.folder(spark, "schedules")
    scratch.write_files(s.selectExpr("division || '/' || page_offset || '.json' AS path", f"{text} AS text"), to)
    found = captured.pages(spark, to).where("division in ('1', '2', '3', '4', '5', '6', '7')")
    return captured.whole_pages(found.withColumn("n_games", documents.games_in(F.col("json"))), limit=10, most=500)


_add(
    "s04_paged_schedule",
    lambda spark, sf_dir: _paged(spark, sf_dir).select("division", "page_offset", F.col("n_games").cast("long").alias("n_games")),
    """
WITH p AS (
  SELECT s_suppkey % 10 AS d, CAST(floor(s_suppkey / 10) AS BIGINT) AS k, CASE WHEN s_suppkey % 41 = 40 THEN NULL WHEN s_suppkey % 37 = 36 THEN 4 ELSE 10 END AS n FROM supplier
), e AS (
  SELECT d, min(k) AS last FROM (SELECT d, k + CASE WHEN n IS NULL THEN -1 ELSE 0 END AS k FROM p WHERE n IS DISTINCT FROM 10 UNION ALL SELECT d, min(k) - 1 FROM p GROUP BY d HAVING min(k) > 0 UNION ALL SELECT d, max(k) FROM p GROUP BY d) GROUP BY d
)
SELECT CAST(p.d AS VARCHAR) AS division, k * 10 AS page_offset, CAST(n AS BIGINT) AS n_games FROM p JOIN e USING (d) WHERE n IS NOT NULL AND k <= last AND k <= 50 AND d BETWEEN 1 AND 7
""",
)


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pseudo.read(spark, sf_dir, "supplier")
    box = """'{"home": {"id": "h' || s_nationkey || '", "finalScore": "' || s_suppkey % 6 || '", "roster": {"players": [{"id": "p' || s_suppkey || '", "number": "' || s_suppkey % 99 || '"}]}}}'"""
    to = scratch.folder(spark, "boxes")
    scratch.write_files(s.selectExpr("s_suppkey || '.json' AS path", f"CASE WHEN s_suppkey % 5 <> 0 THEN {box} END AS text"), to)
    found = captured.fetch_documents(s.selectExpr("s_suppkey AS game_id").union(s.selectExpr("-s_suppkey")), to)
    players = documents.box_score_rosters(found).select("game_id", "team_id", "player_id", "number")
    return found.select("game_id", F.col("json").isNotNull().alias("found")).join(players, "game_id", "left")


_add(
    "s09_fetched_box_scores",
    _fetched,
    """
SELECT s_suppkey AS game_id, s_suppkey % 5 <> 0 AS found, CASE WHEN s_suppkey % 5 <> 0 THEN 'h' || s_nationkey END AS team_id, CASE WHEN s_suppkey % 5 <> 0 THEN 'p' || s_suppkey END AS player_id, CAST(CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey % 99 END AS INTEGER) AS number FROM supplier
UNION ALL SELECT -s_suppkey, false, NULL, NULL, NULL FROM supplier
""",
)
