"""Queries of club pages, directories and rosters, with SQL for comparison.

Names, titles and documents are made from the driver's tables by expressions that both
engines read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import core
from ..operators import changes, directory, names, resolve
from ..sources import documents, pseudo

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _add(name: str, make, table: str | list[str], sql: str) -> None:
    tables = [table] if isinstance(table, str) else table
    QUERIES[name] = lambda spark, sf_dir: make(*[pseudo.read(spark, sf_dir, t) for t in tables])
    ORACLE[name] = sql


def _has(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _cases(key: str, texts: list[str]) -> str:
    return f"CASE {key} % {len(texts)} " + " ".join(f"WHEN {k} THEN {t}" for k, t in enumerate(texts)) + " END"


# Forms of texts, as SQL that both engines read.
_TEAM = _cases("p_partkey", ["p_name || ' Squirts A1'", "'Mighty Mites'", "'mite B'", "p_name || ' U10 gold'", "'Pee Wee ' || p_name", "'06ELITE'", "'Coaches'", "p_name || ' Teams'", "'WHK'", "'WHK - ' || p_name", "'Learn to Play'", "'LTP'", "'U9'", "upper(p_name) || ' HIGH SCHOOL c'"])
_TITLE = _cases("p_partkey", ["'Head Coach'", "' asst. coach '", "'Team manager'", "'Director of Hockey'", "''", "p_name", "'ASSISTANT COACH'"])
_PERSON = _cases("p_partkey", ["p_name || ' - Vice President'", "'Treasurer: ' || p_name", "p_name || ' — ' || 'Registrar'", "p_name", "'Director - '", "'A: B - Secretary'"])
_JOINED = _cases("p_partkey", ["'EdwardBourget'", "'EDWARDBOURGET'", "'EDWARD O''NEIL'", "'ED'", "p_name", "'  Ann-MarieSmith '"])
_HEADING = _cases("p_partkey", ["'8U Red'", "'Travel Team Overview 8U'", "'Pee  Wee'", "p_name", "'Skills for coach'", "'Major II'", "'News'", "'House League'", "' Learn to Skate '", "'x'"])
_URL = "url || " + _cases("page_id", ["'/Board/a'", "'/about-us'", "'?coach=1'", "'/Coaches#x'", "'/team'"])
_OFFICE = _cases("c_custkey", ["'Vice President'", "'President'", "'Club secretary'", "'Treasurer'", "'Director'", "'Coordinator'", "'Member'"])

_AGE_RULE = "CASE " + " ".join(f"WHEN starts_with(k, '{n}') THEN {f"'{c}'" if c else 'NULL'}" for n, c in names.AGES.items()) + " END"
_add(
    "f02_ages_and_levels",
    lambda p: p.select("p_partkey", names.age_code(F.expr(_TEAM)).alias("code"), names.age_in(F.expr(_TEAM)).alias("age"), names.level_in(F.expr(_TEAM)).alias("level")),
    "part",
    f"SELECT p_partkey, {_AGE_RULE} AS code, nullif(regexp_extract(t, '{names.AGE}', 1), '') AS age, coalesce(nullif(regexp_extract(t, '{names.LEVEL}', 1), ''), nullif(regexp_extract(t, '{names.LEVEL}', 2), '')) AS level FROM (SELECT p_partkey, t, lower(trim(t)) AS k FROM (SELECT p_partkey, {_TEAM} AS t FROM part))",
)
_add(
    "f13_page_kind",
    lambda p: p.select("page_id", names.page_kind(F.expr(_URL)).alias("kind")),
    "pages",
    f"SELECT page_id, CASE WHEN {_has('p', ['board', 'director'])} THEN 'board page' WHEN {_has('p', ['contact', 'about'])} THEN 'contact page' WHEN contains(p, 'coach') THEN 'coaches page' WHEN p IN ('/', '') THEN 'homepage' ELSE 'page' END AS kind FROM (SELECT page_id, lower(regexp_extract({_URL}, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS p FROM pages)",
)
_TITLED = r"array_to_string(list_transform(regexp_extract_all({x}, '\p{{L}}+|\P{{L}}+'), lambda q: upper(q[1]) || lower(q[2:])), '')"
_add(
    "f23_roles",
    lambda p: p.select("p_partkey", names.coach_role(F.expr(_TITLE)).alias("role"), names.staff_title(F.expr(_TITLE)).alias("title")),
    "part",
    f"SELECT p_partkey, CASE WHEN contains(k, 'head coach') THEN 'Head Coach' WHEN {_has('k', ['asst', 'assistant'])} THEN 'Assistant Coach' WHEN contains(k, 'manager') THEN 'Manager' ELSE 'Coach' END AS role, CASE WHEN k IN ('', 'coach') THEN 'Coach' WHEN k = 'head coach' THEN 'Head Coach' WHEN k IN ('assistant coach', 'asst coach', 'asst. coach') THEN 'Assistant Coach' WHEN k = 'manager' THEN 'Manager' ELSE {_TITLED.format(x='t')} END AS title FROM (SELECT p_partkey, trim({_TITLE}) AS t, lower(trim({_TITLE})) AS k FROM part)",
)


def _split_sql() -> str:
    out = "CASE WHEN length(t) > 120 THEN NULL"
    for sep in names.SEPARATORS:
        a, b = f"trim(split_part(t, '{sep}', 1))", f"trim(substr(t, strpos(t, '{sep}') + {len(sep)}))"
        there = f"contains(t, '{sep}') AND {a} <> '' AND {b} <> ''"
        out += f" WHEN {there} AND {_has(f'lower({b})', names.TITLE_WORDS)} THEN [{a}, {b}] WHEN {there} AND {_has(f'lower({a})', names.TITLE_WORDS)} THEN [{b}, {a}]"
    return out + " END"


_add(
    "f24_name_and_title",
    lambda p: p.select("p_partkey", names.name_and_title(F.expr(_PERSON)).alias("x"), names.joined_name(F.expr(_JOINED)).alias("joined")).select("p_partkey", "x.name", "x.title", "joined"),
    "part",
    f"SELECT p_partkey, x[1] AS name, x[2] AS title, CASE WHEN contains(j, ' ') THEN CASE WHEN capitals THEN {_TITLED.format(x='j')} ELSE j END WHEN len(parts) >= 2 THEN array_to_string(parts, ' ') WHEN capitals AND length(j) > 3 THEN {_TITLED.format(x='j')} ELSE j END AS joined FROM (SELECT p_partkey, {_split_sql()} AS x, j, regexp_extract_all(j, '[A-Z][a-z]+') AS parts, upper(j) = j AND lower(j) <> j AS capitals FROM (SELECT p_partkey, {_PERSON} AS t, trim({_JOINED}) AS j FROM part))",
)
_AGED = f"regexp_matches(t, '{names.AGE}')"
_add(
    "f26_is_team",
    lambda p: p.select("p_partkey", names.is_team(F.expr(_TEAM), F.lit("whk"), F.expr("p_size % 5 = 0")).alias("is_team")),
    "part",
    rf"SELECT p_partkey, CASE WHEN k IN {_in(names.NO_TEAMS)} OR (regexp_matches(k, '^.+\s+teams?\s*$') AND NOT {_AGED}) THEN false WHEN {_AGED} OR {_has('k', ['beginner', 'ltp', 'learn'])} THEN true WHEN contains(upper(t), 'WHK') AND trim(replace(upper(t), 'WHK', ''), ' -') <> '' THEN true WHEN regexp_matches(trim(t), '^(?:0[4-8]|1[0-9]|[Gg]\d)') THEN true ELSE p_size % 5 = 0 END AS is_team FROM (SELECT p_partkey, p_size, {_TEAM} AS t, lower(trim({_TEAM})) AS k FROM part)",
)
_add(
    "f27_programs",
    lambda p: p.select("p_partkey", names.is_team_header(F.expr(_HEADING)).alias("header"), names.is_program(F.expr(_HEADING)).alias("program"), names.program_name(F.expr(_HEADING)).alias("name")),
    "part",
    f"SELECT p_partkey, length(t) >= 3 AND NOT {_has('k', names.NO_HEADERS)} AND (" + " OR ".join(f"regexp_matches(k, '{h}')" for h in names.HEADERS) + f") AS header, length(t) BETWEEN 3 AND 100 AND {_has('k', names.PROGRAM_WORDS)} AS program, CASE WHEN trim(k) NOT IN {_in(names.NO_PROGRAMS)} THEN trim(t) END AS name FROM (SELECT p_partkey, {_HEADING} AS t, lower({_HEADING}) AS k FROM part)",
)
_add(
    "f30_initials",
    lambda c: c.select("c_custkey", names.initials(F.expr("replace(c_name, '#', ' ') || '  of ' || c_mktsegment")).alias("initials"), names.colour_index(F.col("c_mktsegment")).cast("long").alias("colour"), names.json_list(F.when(F.col("c_custkey") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("c_mktsegment"))).alias("json")),
    "customer",
    "SELECT c_custkey, upper(array_to_string(list_transform(list_filter(string_split(replace(c_name, '#', ' ') || '  of ' || c_mktsegment, ' '), lambda w: w <> '')[1:3], lambda w: w[1]), '')) AS initials, CAST(ascii(c_mktsegment) % 6 AS BIGINT) AS colour, CASE WHEN c_custkey % 3 <> 0 THEN '[\"' || c_mktsegment || '\"]' END AS json FROM customer",
)
_CLUB = _cases("s_suppkey", ["'North Bay Eagles Hockey League'", "'Canton Youth Hockey'", "'WHK Hawks'", "'Boss ' || s_suppkey || ' Hockey Association'", "''", "'Abington League'"])
_TOWN = _cases("s_suppkey", ["'North Bay'", "'Canton'", "'Whitman-Hanson'", "'Marshfield'", "'Hull'"])
_ABBR = _cases("s_suppkey", ["'NBE'", "'CYH'", "'whk'", "NULL"])
_ENDING = "(?:" + "|".join(names.ENDINGS) + ")$"
_add(
    "f04_name_patterns",
    lambda s: s.select("s_suppkey", F.array_join(names.name_patterns(F.expr(_ABBR), F.expr(_CLUB), F.expr(_TOWN)), ",").alias("patterns")),
    "supplier",
    f"""WITH a AS (SELECT s_suppkey, trim(regexp_replace(lower({_CLUB}), '{_ENDING}', '')) AS core, lower({_ABBR}) AS abbr, lower({_TOWN}) AS town FROM supplier),
b AS (SELECT *, CASE WHEN contains(core, ' ') AND length(string_split(core, ' ')[-1]) > 3 AND string_split(core, ' ')[-1] NOT IN {_in(names.COMMON)} THEN string_split(core, ' ')[-1] END AS last, CASE WHEN core LIKE '%s' AND core NOT LIKE '%ss' THEN core[:-2] END AS one FROM a),
c AS (SELECT *, CASE WHEN last LIKE '%s' AND last NOT LIKE '%ss' AND last[:-2] NOT IN {_in(names.COMMON)} THEN last[:-2] END AS last_one FROM b),
d AS (SELECT s_suppkey, town, concat_ws(',', nullif(core, ''), one, last, last_one, CASE WHEN abbr IS DISTINCT FROM core AND abbr IS DISTINCT FROM last THEN abbr END) AS found FROM c)
SELECT s_suppkey, CASE WHEN contains(found, town) OR regexp_matches(town, '[-/ ]') THEN found ELSE concat_ws(',', nullif(found, ''), town) END AS patterns FROM d""",
)
_add(
    "o04_board",
    lambda c: directory.board(c.select(F.col("c_nationkey").alias("club_id"), F.expr(_OFFICE).alias("title"), F.col("c_name").alias("name"), F.expr("c_custkey % 9 <> 0").alias("is_active"))).select("club_id", "name", "title", "place"),
    "customer",
    f"SELECT club_id, name, title, row_number() OVER (PARTITION BY club_id ORDER BY CASE WHEN k LIKE '%president%' AND k NOT LIKE '%vice%' THEN 1 WHEN k LIKE '%vice president%' THEN 2 WHEN k LIKE '%secretary%' THEN 3 WHEN k LIKE '%treasurer%' THEN 4 WHEN k LIKE '%director%' THEN 5 WHEN k LIKE '%coordinator%' THEN 6 ELSE 7 END, name) AS place FROM (SELECT c_nationkey AS club_id, c_name AS name, {_OFFICE} AS title, lower({_OFFICE}) AS k FROM customer WHERE c_custkey % 9 <> 0)",
)
_add(
    "p06_announcements",
    lambda o: directory.announcements(o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("created_at"), F.expr("CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END").alias("publish_date"), F.expr("CASE WHEN o_orderkey % 5 <> 0 THEN date_add(CAST(o_orderdate AS DATE), 30) END").alias("expire_date")), F.lit("1996-06-01").cast("date"), 50).select("id", "priority"),
    "orders",
    "SELECT o_orderkey AS id, o_orderpriority AS priority FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE (o_orderkey % 3 = 0 OR d <= DATE '1996-06-01') AND (o_orderkey % 5 = 0 OR d + 30 >= DATE '1996-06-01') ORDER BY o_orderpriority DESC, d DESC, o_orderkey LIMIT 50",
)
_add("p07_next_days", lambda e: directory.within_days(e, "ts", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"), 3).select("event_id"), "events", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-05 00:00:00'")
_add(
    "j17_coaches_of_teams",
    lambda s, n: directory.coaches_of(s.select("s_suppkey", F.expr("CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE '[' || (s_suppkey % 25) || ', ' || (s_suppkey % 7) || ']' END").alias("team_ids")), n.select(F.col("n_nationkey").cast("long").alias("team_id"), "n_name")).select("s_suppkey", "team_id", "n_name"),
    ["supplier", "nation"],
    "SELECT DISTINCT s_suppkey, CAST(n_nationkey AS BIGINT) AS team_id, n_name FROM supplier JOIN nation ON n_nationkey = s_suppkey % 25 OR n_nationkey = s_suppkey % 7 WHERE s_suppkey % 4 <> 0",
)
# Each name once, so that places are without ties.
_DIVISION = "(" + _cases("p_partkey", ["'2012 Elite'", "'U14 ' || p_name", "'GIRLS SCHOOL'", "'Fed Futures'", "p_name", "'G10 BOG'"]) + ") || ' ' || p_partkey"
_add(
    "p14_categories",
    lambda p: directory.categories(p.select("p_partkey", F.expr(_DIVISION).alias("division_name"), F.expr("CASE WHEN p_size % 2 = 0 THEN '10477' ELSE 'other' END").alias("league_id"))).select("p_partkey", "league_id", "category", "place"),
    "part",
    f"WITH d AS (SELECT p_partkey, {_DIVISION} AS n, CASE WHEN p_size % 2 = 0 THEN '10477' ELSE 'other' END AS league_id FROM part), f AS ("
    + " UNION ALL ".join(f"SELECT p_partkey, league_id, '{g}' AS category, n FROM d WHERE league_id {'=' if k else '<>'} '10477' AND regexp_matches(n, '{p}')" for k, groups in directory.CATEGORIES.items() for g, p in groups.items())
    + "), a AS (SELECT * FROM f UNION ALL SELECT p_partkey, league_id, 'Other', n FROM d WHERE p_partkey NOT IN (SELECT p_partkey FROM f)) SELECT p_partkey, league_id, category, row_number() OVER (PARTITION BY league_id, category ORDER BY lower(n), n) AS place FROM a",
)
_add(
    "j12_by_id_or_number",
    lambda s, li: directory.scored_by(
        s.select((F.col("s_suppkey") % 5).alias("team"), F.col("s_suppkey").alias("player_id"), (F.col("s_suppkey") % 30).alias("number")),
        li.select((F.col("l_suppkey") % 5).alias("team"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"), F.col("l_suppkey").alias("scorer_id"), (F.col("l_partkey") % 90).alias("scorer_number")),
    ),
    ["supplier", "lineitem"],
    "SELECT s_suppkey % 5 AS team, s_suppkey AS player_id, s_suppkey % 30 AS number, count(DISTINCT l_orderkey * 10 + l_linenumber) AS goals FROM supplier JOIN lineitem ON s_suppkey % 5 = l_suppkey % 5 AND (s_suppkey = l_suppkey OR s_suppkey % 30 = l_partkey % 90) GROUP BY s_suppkey",
)
_ID = "CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 4 = 0 THEN 'g' || (o_custkey % 50) ELSE 'o' || o_orderkey END"
_add("w14_keep_first", lambda o: changes.keep_first(o.select("o_orderkey", F.expr(_ID).alias("id")), "id", ["o_orderkey"]), "orders", f"SELECT o_orderkey, id FROM (SELECT o_orderkey, id, row_number() OVER (PARTITION BY id ORDER BY o_orderkey) AS n FROM (SELECT o_orderkey, {_ID} AS id FROM orders)) WHERE n = 1 OR id = ''")
_add(
    "p11_upsert_coaches",
    lambda c: changes.upsert(
        c.where("c_custkey % 3 <> 0").select("c_name", F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END").alias("team_id"), F.lit("old").alias("role"), F.col("c_mktsegment").alias("mail")),
        c.where("c_custkey % 5 <> 0").select("c_name", F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END").alias("team_id"), F.lit("new").alias("role"), F.lit(None).cast("string").alias("mail")),
        ["c_name", "team_id"],
        null_safe=True,
    ),
    "customer",
    "SELECT c_name, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS team_id, CASE WHEN c_custkey % 5 <> 0 THEN 'new' ELSE 'old' END AS role, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS mail FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 <> 0",
)
_GAME = ["CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS STRING) ELSE '' END AS game_id", "'t' || o_orderkey AS team", "CAST(o_orderdate AS DATE) AS date", "CASE WHEN o_orderkey % 7 <> 0 THEN 'c' || o_custkey END AS opponent"]
_add(
    "m05_upsert_games",
    lambda o: changes.upsert_games(o.where("o_orderkey % 3 <> 0").selectExpr(*_GAME, "o_orderstatus AS state"), o.where("o_orderkey % 5 <> 0").selectExpr(*_GAME, "CASE WHEN o_orderkey % 11 <> 0 THEN 'new' END AS state")).select("game_id", "team", F.col("date").cast("string").alias("date"), "opponent", "state"),
    "orders",
    f"SELECT {', '.join(_GAME[:2])}, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, {_GAME[3]}, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 THEN 'new' WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS state FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 <> 0",
)
_add(
    "r13_enrich",
    lambda n: directory.enrich(
        n.select("n_nationkey", F.expr("CASE WHEN n_nationkey % 3 = 0 THEN 'http://X.org/' || n_nationkey || '//' END").alias("url"), F.upper("n_name").alias("name"), F.expr("CASE WHEN n_nationkey % 4 = 0 THEN 'own' END").alias("town")),
        n.where("n_nationkey % 5 <> 0").select(F.expr("'http://x.org/' || n_nationkey").alias("url"), F.col("n_name").alias("name"), F.expr("'town ' || n_regionkey").alias("town")),
        ["town"],
    ).select("n_nationkey", "town"),
    "nation",
    "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'own' WHEN n_nationkey % 5 <> 0 THEN 'town ' || n_regionkey END AS town FROM nation",
)
_DIVISIONS = """'[{"id": ' || r_regionkey || ', "title": "' || r_name || '", "goalValue": 2}, {"id": ' || (r_regionkey + 100) || ', "maxGoalDifferential": 7}]'"""
_add(
    "s02_divisions",
    lambda r: documents.divisions(r.select(F.expr(_DIVISIONS).alias("json"))),
    "region",
    "SELECT CAST(r_regionkey AS BIGINT) AS division_id, r_name AS division_name, CAST(1 AS INTEGER) AS assist_value, CAST(2 AS INTEGER) AS goal_value, CAST(NULL AS INTEGER) AS max_goal_differential FROM region UNION ALL SELECT CAST(r_regionkey + 100 AS BIGINT), 'Unknown', 1, 1, 7 FROM region",
)
_ROSTER = """CASE WHEN n_nationkey % 5 = 4 THEN '{"coachData": {"names": [{"firstName": "No"}]}}' ELSE '{"playerData": {"names": [{"firstName": "A", "lastName": "' || n_name || '"}, {"lastName": "B"}, {}], "ids": [' || n_nationkey || ', "b' || n_nationkey || '"], "jersey": ["7"], "positions": [["F", "C"]], "g": [3, 4]}, "goalieData": {"names": [{"firstName": "G"}], "ids": ["g' || n_nationkey || '"], "gp": [9]}, "coachData": {"names": [{"firstName": "C"}, {}], "positions": ["Head"]}}' END"""
_add(
    "s10_roster",
    lambda n: documents.roster_people(n.select(F.col("n_nationkey").cast("long").alias("team_id"), F.expr(_ROSTER).alias("json"))).select("team_id", "player_id", "first_name", "last_name", "jersey", "position", "gp", "g", "gwg", "is_goalie"),
    "nation",
    "WITH n AS (SELECT CAST(n_nationkey AS BIGINT) AS team_id, n_name FROM nation WHERE n_nationkey % 5 <> 4) SELECT team_id, CAST(team_id AS VARCHAR) AS player_id, 'A' AS first_name, n_name AS last_name, '7' AS jersey, 'F,C' AS position, 0 AS gp, 3 AS g, 0 AS gwg, false AS is_goalie FROM n UNION ALL SELECT team_id, 'b' || team_id, '', 'B', NULL, NULL, 0, 4, 0, false FROM n UNION ALL SELECT team_id, 'g' || team_id, 'G', '', NULL, 'goalie', 9, 0, NULL, true FROM n",
)
_add("s10_coaches", lambda n: documents.roster_coaches(n.select(F.col("n_nationkey").cast("long").alias("team_id"), F.expr(_ROSTER).alias("json"))), "nation", "WITH n AS (SELECT CAST(n_nationkey AS BIGINT) AS team_id FROM nation WHERE n_nationkey % 5 <> 4) SELECT team_id, 'C' AS first_name, '' AS last_name, 'Head' AS position FROM n UNION ALL SELECT team_id, '', '', 'unknown' FROM n")
_DUMP = """'// made
const ALL = {"d_' || r_regionkey || '": {"division_id": ' || r_regionkey || ', "division_name": "' || r_name || '", "league_id": "10477", "teams": [{"rank": 1, "team_id": 5, "name": "x", "gp": 3, "w": 2, "pts": 4}, {"rank": 2, "team_id": 6}]}, "e": {"division_id": 9, "teams": []}};'"""
_add(
    "s27_standings_dump",
    lambda r: documents.standings_dump(r.select(F.expr(_DUMP).alias("value"))).select("key", "division_id", "division_name", "league_id", "rank", "team_id", "name", "w", "pts"),
    "region",
    "SELECT 'd_' || r_regionkey AS key, CAST(r_regionkey AS BIGINT) AS division_id, r_name AS division_name, '10477' AS league_id, k AS rank, CAST(4 + k AS BIGINT) AS team_id, CASE k WHEN 1 THEN 'x' END AS name, CASE k WHEN 1 THEN 2 END AS w, CASE k WHEN 1 THEN 4 END AS pts FROM region CROSS JOIN (VALUES (1), (2)) v(k)",
)

# Texts of sources: goal lines, divisions, dates, clocks; and captured documents.
_GOAL = _cases("p_partkey", ["'2nd 05:12 A. Player (B. One, C. Two)'", "'OT 1:02 ' || p_name || ' (Unassisted)'", "'3rd no time'", "p_name", "'1st 12:30 ' || p_name"])
_add(
    "s14_goal_lines",
    lambda p: documents.goal_lines(p.select("p_partkey", F.expr(_GOAL).alias("line"))).select("p_partkey", "period", "time", "player", F.array_join("assists", ";").alias("assists")),
    "part",
    "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '2nd' WHEN 1 THEN 'OT' ELSE '1st' END AS period, CASE p_partkey % 5 WHEN 0 THEN '05:12' WHEN 1 THEN '1:02' ELSE '12:30' END AS time, CASE WHEN p_partkey % 5 = 0 THEN 'A. Player' ELSE trim(p_name) END AS player, CASE WHEN p_partkey % 5 = 0 THEN 'B. One;C. Two' ELSE '' END AS assists FROM part WHERE p_partkey % 5 IN (0, 1, 4)",
)
_PARTS = _cases("p_partkey", ["'U10B - Gold'", "'GU12A'", "'U8C'", "'GU14'", "p_name"])
_add(
    "f05_text_forms",
    lambda p: p.select("p_partkey", resolve.slug(F.concat(F.lit(" "), "p_name", F.lit("-- 7!"))).alias("slug"), resolve.fingerprint(F.concat("p_name", F.lit(" U-10"))).alias("mark"), resolve.division_parts(F.expr(_PARTS)).alias("d"), resolve.split_name(F.concat(F.lit(" "), "p_name", F.lit("  x y"))).alias("n"), core.leading_int(F.concat(F.col("p_size").cast("string"), F.lit("B"))).alias("jersey"))
    .select("p_partkey", "slug", "mark", "d.age", "d.level", "d.tier", "n.first", "n.last", "jersey"),
    "part",
    r"SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-7' AS slug, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') || 'u10' AS mark, CASE p_partkey % 5 WHEN 0 THEN 'U10' WHEN 1 THEN 'GU12' WHEN 2 THEN 'U8' WHEN 3 THEN 'GU14' END AS age, CASE p_partkey % 5 WHEN 0 THEN 'B' WHEN 1 THEN 'A' WHEN 2 THEN 'C' END AS level, CASE p_partkey % 5 WHEN 0 THEN 'Gold' END AS tier, regexp_extract(p_name, '^\S+') AS first, trim(regexp_replace(p_name, '^\S+', '')) || CASE WHEN contains(p_name, ' ') THEN '  ' ELSE '' END || 'x y' AS last, CAST(p_size AS INTEGER) AS jersey FROM part",
)
_add(
    "f06_dates",
    lambda o: o.select("o_orderkey", resolve.date_of(F.expr("CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'M/d/yyyy') WHEN 2 THEN date_format(o_orderdate, 'EEEE, MMMM d, yyyy') ELSE 'soon' END")).cast("string").alias("day")),
    "orders",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
)
_add(
    "f14_clock",
    lambda e: e.select("event_id", core.game_seconds(core.period_number(F.expr("CASE event_id % 5 WHEN 0 THEN '1st' WHEN 1 THEN 'Second' WHEN 2 THEN '3RD' WHEN 3 THEN 'Overtime' ELSE 'x' END")), F.expr("CASE WHEN event_id % 7 = 0 THEN 'late' ELSE (event_id % 13) || ':05' END")).alias("seconds")),
    "events",
    "SELECT event_id, CAST(CASE WHEN event_id % 5 < 4 AND event_id % 7 <> 0 THEN (event_id % 5 + 1) * 780 - (event_id % 13) * 60 - 5 END AS INTEGER) AS seconds FROM events",
)
_BOX = """'{"home": {"id": "h' || n_nationkey || '", "roster": {"players": [{"id": "p1", "firstName": "A", "lastName": "' || n_name || '", "number": "9", "status": "PLAYED", "g": 1}, {"id": ""}]}}, "visitor": {"id": "v", "roster": {"players": [{"id": "p2", "number": "x"}]}}, "tables": {"goalsByPeriod": [{"period": "1st", "periodEvents": [{"eventType": "goal", "time": "10:00", "team": {"id": "h' || n_nationkey || '"}, "powerPlay": true, "goalScorer": {"id": "p1", "number": "9"}, "assist1By": {"id": ""}}]}, {"period": "OT", "periodEvents": [{"eventType": "note"}, {"eventType": "GOAL", "time": "bad", "team": {"id": "v"}, "goalScorer": {"id": "p2"}}]}], "penaltiesByPeriod": [{"period": "2nd", "periodEvents": [{"eventType": "penalty", "time": "1:30", "team": {"id": "v"}, "commitedBy": {"id": "p2"}, "penaltyType": {"title": "Hooking", "duration": "2", "class": "Minor"}}]}]}}'"""


def _boxes(nation):
    return nation.select(F.col("n_nationkey").alias("game_id"), F.expr(_BOX).alias("json"))


_add(
    "s06_box_goals",
    lambda n: documents.box_score_goals(_boxes(n)).select("game_id", "seq", "period", "period_number", "game_seconds", "team_id", "is_home", "scorer_id", "scorer_number", "assist1_id", "pp"),
    "nation",
    "SELECT n_nationkey AS game_id, CAST(0 AS INTEGER) AS seq, '1st' AS period, CAST(1 AS INTEGER) AS period_number, CAST(180 AS INTEGER) AS game_seconds, 'h' || n_nationkey AS team_id, true AS is_home, 'p1' AS scorer_id, CAST(9 AS INTEGER) AS scorer_number, CAST(NULL AS VARCHAR) AS assist1_id, true AS pp FROM nation UNION ALL SELECT n_nationkey, 1001, 'OT', 4, NULL, 'v', false, 'p2', NULL, NULL, false FROM nation",
)
_add("s07_box_penalties", lambda n: documents.box_score_penalties(_boxes(n)).select("game_id", "period", "game_seconds", "team_id", "player_id", "served_by", "penalty", "penalty_class", "minutes", "is_major"), "nation", "SELECT n_nationkey AS game_id, '2nd' AS period, CAST(1470 AS INTEGER) AS game_seconds, 'v' AS team_id, 'p2' AS player_id, CAST(NULL AS VARCHAR) AS served_by, 'Hooking' AS penalty, 'Minor' AS penalty_class, CAST(2 AS INTEGER) AS minutes, false AS is_major FROM nation")
_add("s08_box_rosters", lambda n: documents.box_score_rosters(_boxes(n)).select("game_id", "team_id", "player_id", "number", "name", "status", "g"), "nation", "SELECT n_nationkey AS game_id, 'h' || n_nationkey AS team_id, 'p1' AS player_id, CAST(9 AS INTEGER) AS number, 'A ' || n_name AS name, 'played' AS status, CAST(1 AS INTEGER) AS g FROM nation UNION ALL SELECT n_nationkey, 'v', 'p2', NULL, '', NULL, NULL FROM nation")
_PAGE = """'{"d": [{"date": "2024-01-0' || (n_regionkey + 1) || '", "games": [{"id": "g' || n_nationkey || '", "status": "FINAL", "homeTeam": {"id": "1", "name": "' || n_name || '"}, "visitor": {"id": "2", "title": "V"}}, {"id": "all", "date": "2024-02-02", "home": {"title": "T"}}, {"status": "x"}]}]}'"""
_add("s05_schedule", lambda n: documents.schedule_games(n.select(F.expr(_PAGE).alias("json"))).select("game_id", "game_date", "status", "home_id", "home_name", "visitor_id", "visitor_name"), "nation", "SELECT 'g' || n_nationkey AS game_id, '2024-01-0' || (n_regionkey + 1) AS game_date, 'final' AS status, '1' AS home_id, n_name AS home_name, '2' AS visitor_id, 'V' AS visitor_name FROM nation UNION ALL SELECT 'all', '2024-02-02', 'scheduled', NULL, 'T', NULL, NULL")
_TABLE = """'[{"id": ' || r_regionkey || ', "title": "' || r_name || '", "tableData": {"teamIds": [5, 6, 7], "teamTitles": [{"title": "a"}, {"title": "b"}], "gp": [3], "pts": [4, 2]}}]'"""
_add("s03_standings", lambda r: documents.standings_teams(r.select(F.expr(_TABLE).alias("json"))).select("division_id", "division", "team_id", "team_name", "gp", "pts"), "region", "SELECT CAST(r_regionkey AS BIGINT) AS division_id, r_name AS division, CAST(5 AS BIGINT) AS team_id, 'a' AS team_name, CAST(3 AS INTEGER) AS gp, CAST(4 AS INTEGER) AS pts FROM region UNION ALL SELECT CAST(r_regionkey AS BIGINT), r_name, 6, 'b', NULL, 2 FROM region")
_add("m01_last_wins", lambda o: changes.last_wins(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey"), "orders", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
_add("m03_insert_or_ignore", lambda c: changes.insert_or_ignore(c.where("c_custkey % 2 = 0").selectExpr("c_custkey", "'old' AS v"), c.where("c_custkey % 3 = 0").selectExpr("c_custkey", "'new' AS v"), ["c_custkey"]), "customer", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE 'new' END AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
_add("j16_fill_blanks", lambda c: changes.fill_blanks(c.selectExpr("c_custkey", "c_nationkey", "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name END AS name"), c.selectExpr("c_nationkey", "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS name"), "c_nationkey", "name").select("c_custkey", "name"), "customer", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN coalesce(least_name, ' ') ELSE c_name END AS name FROM customer LEFT JOIN (SELECT c_nationkey, min(c_mktsegment) AS least_name FROM customer WHERE c_custkey % 5 <> 0 GROUP BY ALL) USING (c_nationkey)")
