"""Flatten captured documents: box scores, schedules, standings and rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import core

_PERSON = "struct<id: string, number: string, firstName: string, lastName: string>"
_EVENT = f"struct<eventType: string, time: string, homeTeam: boolean, powerPlay: boolean, gameWinningGoal: boolean, shg: boolean, en: boolean, goalScorer: {_PERSON}, assist1By: {_PERSON}, assist2By: {_PERSON}, commitedBy: {_PERSON}, servedBy: {_PERSON}, penaltyType: struct<title: string, duration: string, class: string>, major: boolean, team: struct<id: string, title: string>>"
_PLAYER = "struct<id: string, firstName: string, lastName: string, number: string, position: string, status: string, g: int, a: int, pts: int, pim: int>"
_SIDE = f"struct<id: string, title: string, finalScore: string, roster: struct<players: array<{_PLAYER}>>>"
_PERIODS = f"array<struct<period: string, type: string, periodEvents: array<{_EVENT}>>>"
#: A captured box score; empty ids stand for nobody.
BOX_SCORE = f"struct<home: {_SIDE}, visitor: {_SIDE}, tables: struct<goalsByPeriod: {_PERIODS}, penaltiesByPeriod: {_PERIODS}>>"
_TEAM = "struct<id: string, name: string, title: string>"
SCHEDULE = f"map<string, array<struct<date: string, games: array<struct<id: string, status: string, date: string, time: string, location: string, homeTeam: {_TEAM}, visitorTeam: {_TEAM}, home: {_TEAM}, visitor: {_TEAM}>>>>>"
STANDINGS = "array<struct<id: bigint, title: string, tableData: struct<teamIds: array<bigint>, teamTitles: array<struct<title: string, id: bigint>>, teamLogos: array<string>, gp: array<int>, w: array<int>, l: array<int>, t: array<int>, pts: array<int>, gf: array<int>, ga: array<int>>>>"


def _id(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def _events(boxes: DataFrame, column: str, table: str, kind: str) -> DataFrame:
    doc = boxes.select("game_id", F.from_json(column, BOX_SCORE).alias("d"))
    periods = doc.select("game_id", F.col("d.home.id").alias("home_id"), F.posexplode(f"d.tables.{table}").alias("p", "x"))
    events = periods.select("game_id", "home_id", "p", F.col("x.period").alias("period"), F.posexplode("x.periodEvents").alias("q", "e")).where(F.lower("e.eventType") == kind)
    number = core.period_number(F.col("period"))
    shared = ["game_id", (F.col("p") * 1000 + F.col("q")).alias("seq"), "period", number.alias("period_number"), F.col("e.time").alias("time_remaining"), core.game_seconds(number, F.col("e.time")).alias("game_seconds"), _id("e.team.id").alias("team_id"), F.col("e.team.id").eqNullSafe(F.col("home_id")).alias("is_home")]
    return events.select(*shared, "e")


def box_score_goals(boxes: DataFrame, column: str = "json") -> DataFrame:
    """Goals of box scores (game_id, JSON); the key is (game_id, seq)."""
    flag = lambda n: F.coalesce(F.col(f"e.{n}"), F.lit(False))
    person = lambda n, out: [_id(f"e.{n}.id").alias(f"{out}_id"), F.col(f"e.{n}.number").try_cast("int").alias(f"{out}_number")]
    e = _events(boxes, column, "goalsByPeriod", "goal")
    return e.select(*[c for c in e.columns if c != "e"], *person("goalScorer", "scorer"), *person("assist1By", "assist1"), *person("assist2By", "assist2"), flag("powerPlay").alias("pp"), flag("shg").alias("sh"), flag("gameWinningGoal").alias("gw"), flag("en").alias("en"))


def box_score_penalties(boxes: DataFrame, column: str = "json") -> DataFrame:
    e = _events(boxes, column, "penaltiesByPeriod", "penalty")
    return e.select(*[c for c in e.columns if c != "e"], _id("e.commitedBy.id").alias("player_id"), _id("e.servedBy.id").alias("served_by"), F.col("e.penaltyType.title").alias("penalty"), F.col("e.penaltyType.class").alias("penalty_class"), F.col("e.penaltyType.duration").try_cast("int").alias("minutes"), F.coalesce("e.major", F.lit(False)).alias("is_major"))


def box_score_rosters(boxes: DataFrame, column: str = "json") -> DataFrame:
    """Players of both sides; without an id they are left out."""
    doc = boxes.select("game_id", F.from_json(column, BOX_SCORE).alias("d"))
    sides = doc.select("game_id", F.explode(F.array("d.home", "d.visitor")).alias("s"))
    rows = sides.select("game_id", F.col("s.id").alias("team_id"), F.explode("s.roster.players").alias("p"))
    return rows.where(F.coalesce(F.trim("p.id"), F.lit("")) != "").select("game_id", "team_id", F.col("p.id").alias("player_id"), F.col("p.number").try_cast("int").alias("number"), F.trim(F.concat_ws(" ", "p.firstName", "p.lastName")).alias("name"), "p.position", F.lower("p.status").alias("status"), "p.g", "p.a", "p.pts", "p.pim")


def schedule_games(pages: DataFrame, column: str = "json") -> DataFrame:
    """Games of schedule pages: a map of days, each with games; teams under either of two names."""
    days = pages.select(F.explode(F.map_values(F.from_json(column, SCHEDULE))).alias("list")).select(F.explode("list").alias("d"))
    g = days.select(F.col("d.date").alias("day"), F.explode("d.games").alias("g")).where("g.id is not null")
    name = lambda a, b: F.coalesce(f"g.{a}.name", f"g.{a}.title", f"g.{b}.title", f"g.{b}.name")
    one = lambda a, b, c: F.coalesce(f"g.{a}.{c}", f"g.{b}.{c}")
    return g.select(F.col("g.id").alias("game_id"), F.coalesce("g.date", "day").alias("game_date"), F.coalesce(F.lower("g.status"), F.lit("scheduled")).alias("status"), F.col("g.location").alias("location"), one("homeTeam", "home", "id").alias("home_id"), name("homeTeam", "home").alias("home_name"), one("visitorTeam", "visitor", "id").alias("visitor_id"), name("visitorTeam", "visitor").alias("visitor_name")).dropDuplicates(["game_id"])


def schedule_teams(pages: DataFrame, order: str, column: str = "json") -> DataFrame:
    """Teams of schedules by name, once each, where they come first: team_name and the page. order: a column that orders the pages."""
    days = F.flatten(F.map_values(F.from_json(column, SCHEDULE)))
    name = lambda g, a, b: F.coalesce(F.nullif(g[a]["name"], F.lit("")), F.nullif(g[a]["title"], F.lit("")), F.nullif(g[b]["title"], F.lit("")), g[b]["name"])
    found = F.flatten(F.transform(F.flatten(F.transform(days, lambda d: d["games"])), lambda g: F.array(name(g, "homeTeam", "home"), name(g, "visitorTeam", "visitor"))))
    rows = pages.select(order, F.posexplode(found).alias("place", "team_name")).where("coalesce(team_name, '') <> ''")
    return rows.groupBy("team_name").agg(F.min_by(order, F.struct(order, "place")).alias(order))


def games_in(json: Column) -> Column:
    """Games of a schedule page that have an id; 0 of an absent or broken page."""
    days = F.flatten(F.map_values(F.from_json(json, SCHEDULE)))
    return F.coalesce(F.aggregate(days, F.lit(0), lambda n, d: n + F.coalesce(F.size(F.filter(d["games"], lambda g: g["id"].isNotNull())), F.lit(0))), F.lit(0))


def standings_teams(pages: DataFrame, column: str = "json") -> DataFrame:
    """Teams of standings whose columns are parallel arrays; what a short array lacks is null."""
    d = pages.select(F.explode(F.from_json(column, STANDINGS)).alias("d")).select(F.col("d.id").alias("division_id"), F.col("d.title").alias("division"), "d.tableData.*")
    # A column that is absent altogether counts as an empty array.
    columns = ["teamIds", "teamTitles", "teamLogos", "gp", "w", "l", "t", "pts", "gf", "ga"]
    d = d.withColumns({c: F.coalesce(c, F.array().cast(d.schema[c].dataType)) for c in columns})
    z = d.select("division_id", "division", F.inline(F.arrays_zip(*columns)))
    return z.select("division_id", "division", F.col("teamIds").alias("team_id"), F.col("teamTitles.title").alias("team_name"), F.col("teamLogos").alias("logo"), "gp", "w", "l", "t", "pts", "gf", "ga").where("team_name is not null")


_DIVISIONS = "array<struct<id: bigint, title: string, assistValue: int, goalValue: int, maxGoalDifferential: int>>"
_NAMES = "array<struct<firstName: string, lastName: string, photo: string>>"
_COUNTS = ["gp", "g", "a", "pts", "pim", "ppg", "shg", "gwg"]
_LISTS = f"names: {_NAMES}, ids: array<string>, jersey: array<string>, {', '.join(f'{c}: array<int>' for c in _COUNTS)}"
_BODY = ["birthdate", "height", "weight", "shotHand", "hometown"]
ROSTER = f"struct<playerData: struct<{_LISTS}, positions: array<array<string>>, {', '.join(f'{c}: array<string>' for c in _BODY)}>, goalieData: struct<{_LISTS}>, coachData: struct<names: {_NAMES}, positions: array<string>>>"
_PLACES = "array<struct<rank: int, team_id: bigint, name: string, gp: int, w: int, l: int, t: int, gf: int, ga: int, pts: int>>"
STANDINGS_DUMP = f"map<string, struct<division_id: bigint, division_name: string, league_id: string, teams: {_PLACES}>>"


def divisions(pages: DataFrame, column: str = "json") -> DataFrame:
    """Divisions of a list; values of goals and assists are 1 where they are absent, and one without an id is left out."""
    d = pages.select(F.explode(F.from_json(column, _DIVISIONS)).alias("d")).where("d.id is not null")
    return d.select(F.col("d.id").alias("division_id"), F.coalesce("d.title", F.lit("Unknown")).alias("division_name"), F.coalesce("d.assistValue", F.lit(1)).alias("assist_value"), F.coalesce("d.goalValue", F.lit(1)).alias("goal_value"), F.col("d.maxGoalDifferential").alias("max_goal_differential"))


def _zipped(doc: DataFrame, part: str, fields: list[str]) -> DataFrame:
    """Rows of parallel arrays, as many as there are names; what a short or absent array lacks is null."""
    kinds = {f.name: f.dataType for f in doc.schema["d"].dataType[part].dataType}
    arrays = [F.coalesce(f"d.{part}.{c}", F.array().cast(kinds[c])).alias(c) for c in fields]
    d = doc.select("team_id", *arrays).withColumn("n", F.size("names"))
    return d.select("team_id", "n", F.posexplode(F.arrays_zip(*fields)).alias("i", "x")).where("i < n").select("team_id", "x.*")


def roster_people(pages: DataFrame, column: str = "json") -> DataFrame:
    """Players and goalies of team rosters (team_id, JSON of parallel arrays); without an id they are left out.

    A team whose lists are empty (private) gives no row. Absent counts are 0.
    """
    doc = pages.select("team_id", F.from_json(column, ROSTER).alias("d"))
    person = ["team_id", F.col("ids").alias("player_id"), F.coalesce("names.firstName", F.lit("")).alias("first_name"), F.coalesce("names.lastName", F.lit("")).alias("last_name"), "jersey"]
    zero = lambda names: [F.coalesce(c, F.lit(0)).alias(c) for c in names]
    players = _zipped(doc, "playerData", ["names", "ids", "jersey", "positions", *_COUNTS, *_BODY])
    players = players.select(*person, F.array_join("positions", ",").alias("position"), *zero(_COUNTS), F.col("names.photo").alias("photo"), *_BODY, F.lit(False).alias("is_goalie"))
    goalies = _zipped(doc, "goalieData", ["names", "ids", "jersey", *_COUNTS[:5]])
    goalies = goalies.select(*person, F.lit("goalie").alias("position"), *zero(_COUNTS[:5]), F.lit(True).alias("is_goalie"))
    return players.unionByName(goalies, allowMissingColumns=True).where("coalesce(player_id, '') <> ''")


def roster_coaches(pages: DataFrame, column: str = "json") -> DataFrame:
    """Coaches of team rosters; teams without players and goalies give none."""
    doc = pages.select("team_id", F.from_json(column, ROSTER).alias("d")).where("coalesce(size(d.playerData.names), 0) > 0 or coalesce(size(d.goalieData.names), 0) > 0")
    rows = _zipped(doc, "coachData", ["names", "positions"])
    return rows.select("team_id", F.coalesce("names.firstName", F.lit("")).alias("first_name"), F.coalesce("names.lastName", F.lit("")).alias("last_name"), F.coalesce("positions", F.lit("unknown")).alias("position"))


def standings_dump(files: DataFrame, column: str = "value") -> DataFrame:
    """Teams of a standings file: an object of divisions, each with its teams, with or without a script around it."""
    body = F.regexp_extract(column, r"(?s)(\{.*\})", 1)
    d = files.select(F.explode(F.from_json(body, STANDINGS_DUMP)).alias("key", "d"))
    return d.select("key", "d.division_id", "d.division_name", "d.league_id", F.explode("d.teams").alias("x")).select("key", "division_id", "division_name", "league_id", "x.*")


# Penalties that a line is searched for, in order.
PENALTIES = ["Tripping", "Hooking", "Slashing", "Roughing", "High-Sticking", "Interference", "Holding", "Cross-Checking", "Boarding", "Charging"]


def goal_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Goals from lines such as '2nd 05:12 A. Player (B. One, C. Two)'; a line needs period, time and player."""
    x = F.col(column)
    inside = F.nullif(F.regexp_extract(x, r"\(([^)]*)\)", 1), F.lit(""))
    assists = F.when(inside.isNull() | (F.lower(inside) == "unassisted"), F.array().cast("array<string>")).otherwise(F.transform(F.split(inside, ","), lambda a: F.trim(a)))
    out = lines.select("*", F.nullif(F.regexp_extract(x, r"(?i)\b(1st|2nd|3rd|OT|SO)\b", 1), F.lit("")).alias("period"), F.nullif(F.regexp_extract(x, r"\b(\d{1,2}:\d{2})\b", 1), F.lit("")).alias("time"), F.nullif(F.trim(F.regexp_extract(x, r"\d{1,2}:\d{2}\s+([^(]+)", 1)), F.lit("")).alias("player"), assists.alias("assists"))
    return out.where("period is not null and time is not null and player is not null")


def penalty_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Penalties from lines, by the first of the known kinds that a line names, with minutes as 'N min'."""
    x, kind = F.col(column), None
    for p in PENALTIES:
        hit = F.contains(x, F.lit(p))
        kind = F.when(hit, p) if kind is None else kind.when(hit, p)
    return lines.select("*", F.nullif(F.regexp_extract(x, r"\b(\d{1,2}:\d{2})\b", 1), F.lit("")).alias("time"), kind.otherwise("Unknown").alias("penalty"), F.nullif(F.regexp_extract(x, r"(?i)(\d+)\s*min", 1), F.lit("")).try_cast("int").alias("minutes"))


def validate_details(games: DataFrame) -> DataFrame:
    """Errors of nested game documents: period sums, numbers of goals, missing fields. games as in the captured details."""
    total = lambda side: F.aggregate(F.map_values("period_scores"), F.lit(0), lambda a, x: a + F.coalesce(x[side], F.lit(0)))
    played = F.col("home_score").isNotNull()
    goals = F.size("scoring_summary")
    checks = [
        F.when(played & F.col("period_scores").isNotNull() & (total("home") != F.col("home_score").try_cast("int")), F.lit("home_period_sum")),
        F.when(played & F.col("period_scores").isNotNull() & (total("visitor") != F.col("visitor_score").try_cast("int")), F.lit("visitor_period_sum")),
        F.when(played & F.col("scoring_summary").isNotNull() & (goals != F.col("home_score").try_cast("int") + F.col("visitor_score").try_cast("int")), F.lit("goal_count")),
        *[F.when(core.blank(F.col(c)), F.lit(f"missing_{c}")) for c in ("game_id", "date", "home_team", "visitor_team")],
    ]
    return games.select("game_id", F.explode(F.array_compact(F.array(*checks))).alias("error"))
