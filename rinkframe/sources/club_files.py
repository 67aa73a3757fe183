"""Captured directories of clubs and the league's configuration files.

A directory of clubs holds one folder a club with club_info.json and lists of teams, players, coaches,
board_members, games and contacts. A folder without club_info.json is not a club. Keys that are not
known are dropped; an item that is no object or lacks a key that it needs is skipped; a file that is no
list of JSON is set aside, and its club's other files count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PAGE = ", source_url: string"
#: Lists of a club: their fields, of which the first ones are needed, and values of keys that are absent.
LISTS = {
    "teams": ("club_name: string, team_name: string, age_group: string, division_level: string, season: string, team_page_url: string, roster_url: string, schedule_url: string, sportsengine_page_id: string, sportsengine_team_instance_id: string, subseason_id: string" + _PAGE, 2),
    "players": ("club_name: string, team_name: string, name: string, first_name: string, last_name: string, jersey_number: string, position: string, usah_number: string, player_profile_url: string" + _PAGE, 3),
    "coaches": ("club_name: string, name: string, team_name: string, role: string, email: string, phone: string" + _PAGE, 2),
    "board_members": ("club_name: string, name: string, title: string, email: string, phone: string" + _PAGE, 2),
    "games": ("club_name: string, team_name: string, date: string, opponent: string, time: string, location: string, is_home: boolean, home_score: int, away_score: int, status: string, game_id: string, game_url: string" + _PAGE, 4),
    "contacts": ("club_name: string, contact_type: string, value: string, context: string" + _PAGE, 3),
}
CLUB = ("club_name: string, club_slug: string, website_url: string, sportsengine_org_id: string, town: string, abbreviation: string, conference: string, scraped_at: string", 3)
DEFAULTS = {"source_url": "", "status": "scheduled", "conference": "SSC"}


def _files(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Files of one name in all club folders: club, text."""
    found = spark.read.text(folder, wholetext=True, pathGlobFilter=f"{name}.json", recursiveFileLookup=True)
    return found.select(F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1).alias("club"), F.col("value").alias("text"))


def _fields(item: Column, schema: str, needed: int) -> tuple[list[Column], Column]:
    """Columns of an item (JSON text of an object), with defaults of absent keys, and whether it has the keys that it needs."""
    x, keys = F.from_json(item, f"struct<{schema}>"), F.json_object_keys(item)
    names = [f.split(":")[0] for f in schema.split(", ")]
    has = lambda n: F.coalesce(F.array_contains(keys, n), F.lit(False))
    columns = [(F.when(has(n), x[n]).otherwise(F.lit(DEFAULTS[n])) if n in DEFAULTS else x[n]).alias(n) for n in names]
    whole = has(names[0])
    for n in names[1:needed]:
        whole = whole & has(n)
    return columns, whole


def _is_list(text: str) -> Column:
    return F.rlike(text, F.lit(r"^\s*\["))


def clubs(spark: SparkSession, folder: str) -> DataFrame:
    """Clubs with what their club_info.json says; a file that is no object, or lacks a key that it needs, gives none."""
    files = _files(spark, folder, "club_info").where(F.json_object_keys("text").isNotNull())
    columns, whole = _fields(F.col("text"), *CLUB)
    return files.where(whole).select("club", *columns)


def read_list(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Items of one list of all clubs: club, place in the file and the fields."""
    files = _files(spark, folder, name).join(clubs(spark, folder).select("club"), "club", "left_semi")
    items = files.where(_is_list("text")).select("club", F.posexplode(F.from_json("text", "array<string>")).alias("place", "item")).where(F.json_object_keys("item").isNotNull())
    columns, whole = _fields(F.col("item"), *LISTS[name])
    return items.where(whole).select("club", "place", *columns)


def bad_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that are set aside: club, file and why."""
    found = []
    for name in LISTS:
        files = _files(spark, folder, name)
        why = F.when(~_is_list("text"), "no list").when(F.from_json("text", "array<string>").isNull(), "no JSON")
        found.append(files.select("club", F.lit(f"{name}.json").alias("file"), why.alias("why")))
    info = _files(spark, folder, "club_info")
    found.append(info.select("club", F.lit("club_info.json").alias("file"), F.when(F.json_object_keys("text").isNull(), "no JSON").when(~_fields(F.col("text"), *CLUB)[1], "keys are missing").alias("why")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.where("why is not null")


def counts(spark: SparkSession, folder: str) -> DataFrame:
    """Items of each list of each club, 0 where a list is absent or bad."""
    found = clubs(spark, folder).select("club", "club_name")
    for name in LISTS:
        n = read_list(spark, folder, name).groupBy("club").agg(F.count("*").alias(name))
        found = found.join(n, "club", "left")
    return found.na.fill(0, list(LISTS))


_ENTRY = "struct<name: string, url: string, abbreviation: string, town: string, platform: string>"
CONFIGURED = f"struct<conference: string, season: string, source: string, last_updated: string, clubs: array<{_ENTRY}>>"
DIVISIONS = "struct<season_id: string, season_info: struct<season_id: string, title: string>, divisions: map<string, string>>"


def configured_clubs(files: DataFrame, column: str = "value") -> DataFrame:
    """Clubs of a league's configuration: conference, season and each club's name, address, abbreviation, town and platform."""
    d = files.select(F.from_json(column, CONFIGURED).alias("d"))
    return d.select("d.conference", "d.season", F.posexplode("d.clubs").alias("place", "c")).select("conference", "season", "place", "c.*")


def configured_divisions(files: DataFrame, column: str = "value") -> DataFrame:
    """Divisions of a season's configuration: their names as they are, and ids."""
    d = files.select(F.from_json(column, DIVISIONS).alias("d"))
    return d.select(F.coalesce("d.season_id", "d.season_info.season_id").alias("season_id"), F.col("d.season_info.title").alias("season"), F.explode("d.divisions").alias("division_name", "division_id"))
