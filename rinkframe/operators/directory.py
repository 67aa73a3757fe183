"""Lookups of clubs and leagues: boards, announcements, horizons, coaches, categories, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Offices of a board in order of rank; a vice president is no president.
OFFICES = ["President", "Vice President", "Secretary", "Treasurer", "Director", "Coordinator"]

# Categories of divisions and patterns of their names; a division may be in several, and else is in Other.
CATEGORIES = {
    "10477": {"Birth Year Divisions": "^20[0-9]{2}", "Age-Based (U14-U18)": "^U[0-9]{2}", "Fed Futures": "Fed Futures"},
    "": {"Youth Divisions (U8-U14)": "^U[0-9]", "School Divisions": "SCHOOL|BOG", "Girls Divisions": "^G|GIRLS"},
}


def office_rank(title: Column) -> Column:
    """Rank of a board member's title, without regard to case."""
    x, out = F.lower(F.coalesce(title, F.lit(""))), F
    for k, office in enumerate(OFFICES, 1):
        hit = F.contains(x, F.lit(office.lower()))
        out = out.when(hit & ~F.contains(x, F.lit("vice")) if office == "President" else hit, k)
    return out.otherwise(len(OFFICES) + 1)


def board(members: DataFrame) -> DataFrame:
    """Active members with place in their club: by office, then name. members: club_id, title, name, is_active."""
    order = W.partitionBy("club_id").orderBy(office_rank(F.col("title")), "name")
    return members.where("is_active").withColumn("place", F.row_number().over(order).cast("long"))


def valid_at(as_of: Column, begin: str = "publish_date", end: str = "expire_date") -> Column:
    """Whether a row holds at a time; an end that is null is open."""
    return (F.col(begin).isNull() | (F.col(begin) <= as_of)) & (F.col(end).isNull() | (F.col(end) >= as_of))


def announcements(rows: DataFrame, as_of: Column, limit: int = 5) -> DataFrame:
    """Announcements that hold at a time, by priority as text from z to a, the newest first; the id breaks ties."""
    return rows.where(valid_at(as_of)).orderBy(F.desc("priority"), F.desc("created_at"), "id").limit(limit)


def within_days(rows: DataFrame, time: str, as_of: Column, days: int) -> DataFrame:
    """Rows from a time to so many days after it, both included."""
    return rows.where(F.col(time).between(as_of, as_of + F.make_dt_interval(F.lit(days))))


def coaches_of(coaches: DataFrame, teams: DataFrame) -> DataFrame:
    """One row for each coach and team. coaches: team_ids, a JSON list of ids; teams: team_id. Whole ids are compared."""
    ids = F.array_distinct(F.from_json("team_ids", "array<bigint>"))
    return coaches.withColumn("team_id", F.explode(ids)).join(teams, "team_id")


def categories(divisions: DataFrame) -> DataFrame:
    """Categories of divisions (division_name, league_id) with place by name; one row for each category a division is in."""
    name = F.col("division_name")

    def named(groups: dict[str, str]) -> Column:
        return F.array_compact(F.array(*[F.when(F.rlike(name, F.lit(p)), g) for g, p in groups.items()]))

    other = named(CATEGORIES[""])
    found = F.when(F.col("league_id") == "10477", named(CATEGORIES["10477"])).otherwise(other)
    rows = divisions.withColumn("category", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("Other")))))
    return rows.withColumn("place", F.row_number().over(W.partitionBy("league_id", "category").orderBy(F.lower("division_name"), "division_name")).cast("long"))


def league_summary(record: DataFrame) -> DataFrame:
    """Divisions, teams and games of each season, from the teams' records."""
    return record.groupBy("season_id").agg(F.countDistinct("division_id").alias("n_divisions"), F.count("*").alias("n_teams"), F.round(F.sum("gp") / 2).cast("long").alias("n_games"))


def share_text(part: Column, whole: Column) -> Column:
    """A percentage with one digit, as text; N/A of nothing."""
    return F.when(whole == 0, "N/A").otherwise(F.format_string("%.1f%%", part * 100.0 / whole))


def enrich(clubs: DataFrame, config: DataFrame, columns: list[str]) -> DataFrame:
    """Fill columns of clubs from a configuration, by address without its last slashes, else by name.

    clubs: url, name and the columns; config: the same, each url and name once. What a club has stays.
    """
    bare = lambda c: F.nullif(F.lower(F.regexp_replace(c, "/+$", "")), F.lit(""))
    at = config.select(bare(F.col("url")).alias("u_"), *[F.col(c).alias(f"u_{c}") for c in columns]).where("u_ is not null").withColumn("by_url_", F.lit(True))
    named = config.select(F.lower("name").alias("n_"), *[F.col(c).alias(f"n_{c}") for c in columns]).where("n_ is not null")
    out = clubs.withColumn("u_", bare(F.col("url"))).join(at, "u_", "left").withColumn("n_", F.when(F.col("by_url_").isNull(), F.lower("name"))).join(named, "n_", "left")
    return out.withColumns({c: F.coalesce(c, f"u_{c}", f"n_{c}") for c in columns}).select(*clubs.columns)


def scored_by(roster: DataFrame, events: DataFrame, event: str = "event_id") -> DataFrame:
    """Events of each player, who is known by id or by number within the team; an event counts once for a player.

    roster: team, player_id, number. events: team, scorer_id, scorer_number and a key.
    Events of a number are counted once for all who wear it; only events by id are joined to players, without those
    that their number counts already. So no event is repeated for each player of a number.
    """
    e, who = events.select("team", event, "scorer_id", "scorer_number"), roster.select("team", "player_id", "number").distinct()
    worn = who.select("team", "number").distinct()
    numbered = e.withColumnRenamed("scorer_number", "number").select("team", "number", event).join(worn, ["team", "number"], "left_semi").distinct()
    by_number = numbered.groupBy("team", "number").agg(F.count("*").alias("n_number"))
    by_id = who.join(e.withColumnRenamed("scorer_id", "player_id").select("team", "player_id", event).distinct(), ["team", "player_id"])
    held = numbered.select(F.col("team").alias("team_"), F.col("number").alias("number_"), F.col(event).alias("event_"))
    by_id = by_id.join(held, (F.col("team") == F.col("team_")) & (F.col("number") == F.col("number_")) & F.col(event).eqNullSafe(F.col("event_")), "left_anti")
    by_id = by_id.groupBy("team", "player_id", "number").agg(F.count("*").alias("n_id")).withColumnsRenamed({"team": "team_", "player_id": "player_", "number": "number_"})
    out = who.join(by_number, ["team", "number"], "left").join(by_id, (F.col("team") == F.col("team_")) & (F.col("player_id") == F.col("player_")) & F.col("number").eqNullSafe(F.col("number_")), "left")
    goals = F.coalesce("n_number", F.lit(0)) + F.coalesce("n_id", F.lit(0))
    return out.select("team", "player_id", "number", goals.alias("goals")).where("goals > 0")
