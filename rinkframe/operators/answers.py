"""Answers of the lookups of clubs and leagues: nested rows, counts of children, pages and filters.

An answer about one thing is a row with arrays of structs for its children; lists that a caller reads bit by bit are
pages after a key (`page_after`), so that a late page costs what the first does. Counts of all children come from one
grouped pass. Filters that are None are left out, so each function serves its lookups with and without them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import core
from . import directory


@dataclass
class Children:
    """Children of a thing: rows, the column that refers to it, columns by which they are ordered, and those that are shown."""

    rows: DataFrame
    key: str
    order: Sequence[str | Column] = ()
    shown: Sequence[str] = ()


def nested(parents: DataFrame, key: str, children: dict[str, Children]) -> DataFrame:
    """Parents with an array of structs for each kind of children, in order, and their number n_<kind>; empty where there are none.

    Each kind is grouped once by the parents' key, and joined without another shuffle of the parents. Where only its
    number is read, no array is made.
    """
    out = parents
    for kind, c in children.items():
        shown = list(c.shown) or [x for x in c.rows.columns if x != c.key]
        place = [F.struct(F.col(o).isNotNull(), F.col(o)) if isinstance(o, str) else o for o in c.order]
        entry = F.struct(*[p.alias(f"o{k}") for k, p in enumerate(place)], F.struct(*shown).alias("row"))
        made = c.rows.where(F.col(c.key).isNotNull()).groupBy(F.col(c.key).alias("key_")).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["row"]).alias(kind), F.count("*").alias(f"n_{kind}"))
        out = out.join(made, F.col(key) == F.col("key_"), "left").drop("key_")
        out = out.withColumn(kind, F.coalesce(kind, F.array().cast(made.schema[kind].dataType))).withColumn(f"n_{kind}", F.coalesce(f"n_{kind}", F.lit(0)))
    return out


def descending(column: str) -> Column:
    """An order of children by a number, the greatest first, nulls last."""
    x = F.col(column).cast("double")
    return F.struct(x.isNull(), -x)


def child_counts(parents: DataFrame, key: str, children: dict[str, DataFrame]) -> DataFrame:
    """Parents with the number of rows of each kind that refer to them by `key`, 0 without any: one grouping of all kinds together."""
    kinds = list(children)
    rows = reduce(DataFrame.unionByName, [df.select(F.col(key).alias("key_"), F.lit(kind).alias("kind_")) for kind, df in children.items()])
    counted = rows.groupBy("key_").agg(*[F.count_if(F.col("kind_") == k).alias(f"{k}_count") for k in kinds])
    out = parents.join(counted, F.col(key) == F.col("key_"), "left").drop("key_")
    return out.na.fill(0, [f"{k}_count" for k in kinds])


def filtered(rows: DataFrame, *tests: Column | None) -> DataFrame:
    return rows.where(reduce(lambda a, b: a & b, [t for t in tests if t is not None], F.lit(True)))


def equal(column: str, value) -> Column | None:
    """A filter on a value; none where the value is not given."""
    return None if value is None or value == "" else F.col(column) == F.lit(value)


def holding(query: str | None, *columns: Column) -> Column | None:
    """Whether one of the columns holds a text, in any case; % and _ in it stand for any characters."""
    if query is None or query == "":
        return None
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(F.ilike(c, F.lit(f"%{query}%")), F.lit(False)) for c in columns]), F.lit(False))


def page_after(rows: DataFrame, order: Sequence[str], limit: int, after: Sequence | None = None) -> DataFrame:
    """The next `limit` rows by the columns of `order`, which tell rows apart, after the key `after`; with their place and whether more follow.

    Nulls come first. A page reads what lies after its key, not the pages before it.
    """
    if after is not None:
        later, same = F.lit(False), F.lit(True)
        for c, value in zip(order, after, strict=True):
            greater = F.col(c).isNotNull() if value is None else F.coalesce(F.col(c) > F.lit(value), F.lit(False))
            later = later | (same & greater)
            same = same & F.col(c).eqNullSafe(F.lit(value))
        rows = rows.where(later)
    by = [F.asc_nulls_first(c) for c in order]
    # The window sees one row more than a page at most.
    found = rows.orderBy(*by).limit(limit + 1).withColumn("place", F.row_number().over(W.orderBy(*by)).cast("long"))
    return found.withColumn("has_more", F.max("place").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) > limit).where(F.col("place") <= limit)


def envelope(rows: DataFrame, name: str, order: Sequence[Column], limit: int, offset: int = 0) -> DataFrame:
    """One row with a page as an array and struct pagination (total, limit, offset, has_more). The array holds `limit` rows at most.

    The total is counted while the page is taken: one pass over the rows (`limit` + `offset` rows stay of each task).
    """
    place = F.row_number().over(W.orderBy(*order)).cast("long")
    top = rows.orderBy(*order).limit(limit + offset).withColumn("place_", place).where(F.col("place_") > offset)
    page = top.agg(F.transform(F.array_sort(F.collect_list(F.struct("place_", F.struct(*rows.columns).alias("row")))), lambda x: x["row"]).alias(name))
    total = rows.agg(F.count("*").alias("total_"))
    pagination = F.struct(F.col("total_").alias("total"), F.lit(limit).alias("limit"), F.lit(offset).alias("offset"), (F.lit(offset) + F.size(name) < F.col("total_")).alias("has_more"))
    # One row each.
    return page.crossJoin(total).select(name, pagination.alias("pagination"))


# Lookups of one club's directory.


def club_detail(clubs: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """Clubs with the counts of their teams, players, coaches, board members, games and contacts; all refer by club_id."""
    return child_counts(clubs, "club_id", children)


def find_clubs(clubs: DataFrame, query: str | None = None) -> DataFrame:
    """Clubs whose name, abbreviation or town holds a text; all without one. By name."""
    return filtered(clubs, holding(query, F.col("club_name"), F.col("abbreviation"), F.col("town"))).orderBy("club_name", "club_id")


def club_players(players: DataFrame, teams: DataFrame, clubs: DataFrame, club_id=None, team_id=None, name: str | None = None, club: str | None = None) -> DataFrame:
    """Players with their team and club, of one club or all, by parts of names; in order of last name and first name."""
    t = teams.select("team_id", "team_name", "team_page_url")
    c = clubs.select("club_id", "club_name", F.col("abbreviation").alias("club_abbreviation"))
    rows = filtered(players, equal("club_id", club_id), equal("team_id", team_id), holding(name, F.concat("first_name", F.lit(" "), "last_name")))
    named = filtered(c, holding(club, F.col("club_name"), F.col("club_abbreviation")))
    return rows.join(named, "club_id").join(t, "team_id", "left").orderBy("last_name", "first_name", "player_id")


def club_teams(teams: DataFrame, club_id) -> DataFrame:
    """Active teams of a club by age, level and name."""
    return filtered(teams, F.col("is_active"), equal("club_id", club_id)).orderBy("age_group", "division_level", "team_name")


def team_with_roster(teams: DataFrame, players: DataFrame, coaches: DataFrame, team_id=None) -> DataFrame:
    """Teams, or one, with their players by number and name, and their coaches by name."""
    number = F.struct(core.leading_int(F.col("jersey_number")))
    who = players.where(equal("team_id", team_id)) if team_id is not None else players
    staff = coaches.where(equal("team_id", team_id)) if team_id is not None else coaches
    children = {"players": Children(who, "team_id", [number, "last_name", "first_name"]), "coaches": Children(staff, "team_id", ["name"])}
    return nested(filtered(teams, equal("team_id", team_id)), "team_id", children)


def club_coaches(coaches: DataFrame, teams: DataFrame, club_id) -> DataFrame:
    """Coaches of a club with their team, by name."""
    rows = filtered(coaches, equal("club_id", club_id))
    return rows.join(teams.select("team_id", "team_name", "team_page_url"), "team_id", "left").orderBy("name", "team_id")


def club_contacts(contacts: DataFrame, club_id) -> DataFrame:
    return filtered(contacts, equal("club_id", club_id)).orderBy("contact_type", "value")


def club_games(games: DataFrame, club_id, team_id=None, status: str | None = None) -> DataFrame:
    """Games of a club, of one team or all, by day and time."""
    return filtered(games, equal("club_id", club_id), equal("team_id", team_id), equal("status", status)).orderBy("date", "time")


# Lookups of one league.


def players(rows: DataFrame, division: str | None = None, age_group: str | None = None, team_id=None) -> DataFrame:
    return filtered(rows, equal("division", division), equal("age_group", age_group), equal("team_id", team_id))


def player_with_evaluations(rows: DataFrame, evaluations: DataFrame, player_id=None) -> DataFrame:
    """Players, or one, with their evaluations, the newest first."""
    found = filtered(evaluations, equal("player_id", player_id))
    newest = descending_time("created_at")
    return nested(filtered(rows, equal("player_id", player_id)), "player_id", {"evaluations": Children(found, "player_id", [newest, "evaluation_id"])})


def descending_time(column: str) -> Column:
    x = F.unix_micros(F.col(column).cast("timestamp"))
    return F.struct(x.isNull(), -x)


def evaluations(rows: DataFrame, tryout_color: str | None = None, min_score: int | None = None) -> DataFrame:
    """Evaluations of a colour and a score, the best first."""
    return filtered(rows, equal("tryout_color", tryout_color), None if not min_score else F.col("total_score") >= min_score)


def teams(rows: DataFrame, division: str | None = None, season: str | None = None) -> DataFrame:
    return filtered(rows, equal("division", division), equal("season", season)).orderBy("division", "level")


def roster(rows: DataFrame, team_id) -> DataFrame:
    return filtered(rows, equal("team_id", team_id)).orderBy("jersey_number", "last_name")


def team_schedule(events: DataFrame, team_id, as_of: Column, include_past: bool = False) -> DataFrame:
    """Events of a team, by their begin; without those before a time unless these are wanted."""
    return filtered(events, equal("team_id", team_id), None if include_past else F.col("start_time") >= as_of).orderBy("start_time", "event_id")


def schedule_items(events: DataFrame, as_of: Column, days: int | None = 14, team_id=None) -> DataFrame:
    """Items of a schedule from a time on for some days, or with days=None of the same day: item_type, id, title, start_time, end_time, team_id, status."""
    rows = filtered(events, equal("team_id", team_id))
    rows = rows.where(F.to_date("start_time") == F.to_date(as_of)) if days is None else directory.within_days(rows, "start_time", as_of, days)
    return rows.select(F.lit("event").alias("item_type"), F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("id"), "title", "start_time", "end_time", "team_id", F.lit("scheduled").alias("status"))
