"""Player statistics, leaders, search and rosters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import core
from .league import League, goal_roles

KEY = ["season_id", "team_id", "player_id"]


def basic(league: League) -> DataFrame:
    """Games with any event, goals, assists, points, situations and penalties of every player."""
    goal, assist, foul = (F.col("role") == r for r in ("g", "a", "p"))
    fouls = league.penalties.select(*KEY, "game_id", F.lit("p").alias("role"), "minutes")
    events = goal_roles(league.goals).unionByName(fouls, allowMissingColumns=True)
    counts = {"g": goal, "a": assist, "pp_g": goal & F.col("pp"), "pp_a": assist & F.col("pp"), "sh_g": goal & F.col("sh"), "sh_a": assist & F.col("sh"), "gwg": goal & F.col("gw"), "en_g": goal & F.col("en"), "penalties": foul}
    # One shuffle of events by player and game; players' rows follow from games' counts.
    games = events.groupBy(*KEY, "game_id").agg(*[F.count_if(c).alias(n) for n, c in counts.items()], F.coalesce(F.sum("minutes"), F.lit(0)).cast("long").alias("pim"), F.count_if(F.col("minutes") >= 5).alias("majors"))
    out = games.groupBy(*KEY).agg(F.count("game_id").alias("gp"), *[F.sum(c).alias(c) for c in (*counts, "pim", "majors")])
    pts = F.col("g") + F.col("a")
    return out.withColumn("pts", pts).withColumn("pts_per_game", core.ratio(pts, F.col("gp"))).withColumn("pim_per_game", core.ratio(F.col("pim"), F.col("gp")))


def scorers_only(league: League) -> DataFrame:
    """The narrower listing of scorers, in which points are goals."""
    g = league.goals.where("scorer_id is not null").groupBy("season_id", "team_id", F.col("scorer_id").alias("player_id")).agg(F.count("*").alias("g"), F.countDistinct("game_id").alias("gp"))
    return g.withColumn("pts", F.col("g")).withColumn("goals_per_game", F.col("g") / F.nullif(F.col("gp"), F.lit(0)))


#: Columns by which each category of leaders is ordered.
LEADERS = {"points": ("pts", "g"), "goals": ("g", "pts"), "assists": ("a", "pts"), "pim": ("pim",)}


def leaders(players: DataFrame, category: str = "points", limit: int | None = None, min_games: int = 1) -> DataFrame:
    """Rank, value, percentile and reading within each season."""
    first, *rest = LEADERS[category]
    season = W.partitionBy("season_id")
    order = season.orderBy(F.desc(first), *[F.desc(c) for c in rest], "player_id", "team_id")
    out = players.where(F.col("gp") >= min_games).withColumn("rank", F.row_number().over(order).cast("long")).withColumn("total_qualified", F.count("*").over(season))
    p = core.percentile(F.col("rank"), F.col("total_qualified"))
    out = out.select(*KEY, F.col(first).alias("value"), "rank", "total_qualified", p.alias("percentile"), core.interpret(p).alias("reading"), core.ordinal_suffix(F.col("rank")).alias("suffix"))
    return out if limit is None else out.where(F.col("rank") <= limit)


def card(players: DataFrame) -> DataFrame:
    """Rates and rank within the team by points, then goals."""
    rank = F.rank().over(W.partitionBy("season_id", "team_id").orderBy(F.desc("pts"), F.desc("g"))).cast("long")
    return players.select(*KEY, "gp", "pts", "pts_per_game", "pim_per_game", rank.alias("team_rank"))


def usual_number(league: League) -> DataFrame:
    """The number a scorer wore in most goals; ties go to the lower number."""
    seen = league.goals.where("scorer_id is not null").groupBy("season_id", "team_id", F.col("scorer_id").alias("player_id"), F.col("scorer_number").alias("number")).agg(F.count("*").alias("n"))
    best = W.partitionBy(*KEY).orderBy(F.desc("n"), "number")
    return seen.withColumn("nth", F.row_number().over(best)).where("nth = 1").select(*KEY, "number")


def search(players: DataFrame, number: int | None = None, team_id: int | None = None, name: str | None = None, limit: int = 50) -> DataFrame:
    """Players by number, team or part of the id; confidence .9 where number and name both match. players has number."""
    tests: list[tuple[str, Column]] = []
    if number is not None:
        tests.append(("number", F.col("number") == number))
    if team_id is not None:
        tests.append(("team", F.col("team_id") == team_id))
    if name is not None:
        tests.append(("name", F.contains(F.lower("player_id"), F.lit(name.lower()))))
    hit = reduce(lambda a, b: a & b, [t for _, t in tests], F.lit(True))
    sure = number is not None and name is not None
    out = players.where(hit).withColumn("confidence", F.lit(0.9 if sure else 0.7)).withColumn("matches", F.array_join(F.array(*[F.lit(n) for n, _ in tests]), ","))
    return out.orderBy(F.desc("pts"), "season_id", "player_id").limit(limit)


def listing(df: DataFrame, filters: list[Column | None], order: list, limit: int, offset: int = 0) -> DataFrame:
    """A page of rows with the total and whether more follow. Filters that are None are left out."""
    hit = reduce(lambda a, b: a & b, [f for f in filters if f is not None], F.lit(True))
    found = df.where(hit)
    page = found.orderBy(*order).offset(offset).limit(limit)
    return page.withColumn("total", found.agg(F.count("*")).scalar()).withColumn("has_more", F.col("total") > offset + limit)


def roster(players: DataFrame) -> DataFrame:
    """Players of each team in order of points and goals."""
    place = F.row_number().over(W.partitionBy("season_id", "team_id").orderBy(F.desc("pts"), F.desc("g"), "player_id")).cast("long")
    return players.select(*KEY, "gp", "g", "a", "pts", place.alias("place"))
