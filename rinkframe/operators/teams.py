"""Records, goals by period, special teams, splits and form of teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import core
from .league import League, team_games

KEY = ["season_id", "team_id"]


def record(league: League) -> DataFrame:
    """Games, wins, losses, ties, goals and points of every team, zeros without games."""
    g = team_games(league.games)
    won = g.groupBy(*KEY).agg(F.count("*").alias("gp"), F.count_if(F.col("own") > F.col("other")).alias("w"), F.count_if(F.col("own") < F.col("other")).alias("l"), F.count_if(F.col("own") == F.col("other")).alias("t"), F.sum("own").alias("gf"), F.sum("other").alias("ga"))
    out = league.teams.join(won, KEY, "left").fillna(0, ["gp", "w", "l", "t", "gf", "ga"])
    c = {k: F.col(k) for k in ("gp", "w", "l", "t", "gf", "ga")}
    points = c["w"] * 2 + c["t"]
    return out.select(*KEY, "team_name", "division_id", *c.values(), (c["gf"] - c["ga"]).alias("gd"), points.alias("points"), core.ratio(points, c["gp"] * 2).alias("points_pct"), core.ratio(c["gf"], c["gp"]).alias("gpg"), core.ratio(c["ga"], c["gp"]).alias("gapg"), c["w"].alias("row_wins"))


def standings(league: League) -> DataFrame:
    """Teams in order within their division: points, wins, goals for, then id."""
    order = W.partitionBy("season_id", "division_id").orderBy(F.desc("points"), F.desc("w"), F.desc("gf"), "team_id")
    return record(league).withColumn("place", F.row_number().over(order).cast("long")).withColumn("record", core.record(F.col("w"), F.col("l"), F.col("t")))


def _counts(league: League, events: DataFrame, counts: dict[str, tuple[bool, Column]]) -> DataFrame:
    """Counts for every team, zeros without events, of events that are its own (True) or against it (False).

    Events meet their games once and are one row for either side; what is against no side of
    its game counts for its own team only.
    """
    sides = league.games.select("season_id", "game_id", "home_id", "visitor_id").where("home_id <> visitor_id")
    against = F.when(F.col("by_id") == F.col("home_id"), F.col("visitor_id")).when(F.col("by_id") == F.col("visitor_id"), F.col("home_id"))
    both = F.array(F.struct(F.col("by_id").alias("team_id"), F.lit(True).alias("mine")), F.struct(against.alias("team_id"), F.lit(False).alias("mine")))
    e = events.withColumnRenamed("team_id", "by_id").join(sides, ["season_id", "game_id"], "left").select("*", F.inline(both)).where("team_id is not null")
    found = e.groupBy(*KEY).agg(*[F.count_if((F.col("mine") == mine) & c).alias(n) for n, (mine, c) in counts.items()])
    return league.teams.select(*KEY).join(found, KEY, "left").fillna(0, list(counts)).select(*KEY, *counts)


def _goals(league: League) -> DataFrame:
    return league.goals.select("season_id", "game_id", "team_id", "period", "pp", F.lit(False).alias("foul"))


def _fouls(league: League) -> DataFrame:
    """Penalties of two minutes or more."""
    return league.penalties.where("minutes >= 2").select("season_id", "game_id", "team_id", F.lit(None).cast("string").alias("period"), F.lit(False).alias("pp"), F.lit(True).alias("foul"))


def _period_counts() -> dict[str, tuple[bool, Column]]:
    number = core.period_number(F.col("period"))
    return {f"{n}_{kind}": (mine, ~F.col("foul") & (number == k)) for kind, mine in (("for", True), ("against", False)) for k, n in ((1, "p1"), (2, "p2"), (3, "p3"), (4, "ot"))}


def _power_play_counts() -> dict[str, tuple[bool, Column]]:
    return {"pp_goals": (True, F.col("pp")), "pp_chances": (False, F.col("foul"))}


def _penalty_kill_counts() -> dict[str, tuple[bool, Column]]:
    return {"pp_against": (False, F.col("pp")), "times_short": (True, F.col("foul"))}


def _special(league: League) -> DataFrame:
    return _goals(league).where("pp").unionByName(_fouls(league))


def _with_pp_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("pp_pct", core.ratio(F.col("pp_goals"), F.col("pp_chances"), 100.0))


def _with_pk_pct(df: DataFrame) -> DataFrame:
    return df.withColumn("pk_pct", core.ratio(F.col("times_short") - F.col("pp_against"), F.col("times_short"), 100.0))


def period_goals(league: League) -> DataFrame:
    """Goals for and against by period; labels that mean one period add up."""
    return _counts(league, _goals(league), _period_counts())


def power_play(league: League) -> DataFrame:
    """Goals with the extra player, chances (opponents' penalties of two minutes or more) and their percentage."""
    return _with_pp_pct(_counts(league, _special(league), _power_play_counts()))


def penalty_kill(league: League) -> DataFrame:
    """Goals against while short, times short and the percentage survived."""
    return _with_pk_pct(_counts(league, _special(league), _penalty_kill_counts()))


def splits(league: League) -> DataFrame:
    """Records at home and away."""
    g = team_games(league.games)
    aggs = []
    for side, here in (("home", F.col("is_home")), ("away", ~F.col("is_home"))):
        aggs += [F.count_if(here & (F.col("own") > F.col("other"))).alias(f"{side}_w"), F.count_if(here & (F.col("own") < F.col("other"))).alias(f"{side}_l"), F.count_if(here & (F.col("own") == F.col("other"))).alias(f"{side}_t")]
        aggs += [F.coalesce(F.sum(F.when(here, F.col(c))), F.lit(0)).alias(f"{side}_{n}") for c, n in (("own", "gf"), ("other", "ga"))]
    found = g.groupBy(*KEY).agg(*aggs)
    return league.teams.select(*KEY).join(found, KEY, "left").fillna(0)


def last_and_streak(games: DataFrame, key: list[str], last: int) -> DataFrame:
    """Record of the last games and the streak at the end. games: key, game_date, game_id, own, other."""
    latest = W.partitionBy(*key).orderBy(F.desc("game_date"), F.desc("game_id"))
    g = games.withColumn("result", core.result(F.col("own"), F.col("other"))).withColumn("nth", F.row_number().over(latest))
    g = g.withColumn("newest", F.first("result").over(latest))
    near = F.col("nth") <= last
    tally = [F.count_if(near & (F.col("result") == r)) for r in "WLT"]
    ended = F.min(F.when(F.col("result") != F.col("newest"), F.col("nth")))
    return g.groupBy(*key).agg(core.record(*tally).alias("last_record"), F.concat(F.first("newest"), F.coalesce(ended - 1, F.count("*")).cast("string")).alias("streak"))


def recent_form(league: League, last: int = 10) -> DataFrame:
    """Record of the last ten games and the current streak."""
    return last_and_streak(team_games(league.games), KEY, last)


def rest(league: League) -> DataFrame:
    """Games after two days of rest or more, and back to back; finals without scores count."""
    order = W.partitionBy(*KEY).orderBy("game_date", "game_id")
    days = F.datediff("game_date", F.lag("game_date").over(order)) - 1
    g = team_games(league.games, scored=False).withColumn("days", days)
    out = g.groupBy(*KEY).agg(F.count_if(F.col("days") >= 2).alias("on_rest"), F.count_if(F.col("days") == 0).alias("back_to_back"))
    return out.withColumn("differential", F.col("on_rest") - F.col("back_to_back"))


def season_stats(league: League) -> DataFrame:
    """All of a team's season in one wide row."""
    # Goals and penalties are read once and meet their games once, for all their counts.
    events = _counts(league, _goals(league).unionByName(_fouls(league)), _period_counts() | _power_play_counts() | _penalty_kill_counts())
    out = record(league)
    for part in (_with_pk_pct(_with_pp_pct(events)), splits(league), recent_form(league), rest(league)):
        out = out.join(part, KEY, "left")
    return out


def profile(league: League, recent: int = 5) -> DataFrame:
    """Rank in the division, its averages, the latest games and the streak within them."""
    r = record(league)
    rank = F.rank().over(W.partitionBy("season_id", "division_id").orderBy(F.desc("points"), F.desc("gf"))).cast("long")
    division = W.partitionBy("season_id", "division_id")
    r = r.withColumn("rank", rank).withColumn("division_teams", F.count("*").over(division)).withColumn("division_gpg", F.avg(F.when(F.col("gp") > 0, F.col("gf") / F.col("gp"))).over(division))
    latest = W.partitionBy(*KEY).orderBy(F.desc("game_date"), F.desc("game_id"))
    g = team_games(league.games).withColumn("nth", F.row_number().over(latest)).where(F.col("nth") <= recent)
    streak = last_and_streak(g.drop("nth"), KEY, recent).select(*KEY, "streak")
    score = F.concat(F.col("own").cast("string"), F.lit("-"), F.col("other").cast("string"))
    games = g.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("nth", "game_id", "opponent_id", score.alias("score"), "is_home"))).alias("recent"))
    out = r.join(games, KEY, "left").join(streak, KEY, "left")
    return out.withColumn("goals_in_context", core.in_context(F.col("gpg"), F.col("rank"), F.col("division_teams")))


def head_to_head(league: League, last: int = 5) -> DataFrame:
    """Every pair of teams that met, from the view of the lower id."""
    g = team_games(league.games).where("team_id < opponent_id")
    key = ["season_id", "team_id", "opponent_id"]
    own, other = F.col("own"), F.col("other")
    base = g.groupBy(*key).agg(F.count("*").alias("gp"), F.count_if(own > other).alias("w"), F.count_if(own < other).alias("l"), F.count_if(own == other).alias("t"), F.sum("own").alias("gf"), F.sum("other").alias("ga"), F.sum(core.points(own, other)).cast("long").alias("points"))
    pp = g.join(league.goals.where("pp").select("game_id", F.col("team_id")), ["game_id", "team_id"]).groupBy(*key).agg(F.count("*").alias("pp_goals"))
    fouls = league.penalties.where("minutes >= 2").select("game_id", F.col("team_id").alias("opponent_id"))
    chances = g.join(fouls, ["game_id", "opponent_id"]).groupBy(*key).agg(F.count("*").alias("pp_chances"))
    form = last_and_streak(g, key, last)
    out = base.join(form, key).join(pp, key, "left").join(chances, key, "left").fillna(0, ["pp_goals", "pp_chances"])
    out = out.withColumn("pp_pct", core.ratio(F.col("pp_goals"), F.col("pp_chances"), 100.0))
    return out.withColumn("points_pct", core.ratio(F.col("points"), F.col("gp") * 2)).withColumn("gd", F.col("gf") - F.col("ga"))
