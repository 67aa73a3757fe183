"""Strength of schedule and of victory, and results against thirds of a division."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import core
from . import teams
from .league import League, team_games

KEY = teams.KEY


def opponents(league: League) -> DataFrame:
    """Distinct opponents in final games, with or without scores."""
    return team_games(league.games, scored=False).select(*KEY, "opponent_id").distinct()


def schedule(league: League) -> DataFrame:
    """Mean percentage of opponents, of theirs (the team itself included), and both at two to one."""
    edges = opponents(league)
    pct = teams.record(league).select("season_id", F.col("team_id").alias("opponent_id"), "points_pct")
    sos = edges.join(pct, ["season_id", "opponent_id"], "left").groupBy(*KEY).agg(F.avg(F.coalesce("points_pct", F.lit(0.0))).alias("sos"), F.count("*").alias("n_opponents"))
    theirs = sos.select("season_id", F.col("team_id").alias("opponent_id"), F.col("sos").alias("their_sos"))
    two = edges.join(theirs, ["season_id", "opponent_id"], "left").groupBy(*KEY).agg(F.avg(F.coalesce("their_sos", F.lit(0.0))).alias("opp_opp"))
    out = league.teams.select(*KEY).join(sos, KEY, "left").join(two, KEY, "left").fillna(0)
    return out.withColumn("adjusted", F.col("sos") * 2 / 3 + F.col("opp_opp") / 3)


def victory(league: League) -> DataFrame:
    """Mean percentage of beaten teams, once for each win."""
    pct = teams.record(league).select("season_id", F.col("team_id").alias("opponent_id"), "points_pct")
    beaten = team_games(league.games).where("own > other").join(pct, ["season_id", "opponent_id"])
    found = beaten.groupBy(*KEY).agg(F.avg("points_pct").alias("sov"))
    return league.teams.select(*KEY).join(found, KEY, "left").fillna(0)


def ranks(league: League) -> DataFrame:
    """Season-wide ranks by both strengths; ties in order of id. Ranks run over digits that suffice to tell teams apart."""
    out = schedule(league).join(victory(league), KEY)
    by = lambda c: F.row_number().over(W.partitionBy("season_id").orderBy(F.desc(F.round(c, 9)), "team_id")).cast("long")
    return out.withColumn("sos_rank", by("sos")).withColumn("sov_rank", by("sov"))


def thirds(league: League) -> DataFrame:
    """Each team's third of its division: the first n // 3 by percentage, the last n // 3, and the rest."""
    division = W.partitionBy("season_id", "division_id")
    r = teams.record(league).withColumn("place", F.row_number().over(division.orderBy(F.desc(F.round("points_pct", 9)), "team_id"))).withColumn("n", F.count("*").over(division))
    cut = F.floor(F.col("n") / 3)
    return r.select(*KEY, "division_id", F.when(F.col("place") <= cut, "top").when(F.col("place") > F.col("n") - cut, "bottom").otherwise("middle").alias("third"))


def against_thirds(league: League) -> DataFrame:
    """Distinct opponents in each third of the team's own division, and points won against them."""
    third = thirds(league).select("season_id", "division_id", F.col("team_id").alias("opponent_id"), "third")
    own = league.teams.select(*KEY, "division_id")
    met = opponents(league).join(own, KEY).join(third, ["season_id", "division_id", "opponent_id"])
    games = team_games(league.games, scored=False).join(own, KEY).join(third, ["season_id", "division_id", "opponent_id"])
    won = F.coalesce(core.points(F.col("own"), F.col("other")), F.lit(0))
    names = ("top", "middle", "bottom")
    a = met.groupBy(*KEY).agg(*[F.count_if(F.col("third") == t).alias(f"games_{t}") for t in names])
    b = games.groupBy(*KEY).agg(*[F.sum(F.when(F.col("third") == t, won).otherwise(0)).cast("long").alias(f"points_{t}") for t in names])
    return league.teams.select(*KEY).join(a, KEY, "left").join(b, KEY, "left").fillna(0)
