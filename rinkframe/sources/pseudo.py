"""A pseudo-season over the driver's tables, so that league operators run on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.league import League


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def games(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    home = key % 25
    away = (home + 1 + F.floor(key / 25) % 24) % 25
    scored = (F.col("o_orderstatus") == "F") & (key % 97 != 0)
    price = F.col("o_totalprice")
    return orders.select(
        F.year("o_orderdate").cast("long").alias("season_id"),
        key.alias("game_id"),
        F.to_date("o_orderdate").alias("game_date"),
        home.alias("home_id"),
        away.alias("visitor_id"),
        F.when(scored, F.floor(price) % 7).alias("home_score"),
        F.when(scored, F.floor(price / 7) % 7).alias("visitor_score"),
        F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "scheduled").otherwise("in_progress").alias("status"),
    )


def league(spark: SparkSession, sf_dir: str) -> League:
    """Nations are teams, regions divisions, orders games, lineitems goals and penalties."""
    g = games(read(spark, sf_dir, "orders"))
    nation = read(spark, sf_dir, "nation")
    seasons = g.select("season_id").distinct()
    teams = nation.select(F.col("n_nationkey").cast("long").alias("team_id"), F.col("n_name").alias("team_name"), F.col("n_regionkey").cast("long").alias("division_id"))
    # Twenty-five teams in each season.
    teams = seasons.withColumn("team_id", F.explode(F.sequence(F.lit(0), F.lit(24)))).withColumn("team_id", F.col("team_id").cast("long")).join(teams, "team_id").select("season_id", "team_id", "team_name", "division_id")
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    e = items.join(g.select("game_id", "season_id", "home_id", "visitor_id"), items["l_orderkey"] == g["game_id"])
    team = F.when(F.col("l_linestatus") == "F", F.col("home_id")).otherwise(F.col("visitor_id"))
    e = e.withColumn("team_id", team)
    player = lambda n: F.concat(F.lit("p"), F.col("team_id").cast("string"), F.lit("_"), n.cast("string"))
    number = F.col("l_suppkey") % 20
    worn = number + F.when(F.col("l_quantity") == 1, 50).otherwise(0)
    line = F.col("l_linenumber")
    period = F.element_at(F.array(F.lit("1st"), F.lit("2nd"), F.lit("3rd"), F.lit("OT")), line % 4 + 1)
    flag = F.col("l_returnflag")
    goals = e.where(flag.isin("A", "N")).select(
        "season_id", "game_id", "team_id", period.alias("period"), player(number).alias("scorer_id"), worn.alias("scorer_number"),
        F.when(flag == "A", player(F.col("l_partkey") % 20)).alias("assist1_id"), F.when((flag == "A") & (line % 2 == 0), player((F.col("l_partkey") + 7) % 20)).alias("assist2_id"),
        (line == 1).alias("pp"), (line == 2).alias("sh"), (line == 3).alias("gw"), (line == 7).alias("en"),
    )
    minutes = F.when(line % 4 == 0, 10).when(line % 4 == 3, 5).otherwise(2)
    penalties = e.where(flag == "R").select("season_id", "game_id", "team_id", player(number).alias("player_id"), worn.alias("player_number"), minutes.cast("long").alias("minutes"))
    return League(teams, g, goals, penalties)
