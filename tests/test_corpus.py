from dataclasses import replace

from pyspark.sql import functions as F

from rinkframe.plans import corpus


def test_undefeated_at_home_reads_all_games(spark, monkeypatch):
    rows = [(1, 1, 5, 6, 0, 1), (1, 2, 5, 7, 3, 1), (1, 3, 6, 5, 2, 2), (1, 4, 7, 5, None, None)]
    games = spark.createDataFrame(rows, "season_id long, game_id long, home_id long, visitor_id long, home_score long, visitor_score long")
    league = corpus.pseudo.league(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(corpus.pseudo, "league", lambda *_: replace(league, games=games.withColumns({"game_date": F.lit("2024-01-01").cast("date"), "status": F.lit("final")})))
    assert [tuple(r) for r in corpus.ask(spark, "", "undefeated_at_home").collect()] == [(1, 6, 1)]
