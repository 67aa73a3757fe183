"""Expected values of a small season, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from rinkframe.operators import strength, teams
from rinkframe.operators.league import League

GAMES = """g01 2025-01-01 1 2 3 2 final
g02 2025-01-02 1 3 1 1 final
g03 2025-01-02 2 3 0 4 final
g04 2025-01-05 4 5 2 5 final
g05 2025-01-05 5 6 3 3 final
g06 2025-01-05 4 6 6 0 final
g07 2025-01-06 1 4 2 4 final
g08 2025-01-09 2 1 1 2 final
g09 2025-01-10 3 5 0 2 final
g10 2025-01-12 1 2 - - final
g11 2025-01-20 2 3 - - scheduled
g12 2025-01-11 6 2 1 5 final"""


@pytest.fixture(scope="module")
def league(spark):
    rows = []
    for season in (1, 2):
        for line in GAMES.split("\n"):
            i, day, h, v, hs, vs, status = line.split()
            score = lambda x: None if x == "-" else int(x)
            if season == 1 or i != "g12":
                rows.append((season, f"{season}{i}", day, int(h), int(v), score(hs), score(vs), status))
    games = spark.createDataFrame(rows, "season_id int, game_id string, day string, home_id int, visitor_id int, home_score int, visitor_score int, status string").withColumn("game_date", F.to_date("day")).drop("day")
    names = spark.createDataFrame([(s, t, f"T{t}", 1 if t < 4 else 2) for s in (1, 2) for t in range(1, 8)], "season_id int, team_id int, team_name string, division_id int")
    goals = spark.createDataFrame([(1, "1g01", 1, "1st period", "101", 9, "102", "102", True, False, True, False), (1, "1g01", 1, "OT", "101", 9, None, None, False, False, False, False), (1, "1g01", 2, "3rd", "201", 7, "202", None, True, False, False, False)], "season_id int, game_id string, team_id int, period string, scorer_id string, scorer_number int, assist1_id string, assist2_id string, pp boolean, sh boolean, gw boolean, en boolean")
    penalties = spark.createDataFrame([(1, "1g01", 2, "201", 7, 2), (1, "1g01", 2, "203", 8, 5), (1, "1g01", 1, "101", 9, 1)], "season_id int, game_id string, team_id int, player_id string, player_number int, minutes int")
    return League(names, games, goals, penalties)


def table(df, *cols, season=1):
    return {r.team_id: tuple(r)[1:] for r in df.where(F.col("season_id") == season).select("team_id", *cols).collect()}


def test_records(league):
    got = table(teams.record(league), "gp", "w", "l", "t", "gf", "ga", "points", F.round("points_pct", 6))
    assert got == {1: (4, 2, 1, 1, 8, 8, 5, 0.625), 2: (4, 1, 3, 0, 8, 10, 2, 0.25), 3: (3, 1, 1, 1, 5, 3, 3, 0.5), 4: (3, 2, 1, 0, 12, 7, 4, 0.666667), 5: (3, 2, 0, 1, 10, 5, 5, 0.833333), 6: (3, 0, 2, 1, 4, 14, 1, 0.166667), 7: (0, 0, 0, 0, 0, 0, 0, 0.0)}
    assert table(teams.record(league), "gp", season=2)[6] == (2,)
    assert {k: v[0] for k, v in table(teams.standings(league.season(1)), "place").items()} == {1: 1, 3: 2, 2: 3, 5: 1, 4: 2, 6: 3, 7: 4}


def test_form_and_rest(league):
    assert table(teams.recent_form(league), "last_record", "streak") == {1: ("2-1-1", "W1"), 2: ("1-3-0", "W1"), 3: ("1-1-1", "L1"), 4: ("2-1-0", "W2"), 5: ("2-0-1", "W1"), 6: ("0-2-1", "L2")}
    assert table(teams.rest(league), "on_rest", "back_to_back") == {1: (3, 1), 2: (1, 2), 3: (1, 0), 4: (0, 1), 5: (1, 0), 6: (1, 0)}


def test_strength(league):
    six = league.__class__(league.teams.where("team_id < 7"), league.games, league.goals, league.penalties)
    got = table(strength.ranks(six), F.round("sos", 6), F.round("opp_opp", 6), F.round("adjusted", 6), F.round("sov", 6), "sos_rank", "sov_rank")
    assert got == {1: (0.472222, 0.513889, 0.486111, 0.25, 4, 3), 2: (0.430556, 0.541667, 0.467593, 0.166667, 6, 5), 3: (0.569444, 0.449074, 0.529321, 0.25, 2, 4), 4: (0.541667, 0.5, 0.527778, 0.395833, 3, 2), 5: (0.444444, 0.564815, 0.484568, 0.583333, 5, 1), 6: (0.583333, 0.472222, 0.546296, 0.0, 1, 6)}
    assert {k: v[0] for k, v in table(strength.thirds(six), "third").items()} == {1: "top", 2: "bottom", 3: "middle", 4: "middle", 5: "top", 6: "bottom"}
    got = table(strength.against_thirds(six), *[f"{k}_{t}" for k in ("games", "points") for t in ("top", "middle", "bottom")])
    assert got == {1: (0, 1, 1, 0, 1, 4), 2: (1, 1, 0, 0, 0, 0), 3: (1, 0, 1, 1, 0, 2), 4: (1, 0, 1, 0, 0, 2), 5: (0, 1, 1, 0, 2, 1), 6: (1, 1, 0, 1, 0, 0)}


def test_head_to_head(league):
    rows = teams.head_to_head(league).where("season_id = 1").collect()
    got = {(r.team_id, r.opponent_id): (r.gp, f"{r.w}-{r.l}-{r.t}", r.gf, r.ga, r.points, r.streak) for r in rows}
    assert got == {(1, 2): (2, "2-0-0", 5, 3, 4, "W2"), (1, 3): (1, "0-0-1", 1, 1, 1, "T1"), (1, 4): (1, "0-1-0", 2, 4, 0, "L1"), (2, 3): (1, "0-1-0", 0, 4, 0, "L1"), (2, 6): (1, "1-0-0", 5, 1, 2, "W1"), (3, 5): (1, "0-1-0", 0, 2, 0, "L1"), (4, 5): (1, "0-1-0", 2, 5, 0, "L1"), (4, 6): (1, "1-0-0", 6, 0, 2, "W1"), (5, 6): (1, "0-0-1", 3, 3, 1, "T1")}


def test_splits(league):
    got = table(teams.splits(league), "home_w", "home_l", "home_t", "home_gf", "home_ga", "away_w", "away_l", "away_t", "away_gf", "away_ga")
    assert got == {1: (1, 1, 1, 6, 7, 1, 0, 0, 2, 1), 2: (0, 2, 0, 1, 6, 1, 1, 0, 7, 4), 3: (0, 1, 0, 0, 2, 1, 0, 1, 5, 1), 4: (1, 1, 0, 8, 5, 1, 0, 0, 4, 2), 5: (0, 0, 1, 3, 3, 2, 0, 0, 7, 2), 6: (0, 1, 0, 1, 5, 0, 1, 1, 3, 9), 7: (0,) * 10}


def test_special_teams_and_periods(league):
    assert table(teams.power_play(league), "pp_goals", "pp_chances", "pp_pct")[1] == (1, 2, 50.0)
    assert table(teams.penalty_kill(league), "pp_against", "times_short", "pk_pct")[2] == (1, 2, 50.0)
    assert table(teams.period_goals(league), "p1_for", "ot_for", "p3_against")[1] == (1, 1, 1)


def test_no_nested_loops(league):
    for df in (teams.season_stats(league), strength.ranks(league), strength.against_thirds(league), teams.head_to_head(league)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
