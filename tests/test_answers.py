from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rinkframe.operators import answers, logos


def rows(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


@pytest.fixture(scope="module")
def club(spark):
    return {
        "clubs": rows(spark, "club_id int, club_name string, abbreviation string, town string", (1, "Bears", "BEA", "Hull"), (2, "Foxes", None, "North Bay"), (3, "Owls", "O%", None)),
        "teams": rows(spark, "team_id int, club_id int, team_name string, age_group string, division_level string, is_active boolean, team_page_url string", (10, 1, "B1", "U10", "B", True, "u"), (11, 1, "B2", "U10", "A", True, None), (12, 1, "B3", "U8", None, False, None), (20, 2, "F1", "U8", "A", True, None)),
        "players": rows(spark, "player_id int, club_id int, team_id int, first_name string, last_name string, jersey_number string", (1, 1, 10, "Al", "Zed", "7b"), (2, 1, 10, "Bo", "Young", "10"), (3, 1, None, "Cy", "Xu", None), (4, 2, 20, "Al", "Young", "7"), (5, 1, 10, "Di", "Zed", None)),
        "coaches": rows(spark, "coach_id int, club_id int, team_id int, name string", (1, 1, 10, "Kim"), (2, 1, 10, "Jo"), (3, 1, 99, "Lee")),
        "games": rows(spark, "game_id int, club_id int, team_id int, date string, time string, status string", (1, 1, 10, "2024-01-02", "8:00", "final"), (2, 1, 11, "2024-01-01", None, "scheduled")),
        "contacts": rows(spark, "club_id int, contact_type string, value string", (1, "phone", "2"), (1, "email", "b"), (1, "email", "a")),
    }


def test_club_detail(club):
    children = {k: club[n] for k, n in (("team", "teams"), ("player", "players"), ("coach", "coaches"), ("game", "games"), ("contact", "contacts"))}
    out = answers.club_detail(club["clubs"], children).orderBy("club_id")
    assert [tuple(r)[4:] for r in out.collect()] == [(3, 4, 3, 2, 3), (1, 1, 0, 0, 0), (0, 0, 0, 0, 0)]
    assert out._jdf.queryExecution().executedPlan().toString().count("keys=[key_") in (2, 4)  # one grouping of all kinds, in two halves


def test_team_with_roster(club):
    (t,) = answers.team_with_roster(club["teams"], club["players"], club["coaches"], 10).collect()
    assert [(p.jersey_number, p.last_name) for p in t.players] == [(None, "Zed"), ("7b", "Zed"), ("10", "Young")] and [c.name for c in t.coaches] == ["Jo", "Kim"] and (t.n_players, t.n_coaches) == (3, 2)
    every = {r.team_id: (r.n_players, r.n_coaches, r.players) for r in answers.team_with_roster(club["teams"], club["players"], club["coaches"]).collect()}
    assert every[12] == (0, 0, []) and every[20][:2] == (1, 0) and len(every) == 4


def test_lists_and_searches(club):
    names = lambda df, c: [r[c] for r in df.collect()]
    assert names(answers.find_clubs(club["clubs"]), "club_name") == ["Bears", "Foxes", "Owls"]
    assert names(answers.find_clubs(club["clubs"], "BAY"), "club_id") == [2] and names(answers.find_clubs(club["clubs"], "be"), "club_id") == [1] and names(answers.find_clubs(club["clubs"], "o_l"), "club_id") == [3]
    find = lambda **k: names(answers.club_players(club["players"], club["teams"], club["clubs"], **k), "player_id")
    assert find() == [3, 4, 2, 1, 5] and find(name="al y") == [4] and find(club="ears") == [3, 2, 1, 5] and find(club_id=1, team_id=10) == [2, 1, 5] and find(name="AL", club="fox") == [4]
    assert names(answers.club_teams(club["teams"], 1), "team_id") == [11, 10] and names(answers.club_coaches(club["coaches"], club["teams"], 1), "team_name") == ["B1", "B1", None]
    assert names(answers.club_contacts(club["contacts"], 1), "value") == ["a", "b", "2"] and names(answers.club_games(club["games"], 1), "game_id") == [2, 1] and names(answers.club_games(club["games"], 1, status="final"), "game_id") == [1]


def test_pages_after_a_key(spark):
    values = [(None, 1), (None, 2), ("a", 5), ("a", 7), ("b", 1), ("b", None), ("c", 3)]
    df, seen, after = rows(spark, "k string, n int", *values), [], None
    for size in range(10):
        page = answers.page_after(df, ["k", "n"], 2, after).collect()
        seen += [(r.k, r.n) for r in page]
        assert [r.place for r in page] == list(range(1, len(page) + 1))
        if not page or not page[-1].has_more:
            break
        after = seen[-1]
    assert seen == [(None, 1), (None, 2), ("a", 5), ("a", 7), ("b", None), ("b", 1), ("c", 3)]
    plan = answers.page_after(df, ["k", "n"], 2, ("a", 5))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_envelope(spark):
    df = rows(spark, "n int, x string", *[(k, f"x{k}") for k in range(7)])
    (r,) = answers.envelope(df, "players", [F.desc("n")], 3, 2).collect()
    assert [p.n for p in r.players] == [4, 3, 2] and tuple(r.pagination) == (7, 3, 2, True)
    (r,) = answers.envelope(df, "players", [F.asc("n")], 3, 6).collect()
    assert [p.n for p in r.players] == [6] and not r.pagination.has_more
    (r,) = answers.envelope(df.limit(0), "players", [F.asc("n")], 3).collect()
    assert r.players == [] and r.pagination.total == 0


def test_league_lookups(spark):
    who = rows(spark, "player_id string, division string, age_group string, team_id int", ("a", "A", "U10", 1), ("b", "A", "U8", 2), ("c", None, "U8", 1))
    assert [r.player_id for r in answers.players(who, division="A", age_group="U8").collect()] == ["b"] and answers.players(who, team_id=1).count() == 2
    at = lambda d: datetime(2024, 1, d)
    marks = rows(spark, "evaluation_id int, player_id string, created_at timestamp, tryout_color string, total_score int", (1, "a", at(1), "red", 5), (2, "a", at(3), "blue", 9), (3, "a", None, "red", 7), (4, "b", at(2), "red", None))
    got = {r.player_id: [e.evaluation_id for e in r.evaluations] for r in answers.player_with_evaluations(who, marks).collect()}
    assert got == {"a": [2, 1, 3], "b": [4], "c": []} and answers.player_with_evaluations(who, marks, "a").count() == 1
    assert {r.evaluation_id for r in answers.evaluations(marks, "red", 6).collect()} == {3}
    events = rows(spark, "event_id int, title string, start_time timestamp, end_time timestamp, team_id int", (1, "x", at(1), None, 1), (2, "y", at(5), at(6), 1), (3, "z", at(5), None, 2))
    now = F.lit("2024-01-04").cast("timestamp")
    assert [r.event_id for r in answers.team_schedule(events, 1, now).collect()] == [2] and answers.team_schedule(events, 1, now, True).count() == 2
    assert sorted(r.id for r in answers.schedule_items(events, now, 1).collect()) == ["event_2", "event_3"] and [r.id for r in answers.schedule_items(events, F.lit("2024-01-01 20:00:00").cast("timestamp"), None).collect()] == ["event_1"]


def test_logo_tables_and_lookup(spark):
    files = rows(spark, "file string", ("bears.svg",), ("Be-ars.PNG",), ("BSHL.svg",), ("north_bay foxes.webp",), ("notes.txt",), ("noext",))
    teams = rows(spark, "team_name string, team_id int, logo_url string", ("Bears U10 Blue", 1, "http://b"), ("Bears Gold", 2, "http://a"), ("Owls", 3, "http://o"), ("Owls", 4, "http://o"), ("Elks", 5, ""), ("Mice", 6, None))
    manual = rows(spark, "alias string, file string", ("The Foxes", "north_bay foxes.webp"), ("Nobody", "absent.svg"), ("Owls", "BSHL.svg"))
    built, aliases = logos.build(files, teams, manual)
    got = {r.canonical_name: tuple(r)[1:] for r in built.collect()}
    assert got == {
        "bears": ("Be Ars", "bears.svg", "http://a", False, "both"),
        "bshl": ("Bshl", "BSHL.svg", None, True, "local"),
        "northbayfoxes": ("North Bay Foxes", "north_bay foxes.webp", None, False, "local"),
        "owls": ("Owls", None, "http://o", False, "league"),
    }
    assert {tuple(r) for r in aliases.collect()} == {("Bears U10 Blue", 1, "bears", 1.0, False), ("Bears Gold", 2, "bears", 1.0, False), ("Owls", 3, "owls", 1.0, False), ("Owls", 4, "owls", 1.0, False), ("The Foxes", None, "northbayfoxes", 1.0, True), ("Owls", None, "bshl", 1.0, True)}
    assert {r.counter: r.n for r in logos.statistics(built, aliases).collect()} == {"total_logos": 4, "with_local": 3, "with_league": 2, "with_both": 1, "total_aliases": 6, "manual_overrides": 2}
    # Built again over itself, with a new file and a new address: the file moves, the address stays, nothing doubles.
    again, more = logos.build(rows(spark, "file string", ("bears_.svg",), ("bears.zip",)), rows(spark, "team_name string, team_id int, logo_url string", ("Bears U10 Blue", 1, "http://0"), ("Mice", 6, "http://m")), manual, (built, aliases))
    got = {r.canonical_name: (r.display_name, r.local_file, r.logo_url, r.source) for r in again.collect()}
    assert got["bears"] == ("Be Ars", "bears_.svg", "http://a", "both") and got["mice"] == ("Mice", None, "http://m", "league") and len(got) == 5 and more.count() == 7
    names = rows(spark, "team_name string, team_id int", ("Bears Gold", 2), ("Bears Gold", 9), ("Owls", None), ("Owls", 3), ("The Foxes", None), ("the foxes", None), ("North Bay Foxez", None), ("Zzz", 1))
    got = {(r.team_name, r.team_id): (r.local_file, r.logo_url, r.confidence, r.source, r.how) for r in logos.lookup(names, built, aliases).collect()}
    assert got["Bears Gold", 2] == ("bears.svg", "http://a", 1.0, "both", "alias") and got["Bears Gold", 9] == ("bears.svg", "http://a", 0.9, "both", "canonical")
    assert got["Owls", None] == ("BSHL.svg", None, 1.0, "local", "alias") and got["Owls", 3] == (None, "http://o", 1.0, "league", "alias")
    assert got["The Foxes", None][4] == "alias" and got["the foxes", None] == ("north_bay foxes.webp", None, 1.0, "local", "alias")
    assert got["North Bay Foxez", None][0] == "north_bay foxes.webp" and got["North Bay Foxez", None][4] == "similar" and got["Zzz", 1] == (None, None, None, "none", "none") and len(got) == 8


def test_picture(spark):
    df = rows(spark, "name string", ("The BEARS U10",), ("tri  county",), (None,), ("x",))
    out = df.select(logos.picture(F.col("name"), {"bears": "b.svg"}, {r"tri\s*county": "t.svg", "bear": "c.svg"}).alias("p")).collect()
    assert [r.p for r in out] == ["b.svg", "t.svg", None, None]


def test_numbers_of_children_alone_make_no_arrays(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id long")
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "parent long, name string")
    out = answers.nested(parents, "id", {"x": answers.Children(rows, "parent", ["name"])}).select("id", "n_x")
    assert sorted(map(tuple, out.collect())) == [(1, 2), (2, 0)]
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
