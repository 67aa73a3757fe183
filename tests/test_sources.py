import json
from datetime import date, datetime

from pyspark.sql import functions as F

from rinkframe.functions import core
from rinkframe.operators import changes, resolve
from rinkframe.sources import documents
from rinkframe.streaming import events


def test_box_score(spark):
    who = lambda i, n: {"id": i, "number": n}
    box = {
        "home": {"id": "1", "title": "A", "finalScore": "1", "roster": {"players": [{"id": "p1", "firstName": "Al", "lastName": "B", "number": "9", "status": "Playing", "g": 1}, {"id": ""}]}},
        "visitor": {"id": "2", "title": "B", "finalScore": "0", "roster": {"players": [{"id": "p2", "number": "x"}]}},
        "tables": {
            "goalsByPeriod": [{"period": "1st", "periodEvents": [{"eventType": "goal", "time": "10:30", "powerPlay": True, "goalScorer": who("p1", "9"), "assist1By": who("", ""), "team": {"id": "1"}}, {"eventType": "other"}]}, {"period": "OT", "periodEvents": []}],
            "penaltiesByPeriod": [{"period": "2nd", "periodEvents": [{"eventType": "penalty", "time": "bad", "commitedBy": who("p2", "x"), "penaltyType": {"title": "Hooking", "duration": "2", "class": "minor"}, "team": {"id": "2"}}]}],
        },
    }
    boxes = spark.createDataFrame([("g", json.dumps(box)), ("none", None), ("odd", "{}")], "game_id string, json string")
    (g,) = documents.box_score_goals(boxes).collect()
    assert (g.game_id, g.period_number, g.game_seconds, g.team_id, g.is_home, g.scorer_id, g.scorer_number, g.assist1_id, g.pp, g.sh) == ("g", 1, 150, "1", True, "p1", 9, None, True, False)
    (p,) = documents.box_score_penalties(boxes).collect()
    assert (p.player_id, p.minutes, p.penalty, p.is_home, p.game_seconds) == ("p2", 2, "Hooking", False, None)
    assert {(r.team_id, r.player_id, r.number) for r in documents.box_score_rosters(boxes).collect()} == {("1", "p1", 9), ("2", "p2", None)}


def test_schedule_and_standings(spark):
    page = {"d1": [{"date": "2025-01-01", "games": [{"id": "7", "status": "FINAL", "homeTeam": {"id": "1", "name": "A"}, "visitor": {"id": "2", "title": "B"}}, {"status": "x"}]}]}
    (g,) = documents.schedule_games(spark.createDataFrame([(json.dumps(page),)], "json string")).collect()
    assert (g.game_id, g.status, g.home_name, g.visitor_name, g.game_date) == ("7", "final", "A", "B", "2025-01-01")
    table = [{"id": 3, "title": "D", "tableData": {"teamIds": [1, 2, 3], "teamTitles": [{"title": "A"}, {"title": "B"}], "w": [5]}}]
    rows = documents.standings_teams(spark.createDataFrame([(json.dumps(table),)], "json string")).collect()
    assert [(r.team_id, r.team_name, r.w) for r in rows] == [(1, "A", 5), (2, "B", None)]


def test_lines(spark):
    lines = spark.createDataFrame([("2nd 05:12 A. Player (B. One, C. Two)",), ("OT 1:02 Solo (Unassisted)",), ("no goal",)], "line string")
    assert [(r.period, r.time, r.player, r.assists) for r in documents.goal_lines(lines).collect()] == [("2nd", "05:12", "A. Player", ["B. One", "C. Two"]), ("OT", "1:02", "Solo", [])]
    lines = spark.createDataFrame([("1st 3:00 X Hooking 2 min",), ("4:00 X mystery 10 Min",)], "line string")
    assert [(r.penalty, r.minutes) for r in documents.penalty_lines(lines).collect()] == [("Hooking", 2), ("Unknown", 10)]


def test_validate_details(spark):
    schema = "game_id string, date string, home_team string, visitor_team string, home_score string, visitor_score string, period_scores map<string, struct<visitor:int, home:int>>, scoring_summary array<struct<player: string>>"
    rows = [("1", "d", "h", "v", "2", "1", {"1st": (1, 1), "2nd": (0, 1)}, [("a",)] * 3), ("2", "d", "h", "", "2", "1", {"1st": (1, 1)}, [("a",)]), ("3", "d", "h", "v", None, None, None, None)]
    assert {(r.game_id, r.error) for r in documents.validate_details(spark.createDataFrame(rows, schema)).collect()} == {("2", "home_period_sum"), ("2", "goal_count"), ("2", "missing_visitor_team")}


def test_names_and_dates(spark):
    df = spark.createDataFrame([("Wolves - U10B1", "x"), ("lake kings U12A Red", "x"), ("O'neil Stars (A)", "x"), (None, "x"), ("", "x")], "team string, y string")
    assert [r.c for r in df.select(resolve.club_name(F.col("team")).alias("c")).collect()] == ["Wolves", "Lake Kings", "O'Neil Stars", "", ""]
    df = spark.createDataFrame([("Canton Red Black",), ("ssc blue",), ("HULL",), ("WHK-White",), ("U-14 Stars",), ("Duxbury Pee Wee 3",)], "team string")
    assert [r.c for r in df.select(resolve.club_name(F.col("team")).alias("c")).collect()] == ["Canton Red", "SSC", "Hull", "WHK", "U-14 Stars", "Duxbury"]
    df = spark.createDataFrame([("Monday, 3/4/2025",), ("March 4, 2025",), ("2025-03-04",), ("game on 3/4/2025 late",), ("never",)], "d string")
    assert [r.d for r in df.select(resolve.date_of(F.col("d")).alias("d")).collect()] == [date(2025, 3, 4)] * 4 + [None]
    assert spark.createDataFrame([("U12B - Gold",), ("GU14A",), ("x",)], "d string").select(resolve.division_parts(F.col("d")).alias("p")).select("p.*").collect() == [("U12", "B", "Gold"), ("GU14", "A", None), (None, None, None)]
    assert resolve.fold(spark.createDataFrame([("Élan-№1",)], "n string"), "n", "f").first().f == "elanno1"
    pages = spark.createDataFrame([(1, '<a href="mailto:A@x.org">a</a><a href="mailto:a@x.org"><a href="tel:555">')], "id int, html string")
    assert {(r.kind, r.value) for r in resolve.contacts(pages, "id", "html").collect()} == {("email", "A@x.org"), ("phone", "555")}


def test_matches(spark):
    left, right = spark.createDataFrame([("Wolves",), ("Kings",)], "name string"), spark.createDataFrame([("Wolvess",), ("Kangaroos",)], "other string")
    assert [(r.name, r.other) for r in resolve.fuzzy_match(left, right).collect()] == [("Wolves", "Wolvess")]
    clubs = spark.createDataFrame([("c1", "U10", "B1", "wolves"), ("c2", "U10", None, "kings")], "club_team string, age string, level string, pattern string")
    teams = spark.createDataFrame([(1, "Wolves Red", "U10", "B2"), (2, "Wolves", "U10", "A"), (3, "Kings 1", "U10", "A"), (4, "Kings 2", "U10", "A")], "team_id int, team_name string, age string, level string")
    assert [(r.club_team, r.team_id) for r in resolve.structured_match(clubs, teams).collect()] == [("c1", 1)]
    members = lambda rows: spark.createDataFrame(rows, "age string, id string, member string")
    a, b = members([("u", "x", m) for m in "abcd"]), members([("u", "y", m) for m in "abc"] + [("u", "z", m) for m in "ad"] + [("v", "w", m) for m in "abcd"])
    assert [tuple(r) for r in resolve.best_overlap(a, b, "age", "id", "member").collect()] == [("u", "x", "y", 0.75)]


def test_changes(spark):
    old = spark.createDataFrame([(1, None, "s"), (2, 3, "f"), (9, 1, "f")], "id int, score int, status string")
    new = spark.createDataFrame([(1, 4, "f"), (2, 3, "f"), (6, None, "s")], "id int, score int, status string")
    got = {tuple(r) for r in changes.merge_snapshots(old, new, "id", ["score", "status"]).collect()}
    assert got == {(1, 4, "f", "updated"), (2, 3, "f", "unchanged"), (9, 1, "f", "kept"), (6, None, "s", "new")}
    assert {tuple(r) for r in changes.upsert(old, new, ["id"]).collect()} == {(1, 4, "f"), (2, 3, "f"), (9, 1, "f"), (6, None, "s")}
    assert changes.insert_or_ignore(old, new, ["id"]).count() == 4
    names, lookup = spark.createDataFrame([("a", " "), ("b", "B")], "id string, name string"), spark.createDataFrame([("a", "Y"), ("a", "X")], "id string, name string")
    assert {tuple(r) for r in changes.fill_blanks(names, lookup, "id", "name").collect()} == {("a", "X"), ("b", "B")}


def test_clock(spark):
    at = [datetime(2025, 1, 3, 16, 59), datetime(2025, 1, 3, 17), datetime(2025, 1, 4, 3), datetime(2025, 1, 6, 21), datetime(2025, 1, 6, 21, 0, 1)]
    rows = spark.createDataFrame([(t,) for t in at], "ts timestamp_ntz").select(core.game_day(F.col("ts")).alias("d"), core.refresh_minutes(F.col("ts")).alias("m")).collect()
    assert [(r.d, r.m) for r in rows] == [(False, 240), (True, 15), (True, 15), (True, 15), (False, 240)]
    got = spark.range(0, 25).select(core.ordinal_suffix(F.col("id")).alias("s")).collect()
    assert [got[k].s for k in (1, 2, 3, 4, 11, 12, 13, 21, 22)] == ["st", "nd", "rd", "th", "th", "th", "th", "st", "nd"]


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, datetime(2025, 1, 1, i % 5, 7 * i % 60), "ab"[i % 2], float(i)) for i in range(40)]
    batch = spark.createDataFrame(rows + rows[:5], "event_id long, ts timestamp, event_type string, value double")
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    query = events.windowed_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, events.windowed_counts(batch).collect()))


def test_fuzzy_match_against_all_pairs(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(3)
    names = ["thebruins", "bruins", "kruins", "bruinz", "", "a", "ab", "aab", "x" * 9, "élan", "elan", "wolves", "volves"] + ["".join(rng.choice("abcd1") for _ in range(rng.randint(1, 12))) for _ in range(60)]
    others = names[1::2] + ["".join(rng.sample(x, len(x))) for x in names[::3]]
    left, right = spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in others], "other string")
    for least in (0.8, 0.5):
        want = {}
        for a in names:
            found = [(-r, b) for b in others if (r := SequenceMatcher(None, a, b).ratio()) >= least]
            if found:
                want[a] = (min(found)[1], -min(found)[0])
        assert {r.name: (r.other, r.similarity) for r in resolve.fuzzy_match(left, right, least).collect()} == want
