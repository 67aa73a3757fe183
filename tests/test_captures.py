import json
from itertools import takewhile

from pyspark.sql import functions as F

from rinkframe.operators import directory
from rinkframe.sources import captured, club_files, documents, scratch


def write(root, files):
    for name, text in files.items():
        place = root / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_text(text if isinstance(text, str) else json.dumps(text, indent=2))
    return f"file://{root}"


def test_club_directories(spark, tmp_path):
    info = {"club_name": "Bears", "club_slug": "bears", "website_url": "http://b/", "town": None, "other": [1]}
    folder = write(
        tmp_path,
        {
            "bears/club_info.json": info,
            "bears/teams.json": [{"club_name": "Bears", "team_name": "B1", "coach": {"x": 1}, "age_group": "U10"}, 5, "text", None, {"club_name": "Bears"}, {"club_name": None, "team_name": None}],
            "bears/players.json": [{"club_name": "Bears", "team_name": "B1", "name": "Al", "jersey_number": 7}],
            "bears/coaches.json": '[{"club_name": "Bears", ',
            "bears/board_members.json": {"club_name": "Bears", "name": "Not in a list"},
            "bears/games.json": [{"club_name": "B", "team_name": "B1", "date": "2024-01-02", "opponent": "F", "is_home": True, "home_score": 3, "status": None}, {"club_name": "B", "team_name": "B1", "date": "d", "opponent": "G"}],
            "foxes/club_info.json": {"club_name": "Foxes", "club_slug": "foxes", "website_url": None, "conference": "X"},
            "foxes/contacts.json": [],
            "nobody/teams.json": [{"club_name": "N", "team_name": "N1"}],
            "half/club_info.json": {"club_name": "Half"},
            "half/teams.json": [{"club_name": "H", "team_name": "H1"}],
            "odd/club_info.json": "[1]",
        },
    )
    clubs = {r.club: r for r in club_files.clubs(spark, folder).collect()}
    assert clubs.keys() == {"bears", "foxes"} and clubs["bears"].conference == "SSC" and clubs["foxes"].conference == "X" and clubs["bears"].town is None
    teams = club_files.read_list(spark, folder, "teams").orderBy("place").collect()
    assert [(r.club, r.team_name, r.age_group, r.source_url) for r in teams] == [("bears", "B1", "U10", ""), ("bears", None, None, "")]
    assert [r.jersey_number for r in club_files.read_list(spark, folder, "players").collect()] == ["7"]
    games = club_files.read_list(spark, folder, "games").orderBy("place").collect()
    assert [(r.status, r.home_score, r.is_home) for r in games] == [(None, 3, True), ("scheduled", None, None)]
    assert {tuple(r) for r in club_files.bad_files(spark, folder).collect()} == {("bears", "coaches.json", "no JSON"), ("bears", "board_members.json", "no list"), ("half", "club_info.json", "keys are missing"), ("odd", "club_info.json", "no JSON")}
    got = {r.club: r[2:] for r in club_files.counts(spark, folder).collect()}
    assert got == {"bears": (2, 1, 0, 0, 2, 0), "foxes": (0, 0, 0, 0, 0, 0)}
    config = spark.createDataFrame([(json.dumps({"conference": "SSC", "season": "s", "clubs": [{"name": "x", "url": "http://b", "town": "T", "abbreviation": "B"}, {"name": "FOXES", "town": "U", "more": 1}]}),)], "value string")
    named = club_files.clubs(spark, folder).select("club", F.col("website_url").alias("url"), F.col("club_name").alias("name"), "town", "abbreviation")
    filled = directory.enrich(named, club_files.configured_clubs(config), ["town", "abbreviation"]).collect()
    assert {(r.club, r.town, r.abbreviation) for r in filled} == {("bears", "T", "B"), ("foxes", "U", None)}


def test_configured_divisions(spark):
    text = {"season_id": "7", "season_info": {"title": "S"}, "divisions": {"U10": "1", "HIGH  SCHOOL": "2"}, "division_count": 2}
    rows = club_files.configured_divisions(spark.createDataFrame([(json.dumps(text),), ("no",), (None,)], "value string")).collect()
    assert {tuple(r) for r in rows} == {("7", "S", "U10", "1"), ("7", "S", "HIGH  SCHOOL", "2")}


def page(n):
    return json.dumps({"d": [{"date": "2024-01-01", "games": [{"id": f"g{k}"} for k in range(n)]}]})


def test_paged_schedules(spark, tmp_path):
    sizes = {"1": [10, 10, 4, 10], "2": [10, None, 10], "3": [0], "4": [3], "5": [10, 10], "6": [None, 10], "7": [10] * 8}
    files = {f"{d}/{10 * k}.json": page(n) for d, p in sizes.items() for k, n in enumerate(p) if n is not None} | {"1/15.json": page(10), "8/0.json": "broken", "9/x.json": "[]"}
    folder = write(tmp_path, files)
    found = captured.pages(spark, folder)
    assert found.rdd.getNumPartitions() == len(files) - 1 and found.count() == len(files) - 1
    part = found.where("division = '1' and page_offset >= 20 and page_offset < 30 and json is not null")
    assert part.rdd.getNumPartitions() == 1 and [r.page_offset for r in part.collect()] == [20]
    assert captured.pages(spark, folder).where("division in ('2', '3')").rdd.getNumPartitions() == 3
    assert found.where("division = 'none'").count() == 0
    counted = found.withColumn("n_games", documents.games_in(F.col("json")))
    got = {(r.division, r.page_offset) for r in captured.whole_pages(counted, limit=10, most=50).collect()}
    want = set()
    for d, p in sizes.items():
        full = len(list(takewhile(lambda n: n == 10, p)))
        want |= {(d, 10 * k) for k in range(min(full + 1, len(p), 6)) if p[k] is not None}
    assert got == want | {("8", 0)}
    assert {r.game_id for r in documents.schedule_games(captured.whole_pages(counted, limit=10).where("division = '4'")).collect()} == {"g0", "g1", "g2"}


def test_fetched_documents(spark, tmp_path):
    rows = spark.createDataFrame([(f"{k}.json", None if k % 3 == 0 else f"<{k}>") for k in range(20)] + [("a/b.json", "é")], "path string, text string")
    folder = f"file://{tmp_path}"
    assert scratch.write_files(rows, folder) == 14
    got = captured.fetch_documents(spark.createDataFrame([(k,) for k in [*range(25), None]], "game_id long"), folder).collect()
    assert {r.game_id: r.json for r in got} == {k: f"<{k}>" if k < 20 and k % 3 else None for k in range(25)} | {None: None}
    assert captured.fetch_documents(spark.createDataFrame([("a/b",)], "id string"), folder, "id").collect()[0].json == "é"
