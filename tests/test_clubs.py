from pyspark.sql import functions as F

from rinkframe.operators import changes, directory, names
from rinkframe.sources import documents


def values(spark, make, rows, cols=("x",)):
    types = ", ".join(f"{c} string" for c in cols)
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], types).withColumn("nth", F.monotonically_increasing_id())
    return [r[0] for r in df.select(make(*[F.col(c) for c in cols]).alias("y"), "nth").orderBy("nth").select("y").collect()]


def test_ages_and_levels(spark):
    assert values(spark, names.age_code, [" Squirts", "mighty mites", "MITE", "LTP", "adult", None]) == ["U10", "U6", "U8", None, None, None]
    assert values(spark, names.age_in, ["Hull u12 B", "Pee  wee", "x", None]) == ["u12", "Pee  wee", None, None]
    assert values(spark, names.level_in, ["Hull B2 Red", "Hull red", "Hull", None]) == ["B2", "red", None, None]


def test_names_and_titles(spark):
    assert [r and tuple(r) for r in values(spark, names.name_and_title, ["Ann Lee - Vice President", "Registrar: Bo", "Ann - Bo", "x" * 121 + " - President", "", None])] == [("Ann Lee", "Vice President"), ("Bo", "Registrar"), None, None, None, None]
    assert values(spark, names.joined_name, ["EdwardBourget", "EDWARDBOURGET", "ED LEE", "ED", "ann", ""]) == ["Edward Bourget", "Edwardbourget", "Ed Lee", "ED", "ann", ""]
    assert values(spark, names.staff_title, ["Mite Minor (15) - elite coach", "asst coach", None]) == ["Mite Minor (15) - Elite Coach", "Assistant Coach", "Coach"]
    assert values(spark, names.coach_role, ["Asst. Coach", "Trainer", None]) == ["Assistant Coach", "Coach", "Coach"]


def test_teams_and_programs(spark):
    assert values(spark, lambda x: names.is_team(x, F.lit("WHK")), ["WHK", "WHK Blue", "Hull Teams", "U8 Teams", "06ELITE", "News", "Odd", None]) == [False, True, False, True, True, False, False, False]
    assert values(spark, names.is_team_header, ["8U Red", "8U head coaches", "x", None]) == [True, False, False, False]
    assert values(spark, names.program_name, [" House League ", " Travel ", None]) == [None, "Travel", None]
    assert values(spark, names.initials, ["north bay  old team", "", None]) == ["NBO", "?", "?"]


def test_name_patterns(spark):
    rows = [("NBE", "North Bay Eagles Hockey League", "North Bay"), ("WHK", "WHK Hawks", "Whitman-Hanson-Kingston"), (None, None, "Marshfield"), (None, None, None), ("CYH", "Canton Youth Hockey", "Canton")]
    got = values(spark, names.name_patterns, rows, ("a", "c", "t"))
    assert got == [["north bay eagles", "north bay eagle", "eagles", "eagle", "nbe"], ["whk hawks", "whk hawk", "whk"], ["marshfield"], [], ["canton", "cyh"]]


def test_page_kind(spark):
    assert values(spark, names.page_kind, ["http://a.org/Board", "http://a.org/?contact", "http://a.org", "http://a.org/x", "/coach", None]) == ["board page", "homepage", "homepage", "page", "coaches page", "page"]


def test_board_ranks_the_vice_president_after_the_president(spark):
    members = spark.createDataFrame([(1, "Vice President", "A", True), (1, "President", "B", True), (1, None, "C", True), (1, "Secretary", "D", False)], "club_id long, title string, name string, is_active boolean")
    assert [r.name for r in directory.board(members).orderBy("place").collect()] == ["B", "A", "C"]


def test_players_by_id_or_number(spark):
    roster = spark.createDataFrame([("t", "p1", 7), ("t", "p2", 8)], "team string, player_id string, number int")
    events = spark.createDataFrame([("t", 1, "p1", 7), ("t", 2, "p1", 8), ("t", 3, None, 7), ("u", 4, "p1", 7)], "team string, event_id long, scorer_id string, scorer_number int")
    out = directory.scored_by(roster, events)
    assert {r.player_id: r.goals for r in out.collect()} == {"p1": 3, "p2": 1}
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()


def test_numbers_that_many_wear_join_no_events(spark):
    roster = spark.createDataFrame([("t", "p1", 7), ("t", "p2", 7), ("t", "p3", None), ("t", None, 7), ("t", "p2", 7), ("t", "p4", 9)], "team string, player_id string, number int")
    events = spark.createDataFrame([("t", 1, "p1", 7), ("t", 1, "p1", 7), ("t", 2, "p1", 8), ("t", 3, "p3", 7), ("t", None, "p2", 7), ("t", None, "p2", None), ("t", 1, "p3", 5)], "team string, event_id long, scorer_id string, scorer_number int")
    out = directory.scored_by(roster, events)
    assert {r.player_id: r.goals for r in out.collect()} == {"p1": 4, "p2": 3, "p3": 2, None: 3}
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert joins and not [x for x in joins if "number#" in x]


def test_upserts_with_null_keys(spark):
    old = spark.createDataFrame([("a", None, "old"), ("b", 1, "old")], "name string, team_id int, role string")
    new = spark.createDataFrame([("a", None, "new"), ("c", None, None)], "name string, team_id int, role string")
    got = changes.upsert(old, new, ["name", "team_id"], null_safe=True)
    assert sorted((r.name, r.team_id, r.role) for r in got.collect()) == [("a", None, "new"), ("b", 1, "old"), ("c", None, None)]
    schema = "game_id string, team string, date string, opponent string, state string"
    old = spark.createDataFrame([("1", "t", "d", "o", "a"), ("", "t", "e", None, "a")], schema)
    new = spark.createDataFrame([(" 1", "t", "x", "o", "b"), (None, "t", "e", None, "b"), ("", "t", "f", "o", "b")], schema)
    assert sorted(r.state + r.date for r in changes.upsert_games(old, new).collect()) == ["be", "bf", "bx"]


def test_keep_first_keeps_blank_ids(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, None), (5, " ")], "n int, id string")
    assert sorted(r.n for r in changes.keep_first(rows, "id", ["n"]).collect()) == [1, 3, 4, 5]


def test_documents_that_hold_nothing(spark):
    pages = spark.createDataFrame([(1, None), (2, "{}"), (3, "broken"), (4, '{"playerData": {"names": []}, "coachData": {"names": [{"firstName": "C"}]}}')], "team_id long, json string")
    assert documents.roster_people(pages).count() == 0 and documents.roster_coaches(pages).count() == 0
    assert documents.divisions(pages).count() == 0 and documents.standings_dump(pages, "json").count() == 0
