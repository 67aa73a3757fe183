from datetime import datetime

from pyspark.sql import functions as F

from rinkframe.operators import logos, monitor


def test_player_scores(spark):
    rows = [("p013", "A", 1, 1, 50, 0, 0), ("p001", "B", 1, 3, 4, 2, 6), ("p004", "C", 2, 2, 2, 0, 0), ("p011", "", 1, 1, 1, 0, 0), ("none", "D", 1, 0, 0, 0, 120)]
    got = {r.player_id: (r.score, r.recommendations) for r in monitor.player_scores(spark.createDataFrame(rows, "player_id string, name string, n_numbers int, gp int, g int, a int, pim int")).collect()}
    assert {k: v[0] for k, v in got.items()} == {"p013": 0.8, "p001": 1.0, "p004": 0.85, "p011": 0.8, "none": 0.775}
    assert got["none"][1] == ["complete statistics", "review penalties"]


def test_report_and_bands(spark):
    s = lambda *v: spark.createDataFrame([(float(x), ["a", "b"] if x < 0.6 else ["a"]) for x in v], "score double, recommendations array<string>")
    r = monitor.report(s(0.8, 1.0, 1.0, 1.0, 1.0, 0.85, 0.8, 0.8), s(1.0, 0.65, 0.81, 0.79, 0.79), s(0.1).limit(0)).first()
    assert tuple(r) == (0.906, 0.808, 0.0, 0.571)
    assert {x.band: x.n for x in monitor.histogram(s(0.1, 0.5, 0.79, 0.8)).collect()} == {"poor": 1, "fair": 2, "good": 1}
    assert [tuple(x) for x in monitor.top_recommendations(s(0.1, 0.65, 0.9)).collect()] == [("a", 2), ("b", 1)]


def test_issues(spark):
    at = [datetime(2025, 1, d) for d in (1, 2, 3)]
    issues = spark.createDataFrame([(1, 0.6, at[0], None, None, None), (2, 0.2, at[2], None, None, None), (3, 0.1, at[2], at[2], "x", "y")], "issue_id int, impact double, created_at timestamp, resolved_at timestamp, resolved_by string, notes string")
    assert [(r.issue_id, r.severity) for r in monitor.unresolved(issues).orderBy("issue_id").collect()] == [(1, "critical"), (2, "warning")]
    assert monitor.unresolved(monitor.resolve_issue(issues, 1, "me", "done", "2025-01-05"), "critical").count() == 0
    log = spark.createDataFrame([(at[1],)], "run_at timestamp")
    assert {r.issue_id for r in monitor.new_issues(issues, log).collect()} == {2, 3}
    assert monitor.new_issues(issues, log.limit(0)).count() == 0


def test_basic(spark):
    p = spark.createDataFrame([(9, "A", 2, 5), (None, " ", 0, 0)], "number int, name string, gp int, pts int")
    assert [r.score for r in monitor.basic_scores(p).collect()] == [1.0, 0.0]
    assert [r.confidence for r in monitor.basic_confidence(p).collect()] == [1.0, 0.1]


def test_logo_cascade(spark):
    teams = spark.createDataFrame([("The Wolves",), ("wolves",), ("Wolves U12 Red",), ("Wolvess",), ("Nobody",)], "team_name string")
    table = spark.createDataFrame([("Wolves", "w.png"), ("Kings", "k.png")], "logo_name string, file string")
    alias = spark.createDataFrame([("the wolves", "alias.png")], "alias string, file string")
    got = logos.match(teams, table, alias)
    assert {r.team_name: (r.file, r.confidence, r.how) for r in got.collect()} == {"The Wolves": ("alias.png", 1.0, "alias"), "wolves": ("w.png", 1.0, "name"), "Wolves U12 Red": ("w.png", 0.95, "stripped"), "Wolvess": ("w.png", 0.923, "similar"), "Nobody": (None, None, "none")}
    remote = spark.createDataFrame([("wolves", "http://x"), ("Nobody", "http://y")], "team_name string, logo_url string")
    assert {r.found: r.n for r in logos.coverage(logos.manifest(got, remote)).collect()} == {"both": 1, "local": 3, "league": 1}
    assert [r.file for r in logos.search("wolf", table).select(F.col("file")).collect()] == ["w.png"]


def test_logo_cascade_tries_the_stripped_name(spark):
    teams = spark.createDataFrame([("Bruinz U12 Blue",), ("The Bruins",), ("Pack U10 Red",), ("U12",)], "team_name string")
    table = spark.createDataFrame([("Bruins", "b.png"), ("Kings", "k.png")], "logo_name string, file string")
    alias = spark.createDataFrame([("pack", "p.png")], "alias string, file string")
    got = logos.match(teams, table, alias)
    assert {r.team_name: (r.file, r.confidence, r.how) for r in got.collect()} == {"Bruinz U12 Blue": ("b.png", 0.833, "similar"), "The Bruins": ("b.png", 0.8, "similar"), "Pack U10 Red": ("p.png", 0.95, "stripped"), "U12": (None, None, "none")}
