import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rinkframe.operators import changes
from rinkframe.sinks import reports, tables
from rinkframe.streaming import events


def goals(spark, rows):
    return spark.createDataFrame(rows, "game_id long, seq int, scorer string")


def state(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def test_append_by_key_is_idempotent(spark, tmp_path):
    t = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["game_id", "seq"], buckets=4)
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.append(goals(spark, [(1, 0, "a"), (1, 1, "b"), (2, 0, None), (2, 0, "c")]), "one") == 0
    first = state(t)
    assert first == [(1, 0, "a"), (1, 1, "b"), (2, 0, None)]
    assert t.append(goals(spark, [(9, 9, "z")]), "one") == 0 and state(t) == first
    assert t.append(goals(spark, [(1, 1, "changed"), (3, 0, "d"), (None, None, "n")]), "two") == 1
    # The same rows in another run change nothing; null keys are one key.
    t.append(goals(spark, [(1, 1, "again"), (3, 0, "e"), (None, None, "m")]), "three")
    assert state(t) == [*first, (3, 0, "d"), (None, None, "n")]
    assert t.runs() == ["one", "two", "three"] and len(t.read(0).collect()) == 3


def test_killed_between_write_and_commit(spark, tmp_path, monkeypatch):
    t = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["game_id", "seq"], buckets=4)
    t.append(goals(spark, [(k, 0, "a") for k in range(10)]), "one")
    before = state(t)
    commit = tables.KeyedTable._commit
    monkeypatch.setattr(tables.KeyedTable, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        t.append(goals(spark, [(k, 1, "b") for k in range(10)]), "two")
    monkeypatch.setattr(tables.KeyedTable, "_commit", commit)
    assert state(t) == before and t.versions() == [0]
    left = len(list(Path(tmp_path, "t/data").iterdir()))
    t.append(goals(spark, [(k, 1, "b") for k in range(10)]), "two")
    assert state(t) == sorted([*before, *[(k, 1, "b") for k in range(10)]], key=str)
    t.rotate(1)
    assert t.versions() == [1] and len(list(Path(tmp_path, "t/data").iterdir())) < left + 1 and len(t.read().collect()) == 20


def test_two_writers(spark, tmp_path):
    t = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["game_id", "seq"])
    t.append(goals(spark, [(1, 0, "a")]))
    with pytest.raises(FileExistsError):
        t._commit({"version": 0, "schema": None, "folders": {}, "run": None, "buckets": 16})


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["id"], buckets=32)
    rows = lambda ids, s: spark.createDataFrame([(i, s, i % 3) for i in ids], "id long, status string, other int")
    t.merge(rows(range(5000), "scheduled"), ["status"])
    whole = t.manifest()["folders"]
    t.merge(rows([7, 8], "final"), ["status"])
    one = t.manifest()["folders"]
    assert len(whole) == 32 and sum(whole[k] != one[k] for k in whole) in (1, 2)
    size = lambda v: sum(p.stat().st_size for f in set(t.manifest(v)["folders"].values()) - set(t.manifest(v - 1)["folders"].values() if v else []) for p in Path(tmp_path, "t", f).glob("*.parquet"))
    assert size(1) < size(0) / 8
    t.merge(spark.createDataFrame([(9, None, 5), (10, "scheduled", 9), (6000, "new", 1)], "id long, status string, other int"), ["status"])
    got = {r.id: (r.status, r.other) for r in t.read().collect()}
    assert len(got) == 5001 and got[7] == ("final", 1) and got[9] == ("scheduled", 0) and got[10] == ("scheduled", 1) and got[6000] == ("new", 1)
    # The same as merging whole snapshots.
    old = rows(range(5000), "scheduled")
    assert sorted(map(tuple, t.read(1).collect())) == sorted(map(tuple, changes.merge_snapshots(old, rows([7, 8], "final"), "id", ["status"]).drop("change_type").collect()))
    for k in range(5):
        t.merge(rows([k], f"s{k}"), ["status"])
    assert t.rotate(3) == 5 and t.versions() == [5, 6, 7] and len(t.read().collect()) == 5001 and t.rotate(3) == 0


def test_streams_of_snapshots_and_events(spark, tmp_path):
    schema = "id long, status string"
    feed = lambda k, rows: spark.createDataFrame(rows, schema).write.mode("append").json(f"{tmp_path}/in/{k}")
    t, log = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["id"], 4), tables.KeyedTable(spark, f"file://{tmp_path}/e", ["id"], 4)
    for k, rows in enumerate([[(1, "a"), (2, "a"), (2, "b")], [(2, None), (3, "c")], [(1, "z")]]):
        feed(k, rows)
        read = lambda: spark.readStream.schema(schema).json(f"{tmp_path}/in/*")
        events.merge_stream(read(), t, f"{tmp_path}/c1", ["status"], keep=2).awaitTermination()
        events.append_stream(read(), log, f"{tmp_path}/c2").awaitTermination()
    assert state(t) == [(1, "z"), (2, "b"), (3, "c")] and t.versions() == [1, 2]
    assert state(log) == [(1, "a"), (2, "a"), (3, "c")]


def test_issues_and_log(spark, tmp_path):
    numbers = spark.createDataFrame([("p1", "numbers", "two", 0.25)], "player_id string, issue_type string, details string, consistency double")
    games = spark.createDataFrame([(5, "no goals", "x", "critical"), (6, "odd", "y", "warning")], "game_id long, issue_type string, description string, severity string")
    twice = spark.createDataFrame([(None, "same", "z")], "players string, issue_type string, description string")
    issues = reports.issue_rows(numbers, games, twice)
    t = tables.KeyedTable(spark, f"file://{tmp_path}/i", ["issue_id"], 4)
    at = F.lit("2024-01-01 00:00:00")
    for run in ("r1", "r1", "r2"):
        reports.save_issues(t, issues, run, at)
    rows = t.read()
    assert rows.count() == 8 and rows.where("run_id = 'r1'").count() == 4
    got = sorted((r.entity_type, r.entity_id, r.game_id, r.confidence_impact) for r in rows.where("run_id = 'r2'").collect())
    assert [g[:2] for g in got] == [("game", "5"), ("game", "6"), ("player", ""), ("player", "p1")] and [g[3] for g in got] == [0.5, 0.2, 0.3, 0.75]
    summary = reports.issue_summary(rows.withColumn("resolved_at", F.when(F.col("run_id") == "r1", F.current_timestamp())))
    assert tuple(summary.first()) == (4, 1, 3, 0, 4)
    scores = spark.createDataFrame([(0.5, 0.25)], "overall double, player_average double")
    log = tables.KeyedTable(spark, f"file://{tmp_path}/l", ["run_id"], 1)
    for run in ("r1", "r2", "r2"):
        log.append(reports.monitoring_row(run, scores, reports.issue_summary(rows), at), run)
    last = log.read().where("run_id = 'r2'").first()
    assert log.read().count() == 2 and (last.overall_score, last.total_issues, last.critical_issues) == (0.5, 8, 2)
    assert json.loads(last.report_data)["issue_summary"]["warning"] == 6


def test_reports(spark, tmp_path):
    players = spark.createDataFrame([(f"n{k}", k, k % 4, k % 3, k % 4 + k % 3, 5) for k in range(15)] + [(None, None, 9, 9, 18, 1)], "name string, number int, g int, a int, pts int, gp int")
    teams = spark.createDataFrame([("A", 3, 2, 1, 0, 4, 9, 5), ("B", 3, 1, 2, 0, 2, 5, 9)], "team_name string, gp int, w int, l int, t int, pts int, gf int, ga int")
    out = reports.season_summary({"teams": teams, "players": players}, players, teams).collect()
    line = {(r.section, r.place): r.line for r in out}
    assert len(out) == 14 and line["records", 1] == "players                  16" and line["scorers", 1] == " 1. #  - -                         -  18 pts (9G, 9A) in 1 GP"
    assert line["standings", 2] == f"{'B':25}   3   1   2   0    2   5   9"
    teams = spark.createDataFrame([(1, False), (None, False), (None, True), (3, False)], "matched_id int, skipped boolean")
    players = spark.createDataFrame([(1, "x"), (2, None), (None, None)], "matched_id int, name string")
    got = {r.counter: r.n for r in reports.match_report(teams, players, {"goals": F.col("name").isNotNull()}).collect()}
    assert got == {"teams_matched": 2, "teams_unmatched": 1, "teams_skipped": 1, "players_matched": 2, "players_unmatched": 1, "names_backfilled.goals": 1}
    reports.write_json(players, f"{tmp_path}/r")
    assert sorted(json.loads(r.value)["matched_id"] or 0 for r in spark.read.text(f"{tmp_path}/r").collect()) == [0, 1, 2]


def season(spark, tmp_path):
    rows = {
        "games": (spark.createDataFrame([(1, 10, 11), (2, 10, 99), (3, 98, 97), (4, None, 12), (4, 12, 12), (None, 10, 11)], "game_id long, home_id long, visitor_id long")),
        "goals": spark.createDataFrame([(1,), (1,), (7,), (7,), (8,), (None,)], "game_id long"),
        "teams": spark.createDataFrame([(10,), (11,), (12,), (13,)], "team_id long"),
        "team_stats": spark.createDataFrame([(10,), (50,)], "team_id long"),
        "divisions": spark.createDataFrame([], "division_id long"),
        "penalties": spark.createDataFrame([(1,)], "game_id long"),
    }
    for name, df in rows.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
    return {name: spark.read.parquet(f"{tmp_path}/{name}") for name in rows}


def test_integrity(spark, tmp_path):
    t = season(spark, tmp_path)
    got = {r.check: (r.n, r.level) for r in reports.integrity(t, ["games", "goals", "teams", "divisions", "penalties", "absent"]).collect()}
    assert got == {
        "table games": (6, "ok"), "table goals": (6, "ok"), "table teams": (4, "ok"), "table team_stats": (2, "ok"), "table divisions": (0, "warning"), "table penalties": (1, "ok"), "table absent": (None, "error"),
        "orphan_games": (2, "warning"), "orphan_goals": (3, "warning"), "teams_without_stats": (2, "warning"),
    }


def test_integrity_reads_each_table_once(spark, tmp_path):
    t = season(spark, tmp_path)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = reports.references(t["games"], t["goals"], t["teams"], t["team_stats"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") == 1
    assert plan.count("FileScan parquet") == 4


def test_appends_leave_rows_in_their_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FOLDERS", 4)
    t = tables.KeyedTable(spark, f"file://{tmp_path}/t", ["id"], buckets=2)
    rows = lambda low, high: spark.range(low, high).selectExpr("nullif(id, 0) AS id", f"{high} AS made")
    t.append(rows(0, 100), "a")
    first = set(t.manifest()["folders"].values())
    t.append(rows(0, 103), "b")
    read = lambda: sorted(((r.id, r.made) for r in t.read().collect()), key=str)
    want = [(k or None, 100 if k < 100 else 103) for k in range(103)]
    assert read() == sorted(want, key=str) and first <= set(t._named(t.manifest()))
    assert sum(t.spark.read.parquet(f"{t.path}/{f}").count() for f in set(t.manifest()["folders"].values()) - first) == 3
    t.append(rows(5, 50), "c")
    assert read() == sorted(want, key=str) and first <= set(t._named(t.manifest()))
    for k in range(6):
        t.append(rows(0, 110 + 10 * k), f"d{k}")
        t.rotate(1)
    assert len(read()) == 160 and len(t._named(t.manifest())) <= 8
    # Other types of columns: written anew.
    t.append(spark.createDataFrame([(500, 7)], "id long, made long"), "e")
    assert len(read()) == 161 and dict(t.read().dtypes)["made"] == "bigint"
