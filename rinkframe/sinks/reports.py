"""Issues, logs and reports: rows that are appended once a run, and summaries as JSON or text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import monitor
from .tables import KeyedTable

ISSUE = "entity_type string, entity_id string, game_id string, issue_type string, issue_description string, confidence_impact double"
#: Impact of a game's issue by severity, and of a duplicate.
CRITICAL, MINOR, DUPLICATE = 0.5, 0.2, 0.3


def issue_rows(numbers: DataFrame, games: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Issues of three kinds in one form.

    numbers: player_id, issue_type, details, consistency. games: game_id, issue_type, description, severity.
    duplicates: players, issue_type, description.
    """
    none = F.lit(None).cast("string")
    one = lambda kind, who, game, what, text, impact: [F.lit(kind).alias("entity_type"), who.cast("string").alias("entity_id"), game.cast("string").alias("game_id"), what.alias("issue_type"), text.alias("issue_description"), impact.cast("double").alias("confidence_impact")]
    c = F.col
    out = numbers.select(*one("player", c("player_id"), none, c("issue_type"), c("details"), 1.0 - c("consistency")))
    out = out.unionByName(games.select(*one("game", c("game_id"), c("game_id"), c("issue_type"), c("description"), F.when(c("severity") == "critical", CRITICAL).otherwise(MINOR))))
    return out.unionByName(duplicates.select(*one("player", F.coalesce("players", F.lit("")), none, c("issue_type"), c("description"), F.lit(DUPLICATE))))


def save_issues(table: KeyedTable, issues: DataFrame, run: str, as_of: Column) -> int:
    """Append a run's issues. The id is a hash of run and issue, so that a run that is done again adds nothing; table: key issue_id."""
    id_ = F.sha2(F.to_json(F.struct(F.lit(run).alias("run"), *issues.columns), {"ignoreNullFields": "false"}), 256)
    rows = issues.select(id_.alias("issue_id"), *issues.columns, F.lit(run).alias("run_id"), as_of.cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(None).cast("string").alias("resolved_by"), F.lit(None).cast("string").alias("notes"))
    return table.append(rows, run)


def issue_summary(issues: DataFrame) -> DataFrame:
    """Open issues by severity and in all, and resolved ones: one row. issues: confidence_impact, resolved_at."""
    open_, level = F.col("resolved_at").isNull(), monitor.severity(F.col("confidence_impact"))
    return issues.agg(F.count_if(open_).alias("total_unresolved"), *[F.count_if(open_ & (level == s)).alias(s) for s in ("critical", "warning", "info")], F.count_if(~open_).alias("resolved"))


def monitoring_row(run: str, scores: DataFrame, issues: DataFrame, as_of: Column) -> DataFrame:
    """The row of a run for the monitoring log, with its whole report as JSON. scores: one row with overall; issues: one of issue_summary."""
    # One row each.
    both = scores.crossJoin(issues)
    report = F.to_json(F.struct(F.struct(*scores.columns).alias("overall_statistics"), F.struct(*issues.columns).alias("issue_summary")))
    return both.select(F.lit(run).alias("run_id"), as_of.cast("timestamp").alias("run_at"), F.col("overall").alias("overall_score"), F.col("total_unresolved").alias("total_issues"), F.col("critical").alias("critical_issues"), F.col("resolved").alias("resolved_issues"), report.alias("report_data"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table: name, n."""
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


def season_summary(tables: dict[str, DataFrame], players: DataFrame, standings: DataFrame, limit: int = 10) -> DataFrame:
    """Sections of a season's report as rows: section, place, line.

    players: name, number, g, a, pts, gp of one season; standings: team_name, gp, w, l, t, pts, gf, ga. Lines are formatted here;
    the top rows come from a limit, so no window sees more than `limit` rows.
    """
    counts = table_counts(tables).select(F.lit("records").alias("section"), F.row_number().over(W.orderBy("name")).alias("place"), F.format_string("%-20s %6d", "name", "n").alias("line"))
    top = players.orderBy(F.desc("pts"), F.desc("g"), "name", "number").limit(limit)
    place = F.row_number().over(W.orderBy(F.desc("pts"), F.desc("g"), "name", "number"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    top = top.withColumn("place", place).select(F.lit("scorers").alias("section"), "place", F.format_string("%2d. #%3s %-25s - %3d pts (%dG, %dA) in %d GP", "place", text("number"), text("name"), F.col("pts"), F.col("g"), F.col("a"), F.col("gp")).alias("line"))
    order = [F.desc("pts"), F.desc("w"), F.desc(F.col("gf") - F.col("ga")), F.asc("team_name")]
    best = standings.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(W.orderBy(*order)))
    best = best.select(F.lit("standings").alias("section"), "place", F.format_string("%-25s %3d %3d %3d %3d %4d %3d %3d", *[F.col(c) for c in ("team_name", "gp", "w", "l", "t", "pts", "gf", "ga")]).alias("line"))
    return counts.unionByName(top).unionByName(best)


def match_report(teams: DataFrame, players: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Counters of a reconciliation in one pass over each table: counter, n.

    teams: matched_id, skipped (boolean). players: matched_id. fields: for each backfilled table a condition on players.
    """
    matched = F.col("matched_id").isNotNull()
    t = teams.agg(F.count_if(matched & ~F.col("skipped")).alias("teams_matched"), F.count_if(~matched & ~F.col("skipped")).alias("teams_unmatched"), F.count_if("skipped").alias("teams_skipped"))
    p = players.agg(F.count_if(matched).alias("players_matched"), F.count_if(~matched).alias("players_unmatched"), *[F.count_if(c).alias(f"names_backfilled.{n}") for n, c in fields.items()])
    rows = lambda d: d.select(F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(f"`{c}`").alias("n")) for c in d.columns])))
    return rows(t).unionByName(rows(p))


def report_json(report: DataFrame) -> DataFrame:
    """A report of one row or many as JSON, a line a row; nulls are kept."""
    return report.select(F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_json(report: DataFrame, path: str) -> None:
    report_json(report).write.mode("overwrite").text(path)


# Tables that a season needs, and those of them of which an empty one is a warning.
REQUIRED = ["games", "goals", "penalties", "game_rosters", "teams", "divisions", "team_stats", "player_stats", "strength_of_schedule", "head_to_head", "player_game_log", "data_quality_issues"]
NOT_EMPTY = ["games", "teams", "divisions"]


def references(games: DataFrame, goals: DataFrame, teams: DataFrame, stats: DataFrame) -> DataFrame:
    """Broken references between tables, in one row: orphan_games, orphan_goals, teams_without_stats.

    games: game_id, home_id, visitor_id. goals: game_id. teams, stats: team_id. Null keys refer to nothing and
    are not broken. Each table is read once: goals are counted by game and meet the games in one full join, and
    what is known of a team is one grouped table, whose shuffle both sides of a game share.
    """
    known = teams.select("team_id", F.lit(1).alias("t"), F.lit(0).alias("s")).unionByName(stats.select("team_id", F.lit(0).alias("t"), F.lit(1).alias("s")))
    known = known.groupBy("team_id").agg(F.max("t").alias("t"), F.max("s").alias("s"))
    side = lambda n: known.select(F.col("team_id").alias(f"{n}_id"), F.col("t").alias(f"{n}_t"), F.col("s").alias(f"{n}_s"))
    scored = goals.where("game_id is not null").groupBy(F.col("game_id").alias("scored_id")).agg(F.count("*").alias("n_goals"))
    rows = games.select(F.col("game_id"), "home_id", "visitor_id", F.lit(True).alias("is_game")).join(scored, F.col("game_id") == F.col("scored_id"), "full_outer")
    rows = rows.join(side("home"), "home_id", "left").join(side("visitor"), "visitor_id", "left")
    absent = lambda n: F.col(f"{n}_id").isNotNull() & (F.coalesce(f"{n}_t", F.lit(0)) == 0)
    bare = lambda n: F.when((F.col(f"{n}_t") == 1) & (F.col(f"{n}_s") == 0), F.col(f"{n}_id"))
    rows = rows.select("is_game", "n_goals", (absent("home") | absent("visitor")).alias("orphan"), F.posexplode_outer(F.array_compact(F.array(bare("home"), bare("visitor")))).alias("k", "bare"))
    once = F.coalesce("k", F.lit(0)) == 0
    zero = F.lit(0).cast("long")
    return rows.agg(
        F.count_if(once & F.col("is_game") & F.col("orphan")).alias("orphan_games"),
        F.coalesce(F.sum(F.when(once & F.col("is_game").isNull(), F.col("n_goals"))), zero).alias("orphan_goals"),
        F.countDistinct("bare").alias("teams_without_stats"),
    )


def integrity(tables: dict[str, DataFrame], required: list[str] | None = None) -> DataFrame:
    """Checks of a season's tables as rows: check, n, level (ok, warning, error).

    Rows are counted while the checks of references read them (`observe`), so the counts cost no scan of their own;
    only tables that no check reads are counted by themselves. A needed table that is missing is an error.
    """
    required = REQUIRED if required is None else required
    spark = next(iter(tables.values())).sparkSession
    checked = [n for n in ("games", "goals", "teams", "team_stats") if n in tables]
    counts: dict[str, int] = {}
    found = {}
    if len(checked) == 4:
        seen = {n: Observation(f"rows of {n}") for n in checked}
        one, two, three, four = (tables[n].observe(seen[n], F.count(F.lit(1)).alias("n")) for n in checked)
        found = references(one, two, three, four).first().asDict()
        counts = {n: o.get["n"] for n, o in seen.items()}
    rest = {n: df for n, df in tables.items() if n not in counts}
    if rest:
        counts |= {r.name: r.n for r in table_counts(rest).collect()}  # a row a table
    rows = [(f"table {n}", counts.get(n), "error" if n not in counts else "warning" if n in NOT_EMPTY and not counts[n] else "ok") for n in required]
    rows += [(f"table {n}", counts[n], "ok") for n in counts if n not in required]
    rows += [(n, k, "warning" if k else "ok") for n, k in found.items()]
    return spark.createDataFrame(rows, "check string, n long, level string")


def best_teams(teams: DataFrame, stats: DataFrame, limit: int = 5) -> DataFrame:
    """A sample of the statistics: the teams with the largest share of points. stats: team_id, pts_pct and others."""
    return stats.join(teams.select("team_id", "team_name"), "team_id").orderBy(F.desc("pts_pct"), "team_name", "team_id").limit(limit)
