"""Rows of league and club pages: games, periods, shots, statistics, standings, rosters, schedules.

Each function takes pages with a column of HTML and keeps their other columns; the pages
are parsed once (`markup.tables_of`), all else is native expressions inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import changes, resolve
from . import markup

# Classes of tables, periods in headers and their names, positions, words of venues.
SCORE_TABLES = ["scoreTable", "statTable", "boxscore"]
PERIODS = {"1": "1st", "2": "2nd", "3": "3rd", "OT": "OT", "SO": "SO"}
TOTALS = ["F", "T", "Total"]
SHOT_COLUMNS = {"1": "1st", "2": "2nd", "3": "3rd", "OT": "OT", "Total": "total"}
POSITIONS = ["F", "D", "G", "C", "LW", "RW", "LD", "RD"]
VENUES = ["rink", "arena", "ice"]

# Headers of each statistic, in order of trial.
PLAYER_COLUMNS = {
    "games_played": ["gp", "games played", "games"], "goals": ["g", "goals"], "assists": ["a", "assists"], "points": ["pts", "points", "p"], "penalty_minutes": ["pim", "penalty minutes", "pen"],
    "plus_minus": ["+/-", "plus/minus"], "power_play_goals": ["ppg", "pp goals"], "short_handed_goals": ["shg", "sh goals"], "game_winning_goals": ["gwg", "game winning goals"],
}
TEAM_COLUMNS = {"points": ["pts", "points"], "games_played": ["gp", "games played"], "wins": ["w", "wins"], "losses": ["l", "losses"], "ties": ["t", "ties", "otl"], "goals_for": ["gf", "goals for"], "goals_against": ["ga", "goals against"]}


def _digits(x: Column) -> Column:
    return F.rlike(x, F.lit(r"^\d+$"))


def _whole(x: Column) -> Column:
    """A whole number in a text, else null."""
    return F.when(F.rlike(x, F.lit(r"^\s*[+-]?\d+\s*$")), F.trim(x).try_cast("int"))


def _first(x: Column) -> Column:
    return F.get(x, F.lit(0))


def _before_dash(name: Column) -> Column:
    return F.when(F.contains(name, F.lit(" - ")), F.substring_index(name, " - ", 1))


def calendar_dates(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """Days of a calendar slider with their links: day, url."""
    slider = F.regexp_extract(html, r"""(?is)<ul[^>]*\bclass\s*=\s*["'][^"']*\bgames-slider-inner\b[^"']*["'][^>]*>(.*?)</ul>""", 1)
    items = F.slice(F.split(slider, r"(?i)<li\b"), 2, 1 << 30)
    day = lambda x: F.array_join(F.array(*[F.regexp_extract(x, r"""(?is)^[^>]*\bid\s*=\s*["']slider_day_(\d{4})_(\d{2})_(\d{2})""", k) for k in (1, 2, 3)]), "_")
    href = lambda x: F.regexp_extract(x, r"""(?is)<a\b[^>]*\bhref\s*=\s*["']([^"']+)["']""", 1)
    rows = pages.select(*[c for c in pages.columns if c != html], F.posexplode(items).alias("place", "x_")).withColumns({"day": day(F.col("x_")), "href_": href(F.col("x_"))})
    return rows.where("length(day) = 10 and href_ <> ''").withColumn("url", markup.join_url(F.lit(base), F.col("href_"))).drop("x_", "href_")


def game_rows(pages: DataFrame, base: str, html: str = "html") -> DataFrame:
    """Games of schedule pages, from the first table of statistics; rows of fewer than six cells are no games."""
    title = F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)
    rows = pages.select(*pages.columns, F.regexp_extract(title, r"(\d{1,2}/\d{1,2}/\d{4})", 1).alias("date"), _first(markup.with_class(markup.tables_of(F.col(html)), "statTable")).alias("t_")).drop(html)
    # Without a body, the first row is the header.
    found = F.when(F.col("t_.has_body"), markup.body_rows(F.col("t_"))).otherwise(F.slice("t_.rows", 2, 1 << 30))
    rows = rows.select("*", F.posexplode(found).alias("place", "r_")).withColumn("c_", markup.cells(F.col("r_"), "td")).where(F.size("c_") >= 6)
    cell = lambda k: F.get("c_", F.lit(k))
    team = lambda k: F.trim(F.coalesce(markup.link_with_class(cell(k), "teamName"), cell(k)["text"]))
    status, links = cell(5)["text"], F.flatten(F.transform(F.col("r_.cells"), lambda c: c["links"]))
    link = _first(F.filter(links, lambda x: F.contains(x["href"], F.lit("game/show"))))["href"]
    score = lambda k: F.nullif(cell(k)["text"], F.lit("-"))
    out = rows.select("*", F.regexp_extract(F.coalesce("r_.id", F.lit("")), r"game_list_row_(\d+)", 1).alias("game_id"), F.when(F.contains(status, F.lit("AM")) | F.contains(status, F.lit("PM")), status).otherwise("").alias("time"), team(0).alias("visitor_team"), team(2).alias("home_team"), score(1).alias("visitor_score"), score(3).alias("home_score"), cell(4)["text"].alias("location"), status.alias("status"), F.coalesce(markup.join_url(F.lit(base), link), F.lit("")).alias("game_url"))
    return out.withColumn("division", _before_dash(F.col("visitor_team"))).drop("t_", "r_", "c_")


def first_seen(games: DataFrame, order: list[str]) -> DataFrame:
    """Games of several pages, each id once, where it comes first; games without an id all stay."""
    return changes.keep_first(games, "game_id", order)


def _places(headers: Column, header: str) -> Column:
    """Columns that have a header, in order."""
    return F.filter(F.sequence(F.lit(0), F.size(headers) - 1), lambda i: F.get(headers, i)["text"] == F.lit(header))


def _by_period(columns: dict[str, str], headers: Column, value) -> list[Column]:
    """For each period its last column with a value, as an array of one entry or none."""
    out = []
    for header, name in columns.items():
        found = F.filter(F.transform(_places(headers, header), value), lambda v: v.isNotNull())
        out.append(F.when(F.size(found) > 0, F.array(F.struct(F.lit(name).alias("k"), F.element_at(found, -1).alias("v")))).otherwise(F.array().cast(_entry(value))))
    return out


def _entry(value) -> str:
    return f"array<struct<k: string, v: {value.kind}>>"


def _count_headers(headers: Column, names: list[str]) -> Column:
    return F.size(F.filter(headers, lambda h: h["text"].isin(names)))


def _filled(entries: list[Column]) -> Column:
    """A map of the entries; null where there is none."""
    all_ = F.concat(*entries)
    return F.when(F.size(all_) > 0, F.map_from_entries(all_))


def period_scores(tables: Column) -> Column:
    """Scores by period of the first table that has some: a map of period to visitor and home; null without any."""

    def of(table: Column) -> Column:
        rows, headers = markup.body_rows(table), table["headers"]
        one, two = (markup.cells(F.get(rows, F.lit(k)), "td", "th") for k in (0, 1))

        def value(i: Column) -> Column:
            visitor, home = (_whole(F.get(side, i)["text"]) for side in (one, two))
            return F.when(visitor.isNotNull() & home.isNotNull(), F.struct(visitor.alias("visitor"), home.alias("home")))

        value.kind = "struct<visitor: int, home: int>"
        fits = table["has_head"] & (_count_headers(headers, [*PERIODS, *TOTALS]) >= 2) & (F.size(rows) >= 2)
        return F.when(fits, _filled(_by_period(PERIODS, headers, value)))

    return _first(F.filter(F.transform(markup.with_class(tables, *SCORE_TABLES), of), lambda m: m.isNotNull()))


def shots_on_goal(tables: Column) -> Column:
    """Shots by period of the first row of shots that has some: a map of period, or total, to shots; null without any."""

    def of(table: Column) -> Column:
        headers = table["headers"]

        def row_map(row: Column) -> Column:
            cells = markup.cells(row, "td", "th")

            def value(i: Column) -> Column:
                return _whole(F.get(cells, i)["text"])

            value.kind = "int"
            named = F.contains(F.lower(F.array_join(F.transform(row["cells"], lambda c: c["text"]), " ")), F.lit("shot"))
            return F.when(named, _filled(_by_period(SHOT_COLUMNS, headers, value)))

        fits = table["has_head"] & F.contains(F.lower(table["text"]), F.lit("shot")) & (_count_headers(headers, list(SHOT_COLUMNS)) >= 2)
        return F.when(fits, _first(F.filter(F.transform(table["rows"], row_map), lambda m: m.isNotNull())))

    return _first(F.filter(F.transform(markup.with_class(tables, *SCORE_TABLES), of), lambda m: m.isNotNull()))


def game_details(pages: DataFrame, html: str = "html") -> DataFrame:
    """Period scores and shots of game pages."""
    parsed = pages.withColumn("tables_", markup.tables_of(F.col(html))).drop(html)
    return parsed.withColumns({"period_scores": period_scores(F.col("tables_")), "shots_on_goal": shots_on_goal(F.col("tables_"))}).drop("tables_")


def _stat_rows(pages: DataFrame, html: str) -> DataFrame:
    """Rows of all tables of statistics that have a head and a body: table, place, cells c_, map of columns m_, heading."""
    tables = pages.select(*pages.columns, F.posexplode(markup.with_class(markup.tables_of(F.col(html)), "statTable")).alias("table", "t_")).drop(html).where("t_.has_head and t_.has_body")
    tables = tables.withColumn("m_", markup.columns_of(F.transform("t_.headers", lambda h: F.lower(h["tight"]))))
    rows = tables.select("*", F.posexplode(markup.body_rows(F.col("t_"))).alias("place", "r_"))
    return rows.withColumn("c_", markup.cells(F.col("r_"), "td")).where(F.size("c_") >= 3)


def _value(name: str) -> Column:
    return F.nullif(F.get("c_", F.element_at("m_", name))["tight"], F.lit(""))


def _counts(columns: dict[str, list[str]]) -> list[Column]:
    """Each count from the first of its columns that is a number other than zero."""
    return [F.coalesce(*[F.nullif(_whole(_value(h)), F.lit(0)) for h in headers], F.lit(0)).alias(name) for name, headers in columns.items()]


def player_stat_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Players of tables of statistics, whatever the order of the columns; a row without a name is left out."""
    rows = _stat_rows(pages, html)
    named = F.transform(F.slice("c_", 1, 3), lambda c: F.coalesce(markup.link_with_class(c, "playerName"), F.when((F.char_length(c["tight"]) > 2) & ~_digits(c["tight"]), c["tight"])))
    team = _first(F.filter(F.transform("c_", lambda c: markup.link_with_class(c, "teamName")), lambda x: x.isNotNull()))
    out = rows.select("*", F.nullif(_first(F.filter(named, lambda x: x.isNotNull())), F.lit("")).alias("name"), F.coalesce(F.nullif(team, F.lit("")), F.lit("Unknown")).alias("team"), *_counts(PLAYER_COLUMNS), _before_dash(team).alias("division"))
    return out.where("name is not null").drop("t_", "m_", "r_", "c_")


def standing_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Teams of standings, whatever the order of the columns; the division is the heading before the table, else a prefix of the name."""
    rows = _stat_rows(pages, html)
    linked = _first(F.filter(F.transform(F.slice("c_", 1, 3), lambda c: markup.link_with_class(c, "teamName")), lambda x: x.isNotNull()))
    rows = rows.withColumn("team_name", F.nullif(F.coalesce(F.nullif(linked, F.lit("")), F.get("c_", F.lit(0))["tight"]), F.lit(""))).where("team_name is not null")
    short = _first(F.filter(F.transform(F.slice("c_", 2, 1 << 30), lambda c: c["tight"]), lambda x: (F.char_length(x) <= 10) & (x != "") & (x != F.col("team_name"))))
    out = rows.select("*", F.coalesce(_value("team"), _value("abbrev"), short, F.substring("team_name", 1, 10)).alias("team_abbrev"), F.coalesce(F.nullif(F.col("t_.heading"), F.lit("")), _before_dash(F.col("team_name"))).alias("division"), *_counts(TEAM_COLUMNS))
    return out.withColumn("record", F.coalesce(_value("division"), _value("record"), F.concat_ws("-", "wins", "losses", "ties"))).drop("t_", "m_", "r_", "c_")


def _header_kind(h: Column) -> Column:
    has = lambda *words: F.greatest(*[F.contains(h, F.lit(w)) for w in words], F.lit(False))
    return F.when(has("number") | h.isin("#", "no"), "number").when(has("name"), "name").when(has("pos"), "position").when(has("usah", "registration"), "usah").otherwise("")


def roster_rows(pages: DataFrame, base: Column, html: str = "html") -> DataFrame:
    """Players of the first table of roster pages. base: the club's address.

    Columns go by their headers, without any by place. A number must be digits, a position one of a
    list, else they are null; without a column of names, the first link that looks like one counts.
    """
    rows = pages.select(*pages.columns, base.alias("base_"), _first(markup.tables_of(F.col(html))).alias("t_")).drop(html)
    rows = rows.withColumn("h_", F.transform("t_.headers", lambda h: _header_kind(F.lower(h["tight"]))))
    rows = rows.select("*", F.posexplode(markup.body_rows(F.col("t_"))).alias("place", "r_")).withColumn("c_", markup.cells(F.col("r_"), "td")).where(F.size("c_") > 0)
    bare, three = F.size("h_") == 0, F.size("c_") == 3
    by_place = {"number": F.lit(0), "name": F.when(three, 1).otherwise(2), "position": F.when(three, 2).otherwise(3), "usah": F.lit(None).cast("int")}
    at = {k: F.when(bare, p).otherwise(F.element_at(markup.columns_of(F.col("h_")), k)) for k, p in by_place.items()}
    cell = {k: F.get("c_", i) for k, i in at.items()}
    own = cell["name"]
    like_name = _first(F.filter(F.transform("c_", lambda c: _first(c["links"])), lambda x: (F.char_length(x["text"]) > 2) & ~_digits(x["text"])))
    link = F.when(own.isNotNull(), _first(own["links"])).otherwise(like_name)
    name = F.when(own.isNotNull(), F.coalesce(_first(own["links"])["text"], own["tight"])).otherwise(like_name["text"])
    kept = lambda k, good: F.when((cell[k]["tight"] == "") | good(cell[k]["tight"]), cell[k]["tight"])
    out = rows.select("*", name.alias("name"), kept("number", _digits).alias("jersey_number"), kept("position", lambda x: x.isin(POSITIONS)).alias("position"), cell["usah"]["tight"].alias("usah_number"), markup.join_url(F.col("base_"), F.nullif(link["href"], F.lit(""))).alias("player_profile_url"))
    parts = resolve.split_name(F.col("name"))
    return out.where("coalesce(name, '') <> ''").withColumns({"first_name": parts["first"], "last_name": F.regexp_replace(parts["last"], r"\s+", " ")}).drop("base_", "t_", "h_", "r_", "c_")


def _day(x: Column) -> Column:
    short = F.regexp_extract(x, r"(\d{1,2}/\d{1,2}/\d{2,4})", 1)
    return F.coalesce(resolve.date_of(x), F.try_to_date(short, "M/d/yy")).cast("string")


def club_schedule_rows(pages: DataFrame, base: Column, team: Column, club: Column, html: str = "html") -> DataFrame:
    """Games of a team's schedule page. A row that spans columns holds the day of those below it.

    A score 'a - b' is the visitor's first. Of two links the first is the visitor; of one, which is the
    opponent, an '@' in the first cell says that the game is away. The side is the one whose name
    holds the team's or the club's. The last text with a word for a venue is the place, else the first that is left.
    """
    tables = markup.tables_of(F.col(html))
    table = F.coalesce(_first(markup.with_class(tables, "statTable")), _first(tables))
    rows = pages.select(*pages.columns, base.alias("base_"), team.alias("team_"), club.alias("club_"), table["rows"].alias("t_")).drop(html)
    spans = lambda r: F.coalesce(_first(F.filter(r["cells"], lambda c: c["spans"] & (c["tag"] == "th"))), _first(F.filter(r["cells"], lambda c: c["spans"])))
    rows = rows.withColumn("days_", F.filter(F.transform("t_", lambda r, i: F.struct(i.alias("i"), _day(spans(r)["tight"]).alias("d"))), lambda x: x["d"].isNotNull()))
    rows = rows.select("*", F.posexplode("t_").alias("place", "r_")).where(spans(F.col("r_")).isNull())
    above = F.filter("days_", lambda x: x["i"] < F.col("place"))
    rows = rows.withColumns({"c_": markup.cells(F.col("r_"), "td"), "day_": F.when(F.size(above) > 0, F.element_at(above, -1)["d"])}).where(F.size("c_") >= 3)
    rows = rows.withColumn("x_", F.transform("c_", lambda c: c["tight"]))
    score, time = r"(\d+)\s*-\s*(\d+)", r"(?i)\d{1,2}:\d{2}\s*(?:AM|PM)"
    # Where no day stands above, the first cell that holds one is it, and nothing else.
    seen = F.transform("x_", lambda x, i: F.struct(i.alias("i"), _day(x).alias("d")))
    rows = rows.withColumn("own_", F.when(F.col("day_").isNull(), _first(F.filter(seen, lambda x: x["d"].isNotNull()))))
    texts = F.filter(F.transform("x_", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda x: ~x["i"].eqNullSafe(F.col("own_.i")))
    rows = rows.withColumn("date", F.coalesce("day_", "own_.d", F.lit(""))).withColumn("s_", _first(F.filter(texts, lambda x: F.rlike(x["x"], F.lit(score)))))
    times = F.filter(texts, lambda x: ~x["i"].eqNullSafe(F.col("s_.i")) & F.rlike(x["x"], F.lit(time)))
    links = F.filter(F.transform("c_", lambda c: _first(c["links"])), lambda x: F.char_length(x["text"]) > 1)
    rows = rows.withColumns({"l_": links, "time": F.when(F.size(times) > 0, F.element_at(times, -1)["x"]).otherwise("")})
    one, two = F.get("l_", F.lit(0))["text"], F.get("l_", F.lit(1))["text"]
    away = F.contains(F.get("x_", F.lit(0)), F.lit("@"))
    visitor = F.when(two.isNotNull() | ~away, one).when(one.isNotNull(), F.col("team_"))
    home = F.when(two.isNotNull(), two).when(one.isNotNull(), F.when(away, one).otherwise(F.col("team_")))
    urls = F.filter("l_", lambda x: F.contains(x["href"], F.lit("/game/show/")))
    rows = rows.withColumns({"v_": F.coalesce(visitor, F.lit("")), "h_": F.coalesce(home, F.lit("")), "game_url": F.when(F.size(urls) > 0, markup.join_url(F.col("base_"), F.element_at(urls, -1)["href"]))})
    ours = lambda side: F.contains(F.lower(side), F.lower("team_")) | F.contains(F.lower(side), F.lower("club_"))
    rows = rows.withColumn("is_home", F.when(ours("h_"), True).when(ours("v_"), False))
    opponent = F.when(F.col("is_home"), F.col("v_")).when(~F.col("is_home"), F.col("h_")).otherwise(F.coalesce(F.nullif("v_", F.lit("")), "h_"))
    places = F.filter("x_", lambda x: (F.char_length(x) > 3) & ~F.rlike(x, F.lit(r"\d{1,2}:\d{2}")) & ~F.rlike(x, F.lit(score)) & (x != F.col("v_")) & (x != F.col("h_")) & (x != F.col("date")))
    venues = F.filter(places, lambda x: F.greatest(*[F.contains(F.lower(x), F.lit(w)) for w in VENUES]))
    goals = lambda k: F.regexp_extract("s_.x", score, k).try_cast("int")
    out = rows.select(
        "*", F.coalesce(F.nullif(opponent, F.lit("")), F.lit("TBD")).alias("opponent"), F.when(F.size(venues) > 0, F.element_at(venues, -1)).otherwise(F.coalesce(_first(places), F.lit(""))).alias("location"),
        goals(2).alias("home_score"), goals(1).alias("away_score"), F.when(F.col("s_").isNotNull(), "final").otherwise("scheduled").alias("status"), F.nullif(F.regexp_extract("game_url", r"/game/show/(\d+)", 1), F.lit("")).alias("game_id"),
    )
    return out.where("opponent <> 'TBD' or date <> ''").drop(*[c for c in out.columns if c.endswith("_") and c not in pages.columns])
