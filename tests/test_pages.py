import pytest
from pyspark.sql import functions as F

from rinkframe.sources import markup, pages


def frame(spark, *htmls):
    return spark.createDataFrame([(k, h) for k, h in enumerate(htmls)], "page int, html string")


def row(*cells, tag="td", **attrs):
    extra = "".join(f' {k}="{v}"' for k, v in attrs.items())
    return f"<tr{extra}>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


def table(headers, rows, classes="statTable", head="thead"):
    return f'<table class="x {classes}"><{head}>{row(*headers, tag="th")}</{head}><tbody>{"".join(rows)}</tbody></table>'


TEAM = '<a class="teamName" href="/t/1"> {} </a>'


def test_tables_and_broken_markup(spark):
    html = """<h2>Old</h2><p>x</p><h3>Gold <b>Division</b></h3><table class='a b'><caption>c</caption><tr id=r1><th colspan=2>H<td>1 &amp; <i> 2 </i><a href=/x class="k l">L</a>
      <tr><td>in <table class=n><tr><td>nested</table> out</td></tr><td>loose</td></table><script>var x = "<td>no</td>"</script><table><tr><td>open"""
    (p,) = frame(spark, html).select(markup.tables_of(F.col("html")).alias("t")).collect()
    outer, nested, last = p.t
    assert outer.classes == ["a", "b"] and outer.heading == "GoldDivision" and not outer.has_head and not outer.has_body
    assert [[(c.tag, c.text) for c in r.cells] for r in outer.rows] == [[("th", "H"), ("td", "1 &  2 L")], [("td", "in nested out")], [("td", "loose")]]
    first = outer.rows[0].cells
    assert outer.rows[0].id == "r1" and first[0].spans and first[1].tight == "1 &2L" and first[1].links[0].href == "/x" and first[1].links[0].classes == ["k", "l"]
    assert nested.classes == ["n"] and nested.rows[0].cells[0].text == "nested" and last.rows[0].cells[0].text == "open"
    odd = frame(spark, None, "", "<", "<table", "</td></tr></table>", "<table></tbody><a>x", "<td>x</td><h2><table><thead><th>" + "<tr>" * 2000)
    assert [len(r.t) for r in odd.select(markup.tables_of(F.col("html")).alias("t")).collect()] == [0, 0, 0, 0, 0, 1, 1]


@pytest.mark.parametrize("base,href,want", [("https://a.org", "/g/1", "https://a.org/g/1"), ("https://a.org/b/c?q=/", "d", "https://a.org/b/d"), ("https://a.org", "d", "https://a.org/d"), ("http://a.org/x", "//b.org/y", "http://b.org/y"), ("https://a.org", "http://c/d", "http://c/d"), ("https://a.org/x", "", "https://a.org/x")])
def test_join_url(spark, base, href, want):
    assert spark.range(1).select(markup.join_url(F.lit(base), F.lit(href))).first()[0] == want


def test_game_rows(spark):
    rows = [
        row(TEAM.format("8A - Bears"), " 3 ", TEAM.format("8A - Foxes"), "2", "Rink 1", "Final", '<a href="/game/show/77">x</a>', id="game_list_row_77"),
        row("Plain", "-", "Other", "-", "", "7:00 PM EST", id="odd"),
        row("too", "few"),
    ]
    page = f"<title>Games 1/9/2024 here</title><table><tr><td>first</td></tr></table>{table(['v', '', 'h', '', 'l', 's'], rows)}"
    bare = f'<table class="statTable">{row("V", "s", "H", "s", "L", "T")}{row("A", "1", "B", "0", "L", "10:00 AM", id="game_list_row_77")}</table>'
    out = pages.game_rows(frame(spark, page, bare, None, "<table class=statTable></table>"), "https://l.org")
    got = [tuple(r[c] for c in "page game_id date time visitor_team home_team visitor_score home_score location status division game_url".split()) for r in out.orderBy("page", "place").collect()]
    assert got == [
        (0, "77", "1/9/2024", "", "8A - Bears", "8A - Foxes", "3", "2", "Rink 1", "Final", "8A", "https://l.org/game/show/77"),
        (0, "", "1/9/2024", "7:00 PM EST", "Plain", "Other", None, None, "", "7:00 PM EST", None, ""),
        (1, "77", "", "10:00 AM", "A", "B", "1", "0", "L", "10:00 AM", None, ""),
    ]
    kept = pages.first_seen(out, ["page", "place"]).select("page", "game_id").collect()
    assert sorted(map(tuple, kept)) == [(0, ""), (0, "77")]


def test_periods_and_shots(spark):
    good = table(["Team", "1", "2", "OT", "T"], [row("V", "1", "0", "2", "3"), row("H", "0", "x", "1", "1")], "boxscore")
    few = table(["Team", "1"], [row("V", "9"), row("H", "9")])
    none = table(["Team", "1", "2"], [row("V", "-", ""), row("H", "1", "2")], "scoreTable")
    shots = table(["Team", "1", "2", "3", "Total"], [row("Goals", "1", "1", "1", "3"), row("<b>Shots</b> V", "5", "", "7", "12"), row("Shots H", "1", "1", "1", "3")])
    no_head = f'<table class="statTable">{row("", "1", "2", tag="th")}{row("Shots", "1", "2")}{row("x", "3", "4")}</table>'
    late = f'<table class="boxscore"><thead>{row("", "1", "2", "1", tag="th")}</thead>{row("V", "4", "5", "6")}{row("H", "7", "8", "+9")}</table>'
    out = pages.game_details(frame(spark, few + none + good + shots, no_head, None, late)).orderBy("page").collect()
    scores = lambda m: m and {k: (v.visitor, v.home) for k, v in m.items()}
    assert scores(out[0].period_scores) == {"1st": (1, 0), "OT": (2, 1)} and out[0].shots_on_goal == {"1st": 5, "3rd": 7, "total": 12}
    assert out[1].period_scores is None and out[1].shots_on_goal is None and out[2].period_scores is None
    # Without a body the header row is the first row, and of equal headers the last counts where it has a value.
    assert scores(out[3].period_scores) == {"1st": (1, 6), "2nd": (2, 5)}


def test_statistics_by_header(spark):
    rows = [row("12", "", '<a class="playerName">Al <b>B</b></a>', TEAM.format("8A - T"), "3", "0", "7", "-2"), row("1", "2", "3", "4", "x"), row("7", "Cy D", "9", "Z", "2.0", "1", "+4")]
    page = table(["#", "", "Player", "Team", "G", "Games", "PTS", "+/-"], rows) + table(["Goals", "G", "Name"], [row("5", "0", "Eve")]) + '<table class="statTable"><tbody><tr><td>a</td><td>b</td><td>cde</td></tr></tbody></table>'
    got = [(r.table, r.name, r.team, r.goals, r.games_played, r.points, r.plus_minus, r.division) for r in pages.player_stat_rows(frame(spark, page)).orderBy("table", "place").collect()]
    assert got == [(0, "AlB", "8A - T", 3, 0, 7, -2, "8A"), (0, "Cy D", "Unknown", 0, 1, 4, 0, None), (1, "Eve", "Unknown", 5, 0, 0, 0, None)]


def test_standings_by_header(spark):
    one = "<h3>U10 Gold</h3>" + table(["Team", "W", "L", "OTL", "PTS"], [row(TEAM.format("Bears of Town"), "5", "1", "2", "12"), row("", "1", "1", "1", "1")])
    two = table(["GF", "Name", "x", "Record"], [row("9", TEAM.format("8A - Foxes"), "FOX", "1-2-3"), row("17", "Owls and others", "a longer text", "")])
    got = [(r.team_name, r.team_abbrev, r.division, r.wins, r.ties, r.points, r.goals_for, r.record) for r in pages.standing_rows(frame(spark, one, two)).orderBy("page", "place").collect()]
    assert got == [("Bears of Town", "Bears of Town", "U10 Gold", 5, 2, 12, 0, "5-1-2"), ("8A - Foxes", "FOX", "8A", 0, 0, 0, 9, "1-2-3"), ("17", "17", None, 0, 0, 0, 17, "0-0-0")]


def test_roster_rows(spark):
    named = table(["Pos", "Player Name", "#", "USAH ID"], [row("F", '<a href="/p/1">Al  B C</a>', "7", "u1"), row("X", "Cy", "7a", ""), row("G", "", "1")], "any")
    bare = f"<table>{row('4', '', 'Di E', 'D')}{row('5', 'Eve', 'LW')}</table>"
    no_names = table(["#", "Pos"], [row("8", "C", '<a href="p/2">12</a>', '<a href="q/3">Fay G</a>')])
    out = pages.roster_rows(frame(spark, named, bare, no_names, "<p>none</p>"), F.lit("https://c.org/a/b"))
    got = [(r.page, r.name, r.first_name, r.last_name, r.jersey_number, r.position, r.usah_number, r.player_profile_url) for r in out.orderBy("page", "place").collect()]
    assert got == [
        (0, "Al  B C", "Al", "B C", "7", "F", "u1", "https://c.org/p/1"),
        (0, "Cy", "Cy", "", None, None, "", None),
        (1, "Di E", "Di", "E", "4", "D", None, None),
        (1, "Eve", "Eve", "", "5", "LW", None, None),
        (2, "Fay G", "Fay", "G", "8", "C", None, "https://c.org/a/q/3"),
    ]


def test_club_schedule_rows(spark):
    link = lambda t, h="": f'<a href="{h}">{t}</a>'
    rows = [
        "<tr><th colspan=4>Saturday, January 6, 2024</th></tr>",
        row(link("Foxes"), "3 - 2", link("Club Bears A", "/game/show/5"), "Big Arena", "West", "7:15 PM EST"),
        row("@", link("Owls", "x/game/show/8"), "Win 1-4", "The Pond"),
        "<tr><td colspan=9>not a day</td></tr>",
        row(link("Elks"), link("Moose"), "Ice Palace", "Hall"),
        row("", "-", ""),
        row("a", "b"),
        "<tr><th colspan=4>1/9/24</th></tr>",
        row("2024-02-03", link("Foxes"), "home"),
    ]
    alone = table(["a"], [row("2/3/2024", link("Foxes"), "2024-01", "6:00 pm"), row("", "", "")], "plain")
    pages_ = frame(spark, f'<table><tr><td>x</td></tr></table><table class="statTable">{"".join(rows)}</table>', alone)
    out = pages.club_schedule_rows(pages_, F.lit("https://c.org/s/"), F.lit("Bears A"), F.lit("Bears"))
    got = [(r.date, r.opponent, r.is_home, r.home_score, r.away_score, r.status, r.time, r.location, r.game_id) for r in out.orderBy("page", "place").collect()]
    assert got == [
        ("2024-01-06", "Foxes", True, 2, 3, "final", "7:15 PM EST", "Big Arena", "5"),
        ("2024-01-06", "Owls", False, 4, 1, "final", "", "The Pond", "8"),
        ("2024-01-06", "Elks", None, None, None, "scheduled", "", "Ice Palace", None),
        ("2024-01-06", "TBD", None, None, None, "scheduled", "", "", None),
        ("2024-01-09", "Foxes", True, 2, 2024, "final", "", "home", None),
        ("2024-02-03", "Foxes", True, 1, 2024, "final", "6:00 pm", "2/3/2024", None),
    ]


def test_calendar(spark):
    html = '<ul class="x games-slider-inner"><li id="slider_day_2024_01_15"><a href="/d/1">x</a></li><li id="slider_day_2024_1_1"><a href="/no">x</a></li><li id="slider_day_2024_01_16"></li></ul><li id="slider_day_2024_01_17"><a href="/no">x</a>'
    out = pages.calendar_dates(frame(spark, html, None, ""), "https://l.org").collect()
    assert [(r.page, r.day, r.url) for r in out] == [(0, "2024_01_15", "https://l.org/d/1")]


def test_few_pages_are_objects_at_once(monkeypatch):
    made = []
    monkeypatch.setattr(markup, "PAGES", 3)
    monkeypatch.setattr(markup.F, "arrow_udf", lambda _: lambda f: made.append(f) or (lambda c: c))
    markup.tables_of("html")
    build, sizes = markup.pa.array, []
    monkeypatch.setattr(markup.pa, "array", lambda x, t: sizes.append(len(x)) or build(x, t))
    html = [f"<table><tr><td>{k}</td></tr></table>" if k % 4 else None for k in range(8)]
    out = made[0](build(html, markup.pa.string())).to_pylist()
    assert [[t["rows"][0]["cells"][0]["text"] for t in p] for p in out] == [[str(k)] if k % 4 else [] for k in range(8)]
    assert len(made[0](build([], markup.pa.string()))) == 0 and max(sizes) == 3
