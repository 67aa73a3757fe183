from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rinkframe.operators import logos
from rinkframe.operators.league import League
from rinkframe.serving import ROUTES, Serving


@pytest.fixture(scope="module")
def served(spark):
    t = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    league = League(
        t("season_id long, team_id long, team_name string, division_id long", (1, 1, "A", 7), (1, 2, "B", 7), (1, 3, "C", 8), (2, 1, "A", 7)),
        t("season_id long, game_id long, game_date date, home_id long, visitor_id long, home_score long, visitor_score long, status string", (1, 10, date(2024, 1, 1), 1, 2, 3, 1, "final"), (1, 11, date(2024, 1, 2), 2, 3, None, None, "scheduled"), (2, 12, date(2025, 1, 1), 1, 1, 0, 0, "final")),
        t("season_id long, game_id long, team_id long, period string, scorer_id string, scorer_number long, assist1_id string, assist2_id string, pp boolean, sh boolean, gw boolean, en boolean", (1, 10, 1, "1st", "p", 9, "q", None, True, False, True, False), (1, 10, 1, "2nd", "p", 9, None, None, False, False, False, False), (1, 10, 2, "1st", "r", 4, None, None, False, False, False, False)),
        t("season_id long, game_id long, team_id long, player_id string, player_number long, minutes long", (1, 10, 2, "r", 4, 2)),
    )
    at = datetime(2024, 1, 5, 9)
    club = {
        "clubs": t("club_id int, club_name string, abbreviation string, town string", (1, "Bears", "B", "Hull"), (2, "Foxes", None, None)),
        "teams": t("team_id int, club_id int, team_name string, age_group string, division_level string, is_active boolean, team_page_url string", (5, 1, "B1", "U8", "A", True, "u")),
        "players": t("player_id int, club_id int, team_id int, first_name string, last_name string, jersey_number string", (1, 1, 5, "Al", "Z", "9")),
        "coaches": t("coach_id int, club_id int, team_id int, name string", (1, 1, 5, "Kim")),
        "board": t("club_id int, name string, title string, is_active boolean", (1, "Lee", "Vice President", True), (1, "Max", "President", True), (1, "No", "Clerk", False)),
        "contacts": t("club_id int, contact_type string, value string", (1, "email", "a")),
        "games": t("game_id int, club_id int, team_id int, date string, time string, status string", (1, 1, 5, "2024", "8", "final")),
    }
    own = {
        "players": t("player_id string, first_name string, last_name string, division string, age_group string, team_id long, jersey_number int", ("x", "Al", "Z", "A", "U8", 1, 4), ("y", "Bo", "Y", "A", "U8", 1, 3)),
        "teams": t("team_id long, division string, level string, season string", (1, "A", "1", "s"), (2, "B", "1", "s")),
        "evaluations": t("evaluation_id int, player_id string, created_at timestamp, tryout_color string, total_score int", (1, "x", at, "red", 5)),
        "events": t("event_id int, title string, start_time timestamp, end_time timestamp, team_id long", (1, "practice", at, None, 1)),
        "board": club["board"],
        "venues": t("name string", ("R",)),
        "announcements": t("id int, title string, priority string, created_at timestamp, publish_date timestamp, expire_date timestamp, is_active boolean", (1, "now", "b", at, None, None, True), (2, "gone", "a", at, None, datetime(2023, 1, 1), True)),
        "coaches": t("coach_id int, name string, team_ids string", (1, "Kim", "[1, 3]"), (2, "Lee", "[11]")),
    }
    pictures = logos.build(t("file string", ("a.svg",)), t("team_name string, team_id long, logo_url string", ("B", 2, "http://b")), t("alias string, file string", ("Alpha", "a.svg")))
    return Serving(league, club, own, pictures)


AT = lambda: F.lit("2024-01-05 00:00:00").cast("timestamp")
#: Parameters of each route, and how many rows it gives.
CALLS = {
    "seasons/{id}": ({"id": 1}, 1), "seasons/{id}/divisions": ({"id": 1}, 2), "divisions/{id}/standings": ({"id": 7, "season_id": 1}, 2), "divisions/{id}/teams": ({"id": 7}, 3), "teams/{id}": ({"id": 1}, 2), "teams/{id}/stats": ({"id": 1, "season_id": 1}, 1),
    "teams/{id}/schedule": ({"id": 2}, 2), "teams/{id}/roster": ({"id": 1}, 2), "teams/{id}/leaders": ({"id": 1, "limit": 1}, 1), "players/{id}": ({"id": "p"}, 1), "players/{id}/stats": ({}, 3), "players/search": ({"number": 9}, 1),
    "seasons/{id}/leaders/points": ({"id": 1, "limit": 2}, 2), "seasons/{id}/leaders/goals": ({"id": 1}, 3), "seasons/{id}/leaders/assists": ({"id": 2}, 0), "games/{id}": ({"id": 10}, 1), "games/{id}/summary": ({}, 3),
    "whk/dashboard": ({"as_of": AT}, 1), "whk/announcements": ({"as_of": AT}, 1), "whk/players": ({"division": "A"}, 1), "whk/players/{id}": ({"id": "x"}, 1), "whk/players/{id}/evaluations": ({}, 2), "whk/evaluations": ({}, 1), "whk/teams": ({}, 2), "whk/teams/{id}": ({"id": 1}, 1),
    "whk/teams/{id}/roster": ({"id": 1}, 2), "whk/teams/{id}/schedule": ({"as_of": AT, "id": 1}, 1), "whk/schedule": ({"as_of": AT}, 1), "whk/schedule/today": ({"as_of": AT}, 1), "whk/board": ({}, 2), "whk/venues": ({}, 1), "whk/sync/status": ({}, 8),
    "logos/list": ({}, 1), "logos/stats": ({}, 6), "logos/search": ({"query": "a"}, 1), "logos/lookup": ({"names": [("Alpha", None), ("B", 2)]}, 2), "logos/team/{name}": ({"names": [("zzz", None)]}, 1), "logos/manifest": ({"season_id": 1}, 3),
    "clubs": ({}, 2), "clubs/search/{query}": ({"query": "hul"}, 1), "clubs/player-search": ({"name": "al"}, 1), "clubs/{id}": ({"id": 1}, 1), "clubs/{id}/teams": ({"id": 1}, 1), "clubs/{id}/teams/{team_id}": ({"id": 1, "team_id": 5}, 1), "clubs/{id}/players": ({"id": 1}, 1),
    "clubs/{id}/board": ({"id": 1}, 2), "clubs/{id}/coaches": ({"id": 1}, 1), "clubs/{id}/contacts": ({"id": 1}, 1), "clubs/{id}/games": ({"id": 1, "status": "final"}, 1),
}


def test_every_route(served):
    assert CALLS.keys() == ROUTES.keys()
    for route, (parameters, n) in CALLS.items():
        given = {k: v() if v is AT else v for k, v in parameters.items()}
        assert served.get(route, **given).count() == n, route
    with pytest.raises(KeyError):
        served.get("nowhere")


def test_some_answers(served):
    (g,) = served.get("games/{id}", id=10).collect()
    assert [x.scorer_id for x in g.goals] == ["p", "r", "p"] and g.n_penalties == 1
    (t,) = served.get("whk/teams/{id}", id=1).collect()
    assert [p.player_id for p in t.players] == ["y", "x"] and [c.name for c in t.coaches] == ["Kim"]
    (c,) = served.get("clubs/{id}", id=1).collect()
    assert (c.team_count, c.player_count, c.coach_count, c.board_member_count, c.game_count, c.contact_count) == (1, 1, 1, 3, 1, 1)
    assert [r.name for r in served.get("clubs/{id}/board", id=1).collect()] == ["Max", "Lee"]
    (d,) = served.get("whk/dashboard", as_of=AT()).collect()
    assert d.announcements == ["now"] and d.n_players == 2
