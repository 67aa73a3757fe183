"""The lookups of the service by route: each is a function of its tables and parameters and gives a DataFrame.

    Serving(league=…).get("teams/{id}/stats", id=3, season_id=1996)

A route's parameters become filters, which Catalyst pushes below the operators' groupings where their keys allow.
Nothing is run here; transport, push subscriptions and files of pictures are not part of it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import core
from .operators import answers, directory, logos, players, quality, teams
from .operators.league import League, team_games

ROUTES: dict[str, Callable[..., DataFrame]] = {}


def _route(*paths: str):
    def keep(f):
        for p in paths:
            ROUTES[p] = f
        return f

    return keep


@dataclass(frozen=True)
class Serving:
    """Tables behind the routes: a league's seasons, the directory of clubs, that of the own club, and logos.

    club: clubs, teams, players, coaches, board, contacts, games. own: players, teams, evaluations, events, board, venues,
    announcements, coaches. pictures: logos and aliases as `logos.build` makes them.
    """

    league: League | None = None
    club: dict[str, DataFrame] = field(default_factory=dict)
    own: dict[str, DataFrame] = field(default_factory=dict)
    pictures: tuple[DataFrame, DataFrame] | None = None

    def get(self, route: str, **parameters) -> DataFrame:
        """The answer of a route, such as "clubs/{id}/teams"; unknown routes and parameters are errors."""
        if route not in ROUTES:
            raise KeyError(f"no route {route}")
        return ROUTES[route](self, **parameters)


def _of(df: DataFrame, **values) -> DataFrame:
    return answers.filtered(df, *[answers.equal(c, v) for c, v in values.items()])


# Seasons and divisions.


@_route("seasons/{id}")
def season(s: Serving, id=None) -> DataFrame:
    """Days, games, teams and divisions of a season."""
    x = s.league.season(id)
    days = x.games.groupBy("season_id").agg(F.count("*").alias("n_games"), F.count_if(core.final(F.col("status"))).alias("n_finals"), F.min("game_date").alias("first_day"), F.max("game_date").alias("last_day"))
    return days.join(x.teams.groupBy("season_id").agg(F.count("*").alias("n_teams"), F.countDistinct("division_id").alias("n_divisions")), "season_id")


@_route("seasons/{id}/divisions")
def divisions(s: Serving, id=None) -> DataFrame:
    return s.league.season(id).teams.groupBy("season_id", "division_id").agg(F.count("*").alias("n_teams")).orderBy("season_id", "division_id")


@_route("divisions/{id}/standings")
def standings(s: Serving, id=None, season_id=None) -> DataFrame:
    return _of(teams.standings(s.league.season(season_id)), division_id=id).orderBy("season_id", "division_id", "place")


@_route("divisions/{id}/teams")
def division_teams(s: Serving, id=None, season_id=None) -> DataFrame:
    return _of(s.league.season(season_id).teams, division_id=id).orderBy("team_name")


# Teams.


@_route("teams/{id}")
def team(s: Serving, id=None, season_id=None) -> DataFrame:
    return _of(s.league.season(season_id).teams, team_id=id)


@_route("teams/{id}/stats")
def team_stats(s: Serving, id=None, season_id=None) -> DataFrame:
    """Record, place in the division, latest games and streak; the others of its division count for place and averages."""
    return _of(teams.profile(s.league.season(season_id)), team_id=id)


@_route("teams/{id}/schedule")
def team_schedule(s: Serving, id=None, season_id=None) -> DataFrame:
    return _of(team_games(s.league.season(season_id).games, scored=False, finals=False), team_id=id).orderBy("game_date", "game_id")


@_route("teams/{id}/roster")
def team_roster(s: Serving, id=None, season_id=None) -> DataFrame:
    return _of(players.roster(players.basic(s.league.season(season_id))), team_id=id).orderBy("place")


@_route("teams/{id}/leaders")
def team_leaders(s: Serving, id=None, season_id=None, limit: int = 10) -> DataFrame:
    return _of(team_roster(s, id, season_id)).where(F.col("place") <= limit)


# Players.


@_route("players/{id}", "players/{id}/stats")
def player(s: Serving, id=None, season_id=None) -> DataFrame:
    """Totals, rates and place within the team."""
    basic = players.basic(s.league.season(season_id))
    return _of(basic.join(players.card(basic).select(*players.KEY, "team_rank"), players.KEY), player_id=id)


@_route("players/search")
def player_search(s: Serving, number: int | None = None, team_id=None, name: str | None = None, season_id=None, limit: int = 50) -> DataFrame:
    x = s.league.season(season_id)
    return players.search(players.basic(x).join(players.usual_number(x), players.KEY), number, team_id, name, limit)


def _leaders(category: str):
    def leaders(s: Serving, id=None, limit: int = 50, min_games: int = 1) -> DataFrame:
        return players.leaders(players.basic(s.league.season(id)), category, limit, min_games)

    return leaders


for _category in ("points", "goals", "assists"):
    ROUTES[f"seasons/{{id}}/leaders/{_category}"] = _leaders(_category)


# Games.


@_route("games/{id}")
def game(s: Serving, id=None, shown: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """A game with its goals and penalties as arrays; shown: columns of each that are wanted, all by default."""
    x, shown = s.league, shown or {}
    children = {"goals": answers.Children(x.goals, "game_id", ["period", "scorer_id"]), "penalties": answers.Children(x.penalties, "game_id", ["player_id"])}
    children = {k: answers.Children(_of(c.rows, game_id=id), c.key, c.order, shown.get(k, ())) for k, c in children.items()}
    return answers.nested(_of(x.games, game_id=id), "game_id", children)


@_route("games/{id}/summary")
def game_summary(s: Serving, id=None) -> DataFrame:
    """Numbers of goals and penalties of a game."""
    x = s.league
    scored = _of(x.goals, game_id=id).groupBy("game_id").agg(F.count("*").alias("n_goals"), F.count_if("pp").alias("n_pp"))
    fouls = _of(x.penalties, game_id=id).groupBy("game_id").agg(F.count("*").alias("n_penalties"), F.sum("minutes").cast("long").alias("pim"))
    out = _of(x.games, game_id=id).join(scored, "game_id", "left").join(fouls, "game_id", "left").fillna(0, ["n_goals", "n_pp", "n_penalties", "pim"])
    return out.select("season_id", "game_id", "n_goals", "n_pp", "n_penalties", "pim", (F.col("home_score") + F.col("visitor_score")).alias("total_goals"))


# The own club.


@_route("whk/dashboard")
def dashboard(s: Serving, as_of, limit: int = 5) -> DataFrame:
    """Counts of the club's tables and its announcements that hold, one row."""
    held = directory.announcements(s.own["announcements"], as_of, limit)
    named = held.agg(F.array_sort(F.collect_list("title")).alias("announcements"))
    for n in ("players", "teams", "events", "board"):
        named = named.crossJoin(s.own[n].agg(F.count("*").alias(f"n_{n}")))  # one row each
    return named


@_route("whk/announcements")
def announcements(s: Serving, as_of, limit: int = 10, include_expired: bool = False) -> DataFrame:
    rows = s.own["announcements"]
    if include_expired:
        return rows.orderBy(F.desc("priority"), F.desc("created_at"), "id").limit(limit)
    return directory.announcements(rows.where("is_active") if "is_active" in rows.columns else rows, as_of, limit)


@_route("whk/players")
def own_players(s: Serving, division=None, age_group=None, team_id=None, limit: int = 50, offset: int = 0) -> DataFrame:
    order = [F.asc("last_name"), F.asc("first_name"), F.asc("player_id")]
    return answers.envelope(answers.players(s.own["players"], division, age_group, team_id), "players", order, limit, offset)


@_route("whk/players/{id}", "whk/players/{id}/evaluations")
def own_player(s: Serving, id=None) -> DataFrame:
    return answers.player_with_evaluations(s.own["players"], s.own["evaluations"], id)


@_route("whk/evaluations")
def evaluations(s: Serving, tryout_color=None, min_score=None, limit: int = 50, offset: int = 0) -> DataFrame:
    rows = answers.evaluations(s.own["evaluations"], tryout_color, min_score)
    return answers.envelope(rows, "evaluations", [F.desc("total_score"), F.asc("evaluation_id")], limit, offset)


@_route("whk/teams")
def own_teams(s: Serving, division=None, season=None) -> DataFrame:
    return answers.teams(s.own["teams"], division, season)


@_route("whk/teams/{id}")
def own_team(s: Serving, id=None) -> DataFrame:
    """A team with its players by name and its coaches, whose lists of teams hold it."""
    who = answers.Children(_of(s.own["players"], team_id=id), "team_id", ["last_name", "first_name", "player_id"])
    staff = directory.coaches_of(s.own["coaches"], _of(s.own["teams"], team_id=id).select("team_id")).drop("team_ids")
    return answers.nested(_of(s.own["teams"], team_id=id), "team_id", {"players": who, "coaches": answers.Children(staff, "team_id", ["name"])})


@_route("whk/teams/{id}/roster")
def own_roster(s: Serving, id=None) -> DataFrame:
    return answers.roster(s.own["players"], id)


@_route("whk/teams/{id}/schedule")
def own_team_schedule(s: Serving, as_of, id=None, include_past: bool = False) -> DataFrame:
    return answers.team_schedule(s.own["events"], id, as_of, include_past)


@_route("whk/schedule")
def own_schedule(s: Serving, as_of, team_id=None, days: int = 14) -> DataFrame:
    return answers.schedule_items(s.own["events"], as_of, days, team_id).orderBy("start_time", "id")


@_route("whk/schedule/today")
def today(s: Serving, as_of) -> DataFrame:
    return answers.schedule_items(s.own["events"], as_of, None).orderBy("start_time", "id")


@_route("whk/board")
def own_board(s: Serving) -> DataFrame:
    return directory.board(s.own["board"]).orderBy("place")


@_route("whk/venues")
def venues(s: Serving) -> DataFrame:
    return s.own["venues"].orderBy("name")


@_route("whk/sync/status")
def sync_status(s: Serving) -> DataFrame:
    """Rows of each of the club's tables."""
    return quality.table_counts(s.own)


# Logos.


@_route("logos/list")
def logo_list(s: Serving) -> DataFrame:
    return s.pictures[0].where("local_file is not null").select("local_file").orderBy("local_file")


@_route("logos/stats")
def logo_stats(s: Serving) -> DataFrame:
    return logos.statistics(*s.pictures)


@_route("logos/search")
def logo_search(s: Serving, query: str, limit: int = 10) -> DataFrame:
    files = s.pictures[0].where("local_file is not null").select(F.regexp_extract("local_file", r"^(.*)\.[^.]*$", 1).alias("logo_name"), F.col("local_file").alias("file"))
    return logos.search(query, files, limit)


@_route("logos/lookup", "logos/team/{name}")
def logo_lookup(s: Serving, names: Sequence[tuple[str, int | None]]) -> DataFrame:
    asked = s.pictures[0].sparkSession.createDataFrame(list(names), "team_name string, team_id long")
    return logos.lookup(asked, *s.pictures)


@_route("logos/manifest")
def logo_manifest(s: Serving, season_id=None) -> DataFrame:
    """Each team of a season with its logo and where it is from."""
    asked = s.league.season(season_id).teams.select("team_name", F.lit(None).cast("long").alias("team_id")).distinct()
    return logos.lookup(asked, *s.pictures)


# Clubs.


@_route("clubs")
def clubs(s: Serving) -> DataFrame:
    return answers.find_clubs(s.club["clubs"])


@_route("clubs/search/{query}")
def club_search(s: Serving, query: str) -> DataFrame:
    return answers.find_clubs(s.club["clubs"], query)


@_route("clubs/player-search")
def club_player_search(s: Serving, name: str, club: str | None = None) -> DataFrame:
    return answers.club_players(s.club["players"], s.club["teams"], s.club["clubs"], name=name, club=club)


@_route("clubs/{id}")
def club(s: Serving, id=None) -> DataFrame:
    kinds = {"team": "teams", "player": "players", "coach": "coaches", "board_member": "board", "game": "games", "contact": "contacts"}
    return answers.club_detail(_of(s.club["clubs"], club_id=id), {k: _of(s.club[n], club_id=id) for k, n in kinds.items()})


@_route("clubs/{id}/teams")
def club_teams(s: Serving, id) -> DataFrame:
    return answers.club_teams(s.club["teams"], id)


@_route("clubs/{id}/teams/{team_id}")
def club_team(s: Serving, id, team_id) -> DataFrame:
    return answers.team_with_roster(_of(s.club["teams"], club_id=id), s.club["players"], s.club["coaches"], team_id)


@_route("clubs/{id}/players")
def club_players(s: Serving, id, team_id=None, search: str | None = None) -> DataFrame:
    return answers.club_players(s.club["players"], s.club["teams"], s.club["clubs"], id, team_id, search)


@_route("clubs/{id}/board")
def club_board(s: Serving, id) -> DataFrame:
    return directory.board(_of(s.club["board"], club_id=id)).orderBy("place")


@_route("clubs/{id}/coaches")
def club_coaches(s: Serving, id) -> DataFrame:
    return answers.club_coaches(s.club["coaches"], s.club["teams"], id)


@_route("clubs/{id}/contacts")
def club_contacts(s: Serving, id) -> DataFrame:
    return answers.club_contacts(s.club["contacts"], id)


@_route("clubs/{id}/games")
def club_games(s: Serving, id, team_id=None, status: str | None = None) -> DataFrame:
    return answers.club_games(s.club["games"], id, team_id, status)
