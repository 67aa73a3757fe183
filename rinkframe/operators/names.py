"""Names and titles as they stand on club pages: ages, levels, roles, people, programs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .resolve import title_case

# Names of ages and their codes, in order of search; None stands for no code.
AGES = {
    "mite": "U8", "mighty mite": "U6", "mini mite": "U6", "squirt": "U10", "pee wee": "U12", "peewee": "U12", "bantam": "U14", "midget": "U18",
    "u6": "U6", "u8": "U8", "u10": "U10", "u12": "U12", "u14": "U14", "u16": "U16", "u18": "U18", "u19": "U19",
    "learn to play": None, "ltp": None, "beginner hockey": None,
}

# Patterns of an age and of a level in a team's name.
AGE = r"(?i)(U\d+|Mite|Squirt|Peewee|Pee\s*Wee|Bantam|Midget|Middle\s*School|High\s*School|LTP|Learn\s*to\s*Play)"
LEVEL = r"(?i)\b([ABC]\d?)\b|(?:^|\s)(Gold|Silver|Bronze|Black|White|Red|Blue|Green)\b"

# Links of a club's page that are no teams.
NO_TEAMS = ["calendar", "home", "about us", "aboutus", "parents", "coaches", "assets", "sponsors", "register", "registration", "contact", "news", "photos", "videos", "code of conduct", "locker room policy", "board of directors", "edit my account", "tryout policy", "team store", "teamstore", "rinks", "practice schedule", "master schedule", "team pictures"]

# Endings of a club's name that do not distinguish it, and words that stand for no single club.
ENDINGS = [" youth hockey association", " youth hockey league", " hockey league", " hockey association", " youth hockey", " hockey", " youth", " league"]
COMMON = ["hawks", "hawk"]

# Words by which the title is known from the name, and what separates the two, in order.
TITLE_WORDS = ["president", "director", "coordinator", "treasurer", "secretary", "registrar"]
SEPARATORS = [" - ", " — ", " – ", ": "]

# Headings that are none of a team, and patterns of those that are.
NO_HEADERS = ["travel team overview", "learn more", "head coaches"]
HEADERS = [r"\b\d+u\b", r"\b(mite|squirt|pee\s*wee|bantam|midget)\b", r"\b(6u|8u|10u|12u|14u|15u|16u|18u)\b", r"\b(development|full\s*ice|hybrid)\b", r"\b(major|minor)\b", r"\bskills\b.*\b(coach|development)\b"]

# Words of a program's name, and labels that are no programs.
PROGRAM_WORDS = ["mite", "squirt", "peewee", "pee wee", "bantam", "midget", "8u", "10u", "12u", "14u", "16u", "18u", "learn to play", "ltp", "learn to skate", "development", "travel", "house", "rec", "recreation"]
NO_PROGRAMS = ["programs", "our programs", "hockey programs", "registration", "directions", "contact", "about", "home", "schedule", "register", "coaches", "staff", "board", "news", "house league"]


def _strip(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def _any(x: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(x, F.lit(w))
    return out


def _found(x: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def age_code(x: Column) -> Column:
    """The U-code of an age's name or of a name that begins with one; null for others."""
    key, out = F.lower(_strip(x)), F
    for name, code in AGES.items():
        out = out.when(F.startswith(key, F.lit(name)), F.lit(code))
    return out


def age_in(team: Column) -> Column:
    """The first age that a team's name holds, as written; null without."""
    return _found(team, AGE, 1)


def level_in(team: Column) -> Column:
    """The first level (a letter A to C with or without digit, or a colour) in a team's name; null without."""
    return F.coalesce(_found(team, LEVEL, 1), _found(team, LEVEL, 2))


def page_kind(url: Column) -> Column:
    """What a page is about, by its path."""
    path = F.lower(F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1))
    return F.when(_any(path, ["board", "director"]), "board page").when(_any(path, ["contact", "about"]), "contact page").when(_any(path, ["coach"]), "coaches page").when(path.isin("/", ""), "homepage").otherwise("page")


def coach_role(title: Column) -> Column:
    """Head Coach, Assistant Coach, Manager or Coach, by words in a title."""
    x = F.coalesce(F.lower(title), F.lit(""))
    return F.when(_any(x, ["head coach"]), "Head Coach").when(_any(x, ["asst", "assistant"]), "Assistant Coach").when(_any(x, ["manager"]), "Manager").otherwise("Coach")


def staff_title(title: Column) -> Column:
    """The usual roles by whole titles; other titles stay, in title case."""
    x = F.coalesce(_strip(title), F.lit(""))
    low = F.lower(x)
    return F.when(low.isin("", "coach"), "Coach").when(low == "head coach", "Head Coach").when(low.isin("assistant coach", "asst coach", "asst. coach"), "Assistant Coach").when(low == "manager", "Manager").otherwise(title_case(x))


def name_and_title(text: Column) -> Column:
    """(name, title) of 'Name - Title' or 'Title: Name'; nulls where no side is a known title or the text is over 120 long."""
    out = F.when(F.char_length(text) > 120, F.lit(None))
    for sep in SEPARATORS:
        parts = F.split(text, sep, 2)
        a, b = _strip(F.get(parts, F.lit(0))), _strip(F.get(parts, F.lit(1)))
        both = (a != "") & (b != "")
        out = out.when(both & _any(F.lower(b), TITLE_WORDS), F.struct(a.alias("name"), b.alias("title"))).when(both & _any(F.lower(a), TITLE_WORDS), F.struct(b.alias("name"), a.alias("title")))
    return out


def joined_name(name: Column) -> Column:
    """Space between first and last name where capitals show it; names in capitals in title case."""
    x = _strip(name)
    capitals = (F.upper(x) == x) & (F.lower(x) != x)
    parts = F.regexp_extract_all(x, F.lit("([A-Z][a-z]+)"), 1)
    return F.when(F.contains(x, F.lit(" ")), F.when(capitals, title_case(x)).otherwise(x)).when(F.size(parts) >= 2, F.array_join(parts, " ")).when(capitals & (F.char_length(x) > 3), title_case(x)).otherwise(x)


def is_team(name: Column, abbreviation: Column | None = None, has_season: Column | None = None) -> Column:
    """Whether a link names a team, by rules of which the first that applies decides."""
    low, aged = F.lower(_strip(name)), F.rlike(name, F.lit(AGE))
    short = F.upper(F.coalesce(abbreviation if abbreviation is not None else F.lit(None).cast("string"), F.lit("")))
    beside = F.regexp_replace(F.replace(F.upper(name), short, F.lit("")), "^[ -]+|[ -]+$", "") != ""
    season = F.coalesce(has_season, F.lit(False)) if has_season is not None else F.lit(False)
    return (
        F.when(name.isNull() | low.isin(NO_TEAMS) | (F.rlike(low, F.lit(r"^.+\s+teams?\s*$")) & ~aged), False)
        .when(aged | _any(low, ["beginner", "ltp", "learn"]), True)
        .when((short != "") & F.contains(F.upper(name), short) & beside, True)
        .when(F.rlike(_strip(name), F.lit(r"^(?:0[4-8]|1[0-9]|[Gg]\d)")), True)
        .otherwise(season)
    )


def is_team_header(text: Column) -> Column:
    """Whether a heading is that of a team."""
    low, hit = F.lower(text), F.lit(False)
    for p in HEADERS:
        hit = hit | F.rlike(low, F.lit(p))
    return F.coalesce((F.char_length(text) >= 3) & ~_any(low, NO_HEADERS) & hit, F.lit(False))


def is_program(text: Column) -> Column:
    """Whether a text of 3 to 100 characters looks like a program's name."""
    return F.coalesce(F.char_length(text).between(3, 100) & _any(F.lower(text), PROGRAM_WORDS), F.lit(False))


def program_name(text: Column) -> Column:
    """The name without space around; null for general labels."""
    x = _strip(text)
    return F.when(~F.lower(x).isin(NO_PROGRAMS), x)


def initials(name: Column) -> Column:
    """First letters of up to three words, in capitals; a question mark without words."""
    words = F.filter(F.split(name, " "), lambda w: w != "")
    return F.coalesce(F.nullif(F.upper(F.array_join(F.transform(F.slice(words, 1, 3), lambda w: F.left(w, F.lit(1))), "")), F.lit("")), F.lit("?"))


def colour_index(name: Column, colours: int = 6) -> Column:
    """Number of the colour that stands for a name, from its first character."""
    return F.coalesce(F.ascii(name), F.lit(0)) % colours


def json_list(items: Column) -> Column:
    """A list as JSON; null for an empty one."""
    return F.when(F.size(items) > 0, F.to_json(items))


def _plural(x: Column) -> Column:
    return F.endswith(x, F.lit("s")) & ~F.endswith(x, F.lit("ss"))


def name_patterns(abbreviation: Column, club: Column, town: Column) -> Column:
    """Names by which a club's teams may be known, the most telling first.

    The club's name without its ending, its last word if that is telling, both without a
    plural's s, the abbreviation, and a town of one word that no other pattern holds.
    """
    core = _strip(F.regexp_replace(F.lower(F.coalesce(club, F.lit(""))), f"(?:{'|'.join(ENDINGS)})$", ""))
    words = F.split(core, r"\s+")
    last = F.when((F.size(words) > 1) & (F.char_length(F.element_at(words, -1)) > 3) & ~F.element_at(words, -1).isin(COMMON), F.element_at(words, -1))
    single = lambda x: F.when(_plural(x), F.left(x, F.char_length(x) - 1))
    telling = single(last)
    found = F.array(F.nullif(core, F.lit("")), single(core), last, F.when(~telling.isin(COMMON), telling), F.nullif(F.lower(abbreviation), F.lit("")))
    found = F.array_distinct(F.array_compact(found))
    t = F.nullif(F.lower(town), F.lit(""))
    covered = F.exists(found, lambda p: F.contains(p, t))
    return F.when(t.isNotNull() & ~F.coalesce(covered, F.lit(False)) & ~F.rlike(t, F.lit("[-/ ]")), F.concat(found, F.array(t))).otherwise(found)
