"""Entity resolution: names of clubs, teams and players across sources."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Colours that end a team's name, in order of removal; each goes once.
COLOURS = ["Red", "Blue", "White", "Black", "Green", "Gold", "Silver", "Gray", "Grey", "Orange", "Purple"]

# Level names (patterns) from which on a team's name is no longer its club's, in order.
LEVELS = ["Squirt", "Pee ?Wee", "PeeWee", "Bantam", "Midget", "Mite"]

# Clubs that are written in capitals.
ACRONYMS = ["WHK", "SSC", "NRI", "KP", "YD", "CC", "GU10", "GU12"]

# Platforms and the marks of their pages, in order.
PLATFORMS = {
    "sportsengine": ["sportngin", "sportsengine", "theme-nav-item", "se-widget"],
    "crossbar": ["crossbar"],
    "leagueapps": ["leagueapps", "/clubteams/", "la-team"],
    "angular": ["ng-star-inserted", "angular", "ng-version"],
}


def title_case(x: Column) -> Column:
    """Upper case after any character that is no letter, lower case elsewhere."""
    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit(r"(\p{L}+|\P{L}+)"), 1), lambda p: F.initcap(p)), "")


def club_name(team: Column) -> Column:
    """The club in a team's name: without division, age, colour, letter, number and level, in title case but for acronyms."""
    stripped = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    x = stripped(F.coalesce(team, F.lit("")))
    x = F.when(F.contains(x, F.lit(" - ")), stripped(F.substring_index(x, " - ", 1))).when(F.contains(x, F.lit("-")) & ~F.startswith(x, F.lit("U")), stripped(F.substring_index(x, "-", 1))).otherwise(x)
    colours = [rf"(?i)\s+{c}$" for c in COLOURS]
    levels = [rf"(?i)\s+{v}.*$" for v in LEVELS]
    for pattern in [r"\s*\([^)]*\)", r"(?i)\s+U\d+[ABC]?\d?", r"(?i)\s+Girls?$", *colours, r"\s+[A-Z]$", r"\s+\d$", *levels]:
        x = F.regexp_replace(x, pattern, "")
    x = F.when(F.upper(x).isin(ACRONYMS), F.upper(x)).otherwise(title_case(x))
    return stripped(F.regexp_replace(x, r"\s+", " "))


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def fingerprint(x: Column) -> Column:
    """Letters and digits in lower case; see `fold` for names with marks on letters."""
    return F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]", "")


def fold(df: DataFrame, column: str, out: str) -> DataFrame:
    """Add compatibility-decomposed fingerprints, for which Spark has no function."""
    import unicodedata

    @F.pandas_udf("string")
    def decomposed(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFKD", v).lower() if c.isalnum()))

    return df.withColumn(out, decomposed(F.col(column)))


def division_parts(x: Column) -> Column:
    """Age, level and tier of a division's name, nulls where it has none."""
    part = lambda p, k: F.nullif(F.regexp_extract(x, p, k), F.lit(""))
    plain, girls = r"^(U\d+)([A-C])(?:\s*-\s*(.+))?", r"^G(U\d+)([A-C])?(?:\s*-\s*(.+))?"
    return F.struct(F.coalesce(part(plain, 1), F.concat(F.lit("G"), part(girls, 1))).alias("age"), F.coalesce(part(plain, 2), part(girls, 2)).alias("level"), F.coalesce(part(plain, 3), part(girls, 3)).alias("tier"))


def split_name(x: Column) -> Column:
    parts = F.split(F.trim(x), r"\s+", 2)
    return F.struct(F.get(parts, F.lit(0)).alias("first"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("last"))


def date_of(x: Column) -> Column:
    """A date in any of the usual forms; a weekday before it is dropped; null otherwise."""
    x = F.trim(F.regexp_replace(x, r"^(?i)(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?,?\s+", ""))
    forms = ["yyyy-MM-dd", "M/d/yyyy", "M/d/yy", "MMMM d, yyyy", "MMM d, yyyy", "MMMM d yyyy", "MMM d yyyy"]
    inside = F.regexp_extract(x, r"(\d{1,2}/\d{1,2}/\d{4})", 1)
    return F.coalesce(*[F.try_to_date(x, f) for f in forms], F.try_to_date(inside, "M/d/yyyy"))


def contacts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Mail and phone links of pages, once each without regard to case."""
    kinds = F.array(F.struct(F.lit("email").alias("kind"), F.regexp_extract_all(F.col(html), F.lit("mailto:([^\"'?>]+)"), 1).alias("found")), F.struct(F.lit("phone").alias("kind"), F.regexp_extract_all(F.col(html), F.lit("tel:([^\"'>]+)"), 1).alias("found")))
    flat = pages.select(key, F.inline(kinds)).select(key, "kind", F.explode("found").alias("value"))
    return flat.groupBy(key, "kind", F.lower("value").alias("folded")).agg(F.min("value").alias("value")).drop("folded")


def platform(html: Column) -> Column:
    """The first platform one of whose marks the page holds, in any case; the first of all where there is none."""
    x, out = F.lower(html), F
    for name, marks in PLATFORMS.items():
        out = out.when(F.greatest(*[F.contains(x, F.lit(m)) for m in marks], F.lit(False)), name)
    return out.otherwise(next(iter(PLATFORMS)))


def parallel_arrays(doc: DataFrame) -> DataFrame:
    """Rows of a document of parallel arrays team_ids, titles, divisions; short arrays give nulls, rows without title go."""
    return doc.select(F.inline(F.arrays_zip("team_ids", "titles", "divisions"))).where("titles is not null").select(F.col("team_ids").alias("team_id"), F.col("titles").alias("team_name"), F.col("divisions").alias("division_id"))


def parallel_arrays_round_trip(nation: DataFrame) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").cast("long").alias("i"), F.col("n_name").alias("n"), F.col("n_regionkey").cast("long").alias("r"))))
    doc = nation.groupBy("n_regionkey").agg(rows.alias("x")).select(F.col("x.i").alias("team_ids"), F.col("x.n").alias("titles"), F.col("x.r").alias("divisions"))
    return parallel_arrays(doc)


def match_by_number(left: DataFrame, right: DataFrame) -> DataFrame:
    """Players of one team who wear one number; of several candidates the last id wins."""
    r = right.groupBy("season_id", "team_id", "number").agg(F.max("player_id").alias("matched_id"))
    return left.join(r, ["season_id", "team_id", "number"])


def roster_overlap(left: DataFrame, right: DataFrame, set_id: str, member: str) -> DataFrame:
    """Jaccard overlap of two families of sets under one id, both not empty."""
    a = left.groupBy(set_id).agg(F.collect_set(member).alias("a"))
    b = right.groupBy(set_id).agg(F.collect_set(member).alias("b"))
    return a.join(b, set_id).select(set_id, (F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))).alias("overlap"))


def best_overlap(left: DataFrame, right: DataFrame, block: str, set_id: str, member: str, least: float = 0.5, least_size: int = 3, chunk: int = 16384) -> DataFrame:
    """For each left set the right set of its block that overlaps most, `least` at least; of equal ones that of the least id.

    Equal sets are one class, which is compared once. Classes are dealt into chunks of about `chunk`; a task meets one
    left and one right chunk of a block, so that shared members, which may be common, are never joined. A set is one row.
    """
    known = lambda d: d.select(*[F.col(c).alias(c) for c in (block, set_id, member)]).where(F.col(block).isNotNull() & F.col(set_id).isNotNull()).groupBy(block, set_id).agg(F.sort_array(F.collect_set(member)).alias("members")).where(F.size("members") > 0)
    one, two = known(left).where(F.size("members") >= least_size), known(right)
    dealt, other = (d.groupBy(block, "members").agg(F.min(set_id).alias("first_id")) for d in (one, two))
    # Of as many chunks as a block has of the one side, each chunk of the other side meets all.
    count = lambda d, n: d.groupBy(F.col(block).alias("block_")).agg(F.ceil(F.count("*") / chunk).alias(n))
    grid = count(dealt, "n_left").join(count(other, "n_right"), "block_")
    at = lambda n: F.pmod(F.xxhash64("members"), F.col(n))
    dealt, other = (d.join(grid, F.col(block) == F.col("block_")) for d in (dealt, other))
    dealt = dealt.select(block, "members", "first_id", at("n_left").alias("i_"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_right") - 1)).alias("j_"))
    other = other.select(block, "members", "first_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_left") - 1)).alias("i_"), at("n_right").alias("j_"))
    kinds = dict(dealt.dtypes)
    found = dealt.groupBy(block, "i_", "j_").cogroup(other.groupBy(block, "i_", "j_")).applyInPandas(_nearest_sets(block, least), f"`{block}` {kinds[block]}, class_id {kinds['first_id']}, right_id {dict(other.dtypes)['first_id']}, overlap double")
    best = found.groupBy(block, "class_id").agg(F.min_by(F.struct("right_id", "overlap"), F.struct(-F.col("overlap"), "right_id")).alias("best"))
    classes = one.groupBy(block, "members").agg(F.min(set_id).alias("class_id")).join(best, [block, "class_id"]).select(block, "members", "best")
    return one.join(classes, [block, "members"]).select(block, F.col(set_id).alias("left_id"), "best.right_id", "best.overlap")


def _nearest_sets(block: str, least: float):
    """For each set of a chunk the set of another one that overlaps most, by products of their incidence matrices."""

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({block: a[block][:0], "class_id": a["first_id"][:0], "right_id": b["first_id"][:0], "overlap": np.empty(0)})
        b = b.sort_values("first_id", kind="stable")
        size_a, size_b = (x["members"].map(len).to_numpy() for x in (a, b))
        row_a, row_b = np.repeat(np.arange(len(a)), size_a), np.repeat(np.arange(len(b)), size_b)
        codes, names = pd.factorize(np.concatenate([*a["members"], *b["members"]]))
        code_a, code_b = codes[: len(row_a)], codes[len(row_a) :]
        in_a, in_b = np.bincount(code_a, minlength=len(names)), np.bincount(code_b, minlength=len(names))
        # Members that many sets hold are columns of matrices, those of few sets are paired one by one.
        common = np.flatnonzero(in_a.astype(float) * in_b > len(a) * len(b) / 64)
        column = np.full(len(names), -1)
        column[common] = np.arange(len(common))
        own_b = np.flatnonzero((column[code_b] < 0) & (in_a[code_b] > 0))
        own_b = own_b[np.argsort(code_b[own_b], kind="stable")]
        begin = np.searchsorted(code_b[own_b], np.arange(len(names) + 1))
        step, width = max(1, (1 << 22) // len(b)), 256
        best, at = np.full(len(a), -1.0), np.zeros(len(a), int)
        for low in range(0, len(a), step):
            high = min(low + step, len(a))
            k0, k1 = np.searchsorted(row_a, [low, high])
            rows, held = row_a[k0:k1] - low, code_a[k0:k1]
            n = np.zeros((high - low, len(b)), np.float32)
            for first in range(0, len(common), width):
                x, y = np.zeros((high - low, width), np.float32), np.zeros((width, len(b)), np.float32)
                here, there = (np.flatnonzero((column[c] >= first) & (column[c] < first + width)) for c in (held, code_b))
                x[rows[here], column[held[here]] - first] = 1
                y[column[code_b[there]] - first, row_b[there]] = 1
                n += x @ y
            rare = np.flatnonzero(begin[held + 1] > begin[held])
            many = begin[held[rare] + 1] - begin[held[rare]]
            place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin[held[rare]], many)
            np.add.at(n, (np.repeat(rows[rare], many), row_b[own_b[place]]), 1)
            n = n.astype(float)
            n /= size_a[low:high, None] + size_b[None, :] - n
            at[low:high] = n.argmax(axis=1)
            best[low:high] = n.max(axis=1)
        kept = (best >= least) & (best > 0)
        return pd.DataFrame({block: a[block][kept], "class_id": a["first_id"][kept], "right_id": b["first_id"].to_numpy()[at[kept]], "overlap": best[kept]})

    return nearest


def structured_match(clubs: DataFrame, teams: DataFrame) -> DataFrame:
    """Teams of one age whose name holds the club's pattern, levels equal where both are known; exactly one candidate.

    clubs: club_team, age, level, pattern. teams: team_id, team_name, age, level.
    """
    bare = lambda c: F.upper(F.regexp_replace(c, "[0-9]+$", ""))
    c, t = clubs.alias("c"), teams.alias("t")
    levels = F.coalesce(bare(F.col("c.level")) == bare(F.col("t.level")), F.lit(True))
    hits = c.join(t, (F.col("c.age") == F.col("t.age")) & F.contains(F.lower("t.team_name"), F.lower("c.pattern")) & levels)
    hits = hits.select(F.col("c.club_team").alias("club_team"), F.col("t.team_id").alias("team_id")).distinct()
    return hits.withColumn("n", F.count("*").over(W.partitionBy("club_team"))).where("n = 1").drop("n")


def _similar(least: float):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            found = []
            for a, b in zip(d["name"], d["other"], strict=True):
                m = SequenceMatcher(None, a, b)
                # The count of shared characters bounds the similarity from above.
                found.append(m.ratio() if m.quick_ratio() >= least else 0.0)
            yield d.assign(similarity=found)

    return score


def _characters(x: Column) -> Column:
    """The characters of a name, each with the number of its occurrence; an empty name has one mark of its own."""
    n = F.char_length(x)
    chars = F.transform(F.sequence(F.lit(1), n), lambda i: x.substr(i, F.lit(1)))
    numbered = lambda c: F.transform(F.sequence(F.lit(1), F.size(F.filter(chars, lambda y: y == c))), lambda k: F.concat(c, k.cast("string")))
    return F.when(n == 0, F.array(F.lit(""))).when(n > 0, F.flatten(F.transform(F.array_distinct(chars), numbered)))


def _parts(a: int, b: int, least: float, most: int) -> int:
    """Into how many parts the shorter of two names of a and b characters is cut for its keys; 0 where a name would have many more than `most`.

    Similar names have a common subsequence of `kept` characters. With one part, keys are all subsequences of that
    length. With more, one of the parts has at most its even share of all the characters that either name loses.
    """
    kept = ceil(least * (a + b) / 2 - 1e-6)
    if max(comb(a, kept), comb(b, kept)) <= most:
        return 1
    short, lost = min(a, b), a + b - 2 * kept
    for parts in range(2, short // 3 + 1):
        share, size = lost // parts, -(-short // parts)
        own = sum(comb(size, n) for n in range(min(share, short - kept) + 1))
        partner = (1 + lost) * sum(comb(size + n, n) for n in range(min(share, max(a, b) - kept) + 1))
        if parts * max(own, partner) <= most:
            return parts
    return 0


def _without(x: str, n: int) -> set[str]:
    """The name without n of its characters, in all ways."""
    return {"".join(y) for y in combinations(x, len(x) - n)}


def _keys(x: str, other: int, parts: int, cut: bool, least: float) -> set[str]:
    """Keys of a name for partners of a length; `cut`: the name is cut into parts, not its partner."""
    kept = ceil(least * (len(x) + other) / 2 - 1e-6)
    mine, theirs = len(x) - kept, other - kept
    if parts == 1:
        return _without(x, mine)
    share, size = (mine + theirs) // parts, len(x) if cut else other
    edges, out = [size * k // parts for k in range(parts + 1)], set()
    for k, (low, high) in enumerate(zip(edges, edges[1:])):
        if cut:
            out |= {f"{k} {y}" for n in range(min(share, mine, high - low) + 1) for y in _without(x[low:high], n)}
            continue
        # What stands before the part was moved by what either name lost there.
        for start in range(max(0, low - theirs), min(len(x), low + mine) + 1):
            for gone in range(min(share, theirs, high - low) + 1):
                for n in range(min(share - gone, mine) + 1):
                    if (end := start + high - low - gone + n) <= len(x):
                        out |= {f"{k} {y}" for y in _without(x[start:end], n)}
    return out


def _all_keys(least: float):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 64):
                rows = []
                for x, is_left, partners in zip(*[c.to_pylist() for c in batch.slice(low, 64).columns], strict=True):
                    for p in partners:
                        cut = len(x) < p["other"] or (len(x) == p["other"] and is_left)
                        pair = (len(x), p["other"]) if is_left else (p["other"], len(x))
                        rows += [(x, is_left, *pair, k) for k in _keys(x, p["other"], p["parts"], cut, least)]
                columns = zip(*rows) if rows else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=["x", "is_left", "a", "b", "key"])

    return make


def _cuts(least: float, most: int):
    return lambda batches: (d.assign(parts=[_parts(a, b, least, most) for a, b in zip(d["a"], d["b"], strict=True)]) for d in batches)


def _by_rarest(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """Pairs of names that share one of the rarest few characters of each (a prefix filter).

    Names of lengths a and b that are similar enough share least * (a + b) / 2 characters, hence at least
    a * least / (2 - least) of the one's.
    """
    names = left.select(F.col("name").alias("x"), F.lit(True).alias("is_left")).unionByName(right.select(F.col("other").alias("x"), F.lit(False).alias("is_left")))
    marks = names.select("x", "is_left", F.explode(_characters(F.col("x"))).alias("mark"))
    common = marks.groupBy("mark").agg(F.count("*").alias("many"))
    rank = F.row_number().over(W.partitionBy("is_left", "x").orderBy("many", "mark"))
    n = F.char_length("x")
    shared = F.greatest(F.lit(1), F.ceil(n * F.lit(least / (2 - least)) - F.lit(1e-6)))
    first = marks.join(common, "mark").withColumn("rank", rank).where(F.col("rank") <= F.greatest(F.lit(1), n - shared + 1))
    one = first.where("is_left").select(F.col("x").alias("name"), "mark")
    two = first.where("not is_left").select(F.col("x").alias("other"), "mark")
    return one.join(two, "mark").select("name", "other")


def fuzzy_match(left: DataFrame, right: DataFrame, least: float = 0.8, most: int = 2000) -> DataFrame:
    """Best partner of each name by Ratcliff-Obershelp similarity, `least` at least, which is above 0.

    left: name. right: other. Only names that share a key of `_keys` are compared, or one of their rarest characters
    where a name would have many more than `most` keys for partners of one length.
    """
    names = left.select(F.col("name").alias("x"), F.lit(True).alias("is_left")).unionByName(right.select(F.col("other").alias("x"), F.lit(False).alias("is_left"))).where("x is not null").distinct()
    size = F.char_length("x")
    lengths = names.select("is_left", size.alias("n")).distinct()
    # Lengths that occur on both sides and can be similar: a few rows.
    span = F.sequence(F.ceil(F.col("n") * F.lit(least / (2 - least)) - F.lit(1e-6)), F.floor(F.col("n") * F.lit((2 - least) / least) + F.lit(1e-6)))
    met = lengths.where("is_left").select(F.col("n").alias("a"), F.explode(span).alias("b")).join(lengths.where("not is_left").select(F.col("n").cast("long").alias("b")), "b").select("a", F.col("b").cast("int").alias("b"))
    met = met.mapInPandas(_cuts(least, most), "a int, b int, parts int")
    keyed = met.where("parts > 0").select(F.inline(F.array(F.struct(F.lit(True).alias("is_left"), F.col("a").alias("n"), F.col("b").alias("other"), "parts"), F.struct(F.lit(False).alias("is_left"), F.col("b").alias("n"), F.col("a").alias("other"), "parts"))))
    partners = keyed.groupBy("is_left", "n").agg(F.collect_list(F.struct("other", "parts")).alias("partners"))
    keys = names.withColumn("n", size).join(partners, ["is_left", "n"]).select("x", "is_left", "partners").mapInArrow(_all_keys(least), "x string, is_left boolean, a int, b int, key string")
    keys = keys.select("x", "is_left", F.xxhash64("a", "b", "key").alias("key"))
    pairs = keys.where("is_left").select(F.col("x").alias("name"), "key").join(keys.where("not is_left").select(F.col("x").alias("other"), "key"), "key").select("name", "other")
    rest = met.where("parts = 0")
    of = lambda flag, column, out: names.where(flag).join(rest.select(F.col(column).alias("n")).distinct(), size == F.col("n")).select(F.col("x").alias(out))
    rarest = _by_rarest(of("is_left", "a", "name"), of("not is_left", "b", "other"), least)
    rarest = rarest.join(rest.select("a", "b"), (F.char_length("name") == F.col("a")) & (F.char_length("other") == F.col("b"))).select("name", "other")
    scored = pairs.unionByName(rarest).distinct().mapInPandas(_similar(least), "name string, other string, similarity double").where(F.col("similarity") >= least)
    best = W.partitionBy("name").orderBy(F.desc("similarity"), "other")
    return scored.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")
