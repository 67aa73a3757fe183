"""Logos of teams: a cascade of aliases, names, stripped names and similar names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import resolve

# Words (patterns) that tell teams of one club apart.
WORDS = [r"U\d+[A-Z]?", "Squirt", "PeeWee", "Bantam", "Midget", "Mite", "Red", "Blue", "White", "Black", "Gold", "Silver", "Grey", "Green", "Yellow", r"\d+", "Girls", "Boys"]


def strip_words(x: Column) -> Column:
    """The name without age, level, colour, number and gender words."""
    return F.trim(F.regexp_replace(F.regexp_replace(x, rf"(?i)\b({'|'.join(WORDS)})\b", ""), r"\s+", " "))


def match(teams: DataFrame, logos: DataFrame, aliases: DataFrame, least: float = 0.8) -> DataFrame:
    """Logo file and confidence of each team name: alias 1.0, same name 1.0, alias of the stripped name .95, stripped name .95, name similar to it or to the stripped one.

    teams: team_name. logos: logo_name, file. aliases: alias, file.
    """
    t = teams.select("team_name").distinct().withColumns({"key": resolve.fingerprint(F.col("team_name")), "bare": resolve.fingerprint(strip_words(F.col("team_name")))})
    first = lambda df, key, out: df.groupBy(key.alias(f"k_{out}")).agg(F.min("file").alias(out))
    a = first(aliases, resolve.fingerprint(F.col("alias")), "alias_file")
    n = first(logos, resolve.fingerprint(F.col("logo_name")), "name_file")
    b = first(logos, resolve.fingerprint(strip_words(F.col("logo_name"))), "bare_file")
    s = first(aliases, resolve.fingerprint(F.col("alias")), "bare_alias")
    t = t.join(a, F.col("key") == F.col("k_alias_file"), "left").join(s, (F.col("bare") == F.col("k_bare_alias")) & (F.col("bare") != ""), "left").join(n, F.col("key") == F.col("k_name_file"), "left").join(b, (F.col("bare") == F.col("k_bare_file")) & (F.col("bare") != ""), "left")
    exact = F.coalesce("alias_file", "name_file", "bare_alias", "bare_file")
    tried = t.where(exact.isNull()).select("key", "bare", F.explode(F.array("key", "bare")).alias("name")).where("name = key or name <> ''").distinct()
    near = resolve.fuzzy_match(tried.select("name"), logos.select(resolve.fingerprint(F.col("logo_name")).alias("other")), least)
    near = near.join(n, F.col("other") == F.col("k_name_file")).select("name", "other", F.col("name_file").alias("near_file"), "similarity")
    # Of the full and the stripped name, the one with the more similar logo counts.
    best = W.partitionBy("key", "bare").orderBy(F.desc("similarity"), "other")
    near = tried.join(near, "name").withColumn("nth", F.row_number().over(best)).where("nth = 1")
    near = near.select(F.col("key").alias("near_key"), F.col("bare").alias("near_bare"), "near_file", "similarity")
    out = t.join(near, (F.col("key") == F.col("near_key")) & (F.col("bare") == F.col("near_bare")), "left")
    confidence = F.when(F.col("alias_file").isNotNull() | F.col("name_file").isNotNull(), 1.0).when(exact.isNotNull(), 0.95).otherwise(F.round("similarity", 3))
    how = F.when(F.col("alias_file").isNotNull(), "alias").when(F.col("name_file").isNotNull(), "name").when(exact.isNotNull(), "stripped").when(F.col("near_file").isNotNull(), "similar").otherwise("none")
    return out.select("team_name", F.coalesce(exact, "near_file").alias("file"), confidence.alias("confidence"), how.alias("how"))


def search(query: str, logos: DataFrame, limit: int = 10, least: float = 0.4) -> DataFrame:
    """Logos whose name is similar to a query; of equal fingerprints the best stays."""
    spark = logos.sparkSession
    q = spark.range(1).select(resolve.fingerprint(F.lit(query)).alias("name"))
    pairs = q.crossJoin(logos.select(resolve.fingerprint(F.col("logo_name")).alias("other"), "logo_name", "file"))  # one row against all
    scored = pairs.mapInPandas(_ratios, "name string, other string, logo_name string, file string, similarity double").where(F.col("similarity") > least)
    best = W.partitionBy("other").orderBy(F.desc("similarity"), "file")
    return scored.withColumn("nth", F.row_number().over(best)).where("nth = 1").orderBy(F.desc("similarity"), "logo_name").select("logo_name", "file", "similarity").limit(limit)


def _ratios(batches):
    from difflib import SequenceMatcher

    for d in batches:
        yield d.assign(similarity=[SequenceMatcher(None, a, b).ratio() for a, b in zip(d["name"], d["other"], strict=True)])


def manifest(matches: DataFrame, remote: DataFrame) -> DataFrame:
    """Whether each team has a local logo, one of the league, both or none. remote: team_name, logo_url."""
    r = remote.groupBy("team_name").agg(F.max("logo_url").alias("logo_url"))
    m = matches.join(r, "team_name", "left")
    here, there = F.col("file").isNotNull(), F.coalesce(F.trim("logo_url"), F.lit("")) != ""
    return m.withColumn("found", F.when(here & there, "both").when(here, "local").when(there, "league").otherwise("none"))


def coverage(manifested: DataFrame) -> DataFrame:
    return manifested.groupBy("found").agg(F.count("*").alias("n"))


# Endings of logo files, and files of leagues.
IMAGES = ["svg", "png", "jpg", "jpeg", "webp"]
LEAGUES = ["BSHL", "EHF"]


def local_logos(files: DataFrame) -> DataFrame:
    """Logos of files by canonical name: canonical_name, display_name, local_file, is_league. files: file.

    Of files with one canonical name the last by name is the file; name and kind are the first's.
    """
    stem = F.regexp_extract("file", r"^(.*)\.([^.]*)$", 1)
    named = files.where(F.lower(F.regexp_extract("file", r"^(.*)\.([^.]*)$", 2)).isin(IMAGES))
    league = F.contains(F.lower(stem), F.lit("league")) | stem.isin(LEAGUES)
    rows = named.select(resolve.fingerprint(stem).alias("canonical_name"), resolve.title_case(F.translate(stem, "_-", "  ")).alias("display_name"), league.alias("is_league"), "file")
    return rows.groupBy("canonical_name").agg(F.min_by("display_name", "file").alias("display_name"), F.max("file").alias("local_file"), F.min_by("is_league", "file").alias("is_league"))


def _listed(teams: DataFrame) -> DataFrame:
    """Teams with an address of a logo, and the canonical name without suffixes."""
    bare = strip_words(F.col("team_name"))
    return teams.where("coalesce(logo_url, '') <> ''").select("team_name", "team_id", "logo_url", resolve.fingerprint(bare).alias("canonical_name"), bare.alias("display_name")).distinct()


def build(files: DataFrame, teams: DataFrame, manual: DataFrame, old: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Tables of logos and of aliases, merged from files, the league's teams, manual aliases and the tables before.

    files: file. teams: team_name, team_id, logo_url. manual: alias, file. A file of this build replaces an older one; an
    address stays once it is known, of new ones the least counts. Names come from where the logo was first seen:
    older tables, files, teams. Aliases: team_name, team_id, canonical_name, confidence, is_manual; a manual one needs a logo with its file.
    """
    none = lambda kind: F.lit(None).cast(kind)
    new = local_logos(files).select("canonical_name", "display_name", "local_file", none("string").alias("logo_url"), "is_league", F.lit(1).alias("from_"))
    listed = _listed(teams)
    new = new.unionByName(listed.groupBy("canonical_name").agg(F.min("display_name").alias("display_name"), F.min("logo_url").alias("logo_url")).select("canonical_name", "display_name", none("string").alias("local_file"), "logo_url", F.lit(False).alias("is_league"), F.lit(2).alias("from_")))
    if old is not None:
        new = new.unionByName(old[0].select("canonical_name", "display_name", "local_file", "logo_url", "is_league", F.lit(0).alias("from_")))
    # An older address comes first, an older file last.
    logos = new.groupBy("canonical_name").agg(
        F.min_by("display_name", "from_").alias("display_name"), F.max_by("local_file", F.when(F.col("local_file").isNotNull(), F.col("from_"))).alias("local_file"),
        F.min_by("logo_url", F.when(F.col("logo_url").isNotNull(), F.col("from_"))).alias("logo_url"), F.min_by("is_league", "from_").alias("is_league"),
    )
    here, there = F.col("local_file").isNotNull(), F.col("logo_url").isNotNull()
    logos = logos.withColumn("source", F.when(here & there, "both").when(here, "local").when(there, "league"))
    own = listed.select("team_name", "team_id", "canonical_name", F.lit(1.0).alias("confidence"), F.lit(False).alias("is_manual"), F.lit(1).alias("from_"))
    by_file = logos.where("local_file is not null").groupBy(F.col("local_file").alias("file")).agg(F.min("canonical_name").alias("canonical_name"))
    hand = manual.join(by_file, "file").select(F.col("alias").alias("team_name"), none(dict(teams.dtypes)["team_id"]).alias("team_id"), "canonical_name", F.lit(1.0).alias("confidence"), F.lit(True).alias("is_manual"), F.lit(0).alias("from_"))
    aliases = own.unionByName(hand)
    if old is not None:
        aliases = aliases.unionByName(old[1].select("team_name", "team_id", "canonical_name", "confidence", "is_manual", F.when(F.col("is_manual"), 2).otherwise(0).alias("from_")))
    # A team's alias follows its logo, a manual one stays as it was.
    last = F.struct("from_", "canonical_name")
    aliases = aliases.groupBy("team_name", "team_id", "is_manual").agg(F.max_by("canonical_name", last).alias("canonical_name"), F.max_by("confidence", last).alias("confidence"))
    return logos, aliases.select("team_name", "team_id", "canonical_name", "confidence", "is_manual")


def statistics(logos: DataFrame, aliases: DataFrame) -> DataFrame:
    """Coverage of the tables: counter, n."""
    a = logos.agg(F.count("*").alias("total_logos"), F.count("local_file").alias("with_local"), F.count("logo_url").alias("with_league"), F.count_if(F.col("source") == "both").alias("with_both"))
    b = aliases.agg(F.count("*").alias("total_aliases"), F.count_if("is_manual").alias("manual_overrides"))
    rows = lambda d: d.select(F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in d.columns])))
    return rows(a).unionByName(rows(b))


def lookup(names: DataFrame, logos: DataFrame, aliases: DataFrame, least: float = 0.8) -> DataFrame:
    """Logo of each name from the tables: team_name, team_id, local_file, logo_url, confidence, source, how.

    names: team_name, team_id (null: unknown). First the alias of name and id, or without an id the best alias of
    the name: manual before others, with a file before without, by confidence. Then the canonical name, .9. Only names
    that neither step knows go on to `match` over the files.
    """
    held = aliases.join(logos, "canonical_name").select("team_name", "team_id", "local_file", "logo_url", "confidence", "source", "is_manual", "canonical_name")
    best = F.struct("is_manual", F.col("local_file").isNotNull(), "confidence", F.col("canonical_name"))
    entry = F.struct("local_file", "logo_url", "confidence", "source")
    exact = held.groupBy("team_name", "team_id").agg(F.max_by(entry, best).alias("hit_id")).where("team_id is not null")
    any_ = held.groupBy("team_name").agg(F.max_by(entry, best).alias("hit_name"))
    known = logos.select(F.col("canonical_name").alias("key_"), F.struct("local_file", "logo_url", F.lit(0.9).alias("confidence"), "source").alias("hit_key"))
    asked = names.select("team_name", "team_id").distinct().withColumn("key_", resolve.fingerprint(strip_words(F.col("team_name"))))
    found = asked.join(exact, ["team_name", "team_id"], "left").join(any_, "team_name", "left").join(known, "key_", "left")
    alias = F.when(F.col("team_id").isNull(), F.col("hit_name")).otherwise(F.col("hit_id"))
    found = found.select("team_name", "team_id", F.coalesce(alias, "hit_key").alias("hit"), F.when(alias.isNotNull(), "alias").when(F.col("hit_key").isNotNull(), "canonical").alias("how"))
    done = found.where("hit is not null").select("team_name", "team_id", "hit.*", "how")
    rest = found.where("hit is null").select("team_name", "team_id")
    files = logos.where("local_file is not null").select(F.regexp_extract("local_file", r"^(.*)\.[^.]*$", 1).alias("logo_name"), F.col("local_file").alias("file"))
    # Manual aliases have been tried as they are written; by fingerprint they count again.
    hand = aliases.where("is_manual").join(logos, "canonical_name").select(F.col("team_name").alias("alias"), F.col("local_file").alias("file"))
    late = match(rest, files, hand, least).select(F.col("team_name").alias("late_"), "file", "confidence", "how")
    late = rest.join(late, F.col("team_name") == F.col("late_")).select("team_name", "team_id", F.col("file").alias("local_file"), F.lit(None).cast("string").alias("logo_url"), F.col("confidence").cast("double").alias("confidence"), F.when(F.col("file").isNotNull(), "local").otherwise("none").alias("source"), "how")
    return done.unionByName(late)


def picture(name: Column, holds: dict[str, str], patterns: dict[str, str]) -> Column:
    """The picture that a page shows for a team: the first key that the name holds in lower case, else the first pattern that it matches in any case, else none."""
    out = F
    for key, file in holds.items():
        out = out.when(F.contains(F.lower(name), F.lit(key)), file)
    for pattern, file in patterns.items():
        out = out.when(F.rlike(name, F.lit(f"(?i){pattern}")), file)
    return out.otherwise(F.lit(None))
