"""Named entities and countries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_CATEGORY = 20
SOURCE_SCORE = 0.5
#: Letters from which a name may differ from a country's by one edit.
FUZZY = 6

# Model labels and the categories they stand for.
LABELS = {"PER": "PERSON", "ORG": "ORG", "LOC": "LOC", "DATE": "DATE", "MISC": "EVENT"}
CATEGORIES = ("GPE", "LAW", "LOC", "ORG", "DATE", "NORP", "EVENT", "MONEY", "PERSON", "QUANTITY")
TITLED = ("PERSON", "GPE", "LOC")

# Names that mean a country: its name, alpha-2 and alpha-3 code.
COUNTRY_NAMES = {
    "usa": ("United States", "US", "USA"),
    "u.s.": ("United States", "US", "USA"),
    "u. s.": ("United States", "US", "USA"),
    "u.s.a.": ("United States", "US", "USA"),
    "united states of america": ("United States", "US", "USA"),
    "united states": ("United States", "US", "USA"),
    "america": ("United States", "US", "USA"),
    "uk": ("United Kingdom", "GB", "GBR"),
    "u.k.": ("United Kingdom", "GB", "GBR"),
    "britain": ("United Kingdom", "GB", "GBR"),
    "great britain": ("United Kingdom", "GB", "GBR"),
    "england": ("United Kingdom", "GB", "GBR"),
    "russia": ("Russia", "RU", "RUS"),
    "south korea": ("South Korea", "KR", "KOR"),
    "north korea": ("North Korea", "KP", "PRK"),
    "iran": ("Iran", "IR", "IRN"),
    "syria": ("Syria", "SY", "SYR"),
    "palestine": ("Palestine", "PS", "PSE"),
    "taiwan": ("Taiwan", "TW", "TWN"),
    "czech republic": ("Czechia", "CZ", "CZE"),
    "ivory coast": ("Côte d'Ivoire", "CI", "CIV"),
    "congo": ("Congo", "CG", "COG"),
    "dr congo": ("DR Congo", "CD", "COD"),
    "drc": ("DR Congo", "CD", "COD"),
    "uae": ("United Arab Emirates", "AE", "ARE"),
}


@F.pandas_udf(T.StringType())
def title_case(words: pd.Series) -> pd.Series:
    """Python's title case, which also begins anew after hyphens and apostrophes."""
    return words.map(lambda x: None if x is None else x.title())


def merge_entities(raw: DataFrame, key: str = "feed_entry_id") -> DataFrame:
    """(key, category, text, score): the best score of each entity of an article, at most PER_CATEGORY by score, then text.

    raw has entity_group, word and score. Unknown labels and words of fewer than
    two characters are dropped, word-piece marks removed, case ignored.
    """
    category = F.lit(None).cast("string")
    for label, name in reversed(LABELS.items()):
        category = F.when(F.col("entity_group") == label, name).otherwise(category)
    word = F.trim(F.replace("word", F.lit("##"), F.lit("")))
    clean = raw.select(key, category.alias("category"), F.lower(word).alias("low"), "score").where("category is not null and length(low) >= 2")
    best = clean.groupBy(key, "category", "low").agg(F.max("score").alias("score"))
    top = best.withColumn("rk", F.row_number().over(Window.partitionBy(key, "category").orderBy(F.desc("score"), "low"))).where(F.col("rk") <= PER_CATEGORY)
    return top.select(key, "category", F.when(F.col("category").isin(*TITLED), title_case("low")).otherwise(F.col("low")).alias("text"), "score")


def entity_meta(merged: DataFrame, key: str = "feed_entry_id") -> DataFrame:
    """(key, entities, score): the article's mean score, to 4 places."""
    return merged.groupBy(key).agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("score"), 4).alias("score"))


def as_document(merged: DataFrame, key: str = "feed_entry_id") -> DataFrame:
    """(key, entities): a map of all categories to arrays of (text, score), empty ones included."""
    rows = merged.groupBy(key, "category").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("o"), "text", "score"))).alias("l"))
    held = rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("category", F.transform("l", lambda x: F.struct(x["text"].alias("text"), x["score"].alias("score")))))).alias("m"))
    none = F.array().cast("array<struct<text:string,score:double>>")
    return held.select(key, F.map_from_arrays(F.array(*map(F.lit, CATEGORIES)), F.array(*[F.coalesce(F.col("m")[c], none) for c in CATEGORIES])).alias("entities"))


def gazetteer(spark: SparkSession) -> list[tuple[str, str, str, str]]:
    """(key, name, alpha2, alpha3) of every ISO 3166 country, as the Java runtime knows them: by English name and by both codes' own name in lower case."""
    locale = spark.sparkContext._jvm.java.util.Locale
    english, out = locale.ENGLISH, []
    for code in locale.getISOCountries():
        place = locale.Builder().setRegion(code).build()
        name = place.getDisplayCountry(english)
        out.append((name.lower(), name, code, place.getISO3Country()))
    return out


def country_rows() -> list[tuple[str, str, str, str]]:
    return [(key, *row) for key, row in COUNTRY_NAMES.items()]


def countries(spark: SparkSession, extra: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """The lookup of lower-case names: the fixed ones, then those of a gazetteer (the ISO countries by default) that they don't hold."""
    held = {x[0]: x for x in reversed(gazetteer(spark) if extra is None else extra)} | {x[0]: x for x in country_rows()}
    return spark.createDataFrame(sorted(held.values()), "key string, name string, alpha2 string, alpha3 string")


def _plain(name: Column) -> Column:
    """A name without accents (of the Latin letters that names of countries have), punctuation and a leading article, in lower case."""
    low = F.translate(F.lower(F.trim(name)), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿß’", "aaaaaaceeeeiiiinooooouuuuyys'")
    return F.regexp_replace(F.trim(F.regexp_replace(low, r"[^a-z0-9]+", " ")), r"^the ", "")


def resolve_countries(names: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """names with country, alpha2 and alpha3, null where the name is unknown.

    A name is looked up as it is, then without accents and punctuation, then, if
    it has FUZZY letters or more, by the one edit that is nearest among keys with
    the same start or the same end; ties go to the key that sorts first. Only
    distinct names that the lookup doesn't hold come so far, and they meet the
    keys of equal start or end only. The lookup is a gazetteer of some hundred
    names; only up to 10000 rows of it are broadcast.
    """
    key = F.lower(F.trim(F.col(column)))
    known = lookup.select(F.col("key").alias("_key"), F.struct("name", "alpha2", "alpha3").alias("_place"))
    bounded = lookup.limit(10_001).count() <= 10_000
    small = F.broadcast(known) if bounded else known
    held = names.join(small, key == F.col("_key"), "left").withColumn("_name", key).drop("_key")
    odd = held.where("_place is null and _name is not null and _name <> ''").select("_name").distinct().withColumn("_p", _plain(F.col("_name")))
    keys = known.withColumn("_q", _plain(F.col("_key")))
    same = odd.join(F.broadcast(keys) if bounded else keys, F.col("_p") == F.col("_q")).select("_name", F.struct(F.lit(0).alias("d"), F.col("_key").alias("k"), F.col("_place").alias("place")).alias("m"))
    ends = lambda c: F.explode(F.array(F.concat(F.lit("^"), F.substring(c, 1, 3)), F.concat(F.lit("$"), F.substring(c, -3, 3))))
    left = odd.where(F.length("_p") >= FUZZY).withColumn("_end", ends("_p"))
    right = keys.where(F.length("_q") >= FUZZY).withColumn("_end", ends("_q"))
    near = left.join(F.broadcast(right) if bounded else right, "_end").withColumn("d", F.levenshtein("_p", "_q", 1)).where("d between 0 and 1")
    near = near.select("_name", F.struct("d", F.col("_key").alias("k"), F.col("_place").alias("place")).alias("m"))
    found = same.unionByName(near).groupBy("_name").agg(F.min("m").alias("_m"))
    out = held.join(found, "_name", "left")
    place = F.coalesce("_place", F.col("_m.place"))
    return out.select(*names.columns, place["name"].alias("country"), place["alpha2"].alias("alpha2"), place["alpha3"].alias("alpha3"))


def geo_aggregate(mentions: DataFrame, sources: DataFrame, lookup: DataFrame, key: str = "feed_entry_id") -> DataFrame:
    """(key, name, alpha2, alpha3, count, avg_score): countries of an article's place names; its source country is added once if absent.

    mentions has word and score, sources has sourcecountry.
    """
    found = resolve_countries(mentions, "word", lookup).where("alpha3 is not null")
    own = found.groupBy(key, "alpha3").agg(F.min("country").alias("name"), F.min("alpha2").alias("alpha2"), F.count(F.lit(1)).alias("count"), F.round(F.avg("score"), 4).alias("avg_score"))
    source = resolve_countries(sources.select(key, "sourcecountry"), "sourcecountry", lookup).where("alpha3 is not null").join(own.select(key, "alpha3"), [key, "alpha3"], "left_anti")
    added = source.select(key, "alpha3", F.col("country").alias("name"), "alpha2", F.lit(1).cast("long").alias("count"), F.lit(SOURCE_SCORE).alias("avg_score"))
    return own.unionByName(added).select(key, "name", "alpha2", "alpha3", "count", "avg_score")


def softmax_top(logits: Column, k: int = 3) -> Column:
    """The k largest of an array of logits as (place, probability), by probability, then place."""
    # an array of one element names a value, so it is computed once for all places
    one = lambda value, use: F.get(F.transform(F.array(value), use), 0)
    row = lambda total: lambda x, i: F.struct((-x / total).alias("o"), i.alias("place"), F.round(x / total, 4).alias("p"))
    rows = lambda powers: one(F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x), lambda total: F.transform(powers, row(total)))
    ranked = lambda values: one(F.array_max(values), lambda top: F.array_sort(one(F.transform(values, lambda x: F.exp(x - top)), rows)))
    return F.transform(F.slice(one(logits, ranked), 1, k), lambda x: F.struct(x["place"].alias("place"), x["p"].alias("p")))
