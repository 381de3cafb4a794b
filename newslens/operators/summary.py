"""Summaries and ordered metadata of clusters.

Articles come with a position in their cluster; every ordered result is built
from (position, value) structs that are sorted, never from arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import falsy_coalesce
from .ranks import numbered

DOMAINS, URLS, IMAGES = 10, 50, 20
ARTICLES, PER_ARTICLE, SENTENCES, MIN_CHARS, TITLES = 10, 2, 5, 30, 5


def positions(members: DataFrame, keys: list[str], score: str = "similarity", ident: str = "feed_entry_id") -> DataFrame:
    """members with pos: 1, 2, ... by similarity, then id, which has to be unique in a cluster.

    Only keys, similarity and id are ranked, in ranges, so a cluster with most of
    the articles is no single task, and articles themselves move once.
    """
    placed = numbered(members.select(*keys, score, ident), [F.desc(score), F.asc(ident)], "pos", keys)
    return members.join(placed.select(*keys, ident, F.col("pos").cast("int").alias("pos")), [*keys, ident])


def lead_sentences(text: Column, most: int = PER_ARTICLE) -> Column:
    """The first sentences of a text that are longer than MIN_CHARS."""
    parts = F.transform(F.slice(F.split(F.trim(text), r"(?<=[.!?])\s+"), 1, most), lambda x: F.trim(x))
    return F.filter(parts, lambda x: F.length(x) > MIN_CHARS)


def distinct_in_order(values: Column) -> Column:
    """Values of an array without later repeats."""
    return F.array_distinct(values)


def first_seen(rows: DataFrame, value: str, order: str) -> DataFrame:
    """(value, first): the distinct values of a column with the place of their first row; the order is that of ``first``."""
    return rows.groupBy(value).agg(F.min(order).alias("first"))


def extractive_summaries(articles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, summary): the first SENTENCES distinct lead sentences of the first ARTICLES articles, else the first titles."""
    top = articles.where(F.col("pos") <= ARTICLES).withColumn("lead", lead_sentences(falsy_coalesce(F.col("content"), F.col("description"))))
    title = falsy_coalesce(*[F.col(x) for x in ("title_en", "title") if x in articles.columns])
    rows = top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "lead", title.alias("title")))).alias("a"))
    sentences = F.slice(distinct_in_order(F.flatten(F.transform("a", lambda x: x["lead"]))), 1, SENTENCES)
    titles = F.filter(F.transform(F.slice("a", 1, TITLES), lambda x: x["title"]), lambda x: x != "")
    return rows.select(*keys, F.when(F.size(sentences) > 0, F.array_join(sentences, " ")).otherwise(F.array_join(titles, " ")).alias("summary"))


def top_domains(articles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, top_domains): domains by count, ties by first appearance."""
    counted = articles.where("domain is not null and domain <> ''").groupBy(*keys, "domain").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    listed = counted.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "first", "domain"))).alias("d"))
    return listed.select(*keys, F.transform(F.slice("d", 1, DOMAINS), lambda x: x["domain"]).alias("top_domains"))


def languages(articles: DataFrame, keys: list[str]) -> DataFrame:
    return articles.groupBy(*keys).agg(F.array_sort(F.collect_set(F.nullif("language", F.lit("")))).alias("languages"))


def urls(articles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, urls): the first URLS urls in order, repeats kept; only those are collected."""
    given = articles.where(F.col("url").isNotNull() & (F.col("url") != "")).select(*keys, "pos", "url")
    order = Window.partitionBy(*keys).orderBy("pos", "url")
    first = given.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= URLS)
    rows = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_n", "url"))).alias("u"))
    return rows.select(*keys, F.transform("u", lambda x: x["url"]).alias("urls"))


def images(articles: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, images): article by article its ``image``, repeated or not, then those of ``images`` not seen so far; the first IMAGES.

    Only those are collected: an image of the list counts at its first place
    among all, which a map-side combined minimum finds.
    """
    listed = F.filter(F.coalesce("images", F.array().cast("array<string>")), lambda i: i.isNotNull() & (i != ""))
    own = F.when(F.coalesce("image", F.lit("")) != "", F.array("image")).otherwise(F.array().cast("array<string>"))
    each = articles.select(*keys, "pos", F.posexplode(F.concat(F.transform(own, lambda x: F.struct(F.lit(True).alias("own"), x.alias("image"))), F.transform(listed, lambda x: F.struct(F.lit(False).alias("own"), x.alias("image"))))).alias("at", "i"))
    each = each.select(*keys, "pos", "at", "i.own", "i.image")
    place = F.struct("pos", "at")
    seen = each.groupBy(*keys, "image").agg(F.min(F.struct(place.alias("place"), "own")).alias("f"))
    # the first place of a listed image, unless it was an article's own before; own ones always
    kept = each.where("own").select(*keys, place.alias("place"), "image").unionByName(seen.where("not f.own").select(*keys, F.col("f.place").alias("place"), "image"))
    first = kept.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("place", "image"))).where(F.col("_n") <= IMAGES)
    rows = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_n", "image"))).alias("a")).select(*keys, F.transform("a", lambda x: x["image"]).alias("images"))
    return articles.select(*keys).distinct().join(rows, keys, "left").withColumn("images", F.coalesce("images", F.array().cast("array<string>")))


def news_clusters(articles: DataFrame, keys: list[str]) -> DataFrame:
    """One output row per cluster: summary, article_count, top_domains, languages, urls and, if there are any, images."""
    out = articles.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("article_count"))
    parts = [extractive_summaries(articles, keys), top_domains(articles, keys), languages(articles, keys), urls(articles, keys)]
    if "image" in articles.columns:
        parts.append(images(articles, keys))
    for part in parts:
        out = out.join(part, keys, "left")
    lists = [x for x in ("top_domains", "languages", "urls", "images") if x in out.columns]
    return out.withColumns({x: F.coalesce(x, F.array().cast("array<string>")) for x in lists})
