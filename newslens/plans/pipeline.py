"""The news run of a day: select, read pages, clean, dedupe, enrich, embed, cluster, summarise, score, write."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import extract_articles
from ..functions.responses import llm_summary
from ..functions.text import embedding_text, hostname, language_resolve, sanitize, title_en
from ..operators import calls, clusters, dedupe, entities, jobs, mentions, prompts, score, summary
from ..operators.models import ModelRegistry
from ..runtime import stash
from ..schema import TIERS, tier_has_embeddings, tier_has_llm
from ..sources import catalog, timings

KEYS = ["flashpoint_id", "cluster_id"]
JOBS = "feed_entry_id long, status string, is_duplicate boolean, duplicate_of long, failure_reason string, run_id string"


@dataclass(frozen=True)
class Result:
    """What a run gives: job states, clusters (None below tier B) and their scores, and what it found in the articles."""

    jobs: DataFrame
    news_clusters: DataFrame | None
    scored: DataFrame | None
    entities: DataFrame | None = None
    countries: DataFrame | None = None
    topics: DataFrame | None = None


def read_pages(chosen: DataFrame, pages: DataFrame | None) -> DataFrame:
    """chosen entries with ``text`` and failure_reason: what they hold, or else the article of the page at their url, or else their description.

    pages has url and html; an entry whose page gives no article, and that has
    no description, has failed.
    """
    held = F.when(F.trim("content") != "", F.col("content"))
    if pages is None:
        text = sanitize(F.coalesce(held, "description", F.lit("")))
        return chosen.withColumns({"text": text, "failure_reason": F.when(F.trim(text) == "", "no_text")})
    wanted = chosen.where(held.isNull() & F.col("url").isNotNull()).select("url").distinct()
    read = extract_articles(pages.where("url is not null").select("url", "html").join(wanted, "url", "left_semi").groupBy("url").agg(F.min("html").alias("html")))
    found = read.select(F.col("url").alias("_url"), F.col("extracted_text").alias("_read"), F.col("failure_reason").alias("_reason"))
    text = sanitize(F.coalesce(held, "_read", "description", F.lit("")))
    return chosen.join(found, F.col("url") == F.col("_url"), "left").withColumns({"text": text, "failure_reason": F.when(F.trim(text) == "", F.coalesce("_reason", F.lit("no_text")))}).drop("_url", "_read", "_reason")


def enrich(live: DataFrame, registry: ModelRegistry, names: DataFrame | None) -> tuple[DataFrame | None, DataFrame | None, DataFrame]:
    """Entities, countries and topics of live entries (id, text, sourcecountry): by the registry's models, and the names of a gazetteer in the texts.

    names has name and entity_group; without names and an entity model there
    are no entities, and countries are those of the sources.
    """
    told = live.select(F.col("id").alias("feed_entry_id"), "text", "sourcecountry")
    raw = told.select("feed_entry_id", F.inline(registry.apply("entities", F.col("text")))) if registry.held["entities"][0] else None
    if names is not None:
        mentioned = mentions.as_entities(mentions.find_mentions(told, names, key="feed_entry_id"), names, key="feed_entry_id")
        raw = mentioned if raw is None else raw.select("feed_entry_id", "entity_group", "word", "score").unionByName(mentioned)
    merged = None if raw is None else stash(entities.merge_entities(raw), "entities")
    places = told.limit(0).selectExpr("feed_entry_id", "text AS word", "cast(0 as double) AS score") if raw is None else raw.where("entity_group = 'LOC'").select("feed_entry_id", "word", "score")
    countries = entities.geo_aggregate(places, told.select("feed_entry_id", "sourcecountry"), entities.countries(live.sparkSession))
    topics = told.select("feed_entry_id", registry.apply("topics", F.col("text")).alias("t")).select("feed_entry_id", F.col("t.topic").alias("topic"), F.col("t.code").alias("code"), F.col("t.confidence").alias("confidence"))
    return merged, stash(countries, "countries"), stash(topics, "topics")


def summarise(news: DataFrame, members: DataFrame, registry: ModelRegistry, **limits) -> DataFrame:
    """news with the summaries of a language model, as far as it gives any, in place of the extracts; summary_method says which."""
    asked = news.drop("summary_method").join(prompts.build_prompts(members, KEYS, registry), KEYS, "left").withColumnRenamed("summary", "extractive")
    answered = calls.summarised(asked, registry, **limits)
    read = F.when(F.col("summary_method") == "extractive", F.col("extractive")).otherwise(F.coalesce(F.nullif(llm_summary("summary"), F.lit("")), "extractive"))
    return answered.withColumn("summary", read).drop("extractive", "system", "prompt", "attempts")


def run(
    entries: DataFrame,
    held_jobs: DataFrame,
    run_id: str,
    tier: str,
    as_of: str,
    registry: ModelRegistry | None = None,
    threshold: float = clusters.THRESHOLD,
    limit: int = 20_000,
    pages: DataFrame | None = None,
    names: DataFrame | None = None,
    spent: timings.Timings | None = None,
    **limits,
) -> Result:
    """One run over a day's entries (with id, seq, flashpoint_id, title, content, description, url, domain, language, sourcecountry, and published_at if known).

    Tier A reads and dedupes; B also finds clusters, entities, countries and
    topics, with extracts as summaries; C has summaries by the registry's model
    where it answers (``limits`` as in calls.summarised). Each stage is written
    and timed in ``spent``.

    A run with the same id after an interruption selects nothing that it has
    taken before, and results don't depend on the clock but on as_of.
    """
    if tier not in TIERS:
        raise ValueError(f"tier {tier}")
    registry, spent = registry or ModelRegistry(), spent or timings.Timings()
    now = F.lit(as_of).cast("timestamp")
    with spent.stage("select"):
        chosen = stash(jobs.unprocessed(entries, held_jobs, run_id, limit).select("id", "has_content").join(entries, "id"), "chosen")
    with spent.stage("read"):
        read = read_pages(chosen, pages)
        language = language_resolve(F.col("language"), F.col("text"), registry.apply("language", F.col("text")))
        read = read.withColumn("language", language).withColumn("title_en", title_en(F.col("title"), F.col("language"), registry.apply("translation", F.col("title")))).withColumn("hostname", hostname(F.col("url")))
        body = stash(read, "read")
    with spent.stage("dedupe"):
        assigned = stash(dedupe.assign(body.where("failure_reason is null"), "text"), "assigned")
    status = F.when(F.col("kind") != "leader", "skipped_duplicate").otherwise("embedded" if tier_has_embeddings(tier) else "extracted")
    done = assigned.select(F.col("id").alias("feed_entry_id"), F.lit(run_id).alias("run_id"), status.alias("status"), (F.col("kind") != "leader").alias("is_duplicate"), "duplicate_of", F.lit(None).cast("string").alias("failure_reason"))
    failed = body.where("failure_reason is not null").select(F.col("id").alias("feed_entry_id"), F.lit(run_id).alias("run_id"), F.lit("failed").alias("status"), F.lit(False).alias("is_duplicate"), F.lit(None).cast(done.schema["duplicate_of"].dataType).alias("duplicate_of"), "failure_reason")
    out = done.unionByName(failed)
    if not tier_has_embeddings(tier):
        return Result(out, None, None)
    with spent.stage("enrich"):
        live = stash(body.join(assigned.where("kind = 'leader'").select("id"), "id", "left_semi"), "live")
        found, places, topics = enrich(live if "sourcecountry" in live.columns else live.withColumn("sourcecountry", F.lit(None).cast("string")), registry, names)
    with spent.stage("embed"):
        vectors = live.select("flashpoint_id", F.col("id").alias("feed_entry_id"), registry.apply("embedding", embedding_text(F.col("title"), F.col("text"))).alias("embedding"))
        vectors = stash(vectors, "vectors")
    with spent.stage("cluster"):
        grouped = clusters.with_similarity(clusters.cluster(vectors, threshold=threshold), vectors)
        members = summary.positions(grouped.join(live.withColumnRenamed("id", "feed_entry_id").drop("flashpoint_id", "content").withColumnRenamed("text", "content"), "feed_entry_id"), KEYS)
        members = stash(members, "members")
    with spent.stage("summarise"):
        news = summary.news_clusters(members, KEYS).withColumn("summary_method", F.lit("extractive"))
        news = stash(summarise(news, members, registry, **limits) if tier_has_llm(tier) else news, "news")
    with spent.stage("score"):
        published = F.max(F.col("published_at").cast("timestamp")) if "published_at" in members.columns else F.lit(None).cast("timestamp")
        newest = members.groupBy(*KEYS).agg(F.coalesce(published, now).alias("max_recency"))
        main = score.primary_topics(topics.select("feed_entry_id", "topic"), members, KEYS)
        base = news.select(*KEYS, "article_count", F.size("top_domains").alias("unique_domains")).join(newest, KEYS).join(main, KEYS, "left")
        rated = score.score(base.withColumn("topic", F.coalesce("topic", F.lit(score.UNCLASSIFIED))), now)
        rated = stash(score.top_hotspots(rated), "scored")
    if tier_has_llm(tier):
        out = out.withColumn("status", F.when(F.col("status") == "embedded", "summarized").otherwise(F.col("status")))
    return Result(out, news, rated, found, places, topics)


def run_day(spark: SparkSession, root: str, run_id: str, tier: str, as_of: str, day: str | None = None, **options) -> Result:
    """run over the tables under ``root`` (the newest day by default), its results written there; options are those of run.

    The day's partition of news_clusters is replaced; jobs, topics, entities,
    countries and scores are those of the run in a partition of their own. A run
    that was interrupted has written nothing, and one that is repeated finds no
    entries and changes nothing; entries that come later need a run of another
    id. The seconds of each stage are added to timings.
    """
    tables = catalog.resolve(spark, root, day)
    catalog.ensure_output(spark, root, date.fromisoformat(tables.day) if tables.day[:4].isdigit() and "-" in tables.day else None)
    kept = f"{root}/feed_entry_jobs"
    held = spark.read.schema(JOBS).parquet(kept) if catalog.table_exists(spark, kept) else spark.createDataFrame([], JOBS)
    spent = options.pop("spent", None) or timings.Timings()
    result = run(tables.entries, held, run_id, tier, as_of, spent=spent, **options)
    with spent.stage("write"):
        own = stash(result.jobs, "jobs")
        before = held.where(F.col("run_id") == run_id).select(*own.columns)
        catalog.write_partitions(stash(before.unionByName(own), "jobs"), kept, ["run_id"])
        if result.news_clusters is not None:
            kinds = {f.name: f.dataType for f in spark.read.parquet(tables.clusters_path).schema}
            given = {"created_at": F.lit(as_of).cast("timestamp"), "dt": F.lit(tables.day).cast("date"), "images": F.array().cast("array<string>")}
            rows = result.news_clusters.select(*[(F.col(x) if x in result.news_clusters.columns else given[x]).cast(kind).alias(x) for x, kind in kinds.items()])
            catalog.write_partitions(rows, tables.clusters_path, ["dt"])
            for name in ("entities", "countries", "topics", "scored"):
                if (part := getattr(result, name)) is not None:
                    catalog.write_partitions(part.withColumn("run_id", F.lit(run_id)), f"{root}/{name}", ["run_id"])
    timings.append(spent.rows(spark, run_id, tables.day, tier, own.count()), f"{root}/timings")
    return replace(result, jobs=own)
