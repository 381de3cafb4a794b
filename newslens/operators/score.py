"""Hotspot scores of clusters and the alerts they raise."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import with_computed
from .ranks import numbered

# Weight of each top-level topic.
TOPIC_WEIGHTS = {
    "conflict, war and peace": 1.0,
    "disaster, accident and emergency incident": 0.9,
    "crime, law and justice": 0.8,
    "politics": 0.7,
    "society": 0.6,
    "health": 0.6,
    "environmental issue": 0.5,
    "economy, business and finance": 0.5,
    "human interest": 0.4,
    "education": 0.3,
    "religion": 0.3,
    "science and technology": 0.3,
    "labour": 0.3,
    "arts, culture, entertainment and media": 0.2,
    "lifestyle and leisure": 0.2,
    "sport": 0.1,
    "weather": 0.3,
}
OTHER_TOPIC = 0.3
UNCLASSIFIED = "unclassified"
HALF_LIFE_HOURS = 12.0
MAX_ARTICLES, MAX_DOMAINS = 100, 20
TOP_SHARE = 0.10


def topic_weight(topic: Column) -> Column:
    """The topic's weight, in any case; OTHER_TOPIC for unknown and missing ones."""
    held = F.create_map(*[F.lit(x) for pair in TOPIC_WEIGHTS.items() for x in pair])
    return F.coalesce(F.try_element_at(held, F.lower(F.coalesce(topic, F.lit("")))), F.lit(OTHER_TOPIC))


def primary_topics(topics: DataFrame, members: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, topic): the most frequent topic of a cluster's members, ties to the first by name."""
    counted = members.select(*keys, "feed_entry_id").join(topics, "feed_entry_id").groupBy(*keys, "topic").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("o"), "topic")).alias("m")).select(*keys, F.col("m.topic").alias("topic"))


def components(articles: Column, domains: Column, recency: Column, topic: Column, as_of: Column) -> dict[str, Column]:
    """The four parts of the score, unrounded: volume, recency (half-life 12 hours, 0 if unknown), diversity, topic_weight."""
    hours = (F.unix_timestamp(as_of) - F.unix_timestamp(recency)) / 3600.0
    return {
        "volume": F.least(F.log2(articles + 1.0) / F.log2(F.lit(MAX_ARTICLES + 1.0)), F.lit(1.0)),
        "recency": F.when(recency.isNull(), 0.0).otherwise(F.exp(-0.693 * hours / HALF_LIFE_HOURS)),
        "diversity": F.least(F.log2(domains + 1.0) / F.log2(F.lit(float(MAX_DOMAINS))), F.lit(1.0)),
        "topic_weight": topic_weight(topic),
    }


def score(clusters: DataFrame, as_of: Column) -> DataFrame:
    """clusters (article_count, unique_domains, max_recency, topic) with the parts and the score, to 4 places."""
    parts = components(F.col("article_count"), F.col("unique_domains"), F.col("max_recency"), F.col("topic"), as_of)
    total = 0.30 * parts["volume"] + 0.25 * parts["recency"] + 0.25 * parts["diversity"] + 0.20 * parts["topic_weight"]
    return clusters.select("*", *[F.round(c, 4).alias(k) for k, c in parts.items()], F.round(total, 4).alias("score"))


def top_hotspots(scored: DataFrame, share: float = TOP_SHARE) -> DataFrame:
    """scored with hot_rank and is_hotspot: the first tenth of all clusters together, at least one; ties by flashpoint and cluster. Other clusters have no rank."""
    most = max(1, int(scored.count() * share))
    ranked = numbered(scored, [F.desc("score"), F.asc("flashpoint_id"), F.asc("cluster_id")], "_rank")
    hot = F.when(F.col("_rank") <= most, F.col("_rank"))
    return ranked.select(*scored.columns, hot.alias("hot_rank"), hot.isNotNull().alias("is_hotspot"))


def webhook_payload() -> Column:
    """The JSON that a hotspot sends to a webhook."""
    fields = ("flashpoint_id", "flashpoint_title", "cluster_id", "summary", "article_count", "hotspot_score", "top_domains")
    return F.to_json(F.struct(F.lit("hotspot_alert").alias("type"), *fields))


def slack_payload() -> Column:
    """The JSON blocks that a hotspot sends to a Slack channel; the summary is cut to 500 characters."""
    mark = lambda text: F.struct(F.lit("mrkdwn").alias("type"), text.alias("text"))
    header = F.to_json(F.struct(F.lit("header").alias("type"), F.struct(F.lit("plain_text").alias("type"), F.concat(F.lit("🔥 Hotspot Alert: "), F.col("flashpoint_title")).alias("text")).alias("text")))
    fields = F.array(
        mark(F.concat(F.lit("*Score:* "), F.format_string("%.2f", F.col("hotspot_score")))),
        mark(F.concat(F.lit("*Articles:* "), F.col("article_count").cast("string"))),
        mark(F.concat(F.lit("*Cluster:* #"), F.col("cluster_id").cast("string"))),
    )
    section = F.to_json(F.struct(F.lit("section").alias("type"), fields.alias("fields")))
    words = F.to_json(F.struct(F.lit("section").alias("type"), mark(F.concat(F.lit("*Summary:*\n"), F.substring("summary", 1, 500))).alias("text")))
    return F.concat(F.lit('{"blocks":['), F.concat_ws(",", header, section, words), F.lit("]}"))


def email_message() -> Column:
    """What a hotspot says in an e-mail: a subject, an empty line, and the facts, a line each."""
    lines = (
        F.concat(F.lit("Subject: Hotspot: "), F.coalesce("flashpoint_title", F.lit(""))),
        F.lit(""),
        F.concat(F.lit("Cluster: "), F.col("cluster_id").cast("string")),
        F.concat(F.lit("Articles: "), F.col("article_count").cast("string")),
        F.concat(F.lit("Score: "), F.format_string("%.2f", F.col("hotspot_score"))),
        F.coalesce("summary", F.lit("")),
    )
    return F.concat_ws("\n", *lines)


def log_only(payload: str) -> bool:
    """A send function for deliver that writes the payload to the executor's log: e-mails go no further."""
    logging.getLogger(__name__).info("alert: %s", payload)
    return True


def deliver(payloads: DataFrame, send, column: str = "payload") -> DataFrame:
    """payloads with ``sent``: what send(text) says on the executors, False where it raises OSError."""

    def tried(texts: list) -> list[list[bool]]:
        sent = []
        for text in texts:
            try:
                sent.append(bool(send(text)))
            except OSError:
                sent.append(False)
        return [sent]

    return with_computed(payloads, column, tried, T.StructType([T.StructField("sent", T.BooleanType())]))
