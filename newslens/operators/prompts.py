"""Prompts for cluster summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.responses import articles_toml
from ..functions.text import falsy_coalesce
from .models import ModelRegistry

ARTICLES = 15
SYSTEM = (
    "You are a news analyst. Summarise the articles below, which cover one event, in English and in six to seven factual sentences. "
    "Say who, what, where, when and why, and use all languages present. The input is TOML, a table array named articles. "
    'Answer with JSON only: {"summary": "..."}'
)


def build_prompts(articles: DataFrame, keys: list[str], registry: ModelRegistry | None = None) -> DataFrame:
    """(keys, system, prompt): the first ARTICLES articles of each cluster, shortened, as TOML."""
    registry = registry or ModelRegistry()
    title = falsy_coalesce(*[F.col(x) for x in ("title_en", "title") if x in articles.columns])
    top = articles.where(F.col("pos") <= ARTICLES).select(
        *keys,
        F.struct(
            F.col("pos").alias("id"),
            F.coalesce("language", F.lit("unknown")).alias("lang"),
            F.when(title == "", "Untitled").otherwise(title).alias("title"),
            registry.apply("presummary", falsy_coalesce(F.col("content"), F.col("description"))).alias("content"),
        ).alias("a"),
    )
    listed = top.groupBy(*keys).agg(F.to_json(F.array_sort(F.collect_list("a"))).alias("j"))
    return listed.select(*keys, F.lit(SYSTEM).alias("system"), articles_toml("j").alias("prompt"))
