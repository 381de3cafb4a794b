"""Value sets and row types of the news data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The states that rows move through.
RUN_STATUSES = ("pending", "running", "completed", "failed", "partial")
JOB_STATUSES = ("queued", "fetching", "extracted", "deduped", "embedded", "clustered", "summarized", "scored", "failed", "skipped_duplicate")
FAILURE_REASONS = ("blocked", "consent", "paywall", "js_required", "no_text", "timeout", "http_error", "unknown")
TIERS = ("A", "B", "C")
#: Statuses after which an entry needs no further run.
TERMINAL = ("summarized", "scored")
#: Statuses from extraction to embedding.
READY = ("extracted", "deduped", "embedded")

NEWS_CLUSTER = T.StructType(
    [
        T.StructField("flashpoint_id", T.StringType()),
        T.StructField("cluster_id", T.IntegerType()),
        T.StructField("summary", T.StringType()),
        T.StructField("article_count", T.IntegerType()),
        T.StructField("top_domains", T.ArrayType(T.StringType())),
        T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("urls", T.ArrayType(T.StringType())),
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField("created_at", T.TimestampType()),
    ]
)

BATCH_RESULT = "custom_id string, response struct<status_code int, body struct<choices array<struct<message struct<content string>>>>>, error struct<message string>"


def tier_has_embeddings(tier: str) -> bool:
    """Tiers B and C embed and cluster."""
    return tier in ("B", "C")


def tier_has_llm(tier: str) -> bool:
    """Tier C summarises by language model."""
    return tier == "C"
