"""JSON-lines files of a batch language-model service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_budget
from ..schema import BATCH_RESULT


def requests(clusters: DataFrame, model: str, system: str = "system", prompt: str = "prompt") -> DataFrame:
    """One JSON request per cluster (flashpoint_id, cluster_id and the two message texts)."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(message("system", system), message("user", prompt)).alias("messages"),
        token_budget(F.length(system) + F.length(prompt)).alias("max_tokens"),
        F.lit(0).alias("temperature"),
    )
    ident = F.concat(F.lit("cluster_"), F.col("flashpoint_id").cast("string"), F.lit("_"), F.col("cluster_id").cast("string"))
    line = F.to_json(F.struct(ident.alias("custom_id"), F.lit("POST").alias("method"), F.lit("/v1/chat/completions").alias("url"), body.alias("body")))
    return clusters.select(ident.alias("custom_id"), line.alias("value"))


def write(lines: DataFrame, path: str) -> None:
    lines.select("value").write.mode("overwrite").text(path)


def results(lines: DataFrame, line: Column | str = "value") -> DataFrame:
    """(custom_id, content): the trimmed first choice of each result line; lines without choices are left out."""
    parsed = lines.select(F.from_json(line, BATCH_RESULT).alias("r"))
    choice = F.get(F.col("r.response.body.choices"), 0)
    return parsed.where(F.size(F.coalesce(F.col("r.response.body.choices"), F.array())) > 0).select(F.col("r.custom_id").alias("custom_id"), F.trim(choice["message"]["content"]).alias("content"))
