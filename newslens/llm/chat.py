"""Chat formatting of reply trees, with DataFrame functions only.

Messages form trees: each has a parent, or starts its conversation. Self-joins
that double the distance at each step list the messages on every path from root
to leaf, so a path of n messages takes log2(n) of them. Paths are ranked by
score within their conversation, and each chosen path becomes one text with a
loss mask over the assistant's words.

The template marks a turn as ``<|turn|>role<|text|>words<|end|>`` and a line
feed. Control strings inside roles and texts are broken by a backslash after
their first character and backslashes are doubled, so ``unescape`` gives back
exactly what went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stash, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: The role whose words are learnt.
LEARNT = "assistant"
#: What starts a control string, and what must follow: this template's own and other common ones.
_ANGLE, _SQUARE = r"<(?=\||/?s>)", r"\[(?=/?INST\])"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, _ANGLE, r"<\\"), _SQUARE, r"[\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def path_members(messages: DataFrame) -> DataFrame:
    """(conv, leaf, node, back): every message of every root-to-leaf path; back counts from the leaf, at 0.

    messages: conv, node (unique in conv) and parent. A parent that isn't in the
    conversation makes a root. Messages that only lie on cycles, or lead into
    one, are on no path from a root and are left out.
    """
    nodes = messages.select("conv", "node", "parent")
    known = nodes.select("conv", F.col("node").alias("parent"))
    up = stash(nodes.where("parent is not null").join(known, ["conv", "parent"]).select("conv", "node", F.col("parent").alias("far")), "up")
    parents = up.select("conv", F.col("far").alias("node")).distinct()
    leaves = nodes.join(parents, ["conv", "node"], "left_anti")
    found = stash(leaves.select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")), "paths")
    largest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    reach = 1
    while reach <= largest:
        more = found.join(up, ["conv", "node"]).select("conv", "leaf", F.col("far").alias("node"), (F.col("back") + reach).alias("back"))
        found = stash(found.unionByName(more), "paths")
        further = up.withColumnRenamed("far", "mid").join(up.select("conv", F.col("node").alias("mid"), "far"), ["conv", "mid"])
        up = stash(further.select("conv", "node", "far"), "up")
        reach *= 2
        if not up.limit(1).count():
            return found
    # whoever still has an ancestor after as many steps as there are messages runs in a circle
    return found.join(up.select("conv", F.col("node").alias("leaf")), ["conv", "leaf"], "left_anti")


def format_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One row for each chosen path: conv, leaf, rank, score, formatted, loss.

    messages: conv (string), node (long), parent (long), role, text, score.
    Paths are ranked by the sum of their scores, then the smaller leaf; the
    first ``branches`` of a conversation are chosen, all by default. ``loss``
    lists the learnt stretches: turn, start and end in code points of formatted.

    Defined results: null roles and texts are empty, null scores 0; an empty
    table gives no rows; equal messages with different nodes are both kept;
    further columns are ignored.
    """
    members = path_members(messages)
    scored = members.join(messages.select("conv", "node", F.coalesce("score", F.lit(0.0)).alias("score")), ["conv", "node"])
    paths = scored.groupBy("conv", "leaf").agg(F.sum("score").alias("path_score"), F.max("back").alias("depth"))
    paths = paths.withColumn("rank", F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("path_score"), "leaf")))
    if branches is not None:
        paths = paths.where(F.col("rank") <= branches)
    role, text = (F.coalesce(F.col(x), F.lit("")) for x in ("role", "text"))
    turns = members.join(paths, ["conv", "leaf"]).join(
        messages.select("conv", "node", (role == LEARNT).alias("learnt"), F.concat(F.lit(TURN), escape(role), F.lit(TEXT)).alias("head"), escape(text).alias("words")), ["conv", "node"]
    )
    turns = turns.withColumn("turn", F.col("depth") - F.col("back"))
    rendered = F.concat("head", "words", F.lit(END))
    before = Window.partitionBy("conv", "leaf").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length(rendered)).over(before), F.lit(0)) + F.length("head")
    placed = turns.select("conv", "leaf", "rank", "path_score", "turn", "learnt", rendered.alias("rendered"), start.alias("start"), (start + F.length("words")).alias("end"))
    grouped = placed.groupBy("conv", "leaf", "rank", "path_score").agg(F.array_sort(F.collect_list(F.struct("turn", "learnt", "start", "end", "rendered"))).alias("turns"))
    return grouped.select(
        "conv",
        "leaf",
        "rank",
        F.col("path_score").alias("score"),
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: F.struct(t["turn"].alias("turn"), t["start"].alias("start"), t["end"].alias("end"))).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns (role, text) and the learnt text of formatted rows, from ``formatted`` and ``loss`` alone."""
    parts = F.slice(F.split("formatted", r"<\|end\|>\n"), 1, F.size(F.split("formatted", r"<\|end\|>\n")) - 1)
    cut = formatted.withColumn("_parts", parts)
    begins = F.aggregate("_parts", F.array(F.lit(0).cast("long")), lambda acc, p: F.concat(acc, F.array((F.element_at(acc, -1) + F.length(p) + len(END)).cast("long"))))
    cut = cut.withColumn("_begins", begins)
    body = lambda p: F.substr(p, F.lit(len(TURN) + 1))
    turn = lambda p: F.struct(
        unescape(F.substring_index(body(p), TEXT, 1)).alias("role"),
        unescape(F.substr(body(p), F.locate(TEXT, body(p)) + len(TEXT))).alias("text"),
    )
    under = lambda s: unescape(F.substr(F.get(F.col("_parts"), s["turn"].cast("int")), (s["start"] - F.get(F.col("_begins"), s["turn"].cast("int")) + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return cut.select(*formatted.columns, F.transform("_parts", turn).alias("turns"), F.array_join(F.transform("loss", under), "").alias("learnt"))


def as_replies(conversations: DataFrame) -> DataFrame:
    """Conversations of plain turns as messages that each answer the one before, rows in the order of turn, role, text (nulls first).

    The key ``conv`` is the id as text after a letter, so that a null id is a conversation of its own.
    """
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("n"))
    order = Window.partitionBy("conv").orderBy(*[F.col(x).asc_nulls_first() for x in ("turn", "role", "text")])
    rows = conversations.select(conv.alias("conv"), "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


_EXTRA = r"""SELECT cast(-1 as bigint) AS conv_id, cast(turn as bigint) AS turn, role, '</s>[INST] ok [/INST]' AS text FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(turn, role)"""


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted, and what is read back from the output.

    Defined results: rows are in order of turn, role and text, nulls first; a
    null role or text is empty; equal rows are turns of their own; rows with a
    null conv_id are one conversation, whose conv_id is null; without
    conversations there is conversation -1 only; texts are formatted whole;
    further columns are ignored. A conversation is one row of the output, so its
    turns, and those only, meet in one task.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(spark.sql(_EXTRA))
    back = read_back(format_trees(stash(as_replies(rows), "replies"), branches=1))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.substr(F.col("conv"), F.lit(2)).try_cast("long").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ESC_SQL = r"regexp_replace(regexp_replace(replace({x}, '\', '\\'), '<(\||s>|/s>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')"
ORACLE_SQL = {
    "op6_chat_format": rf"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -1, turn, role, '</s>[INST] ok [/INST]', role, '' FROM (VALUES (0, 'user'), (1, 'assistant')) x(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length({_ESC_SQL.format(x="role")}) + length({_ESC_SQL.format(x="text")})) AS BIGINT) AS formatted_chars
FROM rows_ GROUP BY conv_id"""
}
