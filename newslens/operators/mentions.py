"""Names in texts: a word trie as a table, walked by joins over the words of every text.

A trie holds an edge for every beginning of a name: the words so far, the next
word, and the name if it ends there. Each place of a text starts a walk; a walk
takes one join a word, and ends where no edge goes on. Of the names found the
leftmost and, where several begin, the longest counts; what it covers begins no
other. All of it is built-in functions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import stash

#: Edges of a trie up to which it is sent to every executor; a larger one is joined by a shuffle.
SENT_EDGES = 100_000
#: Parts that the walks are dealt to by a shuffle, for every word alike, so that a frequent first word is in none alone.
SALTS = 32
_WORDS = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    """The words of a text in lower case: runs of letters and digits; none for null."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORDS), F.lit(0))


def trie(names: DataFrame, name: str = "name") -> DataFrame:
    """(node, word, next, name): the edges of all names; the root is the empty string, and name is null where none ends.

    A name's words are those of texts; names without words are left out, and of
    names with the same words the first in order stands for all.
    """
    split = names.select(F.col(name).alias("name"), words_of(F.col(name)).alias("_w")).where(F.size("_w") > 0)
    steps = split.withColumn("_k", F.explode(F.sequence(F.lit(1), F.size("_w"))))
    at = lambda k: F.array_join(F.slice("_w", F.lit(1), k), " ")
    edges = steps.select(at(F.col("_k") - 1).alias("node"), F.element_at("_w", F.col("_k")).alias("word"), at(F.col("_k")).alias("next"), F.when(F.col("_k") == F.size("_w"), F.col("name")).alias("name"))
    return edges.groupBy("node", "word", "next").agg(F.min("name").alias("name"))


def _walks(docs: DataFrame, key: str, text: str, depth: int) -> DataFrame:
    """(key, check, place, ahead): for each word of each text its number, and it and the next depth - 1 words."""

    def ahead(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words)), lambda k: F.slice(words, k, F.lit(depth)))

    # over an array of one, so the words are taken apart once and not for each of them
    all_ahead = F.element_at(F.transform(F.array(words_of(F.col("_text"))), lambda w: F.when(F.size(w) > 0, ahead(w))), 1)
    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).select("_key", F.xxhash64("_text").alias("_check"), F.posexplode(all_ahead).alias("place", "_ahead"))


def _joined(walks: DataFrame, edges: DataFrame, how: str, sent: bool) -> DataFrame:
    if sent:
        return walks.join(F.broadcast(edges), ["_node", "_word"], how)
    salted = edges.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return walks.join(salted, ["_node", "_word", "_salt"], how)


def find_mentions(docs: DataFrame, names: DataFrame, key: str = "doc_id", text: str = "text", name: str = "name", sent_edges: int = SENT_EDGES) -> DataFrame:
    """(key, place, n_words, name): the names in every text, with the number of the first word (from 0) and how many there are.

    Matching is by whole words in lower case, whatever stands between them;
    leftmost first, of several there the longest, without overlaps.

    Defined results: null and empty texts, and names without words, give no
    rows; equal rows (of key and text) give their rows once, rows of one key and
    several texts those of each; null keys are kept; an empty table or no names
    give no rows; texts are read whole; further columns are ignored.
    """
    edges = stash(trie(names, name).withColumnsRenamed({"node": "_node", "word": "_word", "next": "_next", "name": "_name"}), "trie")
    n, depth = edges.agg(F.count(F.lit(1)), F.max(F.size(F.split("_next", " ")))).first()
    sent = n <= sent_edges
    walks = _walks(docs, key, text, max(1, depth or 1)).withColumn("_node", F.lit("")).withColumn("found", F.lit(None).cast("struct<n_words:int,name:string>"))
    if not sent:
        walks = walks.withColumn("_salt", F.pmod(F.xxhash64("_key", "place"), F.lit(SALTS)).cast("int"))
    for k in range(1, (depth or 0) + 1):
        # most walks end at their first word; the others go on and remember the last name that ended
        stepped = _joined(walks.withColumn("_word", F.get("_ahead", F.lit(k - 1))), edges, "inner" if k == 1 else "left", sent)
        ended = F.when(F.col("_name").isNotNull(), F.struct(F.lit(k).alias("n_words"), F.col("_name").alias("name"))).otherwise(F.col("found"))
        walks = stepped.withColumn("found", ended).withColumn("_node", F.col("_next")).drop("_word", "_next", "_name")
    each = walks.where("found is not null").select("_key", "_check", "place", "found.n_words", "found.name").distinct()
    return leftmost(each, ["_key", "_check"]).select(F.col("_key").alias(key), "place", "n_words", "name")


def leftmost(found: DataFrame, by: list[str]) -> DataFrame:
    """The rows (place, n_words, name), one for each place, that a walk from left to right takes, each from where the last one ended.

    Only rows that overlap are looked at together: a chain begins where nothing
    before reaches, and is folded from its first row on.
    """
    before = Window.partitionBy(*by).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.col("place") >= F.max(F.col("place") + F.col("n_words")).over(before), F.lit(True))
    chained = found.withColumn("_begins", begins).withColumn("_chain", F.sum(F.col("_begins").cast("int")).over(Window.partitionBy(*by).orderBy("place")))
    chains = chained.groupBy(*by, "_chain").agg(F.array_sort(F.collect_list(F.struct("place", "n_words", "name"))).alias("rows"))
    none = F.struct(F.lit(-1).alias("end"), F.expr("cast(array() as array<struct<place:int,n_words:int,name:string>>)").alias("taken"))

    def take(acc: Column, row: Column) -> Column:
        with_it = F.struct((row["place"] + row["n_words"]).alias("end"), F.array_append(acc["taken"], row).alias("taken"))
        return F.when(row["place"] >= acc["end"], with_it).otherwise(acc)

    taken = F.when(F.size("rows") == 1, F.col("rows")).otherwise(F.aggregate("rows", none, take)["taken"])
    return chains.select(*by, F.inline(taken))


def as_entities(mentions: DataFrame, names: DataFrame, key: str = "doc_id", name: str = "name", group: str = "entity_group", word: str = "name") -> DataFrame:
    """(key, entity_group, word, score) as an entity model gives them, from mentions and the names' groups.

    ``word`` may name another column of names, such as the place that a name
    stands for. A name is the surer the longer it is: 0.5, and 0.1 for every word, at most 1.
    """
    known = names.select(F.col(name).alias("_name"), F.col(group).alias("entity_group"), F.col(word).alias("word")).distinct()
    score = F.least(F.lit(1.0), F.round(0.5 + F.col("n_words") / 10, 1))
    return mentions.join(known, mentions["name"] == known["_name"]).select(key, "entity_group", "word", score.alias("score"))
