"""Sentences by statistics of the corpus itself, without a list of abbreviations.

A word that nearly always has a period after it, and is short, is an
abbreviation; a word that stands after sentence ends more often than elsewhere
begins sentences; two words around a period that go together more often than by
chance belong to one sentence. All three are log-likelihood ratios (Kiss and
Strunk 2006) of counts that one aggregation each gives. A text is cut after every
period, question or exclamation mark, and put together again where these say so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import stash

# The thresholds of the method.
ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88
#: How often a word has a period if it is an abbreviation.
NEARLY = 0.99
#: Rows of a table of the model that is sent to all tasks.
SENT = 300_000
_SPACE = r"\x20\x09-\x0D"
#: What is cut off around a fragment: all space separators of Unicode, as the SQL's trim has it.
_BLANK = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
# \z, not $, which Java also matches before a line end of Unicode
_OPEN, _CLOSE = r"""^["'(\[{«„“‘]+""", r"""["')\]}»“”’,;:]+\z"""
_END = r"""([.!?]["')\]»”’]*)[\x20\x09-\x0D]+"""
_LETTER = r"\p{L}"


def _core(word: Column) -> Column:
    """A word without quotation marks and brackets around it and commas behind it."""
    return F.regexp_replace(word, f"{_OPEN}|{_CLOSE}", "")


def _has_period(core: Column) -> Column:
    return core.endswith(".") & ~core.endswith("..")


def _type(core: Column) -> Column:
    """The lower-case word without its final period; null if it has no letter."""
    # each letter by itself: Java looks at a capital sigma's place in the word, and makes two of a dotted I
    low = F.lower(F.translate(F.regexp_replace(core, r"[.!?]+\z", ""), "\u03a3\u0130", "\u03c3i"))
    return F.when(low.rlike(_LETTER), low)


def fragments(text: Column) -> Column:
    """The text cut after every mark that may end a sentence; white space within becomes one space."""
    flat = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), _END, "$1\x01"), f"[{_SPACE}]+", " ")
    return F.filter(F.transform(F.split(flat, "\x01"), lambda x: F.trim(x, F.lit(_BLANK))), lambda x: x != "")


def _xlog(count: Column, p: Column) -> Column:
    # a text's own \x01 cuts words, so that more may follow ends than there are: no number in the SQL, and above any threshold
    return F.when(count == 0, 0.0).when(p < 0, float("nan")).otherwise(count * F.ln(p))


def ratio(both: Column, first: Column, second: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of two events, for how often each and both happen in n."""
    p, p1, p2 = second / n, both / first, (second - both) / (n - first)
    a, b, c, d = both, first - both, second - both, n - first - second + both
    return 2 * (_xlog(a, p1) + _xlog(b, 1 - p1) + _xlog(c, p2) + _xlog(d, 1 - p2) - _xlog(a + c, p) - _xlog(b + d, 1 - p))


def _ends(docs: DataFrame, text: str, **keep: Column) -> DataFrame:
    """(keep, place, last, following): for all fragments but a text's last one, their last word and the first word after them."""
    pieces = docs.select(*(c.alias(x) for x, c in keep.items()), fragments(F.col(text)).alias("_f"))
    last = F.transform(F.slice("_f", F.lit(1), F.greatest(F.size("_f") - 1, F.lit(0))), lambda x: F.substring_index(x, " ", -1))
    following = F.transform(F.slice("_f", F.lit(2), F.size("_f")), lambda x: F.substring_index(x, " ", 1))
    return pieces.select(*keep, F.posexplode(F.arrays_zip(last.alias("last"), following.alias("following"))).alias("place", "x")).select(*keep, "place", "x.last", "x.following")


def _sent(told: DataFrame) -> DataFrame:
    """A table to look words up in, sent to all tasks if it has up to SENT rows; a larger one is joined by a shuffle."""
    return F.broadcast(told) if told.limit(SENT + 1).count() <= SENT else told


def learn(docs: DataFrame, text: str = "text") -> dict[str, DataFrame]:
    """What the corpus says: "abbreviations" (type, score), "starters" (type, score), "collocations" (first, second, score).

    Defined results: null and empty texts say nothing; an empty table gives empty
    tables; repeated rows count each; words without letters are none of the three.
    """
    split = F.split(F.coalesce(F.col(text), F.lit("")), f"[{_SPACE}]+")
    # words and pairs are counted as they stand first, so patterns look at each different one once
    words = docs.select(F.explode(split).alias("word")).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = words.select(_core(F.col("word")).alias("core"), "n").select(_type(F.col("core")).alias("type"), _has_period(F.col("core")).alias("period"), "n")
    counts = stash(words.groupBy("type").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("period"), F.col("n")).otherwise(0)).alias("with_period")), "types")
    # one row, whatever the corpus
    totals = F.broadcast(counts.agg(F.sum("n").alias("all"), F.sum("with_period").alias("periods")))
    known = counts.where("type is not null")
    rate = F.least(F.greatest(F.col("periods") / F.col("all"), F.lit(1e-9)), F.lit(1 - 1e-9))
    without, inner = F.col("n") - F.col("with_period"), F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = F.length("type") - inner
    likelihood = 2 * (F.col("with_period") * F.ln(F.lit(NEARLY) / rate) + without * F.ln(F.lit(1 - NEARLY) / (1 - rate)))
    score = likelihood * F.exp(-letters.cast("double")) * (1 + inner) * F.pow(letters.cast("double"), -without.cast("double"))
    abbreviations = stash(known.where("with_period > 0").crossJoin(totals).select("type", F.round(score, 6).alias("score")).where(F.col("score") >= ABBREVIATION), "abbreviations")
    met = _ends(docs, text).groupBy("last", "following").agg(F.count(F.lit(1)).alias("n"))
    met = met.select(_core(F.col("last")).alias("core"), _core(F.col("following")).alias("next_core"), "n").where("next_core <> ''")
    met = met.select(_has_period(F.col("core")).alias("period"), _type(F.col("core")).alias("type"), _type(F.col("next_core")).alias("next_type"), "n")
    pairs = stash(met.groupBy("period", "type", "next_type").agg(F.sum("n").alias("n")), "pairs")
    # a period after an abbreviation ends no sentence, as far as is known by now
    ends = pairs.join(abbreviations.select("type", F.lit(True).alias("short")), "type", "left").where(~(F.col("period") & F.coalesce("short", F.lit(False))))
    n_ends = F.broadcast(ends.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ends")))
    after = ends.where("next_type is not null").groupBy(F.col("next_type").alias("type")).agg(F.sum("n").alias("both"))
    joined = after.join(known.select("type", "n"), "type").crossJoin(totals).crossJoin(n_ends)
    starters = joined.select("type", F.round(ratio(F.col("both"), F.col("ends"), F.col("n"), F.col("all")), 4).alias("score"), (F.col("both") / F.col("ends") > F.col("n") / F.col("all")).alias("more"))
    starters = stash(starters.where("more").where(F.col("score") >= STARTER).drop("more"), "starters")
    around = pairs.where(F.col("period") & F.col("type").isNotNull() & F.col("next_type").isNotNull()).groupBy("type", "next_type").agg(F.sum("n").alias("both")).where("both > 1")
    first, second = known.select("type", F.col("n").alias("n1")), known.select(F.col("type").alias("next_type"), F.col("n").alias("n2"))
    # only words that may be abbreviations have collocations over a period: others end sentences too often
    close = around.join(abbreviations.select("type"), "type", "left_semi").join(first, "type").join(second, "next_type").crossJoin(totals)
    score = F.round(ratio(F.col("both"), F.col("n1"), F.col("n2"), F.col("all")), 4)
    collocations = close.where(F.col("both") / F.col("n1") > F.col("n2") / F.col("all")).select(F.col("type").alias("first"), F.col("next_type").alias("second"), score.alias("score")).where(F.col("score") >= COLLOCATION)
    return {"abbreviations": abbreviations, "starters": starters, "collocations": stash(collocations, "collocations")}


def split(docs: DataFrame, model: dict[str, DataFrame], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, sentences): every text as an array of sentences, in order; white space within becomes one space.

    A mark doesn't end a sentence where a period follows an abbreviation or a
    single letter and no word that begins sentences, in upper case, comes next;
    nor between the words of a collocation; nor before a lower-case letter.

    Defined results: null and empty texts have no sentence; keys needn't be
    unique, rows of one key and equal text give one row; null keys are kept; an
    empty table gives no rows; texts are read whole; further columns are ignored.
    """
    ident = {"_key": F.col(key), "_check": F.xxhash64(F.col(text))}
    # only places go through the lookups: a fragment whose last word has a period, and what follows
    ends = _ends(docs, text, **ident).where(F.contains("last", F.lit("."))).select(*ident, "place", _core(F.col("last")).alias("core"), _core(F.col("following")).alias("next_core"))
    told = ends.where(_has_period(F.col("core"))).select(*ident, "place", _type(F.col("core")).alias("type"), "next_core", _type(F.col("next_core")).alias("next_type"))
    flag = lambda name: F.lit(True).alias(name)
    told = told.join(_sent(model["abbreviations"].select("type", flag("short"))), "type", "left")
    told = told.join(_sent(model["starters"].select(F.col("type").alias("next_type"), flag("starts"))), "next_type", "left")
    told = told.join(_sent(model["collocations"].select(F.col("first").alias("type"), F.col("second").alias("next_type"), flag("close"))), ["type", "next_type"], "left")
    no = F.lit(False)
    begins = F.coalesce("starts", no) & F.col("next_core").rlike(r"^\p{Lu}")
    short = F.coalesce("short", no) | F.coalesce(F.col("type").rlike(r"^\p{L}\z"), no)
    on = told.where(short & ~begins | F.coalesce("close", no) | F.col("next_core").rlike(r"^\p{Ll}")).select(*ident, "place")
    # texts are shuffled once, to the places after which their sentences go on
    rows = docs.select(*(c.alias(x) for x, c in ident.items()), F.col(text).alias("_text")).unionByName(on, allowMissingColumns=True)
    held = rows.groupBy(*ident).agg(F.max("_text").alias("_text"), F.collect_set("place").alias("_on"))
    each = held.select("_key", "_on", fragments(F.col("_text")).alias("_f"))
    stops = F.when(F.size("_on") > 0, F.array_except(F.sequence(F.lit(0), F.size("_f") - 1), F.col("_on")))
    each = each.select("_key", "_f", stops.alias("_stops"))
    starts = F.concat(F.array(F.lit(0)), F.transform(F.slice("_stops", F.lit(1), F.size("_stops") - 1), lambda x: x + 1))
    joined = F.zip_with(starts, "_stops", lambda x, y: F.array_join(F.slice("_f", x + 1, y - x + 1), " "))
    return each.select(F.col("_key").alias(key), F.when(F.col("_stops").isNull(), F.col("_f")).otherwise(joined).alias("sentences"))


def lead(sentences: Column, most: int, min_chars: int) -> Column:
    """The first sentences of an array that are longer than min_chars, as ``summary.lead_sentences`` takes them of a text."""
    return F.filter(F.slice(sentences, 1, most), lambda x: F.length(x) > min_chars)
