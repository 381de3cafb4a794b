"""Text, URL and numeric column functions."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR_CHARS = 2000


@F.pandas_udf(T.StringType())
def _nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def normalized_text(text: Column) -> Column:
    """Lower case, compatibility decomposition, single spaces, trimmed, then all but letters, digits, _ and spaces removed.

    Spaces are collapsed before punctuation goes, so 'a - b' keeps two spaces.
    Spark has no Unicode normalisation, hence the Arrow function; the rest is compiled.
    """
    plain = F.trim(F.regexp_replace(_nfkd(F.lower(text)), r"[\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " "))
    return F.regexp_replace(plain, r"(?U)[^\p{L}\p{N}_\s]", "")


def content_hash(text: Column) -> Column:
    """SHA-256 of the normalised text."""
    return F.sha2(normalized_text(text), 256)


def sanitize(text: Column) -> Column:
    """Without control characters but tab and line ends; runs of blanks to one, of line feeds to two; trimmed."""
    out = F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]", "")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.regexp_replace(out, r"^\s+|\s+$", "")


def falsy_coalesce(*values: Column) -> Column:
    """The first value that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in values], F.lit(""))


def hostname(url: Column) -> Column:
    """Lower-case host of a URL, null where there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def netloc(url: Column) -> Column:
    """Authority of a URL with port and user, case kept."""
    return F.try_parse_url(url, F.lit("AUTHORITY"))


def _reserved(a: Column, b: Column) -> Column:
    """Whether the first two bytes of an IPv4 address are of a private, loopback, link-local or reserved block."""
    return a.isin(0, 10, 127) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 100) & b.between(64, 127)) | (a >= 224)


def unsafe_literal_ip(host: Column) -> Column:
    """Whether a host is a literal address that is private, loopback, link-local or reserved: IPv4 in four parts or as one decimal or hexadecimal number, or IPv6 outside the global unicast block."""
    octet = lambda k: F.split_part(host, F.lit("."), F.lit(k)).try_cast("int")
    number = F.when(host.rlike(r"^\d{1,10}$"), host.try_cast("long")).when(host.rlike(r"^0[xX][0-9a-fA-F]{1,8}$"), F.conv(F.substring(host, 3, 8), 16, 10).try_cast("long"))
    whole = F.coalesce(_reserved(F.shiftright(number, 24), F.shiftright(number, 16).bitwiseAND(255)), F.lit(False))
    global_v6 = host.rlike(r"^\[[23][0-9a-fA-F]{3}:") & ~host.rlike(r"(?i)^\[(2001:0?db8|2001:0{0,3}:|2002):")
    return (host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$") & _reserved(octet(1), octet(2))) | whole | (F.startswith(host, F.lit("[")) & ~global_v6)


def url_safety(url: Column) -> Column:
    """'ok', or why a URL must not be fetched. Names are not resolved here, that is for the executors that fetch; only those of the machine itself are known."""
    scheme, host = F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))), hostname(url)
    return (
        F.when(~F.coalesce(scheme, F.lit("")).isin("http", "https"), "scheme")
        .when(F.coalesce(host, F.lit("")) == "", "host")
        .when(unsafe_literal_ip(host) | host.rlike(r"^(.*\.)?(localhost|localdomain)\.?$"), "private")
        .otherwise("ok")
    )


def language_resolve(existing: Column, text: Column, detected: Column | None = None) -> Column:
    """The existing code if it is two or three lower-case letters, 'und' for short texts, else what a model detected (or the existing one, or 'und')."""
    fallback = F.coalesce(*([detected] if detected is not None else []), F.nullif(existing, F.lit("")), F.lit("und"))
    return F.when(existing.rlike("^[a-z]{2,3}$"), existing).when(F.length(F.trim(F.coalesce(text, F.lit("")))) < 20, "und").otherwise(fallback)


def title_en(title: Column, language: Column, translated: Column | None = None) -> Column:
    """The title as it is for blank and English ones, else its translation, else the title."""
    kept = F.coalesce(title, F.lit(""))
    if translated is None:
        return kept
    return F.when((F.trim(kept) == "") | F.lower(language).isin("en", "eng"), kept).otherwise(F.coalesce(translated, kept))


def embedding_text(title: Column, content: Column) -> Column:
    """What is embedded of an article: its title and the first 1000 characters."""
    return F.trim(F.concat(F.coalesce(title, F.lit("")), F.lit(". "), F.substring(F.coalesce(content, F.lit("")), 1, 1000)))


def token_budget(chars: Column) -> Column:
    """Output tokens for a prompt: a fifth of its estimated tokens (four characters each), from 200 to 600."""
    return F.greatest(F.lit(200).cast("long"), F.least(F.lit(600).cast("long"), F.floor(F.floor(chars / 4) * 20 / 100))).cast("long")


def fetch_failure(url: Column, kind: Column) -> Column:
    """Failure reason of a fetch outcome: without URL no_text, open breaker blocked, HTTP errors http_error, success null, the rest unknown."""
    return (
        F.when(F.coalesce(url, F.lit("")) == "", "no_text")
        .when(kind == "breaker", "blocked")
        .when(kind.isin("http", "network"), "http_error")
        .when(kind == "ok", None)
        .otherwise("unknown")
    )


def extraction_failure(message: Column) -> Column:
    """Failure reason named in an extraction error text, no_text by default."""
    return F.when(message.contains("js_required"), "js_required").when(message.contains("consent"), "consent").when(message.contains("paywall"), "paywall").otherwise("no_text")


# What is noise in a model's output, and what takes its place, in order; read alike by Java and Python.
NOISE = (
    (r"\r\n?", "\n"),
    (r"\\'", "'"),
    (r"`{3,}", " "),
    (r"(?m)^\s*(?:\[\[.*?\]\]|\[.*?\])\s*$", " "),
    (r"[{}\[\]<>`=\\/]", " "),
    ("\"\"\"|'''", " "),
    (r"\s+", " "),
)


def clean_noise(text: Column) -> Column:
    """Model output without fences, bracket-only lines, structural characters and repeated white space."""
    return F.trim(reduce(lambda out, rule: F.regexp_replace(out, *rule), NOISE, text))


def error_text(message: Column, chars: int = ERROR_CHARS) -> Column:
    return F.substring(message, 1, chars)
