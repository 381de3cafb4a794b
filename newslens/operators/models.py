"""Model-backed functions as named, replaceable Arrow functions.

A factory returns a function over batches; Spark keeps a Python worker's
modules loaded, so a model that the factory caches loads once per worker. The
defaults need no model: they give what the engine falls back on without one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.chunks import token_chunks_of

PRESUMMARY_MIN, PRESUMMARY_MAX = 1000, 2000
EMBEDDING_DIM = 384
CHUNK_FALLBACK = 500

# Code and label of the top-level topics.
TOPIC_CODES = {
    "01000000": "arts, culture, entertainment and media",
    "02000000": "crime, law and justice",
    "03000000": "disaster, accident and emergency incident",
    "04000000": "economy, business and finance",
    "05000000": "education",
    "06000000": "environmental issue",
    "07000000": "health",
    "08000000": "human interest",
    "09000000": "labour",
    "10000000": "lifestyle and leisure",
    "11000000": "politics",
    "12000000": "religion",
    "13000000": "science and technology",
    "14000000": "society",
    "15000000": "sport",
    "16000000": "conflict, war and peace",
    "17000000": "weather",
}


def hashing_embedding(texts: pd.Series) -> pd.Series:
    """Unit vectors of hashed words: a stand-in for a sentence model, not equal to one."""

    def one(text: str | None) -> list[float]:
        v = np.zeros(EMBEDDING_DIM)
        for word in (text or "").lower().split():
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            v[h % EMBEDDING_DIM] += 1.0 if h >> 63 else -1.0
        n = np.linalg.norm(v)
        return (v / n if n else v).tolist()

    return texts.map(one)


def presummary(texts: pd.Series) -> pd.Series:
    """Short texts as they are, long ones cut."""
    return texts.map(lambda x: (x or "") if len(x or "") < PRESUMMARY_MIN else x[:PRESUMMARY_MAX])


def chunked_presummary(model: Callable[[str], str], tokens: Callable[[str], list] = str.split) -> Callable[[pd.Series], pd.Series]:
    """A "presummary" that gives long texts to a model chunk by chunk and joins its words; a chunk that fails becomes its first CHUNK_FALLBACK characters."""

    def chunk(text: str) -> str:
        try:
            return model(text)
        except (OSError, ValueError, RuntimeError):
            return text[:CHUNK_FALLBACK]

    def one(text: str | None) -> str:
        if len(text or "") < PRESUMMARY_MIN:
            return text or ""
        return " ".join(chunk(x) for x in token_chunks_of(text, encode=tokens)).strip()

    return lambda texts: texts.map(one)


#: name: (function over a batch of texts, type of its result); None as function means "no model".
DEFAULTS: dict[str, tuple[Callable[[pd.Series], pd.Series] | None, str]] = {
    "language": (None, "string"),
    "translation": (None, "string"),
    "entities": (None, "array<struct<entity_group:string,word:string,score:double>>"),
    "topics": (lambda s: s.map(lambda _: {"topic": "unclassified", "code": "00000000", "confidence": 0.0}), "struct<topic:string,code:string,confidence:double>"),
    "embedding": (hashing_embedding, "array<double>"),
    "presummary": (presummary, "string"),
    "summary": (None, "string"),
    "summary_fallback": (None, "string"),
}

#: Attempts at a summary, and seconds before the second; the wait doubles with each.
ATTEMPTS, WAIT = 3, 1.0


class ModelRegistry:
    """Functions by name; register() replaces a default."""

    def __init__(self) -> None:
        self.held = dict(DEFAULTS)

    def register(self, name: str, function: Callable[[pd.Series], pd.Series], kind: str | None = None) -> None:
        if name not in self.held:
            raise KeyError(name)
        self.held[name] = (function, kind or self.held[name][1])

    def apply(self, name: str, text: Column) -> Column:
        """The model's result for a column; null of its type without a model."""
        function, kind = self.held[name]
        if function is None:
            return F.lit(None).cast(kind)
        if kind.startswith("struct"):

            def frame(s: pd.Series) -> pd.DataFrame:
                return pd.DataFrame(list(function(s)))

            return F.pandas_udf(frame, kind)(text)

        def series(s: pd.Series) -> pd.Series:
            return function(s)

        return F.pandas_udf(series, kind)(text)

    def summarize(self, text: Column, attempts: int = ATTEMPTS, wait: float = WAIT) -> Column:
        """A language model's summary: attempts of "summary", the last one of "summary_fallback" if registered; null if all fail.

        Waits double between attempts. ``calls.summarised`` keeps to a rate as well, and gives another summary instead of null.
        """
        from .calls import called

        first, kind = self.held["summary"]
        second = self.held["summary_fallback"][0]
        if first is None and second is None:
            return F.lit(None).cast(kind)

        def series(s: pd.Series) -> pd.Series:
            return s.map(lambda x: called(x, first or second, second, attempts, wait)[0])

        return F.pandas_udf(series, kind)(text)
