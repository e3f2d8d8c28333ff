"""Tokenising and word-list tests on review text, all as built-in column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Split on every run of characters that are neither letters nor digits, in any script.
TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"

# The default list of positive words used to classify a review.
DEFAULT_POSITIVE_WORDS = (
    "good", "great", "excellent", "amazing", "awesome", "wonderful", "fantastic",
    "love", "loved", "best", "brilliant", "enjoyed", "perfect", "superb", "masterpiece",
)


def tokens(text: Column | str) -> Column:
    """Lower-cased word tokens of ``text``; NULL text gives an empty array."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.lower(F.coalesce(c, F.lit(""))), TOKEN_SEPARATOR)
    # array_remove (unlike a lambda filter) keeps the stage in whole-stage codegen.
    return F.array_remove(parts, "")


@lru_cache(maxsize=4)
def _stop_words(language: str) -> tuple[str, ...]:
    from pyspark.ml.feature import StopWordsRemover

    SparkSession.getActiveSession()  # the loader needs a running JVM
    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop-word list for ``language``."""
    return _stop_words(language)


def without_stop_words(toks: Column, words: Iterable[str]) -> Column:
    """``toks`` with every stop word removed (order and duplicates kept)."""
    stop = F.array(*[F.lit(w) for w in sorted(set(words))])
    return F.filter(toks, lambda t: ~F.array_contains(stop, t))


def contains_any(toks: Column, words: Iterable[str]) -> Column:
    """True when any token is in ``words``; an empty word list gives false.

    The words travel in the plan as one literal array, so the list should stay small (tens
    to hundreds of words): the cost per row grows with its length.
    """
    ws = sorted({w.lower() for w in words})
    if not ws:
        return F.lit(False)
    return F.arrays_overlap(toks, F.array(*[F.lit(w) for w in ws]))


def effective_words(words: Iterable[str], removed: Iterable[str]) -> list[str]:
    """Words that can still match once ``removed`` have been taken out of the tokens.

    Testing ``tokens - removed`` against ``words`` equals testing ``tokens`` against
    ``words - removed``, so stop-word removal costs nothing per row when only the
    yes/no answer is needed.
    """
    gone = {w.lower() for w in removed}
    return sorted({w.lower() for w in words} - gone)
