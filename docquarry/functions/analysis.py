"""The text analyser that match clauses and indexed text share."""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), _SPLIT), lambda x: x != "")


def analyze(text: str) -> list[str]:
    return [x for x in regex.split(_SPLIT, text.lower()) if x]


_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"


def has_any(c: Column, words: list[str]) -> Column:
    """Whether a token is one of the words: one pass over the text, no list of tokens."""
    if not words:
        return F.lit(False)
    return F.lower(c).rlike(_BEFORE + "(?:" + "|".join(map(regex.escape, dict.fromkeys(words))) + ")" + _AFTER)


def phrase(c: Column, words: list[str], prefix: bool = False) -> Column:
    """Whether the tokens hold the words in a row; the last one may be a beginning."""
    if not words:
        return F.lit(False)
    return F.lower(c).rlike(_BEFORE + _SPLIT.join(map(regex.escape, words)) + ("" if prefix else _AFTER))
