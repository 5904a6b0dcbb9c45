"""Native tokenisers matching the two split rules of the text jobs.

Both follow Java ``String.split`` with limit 0: empty input gives one empty
token, trailing empty tokens are removed, so text made only of separators
gives no token at all, while leading and inner empty tokens are kept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _java_split(text: Column, trailing_pattern: str, sep_pattern: str) -> Column:
    stripped = F.regexp_replace(text, trailing_pattern, "")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, sep_pattern))
    )


def tokenize(text: Column | str) -> Column:
    """Lower-case, split on single whitespace characters (the ML Tokenizer rule)."""
    c = F.col(text) if isinstance(text, str) else text
    return _java_split(F.lower(c), r"\s+$", r"\s")


def split_space(text: Column | str) -> Column:
    """Case-preserving split on single spaces (the legacy mllib job's rule)."""
    c = F.col(text) if isinstance(text, str) else text
    return _java_split(c, r" +$", " ")
