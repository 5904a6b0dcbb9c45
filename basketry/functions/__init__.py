"""Column functions (JVM-side expressions, no Python UDFs)."""

from basketry.functions.textfn import split_space, tokenize
from basketry.functions.timefn import (
    format_rate,
    hhmm_to_hour,
    hour_anchor,
    hours_before,
    hours_between,
    parse_hour,
    strictly_after,
    strictly_before,
)

__all__ = [
    "format_rate",
    "hhmm_to_hour",
    "hour_anchor",
    "hours_before",
    "hours_between",
    "parse_hour",
    "split_space",
    "strictly_after",
    "strictly_before",
    "tokenize",
]
