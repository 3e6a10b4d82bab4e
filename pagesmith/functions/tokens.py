"""Token counting. The counter is a plain Column function, so another one can be passed in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4
MAX_TOKENS = 120_000

TokenCounter = Callable[[Column], Column]


def count_tokens(text: Column) -> Column:
    """Default counter: one token per four characters, rounded up."""
    size = F.length(F.coalesce(text, F.lit("")))
    return F.ceil(size / F.lit(float(CHARS_PER_TOKEN))).cast("bigint")


def trim_to_tokens(text: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """Keep the leading ``max_tokens`` tokens (as counted by the default counter)."""
    kept = F.substring(text, 1, CHARS_PER_TOKEN * max_tokens)
    return F.when(count_tokens(text) > max_tokens, kept).otherwise(text)
