"""Scalar text expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: the sentinel each kind of missing field gets.
MISSING_TEXT = "N/A"
MISSING_ATTR = ""
MISSING_COUNT = "0"


def strip_ws(text: Column) -> Column:
    """Strip all Unicode white space, not only U+0020 as plain ``trim`` does."""
    return F.trim(text, F.lit(WHITESPACE))


def default_fill(value: Column, default: str = MISSING_TEXT, strip: bool = True) -> Column:
    """NULL (element absent) becomes the field's sentinel; present text is stripped."""
    return F.coalesce(strip_ws(value) if strip else value, F.lit(default))


def clean_price(text: Column) -> Column:
    """Displayed price -> digits only text: no currency sign, no thousands commas."""
    return strip_ws(F.translate(strip_ws(text), "₹,", ""))


def price_value(text: Column) -> Column:
    """Numeric twin of :func:`clean_price`; NULL when the text is not a number."""
    return clean_price(text).try_cast("decimal(12,2)")


def name_slug(name: Column, filler: str = "-") -> Column:
    """Lower-case name with spaces replaced (``-`` for URLs, ``_`` for file names)."""
    return F.translate(F.lower(name), " ", filler)


def keyword_match(name: Column, keyword: Column | str) -> Column:
    """Case-insensitive literal substring test; ``%`` and ``_`` have no special meaning."""
    needle = F.lit(keyword) if isinstance(keyword, str) else keyword
    return name.isNotNull() & F.contains(F.lower(name), F.lower(needle))


def preview(text: Column, chars: int = 1000) -> Column:
    """Leading characters followed by an ellipsis; the suffix is always added."""
    return F.concat(F.substring(text, 1, chars), F.lit("..."))


def stats_numbers(text: Column) -> Column:
    """All counters (``12``, ``3K``, ``4M``) in a stats text, in order."""
    return F.regexp_extract_all(text, F.lit(r"\d+[KMB]?"), F.lit(0))


def stats_extract(text: Column) -> Column:
    """First counter = appreciations, second = views; missing counters are ``"0"``."""
    found = stats_numbers(text)
    return F.struct(
        F.coalesce(F.get(found, F.lit(0)), F.lit(MISSING_COUNT)).alias("appreciations"),
        F.coalesce(F.get(found, F.lit(1)), F.lit(MISSING_COUNT)).alias("views"),
    )


def column_label(key: Column) -> Column:
    """``snake_case`` -> display label, title-cased after every non-letter."""
    words = F.regexp_extract_all(
        F.lower(F.translate(key, "_", " ")), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0)
    )
    titled = F.transform(
        words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647))
    )
    return F.array_join(titled, "")


def threshold_label(score: Column, threshold: float = 50) -> Column:
    return F.when(score >= F.lit(threshold), "PASS").otherwise("FAIL")


def strip_urls(text: Column) -> Column:
    """Delete absolute http(s) URLs. The allowed run of characters is ASCII ``!``,
    ``$`` to ``_`` and ``a`` to ``z``; so ``)`` is eaten while ``#`` and ``~`` end a match."""
    return F.regexp_replace(text, r"https?://[!$-_a-z]+", "")
