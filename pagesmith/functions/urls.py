"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The outcome codes of URL validation.
URL_EMPTY = "empty"
URL_BAD_FORMAT = "bad_format"
URL_BAD_SCHEME = "bad_scheme"

_SCHEME = r"(?i:https?|ftps?|sftp|ssh|git|ircs?|rtmps?|rtsp|telnet)"
_BYTE = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HOST = (
    rf"(?:localhost|{_BYTE}(?:\.{_BYTE}){{3}}|\[[0-9A-Fa-f:.]{{2,45}}\]"
    r"|(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]*[\p{L}\p{N}])?\.)+(?:\p{L}{2,63}|(?i:xn--[a-z0-9-]{1,59})))"
)
URL_FORMAT = rf"^{_SCHEME}://(?:[^\s/?#@]+@)?{_HOST}(?::\d{{1,5}})?(?:[/?#]\S*)?$"


def validate_url(url: Column) -> Column:
    """STRUCT<ok, reason>: emptiness, then general format, then http(s) scheme."""
    reason = (
        F.when(url.isNull() | (url == ""), URL_EMPTY)
        .when(~url.rlike(URL_FORMAT), URL_BAD_FORMAT)
        .when(~(url.startswith("http://") | url.startswith("https://")), URL_BAD_SCHEME)
        .otherwise("")
    )
    return F.struct((reason == "").alias("ok"), reason.alias("reason"))


def url_slug(url: Column) -> Column:
    """Text after the last ``/``."""
    return F.substring_index(url, "/", -1)


def url_page_number(url: Column) -> Column:
    """Text after the last ``page=`` up to the next ``&``; the URL itself when absent."""
    return F.substring_index(F.substring_index(url, "page=", -1), "&", 1)


def url_page_int(url: Column) -> Column:
    """Typed twin of :func:`url_page_number`: NULL when the URL names no page."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit("page")).try_cast("int")


def url_quote(text: Column) -> Column:
    """Percent-encoding that keeps ``/`` and ``~`` and encodes space as ``%20``.

    Spark's ``url_encode`` is form encoding, so its four differences are put right."""
    quoted = F.url_encode(text)
    for form, path in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(form), F.lit(path))
    return quoted


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve an href against the page it was found on (host-relative and absolute forms)."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    path = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"[^/]*$", "")
    folder = F.when(F.length(path) > F.length(origin), path).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .when(href.startswith("?"), F.concat(F.regexp_replace(base, r"[?#].*$", ""), href))
        .otherwise(F.concat(folder, href))
    )
