"""HTML expressions: element lookup, subtree removal, markdown and plain text.

All of it is built from Spark's regular-expression and array functions. Elements whose body holds
another element of the same name are closed by counting depth over the page's tags, so nesting is
handled exactly; the common, un-nested case is a single regular expression.

The bodies are written as Spark SQL text (functions named ``_sql_*`` take and return SQL text) and
applied to a column by :func:`bind`, which evaluates its input once per row. Composing text keeps
query construction fast; every lambda variable has a name of its own, so nothing is captured.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WHITESPACE

# Named character references that are decoded: the standard library's table, as ";name=character" runs.
_NAMED = "".join(f"\x01{name}\x02{chr(code)}" for name, code in name2codepoint.items()) + "\x01apos\x02'\x01"
# Fixed value: elements that never have a closing tag.
VOID_TAGS = ("img", "br", "hr", "input", "meta", "link", "source", "area", "base", "col", "wbr")

_ANY_TAG = r"[A-Za-z][A-Za-z0-9-]*"
_TAG_END = r"[\s/>])"
# An attribute as a parser reads it: a value in either quotes or without any. All loops are possessive, which
# Java runs without recursion, so a page of any length is read in one pass and on a small stack.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)"
_GIVEN = r"(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+))"  # the same in three groups, one of which is set
_ATTR = rf"[\s/]++[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+"
# What follows a start tag's name, up to and with its end; a quote that is never closed ends at the next ">".
_TAG_REST = rf"(?:(?:{_ATTR})*+[\s/]*+>|[^>]*>)"
_MARKUP = rf"<(?:/?{_ANY_TAG}(?=[\s/>]){_TAG_REST}|[A-Za-z/!?][^>]*>)"


def _up_to(name: str) -> str:
    """All attributes before the one of that name, and its name; the value follows."""
    return rf"(?:[\s/]++(?!{name}\s*+=)[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+)*+[\s/]++{name}\s*+=\s*+"


# Fixed value: the elements that start a new block of text.
_BLOCKS = (
    "p|div|article|section|main|nav|aside|ul|ol|dl|table|tbody|thead|form|figure|address|body|html"
)


def _lit(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL for "body, where name = value": the value is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def bind(value: Column, body: Callable[[str], str]) -> Column:
    """``body`` (SQL text over a variable) applied to a column that is evaluated once per row."""
    run = F.call_function("transform", F.array(value), F.expr(f"v -> {body('v')}"))
    return F.get(run, F.lit(0))


def _replace_all(text: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        text = f"regexp_replace({text}, {_lit(pattern)}, {_lit(to)})"
    return text


# --- subtree removal ---------------------------------------------------------------------------


def _sql_drop(html: str, *tags: str) -> str:
    names = "|".join(tags)
    opening = _lit(rf"(?i)<(?:{names})\b")
    innermost = [(rf"(?is)<({names})\b{_TAG_REST}(?:(?!<\1\b).)*?</\1\s*>", "")]
    rounds = f"sequence(1, regexp_count(dr, {opening}))"
    # a pass that removes nothing is the last one: what is still open is never closed
    again = _let(
        _replace_all("dacc.html", innermost), "dt",
        "named_struct('html', dt, 'done', length(dt) = length(dacc.html))",
    )
    start = "named_struct('html', dr, 'done', false)"
    passes = f"aggregate({rounds}, {start}, (dacc, dn) -> CASE WHEN dacc.done THEN dacc ELSE {again} END).html"
    return _let(
        _replace_all(html, innermost), "dr", f"CASE WHEN dr RLIKE {opening} THEN {passes} ELSE dr END"
    )


def drop_elements(html: Column, *tags: str) -> Column:
    """Remove every element with one of the given names, contents included.

    One pass removes all innermost elements, which is everything on an un-nested page. Pages that
    still show an opening tag get one more pass per opening tag, enough for any nesting depth."""
    return bind(html, lambda v: _sql_drop(v, *tags))


def clean_html(html: Column) -> Column:
    """Drop the page's header and footer elements; nothing else is touched."""
    return drop_elements(html, "header", "footer")


def _sql_inert(html: str, *more: str) -> str:
    names = "|".join(("script", "style", *more))
    return _replace_all(html, [(rf"(?is)<!--.*?-->|<({names})\b[^>]*>.*?</\1\s*>", "")])


def strip_inert(html: Column, *more: str) -> Column:
    """Remove what a parser never reports as elements (comments, script and style bodies) and,
    on request, ``more`` elements that cannot nest, such as ``head``."""
    return bind(html, lambda v: _sql_inert(v, *more))


# --- character references ----------------------------------------------------------------------


def _sql_char(code: str) -> str:
    """Character of a code point; the replacement character where no such character exists."""
    valid = "cc BETWEEN 1 AND 1114111 AND cc NOT BETWEEN 55296 AND 57343"
    char = f"decode(unhex(lpad(hex(if({valid}, cc, 65533L)), 8, '0')), 'UTF-32')"
    return _let(code, "cc", char)


def _sql_decode(text: str) -> str:
    name = _lit(r"^([A-Za-z][A-Za-z0-9]{1,7}|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});")
    digits = "if(cn RLIKE '^#[xX]', conv(substring(cn, 3), 16, 10), substring(cn, 2))"
    numeric = _sql_char(f"try_cast({digits} AS BIGINT)")
    after = f"substring_index({_lit(_NAMED)}, concat(chr(1), cn, chr(2)), -1)"  # all of it if there is no such name
    named = f"substring_index({after}, chr(1), 1)"
    char = f"CASE WHEN startswith(cn, '#') THEN {numeric} ELSE nullif({named}, '') END"
    done = f"coalesce(concat({char}, substring(cp, length(cn) + 2)), concat('&', cp))"
    one = _let(f"regexp_extract(cp, {name}, 1)", "cn", done)
    pieces = f"transform(split({text}, '&'), (cp, ci) -> CASE WHEN ci = 0 THEN cp ELSE {one} END)"
    return f"array_join({pieces}, '')"


def decode_entities(text: Column) -> Column:
    """Character references -> characters, in one pass, so ``&amp;lt;`` gives ``&lt;``."""
    return bind(text, _sql_decode)


# --- element lookup ----------------------------------------------------------------------------


def _start_tag(tag: str | None, cls: str | None = None, attr: str | None = None,
               element_id: str | None = None) -> str:
    """Pattern of an opening tag carrying the given class token, id and attribute."""
    name = re.escape(tag) if tag else _ANY_TAG
    tests = ""
    if cls:
        token = re.escape(cls)
        tests += (
            rf"(?={_up_to('class')}(?:\"(?:[^\"]*\s)?{token}(?:\s[^\"]*)?\""
            rf"|'(?:[^']*\s)?{token}(?:\s[^']*)?'|{token}(?=[\s>])))"
        )
    if element_id:
        own = re.escape(element_id)
        tests += rf"(?={_up_to('id')}(?:\"{own}\"|'{own}'|{own}(?=[\s>])))"
    if attr:
        tests += rf"(?={_up_to(re.escape(attr))}{_VALUE})"
    return rf"(?is)<{name}(?=[\s/>]){tests}{_TAG_REST}"


def _sql_close(rest: str, tag: str) -> str:
    """``rest`` starts with an opening ``tag``; the text up to its own closing tag."""
    border = f"concat({_lit('(?i)(?=</?')}, {tag}, {_lit(_TAG_END)})"
    depth = "za.depth + if(startswith(zs, '</'), -1, 1)"
    closed = f"(za.closed OR {depth} = 0)"
    step = (
        f"named_struct('depth', {depth}, 'taken', za.taken + if({closed}, 0, 1), 'closed', {closed})"
    )
    start = "named_struct('depth', 0, 'taken', 0, 'closed', false)"
    taken = f"aggregate(zp, {start}, (za, zs) -> {step}).taken"
    return _let(f"split({rest}, {border})", "zp", f"array_join(slice(zp, 1, {taken}), '')")


def _sql_closed(rest: str, tag: str) -> str:
    """Like :func:`_sql_close`, but empty when the element's closing tag never comes."""
    border = f"concat({_lit('(?i)(?=</?')}, {tag}, {_lit(_TAG_END)})"
    depth = "ya.depth + if(startswith(ys, '</'), -1, 1)"
    closed = f"(ya.closed OR {depth} = 0)"
    step = (
        f"named_struct('depth', {depth}, 'taken', ya.taken + if({closed}, 0, 1), 'closed', {closed})"
    )
    start = "named_struct('depth', 0, 'taken', 0, 'closed', false)"
    body = "CASE WHEN yr.closed THEN array_join(slice(yp, 1, yr.taken), '') ELSE '' END"
    counted = _let(f"aggregate(yp, {start}, (ya, ys) -> {step})", "yr", body)
    return _let(f"split({rest}, {border})", "yp", counted)


def _sql_own_element(piece: str, rest: str) -> str:
    """The element that ``piece`` and ``rest`` start with. ``piece`` ends where the next match starts;
    if the element's closing tag isn't in it, or other elements of its name are, it is looked for in
    all that follows. An element that is never closed ends with its piece."""
    void = _lit(rf"(?i)^<(?:{'|'.join(VOID_TAGS)})(?=[\s/>])")
    flat = _lit(rf"(?is)^(<({_ANY_TAG})(?=[\s/>])[^>]*>.*?)</\2\s*>")
    tag = f"regexp_extract({piece}, {_lit(f'^<({_ANY_TAG})')}, 1)"
    nested = f"contains(lower(substring(ob, 2)), concat('<', lower({tag})))"
    whole = _let(_sql_closed(rest, tag), "ow", f"CASE WHEN ow <> '' THEN ow ELSE {_sql_close(piece, tag)} END")
    body = f"CASE WHEN ob = '' OR {nested} THEN {whole} ELSE ob END"
    return (
        f"CASE WHEN {piece} RLIKE {void} THEN regexp_extract({piece}, '^<[^>]*>', 0) "
        f"ELSE {_let(f'regexp_extract({piece}, {flat}, 1)', 'ob', body)} END"
    )


def _sql_element(rest: str) -> str:
    """Opening tag plus body of the element that ``rest`` starts with (closing tag left off)."""
    void = _lit(rf"(?i)^<(?:{'|'.join(VOID_TAGS)})(?=[\s/>])")
    flat = _lit(rf"(?is)^(<({_ANY_TAG})(?=[\s/>])[^>]*>.*?)</\2\s*>")
    tag = f"regexp_extract({rest}, {_lit(f'^<({_ANY_TAG})')}, 1)"
    nested = f"contains(lower(substring(eb, 2)), concat('<', lower({tag})))"
    body = f"CASE WHEN eb = '' OR {nested} THEN {_sql_close(rest, tag)} ELSE eb END"
    return (
        f"CASE WHEN {rest} RLIKE {void} THEN regexp_extract({rest}, '^<[^>]*>', 0) "
        f"ELSE {_let(f'regexp_extract({rest}, {flat}, 1)', 'eb', body)} END"
    )


def find_elements(html: Column, tag: str | None = None, cls: str | None = None,
                  element_id: str | None = None) -> Column:
    """ARRAY of all matching elements in page order, each from its own start to its own closing tag,
    so a match inside another match is part of the outer one and an element of its own."""
    start = _start_tag(tag, cls, element_id=element_id)

    def body(v: str) -> str:
        rest = "array_join(slice(fp, fi + 1, size(fp)), '')"
        one = f"CASE WHEN fe RLIKE {_lit('^' + start)} THEN {_sql_own_element('fe', rest)} END"
        found = f"filter(transform(fp, (fe, fi) -> {one}), fs -> fs IS NOT NULL)"
        return _let(f"split({v}, {_lit(f'(?={start})')})", "fp", found)

    return bind(html, body)


def has_element(html: Column, tag: str | None = None, cls: str | None = None) -> Column:
    """Whether a page has such an element outside comments, scripts and styles; nothing is cut out."""
    return strip_inert(html).rlike(_start_tag(tag, cls))


def _sql_find(html: str, start: str) -> str:
    rest = f"regexp_extract({html}, {_lit(start + '.*')}, 0)"
    return _let(rest, "fr", f"CASE WHEN fr <> '' THEN {_sql_element('fr')} END")


def find_element(html: Column, tag: str | None = None, cls: str | None = None,
                 attr: str | None = None, element_id: str | None = None) -> Column:
    """First matching element, or NULL."""
    return bind(html, lambda v: _sql_find(v, _start_tag(tag, cls, attr, element_id)))


def _sql_attribute(element: str, name: str) -> str:
    given = _lit(rf"(?is)^<[^\s/>]++{_up_to(re.escape(name))}({_VALUE})")
    quote = "if(aq RLIKE '^[\"\\']', 1, 0)"
    value = _sql_decode(f"substring(aq, 1 + {quote}, length(aq) - 2 * {quote})")
    found = f"regexp_extract({element}, {given}, 1)"
    return _let(found, "aq", f"CASE WHEN aq <> '' THEN {value} END")


def attribute(element: Column, name: str) -> Column:
    """Value of an attribute of the element's own opening tag, decoded; NULL when absent."""
    return bind(element, lambda v: _sql_attribute(v, name))


def _sql_text(element: str) -> str:
    return _sql_decode(_replace_all(element, [(_MARKUP, "")]))


def text_content(element: Column) -> Column:
    """Concatenated text of an element, tags removed and character references decoded."""
    return bind(element, _sql_text)


def closest_link(html: Column, cls: str) -> Column:
    """href of the nearest link that is, or encloses, the first element of a class; NULL if none."""
    start = _start_tag(None, cls)

    def body(v: str) -> str:
        # the page in front of the element and the element's own tag; of all link tags in front the last one
        # encloses the element if it opens a link
        parts = f"split({v}, {_lit(start)}, 2)"
        itself = f"regexp_extract({v}, {_lit(start)}, 0)"
        tags = f"split(kp[0], {_lit(r'(?i)(?=</?a[\s>])')})"
        around = f"get({tags}, size({tags}) - 1)"
        link = f"CASE WHEN size(kp) < 2 THEN '' WHEN ks RLIKE {_lit(r'(?i)^<a\s')} THEN ks ELSE {around} END"
        opens = f"kl RLIKE {_lit(r'(?i)^<a\s')}"
        href = _let(link, "kl", f"CASE WHEN {opens} THEN {_sql_attribute('kl', 'href')} END")
        return _let(parts, "kp", _let(itself, "ks", href))

    return bind(html, body)


def page_title(html: Column) -> Column:
    """Text of the first title element; NULL when the page has none."""
    title = _lit(r"(?is)<title\b[^>]*>(.*?)</title\s*>")
    return bind(
        html,
        lambda v: f"CASE WHEN {v} RLIKE {title} THEN {_sql_decode(f'regexp_extract({v}, {title}, 1)')} END",
    )


def links(html: Column) -> Column:
    """ARRAY<STRUCT<name, url>> of links with a non-empty href, in page order."""
    tag = _lit(rf"(?is)^<a(?=\s){_up_to('href')}{_VALUE}")
    strip = lambda text: f"btrim({text}, {_lit(WHITESPACE)})"

    def body(v: str) -> str:
        # a link's text ends where the next link tag begins
        pieces = f"split({_sql_inert(v)}, {_lit(r'(?i)(?=</?a[\s>])')})"
        found = f"filter({pieces}, lp -> lp RLIKE {tag})"
        name, url = strip(_sql_text("la")), strip(_sql_attribute("la", "href"))
        rows = f"transform({found}, la -> named_struct('name', {name}, 'url', {url}))"
        return f"filter({rows}, ll -> ll.url <> '')"

    return bind(html, body)


# --- markdown and plain text -------------------------------------------------------------------


def _sql_headings(text: str) -> str:
    marked = _replace_all(text, [(rf"(?i) ?<h([1-6])(?=[\s/>]){_TAG_REST} ?", "\n\n\x01$1")])
    for level in range(1, 7):
        marked = f"replace({marked}, {_lit(chr(1) + str(level))}, {_lit('#' * level + ' ')})"
    return marked


def _sql_ordered(text: str) -> str:
    """Items of lists get their number or bullet and an indent by depth: a fold over the list tags with a stack of
    the open lists, which holds each one's next number, 0 for a list without. Inner lists begin no new block."""
    tag = rf"</?(?:ul|ol)(?=[\s/>]){_TAG_REST}|<li(?=[\s/>]){_TAG_REST}"
    trimmed = _replace_all(text, [(rf"(?i) ?({tag}) ?", "$1")])
    pieces = f"split({trimmed}, {_lit(r'(?i)(?=<(?:/?(?:ul|ol)|li)[\s/>])')})"
    rest = _replace_all("ux", [(rf"(?i)^(?:{tag})", "")])
    is_item, opens, closes = (f"ux RLIKE {_lit(p)}" for p in (r"(?i)^<li[\s/>]", r"(?i)^<[uo]l[\s/>]", r"(?i)^</[uo]l[\s/>]"))
    depth, number = "size(uo.open)", "get(uo.open, 0)"
    mark = f"CASE WHEN {number} > 0 THEN concat({number}, '. ') ELSE '* ' END"
    item = f"concat({_lit(chr(10))}, repeat('  ', greatest({depth}, 1)), {mark}, {rest})"
    inner = f"({opens} AND {depth} > 0 OR {closes} AND {depth} > 1)"
    shown = f"CASE WHEN {is_item} THEN {item} WHEN {inner} THEN {rest} ELSE ux END"
    outer = f"slice(uo.open, 2, greatest({depth} - 1, 0))"
    after = (
        f"CASE WHEN {opens} THEN concat(array(if(ux RLIKE {_lit('(?i)^<ol')}, 1, 0)), uo.open) WHEN {closes} THEN {outer} "
        f"WHEN {is_item} AND {number} > 0 THEN concat(array({number} + 1), {outer}) ELSE uo.open END"
    )
    start = "named_struct('done', CAST(array() AS ARRAY<STRING>), 'open', CAST(array() AS ARRAY<INT>))"
    step = f"named_struct('done', concat(uo.done, array({shown})), 'open', {after})"
    return f"array_join(aggregate({pieces}, {start}, (uo, ux) -> {step}).done, '')"


_RARE_TAGS = r"(?is)<(?:hr|em|i|code|img|td|th|tr|ol)\b|<ul[\s>](?:(?!</?ul[\s>]).)*+<ul[\s>]"
_RARE_STEPS = [
    (r"(?i) ?<hr\b[^>]*> ?", "\n\n* * *\n\n"),
    (r"(?i)</?(?:em|i)(?:\s[^>]*)?>", "_"),
    (r"(?i)</?code(?:\s[^>]*)?>", "`"),
    (rf"(?i)<img(?=\s)(?={_up_to('src')}{_GIVEN})(?={_up_to('alt')}{_GIVEN}){_TAG_REST}", "![$4$5$6]($1$2$3)"),
    (rf"(?i)<img(?=\s){_up_to('src')}{_GIVEN}{_TAG_REST}", "![]($1$2$3)"),
    (rf"(?i)</t[dh] ?> ?<t[dh](?=[\s/>]){_TAG_REST}", " | "),
    (r"(?i) ?</tr ?> ?", "\n"),
]
_COMMON_STEPS = [
    (r"(?i) ?<br ?/?> ?", "  \n"),
    (rf"(?i) ?<li(?=[\s/>]){_TAG_REST} ?", "\n  * "),
    (rf"(?i)</?(?:b|strong)(?:(?=[\s/]){_TAG_REST}|>)", "**"),
    (rf"(?i)<a(?=\s){_up_to('href')}{_GIVEN}{_TAG_REST}(.*?)</a ?>", "[$4]($1$2$3)"),
    (rf"(?i) ?</?(?:{_BLOCKS}|h[1-6])(?=[\s/>]){_TAG_REST} ?", "\n\n"),
    (_MARKUP, ""),
]


def to_markdown(html: Column) -> Column:
    """Cleaned page -> markdown with inline links, ``#`` headings, bullets and ``**bold**``."""

    def body(v: str) -> str:
        cleaned = _sql_inert(_sql_drop(v, "header", "footer"), "head")
        marked = _sql_headings(_replace_all(cleaned, [(r"[ \t\r\n\f]+", " ")]))
        rare = _sql_ordered(_replace_all("mt", _RARE_STEPS))
        marked_all = f"CASE WHEN mt RLIKE {_lit(_RARE_TAGS)} THEN {rare} ELSE mt END"
        text = _sql_decode(_replace_all(_let(marked, "mt", marked_all), _COMMON_STEPS))
        tidy = _replace_all(text, [(r"\n(?: *\n){2,}", "\n\n"), (r"\n ([^ ])", "\n$1")])
        return f"btrim({tidy}, {_lit(WHITESPACE)})"

    return bind(html, body)


def to_text(html: Column) -> Column:
    """Page -> plain text: no link, emphasis or heading markup, one line per block."""
    steps = [
        (r"[ \t\r\n\f]+", " "),
        (rf"(?i) ?</?(?:br|{_BLOCKS}|h[1-6]|li|tr|header|footer)(?=[\s/>]){_TAG_REST} ?", "\n"),
        (_MARKUP, ""),
    ]

    def body(v: str) -> str:
        text = _sql_decode(_replace_all(_sql_inert(v, "head"), steps))
        return f"btrim({_replace_all(text, [(r' *\n[ \n]*', chr(10))])}, {_lit(WHITESPACE)})"

    return bind(html, body)
