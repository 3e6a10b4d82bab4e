"""Schemas of extracted records, prompts, and the JSON texts that providers reply with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def listing_schema(fields: Sequence[str], arrays: Sequence[str] = ()) -> T.StructType:
    """Record type of a field list: strings in the given order; ``arrays`` become string arrays."""
    if not fields:
        raise ValueError("at least one field is required")
    return T.StructType(
        [
            T.StructField(f, T.ArrayType(T.StringType()) if f in arrays else T.StringType())
            for f in fields
        ]
    )


def container_schema(listing: T.DataType) -> T.StructType:
    """``{"listings": [record, ...]}``"""
    return T.StructType([T.StructField("listings", T.ArrayType(listing))])


def system_prompt(fields: Sequence[str]) -> str:
    """Our own instruction text: the output skeleton named field by field."""
    skeleton = ", ".join(f'"{f}": "string"' for f in fields)
    return (
        "Read the page text below and list every record it contains. Answer with one JSON object "
        f'of the form {{"listings": [{{{skeleton}}}]}} and nothing else. '
        "Leave a value empty when the text does not state it."
    )


USER_PROMPT = "Page text:\n"


def build_prompt(text: Column, fields: Sequence[str]) -> Column:
    return F.concat(F.lit(system_prompt(fields) + "\n" + USER_PROMPT), text)


ANSWER_PROMPT = (
    "Answer the question from the context alone. "
    'If the context does not hold the answer, say "not available in the context".\n\nContext:\n'
)


def build_answer_prompt(context: Column, question: Column) -> Column:
    return F.concat(F.lit(ANSWER_PROMPT), context, F.lit("\n\nQuestion:\n"), question)


def parse_reply(reply: Column, fields: Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """STRUCT<status, listings>. Status is ``ok`` (a JSON object), ``no_object`` (other valid JSON,
    no listings but tokens count) or ``invalid`` (not JSON: neither listings nor tokens count)."""
    record = listing_schema(fields, arrays)
    schema = container_schema(record).add(CORRUPT, T.StringType())
    parsed = F.from_json(
        reply, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return _with_status(reply, parsed, T.ArrayType(record))


def parse_reply_map(reply: Column) -> Column:
    """Like :func:`parse_reply` with records as MAP<STRING,STRING>, which keeps unknown fields."""
    record = T.MapType(T.StringType(), T.StringType())
    schema = container_schema(record).add(CORRUPT, T.StringType())
    parsed = F.from_json(
        reply, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return _with_status(reply, parsed, T.ArrayType(record))


def is_json(text: Column) -> Column:
    """Whether a text is one whole JSON value, of any size and with repeated keys allowed.

    The parser stops after the first value, so the text is read inside an array and inside an object:
    what follows a value breaks at least one of them, or makes it longer than one value."""
    in_array = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1
    return F.coalesce(in_array & in_object, F.lit(False))


def _with_status(reply: Column, parsed: Column, listings: T.ArrayType) -> Column:
    none = F.array().cast(listings)

    def judged(p: Column) -> Column:
        status = F.when(~is_json(reply), "invalid").when(p[CORRUPT].isNotNull(), "no_object").otherwise("ok")
        found = F.when(status == "ok", F.coalesce(p["listings"], none)).otherwise(none)
        return F.struct(status.alias("status"), found.alias("listings"))

    return F.get(F.transform(F.array(parsed), judged), F.lit(0))  # parsed once


def repair_reply(reply: Column, compatible: bool = False) -> Column:
    """Close a reply that was cut off inside its ``listings`` array.

    Valid JSON is returned unchanged. Otherwise the text is cut after its last ``}`` (in
    ``compatible`` mode after the second-last one, which gives up the last whole record) and the
    array and object are closed. With too few ``}`` the text stays as it is."""
    braces = F.size(F.split(reply, r"\}")) - 1
    if compatible:
        cut = F.concat(F.substring_index(reply, "}", -2), F.lit(""))
        kept = F.substring(reply, F.lit(1), F.length(reply) - F.length(cut))
        needed = 2
    else:
        tail = F.substring_index(reply, "}", -1)
        kept = F.substring(reply, F.lit(1), F.length(reply) - F.length(tail))
        needed = 1
    valid = is_json(reply)
    return F.when(valid | (braces < needed), reply).otherwise(F.concat(kept, F.lit("]}")))


def fill_record(record: Column, fields: Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """Requested fields that are absent become empty text (or an empty array), in field order."""
    empty = lambda f: F.array().cast("array<string>") if f in arrays else F.lit("")
    return F.struct(*[F.coalesce(record.getField(f), empty(f)).alias(f) for f in fields])


def fill_map(record: Column, fields: Sequence[str]) -> Column:
    """Map form of :func:`fill_record`: requested fields first, extra fields kept."""
    wanted = F.create_map(
        *[x for f in fields for x in (F.lit(f), F.coalesce(record[f], F.lit("")))]
    )
    extra = F.map_filter(record, lambda k, _: ~k.isin(*fields))
    return F.map_concat(wanted, extra)


def unwrap_container(reply: Column) -> Column:
    """STRUCT<kind, payload>: an object with exactly one key gives that key's value, a list or any
    other object gives itself, everything else is an ``error``."""
    trimmed = F.trim(reply)
    keys = F.json_object_keys(trimmed)
    whole = is_json(trimmed)
    is_list = whole & trimmed.startswith("[")
    is_object = whole & trimmed.startswith("{")
    only = F.element_at(F.map_values(F.from_json(trimmed, "map<string,string>")), 1)
    kind = (
        F.when(is_list, "list")
        .when(is_object & (F.size(keys) == 1), "single_key")
        .when(is_object, "object")
        .otherwise("error")
    )
    return F.struct(
        kind.alias("kind"),
        F.when(kind == "single_key", only)
        .when(kind != "error", trimmed)
        .alias("payload"),
    )
