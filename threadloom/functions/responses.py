"""Column functions that read model responses: JSON extraction and dynamic fields (VARIANT)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom import constants as C
from threadloom.functions.text import SPACE, strip, strip_lower

_END = "\u0001end"


def json_text(response: Column) -> Column:
    """The JSON part of a response: no code fence, no thinking part, first bracket to last bracket."""
    text = strip(response)
    body = F.regexp_replace(text, rf"^```(?:json)?[{SPACE}]*", "")
    body = F.regexp_replace(body, rf"[{SPACE}]*```\z", "")
    text = F.when(F.startswith(text, F.lit("```")), body).otherwise(text)
    text = strip(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))
    return F.nullif(F.regexp_extract(text, r"(?s)[\[{].*[\]}]", 0), F.lit(""))


def object_text(response: Column) -> Column:
    """First opening to last closing brace of the raw response."""
    return F.nullif(F.regexp_extract(response, r"(?s)\{.*\}", 0), F.lit(""))


def framed(json: Column) -> Column:
    """Parse ``json`` next to an end mark; text after the first value then spoils the frame."""
    return F.try_parse_json(F.concat(F.lit("["), json, F.lit(f',"\\u0001end"]')))


def unframed(frame: Column) -> Column:
    """The value of a whole frame, NULL when the text was not exactly one JSON value."""
    whole = (F.try_variant_get(frame, "$[1]", "string") == _END) & F.try_variant_get(
        frame, "$[2]", "variant"
    ).isNull()
    return F.when(whole, F.try_variant_get(frame, "$[0]", "variant"))


def field(value: Column, name: str) -> Column:
    """Member of an object as VARIANT; SQL NULL when absent, VARIANT null when it is a JSON null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), F.lit(False))


def is_text(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def as_text(value: Column) -> Column:
    return value.cast("string")


def unwrap(value: Column) -> Column:
    """One step into an object label: its first known key, NULL when it has none."""
    inner = F.coalesce(*[field(value, key) for key in C.INTENT_KEYS])
    return F.when(is_object(value), inner).otherwise(value)


def scalar_label(value: Column) -> Column:
    """Label of an unwrapped value: lists give their first element, nothing gives the fallback."""
    first = F.try_variant_get(value, "$[0]", "variant")
    picked = F.when(is_array(value), first).otherwise(value)
    return F.when(picked.isNull(), C.FALLBACK_INTENT).otherwise(
        strip_lower(F.coalesce(as_text(picked), F.lit("none")))
    )


def score(value: Column) -> Column:
    """Rating as a whole number in 1..5: absent gives 3, unreadable gives NULL."""
    kind = F.schema_of_variant(value)
    text = as_text(value)
    whole = rf"^[{SPACE}]*[+-]?[0-9]+(_[0-9]+)*[{SPACE}]*\z"
    number = (
        F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when(kind == "STRING", F.when(text.rlike(whole), F.translate(strip(text), "_", "").try_cast("double")))
        .when((kind == "BIGINT") | (kind == "DOUBLE") | F.startswith(kind, F.lit("DECIMAL")), text.try_cast("double"))
    )
    clamped = F.floor(F.greatest(F.lit(1.0), F.least(F.lit(5.0), number)))
    bounded = F.when(number.isNotNull(), clamped)
    return F.when(value.isNull(), 3).otherwise(bounded).cast("int")
