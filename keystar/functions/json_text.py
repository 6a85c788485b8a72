"""Fields out of untrusted text that should hold one JSON object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keystar import constants as K


def object_text(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; NULL when there is no such span."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def parsed_object(text: Column) -> Column:
    """The object as VARIANT; NULL for anything that does not parse."""
    return F.try_parse_json(object_text(text))


def string_field(parsed: Column, field: str) -> Column:
    """A field of a parsed object, only when it is a JSON string."""
    path = f"$.{field}"
    kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    return F.when(kind == "STRING", F.try_variant_get(parsed, path, "string"))


def parse_status(text: Column) -> Column:
    """``parsed`` or ``malformed`` (no object, or an object that is not valid JSON)."""
    return F.when(parsed_object(text).isNotNull(), F.lit("parsed")).otherwise(F.lit("malformed"))


def has_unescaped_quotes(text: Column) -> Column:
    """A quoted word inside a quoted value, which breaks the JSON."""
    return F.coalesce(F.rlike(object_text(text), F.lit(K.QUOTE_PATTERN)), F.lit(False))
