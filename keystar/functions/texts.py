"""Text columns: repair, truncation, composition, matching, prompts and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keystar import constants as K

# LIKE patterns built from user text keep % and _ live; no character escapes them.
_NO_ESCAPE = "\u0001"


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def null_tokens(value: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~value.isin(*tokens), value)


def repair_dash(value: Column) -> Column:
    """Replacement characters left by a wrong decoding become em dashes."""
    return F.replace(value, F.lit(K.REPLACEMENT_CHAR), F.lit(K.EM_DASH))


def truncated(value: Column, limit: int = K.MAX_SEQUENCE) -> tuple[Column, Column]:
    """(text cut to ``limit`` characters, whether anything was cut)."""
    return F.substring(value, 1, limit), F.length(value) > limit


def letter_count(value: Column, letter: str) -> Column:
    """Occurrences of one letter, from the bytes its removal saves (no character counting)."""
    saved = F.octet_length(value) - F.octet_length(F.replace(value, F.lit(letter), F.lit("")))
    width = len(letter.encode())
    return saved if width == 1 else (saved / width).cast("int")


def standard_length(value: Column, letters: str = K.RESIDUES) -> Column:
    """Length once everything outside ``letters`` is removed."""
    return F.length(F.regexp_replace(value, f"[^{letters}]", ""))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to 2 decimals; NULL for a zero whole.

    Rounds the scaled binary value, so every engine agrees on the last digit.
    """
    scaled = F.try_divide(part.cast("double") * 100.0, whole.cast("double"))
    return F.floor(scaled * 100.0 + 0.5).cast("double") / 100.0


def contains_text(value: Column, query: str) -> Column:
    return F.ilike(value, F.lit(f"%{query}%"), F.lit(_NO_ESCAPE))


def starts_with_text(value: Column, query: str) -> Column:
    return F.ilike(value, F.lit(f"{query}%"), F.lit(_NO_ESCAPE))


def any_of(*conditions: Column) -> Column:
    """OR in which a NULL operand counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def prompt(symbol: Column, name: Column, text: Column) -> Column:
    """Request text for one entity; lines without a value are left out."""
    body = F.when(text != "", F.concat(F.lit(K.PROMPT_TEXT), text))
    return F.concat_ws(
        "\n",
        F.concat(F.lit(K.PROMPT_GENE), blank_to_null(symbol)),
        F.concat(F.lit(K.PROMPT_PROTEIN), blank_to_null(name)),
        F.coalesce(body, F.lit(K.PROMPT_NO_TEXT)),
    )


def stage_phase(stage: Column) -> Column:
    """Clinical stage -> 0..4; UNKNOWN and unseen stages stay NULL."""
    chain = None
    for name, phase in K.STAGE_PHASE.items():
        chain = F.when(stage == name, phase) if chain is None else chain.when(stage == name, phase)
    return chain


def phase_label(phase: Column) -> Column:
    return (
        F.when(phase == 4, "Approved")
        .when(phase == 3, "Late-stage trials")
        .when(phase.isNull(), "In development")
        .otherwise(F.concat(F.lit("Phase "), phase.cast("string")))
    )


def display_label(symbol: Column, name: Column, key: Column) -> Column:
    """``SYMBOL (name)``, else the symbol, else the key, else ``?``."""
    symbol, name = blank_to_null(symbol), blank_to_null(name)
    full = F.concat(symbol, F.lit(" ("), name, F.lit(")"))
    return F.coalesce(full, symbol, blank_to_null(key), F.lit("?"))


def fold_domain(value: Column, known: list[str], other: str = K.UNCLASSIFIED) -> Column:
    return F.when(value.isin(*known), value).otherwise(F.lit(other))
