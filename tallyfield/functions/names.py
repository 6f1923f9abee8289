"""Name and position text: cleaning for rank files, keys for matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfield.functions.typing import strip

# --- fixed values: text patterns of the rank files ---
TEAM_IN_PARENS = r"^(.+?)\s*\(([A-Z]{2,4})\)$"
TEAM_AT_END = r"^(.+?)\s+([A-Z]{2,4})$"
GENERATION_SUFFIX = r"\s(II|III|IV)$"
POSITION_CODE = r"(?i)^(QB|RB|WR|TE|K|DST)"
# --- end of fixed values ---


def clean_player_name(c: Column, *, keep_generation: bool = False) -> Column:
    """Player name without a trailing ``(TEAM)`` or team code; NULL becomes ''.

    A name ending in III ends in capitals too and loses it, unless ``keep_generation``.
    """
    s = strip(c)
    in_parens = strip(F.regexp_extract(s, TEAM_IN_PARENS, 1))
    at_end = strip(F.regexp_extract(s, TEAM_AT_END, 1))
    bare = F.when(at_end != "", at_end).otherwise(s)
    if keep_generation:
        bare = F.when(s.rlike(GENERATION_SUFFIX), s).otherwise(bare)
    return F.coalesce(F.when(in_parens != "", in_parens).otherwise(bare), F.lit(""))


def clean_position(c: Column) -> Column:
    """Position code without its number (``rb12`` -> ``RB``); unknown text stays, NULL is ''."""
    s = strip(c)
    code = F.upper(F.regexp_extract(s, POSITION_CODE, 1))
    return F.coalesce(F.when(code != "", code).otherwise(s), F.lit(""))


def name_key(c: Column) -> Column:
    return F.lower(F.trim(c))


def position_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def bare_key(c: Column) -> Column:
    """Name key without dots and spaces: "B.J. Blue" and "BJ Blue" agree."""
    return F.translate(name_key(c), ". ", "")
