"""Lenient conversions: a value that does not parse becomes NULL, the row stays."""

from __future__ import annotations

from datetime import datetime

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfield.schemas import AUDIT_COLUMNS, RESERVED_RENAMES, TABLES, declared_type

# --- fixed values ---
NULL_TEXTS = ("nan", "None", "")
TRUE_TEXTS = ("true", "1", "yes", "y")
FALSE_TEXTS = ("false", "0", "no", "n")
WHITESPACE = " \t\r\n\f\v"
WHITESPACE_SQL = r" \t\r\n\u000C\u000B"
# --- end of fixed values ---

#: What numbers are written with, the infinite ones aside, and white space.
_NUMBER_CHARACTERS = "0123456789.+-eE" + WHITESPACE_SQL

# Java's own parser also takes "12d" and "0x1p3"; a statistics file never means those.
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI]nf(inity)?)$"


def strip(c: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def number_sql(name: str, source: T.DataType | None = None) -> str:
    """SQL text for column ``name`` as a double: NULL for text that is no number, and for NaN.

    Given as text because scoring and summaries need it for dozens of columns at a time.
    """
    col = f"`{name}`"
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return f"nanvl(CAST({col} AS DOUBLE), NULL)"
    if isinstance(source, (T.NumericType, T.BooleanType)):
        return f"CAST({col} AS DOUBLE)"
    text = f"CAST({col} AS STRING)"
    # Text of these characters alone is a number just if it converts: the pattern is left to the rest.
    plain = f"btrim({text}, '{_NUMBER_CHARACTERS}') = ''"
    pattern = f"btrim({text}, '{WHITESPACE_SQL}') RLIKE r'{_NUMBER}'"
    return f"CASE WHEN {plain} OR {pattern} THEN try_cast({text} AS DOUBLE) END"


def to_double(name: str, source: T.DataType | None = None) -> Column:
    """Number or NULL. NaN counts as missing, as it does in a statistics file."""
    return F.expr(number_sql(name, source))


def to_int(name: str, source: T.DataType | None = None) -> Column:
    """Whole number or NULL; 7.5 has no integer meaning and becomes NULL."""
    if isinstance(source, T.IntegralType):
        return F.col(f"`{name}`").try_cast("int")
    d = number_sql(name, source)
    return F.expr(f"CASE WHEN {d} = floor({d}) THEN try_cast({d} AS INT) END")


def to_date(c: Column, formats: Iterable[str] = ()) -> Column:
    """ISO date or NULL; further patterns are tried in order."""
    tries = [c.try_cast("date")]
    tries += [F.to_date(F.try_to_timestamp(c.cast("string"), F.lit(f))) for f in formats]
    return F.coalesce(*tries)


def to_timestamp(c: Column, formats: Iterable[str] = ()) -> Column:
    """ISO timestamp or NULL; further patterns are tried in order."""
    tries = [c.try_cast("timestamp")]
    tries += [F.try_to_timestamp(c.cast("string"), F.lit(f)) for f in formats]
    return F.coalesce(*tries)


def to_bool(c: Column) -> Column:
    """true/1/yes/y and false/0/no/n in any case; all else, blank included, is NULL."""
    s = F.lower(c.cast("string"))
    return F.when(s.isin(*TRUE_TEXTS), F.lit(True)).when(s.isin(*FALSE_TEXTS), F.lit(False))


def flag_to_bool(name: str, source: T.DataType) -> Column:
    """Boolean from whatever type the landing file used for a flag."""
    c = F.col(f"`{name}`")
    if isinstance(source, T.BooleanType):
        return c
    if isinstance(source, T.NumericType):
        d = to_double(name, source)
        return F.when(d == 1, F.lit(True)).when(d == 0, F.lit(False))
    return to_bool(c)


def clean_text(c: Column) -> Column:
    """Text with the usual stand-ins for "missing" turned into NULL."""
    s = c.cast("string")
    return F.when(~s.isin(*NULL_TEXTS), s)


def clean_time_text(c: Column) -> Column:
    """Kick-off time kept as text; only 'nan' is missing here."""
    s = c.cast("string")
    return F.when(s != "nan", s)


def convert(name: str, source: T.DataType, target: T.DataType) -> Column:
    """Lenient conversion of one column to its declared type."""
    c = F.col(f"`{name}`")
    if isinstance(target, T.IntegerType):
        return to_int(name, source)
    if isinstance(target, T.LongType):
        return c.try_cast("bigint")
    if isinstance(target, T.DoubleType):
        return to_double(name, source)
    if isinstance(target, T.BooleanType):
        return flag_to_bool(name, source)
    if isinstance(target, T.DateType):
        return to_date(c)
    if isinstance(target, T.TimestampType):
        return to_timestamp(c)
    return clean_text(c)


def is_missing(c: Column) -> Column:
    """Is there no value, or a text that stands for none? Such a cell loses nothing by becoming NULL."""
    return c.isNull() | F.lower(strip(c.cast("string"))).isin(*[t.lower() for t in NULL_TEXTS])


def _never_fails(source: T.DataType, target: T.DataType) -> bool:
    """Has each value of one type a meaning in the other?"""
    if isinstance(target, T.StringType) or source == target:
        return True
    if isinstance(target, T.DoubleType):
        return isinstance(source, (T.NumericType, T.BooleanType))
    if isinstance(target, (T.IntegerType, T.LongType)):
        return isinstance(source, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType))
    return isinstance(target, T.TimestampType) and isinstance(source, (T.DateType, T.TimestampNTZType))


def rejected(name: str, source: T.DataType, target: T.DataType) -> Column | None:
    """(column, reason, text) of a cell that holds something and becomes NULL, else NULL.

    Reasons: ``number``, ``fraction`` and ``range`` (numbers that are not whole, or too large, for a
    whole-number column), ``flag``, ``date``, ``time``. None for a conversion that cannot fail.
    """
    if _never_fails(source, target):
        return None
    c, d = F.col(f"`{name}`"), to_double(name, source)
    if isinstance(target, (T.IntegerType, T.LongType)):
        # A double from 2 ** 53 on is whole, and from 2 ** 63 on larger than floor() can say.
        part = (F.abs(d) < 2.0**53) & (d != F.floor(d))
        reason = F.when(d.isNull(), "number").when(part, "fraction").otherwise("range")
    elif isinstance(target, T.BooleanType):
        reason = F.lit("flag")
    elif isinstance(target, T.DateType):
        reason = F.lit("date")
    elif isinstance(target, T.TimestampType):
        reason = F.lit("time")
    else:
        reason = F.lit("number")
    lost = ~is_missing(c) & convert(name, source, target).isNull()
    return F.when(lost, F.struct(F.lit(name).alias("column"), reason.alias("reason"), c.cast("string").alias("text")))


def rejects(df: DataFrame, table: str) -> Column:
    """The cells of a landed row that do not convert to their declared types: an array, mostly empty."""
    cells = []
    for f in df.schema.fields:
        if f.name not in AUDIT_COLUMNS and f.name != "gametime":
            cells.append(rejected(f.name, f.dataType, declared_type(table, f.name, f.dataType)))
    cells = [c for c in cells if c is not None]
    kind = "array<struct<column: string, reason: string, text: string>>"
    return F.filter(F.array(*cells), lambda c: c.isNotNull()).cast(kind) if cells else F.array().cast(kind)


def typed_columns(df: DataFrame, table: str) -> list[Column]:
    """Every column of ``df`` in its declared type."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in AUDIT_COLUMNS:
            out.append(c)
        elif f.name == "gametime":
            out.append(clean_time_text(c).alias(f.name))
        else:
            out.append(convert(f.name, f.dataType, declared_type(table, f.name, f.dataType)).alias(f.name))
    return out


def typed(df: DataFrame, table: str) -> DataFrame:
    """``df`` with its columns in their declared types, in one projection."""
    return df.select(*typed_columns(df, table))


def rename_reserved(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in RESERVED_RENAMES.items() if k in df.columns})


def with_audit(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Add created_at / updated_at where the batch lacks them; one time for all rows."""
    now = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    missing = {c: now for c in AUDIT_COLUMNS if c not in df.columns}
    return df.withColumns(missing) if missing else df


def align(df: DataFrame, table: str) -> DataFrame:
    """Declared columns first and complete (absent ones as NULL), then any extras."""
    types = TABLES[table].types
    declared = [
        F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in types.items()
    ]
    extras = [F.col(f"`{c}`") for c in df.columns if c not in types]
    return df.select(*declared, *extras)
