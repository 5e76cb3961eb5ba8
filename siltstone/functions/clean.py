"""Cleaning expressions.

Every function returns a plain Column built from Spark's own functions. Casts
are ``try_cast`` because ANSI mode stays on. Numeric input is cast as it is;
the stripping patterns are for text only, so a double never loses its point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value (case-sensitive).
NULL_LIKE = ["", "null", "NULL", "None", "N/A", "na", "NA"]
# Spellings of true and false, compared in lower case.
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]
# Patterns of the characters to strip.
NOT_INTEGER = r"[^0-9\-]"
NOT_DECIMAL = r"[^0-9\.\-]"
HTML_TAG = r"<[^>]+>"
BLANKS = r"\s+"

# Seconds that a timestamp holds, whose microseconds are a long; outside, an epoch is not a time.
MIN_EPOCH, MAX_EPOCH = -9223372036854, 9223372036854


def clean_string(col: Column) -> Column:
    """Trim spaces; texts that stand for a missing value become null."""
    trimmed = F.trim(col)
    return F.when(~trimmed.isin(*NULL_LIKE), trimmed)


def clean_strings(df: DataFrame) -> DataFrame:
    """``clean_string`` on every string column, in one projection."""
    return df.select(*[
        clean_string(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def _number(df: DataFrame, name: str, pattern: str, target: str) -> Column:
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.NumericType):
        return col.try_cast(target)
    return F.regexp_replace(col.cast("string"), pattern, "").try_cast(target)


def to_long(df: DataFrame, name: str) -> Column:
    return _number(df, name, NOT_INTEGER, "bigint")


def to_int(df: DataFrame, name: str) -> Column:
    """As ``to_long``; a value too large for an int becomes null."""
    return _number(df, name, NOT_INTEGER, "int")


def to_double(df: DataFrame, name: str) -> Column:
    return _number(df, name, NOT_DECIMAL, "double")


def epoch_to_timestamp(col: Column) -> Column:
    seconds = col.try_cast("bigint")
    return F.when(seconds.between(MIN_EPOCH, MAX_EPOCH), F.timestamp_seconds(seconds))


def to_timestamp(df: DataFrame, name: str, text: str = "time") -> Column:
    """Numbers are epoch seconds; text is a written time, or epoch seconds if ``text`` is ``"epoch"``."""
    if text not in ("time", "epoch"):
        raise ValueError(f"text is time or epoch, not {text}")
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return epoch_to_timestamp(F.col(name))
    if isinstance(kind, T.StringType):
        return epoch_to_timestamp(F.col(name)) if text == "epoch" else F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def to_date(col: Column) -> Column:
    return col.try_cast("date")


def clean_html(col: Column) -> Column:
    """Tags become a space, blanks collapse; entities stay as they are."""
    text = F.regexp_replace(col, HTML_TAG, " ")
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def to_boolean(col: Column, strict: bool = False) -> Column:
    """Known spellings first; then a cast, or null when ``strict``."""
    word = F.lower(col.cast("string"))
    known = F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
    return known if strict else known.otherwise(col.try_cast("boolean"))


def flag_to_boolean(df: DataFrame, name: str) -> Column:
    """1 and 0 as numbers, then whatever a boolean cast accepts."""
    col = F.col(name)
    as_bool = col.try_cast("boolean")
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return as_bool
    number = col.try_cast("int")
    return F.when(number == 1, F.lit(True)).when(number == 0, F.lit(False)).otherwise(as_bool)


def normalize_value(col: Column) -> Column:
    """Lower case, trim spaces, then collapse blanks (in this order)."""
    return F.regexp_replace(F.lower(F.trim(col)), BLANKS, " ")


def first_present(df: DataFrame, candidates: list[str]) -> Column:
    """First non-null of the candidate columns that exist; null if none does."""
    present = [F.col(c) for c in candidates if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")
