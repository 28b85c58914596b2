"""Text to number with the accepted spellings stated as patterns.

``try_cast`` alone is too generous (it takes ``1.5d``, blanks and hex), so each
cast sits behind a pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted number spellings.
DECIMAL_FLOAT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NOT_IN_FLOAT = r"[^0-9eE.+-]"
FLOAT_WORD = r"^([+-]?(?i:inf|infinity)|(?i:nan))$"
SIGNED_WORD = r"^[+-]?(?i:inf|infinity|nan)$"
NOT_IN_WHOLE = r"[^0-9+-]"
WHOLE_NUMBER = r"^[+-]?[0-9]+$"
BLANKS = " \t\n\r\x0b\x0c"


def strict_double(text: Column) -> Column:
    """Float text without blanks or suffixes; null when malformed or out of range."""
    # The cast checks the structure, so it is enough to bar foreign characters before it.
    number = F.when(~text.rlike(NOT_IN_FLOAT), text).try_cast("double")
    infinity = F.lit(float("inf"))
    in_range = F.nullif(F.nullif(number, infinity), -infinity)
    return F.coalesce(in_range, F.when(text.rlike(FLOAT_WORD), text).try_cast("double"))


def strict_long(text: Column) -> Column:
    """Decimal integer text that fits 64 bits; null otherwise."""
    return F.when(~text.rlike(NOT_IN_WHOLE), text).try_cast("bigint")


def loose_float_ok(text: Column) -> Column:
    """True if the text reads as a float once blanks around it are cut."""
    bare = F.btrim(text, F.lit(BLANKS))
    return bare.rlike(DECIMAL_FLOAT) | bare.rlike(SIGNED_WORD)


def loose_int_ok(text: Column) -> Column:
    """True if the text reads as a whole number of any size once blanks are cut."""
    return F.btrim(text, F.lit(BLANKS)).rlike(WHOLE_NUMBER)


def ratio_step(length: Column, parts: int) -> Column:
    """``length`` divided into ``parts`` whole steps, at least one."""
    return F.greatest(F.floor(length / F.lit(parts)).cast("int"), F.lit(1))
