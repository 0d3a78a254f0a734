"""Text cleaning, text keys and numeric coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.schemas import NA_TOKENS


def clean(text: Column) -> Column:
    """Without line feeds, carriage returns and ASCII blanks; all other characters stay."""
    for dropped in ("\n", "\r", " "):
        # Plain replacement of bytes; translate() looks up every character and takes twice as long.
        text = F.replace(text, F.lit(dropped), F.lit(""))
    return text


def text_key(text: Column) -> Column:
    """32 bytes that stand for a text, so that shuffles need not carry the text itself."""
    return F.unhex(F.sha2(text, 256))


def known(text: Column) -> Column:
    """Null for the tokens that stand for a missing value."""
    return F.when(~text.isin(*NA_TOKENS), text)


def to_long(text: Column) -> Column:
    """Whole number of a numeric text, fractions cut off; other text raises.

    Goes through a decimal, since a double would round ids beyond 2^53.
    """
    number = text.try_cast("decimal(38,18)")
    refuse = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("long")
    return F.when(text.isNotNull() & number.isNull(), refuse).otherwise(number.cast("long"))


def to_long_or_zero(text: Column) -> Column:
    return F.coalesce(to_long(text), F.lit(0).cast("long"))
