"""Text expressions for the special-day table and for labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reasons that carry a place name after them, and the phrase of the
# football cup days.
PLACE_REASONS = ("Fundacion", "Independencia", "Provincializacion", "Cantonizacion", "Translado")
CUP_PHRASE = "Mundial de futbol Brasil"


def offset_text(reason: Column) -> Column:
    """The sign and digits a reason ends with; null where it does not.  Trimming digits is cheaper than a pattern."""
    rest = F.rtrim(reason, F.lit("0123456789"))
    signed = (F.length(rest) < F.length(reason)) & (rest.endswith("+") | rest.endswith("-"))
    return F.when(signed, F.substr(reason, F.length(rest)))


def day_offset(reason: Column) -> Column:
    """The signed number a reason ends with, else 0."""
    return F.coalesce(offset_text(reason).try_cast("int"), F.lit(0))


def canonical_reason(
    reason: Column, place_reasons: Sequence[str] = PLACE_REASONS, cup_phrase: str = CUP_PHRASE
) -> Column:
    """One spelling per reason: bare place reasons, no offset, one name for cup days; null stays null."""
    by_place = F.coalesce(*[F.when(reason.startswith(p), F.lit(p)) for p in place_reasons])
    offset = offset_text(reason)
    return (
        F.when(by_place.isNotNull(), by_place)
        .when(offset.isNotNull(), F.replace(reason, offset, F.lit("")))
        .when(F.contains(reason, F.lit(cup_phrase)), F.lit(cup_phrase))
        .otherwise(reason)
    )


def refine_special_days(
    df: DataFrame, reason: str = "special_day_reason", place_reasons: Sequence[str] = PLACE_REASONS
) -> DataFrame:
    """Keep a reason's offset in its own column and the reason in its canonical form."""
    return df.withColumns({
        "special_day_offset": day_offset(F.col(reason)),
        reason: canonical_reason(F.col(reason), place_reasons),
    })


def labelled(variable: Column, value: Column) -> Column:
    """``variable = value``."""
    return F.concat_ws(" = ", variable, value.cast("string"))
