"""Engagement counts sent as numbers or as text such as ``"1,204"``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsfold.functions.binding import bind
from newsfold.functions.text import JS_SPACE

# Separators removed from a textual count (the dot is kept on purpose), and what
# must remain.
COUNT_SEPARATORS = rf"[{JS_SPACE},_']"
PLAIN_NUMBER = r"^[0-9]+(\.[0-9]+)?$"
TOO_LARGE = 2.0**63


def engagement_count(number: Column, text: Column) -> Column:
    """LONG count from whichever of the two is set; null when negative, not finite or not a number."""
    def rounded(value: Column) -> Column:
        fits = (value >= 0) & (value < TOO_LARGE)
        return F.when(fits, F.floor(value) + F.when(value - F.floor(value) >= 0.5, 1).otherwise(0))

    digits = F.regexp_replace(text, COUNT_SEPARATORS, "")
    written = bind(digits, lambda d: F.when(d.rlike(PLAIN_NUMBER), d.try_cast("double")))
    return bind(F.coalesce(number, written), rounded)
