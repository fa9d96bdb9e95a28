"""Using the value of an expression several times while writing the expression once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once and occurring once in the plan.

    Steps that read their input several times would otherwise multiply: Spark copies the whole
    expression of a column into each place a pushed-down filter reads it, and a chain of steps that
    read their input three times each grows by powers of three.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
