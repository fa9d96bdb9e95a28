"""The filter set shared by the listing and both counts, checked once and compiled to one predicate."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfold.functions import dates
from newsfold.functions.outlets import with_outlet
from newsfold.operators.keywords import keyword_filter

if TYPE_CHECKING:
    from newsfold.operators.keyword_index import KeywordIndex

UNDATED_NOTE = "Undated mentions match no date range; the result leaves them out."


class ArgumentProblems(ValueError):
    """All problems of a request together."""

    def __init__(self, problems: Iterable[str]):
        self.problems = list(problems)
        super().__init__("; ".join(self.problems))


@dataclass(frozen=True)
class Filters:
    """Checked filters. ``source`` is a slug; ``since`` is inclusive and ``until`` exclusive, in UTC."""

    q: str | None = None
    source: str | None = None
    since: dt.datetime | None = None
    until: dt.datetime | None = None

    @property
    def dated(self) -> bool:
        return self.since is not None or self.until is not None

    def predicate(self) -> Column:
        """Over ``search_text``, ``source_slug`` and ``published_at``; undated rows fail a date bound."""
        clauses = []
        if self.source is not None:
            clauses.append(F.col("source_slug") == self.source)
        if self.since is not None:
            clauses.append(F.col("published_at") >= _instant(self.since))
        if self.until is not None:
            clauses.append(F.col("published_at") < _instant(self.until))
        if self.q is not None:
            clauses.append(keyword_filter(self.q, F.col("search_text")))
        return reduce(lambda a, b: a & b, clauses, F.lit(True)) if clauses else F.lit(True)

    def apply(self, mentions: DataFrame) -> DataFrame:
        return mentions.where(self.predicate())

    def matched(self, mentions: DataFrame, index: KeywordIndex | None = None) -> DataFrame:
        """Mentions that fit; keywords are looked up in ``index`` where there is one, for columns that it carries."""
        return self.apply(mentions) if index is None or self.q is None else index.matches(self)

    def described(self) -> list[Column]:
        """The filters as applied, as columns of a metadata row."""
        return [
            F.lit(self.q).cast("string").alias("q"),
            F.lit(self.source).cast("string").alias("source"),
            F.lit(_text(self.since)).cast("string").alias("from"),
            F.lit(_text(self.until)).cast("string").alias("to"),
            F.lit(UNDATED_NOTE if self.dated else None).cast("string").alias("note"),
        ]


def _instant(moment: dt.datetime) -> Column:
    return F.timestamp_millis(F.lit(round(moment.timestamp() * 1000)))


def _text(moment: dt.datetime | None) -> str | None:
    return moment and moment.isoformat(timespec="milliseconds").replace("+00:00", "Z")


def given(value: object) -> str | None:
    """Text that says something, trimmed."""
    return (value.strip() or None) if isinstance(value, str) else None


def whole_number(value: object, name: str, low: int, high: int, default: int, problems: list[str]) -> int:
    text = given(str(value)) if isinstance(value, int) and not isinstance(value, bool) else given(value)
    if text is None:
        return default
    if not re.fullmatch(r"[0-9]+", text):
        problems.append(f'{name}="{value}" must be a whole number')
        return default
    if not low <= int(text) <= high:
        problems.append(f"{name}={int(text)} is outside {low}-{high}")
        return default
    return int(text)


def _bound(read_millis: int | None, shape: str, raw: str, name: str, problems: list[str]) -> dt.datetime | None:
    if read_millis is None:
        problems.append(f'{name}="{raw}" is no date that can be read as a date (year-month-day, with a time and zone if needed)')
        return None
    moment = dt.datetime.fromtimestamp(0, dt.UTC) + dt.timedelta(milliseconds=read_millis)
    whole_day = name == "to" and shape == dates.DATE_ONLY
    return moment + dt.timedelta(days=1) if whole_day else moment


def read_filters(
    spark: SparkSession,
    problems: list[str],
    q: str | None = None,
    source: str | None = None,
    since: str | None = None,
    until: str | None = None,
) -> Filters:
    """Check arguments, adding to ``problems``.

    Outlet and dates go through the same expressions as ingested records, over one local row that
    Spark evaluates at planning time. A bare date as ``until`` covers that whole day.
    """
    label, since, until = given(source), given(since), given(until)
    texts = {"label": label, "since": since, "until": until}
    row = spark.sql("SELECT :label AS label, :since AS since, :until AS until", args=texts)
    columns = ["source_slug"] if label else []
    if label:
        row = with_outlet(row.withColumn("host", F.lit(None).cast("string")), "label", "host")
    for name in (name for name in ("since", "until") if texts[name]):
        number = F.lit(None).cast("double")
        row = row.withColumn(name, dates.read_published(F.lit("string"), number, F.col(name)))
        columns += [
            F.unix_millis(dates.published_at(F.col(name))).alias(f"{name}_millis"),
            dates.published_shape(F.col(name)).alias(f"{name}_shape"),
        ]
    found = row.select(*columns).first() if columns else None
    start = since and _bound(found["since_millis"], found["since_shape"], since, "from", problems)
    end = until and _bound(found["until_millis"], found["until_shape"], until, "to", problems)
    if start and end and start > end:
        problems.append(f"empty range: from={since} comes after to={until}")
    return Filters(q=given(q), source=label and found["source_slug"], since=start or None, until=end or None)
