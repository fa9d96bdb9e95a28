"""Publication dates in six shapes to one instant, and local-day arithmetic.

Nothing here depends on the session time zone: instants are built from text with an explicit
offset, and days are counted from the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsfold.functions.binding import bind
from newsfold.functions.text import trim_whitespace

REPORT_ZONE = "Asia/Kuala_Lumpur"
REPORT_OFFSET_SECONDS = 8 * 3600  # UTC+8 without daylight saving for all accepted years
DAY_SECONDS = 24 * 3600

# Names of the date shapes.
ISO_ZONED = "iso-dengan-zona"
ISO_UNZONED = "iso-tanpa-zona"
UNIX_NUMBER = "angka-unix"
DATE_ONLY = "tanggal-saja"
DAY_MONTH_YEAR = "hari-bulan-tahun"
MISSING = "tidak-ada"
UNREADABLE = "gagal-dibaca"

# Patterns of the date shapes, and the accepted years.
ISO_CLOCK = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2})?(\.[0-9]+)?"
ISO_ZONE = r"\s*(Z|[+-][0-9]{2}:?[0-9]{2})$"
ISO_ZONED_TEXT = f"(?i){ISO_CLOCK}{ISO_ZONE}"
ISO_UNZONED_TEXT = f"{ISO_CLOCK}$"
DATE_ONLY_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SLASHED_TEXT = r"^([0-9]{1,2})[/\-.]([0-9]{1,2})[/\-.]([0-9]{4})$"
UNIX_TEXT = r"^[0-9]{10,13}$"
FIRST_MILLIS = 946_684_800_000  # 2000-01-01T00:00:00.000Z
LAST_MILLIS = 4_133_980_799_999  # 2100-12-31T23:59:59.999Z
MILLIS_ABOVE = 1e11


def _utc_millis(text: Column) -> Column:
    return F.unix_millis(text.try_cast("timestamp"))


def _unix_millis(value: Column) -> Column:
    millis = F.when(F.abs(value) > MILLIS_ABOVE, value).otherwise(value * 1000)
    in_range = (millis > FIRST_MILLIS - 1) & (millis < LAST_MILLIS + 1)
    return F.when(in_range, millis.cast("bigint"))


def _iso_millis(text: Column, zoned: bool) -> Column:
    """The layout up to the minutes is fixed, so only the tail is looked at."""
    clock = F.regexp_replace(text, f"(?i){ISO_ZONE}", "") if zoned else text
    seconds = F.when(F.length(clock) == 16, F.lit(":00")).otherwise(F.substr(clock, F.lit(17)))
    instant = F.concat(F.substring(clock, 1, 10), F.lit("T"), F.substring(clock, 12, 5), seconds, F.lit("Z"))
    millis = _utc_millis(instant)
    if not zoned:
        return millis
    digits = F.replace(F.right(text, F.lit(6)), F.lit(":"), F.lit(""))
    hours = F.substr(digits, F.length(digits) - 3, F.lit(2)).try_cast("int")
    minutes = F.right(digits, F.lit(2)).try_cast("int")
    ahead = F.when(F.contains(F.right(text, F.lit(6)), F.lit("-")), -1).otherwise(1)
    shift = F.when(F.lower(F.right(text, F.lit(1))) == "z", F.lit(0)).when(
        (hours < 24) & (minutes < 60), (hours * 60 + minutes) * ahead
    )
    return millis - shift.cast("bigint") * 60_000


def _local_midnight_millis(year: Column, month: Column, day: Column) -> Column:
    date = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return _utc_millis(F.concat(date, F.lit("T00:00:00Z"))) - REPORT_OFFSET_SECONDS * 1000


def _slashed_millis(text: Column) -> Column:
    first, second, year = (F.regexp_extract(text, SLASHED_TEXT, group) for group in (1, 2, 3))
    month_first = (second.try_cast("int") > 12) & (first.try_cast("int") <= 12)
    return _local_midnight_millis(
        year, F.when(month_first, first).otherwise(second), F.when(month_first, second).otherwise(first)
    )


def read_published(kind: Column, number: Column, text: Column) -> Column:
    """STRUCT(millis, shape) of a JSON value given its kind, its number and its text.

    ``kind`` is ``string``, ``number``, ``null`` or anything else for other JSON types. A value that
    has a known shape but no real date, or a year outside 2000..2100, comes out unreadable.
    """

    def found(millis: Column, shape: str) -> Column:
        return F.struct(millis.cast("bigint").alias("millis"), F.lit(shape).alias("shape"))

    nothing = F.lit(None)

    def of_text(t: Column) -> Column:
        return (
            F.when(t == "", found(nothing, MISSING))
            .when(t.rlike(UNIX_TEXT), found(_unix_millis(t.try_cast("double")), UNIX_NUMBER))
            .when(t.rlike(ISO_ZONED_TEXT), found(_iso_millis(t, True), ISO_ZONED))
            .when(t.rlike(ISO_UNZONED_TEXT), found(_iso_millis(t, False), ISO_UNZONED))
            .when(
                t.rlike(DATE_ONLY_TEXT),
                found(
                    _local_midnight_millis(*(F.split_part(t, F.lit("-"), F.lit(part)) for part in (1, 2, 3))),
                    DATE_ONLY,
                ),
            )
            .when(t.rlike(SLASHED_TEXT), found(_slashed_millis(t), DAY_MONTH_YEAR))
            .otherwise(found(nothing, UNREADABLE))
        )

    def of_kind(k: Column) -> Column:
        return (
            F.when(k == "null", found(nothing, MISSING))
            .when(k == "number", found(bind(number, _unix_millis), UNIX_NUMBER))
            .when(k == "string", bind(trim_whitespace(text), of_text))
            .otherwise(found(nothing, UNREADABLE))
        )

    def accepted(read: Column) -> Column:
        known = read["millis"].between(FIRST_MILLIS, LAST_MILLIS) | (read["shape"] == MISSING)
        return F.when(known, read).otherwise(found(nothing, UNREADABLE))

    return bind(bind(kind, of_kind), accepted)


def published_at(read: Column) -> Column:
    """The instant of a :func:`read_published` struct."""
    return F.timestamp_millis(read["millis"])


def published_shape(read: Column) -> Column:
    return read["shape"]


def _local_seconds(instant: Column) -> Column:
    return F.unix_seconds(instant) + REPORT_OFFSET_SECONDS


def _date_of(seconds: Column) -> Column:
    return F.date_from_unix_date(F.floor(seconds / DAY_SECONDS).cast("int"))


def local_day(instant: Column) -> Column:
    """``YYYY-MM-DD`` in the report zone, null for null."""
    return _date_of(_local_seconds(instant)).cast("string")


def _clock(seconds: Column) -> tuple[Column, Column, Column]:
    of_day = F.pmod(seconds, F.lit(DAY_SECONDS))
    parts = (F.floor(of_day / 3600), F.floor(F.pmod(of_day, F.lit(3600)) / 60), F.pmod(of_day, F.lit(60)))
    return tuple(F.lpad(part.cast("string"), 2, "0") for part in parts)


def local_display_time(instant: Column) -> Column:
    """``10 Aug, 16:15`` in the report zone, null for null."""
    seconds = _local_seconds(instant)
    hours, minutes, _ = _clock(seconds)
    return F.concat(F.date_format(_date_of(seconds), "dd MMM"), F.lit(", "), hours, F.lit(":"), minutes)


def iso_utc(instant: Column) -> Column:
    """``2026-08-10T08:15:00.000Z``, null for null."""
    seconds = F.unix_seconds(instant)
    millis = F.lpad(F.pmod(F.unix_millis(instant), F.lit(1000)).cast("string"), 3, "0")
    return F.concat(
        _date_of(seconds).cast("string"), F.lit("T"), F.concat_ws(":", *_clock(seconds)), F.lit("."), millis, F.lit("Z")
    )
