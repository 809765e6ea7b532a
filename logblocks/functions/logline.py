"""Column expressions that turn one raw line into typed fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severities the line parser knows; all others read UNKNOWN.
KNOWN_SEVERITIES = ("INFO", "WARN")

# Digits of a date and of a clock time, each part within its range.
DAY_SHAPE = "^[0-9]{2}(0[1-9]|1[0-2])(0[1-9]|[12][0-9]|3[01])$"
CLOCK_SHAPE = "^([01][0-9]|2[0-3])[0-5][0-9][0-5][0-9]([.,][0-9]+)?$"

TOO_FEW_PARTS = "too few parts"
BAD_TIMESTAMP = "timestamp"
BAD_PID = "pid"


def epoch_seconds(day: Column, clock: Column) -> Column:
    """``yyMMdd`` and ``HHmmss`` as UTC epoch seconds; null when out of range.

    Years 69-99 are 19xx. A fraction after the seconds is accepted and dropped.
    Built from calendar arithmetic, so the session time zone plays no part.
    """

    def two(text: Column, start: int) -> Column:
        return F.substring(text, start, 2).try_cast("int")

    shaped = day.rlike(DAY_SHAPE) & clock.rlike(CLOCK_SHAPE)
    century = F.when(day >= "69", 1900).otherwise(2000)
    first = F.make_date(two(day, 1) + century, two(day, 3), F.lit(1))
    date = F.date_add(first, two(day, 5) - 1)
    seconds = two(clock, 1) * 3600 + two(clock, 3) * 60 + two(clock, 5)
    inside_month = F.month(date) == two(day, 3)
    return F.when(shaped, F.when(inside_month, F.unix_date(date).cast("bigint") * 86400 + seconds))


def process_id(text: Column) -> Column:
    """Signed 64-bit decimal, wrapped to 32 bits; null when it is not a number."""
    wide = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))
    return F.shiftright(F.shiftleft(wide, 32), 32).cast("int")


def severity_name(text: Column) -> Column:
    return F.when(text.isin(*KNOWN_SEVERITIES), text).otherwise("UNKNOWN")


def component_name(text: Column) -> Column:
    """Drops one trailing colon."""
    return F.regexp_replace(text, ":\\z", "")


def message_text(parts: Column) -> Column:
    return F.array_join(F.slice(parts, 6, F.greatest(F.size(parts) - 5, F.lit(0))), " ")
