"""Time stamps from landed text, and the freshness window."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from entitymart.functions.text import let, strip

# Freshness window and the zone names of mail dates.
FRESH_FOR = timedelta(hours=24)
ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "AST": "-0400", "ADT": "-0300", "EST": "-0500", "EDT": "-0400",
    "CST": "-0600", "CDT": "-0500", "MST": "-0700", "MDT": "-0600",
    "PST": "-0800", "PDT": "-0700",
}
ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?([+-]\d{2}(:\d{2}(:\d{2})?)?)?)?$"
)
# A day by ISO week, long and compact; the day may be left out.
WEEK = r"^(\d{4})(?:-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)(?=$|[T ])"
# The usual long form, which is cast as it is.
PLAIN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:Z|[+-]\d{2}:\d{2})?\z"
MAIL = (
    r"^(?:[A-Za-z]+,?\s+)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{4}|\d{2})\s+(\d{1,2}:\d{2}(?::\d{2})?)"
    r"\s*([+-]\d{4}|[A-Za-z]+)?.*$"
)
# Unit, stems of its name, and how many of it are taken for an age; the first unit found decides.
AGES = [("mins", ["minute", "min"], 50 * 366 * 24 * 60), ("hours", ["hour", "hr"], 50 * 366 * 24), ("days", ["day"], 50 * 366)]


def instant(when: datetime) -> Column:
    """A point in time as a literal, independent of the session zone."""
    when = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
    return F.lit(when)


def days_of_weeks(c: Column) -> Column:
    """ISO text with a leading week date, ``2024-W05-2`` or ``2024W052``, as text with the date.

    Week 1 is that of January 4, and a week without day starts on its Monday. A week or day
    that the year does not have is left as it is, and is then no date.
    """

    def dated(text: Column) -> Column:
        part = [F.regexp_extract(text, WEEK, i) for i in range(1, 6)]
        year, week = part[0].try_cast("int"), F.concat(part[1], part[3]).try_cast("int")
        day = F.coalesce(F.concat(part[2], part[4]).try_cast("int"), F.lit(1))
        first = F.date_trunc("week", F.try_to_timestamp(F.concat(part[0], F.lit("-01-04")), F.lit("yyyy-MM-dd"))).cast("date")
        date = F.date_add(first, (week - 1) * 7 + day - 1)
        # the Thursday of a week is in the week's year
        thursday = F.date_add(first, (week - 1) * 7 + 3)
        known = (week >= 1) & (week <= 53) & day.between(1, 7) & (F.year(thursday) == year)
        rest = F.regexp_replace(text, WEEK, "")
        return F.when(known, F.concat(F.date_format(date, "yyyy-MM-dd"), rest)).otherwise(text)

    return F.when(c.rlike(WEEK), let(c, dated)).otherwise(c)


def parse_iso(c: Column) -> Column:
    """ISO text to a time stamp; text without offset is UTC, other text is null.

    Compact dates and a comma before the fraction are brought to the long form
    first; the offset is always written out, so the session zone has no say.
    """

    def parsed(c: Column) -> Column:
        plain = F.when(F.length(c) == 19, F.concat(c, F.lit("Z"))).otherwise(c).try_cast("timestamp")
        return F.when(c.rlike(r"^\d{4}"), F.when(c.rlike(PLAIN), plain).otherwise(_parse_other_iso(c)))

    return let(c, parsed)


def _parse_other_iso(c: Column) -> Column:
    text = F.replace(days_of_weeks(c), F.lit("Z"), F.lit("+00:00"))
    text = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})(?=$|\D)", "$1-$2-$3")
    text = F.regexp_replace(text, r"^(\S{10}.)(\d{2})(\d{2})(\d{2})?(?=$|[.,+-])", "$1$2:$3:$4")
    text = F.regexp_replace(text, r":(?=$|[.,+-])", ":00")
    text = F.regexp_replace(text, r",(?=\d)", ".")
    text = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")

    def cast(t: Column) -> Column:
        zoned = (
            F.when(F.length(t) == 10, F.concat(t, F.lit("T00:00:00Z")))
            .when(F.substring(t, 11, 40).rlike(r"[+-]"), t)
            .otherwise(F.concat(t, F.lit("Z")))
        )
        full = F.regexp_replace(zoned, r"^(.{10}[T ]\d{2})(?=[+Z-])", "$1:00")
        full = F.regexp_replace(full, r"^(.{10}[T ]\d{2}:\d{2})(?=[+Z-])", "$1:00")
        return F.when(t.rlike(ISO), full.try_cast("timestamp"))

    return let(text, cast)


def parse_mail(c: Column) -> Column:
    """Mail-header date (``Tue, 02 Jan 2024 03:04:05 GMT``); unknown zone is UTC.

    Years of two digits are 1969 to 2068.
    """

    def dated(part: Column) -> Column:
        day, year, clock, zone = [F.get(part, i) for i in range(4)]
        table = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
        zone = F.when(F.substring(zone, 1, 1).isin("+", "-"), zone).otherwise(
            F.coalesce(F.try_element_at(table, F.upper(zone)), F.lit("+0000"))
        )
        clock = F.when(F.length(clock) <= 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
        year = F.when(F.length(year) == 4, year).otherwise(F.concat(F.when(year > "68", F.lit("19")).otherwise(F.lit("20")), year))
        return F.try_to_timestamp(F.concat_ws(" ", day, year, clock, zone), F.lit("d MMM yyyy H:mm:ss Z"))

    # one match finds all parts
    parts = F.split(F.regexp_replace(c, MAIL, "$1 $2|$3|$4|$5|"), r"\|")
    return F.when(c.rlike(MAIL), let(parts, dated))


def parse_age(c: Column, as_of: Column) -> Column:
    """A number, a unit with or without plural, and ``ago``, anywhere in the text.

    An age beyond fifty years is no age of a posting and gives null.
    """
    out = F.lit(None).cast("timestamp")
    for unit, stems, most in reversed(AGES):
        pattern = rf"(?i)(\d+)\s*(?:{'|'.join(stems)})s?\s*ago"
        n = F.regexp_extract(c, pattern, 1).try_cast("int")
        age = F.make_interval(**{unit: F.when(n <= most, n)})
        out = F.when(c.rlike(pattern), as_of - age).otherwise(out)
    return out


def parse_date(c: Column, as_of: Column) -> Column:
    """ISO, else mail date, else relative age, else null."""
    return let(strip(c), lambda t: F.coalesce(parse_iso(t), parse_mail(t), parse_age(t, as_of)))


def is_fresh(ts: Column, as_of: datetime | None) -> Column:
    """Inside the closed window that ends at ``as_of``; null is not fresh.

    Both bounds are literals, so the predicate reaches the file scan. Without
    ``as_of`` the window ends when the query, or a stream's micro-batch, starts.
    """
    if as_of is None:
        return ts.between(F.current_timestamp() - F.lit(FRESH_FOR), F.current_timestamp())
    return ts.between(instant(as_of - FRESH_FOR), instant(as_of))
