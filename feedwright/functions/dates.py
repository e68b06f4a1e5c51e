"""Date parsing: ordered patterns, relative dates and date ranges.

Results are wall-clock timestamps under a UTC session.  "Now" is always a
column or literal that the caller passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedwright.functions.text import collapse_space, strip

#: Ordered patterns of the parsers (fixed values; order decides ambiguous dates).
GENERIC = ("MMMM d, yyyy", "d MMMM yyyy", "yyyy-M-d", "d-M-yyyy", "M/d/yyyy")
WEEKDAY_FORMS = ("yyyy-M-d", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m:s")
WEEKDAY_TIME = ("d MMMM yyyy H:m", "d MMM yyyy H:m", "MMMM d, yyyy", "MMM d, yyyy", "yyyy-M-d", "d MMMM yyyy", "d MMM yyyy")
LIST_FORMS = ("yyyy-M-d H:m:s", "yyyy-M-d", "d MMM yyyy H:m", "d MMMM yyyy H:m", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")
PUBLISHED = ("yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d")
RFC_822 = ("d MMM yyyy H:m:s", "d MMM yyyy H:m")
_WEEKDAY = r"(?i)^(mon|tues?|wed(nes)?|thu(rs)?|fri|sat(ur)?|sun)(day)?,? +"


def parse_any(text: Column, patterns: Sequence[str]) -> Column:
    """The first pattern that the whole text matches; null if none does.  Runs of space count as one."""
    clean = collapse_space(text)
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(p)) for p in patterns])


def without_weekday(text: Column) -> Column:
    """Java's parser rejects weekday names, and the feeds don't check them against the date."""
    return F.regexp_replace(strip(text), _WEEKDAY, "")


def parse_published(text: Column) -> Column:
    """Cut at the first + and ., then three patterns; an offset is dropped, not applied."""
    return parse_any(F.regexp_extract(strip(text), r"(?s)^([^+.]*)", 1), PUBLISHED)


def parse_published_with_offset(text: Column) -> Column:
    """The same, but an offset or Z is applied."""
    return F.coalesce(F.try_to_timestamp(strip(text)), parse_published(text))


def parse_generic(text: Column) -> Column:
    return parse_any(text, GENERIC)


def parse_weekday_forms(text: Column) -> Column:
    return parse_any(without_weekday(text), WEEKDAY_FORMS)


def parse_weekday_time(text: Column) -> Column:
    return parse_any(without_weekday(text), WEEKDAY_TIME)


def parse_list_date(text: Column) -> Column:
    return parse_any(text, LIST_FORMS)


def parse_iso_wall_clock(text: Column) -> Column:
    """T or space between date and time; what follows a + is dropped; else only the date; N/A is null."""
    cut = F.regexp_replace(F.regexp_replace(text, r"(?s)\+.*$", ""), "T", " ")
    return F.when(text != "N/A", F.coalesce(F.try_to_timestamp(cut, F.lit("yyyy-M-d H:m:s")), F.try_to_timestamp(F.regexp_extract(text, r"^([^T ]*)", 1), F.lit("yyyy-M-d"))))


def parse_iso_variants(text: Column) -> Column:
    """Z, +00:00Z, other offsets and fractions are stripped."""
    return F.try_to_timestamp(F.regexp_replace(strip(text), r"(\.\d+)?(Z|[+-]\d{2}:?\d{2}Z?)?$", ""), F.lit("yyyy-M-d'T'H:m:s"))


def parse_bar_date(text: Column) -> Column:
    """'09 Feb, 2026 | 01:03 PM'; null without the bar."""
    joined = F.regexp_replace(strip(text), r"\s*\|\s*", " ")
    return F.when(F.contains(text, F.lit("|")), F.try_to_timestamp(joined, F.lit("d MMM, yyyy h:m a")))


def parse_rfc822(text: Column) -> Column:
    """The wall clock of a pubDate; the zone is dropped, not applied."""
    return parse_any(F.regexp_replace(without_weekday(text), r"(?i) *([+-]\d{4}|[A-Z]{1,5})$", ""), RFC_822)


def parse_after_comma(text: Column) -> Column:
    """'6:23 pm,Thursday July 17, 2025': the date after the first comma."""
    date = without_weekday(F.regexp_extract(text, r"(?s)^[^,]*,(.*)$", 1))
    return parse_any(date, ("MMMM d, yyyy", "MMM d, yyyy"))


def find_date(text: Column) -> Column:
    """The first of three kinds of date that a text contains anywhere."""
    # The kinds and their formats.
    kinds = (
        (r"(?i)(\d{1,2}\s+(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\s+\d{4})", "d MMM yyyy"),
        (r"(?i)(\d{1,2}\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4})", "d MMMM yyyy"),
        (r"(\d{4}-\d{1,2}-\d{1,2})", "yyyy-M-d"),
    )
    return F.coalesce(*[parse_any(F.regexp_extract(text, p, 1), (form,)) for p, form in kinds])


def date_in_url(link: Column) -> Column:
    """/yymmdd/ as a date of this century."""
    return F.try_to_timestamp(F.concat(F.lit("20"), F.nullif(F.regexp_extract(link, r"/(\d{6})/", 1), F.lit(""))), F.lit("yyyyMMdd"))


#: Seconds of the units of relative dates; a month is 30 days and a year 365 (fixed values).
UNITS = {"minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}
#: Substrings that name a unit in Sinhala list pages, in the order in which they are tried (fixed values).
SINHALA_UNITS = (("මිනිත්", "minute"), ("පැය", "hour"), ("දින", "day"), ("සති", "week"), ("මාස", "month"))


def _back(as_of: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(as_of) - seconds)


def relative_date(text: Column, as_of: Column) -> Column:
    """'a day ago', '3 weeks ago' before as_of; else the generic patterns; else null."""
    clean = F.lower(strip(text))
    unit = F.regexp_extract(clean, r"^(?:an?|\d+)\s*(minute|hour|day|week|month|year)s?\s*ago", 1)
    count = F.coalesce(F.regexp_extract(clean, r"^(\d+)", 1).try_cast("long"), F.lit(1))
    seconds = F.lit(None).cast("long")
    for name, size in UNITS.items():
        seconds = F.when(unit == name, count * size).otherwise(seconds)
    return F.coalesce(_back(as_of, seconds), parse_generic(clean))


def search_relative_date(text: Column, as_of: Column) -> Column:
    """The first '<n> minute|hour|day|week|month' anywhere in the text."""
    clean = F.lower(text)
    pattern = r"(\d+)\s*(minute|hour|day|week|month)"
    seconds = F.lit(None).cast("long")
    for name, size in UNITS.items():
        seconds = F.when(F.regexp_extract(clean, pattern, 2) == name, F.regexp_extract(clean, pattern, 1).try_cast("long") * size).otherwise(seconds)
    return _back(as_of, seconds)


def sinhala_relative_date(text: Column, as_of: Column) -> Column:
    """The first number, in the first unit that the text names in Sinhala or English."""
    count = F.regexp_extract(text, r"(\d+)", 1).try_cast("long")
    seconds = F.lit(None).cast("long")
    for needle, unit in reversed(SINHALA_UNITS):
        named = F.contains(text, F.lit(needle)) | F.contains(F.lower(text), F.lit(unit))
        seconds = F.when(named, count * UNITS[unit]).otherwise(seconds)
    return _back(as_of, seconds)


def written(at: Column, as_of: Column | None = None, missing: str | None = None) -> Column:
    """yyyy-MM-dd HH:mm:ss; a missing date is as_of, or a fixed word."""
    value = F.date_format(F.coalesce(at, as_of) if as_of is not None else at, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(value, F.lit(missing)) if missing is not None else value


def default_range(today: Column) -> tuple[Column, Column]:
    return F.date_sub(today, 1), today


def in_range(at: Column, start: Column, end: Column, undated: bool = False) -> Column:
    """Inclusive; null dates are `undated`."""
    return F.coalesce(at.cast("date").between(start, end), F.lit(undated))


def first_date(*tries: tuple[Column, str]) -> tuple[Column, Column]:
    """(date, source): the first try that gives a date, and its name."""
    source = F.lit(None).cast("string")
    for at, name in reversed(tries):
        source = F.when(at.isNotNull(), F.lit(name)).otherwise(source)
    return F.coalesce(*[at for at, _ in tries]), source
