"""Dates as text.  Nothing here depends on the session time zone."""

from pyspark.sql import functions as F

RFC822_OUT = "EEE, dd MMM yyyy HH:mm:ss"
LOG_OUT = "yyyy-MM-dd HH:mm:ss"


#: Zones by name in mail dates, with their offsets.
ZONES = {
    "GMT": "+0000", "UTC": "+0000", "UT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def _parsed(text, *patterns):
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def _with_offset(text):
    """Cut the weekday and comments; put a numeric offset in place of names."""
    cut = F.regexp_replace(F.trim(text), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+|\s*\([^)]*\)\s*$", "")
    cut = F.regexp_replace(cut, r"\s+", " ")
    name = F.upper(F.regexp_extract(cut, r" ([A-Za-z]{1,3})$", 1))
    offset = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])[name]
    cut = F.when(offset.isNull(), cut).otherwise(
        F.concat(F.regexp_replace(cut, " [A-Za-z]+$", " "), offset)
    )
    # A year of two digits is of the last century from 50 on.
    day = r"^(\d{1,2}[ -][A-Za-z]{3}[ -])"
    cut = F.regexp_replace(cut, day + r"([5-9]\d )", "$119$2")
    cut = F.regexp_replace(cut, day + r"([0-4]\d )", "$120$2")
    return F.when(cut.rlike(r"[+-]\d{2}:?\d{2}$"), cut).otherwise(
        F.concat(cut, F.lit(" +0000"))
    )


def rfc822(text):
    """FN-16: mail-style date to an instant, NULL where it is none."""
    return _parsed(
        _with_offset(text),
        "d MMM yyyy HH:mm:ss Z",
        "d MMM yyyy HH:mm Z",
    )


def iso8601(text):
    """Dates of the Atom dialect and of database text."""
    plain = F.regexp_replace(
        F.regexp_replace(F.trim(text), "T", " "), r"(?i)\s*Z$", " +0000"
    )
    plain = F.regexp_replace(plain, r"\.\d+", "")
    plain = F.regexp_replace(plain, r"\s*([+-]\d{2}):?(\d{2})$", " $1$2")
    plain = F.when(plain.rlike(r" [+-]\d{4}$"), plain).otherwise(
        F.concat(plain, F.lit(" +0000"))
    )
    return _parsed(plain, "yyyy-MM-dd HH:mm:ss Z", "yyyy-MM-dd HH:mm Z")


def tweet_date(text):
    """FN-16: ``Mon Jan 01 00:00:00 +0000 2024``; other mail-style dates too."""
    return F.coalesce(
        _parsed(F.substring(text, 5, 64), "MMM d HH:mm:ss Z yyyy"), rfc822(text)
    )


def mail_date(text):
    """FN-17 (Q-16: the zone is honoured, not dropped): mail-style and ISO dates, those
    of RFC 850 and asctime, months in full, slashes, and days without a time."""
    other = _parsed(
        _with_offset(text),
        "d-MMM-yyyy HH:mm:ss Z",
        "MMM d HH:mm:ss yyyy Z",
        "d MMMM yyyy HH:mm:ss Z",
        "MMM d, yyyy HH:mm:ss Z",
        "MMMM d, yyyy HH:mm:ss Z",
        "d MMM yyyy Z",
        "MMMM d, yyyy Z",
        "yyyy/MM/dd HH:mm:ss Z",
        "yyyy-MM-dd Z",
    )
    return F.coalesce(rfc822(text), iso8601(text), other)


def _utc_clock(instant):
    return F.to_utc_timestamp(instant, F.current_timezone())


def rfc822_text(instant):
    """FN-16, writing side."""
    return F.concat(F.date_format(_utc_clock(instant), RFC822_OUT), F.lit(" +0000"))


def log_text(instant):
    """FN-17/18, writing side."""
    return F.date_format(_utc_clock(instant), LOG_OUT)


def utc_day(instant):
    """Calendar day of an instant, for partitions of a table."""
    return F.to_date(_utc_clock(instant))


def instant(epoch_seconds):
    """FN-18: a moment given as a parameter; operators never read a clock."""
    column = (
        F.lit(int(epoch_seconds)) if isinstance(epoch_seconds, int) else epoch_seconds
    )
    return F.timestamp_seconds(column)
