"""Dates and times as Column expressions: calendar values, weeks, editions, clock text, cadences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import decimals

#: Month names as they are printed.
MONTHS = ["Jan.", "Feb.", "March", "April", "May", "June", "July", "Aug.", "Sept.", "Oct.", "Nov.", "Dec."]


def ics_instant(value: Column, zone: Column) -> Column:
    """A calendar date-time as an instant: UTC with Z, midnight for dates, else wall-clock time of the zone."""
    utc = F.try_to_timestamp(value, F.lit("yyyyMMdd'T'HHmmss'Z'"))
    wall = F.coalesce(F.try_to_timestamp(value, F.lit("yyyyMMdd'T'HHmmss")), F.try_to_timestamp(value, F.lit("yyyyMMdd")))
    return F.coalesce(utc, F.to_utc_timestamp(wall, zone))


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def wall_clock(c: Column, zone: str) -> Column:
    return F.date_format(F.from_utc_timestamp(c, zone), "yyyy-MM-dd'T'HH:mm:ss")


def week_start(day: Column) -> Column:
    """The Monday of the day's week."""
    return F.date_trunc("WEEK", day).cast("date")


def anchor(kind: str, publication: Column, offset: int) -> Column:
    base = {"publication": publication, "week_start": week_start(publication), "next_week_start": F.date_add(week_start(publication), 7)}[kind]
    return F.date_add(base, offset)


def phase(now: Column, publication_at: Column, deadline_at: Column) -> Column:
    return F.when(now >= publication_at, F.lit("published")).when(deadline_at.isNotNull() & (now >= deadline_at), F.lit("closed")).otherwise(F.lit("open"))


def cadence_minutes(c: Column, default: int = 60) -> Column:
    n, unit = F.regexp_extract(c, r"^(\d+)([mhd])$", 1), F.regexp_extract(c, r"^(\d+)([mhd])$", 2)
    per = F.when(unit == "h", 60).when(unit == "d", 1440).otherwise(1)
    return F.when(n != "", F.try_to_number(n, F.lit("999999")).cast("long") * per).otherwise(F.lit(default)).cast("long")


def next_edition(now: Column, weekday: int, time: str = "12:00:00") -> Column:
    """The day of the next edition that isn't out: of this week's, or a week later once that has been published. now: a
    wall-clock text; weekday: 0 is Monday."""
    day = F.date_add(week_start(F.to_date(F.substring(now, 1, 10))), weekday)
    return F.when(now >= F.concat(day.cast("string"), F.lit("T" + time)), F.date_add(day, 7)).otherwise(day)


def hours_between(a: Column, b: Column) -> Column:
    """Hours from one wall-clock text to another; null if either is none."""
    at = lambda c: F.unix_seconds(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    return (at(b) - at(a)) / 3600


def parse_stamp(c: Column) -> Column:
    """An instant in its one canonical form, else null."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))


def ago(minutes: Column) -> Column:
    return (
        F.when(minutes < 1, F.lit("less than a minute ago"))
        .when(minutes == 1, F.lit("1 minute ago"))
        .when(minutes < 90, F.concat(minutes.cast("string"), F.lit(" minutes ago")))
        .otherwise(F.concat(F.round(minutes / 60).cast("int").cast("string"), F.lit(" hours ago")))
    )


def relative_hours(hours: Column) -> Column:
    """'in 5 hours', '1 hour ago', 'in 3 days': days from two of them on; half hours and half days are rounded up."""
    size = F.abs(hours)
    whole = F.floor(size + 0.5).cast("int")
    amount = F.when(size < 48, F.concat(whole.cast("string"), F.when(whole == 1, " hour").otherwise(" hours"))).otherwise(F.concat(F.floor(size / 24 + 0.5).cast("int").cast("string"), F.lit(" days")))
    return F.when(hours >= 0, F.concat(F.lit("in "), amount)).otherwise(F.concat(amount, F.lit(" ago")))


def duration(minutes: Column) -> Column:
    """'80 minutes', '3.5 hours', '2.1 days'."""
    return F.when(minutes < 90, F.concat(decimals(minutes, 0), F.lit(" minutes"))).when(minutes < 60 * 48, F.concat(decimals(minutes / 60), F.lit(" hours"))).otherwise(F.concat(decimals(minutes / 1440), F.lit(" days")))


def elapsed_window(hours: Column, window: Column) -> Column:
    """struct(due, reason) of a scrape that is repeated after `window` hours: never made, dated in the future, or old."""
    # the texts are fixed values
    said = F.concat(F.lit("scraped "), decimals(hours), F.lit("h ago, window is "), window.cast("string"), F.lit("h"))
    pair = lambda d, r: F.struct(d.alias("due"), r.alias("reason"))
    return F.when(hours.isNull(), pair(F.lit(True), F.lit("never scraped"))).when(hours < 0, pair(F.lit(True), F.lit("last scrape is dated in the future"))).otherwise(pair(hours >= window, said))


def due(minutes_since: Column, cadence: Column, slack: int = 10) -> Column:
    """No stamp or one in the future is due; else when the wait and the slack reach the cadence."""
    return minutes_since.isNull() | (minutes_since < 0) | (minutes_since + slack >= cadence)


def bare_clock(t: Column) -> Column:
    """h or h:mm on the twelve-hour clock."""
    h = F.concat((F.pmod(F.hour(t) + 11, F.lit(12)) + 1).cast("string"))
    return F.when(F.minute(t) == 0, h).otherwise(F.concat(h, F.lit(":"), F.lpad(F.minute(t).cast("string"), 2, "0")))


def meridiem(t: Column) -> Column:
    return F.when(F.hour(t) < 12, F.lit("a.m.")).otherwise(F.lit("p.m."))


def time_range(start: Column, end: Column) -> Column:
    """'4:30 — 6 p.m.', with the half of the day once where both share it; 'All day' from midnight to a later midnight."""
    midnight = lambda t: (F.hour(t) == 0) & (F.minute(t) == 0)
    whole = midnight(start) & midnight(end) & (end.cast("date") > start.cast("date"))
    one = F.concat_ws(" ", bare_clock(start), meridiem(start))
    both = F.when(meridiem(start) == meridiem(end), bare_clock(start)).otherwise(one)
    return F.when(whole, F.lit("All day")).when(end.isNull(), one).otherwise(F.concat(both, F.lit(" — "), bare_clock(end), F.lit(" "), meridiem(end)))


def pretty_date(day: Column) -> Column:
    return F.date_format(day, "EEEE, MMMM d")


def pretty_clock(t: Column) -> Column:
    return F.concat_ws(" ", F.date_format(t, "h:mm"), meridiem(t))


def short_date(day: Column) -> Column:
    month = F.element_at(F.array(*(F.lit(m) for m in MONTHS)), F.month(day))
    return F.concat(F.date_format(day, "EEEE"), F.lit(", "), month, F.lit(" "), F.dayofmonth(day).cast("string"))
