"""Time arithmetic on wall-clock timestamps (timestamp_ntz): relative shifts,
calendar differences, time zones and text in mixed formats.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewloom.functions.binding import let

# Month names of mail dates.
MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def time_of_day(ts: Column) -> Column:
    """Interval since midnight."""
    return ts - F.to_date(ts).cast("timestamp_ntz")


def _seconds(ts: Column) -> Column:
    """Second of the minute with its fraction."""
    return F.extract(F.lit("SECOND"), ts)


def shift_months(ts: Column, months: Column) -> Column:
    """Add months, clipped to the month's last day; the time of day stays."""
    return F.add_months(F.to_date(ts), months.cast("int")).cast("timestamp_ntz") + time_of_day(ts)


def shift(
    ts: Column,
    *,
    years=0,
    months=0,
    weeks=0,
    days=0,
    hours=0,
    minutes=0,
    seconds=0,
    microseconds=0,
    leapdays=0,
    year=None,
    month=None,
    day=None,
    hour=None,
    minute=None,
    second=None,
    microsecond=None,
    weekday: tuple[int, int] | int | None = None,
    yearday: int | None = None,
    nlyearday: int | None = None,
) -> Column:
    """Move a timestamp. Singular fields are set first, then years and months are
    added with month-end clipping, then the fixed-length units, and last the result
    moves to the ``weekday`` (0 = Monday) or its (weekday, n) n-th one on or after
    (n > 0) or on or before (n < 0). ``yearday`` sets the day of the year,
    ``nlyearday`` the same without counting a leap day. Amounts may be columns.
    """
    if yearday is not None or nlyearday is not None:
        number = yearday if nlyearday is None else nlyearday
        if yearday is not None and nlyearday is None and number > 59:
            leapdays = -1
        fixed = date(2001, 1, 1) + timedelta(days=min(number, 365) - 1)
        month, day = fixed.month, (32 if number == 366 else fixed.day)
    base = F.to_date(ts)
    target = F.make_date(
        (_c(year) if year is not None else F.year(base)).cast("int"),
        (_c(month) if month is not None else F.month(base)).cast("int"),
        F.lit(1),
    )
    target = F.add_months(target, (_c(years) * 12 + _c(months)).cast("int"))
    wanted = _c(day) if day is not None else F.dayofmonth(base)
    target = F.date_add(target, (F.least(wanted, F.dayofmonth(F.last_day(target))) - 1).cast("int"))
    if not (isinstance(leapdays, int) and leapdays == 0):
        leap = F.dayofyear(F.make_date(F.year(target), F.lit(12), F.lit(31))) == 366
        extra = F.when(leap & (F.month(target) > 2), _c(leapdays)).otherwise(0)
        days = _c(days) + extra
    if hour is None and minute is None and second is None and microsecond is None:
        clock = time_of_day(ts)
    else:
        whole = F.second(ts) if second is None else _c(second)
        part = _seconds(ts) - F.second(ts) if microsecond is None else _c(microsecond) / F.lit(1e6)
        clock = F.make_dt_interval(
            hours=F.hour(ts) if hour is None else _c(hour),
            mins=F.minute(ts) if minute is None else _c(minute),
            secs=(whole + part).cast("decimal(18,6)"),
        )
    fixed = F.make_dt_interval(
        days=(_c(weeks) * 7 + _c(days)).cast("int"),
        hours=_c(hours).cast("int"),
        mins=_c(minutes).cast("int"),
        secs=(_c(seconds) + _c(microseconds) / F.lit(1e6)).cast("decimal(18,6)"),
    )
    moved = target.cast("timestamp_ntz") + clock + fixed
    if weekday is None:
        return moved
    wd, n = weekday if isinstance(weekday, tuple) else (weekday, 1)
    now = F.weekday(moved)
    if n > 0:
        jump = F.pmod(F.lit(wd) - now, F.lit(7)) + (n - 1) * 7
    else:
        jump = -(F.pmod(now - F.lit(wd), F.lit(7)) + (-n - 1) * 7)
    return moved + F.make_dt_interval(days=jump)


def difference(later: Column, earlier: Column) -> Column:
    """``later - earlier`` in whole years, months, days, hours, minutes, seconds and
    microseconds, all of one sign."""

    def split(total: Column, rest: Column) -> Column:
        part = lambda name: F.extract(F.lit(name), rest)
        seconds = part("SECOND")
        fields = {
            "years": F.call_function("div", total, F.lit(12)),
            "months": total % 12,
            "days": part("DAY"),
            "hours": part("HOUR"),
            "minutes": part("MINUTE"),
            "seconds": seconds.cast("bigint"),
            "microseconds": (seconds % 1) * 1_000_000,
        }
        return F.struct(*[v.cast("bigint").alias(k) for k, v in fields.items()])

    def whole_months(rough: Column) -> Column:
        step = lambda reached: F.when((later >= earlier) & (later < reached), -1).when(
            (later < earlier) & (later > reached), 1
        )
        return rough + F.coalesce(let(shift_months(earlier, rough), step), F.lit(0))

    months = (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    total = let(months, whole_months)
    return let(total, lambda n: let(later - shift_months(earlier, n), lambda rest: split(n, rest)))


# --- zones ----------------------------------------------------------------


def wall_to_utc(wall: Column, zone) -> Column:
    """UTC of a wall time. In a gap the wall time first moves forward by the gap;
    of two candidates the earlier instant is taken."""
    return F.convert_timezone(_c(zone), F.lit("UTC"), wall)


def utc_to_wall(utc: Column, zone) -> Column:
    return F.convert_timezone(F.lit("UTC"), _c(zone), utc)


def resolve_gap(wall: Column, zone) -> Column:
    """The wall time that clocks really show: unchanged unless it falls in a gap."""
    return utc_to_wall(wall_to_utc(wall, zone), zone)


def wall_exists(wall: Column, zone) -> Column:
    return resolve_gap(wall, zone) == wall


def overlap(wall: Column, zone) -> Column:
    """How far clocks go back around this wall time (a day on either side); an
    interval of 0 or less when they do not."""
    one_day = F.expr("interval 1 day")
    offset = lambda t: t - wall_to_utc(t, zone)
    return offset(wall - one_day) - offset(wall + one_day)


def wall_is_ambiguous(wall: Column, zone) -> Column:
    """Does the wall time happen twice."""
    back = overlap(wall, zone)
    second = utc_to_wall(wall_to_utc(wall, zone) + back, zone)
    return (back > F.make_dt_interval()) & (second == wall)


def within(a: Column, b: Column, seconds: float) -> Column:
    """Are two times at most so many seconds apart, either way round."""
    reach = F.make_dt_interval(secs=F.lit(abs(seconds)).cast("decimal(18,6)"))
    return (a - b).between(-reach, reach)


# --- text -----------------------------------------------------------------

_EPOCH = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DATES = {
    "iso": r"\d{4}-\d{2}-\d{2}",
    "iso_basic": r"\d{8}(?=T)",
    "iso_week": r"\d{4}-?W\d{2}(?:-?\d)?",
    "iso_ordinal": r"\d{4}-?\d{3}",
    "iso_month": r"\d{4}-\d{2}(?=$)",
}
_CLOCK = r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?"
_ISO = rf"^([0-9W-]+){_CLOCK}$"
_MAIL = (
    r"(?i)^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+)?(\d{1,2})\s+("
    + "|".join(MONTH_NAMES)
    + r")[a-z]*\s+(\d{4})\s+(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[a-z]{1,5})?$"
)


def time_format(text: Column) -> Column:
    """Which known format a timestamp text has; null when none fits."""
    label = F.when(text.rlike(_EPOCH), "epoch")
    for name, pattern in _DATES.items():
        label = label.when(text.rlike(f"^{pattern}{_CLOCK}$"), name)
    return label.when(text.rlike(_MAIL), "mail")


def _date_from(label: Column, a: Column, b: Column, c: Column) -> Column:
    """Day from year and (month, day), (week, weekday) or (day of year); null when
    a part is out of range."""
    year = F.when(a.between(1, 9999), a)
    first = F.when((label != "iso_week") & b.between(1, 12), F.make_date(year, b, F.lit(1)))
    calendar = F.when(c.between(1, F.dayofmonth(F.last_day(first))), F.date_add(first, c - 1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_sub(fourth, F.weekday(fourth))
    week = F.when(b.between(1, 53) & c.between(1, 7), F.date_add(monday, (b - 1) * 7 + c - 1))
    size = F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))
    ordinal = F.when(b.between(1, size), F.date_add(F.make_date(year, F.lit(1), F.lit(1)), b - 1))
    return F.when(label == "iso_week", week).when(label == "iso_ordinal", ordinal).otherwise(calendar)


def read_time(text: Column) -> Column:
    """struct<format, parsed>: the format of a text and its UTC wall time. It reads
    epoch seconds, ISO 8601 (calendar, basic, week and ordinal dates) and mail dates.
    No offset means UTC; 24:00 is the next midnight; unreadable texts give null."""
    whole = lambda x: x.try_cast("int")

    def pieces(t: Column, label: Column) -> Column:
        mail = label == "mail"

        def piece(iso_group: int, mail_group: int | None) -> Column:
            from_mail = F.lit("") if mail_group is None else F.regexp_extract(t, _MAIL, mail_group)
            return F.nullif(F.when(mail, from_mail).otherwise(F.regexp_extract(t, _ISO, iso_group)), F.lit(""))

        return F.struct(
            F.regexp_replace(F.regexp_extract(t, _ISO, 1), "[-W]", "").alias("date"),
            whole(F.coalesce(piece(2, 4), F.lit("0"))).alias("hour"),
            whole(F.coalesce(piece(3, 5), F.lit("0"))).alias("minute"),
            whole(F.coalesce(piece(4, 6), F.lit("0"))).alias("second"),
            whole(F.rpad(F.substring(F.coalesce(piece(5, None), F.lit("")), 1, 6), 6, "0")).alias("micro"),
            F.coalesce(piece(6, 7), F.lit("")).alias("offset"),
        )

    def day_of(t: Column, label: Column, p: Column) -> Column:
        digits = lambda start, length: whole(F.nullif(F.substring(p["date"], start, length), F.lit("")))
        names = F.array(*[F.lit(m) for m in MONTH_NAMES])
        month = F.array_position(names, F.lower(F.substring(F.regexp_extract(t, _MAIL, 2), 1, 3))).cast("int")
        parts = F.when(
            label == "mail",
            F.array(whole(F.regexp_extract(t, _MAIL, 3)), month, whole(F.regexp_extract(t, _MAIL, 1))),
        ).otherwise(
            F.array(
                digits(1, 4),
                F.when(label == "iso_ordinal", digits(5, 3)).otherwise(digits(5, 2)),
                F.when(label.isin("iso_week", "iso_month"), F.coalesce(digits(7, 1), F.lit(1))).otherwise(digits(7, 2)),
            )
        )
        return let(parts, lambda a: _date_from(label, F.get(a, F.lit(0)), F.get(a, F.lit(1)), F.get(a, F.lit(2))))

    def moment(t: Column, label: Column, p: Column) -> Column:
        zone = F.regexp_replace(p["offset"], "[^0-9]", "")
        east = whole(F.substring(zone, 1, 2)) * 60 + F.coalesce(whole(F.substring(zone, 3, 2)), F.lit(0))
        east = F.coalesce(F.when(F.startswith(p["offset"], F.lit("-")), -east).otherwise(east), F.lit(0))
        h, m, s = p["hour"], p["minute"], p["second"]
        legal = ((h < 24) & (m < 60) & (s < 60)) | ((h == 24) & (m + s + p["micro"] == 0))
        clock = F.make_dt_interval(
            hours=h, mins=m - east, secs=(s + p["micro"] / F.lit(1e6)).cast("decimal(18,6)")
        )
        return F.when(legal, day_of(t, label, p).cast("timestamp_ntz") + clock)

    def epoch(number: Column) -> Column:
        day = F.floor(number / 86400)
        at = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz") + F.make_dt_interval(
            secs=(number - day * 86400).cast("decimal(18,6)")
        )
        # The years 1 to 9999.
        return F.when(number.between(-62135596800, 253402300799), at)

    def parse(t: Column, label: Column) -> Column:
        calendar = F.when(label.isNotNull(), let(pieces(t, label), lambda p: moment(t, label, p)))
        parsed = F.when(label == "epoch", let(t.try_cast("double"), epoch)).otherwise(calendar)
        return F.struct(label.alias("format"), parsed.alias("parsed"))

    return let(F.trim(text), lambda t: let(time_format(t), lambda label: parse(t, label)))
