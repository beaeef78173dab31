"""Recurrence rules as rows, expanded into occurrences.

A rule table has ``rule_id``, ``freq``, ``dtstart`` (timestamp_ntz) and at least
one of ``until`` (inclusive) and ``count``. Optional columns: ``interval``,
``wkst`` (0 = Monday), and the filters ``bymonth``, ``bymonthday``, ``byyearday``,
``byweekno``, ``byweekday`` (array of struct<wd,n>, n null for every week),
``byeaster``, ``byhour``, ``byminute``, ``bysecond``, ``bysetpos``.

A rule row unfolds into its periods, a period into the days that pass the
filters, a day into its times. All of that is row-local; only sub-daily rules
are spread over the cluster between periods and times, since one of them can
hold most occurrences. A short rule is cut to its ``count`` in its own row too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions.binding import let
from viewloom.operators.asof import nearest
from viewloom.operators.ordered import row_position
from viewloom.session import cut_lineage

DAY_FREQS = ("YEARLY", "MONTHLY", "WEEKLY", "DAILY")
TIME_FREQS = {"HOURLY": 3600, "MINUTELY": 60, "SECONDLY": 1}

_INTS = ("bymonth", "bymonthday", "byyearday", "byweekno", "byeaster", "byhour", "byminute", "bysecond", "bysetpos")
LAST_DAY = "9999-12-31"


def weekday_set(*entries: int | tuple[int, int]) -> Column:
    """``weekday_set(0, (4, -1))``: every Monday and the last Friday."""
    pairs = [(e, None) if isinstance(e, int) else e for e in entries]
    return F.array(
        *[F.struct(F.lit(wd).alias("wd"), F.lit(n).cast("int").alias("n")) for wd, n in pairs]
    )


def _complete(rules: DataFrame) -> DataFrame:
    """Add the optional columns and the defaults taken from the start."""
    have = set(rules.columns)
    df = rules
    for name in _INTS:
        kind = "array<int>"
        df = df.withColumn(name, F.col(name).cast(kind) if name in have else F.lit(None).cast(kind))
    kind = "array<struct<wd:int,n:int>>"
    df = df.withColumn(
        "byweekday", F.col("byweekday").cast(kind) if "byweekday" in have else F.lit(None).cast(kind)
    )
    df = df.withColumn("interval", F.coalesce(F.col("interval"), F.lit(1)) if "interval" in have else F.lit(1))
    df = df.withColumn("wkst", F.coalesce(F.col("wkst"), F.lit(0)) if "wkst" in have else F.lit(0))
    df = df.withColumn("freq", F.upper("freq"))

    start = F.col("dtstart")
    picks_days = F.coalesce("bymonthday", "byyearday", "byweekno", "byeaster").isNotNull() | F.col(
        "byweekday"
    ).isNotNull()
    plain = ~picks_days
    yearly, monthly, weekly = (F.col("freq") == f for f in DAY_FREQS[:3])
    # An entry with a number counts weeks in the month or year, others any week.
    counted = F.col("freq").isin("YEARLY", "MONTHLY")
    any_week = F.filter("byweekday", lambda e: e["n"].isNull() | (e["n"] == 0) | ~counted)
    one_week = F.filter("byweekday", lambda e: (e["n"] != 0) & counted)
    wide = F.when(F.size(any_week) > 0, F.transform(any_week, lambda e: e["wd"]))
    wide = F.when(plain & weekly, F.array(F.weekday(start))).otherwise(wide)
    return df.withColumns(
        {
            "simple": plain & F.col("bymonth").isNull(),
            "weekdays": wide,
            "nth_weekdays": F.when(F.size(one_week) > 0, one_week),
            "bymonth": F.when(
                plain & yearly & F.col("bymonth").isNull(), F.array(F.month(start))
            ).otherwise(F.col("bymonth")),
            "bymonthday": F.when(plain & (yearly | monthly), F.array(F.dayofmonth(start))).otherwise(
                F.col("bymonthday")
            ),
        }
    )


# --- calendar arithmetic --------------------------------------------------


def week_start(day: Column, wkst: Column) -> Column:
    return F.date_sub(day, F.pmod(F.weekday(day) - wkst, F.lit(7)))


def week_number(day: Column, wkst: Column) -> tuple[Column, Column]:
    """Number of the day's week and weeks in that week's year, for any first
    weekday. A week belongs to the year that holds its fourth day."""
    fourth = F.date_add(week_start(day, wkst), 3)
    number = F.floor((F.dayofyear(fourth) - 1) / 7) + 1
    # The last week of a year is the one that holds 28 December.
    last = F.date_add(week_start(F.make_date(F.year(fourth), F.lit(12), F.lit(28)), wkst), 3)
    return number, F.floor((F.dayofyear(last) - 1) / 7) + 1


def easter(year: Column) -> Column:
    """Western Easter Sunday, by the anonymous Gregorian computus."""
    a, b, c = year % 19, F.floor(year / 100), year % 100
    moon = (19 * a + b - F.floor(b / 4) - F.floor((b - F.floor((b + 8) / 25) + 1) / 3) + 15) % 30
    shift = (32 + 2 * (b % 4) + 2 * F.floor(c / 4) - moon - c % 4) % 7
    late = F.floor((a + 11 * moon + 22 * shift) / 451)
    total = moon + shift - 7 * late + 114
    return F.make_date(year, F.floor(total / 31).cast("int"), (total % 31 + 1).cast("int"))


def _month_length(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def _either_end(wanted: Column, position: Column, size: Column) -> Column:
    """Is the 1-based position wanted, counted from the front or (negative) the back."""
    return F.array_contains(wanted, position) | F.array_contains(wanted, position - size - 1)


def day_passes(day: Column, filters: set[str]) -> Column:
    """The day filters of the rule in the current row; a null filter passes."""

    def unless_absent(name: str, test: Column) -> Column:
        return F.col(name).isNull() | test

    year_length = F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31)))

    by_month = (F.col("freq") == "MONTHLY") | ((F.col("freq") == "YEARLY") & F.col("bymonth").isNotNull())
    place = F.when(by_month, F.dayofmonth(day)).otherwise(F.dayofyear(day))
    extent = F.when(by_month, _month_length(day)).otherwise(year_length)
    from_front = F.floor((place - 1) / 7) + 1
    from_back = -(F.floor((extent - place) / 7) + 1)
    on_nth = F.exists(
        "nth_weekdays",
        lambda e: (e["wd"] == F.weekday(day)) & ((e["n"] == from_front) | (e["n"] == from_back)),
    )
    passes = (
        unless_absent("bymonth", F.array_contains("bymonth", F.month(day)))
        & unless_absent("bymonthday", _either_end(F.col("bymonthday"), F.dayofmonth(day), _month_length(day)))
        & unless_absent("weekdays", F.array_contains("weekdays", F.weekday(day)))
        & unless_absent("nth_weekdays", on_nth)
    )
    if "byyearday" in filters:
        passes &= unless_absent("byyearday", _either_end(F.col("byyearday"), F.dayofyear(day), year_length))
    if "byweekno" in filters:
        number, weeks = (c.cast("int") for c in week_number(day, F.col("wkst")))
        passes &= unless_absent("byweekno", _either_end(F.col("byweekno"), number, weeks))
    if "byeaster" in filters:
        passes &= unless_absent(
            "byeaster", F.array_contains("byeaster", F.date_diff(day, easter(F.year(day))))
        )
    return passes


# --- expansion ------------------------------------------------------------


def _unfold(df: DataFrame, name: str, array: Column, keep: list[str]) -> DataFrame:
    """Explode without nulls. The outer form keeps the optimizer from adding a
    size check that would compute the array a second time."""
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def _at(day: Column, second: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=second)


def _sum_sets(base: Column, more: Column, scale: int) -> Column:
    return F.flatten(F.transform(base, lambda b: F.transform(more, lambda m: b + m * scale)))


def _day_times() -> Column:
    """Seconds of the day at which a daily or coarser rule fires, ascending."""
    start = F.col("dtstart")
    hours = F.transform(F.coalesce("byhour", F.array(F.hour(start))), lambda h: h * 3600)
    minutes = F.coalesce("byminute", F.array(F.minute(start)))
    seconds = F.coalesce("bysecond", F.array(F.second(start)))
    return F.array_distinct(F.array_sort(_sum_sets(_sum_sets(hours, minutes, 60), seconds, 1)))


def _pick_positions(times: Column) -> Column:
    """The members at ``bysetpos`` (1-based, negative from the end) of a sorted set."""
    picked = F.transform("bysetpos", lambda p: F.try_element_at(times, p))
    return F.array_sort(F.array_distinct(F.filter(picked, lambda t: t.isNotNull())))


def _last_period() -> Column:
    """The number of the rule's last period, from 0."""
    start, until = F.to_date("dtstart"), F.to_date("until")
    step, freq = F.col("interval"), F.col("freq")
    months = lambda d: F.year(d) * 12 + F.month(d)
    return (
        F.when(freq == "YEARLY", F.floor((F.year(until) - F.year(start)) / step))
        .when(freq == "MONTHLY", F.floor((months(until) - months(start)) / step))
        .when(freq == "WEEKLY", F.floor(F.date_diff(until, week_start(start, F.col("wkst"))) / (step * 7)))
        .when(freq == "DAILY", F.floor(F.date_diff(until, start) / step))
    )


def _periods() -> Column:
    """The numbers of the rule's periods; null if it ends before it starts."""
    return F.when(F.col("until") >= F.col("dtstart"), F.sequence(F.lit(0).cast("bigint"), _last_period()))


def _candidates(period: Column) -> Column:
    """The days of a period that may pass the filters; without filters that is the one day which does."""
    start, freq = F.to_date("dtstart"), F.col("freq")
    first_week = week_start(start, F.col("wkst"))
    month_one = F.trunc(start, "month")
    i = (period * F.col("interval")).cast("int")
    # A yearly rule of one month looks at that month's days only.
    one_month = F.when(F.size("bymonth") == 1, F.get("bymonth", F.lit(0)))
    first_month, last_month = F.coalesce(one_month, F.lit(1)), F.coalesce(one_month, F.lit(12))
    begin = (
        F.when(freq == "YEARLY", F.make_date(F.year(start) + i, first_month, F.lit(1)))
        .when(freq == "MONTHLY", F.add_months(month_one, i))
        .when(freq == "WEEKLY", F.date_add(first_week, i * 7))
        .otherwise(F.date_add(start, i))
    )
    end = (
        F.when(freq == "YEARLY", F.last_day(F.make_date(F.year(start) + i, last_month, F.lit(1))))
        .when(freq == "MONTHLY", F.last_day(begin))
        .when(freq == "WEEKLY", F.date_add(begin, 6))
        .otherwise(begin)
    )
    # The first week of a weekly rule begins at the start day, not before it.
    from_day = F.when(freq == "WEEKLY", F.greatest(begin, start)).otherwise(begin)
    # Without filters a period has one candidate, the start's place in it.
    month = F.when(freq == "YEARLY", F.make_date(F.year(start) + i, F.month(start), F.lit(1))).otherwise(begin)
    in_month = F.when(
        F.dayofmonth(start) <= F.dayofmonth(F.last_day(month)), F.date_add(month, F.dayofmonth(start) - 1)
    )
    one = (
        F.when(freq.isin("YEARLY", "MONTHLY"), in_month)
        .when(freq == "WEEKLY", F.date_add(start, i * 7))
        .otherwise(begin)
    )
    days = F.sequence(from_day, end, F.expr("interval 1 day"))
    return F.when(F.col("simple"), F.array(one)).otherwise(days)


def _day_periods(rules: DataFrame) -> DataFrame:
    """One row per period of the rule with the period's ``candidates``."""
    periods = _unfold(rules, "period", _periods(), rules.columns)
    return periods.withColumn("candidates", _candidates(F.col("period")))


def _period_times(candidates: Column, filters: set[str]) -> Column:
    """All occurrences of a period, before ``bysetpos`` picks from them."""
    passing = F.filter(candidates, lambda d: F.col("simple") | day_passes(d, filters))
    return F.flatten(F.transform(passing, lambda d: F.transform("times", lambda t: _at(d, t))))


def _day_level(rules: DataFrame, filters: set[str]) -> DataFrame:
    has_setpos = "bysetpos" in filters
    periods = _day_periods(rules.withColumn("times", _day_times()))
    keep = ["rule_id", "dtstart", "until"]
    plain = periods.filter(F.col("bysetpos").isNull()) if has_setpos else periods
    # The days of most rules become rows before they are filtered, which runs compiled.
    named = [c for c in plain.columns if c not in ("candidates", "period")]
    days = _unfold(plain, "day", F.col("candidates"), named).filter(F.col("simple") | day_passes(F.col("day"), filters))
    result = _unfold(days, "second", F.col("times"), [*keep, "day"]).select(
        *keep, _at(F.col("day"), F.col("second")).alias("occurrence")
    )
    if has_setpos:
        whole = _period_times(F.col("candidates"), filters)
        chosen = periods.filter(F.col("bysetpos").isNotNull()).withColumn("whole", whole)
        result = result.unionByName(
            _unfold(chosen, "occurrence", _pick_positions(F.col("whole")), keep)
        )
    return result


def _time_level(rules: DataFrame, filters: set[str]) -> DataFrame:
    """Sub-daily rules, one row per day and then one per firing."""
    has_setpos = "bysetpos" in filters
    start, freq, step = F.col("dtstart"), F.col("freq"), F.col("interval").cast("bigint")
    span = F.when(
        F.col("until") >= start,
        F.sequence(F.to_date("dtstart"), F.to_date("until"), F.expr("interval 1 day")),
    )
    days = (
        _unfold(rules, "day", span, rules.columns)
        .filter(day_passes(F.col("day"), filters))
        .repartition("rule_id", "day")
    )
    unit = F.when(freq == "HOURLY", 3600).when(freq == "MINUTELY", 60).otherwise(1).cast("bigint")
    start_second = F.unix_date(F.to_date(start)).cast("bigint") * 86400 + (
        F.hour(start) * 3600 + F.minute(start) * 60 + F.second(start)
    )
    start_slot = F.floor(start_second / unit)
    day_slot = F.floor(F.unix_date("day").cast("bigint") * 86400 / unit)
    first = F.greatest(start_slot, day_slot + F.pmod(start_slot - day_slot, step))
    last = day_slot + F.floor(F.lit(86400) / unit) - 1
    slots = F.when(
        first <= last, F.transform(F.sequence(first, last, step), lambda s: ((s - day_slot) * unit).cast("int"))
    )

    def allowed(name: str, part: Column) -> Column:
        return F.col(name).isNull() | F.array_contains(name, part.cast("int"))

    sub_hour, sub_minute = freq.isin("MINUTELY", "SECONDLY"), freq == "SECONDLY"
    slots = F.filter(
        slots,
        lambda s: allowed("byhour", F.floor(s / 3600))
        & (~sub_hour | allowed("byminute", F.floor(s / 60) % 60))
        & (~sub_minute | allowed("bysecond", s % 60)),
    )
    minutes = F.when(sub_hour, F.array(F.lit(0))).otherwise(
        F.coalesce("byminute", F.array(F.minute(start)))
    )
    seconds = F.when(sub_minute, F.array(F.lit(0))).otherwise(
        F.coalesce("bysecond", F.array(F.second(start)))
    )
    inside = F.array_distinct(F.array_sort(_sum_sets(F.transform(minutes, lambda m: m * 60), seconds, 1)))
    keep = ["rule_id", "dtstart", "until", "day"]
    fired = _unfold(days.withColumn("inside", inside), "slot", slots, [*keep, "bysetpos", "inside"])
    chosen = F.col("inside")
    if has_setpos:
        chosen = F.when(F.col("bysetpos").isNull(), chosen).otherwise(_pick_positions(chosen))
    seconds_of_day = F.transform(chosen, lambda t: t + F.col("slot"))
    return _unfold(fired, "second", seconds_of_day, keep).select(
        "rule_id", "dtstart", "until", _at(F.col("day"), F.col("second")).alias("occurrence")
    )


def _bounded(rules: DataFrame, freqs: list[str]) -> DataFrame:
    """Occurrences of rules that all have ``until``; distinct per rule."""
    filters = set(rules.columns)
    full = _complete(rules)
    parts = []
    for level, names in ((_day_level, DAY_FREQS), (_time_level, tuple(TIME_FREQS))):
        wanted = [f for f in names if f in freqs]
        if wanted:
            parts.append(level(full.filter(F.col("freq").isin(*wanted)), filters))
    found = reduce(DataFrame.unionByName, parts)
    return found.filter(F.col("occurrence").between(F.col("dtstart"), F.col("until"))).select(
        "rule_id", "occurrence"
    )


def _first(occurrences: DataFrame, counts: DataFrame) -> DataFrame:
    """Keep the first ``count`` occurrences of each rule that has a count."""
    limited = occurrences.join(counts, "rule_id")
    numbered = row_position(
        limited, ["rule_id"], ["occurrence"], "_nr", F.unix_date(F.to_date("occurrence"))
    )
    return numbered.filter(F.col("_nr") <= F.col("count")).select("rule_id", "occurrence")


#: Days times firings a day that a counted rule may look at to be cut to its count in its own row.
IN_ROW = 20_000


def _fits_row() -> Column:
    """Is a completed rule so short that its own row can hold its occurrences? Sub-daily rules are not."""
    freq, days = F.col("freq"), F.lit(1)
    for name, n in {"YEARLY": 366, "MONTHLY": 31, "WEEKLY": 7}.items():
        days = F.when(freq == name, n).otherwise(days)
    firings = F.lit(1).cast("bigint")
    for name in ("byhour", "byminute", "bysecond"):
        firings = firings * F.greatest(F.coalesce(F.size(name), F.lit(1)), F.lit(1))
    size = (_last_period() + 1) * days * firings
    # Without a start or an end, or with the end before the start, there is no occurrence.
    return freq.isin(*DAY_FREQS) & (F.coalesce(F.col("until") < F.col("dtstart"), F.lit(True)) | F.coalesce(size <= IN_ROW, F.lit(False)))


def _first_in_row(full: DataFrame, filters: set[str]) -> DataFrame:
    """The first ``count`` occurrences of completed rules that fit a row, each told from its row alone."""

    def of_period(period: Column) -> Column:
        found = _period_times(F.filter(_candidates(period), lambda d: d.isNotNull()), filters)
        if "bysetpos" not in filters:
            return found
        return F.when(F.col("bysetpos").isNull(), found).otherwise(let(found, _pick_positions))

    # Periods, days and times ascend, so the first ones are the earliest.
    whole = F.flatten(F.transform(_periods(), of_period))
    inside = F.filter(whole, lambda t: t.between(F.col("dtstart"), F.col("until")))
    timed = full.withColumn("times", _day_times())
    return _unfold(timed, "occurrence", F.slice(inside, F.lit(1), F.greatest("count", F.lit(0))), ["rule_id"])


def _first_of_each(rules: DataFrame, freqs: list[str]) -> DataFrame:
    """The first ``count`` occurrences of rules that have ``until`` and ``count``. A rule that is short and
    has its id for itself needs no other row; only the others are brought together by id."""
    by_day = [f for f in DAY_FREQS if f in freqs]
    full = _complete(rules)
    fits = F.coalesce(F.col("freq").isin(*by_day) & _fits_row(), F.lit(False))
    seen = full.select("rule_id", fits.alias("_fits")).filter(F.col("rule_id").isNotNull())
    ids = seen.groupBy("rule_id").agg(F.count(F.lit(1)).alias("_n"), F.bool_and("_fits").alias("_fits"))
    # Mostly none; known before the plan is made, so that the rules are not shuffled for them.
    others = cut_lineage(ids.filter((F.col("_n") > 1) | ~F.col("_fits")).select("rule_id"))
    alone = full.filter(F.col("rule_id").isNotNull())
    filters = set(rules.columns)
    if others.isEmpty():
        return _first_in_row(alone, filters)
    together = rules.join(others, "rule_id", "left_semi")
    found = _first(_bounded(together.drop("count"), freqs), together.select("rule_id", "count"))
    return found.unionByName(_first_in_row(alone.join(others, "rule_id", "left_anti"), filters))


def _guess_until(rules: DataFrame, factor: int) -> Column:
    """A day by which ``count`` occurrences should have come."""
    unit = F.lit(86400)
    for freq, seconds in {"WEEKLY": 7 * 86400, "MONTHLY": 31 * 86400, "YEARLY": 366 * 86400, **TIME_FREQS}.items():
        unit = F.when(F.col("freq") == freq, seconds).otherwise(unit)
    step = F.coalesce(F.col("interval"), F.lit(1)) if "interval" in rules.columns else F.lit(1)
    days = F.ceil((F.col("count").cast("bigint") * step * factor + 1) * unit / 86400)
    last = F.lit(LAST_DAY).cast("date")
    left = F.date_diff(last, F.to_date("dtstart"))
    day = F.date_add(F.to_date("dtstart"), F.least(days, left).cast("int"))
    return day.cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second")


def _open_ended(rules: DataFrame, freqs: list[str]) -> DataFrame:
    """Rules with a count but no end: widen the window of those that are short of
    occurrences until none is, or the calendar ends. Each round is written to the
    checkpoint folder, so no round repeats the work of an earlier one."""
    todo = rules.withColumn("freq", F.upper("freq"))
    factor, result = 3, None
    while True:
        windowed = todo.withColumn("until", _guess_until(todo, factor))
        found = cut_lineage(_first(_bounded(windowed.drop("count"), freqs), todo.select("rule_id", "count")))
        got = found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("_got"))
        short = cut_lineage(
            windowed.join(got, "rule_id", "left")
            .filter((F.coalesce("_got", F.lit(0)) < F.col("count")) & (F.to_date("until") < F.lit(LAST_DAY)))
            .select(*todo.columns)
        )
        done = found.join(short.select("rule_id"), "rule_id", "left_anti")
        result = done if result is None else result.unionByName(done)
        if short.isEmpty():
            return result
        todo, factor = short, factor * 8


def expand(rules: DataFrame, freqs: list[str] | None = None) -> DataFrame:
    """(rule_id, occurrence) of every rule. Dates that do not exist (30 February)
    are skipped. ``rule_id`` must be unique; every rule needs ``until`` or ``count``.
    ``freqs`` names the frequencies in the table, when known, to shorten the plan."""
    freqs = freqs or [*DAY_FREQS, *TIME_FREQS]
    columns = set(rules.columns)
    dtstart = F.to_date("dtstart").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.hour("dtstart") * 3600 + F.minute("dtstart") * 60 + F.second("dtstart")
    )
    whole = rules.withColumn("dtstart", dtstart)
    if "count" not in columns:
        return _bounded(whole, freqs)
    if "until" not in columns:
        return _open_ended(whole, freqs)
    ended = whole.filter(F.col("until").isNotNull())
    uncounted = _bounded(ended.filter(F.col("count").isNull()).drop("count"), freqs)
    counted = ended.filter(F.col("count").isNotNull())
    both = _first_of_each(counted, freqs)
    open_ended = _open_ended(whole.filter(F.col("until").isNull()).drop("until"), freqs)
    return uncounted.unionByName(both).unionByName(open_ended)


# --- questions about occurrences ------------------------------------------


def count_occurrences(rules: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Occurrences per rule, 0 included."""
    counted = occurrences.groupBy("rule_id").agg(F.count(F.lit(1)).alias("occurrences"))
    return (
        rules.select("rule_id")
        .join(counted, "rule_id", "left")
        .select("rule_id", F.coalesce("occurrences", F.lit(0)).alias("occurrences"))
    )


def before_after(
    times: DataFrame, occurrences: DataFrame, at: str = "at", inclusive: bool = False
) -> DataFrame:
    """Add ``before`` and ``after``: the rule's nearest occurrences around ``at``; see
    :func:`viewloom.operators.asof.nearest`."""
    return nearest(times, occurrences, "rule_id", at, "occurrence", inclusive)


def between(
    occurrences: DataFrame, spans: DataFrame, low: str = "low", high: str = "high", inclusive: bool = False
) -> DataFrame:
    """Occurrences inside the span of their rule (one span per rule)."""
    joined = occurrences.join(spans, "rule_id")
    at = F.col("occurrence")
    if inclusive:
        return joined.filter((at >= F.col(low)) & (at <= F.col(high)))
    return joined.filter((at > F.col(low)) & (at < F.col(high)))


def rule_set(
    included: list[DataFrame], excluded: list[DataFrame], set_id: str = "set_id"
) -> DataFrame:
    """Union of occurrence and date tables per set, distinct, without the
    exclusions. All tables have (set_id, occurrence)."""

    def union(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0].select(set_id, "occurrence")
        for part in parts[1:]:
            whole = whole.unionByName(part.select(set_id, "occurrence"))
        return whole.distinct()

    kept = union(included)
    return kept.join(union(excluded), [set_id, "occurrence"], "left_anti") if excluded else kept
