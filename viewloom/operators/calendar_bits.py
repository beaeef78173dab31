"""Counting and picking occurrences without making them.

A daily, weekly, monthly or yearly rule becomes one row per month with the passing days as the bits of a
number. Each filter is such a number too, made by shifts, and filters combine by AND; what a month has is
counted by its set bits, and the n-th occurrence lies in the month where the running count reaches n, at
the bit of that rank. So a question costs a row per month of the rule, however often it fires a day.

Rules are those of :mod:`viewloom.operators.recurrence`, with ``until`` or ``count`` or both, but for
``bysetpos`` and the frequencies below a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.operators.recurrence import DAY_FREQS, LAST_DAY, _complete, _day_times, easter, week_number, week_start
from viewloom.session import cut_lineage

#: Months that an open-ended rule is given at first for each of its counted periods.
_MONTHS = {"DAILY": 1 / 28, "WEEKLY": 1 / 4, "MONTHLY": 1, "YEARLY": 12}


def _bit(place: Column) -> Column:
    """The number with the bit at ``place``; 0 outside of a month."""
    shift = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.least(place.cast("int"), F.lit(40)), F.lit(0)))
    return F.when((place >= 0) & (place < 31), shift).otherwise(F.lit(0).cast("bigint"))


def _any(values: Column, bits) -> Column:
    """The bits of all values together; all bits if the list of values is null."""
    joined = F.aggregate(values, F.lit(0).cast("bigint"), lambda total, v: total.bitwiseOR(bits(v)))
    return F.when(values.isNull(), F.lit((1 << 31) - 1).cast("bigint")).otherwise(joined)


def _every_week(place: Column) -> Column:
    """The bits of a weekday whose first day of the month is at ``place`` (0 to 6)."""
    weekly = sum(1 << (7 * k) for k in range(5))
    return F.call_function("shiftleft", F.lit(weekly).cast("bigint"), place.cast("int"))


def _span(first: Column, last: Column) -> Column:
    """All bits from place ``first`` to place ``last``, which may lie outside of the month."""
    low, high = F.least(F.greatest(first, F.lit(0)), F.lit(31)).cast("int"), F.least(F.greatest(last + 1, F.lit(0)), F.lit(31)).cast("int")
    ones = lambda n: F.call_function("shiftleft", F.lit(1).cast("bigint"), n) - 1
    return F.when(high > low, ones(high) - ones(low)).otherwise(F.lit(0).cast("bigint"))


def _day_bits(filters: set[str]) -> Column:
    """The days of the row's ``month`` that pass the rule's filters, whatever its interval."""
    month, freq = F.col("month"), F.col("freq")
    start, until = F.to_date("dtstart"), F.to_date("until")
    size = F.dayofmonth(F.last_day(month))
    first_weekday = F.weekday(month)
    day_one = F.dayofyear(month) - 1  # days of the year before this month
    year_size = F.dayofyear(F.make_date(F.year(month), F.lit(12), F.lit(31)))
    place_of = lambda wd, first: F.pmod(wd - first, F.lit(7))

    def from_ends(n: Column, length: Column) -> Column:
        """The 0-based place of the n-th, counted from the front or (negative) the back."""
        return F.when(n > 0, n - 1).otherwise(F.when(n < 0, length + n).otherwise(-1))

    def nth(e: Column) -> Column:
        by_month = (freq == "MONTHLY") | F.col("bymonth").isNotNull()
        extent = F.when(by_month, size).otherwise(year_size)
        first = place_of(e["wd"], F.when(by_month, first_weekday).otherwise(F.weekday(F.trunc(month, "year"))))
        last = first + 7 * F.floor((extent - 1 - first) / 7)
        place = F.when(e["n"] > 0, first + 7 * (e["n"] - 1)).otherwise(last + 7 * (e["n"] + 1))
        inside = (place >= 0) & (place < extent)
        return F.when(inside, _bit(F.when(by_month, place).otherwise(place - day_one))).otherwise(F.lit(0).cast("bigint"))

    bits = _span(F.date_diff(start, month), F.least(F.date_diff(until, month), size - 1))
    bits = F.when(F.col("bymonth").isNull() | F.array_contains("bymonth", F.month(month)), bits).otherwise(F.lit(0).cast("bigint"))
    bits = bits.bitwiseAND(_any(F.col("bymonthday"), lambda n: _bit(from_ends(n, size))))
    bits = bits.bitwiseAND(_any(F.col("weekdays"), lambda wd: _every_week(place_of(wd, first_weekday))))
    bits = bits.bitwiseAND(_any(F.col("nth_weekdays"), nth))
    if "byyearday" in filters:
        bits = bits.bitwiseAND(_any(F.col("byyearday"), lambda n: _bit(F.when(from_ends(n, year_size) >= 0, from_ends(n, year_size) - day_one).otherwise(-1))))
    if "byeaster" in filters:
        bits = bits.bitwiseAND(_any(F.col("byeaster"), lambda n: _easter_bit(n, month)))
    if "byweekno" in filters:
        weeks = _weeks(month)

        def in_week(day: Column) -> Column:
            number, total = (c.cast("int") for c in week_number(day, F.col("wkst")))
            wanted = F.array_contains("byweekno", number) | F.array_contains("byweekno", number - total - 1)
            place = F.date_diff(day, month)
            return F.when(wanted, _span(place, place + 6)).otherwise(F.lit(0).cast("bigint"))

        bits = bits.bitwiseAND(F.when(F.col("byweekno").isNull(), F.lit((1 << 31) - 1).cast("bigint")).otherwise(_any(weeks, in_week)))
    return bits


def _due_bits(bits: Column) -> Column:
    """Those of the days that lie in a period the rule's interval does not pass over."""
    month, freq, step, start = F.col("month"), F.col("freq"), F.col("interval"), F.to_date("dtstart")
    size = F.dayofmonth(F.last_day(month))
    weeks = _weeks(month)

    def due_week(day: Column) -> Column:
        due = F.pmod(F.floor(F.date_diff(day, week_start(start, F.col("wkst"))) / 7), step) == 0
        place = F.date_diff(day, month)
        return F.when(due, _span(place, place + 6)).otherwise(F.lit(0).cast("bigint"))

    first_due = F.pmod(F.date_diff(start, month), step).cast("int")
    due_days = F.when(first_due < size, F.sequence(first_due, size - 1, step.cast("int"))).otherwise(F.array().cast("array<int>"))
    months = lambda d: F.year(d) * 12 + F.month(d)
    none = F.lit(0).cast("bigint")
    return (
        F.when(freq == "DAILY", bits.bitwiseAND(_any(due_days, _bit)))
        .when(freq == "WEEKLY", F.when(step == 1, bits).otherwise(bits.bitwiseAND(_any(weeks, due_week))))
        .when(freq == "MONTHLY", F.when((months(month) - months(start)) % step == 0, bits).otherwise(none))
        .otherwise(F.when((F.year(month) - F.year(start)) % step == 0, bits).otherwise(none))
    )


def _weeks(month: Column) -> Column:
    """The weeks that touch the month, by the day each begins."""
    return F.transform(F.sequence(F.lit(0), F.lit(5)), lambda w: F.date_add(week_start(month, F.col("wkst")), w * 7))


def _easter_bit(n: Column, month: Column) -> Column:
    return _bit(F.date_diff(F.date_add(easter(F.year(month)), n), month))


def month_bits(rules: DataFrame) -> DataFrame:
    """(rule_id, dtstart, until, times, month, bits): a row for each month with days on which the rule
    fires; ``times`` are the seconds of such a day. Every rule needs ``until``; ``count`` is not looked at."""
    full = _complete(rules).withColumn("times", _day_times())
    if "bysetpos" in rules.columns:
        full = full.filter(F.col("bysetpos").isNull())
    full = full.filter(F.col("freq").isin(*DAY_FREQS) & (F.col("until") >= F.col("dtstart")))
    from_, to = F.trunc("dtstart", "month"), F.trunc("until", "month")
    months = full.withColumn("month", F.explode(F.sequence(from_, to, F.expr("interval 1 month"))))
    # In two steps, so that the first is written into the second's expression once.
    months = months.withColumn("days", _day_bits(set(rules.columns))).filter("days <> 0")
    return months.withColumn("bits", _due_bits(F.col("days"))).filter("bits <> 0").select("rule_id", "dtstart", "until", "times", "month", "bits")


def _second(time: Column) -> Column:
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def _fired(months: DataFrame) -> DataFrame:
    """The months with ``n``, how often the rule fires in them, and ``skipped``, how many of the first
    day's times lie before the start."""
    on = lambda day: F.col("bits").bitwiseAND(_bit(F.date_diff(day, F.col("month")))) != 0
    early = F.size(F.filter("times", lambda t: t < _second(F.col("dtstart"))))
    late = F.size(F.filter("times", lambda t: t > _second(F.col("until"))))
    skipped = F.when(on(F.to_date("dtstart")), early).otherwise(0)
    cut = F.when(on(F.to_date("until")), late).otherwise(0)
    whole = F.bit_count("bits") * F.size("times")
    return months.withColumns({"skipped": skipped, "n": (whole - skipped - cut).cast("bigint")})


def count_by_bits(rules: DataFrame) -> DataFrame:
    """(rule_id, occurrences) of every rule, 0 included; with a ``count`` no more than that."""
    if "count" in rules.columns:
        rules = _windowed(rules)
    totals = _fired(month_bits(rules)).groupBy("rule_id").agg(F.sum("n").alias("n"))
    most = F.coalesce("n", F.lit(0))
    if "count" in rules.columns:
        most = F.when(F.col("count").isNull(), most).otherwise(F.least(most, F.col("count")))
    return rules.join(totals, "rule_id", "left").select("rule_id", most.cast("bigint").alias("occurrences"))


def _select(bits: Column, rank: Column) -> Column:
    """The place of the set bit of that rank, from 0."""
    places = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda p: F.call_function("shiftright", bits, p) % 2 == 1)
    return F.get(places, rank.cast("int"))


def nth_by_bits(rules: DataFrame, n: Column) -> DataFrame:
    """(rule_id, occurrence): each rule's n-th occurrence, from 1; rules with fewer are left out. ``n`` may
    differ by rule; a ``count`` bounds it."""
    if "count" in rules.columns:
        wanted = rules.select("rule_id", n.cast("bigint").alias("nth"), F.col("count").alias("most"))
        rules = _windowed(rules)
        wanted = wanted.filter(F.col("most").isNull() | (F.col("nth") <= F.col("most"))).drop("most")
    else:
        wanted = rules.select("rule_id", n.cast("bigint").alias("nth"))
    earlier = Window.partitionBy("rule_id").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    counted = _fired(month_bits(rules)).withColumn("past", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    here = counted.join(wanted, "rule_id").filter((F.col("nth") > F.col("past")) & (F.col("nth") <= F.col("past") + F.col("n")))
    rank = F.col("nth") - F.col("past") - 1 + F.col("skipped")
    day = F.date_add("month", _select(F.col("bits"), F.floor(rank / F.size("times"))))
    second = F.get("times", (rank % F.size("times")).cast("int"))
    return here.select("rule_id", (day.cast("timestamp_ntz") + F.make_dt_interval(secs=second)).alias("occurrence"))


def _windowed(rules: DataFrame) -> DataFrame:
    """The rules with an ``until`` for those that have a ``count`` only: months are added, and counted,
    until the count is reached or the calendar ends. Rounds work on rows of months."""
    if "until" not in rules.columns:
        rules = rules.withColumn("until", F.lit(None).cast("timestamp_ntz"))
    done, todo = rules.filter(F.col("until").isNotNull()), rules.filter(F.col("until").isNull() & F.col("count").isNotNull())
    factor, columns = 3.0, rules.columns
    while not todo.isEmpty():
        step = F.coalesce(F.col("interval"), F.lit(1)) if "interval" in columns else F.lit(1)
        unit = F.lit(1.0)
        for freq, months in _MONTHS.items():
            unit = F.when(F.upper("freq") == freq, months).otherwise(unit)
        months = F.ceil(F.col("count") * step * unit * factor + 12)
        left = (F.lit(9999) - F.year("dtstart")) * 12 + 12 - F.month("dtstart")
        last = F.last_day(F.add_months(F.to_date("dtstart"), F.least(months, left).cast("int")))
        tried = todo.withColumn("until", last.cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second"))
        got = _fired(month_bits(tried)).groupBy("rule_id").agg(F.sum("n").alias("_got"))
        known = cut_lineage(tried.join(got, "rule_id", "left"))
        ended = (F.coalesce("_got", F.lit(0)) >= F.col("count")) | (F.to_date("until") >= F.lit(LAST_DAY))
        done = done.unionByName(known.filter(ended).select(*columns))
        todo = known.filter(~ended).withColumn("until", F.lit(None).cast("timestamp_ntz")).select(*columns)
        factor *= 8
    return done
