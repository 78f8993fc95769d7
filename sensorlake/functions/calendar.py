"""Calendar column functions and the public-holiday table.

All are JVM-side built-ins, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_name(d: ColumnOrName) -> Column:
    """Full English day name, ``Monday`` .. ``Sunday``."""
    return F.date_format(_c(d), "EEEE")


def iso_day_of_week(d: ColumnOrName) -> Column:
    """ISO weekday, Monday = 1 .. Sunday = 7."""
    return F.weekday(_c(d)) + 1


def is_weekend(d: ColumnOrName) -> Column:
    """Saturday or Sunday."""
    return iso_day_of_week(d) >= 6


def day_of_week0(d: ColumnOrName) -> Column:
    """Zero-based weekday, Monday = 0, as tinyint (E5)."""
    return F.weekday(_c(d)).cast("tinyint")


def month_of(d: ColumnOrName) -> Column:
    """Month number as tinyint (E5)."""
    return F.month(_c(d)).cast("tinyint")


def observed_at(d: ColumnOrName, hour: ColumnOrName) -> Column:
    """Naive timestamp = date + hour hours (E4); hours past 23 roll over."""
    return _c(d).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), _c(hour).cast("int"))


def month_start(d: ColumnOrName) -> Column:
    """First day of the month."""
    return F.trunc(_c(d), "MM")


def days_inclusive(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of days in [start, end]."""
    return F.datediff(_c(end), _c(start)) + 1


def local_date(now_utc: ColumnOrName, tz: str) -> Column:
    """The calendar date in zone ``tz`` of a UTC instant, as a naive date."""
    return F.to_date(F.from_utc_timestamp(_c(now_utc).cast("timestamp"), tz))


def trailing(df: DataFrame, date_col: str, anchor: Column, days: int) -> DataFrame:
    """Rows with ``anchor - days < date`` (exclusive lower bound, P10)."""
    return df.filter(F.col(date_col) > F.date_sub(anchor, days))


# ---------------------------------------------------------------- holidays (M9)
#
# The Friday before the football grand final, as announced by the
# state government each year.  In later years it is taken to be the Friday
# before the last Saturday of September, the day of all listed finals but those
# of 2015, 2016 and 2020; a caller with an announced date passes a calendar of
# their own.  Easter Sunday is a public holiday from 2016 on.
GRAND_FINAL_EVE = {
    2015: "2015-10-02",
    2016: "2016-09-30",
    2017: "2017-09-29",
    2018: "2018-09-28",
    2019: "2019-09-27",
    2020: "2020-10-23",
    2021: "2021-09-24",
    2022: "2022-09-23",
    2023: "2023-09-29",
    2024: "2024-09-27",
    2025: "2025-09-26",
}

#: Public holidays declared once.
ONE_OFF = {"National Day of Mourning": "2022-09-22"}
#: The last year of the generated calendar, and the last announced final.
LAST_YEAR = 2199
LAST_FINAL = max(GRAND_FINAL_EVE)


def _nth_weekday(year: Column, month: int, weekday0: int, n: int) -> Column:
    """The n-th given weekday (Monday = 0) of a month."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    offset = (F.lit(weekday0) - F.weekday(first) + 7) % 7
    return F.date_add(first, offset + 7 * (n - 1))


def _easter_sunday(year: Column) -> Column:
    """Anonymous Gregorian computus, integer arithmetic only."""
    y = year
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = (h + l_ - 7 * m + 114) % 31 + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def _weekend_to_monday(d: Column) -> Column:
    """Saturday or Sunday -> the following Monday; null for weekdays."""
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_add(d, 2)).when(wd == 6, F.date_add(d, 1))


def _grand_final_eve(y: Column) -> Column:
    """Announced date, or by the rule in the years after the last of them."""
    announced = F.create_map(*[x for yr, d in GRAND_FINAL_EVE.items() for x in (F.lit(yr), F.lit(d).cast("date"))])
    end = F.make_date(y, F.lit(9), F.lit(30))
    rule = F.date_sub(end, (F.weekday(end) + 2) % 7 + 1)
    return F.when(y > LAST_FINAL, rule).otherwise(F.element_at(announced, y))


def _holiday_entries(y: Column) -> list[tuple[str, Column]]:
    """(name, date) of every rule for year column ``y``; a date is null when
    the rule does not apply that year (weekday substitutes)."""
    y = y.cast("int")
    jan1 = F.make_date(y, F.lit(1), F.lit(1))
    jan26 = F.make_date(y, F.lit(1), F.lit(26))
    easter = _easter_sunday(y)
    dec25 = F.make_date(y, F.lit(12), F.lit(25))
    dec26 = F.make_date(y, F.lit(12), F.lit(26))
    # Christmas / Boxing Day on a weekend: substitute on the second day after.
    xmas_sub = F.when(F.weekday(dec25) >= 5, F.date_add(dec25, 2))
    boxing_sub = F.when(F.weekday(dec26) >= 5, F.date_add(dec26, 2))
    return [
        ("New Year's Day", jan1),
        ("New Year's Day (observed)", _weekend_to_monday(jan1)),
        ("Australia Day", jan26),
        ("Australia Day (observed)", _weekend_to_monday(jan26)),
        ("Labour Day", _nth_weekday(y, 3, 0, 2)),
        ("Good Friday", F.date_sub(easter, 2)),
        ("Easter Saturday", F.date_sub(easter, 1)),
        ("Easter Sunday", F.when(y >= 2016, easter)),
        ("Easter Monday", F.date_add(easter, 1)),
        ("ANZAC Day", F.make_date(y, F.lit(4), F.lit(25))),
        ("King's Birthday", _nth_weekday(y, 6, 0, 2)),
        ("Friday before the AFL Grand Final", _grand_final_eve(y)),
        *[(n, F.when(y == int(d[:4]), F.lit(d).cast("date"))) for n, d in ONE_OFF.items()],
        ("Melbourne Cup Day", _nth_weekday(y, 11, 1, 1)),
        ("Christmas Day", dec25),
        ("Christmas Day (observed)", xmas_sub),
        ("Boxing Day", dec26),
        ("Boxing Day (observed)", boxing_sub),
    ]


def holidays(spark: SparkSession, years: DataFrame) -> DataFrame:
    """Public holidays (state of Victoria rules) for each year in ``years``.

    ``years`` is a one-column frame ``year``; the caller derives it from the
    data (``years_of(frame, "sensing_date")``).  Output: ``holiday_date``,
    ``holiday_name``.  Rows are generated by ``explode``; no join.
    """
    arr = F.array(
        *[F.struct(d.alias("holiday_date"), F.lit(n).alias("holiday_name")) for n, d in _holiday_entries(F.col("year"))]
    )
    return (
        years.select(F.explode(arr).alias("h"))
        .select("h.holiday_date", "h.holiday_name")
        .filter(F.col("holiday_date").isNotNull())
    )


def holiday_calendar(spark: SparkSession, first: int = 1900, last: int = LAST_YEAR) -> DataFrame:
    """The holiday dates (``holiday_date``) of a range of years: at most 18 a
    year, generated without reading any data, small enough to broadcast."""
    return holiday_dates(spark, spark.range(first, last + 1).select(F.col("id").cast("int").alias("year")))


def years_of(df: DataFrame, date_col: str) -> DataFrame:
    """Every calendar year between the min and max of ``date_col``."""
    return df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).select(
        F.explode(F.sequence(F.year("lo"), F.year("hi"))).alias("year")
    )


def holiday_dates(spark: SparkSession, years: DataFrame) -> DataFrame:
    """Distinct holiday dates (bounded: at most 17 per year)."""
    return holidays(spark, years).select("holiday_date").distinct()
