"""Free-text dates and calendar features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lists import let
from .text import SPACE, WORD, strip, strip_punct, words

# Month names and their numbers.
MONTHS = {
    "january": "1", "jan": "1", "february": "2", "feb": "2", "march": "3", "mar": "3",
    "april": "4", "apr": "4", "may": "5", "june": "6", "jun": "6", "july": "7", "jul": "7",
    "august": "8", "aug": "8", "september": "9", "sep": "9", "october": "10", "oct": "10",
    "november": "11", "nov": "11", "december": "12", "dec": "12",
}

# Stand-in for a missing raw date, last-resort date, and the digit-word formats.
MISSING_DATE = "1901-02-01 00:00:00"
LAST_RESORT = "2000-02-01"
TIMESTAMP_DAYS = ("1677-09-22", "2262-04-11")
DIGIT_FORMATS = [
    "yyyy-M-d", "d-M-yyyy", "M-d-yyyy", "yyyy/M/d", "d/M/yyyy", "M/d/yyyy",
    "yyyy.M.d", "d.M.yyyy", "M.d.yyyy", "yyyy M d", "d M yyyy", "M d yyyy",
]

MONTH_DAY_YEAR = rf"([{WORD}]+)[{SPACE}]+(\d+),?[{SPACE}]*(\d+)?"
ISO_DATE = r"(\d{4}-\d{2}-\d{2})"


def raw_date_text(raw: Column) -> Column:
    return strip(strip_punct(F.coalesce(raw, F.lit(MISSING_DATE))))


def raw_date_parts(raw: Column) -> tuple[Column, Column, Column]:
    """``(month, day, year)`` as text found in the raw date; null where absent."""
    text = raw_date_text(raw)
    return tuple(F.nullif(F.regexp_extract(text, MONTH_DAY_YEAR, i), F.lit("")) for i in (1, 2, 3))


def parse_date(raw: Column, default_year: int) -> Column:
    """``Month d[, y]`` to a date; two-digit years are 20yy, a missing year is ``default_year``,
    anything else is null."""
    table = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])

    def build(p: Column) -> Column:
        number = F.try_element_at(table, F.lower(p["month"]))
        year = F.when(F.length(p["year"]) == 2, F.concat(F.lit("20"), p["year"])).otherwise(p["year"])
        fits = (F.length(year) == 4) & (F.length(p["day"]) <= 2)
        day_text = F.when(fits, F.concat(year, F.lit("-"), number, F.lit("-"), p["day"]))
        return F.try_to_timestamp(day_text, F.lit("yyyy-M-d")).cast("date")

    def parts(text: Column) -> Column:
        found = [F.nullif(F.regexp_extract(text, MONTH_DAY_YEAR, i), F.lit("")) for i in (1, 2, 3)]
        return F.struct(found[0].alias("month"), found[1].alias("day"),
                        F.coalesce(found[2], F.lit(str(default_year))).alias("year"))

    return in_range(let(let(raw_date_text(raw), parts), build))


def in_range(d: Column) -> Column:
    """Null outside the days a nanosecond timestamp can hold."""
    first, last = (F.to_date(F.lit(x)) for x in TIMESTAMP_DAYS)
    return let(d, lambda x: F.when(x.between(first, last), x))


def iso_date_in(text: Column) -> Column:
    """First ``yyyy-mm-dd`` in the text that is a real date."""
    found = F.nullif(F.regexp_extract(text, ISO_DATE, 1), F.lit(""))
    return in_range(F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).cast("date"))


def digit_words_date(text: Column) -> Column:
    """The purely numeric words joined by spaces, read by the first format that fits."""
    digits = F.array_join(F.filter(words(text), lambda w: w.rlike(r"^\d+$")), " ")
    return F.coalesce(*[F.try_to_timestamp(digits, F.lit(f)) for f in DIGIT_FORMATS]).cast("date")


def date_with_fallback(parsed: Column, article: Column, title: Column, try_formats: bool = False) -> Column:
    """Parsed date, else an ISO date in the article, else in the title, else the last resort.

    ``try_formats`` also tries the digit-only words of article and title."""
    options = [parsed, iso_date_in(article), iso_date_in(title)]
    if try_formats:
        options += [digit_words_date(article), digit_words_date(title)]
    return F.coalesce(*options, F.to_date(F.lit(LAST_RESORT)))


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7).cast("int")


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of the position in a period."""
    angle = F.lit(2) * F.pi() * value / F.lit(period)
    return F.sin(angle), F.cos(angle)


def date_features(d: Column) -> dict[str, Column]:
    """Calendar columns derived from the date alone."""
    week_sin, week_cos = cycle(F.weekofyear(d), 52)
    day_sin, day_cos = cycle(F.dayofmonth(d), 31)
    month_sin, month_cos = cycle(F.month(d), 12)
    return {
        "day_of_week": day_name(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": is_weekend(d),
        "is_weekday": F.lit(1) - is_weekend(d),
        "week_of_year_sin": week_sin,
        "week_of_year_cos": week_cos,
        "day_of_month_sine": day_sin,
        "day_of_month_cos": day_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }
