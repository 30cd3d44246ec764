"""Date scalars. Sessions are expected to be in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.binding import let


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def wayback_time(value: Column) -> Column:
    """Timestamp of 12, 14, 16 or 17 and more digits; null for any other length."""
    d = digits(value)
    n = F.length(d)
    millis = F.concat(F.substring(F.rpad(d, 17, "0"), 1, 14), F.lit("."), F.substring(F.rpad(d, 17, "0"), 15, 3))
    return (
        F.when(n == 12, F.try_to_timestamp(d, F.lit("yyyyMMddHHmm")))
        .when(n == 14, F.try_to_timestamp(d, F.lit("yyyyMMddHHmmss")))
        .when(n >= 16, F.try_to_timestamp(millis, F.lit("yyyyMMddHHmmss.SSS")))
    )


def crawl_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def wayback_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss").cast("long")


def year_of(value: Column) -> Column:
    """The first four digits; ``unknown`` for 0000 and for less."""
    y = F.regexp_extract(value, r"^(\d{4})", 1)
    return F.when(y.isin("", "0000"), "unknown").otherwise(y)


def last_modified(created: Column, metadata: Column, modified: Column) -> Column:
    return F.coalesce(modified, metadata, created)


_TIME = r"(?:\D+(\d{1,2}):(\d{2})(?::(\d{2}))?)?"
_MONTH = "(\\d{1,2}|jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_ORDERS = ((rf"\b(\d{{1,2}})[/.\s-]+{_MONTH}[/.\s,-]+(\d{{4}}){_TIME}", (3, 2, 1)), (rf"\b{_MONTH}[/.\s-]+(\d{{1,2}})[/.\s,-]+(\d{{4}}){_TIME}", (3, 1, 2)), (rf"\b(\d{{4}})[/.\s-]+{_MONTH}[/.\s-]+(\d{{1,2}}){_TIME}", (1, 2, 3)))
_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _parts(low: Column, pattern: str, order: tuple[int, int, int]) -> Column:
    """Year, month, day, hour, minute and second of the first match, as text."""
    return F.array(*[F.regexp_extract(low, pattern, i) for i in (*order, 4, 5, 6)])


def extract_date(text: Column) -> Column:
    """The first date that parses: day-month-year, then month-day-year, then year-month-day; months may be names and a time may follow."""
    names = F.array(*[F.lit(name) for name in _NAMES])

    def moment(parts: Column) -> Column:
        month = F.when(F.array_contains(names, F.get(parts, 1)), F.array_position(names, F.get(parts, 1)).cast("string")).otherwise(F.get(parts, 1))
        two = lambda c: F.lpad(F.when(c == "", "0").otherwise(c), 2, "0")
        whole = F.concat(F.get(parts, 0), two(month), *[two(F.get(parts, i)) for i in range(2, 6)])
        return F.when(F.get(parts, 0) != "", F.try_to_timestamp(whole, F.lit("yyyyMMddHHmmss")))

    return let(F.lower(text), lambda low: F.coalesce(*[let(_parts(low, pattern, order), moment) for pattern, order in _ORDERS]))
