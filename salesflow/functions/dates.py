"""Date parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The accepted spellings, tried in this order.
DATE_FORMATS = ("d/M/yyyy", "yyyy-M-d", "M/d/yyyy")


def parse_date(
    text: Column | str, formats: tuple[str, ...] = DATE_FORMATS, strict: bool = False
) -> Column:
    """The first format that fits; null if none does, or an error when ``strict``."""
    raw = F.trim(F.col(text) if isinstance(text, str) else text)
    parsed = F.coalesce(*[_try_format(raw, fmt) for fmt in formats])
    if not strict:
        return parsed
    bad = raw.isNotNull() & (raw != "") & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), raw))).otherwise(parsed)


def _try_format(raw: Column, fmt: str) -> Column:
    """Text without the format's separator cannot fit it; to find that by parsing costs an exception a row."""
    separator = next((s for s in "/-" if s in fmt), None)
    found = F.try_to_date(raw, fmt)
    return F.when(raw.contains(separator), found) if separator else found


def calendar(date: str = "Date", extended: bool = False) -> dict[str, Column]:
    """Year, Month, ISO Week; with ``extended`` also Day, DayOfYear, Quarter, Season."""
    day = F.col(date)
    columns = {"Year": F.year(day), "Month": F.month(day), "Week": F.weekofyear(day)}
    if extended:
        columns |= {
            "Day": F.dayofmonth(day),
            "DayOfYear": F.dayofyear(day),
            "Quarter": F.quarter(day),
            "Season": season(day),
        }
    return columns


def season(date: Column | str) -> Column:
    """0 from December to February, then 1, 2, 3 per quarter of the shifted year."""
    day = F.col(date) if isinstance(date, str) else date
    return F.floor((F.month(day) % 12) / 3).cast("int")


def add_calendar(df: DataFrame, date: str = "Date", extended: bool = False) -> DataFrame:
    return df.withColumns(calendar(date, extended))
