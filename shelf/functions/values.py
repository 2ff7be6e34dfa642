"""Numbers and dates of the catalogue: Column in, Column out."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_number(text: Column) -> Column:
    """A series number truncated to an integer; null where it is no number."""
    return text.try_cast("double").try_cast("bigint")


def series_number_text(text: Column) -> Column:
    """A series number as exports show it: truncated to an integer where it is a number, else the raw text."""
    return F.coalesce(series_number(text).cast("string"), text, F.lit(""))


def number_of(text: Column, kind: str = "double") -> Column:
    """The number that a text is, beside which the text stays; null where it is none."""
    return F.trim(text).try_cast(kind)


def ensure_dump_date(dump_date: str, today: str) -> tuple[str, bool]:
    """A compact dump date, and whether it had to be made up from today's date (YYYY-MM-DD)."""
    return (dump_date, False) if dump_date else (today.replace("-", ""), True)


def dataset_id(unique: Column | None = None) -> Column:
    """A new dataset's URN, from a random UUID unless one is given."""
    return F.concat(F.lit("urn:uuid:"), F.expr("uuid()") if unique is None else unique)


def positive(value: Column) -> Column:
    return F.when(value > 0, value)


def positive_text(value: Column) -> Column:
    """An id as text; empty where it is not positive."""
    return F.coalesce(positive(value).cast("string"), F.lit(""))


def rating_text(average: Column, count: Column) -> Column:
    """The shortest decimal of an average, without a trailing .0; empty without ratings."""
    return F.when((count > 0) & average.isNotNull(), F.regexp_replace(average.cast("double").cast("string"), r"\.0$", "")).otherwise("")


def rating_whole(text: Column) -> Column:
    """A rating's text truncated to a whole number; empty where it is no number."""
    return F.coalesce(text.try_cast("double").try_cast("bigint").cast("string"), F.lit(""))


def rfc3339(time: Column) -> Column:
    """A time with its zone; empty for null."""
    return F.coalesce(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit(""))


def date_only(text: Column) -> Column:
    """The first ten characters where they are a date, else the text."""
    start = F.substring(text, 1, 10)
    valid = start.rlike(r"^\d{4}-\d{2}-\d{2}$") & start.try_cast("date").isNotNull()
    return F.when(F.coalesce(valid, F.lit(False)), start).otherwise(text)


def compact_date(iso: Column) -> Column:
    return F.replace(iso, F.lit("-"), F.lit(""))


def display_date(compact: Column) -> Column:
    """ISO for eight digits, else the text."""
    return F.when(compact.rlike(r"^\d{8}$"), F.regexp_replace(compact, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")).otherwise(compact)


def zero_pad_hour(time: Column) -> Column:
    return F.when(time.rlike(r"^\d:"), F.concat(F.lit("0"), time)).otherwise(time)


def dump_stamp(tail: Column) -> Column:
    """A struct date, time of a dump's completion line; both null without one."""
    pattern = r"Dump completed on\s+(\d{4}-\d{2}-\d{2})\s+(\d{1,2}:\d{2}:\d{2})"
    date = F.nullif(F.regexp_extract(tail, pattern, 1), F.lit(""))
    return F.struct(date.alias("date"), F.when(date.isNotNull(), zero_pad_hour(F.regexp_extract(tail, pattern, 2))).alias("time"))


def same_time(a: Column, b: Column) -> Column:
    """Equal within a microsecond."""
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) <= 1


def output_path(path: str, dump_date: str) -> str:
    """The path with its dump date appended once; the date must be eight digits."""
    if not re.fullmatch(r"\d{8}", dump_date):
        raise ValueError(f"not a compact date: {dump_date!r}")
    stem, dot, ext = path.rpartition(".") if "." in path.rpartition("/")[2] else (path, "", "")
    return path if stem.endswith(f"_{dump_date}") else f"{stem}_{dump_date}{dot}{ext}"
