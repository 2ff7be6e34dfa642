"""Incremental movement of archives: which ranges are new, which entries, into which archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelf.operators.ranges import stream_bins


def range_of(name: Column, pattern: str) -> Column:
    """A struct begin, end from a file name's two groups; null where the pattern does not fit."""
    begin, end = (F.regexp_extract(name, pattern, i).try_cast("bigint") for i in (1, 2))
    return F.when(begin.isNotNull() & end.isNotNull(), F.struct(begin.alias("begin"), end.alias("end")))


def page_links(pages: DataFrame, column: str, pattern: str) -> DataFrame:
    """(link) of all matches of a pattern's first group in index pages, once each."""
    return pages.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), 1)).alias("link")).distinct()


def high_water(names: DataFrame, column: str, pattern: str) -> DataFrame:
    """One row: the last name by the end of its range, with begin and end."""
    ranged = names.withColumn("_r", range_of(F.col(column), pattern)).where("_r is not null")
    return ranged.agg(F.max_by(column, F.struct("_r.end", "_r.begin")).alias("name"), F.max(F.struct("_r.end", "_r.begin"))["begin"].alias("begin"), F.max("_r.end").alias("end"))


def new_ranges(links: DataFrame, pattern: str, last: int, column: str = "link") -> DataFrame:
    """Links whose range ends after the last id that is already here."""
    return links.withColumn("_r", range_of(F.col(column), pattern)).where(F.col("_r.end") > last).select(column, "_r.begin", "_r.end")


def actual_ranges(entries: DataFrame, by: str = "archive", book: str = "book_id") -> DataFrame:
    """Least and greatest id in each archive, whatever its name says; archives without ids are absent."""
    return entries.where(F.col(book) > 0).groupBy(by).agg(F.min(book).alias("begin"), F.max(book).alias("end"), F.count("*").alias("entries"))


def new_entries(entries: DataFrame, finalised_end: int, present: DataFrame, book: str = "book_id", order: list[str] | None = None) -> DataFrame:
    """Entries with an id beyond the finalised ones that the active archive lacks; of repeated ids the first by order, empty entries (size 0) left out."""
    held = entries.where("size > 0") if "size" in entries.columns else entries
    fresh = held.where(F.col(book) > finalised_end).join(present.select(book).distinct(), book, "left_anti")
    others = [c for c in fresh.columns if c != book]
    ranked = fresh.groupBy(book).agg(F.min_by(F.struct(*others), F.struct(*(order or others))).alias("_e"))
    return ranked.select(book, "_e.*")


def with_last_archive(last: DataFrame, updates: DataFrame, *, finalised_end: int, target: int, size: str = "size", book: str = "book_id") -> DataFrame:
    """New entries, after those of the last finalised archive where that has room: it is taken in whole and made anew.

    last and updates have book, size and archive; updates' repeated ids go by the order of their archives.
    """
    fresh = new_entries(updates, finalised_end, last.select(book), book, order=["archive"])
    used = last.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]  # one row
    return last.select(fresh.columns).unionByName(fresh) if 0 < used < target else fresh


def plan_archives(entries: DataFrame, target: int, size: str = "size", book: str = "book_id", used: int = 0) -> DataFrame:
    """Archives to write, as (bin, begin, end, entries, bytes, finalised): each takes entries until its size is reached.

    `used` is the size that the archive in progress already has. The last bin is not finalised unless full.
    """
    bins = stream_bins(entries, [book], size, target, target - used).groupBy("bin").agg(F.min(book).alias("begin"), F.max(book).alias("end"), F.count("*").alias("entries"), F.sum(size).alias("bytes"))
    room = F.when(F.col("bin") == 0, target - used).otherwise(target)
    return bins.withColumn("finalised", F.col("bytes") >= room)


def archive_name(prefix: str, begin: Column, end: Column, width: int) -> Column:
    """A merged archive's name with both ids padded."""
    return F.concat(F.lit(f"{prefix}-"), F.lpad(begin.cast("string"), width, "0"), F.lit("-"), F.lpad(end.cast("string"), width, "0"), F.lit(".zip"))
