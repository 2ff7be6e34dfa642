"""Entity matching: archive entries to catalogue books by a cascade of keys, with evidence and issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelf.functions.text import file_ext, file_key, file_name, file_stem


def alias_index(rows: DataFrame, key: str, target: str) -> DataFrame:
    """(key, target): keys whose rows all point to one target; a key of several is ambiguous and gone for good."""
    return rows.where(F.col(key).isNotNull() & (F.col(key) != "") & F.col(target).isNotNull()).groupBy(key).agg(
        F.min(target).alias(target), F.max(target).alias("_other")).where(F.col(target) == F.col("_other")).drop("_other")


def ambiguous_keys(rows: DataFrame, key: str, target: str) -> DataFrame:
    """(key, targets): keys that point to more than one target, and how many."""
    return rows.groupBy(key).agg(F.countDistinct(target).alias("targets")).where("targets > 1")


def entry_candidates(entries: DataFrame, entry_col: str = "entry", names_col: str | None = None) -> DataFrame:
    """Entries exploded to (pos, key): stem, stem with extension, the entry's name, then known file names."""
    entry = F.col(entry_col)
    keys = [file_stem(entry), F.concat_ws(".", file_stem(entry), F.nullif(file_ext(entry), F.lit(""))), file_name(entry)]
    listed = F.array(*[file_key(k) for k in keys])
    if names_col:
        listed = F.concat(listed, F.coalesce(F.transform(F.col(names_col), lambda n: file_key(n)), F.array().cast("array<string>")))
    return entries.select("*", F.posexplode(listed).alias("pos", "key")).where("key <> ''")


def match_cascade(entries: DataFrame, books: DataFrame, aliases: DataFrame, *, record_key: str = "record_id", number: str = "entry_number", names_col: str | None = None) -> DataFrame:
    """Each entry with its book: by its number, else by the first candidate key that the alias index knows.

    Adds matched_id, method (numeric_entry_stem, filename_alias or none), alias_id, alias_key and issue.
    books has book_id; aliases has key and book_id without ambiguous keys. Candidates are looked up
    whether or not the number matched, for evidence against it.
    """
    known = books.select(F.col("book_id").alias("_numeric")).distinct()
    index = aliases.select(F.col("key").alias("_key"), F.col("book_id").alias("_alias"))
    hits = entry_candidates(entries.select(record_key, "entry", *([names_col] if names_col else [])), "entry", names_col).join(index, F.col("key") == F.col("_key"))
    first = hits.groupBy(F.col(record_key).alias("_record")).agg(F.min(F.struct("pos", "_alias", "key")).alias("_hit"))
    joined = entries.join(known, F.col(number) == F.col("_numeric"), "left").join(first, F.col(record_key) == F.col("_record"), "left")
    alias = F.col("_hit._alias")
    issue = (F.when(F.col("_numeric").isNotNull() & alias.isNotNull() & (alias != F.col("_numeric")), "conflicting_match_evidence")
             .when(F.col("_numeric").isNull() & alias.isNotNull() & (F.col(number) > 0) & (alias != F.col(number)), "catalog_id_conflict"))
    method = F.when(F.col("_numeric").isNotNull(), "numeric_entry_stem").when(alias.isNotNull(), "filename_alias").otherwise("none")
    return joined.select(*[F.col(c) for c in entries.columns], F.coalesce("_numeric", alias).alias("matched_id"), method.alias("method"),
                         alias.alias("alias_id"), F.col("_hit.key").alias("alias_key"), issue.alias("issue"))
