"""Series of a book: which source's, which kinds, in what order, nested ones flattened, none twice.

A series is a struct (name, number, type, level); a nested one from a book file is a node of a
preorder list: struct (path array<string>, name, number, is_leaf).
"""

from __future__ import annotations

from enum import Enum

from pyspark.sql import Column
from pyspark.sql import functions as F


class _Mode(str, Enum):
    @classmethod
    def parse(cls, text: str | None):
        """The mode of a text, trimmed and in any case; empty is the default, the first."""
        name = (text or "").strip().lower()
        if not name:
            return next(iter(cls))
        return cls(name)


class SeriesMode(_Mode):
    AUTHOR, PUBLISHER, ALL, IGNORE = "author", "publisher", "all", "ignore"


class Preference(_Mode):
    COMPLEMENT, MERGE, REPLACE, IGNORE = "complement", "merge", "replace", "ignore"


class Flatten(_Mode):
    ALL, LEAF, PATH, PATH_LEAF = "all", "leaf", "path", "path-leaf"


class Dedup(_Mode):
    CASE_SENSITIVE, CASE_INSENSITIVE = "case-sensitive", "case-insensitive"


NONE = "array<struct<name:string,number:string>>"


def _none() -> Column:
    return F.array().cast(NONE)


def _sorted(series: Column, mode: SeriesMode) -> Column:
    sign = -1 if mode is SeriesMode.PUBLISHER else 1
    keyed = F.transform(series, lambda s: F.struct((s["type"] * sign).alias("t"), F.coalesce(s["level"], F.lit(0).cast("bigint")).alias("l"), s["name"].alias("name"), F.coalesce(s["number"], F.lit("")).alias("number")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["name"].alias("name"), s["number"].alias("number")))


def db_series(series: Column, mode: SeriesMode, by_type: bool = True) -> Column:
    """The catalogue's series of the mode's types, sorted; without by_type the mode only sets the order."""
    if mode is SeriesMode.IGNORE:
        return _none()
    kinds = {SeriesMode.AUTHOR: [0], SeriesMode.PUBLISHER: [1]}.get(mode, [0, 1])
    keep = (lambda s: s["type"].isin(*kinds)) if by_type else (lambda s: s["type"].isNotNull())
    return F.coalesce(_sorted(F.filter(series, keep), mode), _none())


def flatten_series(nodes: Column, mode: Flatten = Flatten.ALL, separator: str = "/") -> Column:
    """Nested series as a flat list in preorder; a node without a name takes its descendants with it."""
    named = F.filter(nodes, lambda n: ~F.exists(n["path"], lambda p: F.trim(p) == "") & (F.trim(n["name"]) != ""))
    flat = lambda name, n: F.struct(name.alias("name"), F.coalesce(n["number"], F.lit("")).alias("number"))
    leaf = lambda n: flat(F.trim(n["name"]), n)
    path = lambda n: flat(F.array_join(F.transform(n["path"], lambda p: F.trim(p)), separator), n)
    if mode is Flatten.ALL:
        result = F.transform(named, leaf)
    else:
        leaves = F.filter(named, lambda n: n["is_leaf"])
        result = {Flatten.LEAF: lambda: F.transform(leaves, leaf), Flatten.PATH: lambda: F.transform(leaves, path),
                  Flatten.PATH_LEAF: lambda: F.flatten(F.transform(leaves, lambda n: F.array(path(n), leaf(n))))}[mode]()
    return F.coalesce(result, _none())


def fb2_series(title: Column, publication: Column, mode: SeriesMode, flatten: Flatten = Flatten.ALL, separator: str = "/") -> Column:
    """The book file's series: the title's, the publication's or both; mode ignore still gives the title's."""
    parts = []
    if mode is not SeriesMode.PUBLISHER:
        parts.append(flatten_series(title, flatten, separator))
    if mode in (SeriesMode.PUBLISHER, SeriesMode.ALL):
        parts.append(flatten_series(publication, flatten, separator))
    return F.concat(*parts)


def dedup_series(series: Column, mode: Dedup = Dedup.CASE_SENSITIVE) -> Column:
    """The first of each name, names trimmed, nameless ones dropped."""
    fold = F.lower if mode is Dedup.CASE_INSENSITIVE else (lambda c: c)
    named = F.filter(F.transform(series, lambda s: F.struct(F.trim(s["name"]).alias("name"), s["number"].alias("number"))), lambda s: s["name"] != "")
    zero = F.struct(F.array().cast("array<string>").alias("seen"), _none().alias("kept"))

    def step(a: Column, s: Column) -> Column:
        known = F.array_contains(a["seen"], fold(s["name"]))
        return F.struct(F.when(known, a["seen"]).otherwise(F.concat(a["seen"], F.array(fold(s["name"])))).alias("seen"),
                        F.when(known, a["kept"]).otherwise(F.concat(a["kept"], F.array(s))).alias("kept"))

    return F.aggregate(named, zero, step, lambda a: a["kept"])


def select_series(db: Column, fb2: Column, preference: Preference, dedup: Dedup = Dedup.CASE_SENSITIVE) -> Column:
    """One list of series from both sources."""
    chosen = {Preference.IGNORE: db, Preference.MERGE: F.concat(db, fb2), Preference.REPLACE: F.when(F.size(fb2) > 0, fb2).otherwise(db),
              Preference.COMPLEMENT: F.when(F.size(db) > 0, db).otherwise(fb2)}[preference]
    return dedup_series(chosen, dedup)


def single_series(series: Column, title: Column, mode: SeriesMode, preference: Preference) -> Column:
    """The one series of a positional export: no filter by type, and merging is replacing."""
    db, fb2 = F.get(db_series(series, mode, by_type=False), F.lit(0)), F.get(flatten_series(F.filter(title, lambda n: F.size(n["path"]) == 1)), F.lit(0))
    has = lambda s: F.coalesce(s["name"] != "", F.lit(False))
    if preference in (Preference.REPLACE, Preference.MERGE):
        return F.when(has(fb2), fb2).otherwise(db)
    if preference is Preference.COMPLEMENT:
        return F.when(~has(db) & has(fb2), fb2).otherwise(db)
    return db
