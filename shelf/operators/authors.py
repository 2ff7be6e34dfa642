"""Authors of one name: groups that collide, and suffixes that tell their members apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelf.functions.text import cleanse_author


def author_key(last, first, middle):
    """The cleansed name by which authors collide; empty if every part is."""
    parts = [cleanse_author(F.coalesce(p, F.lit(""))) for p in (last, first, middle)]
    return F.when(F.concat(*parts) == "", "").otherwise(F.concat_ws(",", *parts))


def collision_groups(people: DataFrame) -> DataFrame:
    """(key, id, names, nick_name) of people whose name several ids share, one row per id.

    people has id (string), first_name, middle_name, last_name, nick_name and optionally seen (the
    order in which they were met): of several rows of an id, the first stays.
    """
    seen = F.col("seen") if "seen" in people.columns else F.struct("last_name", "first_name", "middle_name", "nick_name")
    keyed = people.withColumn("key", author_key(F.col("last_name"), F.col("first_name"), F.col("middle_name"))).where("key <> '' and id <> ''")
    once = keyed.groupBy("key", "id").agg(*[F.min_by(c, seen).alias(c) for c in ("first_name", "middle_name", "last_name", "nick_name")])
    shared = once.groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return once.join(shared, "key")


def author_suffixes(groups: DataFrame) -> DataFrame:
    """Groups with a suffix: [nick] where the nick is unique in its group, else [#id].

    A suffix must make a name that nobody else got: of those whose suffixed names fall together, the
    first (by key, then id) keeps its suffix; the others try [nick #id], then [#id], which is unique.
    """
    nick = cleanse_author(F.coalesce(F.col("nick_name"), F.lit("")))
    counted = groups.withColumn("_nick", nick)
    counted = counted.withColumn("_same", F.count("*").over(Window.partitionBy("key", "_nick")))
    by_id = F.concat(F.lit("[#"), F.col("id"), F.lit("]"))
    counted = counted.withColumn("_first", F.when((F.col("_nick") != "") & (F.col("_same") == 1), F.concat(F.lit("["), "_nick", F.lit("]"))).otherwise(by_id))
    counted = counted.withColumn("_second", F.when(F.col("_nick") != "", F.concat(F.lit("["), F.col("_nick"), F.lit(" #"), F.col("id"), F.lit("]"))).otherwise(by_id))
    parts = lambda s: author_key(F.concat_ws(" ", F.nullif(cleanse_author(F.coalesce("last_name", F.lit(""))), F.lit("")), F.col(s)), F.col("first_name"), F.col("middle_name"))
    named = counted.withColumn("_name", parts("_first"))
    order = Window.partitionBy("_name").orderBy("key", "id")
    return named.withColumn("suffix", F.when(F.row_number().over(order) == 1, F.col("_first")).otherwise(F.col("_second"))).drop("_nick", "_same", "_first", "_second", "_name")


def with_suffixes(people: DataFrame, suffixes: DataFrame, key: str = "person_id") -> DataFrame:
    """People with the suffix of their id, null without one."""
    known = suffixes.select(F.col("id").alias("_id"), "suffix")
    return people.join(known, F.col(key).cast("string") == F.col("_id"), "left").drop("_id")


def ambiguity_totals(groups: DataFrame) -> DataFrame:
    """Numbers of groups and of authors in them."""
    return groups.agg(F.countDistinct("key").alias("groups"), F.count("*").alias("authors"))
