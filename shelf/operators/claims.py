"""Claims: what each source says about a book, typed, with the observation it comes from.

A dataset row has a locator, observations (array of id, source, kind, status), claims by field (array of
observation and value) and facts about files. Here records become rows, and rows become flat views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelf.functions.text import absent, deletion_state, file_ext, file_name, file_stem, media_type, present
from shelf.functions.values import number_of, positive, positive_text, rating_text, rfc3339

#: Claim fields of plain text: field -> (column of the catalogue's record, column of the book file's).
TEXT_CLAIMS = {
    "title": ("title", "fb2_title"), "language": ("lang", "fb2_lang"), "source_language": ("src_lang", "fb2_src_lang"), "keywords": ("keywords", "fb2_keywords"),
    "annotation": (None, "fb2_annotation"), "year": ("year", "fb2_year"), "book_name": (None, "fb2_book_name"), "publisher": (None, "fb2_publisher"),
    "city": (None, "fb2_city"), "isbn": (None, "fb2_isbn"), "file_author": ("file_author", None),
}
#: Text claims that also carry the number that their text is, where it is one.
NUMBERS = ("year",)
#: Lists of persons and the like, in the order of the book file; their members get their place.
PLACED = ("fb2_authors", "fb2_translators")


def _claim(observation: str, value: Column, number: bool = False) -> Column:
    fields = [F.lit(observation).alias("observation"), value.alias("value"), *([number_of(value, "bigint").alias("number")] if number else [])]
    return F.when(value.isNotNull(), F.struct(*fields))


def observation_status(is_present: Column, failed: Column, collected: Column) -> Column:
    """present, else error where reading failed, else not_collected where it was off, else absent."""
    return F.when(is_present, "present").when(failed, "error").when(~collected, "not_collected").otherwise("absent")


def _relations(have: set[str], db: Column, col) -> Column:
    """What the catalogue says about a book and others: the book that replaces it, and a merge of books per event."""
    kind = "struct<observation:string,kind:string,target:string,event_id:string,time:string,participants:map<string,string>>"
    replaced = F.struct(F.lit("db").alias("observation"), F.lit("replaced_by").alias("kind"), positive(col("replaced_by", "long")).cast("string").alias("target"), F.lit(None).cast("string").alias("event_id"),
                        F.lit(None).cast("string").alias("time"), F.lit(None).cast("map<string,string>").alias("participants")).cast(kind)
    found = F.array_compact(F.array(F.when(db & positive(col("replaced_by", "long")).isNotNull(), replaced)))
    if "joined_books" not in have:
        return found
    merged = F.transform("joined_books", lambda e: F.struct(
        F.lit("db").alias("observation"), F.lit("joined_books").alias("kind"), F.lit(None).cast("string").alias("target"), e["event_id"].cast("string").alias("event_id"), e["time"].cast("string").alias("time"),
        F.create_map(*[x for role in ("bad", "good", "real") for x in (F.lit(role), positive_text(e[role].cast("long")))]).alias("participants")).cast(kind))
    return F.concat(found, F.when(db, F.coalesce(merged, F.array().cast(f"array<{kind}>"))).otherwise(F.array().cast(f"array<{kind}>")))


def dataset_rows(records: DataFrame) -> DataFrame:
    """Claims from joined records. Columns that a record lacks give no claims; empty values are none.

    A record has archive, entry_index, entry (null for a book without a file), db_present, fb2_present,
    and those columns of TEXT_CLAIMS and of the facets that its sources have.
    """
    have = set(records.columns)
    col = lambda c, t="string": F.col(c).cast(t) if c in have else F.lit(None).cast(t)
    db, fb2 = F.coalesce(col("db_present", "boolean"), F.lit(False)), F.coalesce(col("fb2_present", "boolean"), F.lit(False))
    filed = col("archive").isNotNull()
    beyond_title = [c for c in ("fb2_document_id", "fb2_book_name", "fb2_publisher", "fb2_city", "fb2_isbn", "fb2_year", "fb2_original_title") if c in have]
    whole = F.lit(False)
    for c in beyond_title:
        whole = whole | F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))

    def seen(name: str, source: Column, kind: str, status: Column, coverage: Column) -> Column:
        number = positive(col("book_id", "long")) if name == "db" else F.lit(None).cast("long")
        entry, index = (F.lit(None).cast("string"), F.lit(None).cast("long")) if name == "db" else (col("entry"), col("entry_index", "long"))
        return F.struct(F.lit(name).alias("id"), source.alias("source"), F.lit(kind).alias("kind"), status.alias("status"), number.alias("book_id"), entry.alias("entry"), index.alias("index"), coverage.alias("coverage"))

    out = {
        "locator": F.when(col("archive").isNotNull(), F.struct(F.lit("archive_entry").alias("kind"), col("archive").alias("source"), col("entry_index", "long").alias("index"), F.lit(None).cast("long").alias("book_id")))
        .otherwise(F.struct(F.lit("database_book").alias("kind"), F.lit("database").alias("source"), F.lit(None).cast("long").alias("index"), col("book_id", "long").alias("book_id"))),
        "observations": F.array_compact(F.array(
            F.when(filed, seen("archive", col("archive"), "archive_entry", F.lit("present"), F.lit("inventory"))),
            F.when(filed | db, seen("db", F.lit("database"), "catalog", observation_status(db, F.lit(False), F.lit(True)), F.when(db, "complete"))),
            F.when(filed, seen("fb2", col("archive"), "fb2", observation_status(fb2, F.coalesce(F.size(col("errors", "array<string>")) > 0, F.lit(False)), F.coalesce(col("fb2_collected", "boolean"), F.lit(True))),
                               F.when(fb2, F.when(whole, "description").otherwise("title_info")))))),
    }
    for name, (from_db, from_fb2) in TEXT_CLAIMS.items():
        parts = [_claim(o, F.when(flag, absent(F.trim(col(c)))), name in NUMBERS) for o, c, flag in (("db", from_db, db), ("fb2", from_fb2, fb2)) if c]
        out[f"claim_{name}"] = F.array_compact(F.array(*parts))
    stem_id = positive(file_stem(col("entry")).try_cast("bigint"))
    identity = lambda o, scheme, v: F.when(v.isNotNull(), F.struct(F.lit(o).alias("observation"), F.lit(scheme).alias("scheme"), v.cast("string").alias("value")))
    out["identities"] = F.array_compact(F.array(
        identity("db", "catalog.book", F.when(db, positive(col("book_id", "long")))), identity("archive", "catalog.book", stem_id),
        identity("fb2", "document.id", F.when(fb2, absent(F.trim(col("fb2_document_id"))))), identity("fb2", "isbn", F.when(fb2, absent(F.trim(col("fb2_isbn")))))))
    out["claim_deleted"] = F.array_compact(F.array(_claim("db", F.when(db & col("deleted").isNotNull(), F.struct(col("deleted").alias("raw"), deletion_state(col("deleted")).alias("state"))))))
    out["claim_rating"] = F.array_compact(F.array(_claim("db", F.when(db & positive(col("rating_count", "long")).isNotNull(), F.struct(
        col("rating_average", "double").alias("average"), col("rating_count", "long").alias("count"), col("rating_min", "long").alias("min"), col("rating_max", "long").alias("max"))))))
    out["claim_time"] = F.array_compact(F.array(_claim("db", F.when(db, absent(rfc3339(col("time", "timestamp")))))))
    out["claim_modified"] = F.array_compact(F.array(_claim("db", F.when(db, absent(rfc3339(col("catalogue_modified", "timestamp")))))))
    out["claim_status"] = F.array_compact(F.array(_claim("db", F.when(db, F.struct(col("file_type").alias("file_type"), col("md5").alias("md5"))))))
    name = F.coalesce(absent(file_name(col("entry"))), absent(file_name(col("file_name"))))
    size = lambda o, v: F.when(v > 0, F.struct(F.lit(o).alias("observation"), v.alias("value")))
    checksum = lambda o, origin, v: F.when(v.isNotNull(), F.struct(F.lit(o).alias("observation"), F.lit("md5").alias("algorithm"), F.lit("content").alias("scope"), F.lit(origin).alias("origin"), v.alias("value")))
    out["artifact"] = F.struct(name.alias("name"), media_type(F.coalesce(absent(file_ext(col("entry"))), col("file_type"))).alias("media_type"),
                               F.array_compact(F.array(size("db", F.when(db, col("file_size", "long"))), size("archive", col("uncompressed_size", "long")))).alias("sizes"),
                               F.array_compact(F.array(F.when(col("entry").isNotNull(), F.struct(F.lit("archive").alias("observation"), col("entry").alias("entry"), col("modified").alias("modified"))))).alias("occurrences"),
                               F.array_compact(F.array(checksum("db", "reported", F.when(db, absent(col("md5")))), checksum("archive", "calculated", absent(col("content_md5"))))).alias("checksums"))
    out["relations"] = _relations(have, db, col)
    issue = lambda stage, o, text: F.struct(F.lit(stage).alias("stage"), F.lit(o).alias("observation"), text.alias("message"))
    parse = F.transform(F.coalesce(col("errors", "array<string>"), F.array().cast("array<string>")), lambda e: issue("parse", "fb2", e))
    out["issues"] = F.concat(parse, F.array_compact(F.array(F.when(col("issue").isNotNull(), issue("match", "db", col("issue"))))))
    for c in PLACED:
        if c in have and "position" not in records.schema[c].dataType.elementType.names:
            records = records.withColumn(c, F.transform(c, lambda x, i: x.withField("position", (i + 1).cast("long"))))
    facets = [c for c in ("authors", "translators", "illustrators", "genres", "series", "filenames", "joined_books", "fb2_authors", "fb2_translators", "fb2_genres", "fb2_series", "fb2_publication_series", "fb2_sections", "fb2_output", "match") if c in have]
    return records.select(*[v.alias(k) for k, v in out.items()], *facets)


def claimed(claims: Column, observation: str) -> Column:
    """The first value that an observation claims; null without one."""
    return F.get(F.filter(claims, lambda c: c["observation"] == observation), F.lit(0))["value"]


def book_id(rows_locator: Column, identities: Column, artifact: Column) -> Column:
    """A row's book: its locator's, else its first catalogue identity, else its file's stem."""
    identity = F.get(F.filter(identities, lambda i: i["scheme"] == "catalog.book"), F.lit(0))["value"]
    return F.coalesce(rows_locator["book_id"].cast("string"), identity, absent(file_stem(artifact["name"])), absent(file_stem(F.get(artifact["occurrences"], F.lit(0))["entry"])))


def flat_view(rows: DataFrame) -> DataFrame:
    """Claims pivoted to db_ and fb2_ columns, with book_id, file facts and flags."""
    first_number = lambda name, o: F.get(F.filter(F.col(f"claim_{name}"), lambda c: c["observation"] == o), F.lit(0))["number"]
    out = {f"{o}_{name}": present(claimed(F.col(f"claim_{name}"), o)) for name in TEXT_CLAIMS for o in ("db", "fb2")}
    status = lambda o: F.exists("observations", lambda x: (x["id"] == o) & (x["status"] == "present"))
    rating = claimed(F.col("claim_rating"), "db")
    first_size = F.get(F.filter(F.col("artifact.sizes"), lambda s: s["value"] > 0), F.lit(0))["value"]
    out |= {
        "has_db": status("db"), "has_fb2": status("fb2"), "book_id": book_id(F.col("locator"), F.col("identities"), F.col("artifact")),
        "deleted": present(claimed(F.col("claim_deleted"), "db")["raw"]), "time": present(claimed(F.col("claim_time"), "db")),
        "rating": rating_text(rating["average"], rating["count"]), "file_type": present(claimed(F.col("claim_status"), "db")["file_type"]), "md5": present(claimed(F.col("claim_status"), "db")["md5"]),
        "file": present(F.col("artifact.name")), "size": F.coalesce(claimed(F.col("artifact.sizes"), "db"), first_size, F.lit(0).cast("long")),
        "file_date": present(F.substring(F.get(F.col("artifact.occurrences"), F.lit(0))["modified"], 1, 10)),
        "replaced_by": present(F.get(F.filter("relations", lambda r: r["kind"] == "replaced_by"), F.lit(0))["target"]),
    }
    out |= {f"{o}_{name}_number": first_number(name, o) for name in NUMBERS for o in ("db", "fb2")}
    return rows.select("*", *[v.alias(k) for k, v in out.items()])


def claims_of(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(key columns, field, observation, value as text): all text claims as rows, for integrity checks and edges."""
    def named(field: str) -> Column:
        return F.transform(F.col(f"claim_{field}"), lambda c: F.struct(F.lit(field).alias("field"), c["observation"].alias("observation"), c["value"].alias("value")))

    parts = F.array(*[named(f) for f in fields])
    return rows.select("locator", F.explode(F.flatten(parts)).alias("c")).select("locator", "c.*")


def preferred(db: Column, fb2: Column) -> Column:
    """The catalogue's value, else the book file's."""
    return F.coalesce(absent(db), absent(fb2), F.lit(""))
