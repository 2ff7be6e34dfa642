"""Flat export layouts of a dataset: positional, one row per series, and filtered slices.

All take flat views (claims.flat_view) with the facets authors, genres, series of the catalogue and
fb2_authors, fb2_genres, fb2_series, fb2_publication_series of the book file, any of which may be missing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelf.functions.text import cleanse, file_ext, file_stem, genre_codes, is_deleted, join_fields, keywords, limited_people, people, present, range_name, split_key, truncate_field, xml_escape
from shelf.functions.values import date_only, rating_whole, series_number_text
from shelf.operators.claims import preferred
from shelf.operators.facets import EMPTY_PERSONS
from shelf.operators.ranges import accepted_ordinals, in_ranges, missing_positions, running_index
from shelf.operators.series import Dedup, Flatten, Preference, SeriesMode, db_series, fb2_series, select_series, single_series

#: The layouts' field lists.
MULTI_FIELDS = "AUTHOR;GENRE;TITLE;SERIES;SERNO;FILE;SIZE;LIBID;DEL;EXT;DATE;LANG;LIBRATE;KEYWORDS;YEAR;SOURCELIB;"
SLICE_FIELDS = "AUTHOR;GENRE;TITLE;SERIES;SERNO;FILE;SIZE;LIBID;DEL;EXT;DATE;INSNO;FOLDER;LANG;LIBRATE;KEYWORDS;YEAR;"


@dataclass(frozen=True)
class Options:
    """How an export chooses between sources and renders fields."""

    series: SeriesMode = SeriesMode.AUTHOR
    prefer: Preference = Preference.COMPLEMENT
    flatten: Flatten = Flatten.ALL
    separator: str = "/"
    dedup: Dedup = Dedup.CASE_SENSITIVE
    quick_fix: bool = True
    author_limit: int = 128
    title_limit: int = 150
    series_limit: int = 80
    keywords_limit: int = 255
    extended: bool = False
    source_library: str = ""
    online_archive: str = "online"


_SERIES = "array<struct<name:string,number:string,type:bigint,level:bigint>>"
_NODES = "array<struct<path:array<string>,name:string,number:string,is_leaf:boolean>>"


def _facet(df: DataFrame, name: str, kind: str) -> Column:
    if name not in df.columns:
        return F.array().cast(kind)
    want = [f.split(":")[0] for f in kind[len("array<struct<"):-2].replace("array<string>", "x").split(",")]
    have = df.schema[name].dataType.elementType
    if not hasattr(have, "names"):
        return F.coalesce(F.col(name), F.array().cast(kind))
    return F.coalesce(F.transform(F.col(name), lambda x: F.struct(*[(x[w] if w in have.names else F.lit(None)).alias(w) for w in want])).cast(kind), F.array().cast(kind))


def selected_authors(df: DataFrame, prefer: Preference, fallback: bool = False) -> Column:
    """The catalogue's authors; the book file's only when they replace, or where the catalogue has no such book.

    With `fallback`, as user expressions see them, the book file's also stand in where the catalogue knows no author.
    """
    kind = EMPTY_PERSONS.simpleString()
    db, fb2 = _facet(df, "authors", kind), _facet(df, "fb2_authors", kind)
    known = F.when(F.size(db) > 0, db).otherwise(fb2)
    chosen = known if fallback else F.when(F.col("has_db"), db).otherwise(known)
    if prefer is Preference.REPLACE:
        chosen = F.when(F.size(fb2) > 0, fb2).otherwise(chosen)
    return chosen


def _genres(df: DataFrame) -> Column:
    db, fb2 = _facet(df, "genres", "array<struct<code:string>>"), _facet(df, "fb2_genres", "array<struct<code:string>>")
    return genre_codes(F.transform(F.when(F.size(db) > 0, db).otherwise(fb2), lambda g: g["code"]))


def _fields(view: DataFrame, options: Options) -> dict[str, Column]:
    c = F.col
    ext = F.when(c("file_type") != "", c("file_type")).otherwise(file_ext(c("file")))
    date = date_only(c("time"))
    language = c("language") if "language" in view.columns else preferred(c("db_language"), c("fb2_language"))
    return {
        "authors": people(selected_authors(view, options.prefer)), "genres": _genres(view), "title": preferred(c("db_title"), c("fb2_title")),
        "file_stem": F.when(file_stem(c("file")) != "", file_stem(c("file"))).otherwise(present(c("book_id"))), "ext": F.regexp_replace(ext, r"^\.", ""),
        "date": F.when(date != "", date).otherwise(c("file_date")), "lang": F.trim(language), "words": preferred(c("db_keywords"), c("fb2_keywords")), "year_text": preferred(c("db_year"), c("fb2_year")),
    }


def _all_series(view: DataFrame, options: Options) -> Column:
    db = db_series(_facet(view, "series", _SERIES), options.series)
    fb2 = fb2_series(_facet(view, "fb2_series", _NODES), _facet(view, "fb2_publication_series", _NODES), options.series, options.flatten, options.separator)
    return select_series(db, fb2, options.prefer, options.dedup)


def positional_rows(view: DataFrame, options: Options = Options()) -> DataFrame:
    """view with line: one per row, null where neither source has the book. Fields are cut to their limits."""
    named = view.select("*", *[v.alias(f"_{k}") for k, v in _fields(view, options).items()])
    one = single_series(_facet(view, "series", _SERIES), _facet(view, "fb2_series", _NODES), options.series, options.prefer)
    authors = limited_people(selected_authors(view, options.prefer), (options.author_limit,) * 3, options.quick_fix)
    named = named.withColumn("_one", one)
    fix = lambda value, most: truncate_field(present(value), most, options.quick_fix)
    c = F.col
    fields = [authors, c("_genres"), fix(c("_title"), options.title_limit), fix(c("_one.name"), options.series_limit), series_number_text(c("_one.number")), c("_file_stem"), c("size").cast("string"),
              present(c("book_id")), c("deleted"), c("_ext"), c("_date"), c("_lang"), rating_whole(c("rating")), fix(c("_words"), options.keywords_limit)]
    if options.extended:
        fields += [c("md5"), c("replaced_by")]
    line = F.when(c("has_db") | c("has_fb2"), join_fields(*fields))
    return named.withColumn("line", line).select(*view.columns, "line")


#: The fields of a position without a book, before and after its number.
_DUMMY = ("dummy:", "other:", "dummy record", "", "", "", "1"), ("1", "EXT", "2000-01-01", "en", "0", "")


def dummy_line(index: Column) -> Column:
    """The positional line of an entry without a book, in any format; positions count from 1 in it."""
    before, after = _DUMMY
    return join_fields(*map(F.lit, before), (index + 1).cast("string"), *map(F.lit, after))


def without_ignored(rows: DataFrame, ignored: DataFrame | None) -> DataFrame:
    """Rows with a locator that is in none of its archive's ignored ranges (archive, start, end)."""
    if ignored is None:
        return rows
    held = ignored.groupBy(F.col("archive").alias("_of")).agg(F.collect_list(F.struct("start", "end")).alias("_ignored"))
    return rows.join(held, F.col("locator.source") == F.col("_of"), "left").where(~in_ranges(F.col("locator.index"), F.col("_ignored"))).drop("_of", "_ignored")


def positional_export(view: DataFrame, archives: DataFrame, ignored: DataFrame | None = None, options: Options = Options()) -> DataFrame:
    """(archive, index, line, is_dummy): a line for every position of every archive (id, entries) that is not ignored.

    Rows without a book and positions without a row get a dummy line. Rows without an archive are left out,
    but where no archive is declared: then all are numbered through, by book, as one archive of that name.
    A row of an undeclared archive, or a second one at a position, is an error when it is read.
    """
    entries = without_ignored(view.where("locator.kind = 'archive_entry'"), ignored)
    rows = positional_rows(entries, options).select(F.col("locator.source").alias("archive"), F.col("locator.index").alias("index"), "line")
    if archives.isEmpty():
        online = positional_rows(view.where("locator.kind <> 'archive_entry'"), options)
        placed = running_index(online.select(F.col("locator.book_id").alias("book"), "line"), "book", "index")
        rows = rows.union(placed.select(F.lit(options.online_archive).alias("archive"), "index", "line"))
        archives = archives.sparkSession.createDataFrame([(options.online_archive, 0)], "id string, entries long")
    sizes = archives.select(F.col("id").alias("archive"), F.col("entries").cast("long").alias("entries"))
    known = sizes.select(F.col("archive").alias("_id"))
    undeclared = F.raise_error(F.concat(F.lit("undeclared archive "), F.col("archive")))
    rows = rows.join(known, F.col("archive") == F.col("_id"), "left").withColumn("archive", F.when(F.col("_id").isNull(), undeclared).otherwise(F.col("archive"))).drop("_id")
    twice = F.raise_error(F.concat(F.lit("two records at "), F.col("archive"), F.lit(":"), F.col("index").cast("string")))
    rows = rows.groupBy("archive", "index").agg(F.first("line").alias("line"), F.count("*").alias("n")).withColumn("index", F.when(F.col("n") > 1, twice.cast("bigint")).otherwise(F.col("index")))
    gaps = missing_positions(sizes, rows, "archive", "index", ignored)
    made = rows.select("archive", "index", F.coalesce("line", dummy_line(F.col("index"))).alias("line"), F.col("line").isNull().alias("is_dummy"))
    return made.union(gaps.select("archive", "index", dummy_line(F.col("index")), F.lit(True)))


def exportable(view: DataFrame) -> DataFrame:
    """Rows with a title whose file is a book: what the other layouts take."""
    c = F.col
    ext = F.when(c("file_type") != "", c("file_type")).otherwise(file_ext(c("file")))
    return view.where((F.lower(F.regexp_replace(ext, r"^\.", "")) == "fb2") & (preferred(c("db_title"), c("fb2_title")) != ""))


def series_rows(view: DataFrame, options: Options = Options()) -> DataFrame:
    """One row per book and series, with its rendered fields; books without series have one row without."""
    books = exportable(view)
    named = books.select("*", *[v.alias(f"_{k}") for k, v in _fields(books, options).items()], _all_series(books, options).alias("_series"))
    rows = named.select("*", F.posexplode_outer("_series").alias("_pos", "_one"))
    c = F.col
    out = {"author": c("_authors"), "genre": c("_genres"), "title": cleanse(c("_title")), "series_name": cleanse(present(c("_one.name"))), "series_number": cleanse(series_number_text(c("_one.number"))),
           "file_field": cleanse(c("_file_stem")), "size_field": c("size").cast("string"), "lib_id": present(c("book_id")), "del_field": cleanse(c("deleted")), "ext_field": cleanse(c("_ext")),
           "date_field": cleanse(c("_date")), "lang_field": cleanse(c("_lang")), "rate_field": c("rating"), "keywords_field": keywords(c("_words")), "year_field": cleanse(c("_year_text"))}
    return rows.select(*books.columns, F.coalesce(c("_pos"), F.lit(0)).alias("book_row"), *[v.alias(k) for k, v in out.items()])


_COMMON = ["author", "genre", "title", "series_name", "series_number", "file_field", "size_field", "lib_id", "del_field", "ext_field", "date_field"]


def multi_series_export(view: DataFrame, options: Options = Options(), ignored: DataFrame | None = None, online: bool = False) -> DataFrame:
    """(archive, index, book_row, line) with the fields of MULTI_FIELDS, but for positions in ignored ranges (archive, start, end).

    Books without an archive are left out, or with `online`, where no archive is declared, numbered through, by book.
    """
    rows = series_rows(view if online else view.where("locator.kind = 'archive_entry'"), options)
    rows = without_ignored(rows, ignored)
    online = running_index(rows.where("locator.kind <> 'archive_entry'").select(F.col("locator.book_id").alias("_book")).distinct(), "_book", "_at")
    rows = rows.join(online, (F.col("locator.kind") != "archive_entry") & (F.col("locator.book_id") == F.col("_book")), "left")
    line = join_fields(*[F.col(x) for x in (*_COMMON, "lang_field", "rate_field", "keywords_field", "year_field")], cleanse(F.lit(options.source_library)))
    return rows.select(F.when(F.col("locator.kind") == "archive_entry", F.col("locator.source")).otherwise(options.online_archive).alias("archive"), F.coalesce("locator.index", "_at").alias("index"), "book_row", line.alias("line"))


def slice_export(view: DataFrame, where: str | None = None, split_by: str | None = None, options: Options = Options(), ignored: DataFrame | None = None) -> DataFrame:
    """(member, archive, index, accepted_row, accepted_book, input_record, line) with the fields of SLICE_FIELDS.

    `where` is a SQL condition on a row's columns, with one_of, contains_value and range_name; it decides
    per series row, so a book may keep some of its rows. `split_by` is a SQL text on the same columns;
    a book's first accepted row names the member for all. Only rows of archives take part, and none in an
    ignored range (archive, start, end).
    """
    rows = series_rows(without_ignored(view.where("locator.kind = 'archive_entry'"), ignored), options)
    c = F.col
    rows = rows.withColumns({"selected_authors": selected_authors(rows, options.prefer, fallback=True), "archive": c("locator.source"), "index": c("locator.index"), "ins_no": (c("locator.index") + 1).cast("string"), "folder": c("locator.source"),
                             "is_deleted": is_deleted(c("deleted"))})
    accepted = F.expr(where) if where else F.lit(True)
    key = F.expr(split_by).cast("string") if split_by else F.col("archive")
    kept = accepted_ordinals(rows, [], ["archive", "index"], accepted, key, ["book_row"], spread=["archive"])
    line = join_fields(*[c(x) for x in (*_COMMON, "ins_no", "folder", "lang_field", "rate_field", "keywords_field", "year_field")])
    return kept.select(split_key(present(c("split_key"))).alias("member"), "archive", "index", "accepted_row", "accepted_book", "input_record", line.alias("line"))


def annotations(view: DataFrame) -> DataFrame:
    """(archive, xml): the annotations of an archive's books, in order, as one escaped document."""
    rows = view.where((F.col("locator.kind") == "archive_entry") & (F.col("fb2_annotation") != ""))
    item = F.struct(F.col("locator.index").alias("i"), F.concat(F.lit('<annotation file="'), xml_escape(file_stem(F.col("file"))), F.lit('">'), xml_escape(F.col("fb2_annotation")), F.lit("</annotation>")).alias("x"))
    listed = rows.groupBy(F.col("locator.source").alias("archive")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda r: r["x"]), "\n").alias("x"))
    return listed.select("archive", F.concat(F.lit("<annotations>\n"), "x", F.lit("\n</annotations>")).alias("xml"))


def compilations_json(parts: DataFrame, books: DataFrame) -> DataFrame:
    """One JSON text per compilation: its file, the parts found, and whether they cover it. books has book, folder, file."""
    name = books.select(F.col("book").alias("match"), F.col("folder").alias("part_folder"), F.col("file").alias("part_file"))
    part = F.struct("part", "part_folder", "part_file")
    grouped = parts.join(name, "match").groupBy("book").agg(F.sort_array(F.collect_list(part)).alias("p"), F.first("covered").alias("covered"))
    compilation = F.transform("p", lambda p: F.struct(p["part"].alias("part"), p["part_folder"].alias("folder"), p["part_file"].alias("file")))
    return grouped.join(books, "book").select("book", F.to_json(F.struct("folder", "file", compilation.alias("compilation"), "covered")).alias("json"))


def export_diagnostics(view: DataFrame, options: Options = Options(), raw_language: str = "") -> DataFrame:
    """(archive, books, disambiguated_books, disambiguated_authors, canonical_languages): what an export changed.

    Authors count where the catalogue's are shown and carry a suffix; languages where `raw_language`, a column
    with what the sources said, differs from the view's language.
    """
    kind = EMPTY_PERSONS.simpleString()
    db, fb2 = _facet(view, "authors", kind), _facet(view, "fb2_authors", kind)
    shown = (F.size(db) > 0) & ~(F.lit(options.prefer is Preference.REPLACE) & (F.size(fb2) > 0))
    told = F.when(shown, F.size(F.filter(db, lambda p: present(p["suffix"]) != ""))).otherwise(0)
    changed = (F.col("language") != F.col(raw_language)) if raw_language else F.lit(False)
    archive = F.when(F.col("locator.kind") == "archive_entry", F.col("locator.source")).otherwise(options.online_archive)
    return view.select(archive.alias("archive"), told.alias("_told"), changed.alias("_changed")).groupBy("archive").agg(
        F.count("*").alias("books"), F.count_if(F.col("_told") > 0).alias("disambiguated_books"), F.sum("_told").cast("long").alias("disambiguated_authors"), F.count_if("_changed").alias("canonical_languages"))


def export_counts(rows: DataFrame, by: list[str], **conditions: Column) -> DataFrame:
    """Rows and conditions counted per group."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), *[F.count_if(c).alias(k) for k, c in conditions.items()])
