"""Catalogue facets: two physical schemas, one book-centred nested record.

Adapters rename either schema's tables to common facets, all keyed by book_id; everything after them
knows one schema. Every ordered collection carries its order in the rows, with the id as last tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelf.operators.authors import author_suffixes, collision_groups, with_suffixes

DIALECT_A, DIALECT_B = "a", "b"
#: The dumps that are imported for the second schema.
IMPORTED_B = ("libavtor.sql", "libavtors.sql", "libbook.sql", "libgenre.sql", "libgenres.sql", "librate.sql", "libseq.sql", "libseqs.sql")

BOOK_TYPES = {
    "book_id": "long", "file_size": "long", "time": "timestamp", "title": "string", "lang": "string", "src_lang": "string", "file_type": "string",
    "year": "long", "deleted": "string", "file_author": "string", "keywords": "string", "md5": "string", "modified": "timestamp", "replaced_by": "long",
}
_BOOK_NAMES = {
    "file_size": "FileSize", "time": "Time", "title": "Title", "lang": "Lang", "src_lang": "SrcLang", "file_type": "FileType", "year": "Year",
    "deleted": "Deleted", "file_author": "FileAuthor", "keywords": "keywords", "md5": "md5", "modified": "Modified", "replaced_by": "ReplacedBy",
}
PERSON = ("first_name", "middle_name", "last_name", "nick_name")


def detect_dialect(book_columns: list[str]) -> str:
    """The schema whose key the book table has; neither or both is an error."""
    found = [d for d, key in ((DIALECT_A, "bookid"), (DIALECT_B, "bid")) if key in {c.lower() for c in book_columns}]
    if len(found) != 1:
        raise ValueError(f"cannot tell the catalogue's schema from columns {book_columns}")
    return found[0]


def _named(df: DataFrame, /, **columns: str) -> DataFrame:
    """Select by case-insensitive names; a column that the table lacks is null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[old.lower()]}`") if old.lower() in have else F.lit(None)).alias(new) for new, old in columns.items()])


class Catalogue:
    """The tables of a catalogue by lower-case name; those that are missing are empty facets."""

    def __init__(self, tables: dict[str, DataFrame], dialect: str | None = None):
        self.tables = {k.lower(): v for k, v in tables.items()}
        self.dialect = dialect or detect_dialect(self.tables["libbook"].columns)
        self.key = "BookId" if self.dialect == DIALECT_A else "bid"
        self.spark: SparkSession = self.tables["libbook"].sparkSession

    def _table(self, table: str, /, **columns: str) -> DataFrame:
        if table in self.tables:
            return _named(self.tables[table], **columns)
        return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    def books(self, file_type: str | None = "fb2") -> DataFrame:
        """One row per book; NUL padding of checksums goes."""
        rows = self._table("libbook", book_id=self.key, **_BOOK_NAMES)
        rows = rows.select(*[F.col(c).cast(t).alias(c) for c, t in BOOK_TYPES.items()]).withColumn("md5", F.replace("md5", F.lit("\0"), F.lit("")))
        return rows if file_type is None else rows.where(F.col("file_type") == file_type)

    def contributors(self, role: str) -> DataFrame:
        """(book_id, pos, person_id, names) for role author, translator or illustrator, people resolved to their main entry."""
        if self.dialect == DIALECT_A:
            table, person = {"author": ("libavtor", "AvtorId"), "translator": ("libtranslator", "TranslatorId"), "illustrator": ("none", "none")}[role]
            links = self._links(table, person, None)
            people = self._table("libavtorname", person_id="AvtorId", first_name="FirstName", middle_name="MiddleName", last_name="LastName", nick_name="NickName",
                                 uid="uid", email="Email", homepage="Homepage", gender="Gender", master_id="MasterId")
            if role == "author":  # translators are not redirected
                links = redirect(links, self._table("libavtoraliase", bad_id="BadId", good_id="GoodId"))
            return links.join(people.withColumn("person_id", F.col("person_id").cast("long")), "person_id")
        people = self._table("libavtors", person_id="aid", first_name="FirstName", middle_name="MiddleName", last_name="LastName", nick_name="NickName",
                             uid="uid", email="Email", homepage="Homepage", gender="gender", main="main")
        return canonical_people(self._links("libavtor", "aid", role[0]), people)

    def _links(self, table: str, person: str, role: str | None) -> DataFrame:
        rows = self._table(table, book_id=self.key, person_id=person, pos="Pos", role="role")
        if role is not None:
            rows = rows.where(F.col("role") == role)
        return rows.select(*[F.col(c).cast("long").alias(c) for c in ("book_id", "person_id", "pos")])

    def genres(self) -> DataFrame:
        """(book_id, genre_id, code, description, meta): codes translated where a translation is known."""
        if self.dialect == DIALECT_A:
            links = self._table("libgenre", book_id="BookId", genre_id="GenreId")
            dim = self._table("libgenrelist", genre_id="GenreId", code="GenreCode", description="GenreDesc", meta="GenreMeta")
        else:
            links = self._table("libgenre", book_id="bid", genre_id="gid")
            dim = self._table("libgenres", genre_id="gid", code="code", description="gdesc", meta="none")
        return translate_codes(links.join(dim, "genre_id"), self._table("libgenretranslate", src="srcGenreCode", trg="trgGenreCode"))

    def series(self) -> DataFrame:
        """(book_id, series_id, name, number, level, type)."""
        if self.dialect == DIALECT_A:
            rows = self._table("libseq", book_id="BookId", series_id="SeqId", number="SeqNumb", level="Level", type="Type")
            dim = self._table("libseqname", series_id="SeqId", name="SeqName")
            return rows.join(dim, "series_id").select("book_id", "series_id", "name", F.col("number").cast("string").alias("number"), F.col("level").cast("long").alias("level"), F.col("type").cast("long").alias("type"))
        rows = self._table("libseq", book_id="bid", series_id="sid", number="sn")
        dim = self._table("libseqs", series_id="sid", name="seqname", kind="type").where(F.col("kind").isin("a", "p"))
        kind = F.when(F.col("kind") == "a", 0).when(F.col("kind") == "p", 1).otherwise(-1).cast("long")
        number = F.col("number").try_cast("double").try_cast("bigint").cast("string")
        return rows.join(dim, "series_id").select("book_id", "series_id", "name", number.alias("number"), F.lit(0).cast("long").alias("level"), kind.alias("type"))

    def ratings(self) -> DataFrame:
        rows = self._table("librate", book_id=self.key, rate="Rate")
        return rating_stats(rows.select("book_id", F.col("rate").cast("int").alias("rate")), "book_id", "rate")

    def filenames(self) -> DataFrame:
        return self._table("libfilename", book_id="BookId" if self.dialect == DIALECT_A else "bid", file_name="FileName").withColumn("book_id", F.col("book_id").cast("long"))

    def merge_events(self) -> DataFrame:
        """(book_id, event_id, time, bad, good, real): an event once for each distinct book in it."""
        rows = self._table("libjoinedbooks", event_id="Id", time="Time", bad="BadId", good="GoodId", real="realId")
        return events_by_participant(rows, ["bad", "good", "real"])

    def suffixes(self) -> DataFrame:
        """(id, suffix) of authors whose names collide."""
        people = self.contributors("author").select(F.col("person_id").cast("string").alias("id"), *PERSON)
        return author_suffixes(collision_groups(people)).select("id", "suffix")

    def record(self, disambiguate: bool = False) -> DataFrame:
        """One nested row per book: every facet aggregated by book first, then joined; nothing fans out.

        With disambiguate, authors carry the suffix that tells them from others of their name.
        """
        person = ["pos", "person_id", *PERSON]
        books = self.books()
        for role in ("author", "translator", "illustrator"):
            people, columns = self.contributors(role), person
            if disambiguate and role == "author":
                people, columns = with_suffixes(people, self.suffixes()), [*person, "suffix"]
            books = attach(books, people.select("book_id", *columns), "book_id", f"{role}s", columns)
        books = attach(books, self.genres(), "book_id", "genres", ["genre_id", "code", "description", "meta"])
        books = attach(books, self.series(), "book_id", "series", ["type", "level", "name", "series_id", "number"])
        books = attach(books, self.filenames(), "book_id", "filenames", ["file_name"])
        books = attach(books, self.merge_events(), "book_id", "joined_books", ["time", "event_id", "bad", "good", "real"])
        return books.join(self.ratings(), "book_id", "left")


def redirect(links: DataFrame, aliases: DataFrame, key: str = "person_id") -> DataFrame:
    """Links with their key replaced by the good id of an alias, one hop; links that fall together stay."""
    known = aliases.select(F.col("bad_id").cast("long").alias("_bad"), F.col("good_id").cast("long").alias("_good"))
    return links.join(known, F.col(key) == F.col("_bad"), "left").withColumn(key, F.coalesce("_good", key)).drop("_bad", "_good")


def canonical_people(links: DataFrame, people: DataFrame) -> DataFrame:
    """Links joined to each person's main entry; a main of 0 or null is the person."""
    main = people.select(F.col("person_id").cast("long").alias("person_id"), F.coalesce(F.nullif(F.col("main").cast("long"), F.lit(0)), F.col("person_id").cast("long")).alias("_main"))
    full = people.withColumn("_id", F.col("person_id").cast("long")).drop("person_id", "main")
    return links.join(main, "person_id").join(full, F.col("_main") == F.col("_id")).withColumn("person_id", F.col("_main")).drop("_main", "_id")


def translate_codes(rows: DataFrame, translations: DataFrame, code: str = "code") -> DataFrame:
    """Rows with a code replaced where a translation (src, trg) exists."""
    known = translations.select(F.col("src").alias("_src"), F.col("trg").alias("_trg"))
    return rows.join(known, F.col(code) == F.col("_src"), "left").withColumn(code, F.coalesce("_trg", code)).drop("_src", "_trg")


def rating_stats(rows: DataFrame, key: str, rate: str) -> DataFrame:
    """Per key the rounded average, count, least and greatest rating; keys without ratings are absent."""
    known = rows.where(F.col(rate).isNotNull())
    return known.groupBy(key).agg(F.round(F.avg(rate), 0).alias("rating_average"), F.count(rate).alias("rating_count"), F.min(rate).alias("rating_min"), F.max(rate).alias("rating_max"))


def ordered_collect(rows: DataFrame, key: str, name: str, order: list[str], payload: list[str] | None = None) -> DataFrame:
    """Per key an array of structs in the order of columns; order columns come first in each struct."""
    fields = list(dict.fromkeys([*order, *(payload or [])]))
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(name))


def attach(books: DataFrame, rows: DataFrame, key: str, name: str, order: list[str]) -> DataFrame:
    """Books with a facet as an ordered array; books without it have null."""
    return books.join(ordered_collect(rows.withColumn(key, F.col(key).cast("long")), key, name, order), key, "left")


def first_per_key(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Per key the value of its first row in an order, found by partial aggregation."""
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order, value)).alias(value))


def file_identities(books: DataFrame, filenames: DataFrame) -> DataFrame:
    """(book_id, stem, ext): the id and its type, or a book's first file name."""
    from shelf.functions.text import file_ext, file_stem

    first = first_per_key(filenames.where(F.trim("file_name") != ""), "book_id", "file_name", ["file_name"])
    joined = books.join(first, "book_id", "left")
    return joined.select("book_id", F.coalesce(file_stem(F.col("file_name")), F.col("book_id").cast("string")).alias("stem"),
                         F.coalesce(file_ext(F.col("file_name")), F.col("file_type")).alias("ext"))


def events_by_participant(events: DataFrame, participants: list[str]) -> DataFrame:
    """An event for each distinct participant as book_id: an equi-join's side instead of a join on OR."""
    ids = F.array_distinct(F.filter(F.array(*[F.col(p).cast("long") for p in participants]), lambda x: x.isNotNull() & (x > 0)))
    return events.withColumn("book_id", F.explode(ids))


def event_map(bad: Column, good: Column, real: Column) -> Column:
    """The participants of an event by role, those unknown left out."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in (("bad", bad), ("good", good), ("real", real))])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def latest(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order, whole."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


EMPTY_PERSONS = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("last_name", "first_name", "middle_name", "suffix")]))
