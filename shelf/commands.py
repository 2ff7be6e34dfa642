"""Whole commands, composed of sources and operators: cache, merge, inspect, export, rollup plan."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.functions.text import file_key, register_functions
from shelf.operators import authors, claims, exports, facets, fingerprints, inspection, language, matching, rollup, validate
from shelf.settings import Settings
from shelf.sources import archives, datasets, dumps, exchange

#: What commands tell their caller: done, new archives were finalised, a cache is not ready, nothing matched.
DONE, NEW, NOT_READY, NO_MATCH = 0, 2, 3, 4


@dataclass(frozen=True)
class Cache:
    """Where materialised intermediates are: archive entries by archive, the catalogue's records, and the list of sources."""

    root: str

    @property
    def entries(self) -> str:
        return f"{self.root}/entries"

    @property
    def catalogue(self) -> str:
        return f"{self.root}/catalogue"

    @property
    def provenance(self) -> str:
        return f"{self.root}/provenance"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _fingerprint(settings: Settings) -> str:
    return f"{settings.parse}/{settings.content_hash}"


def archive_decisions(spark: SparkSession, folder: str, cache: Cache, settings: Settings, rebuild: bool = False, check_md5: bool = False) -> DataFrame:
    """Which archives of a folder can be read from the cache, and which must be scanned; with check_md5, their whole content is compared too."""
    files = archives.archive_files(spark, folder)
    content = F.md5("content") if check_md5 else F.lit(None).cast("string")
    sources = files.select(content.alias("checksum"), F.regexp_extract("path", r"([^/]+)$", 1).alias("archive"), "path", "length", F.unix_micros("modificationTime").alias("modified"), F.lit(_fingerprint(settings)).alias("settings"))
    if _exists(spark, cache.manifest):
        held = spark.read.parquet(cache.manifest)
    else:
        held = spark.createDataFrame([], "archive string, length long, settings string, built long, checksum string")
    return validate.manifest_decisions(sources, held, "archive", ["length", "settings", *(["checksum"] if check_md5 else [])], rebuild)


def cache_ready(spark: SparkSession, folder: str, cache: Cache, settings: Settings) -> bool:
    """Whether the cache of every archive of a folder is there, right, and newer than the archive."""
    return archive_decisions(spark, folder, cache, settings).where("decision <> 'use'").isEmpty()


def build_cache(spark: SparkSession, cache: Cache, settings: Settings, archive_folder: str | None = None, dump_folder: str | None = None, rebuild: bool = False, *,
                check_md5: bool = False, allow_mismatch: bool = False) -> int:
    """Scan new archives and read the catalogue; only archives whose facts changed are scanned again.

    Dumps of several dates are an error unless allowed. What the catalogue was made from is kept beside it.
    """
    code = DONE
    if archive_folder:
        decisions = archive_decisions(spark, archive_folder, cache, settings, rebuild, check_md5)
        plan = decisions.select("archive", "path", "length", "settings", "decision").collect()  # one row per archive
        if any(r["decision"] == "none" for r in plan):
            code = NOT_READY
        todo = [r["path"] for r in plan if r["decision"] == "create"]
        if todo:
            files = spark.read.format("binaryFile").load(todo)
            datasets.write_cache(archives.scan_archives(files, settings.parse, settings.content_hash), cache.entries, ["archive"])
            built = time.time_ns() // 1000
            made = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("archive"), "length", F.lit(_fingerprint(settings)).alias("settings"), F.lit(built).cast("long").alias("built"), F.md5("content").alias("checksum"))
            datasets.write_cache(made, cache.manifest, ["archive"])
    if dump_folder:
        listed = dumps.dump_files(spark, dump_folder)
        dumps.dump_date(listed, allow_mismatch)
        catalogue = facets.Catalogue(dumps.read_catalogue(spark, dump_folder))
        datasets.write_cache(dumps.import_provenance(listed, catalogue.dialect, time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), allow_mismatch), cache.provenance)
        datasets.write_cache(catalogue.record(settings.disambiguate_authors), cache.catalogue)
    return code


def merge_records(entries: DataFrame | None, catalogue: DataFrame | None) -> DataFrame:
    """Archive entries with the books they match; without archives, the catalogue's books.

    With both, books without an entry are left out: the archives say what there is.
    """
    if entries is None:
        if catalogue is None:
            raise ValueError("nothing to merge")
        return catalogue.withColumns({"db_present": F.lit(True), "fb2_present": F.lit(False)})
    books = entries.where("kind = 'book'").withColumn("entry_number", F.col("book_id")).drop("book_id").withColumn("errors", F.array_compact(F.array("error")))
    if catalogue is None:
        return books.withColumns({"db_present": F.lit(False), "book_id": F.lit(None).cast("long")})
    named = catalogue.select("book_id", F.explode("filenames").alias("f")).select(file_key(F.col("f.file_name")).alias("key"), "book_id")
    keyed = books.withColumn("record_id", F.concat_ws("\x00", "archive", F.col("entry_index").cast("string")))
    matched = matching.match_cascade(keyed, catalogue, matching.alias_index(named, "key", "book_id"))
    match = F.when(F.col("method") != "none", F.struct("method", F.col("entry").alias("input"), "alias_key", F.col("matched_id").alias("book_id")))
    known = catalogue.withColumnRenamed("modified", "catalogue_modified").withColumnRenamed("book_id", "_book")
    joined = matched.withColumn("match", match).join(known, F.col("matched_id") == F.col("_book"), "left")
    return joined.withColumns({"db_present": F.col("_book").isNotNull(), "book_id": F.col("matched_id")}).drop("_book", "record_id")


def merge(spark: SparkSession, cache: Cache, settings: Settings, dump_date: str = "") -> datasets.Dataset:
    """The dataset of a cache: its header, and a row of claims per archive entry or book."""
    entries = spark.read.parquet(cache.entries) if _exists(spark, cache.entries) else None
    catalogue = spark.read.parquet(cache.catalogue) if _exists(spark, cache.catalogue) else None
    layouts = None
    if entries is not None:
        layouts = archives.archive_layouts(entries)
        ids = layouts.select(F.col("id").alias("_id"), F.col("name").alias("_name"))
        layouts = layouts.join(archives.layout_spans(entries), layouts.name == F.col("of"), "left").drop("of")
        unknown = F.raise_error(F.concat(F.lit("undeclared archive "), F.col("archive")))
        entries = entries.join(ids, F.col("archive") == F.col("_name"), "left").withColumn("archive", F.coalesce("_id", unknown)).drop("_id", "_name")  # a row per archive
    rows = claims.dataset_rows(merge_records(entries, catalogue))
    collisions = None
    if catalogue is not None and "authors" in catalogue.columns:
        people = catalogue.select(F.explode("authors").alias("p")).select(F.col("p.person_id").cast("string").alias("id"), "p.last_name", "p.first_name", "p.middle_name", "p.nick_name")
        collisions = authors.collision_groups(people)
    listed = dumps.provenance_sources(spark.read.parquet(cache.provenance)) if _exists(spark, cache.provenance) else None
    header = datasets.dataset_header(rows, layouts, dumps=listed, library=settings.library, created=time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), dump_date=dump_date, collisions=collisions, read=datasets.fb2_coverage(rows))
    return datasets.Dataset(header, rows)


def check_dataset(dataset: datasets.Dataset) -> list[str]:
    """What is wrong with a dataset; an empty list if nothing is."""
    spark = dataset.rows.sparkSession
    errors = validate.header_errors(dataset.header)
    listed = [(a["id"], a["ordinal"], a["entries"]) for a in dataset.header["archives"]]
    layouts = spark.createDataFrame(listed, "id string, ordinal long, entries long")
    for name, bad in (("undeclared observations", validate.undeclared_observations(dataset.rows)), ("undeclared sources", validate.undeclared_sources(dataset.rows, layouts)),
                      ("indexes beyond their archive", validate.bad_archive_indexes(dataset.rows, layouts)), ("another number of records", validate.count_error(dataset.header["records"], dataset.rows)),
                      *([("records out of order", validate.order_errors(dataset.rows, layouts))] if "pos" in dataset.rows.columns else [])):
        if n := bad.count():
            errors.append(f"{name}: {n}")
    return errors


def inspect(dataset: datasets.Dataset, *, book_id: int | None = None, archive: str | None = None, index: int | None = None, file: str | None = None) -> DataFrame:
    """A summary, or the first row of a book, of an entry or of a file."""
    mode = inspection.lookup_mode(book_id=book_id, archive=archive, index=index, file=file)
    if mode == "summary":
        return inspection.dataset_summary(dataset.rows)
    condition = {"book_id": lambda: inspection.has_book(book_id), "archive": lambda: inspection.at_entry(archive, index), "file": lambda: inspection.has_file(file)}[mode]()
    return inspection.first_match(dataset.rows, condition, ["locator.source", "locator.index", "locator.book_id"])


def _view(dataset: datasets.Dataset, settings: Settings) -> DataFrame:
    view = claims.flat_view(dataset.rows)
    if not settings.language.canonicalize:
        return view
    known = settings.language
    rules = language.LanguageRules(aliases=known.aliases, ignore=known.ignore_patterns, locales=known.fallback_locales)
    return language.canonical_language(view, rules, db="db_language", fb2="fb2_language", db_source="db_source_language", fb2_source="fb2_source_language")


def export(dataset: datasets.Dataset, settings: Settings, layout: str, options: exports.Options = exports.Options(), *, where: str | None = None, split_by: str | None = None) -> DataFrame:
    """(member, index, line) of a layout: positional, multi-series or slice."""
    spark = dataset.rows.sparkSession
    register_functions(spark)
    view = _view(dataset, settings)
    listed = dataset.header["archives"]
    layouts = spark.createDataFrame([(a["id"], a["entries"]) for a in listed], "id string, entries long")
    spans = [(a["id"], r["start"], r["end"]) for a in listed for r in a.get("ignored") or []]
    ignored = spark.createDataFrame(spans, "archive string, start long, end long") if spans else None
    if layout == "positional":
        lines = exports.positional_export(view, layouts, ignored, options)
    elif layout == "multi-series":
        lines = exports.multi_series_export(view, options, ignored, online=not listed)
    elif layout == "slice":
        return exports.slice_export(view, where, split_by, options, ignored)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return lines.withColumn("member", F.concat("archive", F.lit(".inp")))


def write_export(lines: DataFrame, path: str, settings: Settings, dump_date: str, members: list[str] | None = None, structure: str = "") -> None:
    """An export as one ZIP, with its information members; structure is the field list of layouts that say theirs."""
    order = [c for c in ("index", "book_row") if c in lines.columns]
    info = {"collection.info": exchange.collection_info(settings.library, dump_date), "version.info": exchange.version_info(dump_date)}
    if structure:
        info = {"structure.info": exchange.structure_info(structure)} | info
    exchange.write_zip(lines, path, order=order, members=members, info=info, comment=exchange.zip_comment(settings.library, dump_date))


def export_members(dataset: datasets.Dataset, layout: str) -> list[str]:
    """The members that an export has even without lines: one per declared archive, but for slices."""
    return [] if layout == "slice" else [f"{a['id']}.inp" for a in dataset.header["archives"]]


def write_annotations(dataset: datasets.Dataset, settings: Settings, path: str) -> int:
    """The annotations of books, an XML member per archive that has any, as one ZIP; without any no file. Returns the members."""
    found = exports.annotations(_view(dataset, settings)).select(F.concat("archive", F.lit(".xml")).alias("member"), F.col("xml").alias("line"))
    if found.isEmpty():
        return 0
    exchange.write_zip(found, path)
    return found.count()


def write_compilations(dataset: datasets.Dataset, path: str) -> int:
    """Books that hold other books, as compilations.json in one ZIP; without any no file. Returns the compilations."""
    rows = dataset.rows
    if "fb2_sections" not in rows.columns:
        return 0
    named = rows.withColumn("book", F.concat_ws("\x00", "locator.source", F.col("locator.index").cast("string")))
    sections = named.select("book", F.posexplode("fb2_sections").alias("pos", "s")).select("book", F.col("pos").cast("long").alias("pos"), "s.depth", "s.key", "s.leaf")
    roots = sections.where("depth = 0").select("key", F.col("book").alias("match"))
    books = named.select("book", F.col("locator.source").alias("folder"), F.col("artifact.name").alias("file"))
    found = exports.compilations_json(fingerprints.compilation_parts(sections, roots), books)
    if found.isEmpty():
        return 0
    whole = found.agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("json")), ","), F.lit("]")).alias("line")).select(F.lit("compilations.json").alias("member"), "line")
    exchange.write_zip(whole, path)
    return found.count()


def new_downloads(spark: SparkSession, pages: str, folder: str, pattern: str) -> DataFrame:
    """(link, begin, end): what index pages (a folder of texts) offer beyond the archives of a folder, by begin.

    pattern has two groups, the first and the last id of a file's name, and fits links and names alike.
    """
    texts = spark.read.text(pages, wholetext=True)
    links = rollup.page_links(texts, "value", f'href="([^"]*{pattern}[^"]*)"')
    here = archives.archive_files(spark, folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))
    last = rollup.high_water(here, "name", pattern).first()["end"]  # one row
    return rollup.new_ranges(links, pattern, last or 0).orderBy("begin")


def decoded_sections(row: DataFrame) -> DataFrame:
    """The sections of a looked-up row as an export of its fingerprint decodes: pos, depth, key as hex, leaf."""
    if "fb2_sections" not in row.columns:
        return row.where("false").select(F.lit(0).alias("pos"))
    sections = row.select(F.lit(1).alias("book"), F.posexplode("fb2_sections").alias("pos", "s")).select("book", "pos", "s.*")
    return inspection.decoded_fingerprints(fingerprints.encoded_fingerprints(sections)).drop("book").orderBy("pos")


def write_merged(dataset: datasets.Dataset, path: str, settings: Settings, order: list[str]) -> str:
    """The dataset as one file in the settings' compression; returns its path."""
    keys = [f"_{o.replace('.', '_')}" for o in order]
    rows = dataset.rows.select("*", *[F.col(o).alias(k) for o, k in zip(order, keys, strict=True)])
    return datasets.write_dataset(datasets.Dataset(dataset.header, rows), path, keys, settings.compression, columns=dataset.rows.columns)


def plan_rollup(finalised: DataFrame, active: DataFrame, updates: DataFrame, settings: Settings) -> tuple[DataFrame, int]:
    """The archives that updates would be written to, and whether any is finalised (NEW).

    All three have entries (archive, book_id, size): those in finalised archives, in the one in progress, and in
    updates. Without one in progress, the last finalised archive is made anew with them if it has room.
    """
    end = finalised.agg(F.coalesce(F.max("book_id"), F.lit(0))).first()[0]
    used = active.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if used:
        plan = rollup.plan_archives(rollup.new_entries(updates, end, active, order=["archive"]), settings.rollup_bytes, used=used)
    else:
        newest = finalised.agg(F.max_by("archive", "book_id")).first()[0]
        last = finalised.where(F.col("archive") == F.lit(newest)) if newest else finalised.where("false")
        plan = rollup.plan_archives(rollup.with_last_archive(last, updates, finalised_end=end, target=settings.rollup_bytes), settings.rollup_bytes)
    return plan, NEW if plan.where("finalised").limit(1).count() else DONE


def rollup_folders(spark: SparkSession, finalised: str, updates: str, settings: Settings, active: str | None = None) -> tuple[DataFrame, int]:
    """plan_rollup of folders of archives; entries whose names are no numbers take no part."""
    def entries(folder: str) -> DataFrame:
        rows = archives.scan_archives(archives.archive_files(spark, folder))
        return rows.where("book_id > 0").select("archive", "book_id", F.col("uncompressed_size").alias("size"))

    done = entries(finalised)
    return plan_rollup(done, entries(active) if active else done.where("false"), entries(updates), settings)
