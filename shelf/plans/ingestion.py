"""Queries through the sources and sinks: dumps, archives, books, datasets, caches and streams.

The driver's tables are first written as what a source reads (statements, ZIP files, XML, JSON Lines, a
folder of new files), then read back; the SQL states what must come out of the tables themselves.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.functions import text as tx
from shelf.functions import values as vl
from shelf.operators import facets, fingerprints, inspection, validate
from shelf.plans.catalogue import _DIGEST_SQL, _LINES_SQL, _WORDS_SQL, _lines, _text64, query
from shelf.session import new_folder, table
from shelf.sources import archives, datasets, dumps
from shelf.streaming import ingest


def _written(rows: DataFrame, name: str) -> str:
    """Lines as a text source of that name."""
    path = f"{new_folder(rows.sparkSession, 'text')}/{name}"
    rows.write.text(path)
    return path


def _quoted(value: Column) -> Column:
    """A text as dump programs quote it."""
    for old, new in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n")):
        value = F.replace(value, F.lit(old), F.lit(new))
    return F.concat(F.lit("'"), value, F.lit("'"))


def _dump(rows: DataFrame, name: str, columns: list[str], values: Column) -> DataFrame:
    """The lines of a dump: a declaration, then statements of many tuples each."""
    head = ["-- dump", "ALTER DATABASE x;", f"CREATE TABLE `{name}` (", *[f"  `{c}` text{',' if c != columns[-1] else ''}" for c in columns], ") ENGINE=InnoDB;"]
    tuples = rows.select(F.spark_partition_id().alias("p"), F.concat(F.lit("("), values, F.lit(")")).alias("t"))
    inserts = tuples.groupBy("p").agg(F.concat(F.lit(f"INSERT INTO `{name}` VALUES "), F.array_join(F.collect_list("t"), ","), F.lit(";")).alias("value")).select("value")
    declared = rows.sparkSession.range(0, 1, 1, 1).select(F.explode(F.array(*map(F.lit, head))).alias("value"))
    return declared.coalesce(1).union(inserts)


# --- dumps ------------------------------------------------------------------------------------

@query("""SELECT c_custkey::VARCHAR AS "Id", c_name || ' it''s \\ "q"' || chr(10) || 'x' AS "Name", CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey::VARCHAR END AS "Nation" FROM customer""")
def dump_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of INSERT statements: quotes, escapes and NULL."""
    rows = table(spark, sf, "customer")
    text = _quoted(F.concat("c_name", F.lit(" it's \\ \"q\"\nx")))
    nation = F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("string")).otherwise("NULL")
    lines = _dump(rows, "libcustomer", ["Id", "Name", "Nation"], F.concat_ws(",", F.col("c_custkey").cast("string"), text, nation))
    return dumps.read_dump(spark, _written(lines, "libcustomer.sql"))


@query("""SELECT c_custkey::VARCHAR AS "BadId", (c_custkey + 1)::VARCHAR AS "GoodId" FROM customer""")
def alias_dump(spark: SparkSession, sf: str) -> DataFrame:
    """The alias dump, whose rows may have a surrogate key before their columns."""
    key = F.col("c_custkey").cast("string")
    more = F.when(F.col("c_custkey") % 2 == 0, F.lit("0"))
    lines = _dump(table(spark, sf, "customer"), "libavtoraliase", ["BadId", "GoodId"], F.concat_ws(",", more, key, (F.col("c_custkey") + 1).cast("string")))
    return dumps.read_dump(spark, _written(lines, dumps.ALIAS_DUMP))


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS date, CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%H:%M:%S') END AS time FROM events""")
def dump_stamps(spark: SparkSession, sf: str) -> DataFrame:
    """Date and zero-padded time of a dump's last line."""
    stamp = F.concat(F.lit("x\n-- Dump completed on "), F.date_format("ts", "yyyy-MM-dd  H:mm:ss"), F.lit("\n"))
    rows = table(spark, sf, "events").select("event_id", vl.dump_stamp(F.when(F.col("event_id") % 5 != 0, stamp).otherwise("-- dump")).alias("s"))
    return rows.select("event_id", "s.date", "s.time")


def _dump_files(spark: SparkSession, sf: str) -> DataFrame:
    """What a folder of dumps lists: a file per nation."""
    day = F.to_timestamp(F.lit("2026-06-22 01:02:03"))
    return table(spark, sf, "nation").select(F.concat(F.lit("lib"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(".sql")).alias("name"), F.lit("2026-06-22").alias("dump_date"), F.lit("01:02:03").alias("dump_time"),
                                             F.timestamp_add("HOUR", F.col("n_nationkey"), day).alias("modificationTime"))


@query("""SELECT 'a' AS dialect, 'now' AS imported, '2026-06-22' AS dump_date, 'lib' || lpad(n_nationkey::VARCHAR, 2, '0') || '.sql' AS name, '01:02:03' AS dump_time,
strftime(TIMESTAMP '2026-06-22 01:02:03' + to_hours(n_nationkey), '%Y-%m-%dT%H:%M:%SZ') AS modified, (SELECT max(n_nationkey) FROM nation)::BIGINT AS latest FROM nation""")
def import_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """What an import was made from, and the time of its latest dump."""
    files = _dump_files(spark, sf)
    made = dumps.import_provenance(files, "a", "now")
    latest = dumps.latest_change(files).select(((F.unix_seconds("modified") - F.unix_seconds(F.to_timestamp(F.lit("2026-06-22 01:02:03")))) / 3600).cast("long").alias("latest"))
    listed = dumps.provenance_sources(made).drop("dump_date")
    return listed.join(made.select("dialect", "imported", "dump_date")).join(latest)  # one row each


# --- archives and books -----------------------------------------------------------------------

def _zips(rows: DataFrame) -> DataFrame:
    """(path, content): ZIP files of rows (archive, place, entry, content), entries in the order of their places."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for entry, content in pdf.sort_values("place")[["entry", "content"]].itertuples(index=False):
                z.writestr(zipfile.ZipInfo(entry, (2026, 6, 22, 1, 2, 4)), content)
        return pd.DataFrame({"path": ["x/" + pdf["archive"].iloc[0]], "content": [out.getvalue()]})

    return rows.groupBy("archive").applyInPandas(build, "path string, content binary")


def _document_entries(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("doc_id")
    ext = F.when(n % 11 == 3, "org").when(n % 11 == 5, "txt").otherwise("fb2")
    return table(spark, sf, "documents").select(F.concat(F.lit("a"), (n % 7).cast("string"), F.lit(".zip")).alias("archive"), n.alias("place"), F.concat(n.cast("string"), F.lit("."), ext).alias("entry"),
                                                F.coalesce("text", F.lit("")).cast("binary").alias("content"))


_ENTRIES_SQL = """entries AS (SELECT 'a' || doc_id % 7 || '.zip' AS archive, (row_number() OVER (PARTITION BY doc_id % 7 ORDER BY doc_id) - 1)::BIGINT AS entry_index, doc_id,
    CASE doc_id % 11 WHEN 3 THEN 'org' WHEN 5 THEN 'txt' ELSE 'fb2' END AS ext, CASE doc_id % 11 WHEN 3 THEN 'ignored' WHEN 5 THEN 'dummy' ELSE 'book' END AS kind, coalesce(text, '') AS t FROM documents)"""


@query(f"""WITH {_ENTRIES_SQL} SELECT archive, entry_index, doc_id || '.' || ext AS entry, doc_id AS book_id, ext, kind, strlen(t)::BIGINT AS uncompressed_size, '2026-06-22T01:02:04Z' AS modified,
CASE WHEN kind = 'book' THEN md5(t) END AS content_md5, NULL::VARCHAR AS error FROM entries""")
def zip_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of ZIP files in their own order, with the books' hashes."""
    return archives.scan_archives(_zips(_document_entries(spark, sf)), None, with_hash=True).drop("compressed_size")


@query(f"""WITH {_ENTRIES_SQL}, runs AS (SELECT archive, kind, min(entry_index) AS a, max(entry_index) AS b FROM (SELECT *, entry_index - row_number() OVER (PARTITION BY archive, kind ORDER BY entry_index) AS run FROM entries) GROUP BY archive, kind, run),
spans AS (SELECT archive, string_agg(a || '-' || b, ',' ORDER BY a) FILTER (kind = 'ignored') AS ignored, string_agg(a || '-' || b, ',' ORDER BY a) FILTER (kind = 'dummy') AS dummy FROM runs GROUP BY archive),
counts AS (SELECT archive, count(*) AS entries, count(*) FILTER (kind = 'book') AS fb2_entries FROM entries GROUP BY archive)
SELECT printf('archive-%04d', row_number() OVER (ORDER BY archive)) AS id, row_number() OVER (ORDER BY archive) - 1 AS ordinal, archive AS name, entries, fb2_entries, ignored, dummy FROM counts JOIN spans USING (archive)""")
def archive_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Archives in order, with their counts and the runs of ignored and of other entries."""
    entries = archives.scan_archives(_zips(_document_entries(spark, sf)))
    spans = archives.layout_spans(entries)
    shown = lambda c: F.array_join(F.transform(c, lambda r: F.concat(r["start"].cast("string"), F.lit("-"), r["end"].cast("string"))), ",").alias(c)
    layouts = archives.archive_layouts(entries)
    return layouts.join(spans, layouts.name == spans.of, "left").select("id", "ordinal", "name", "entries", "fb2_entries", shown("ignored"), shown("dummy"))


def _book_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Books in XML, every thirteenth broken."""
    n, text = F.col("doc_id").cast("string"), lambda s: F.lit(s)
    body = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x1f\x7f-\x9f￾￿]+", " ")
    xml = F.concat(
        text('<?xml version="1.0" encoding="utf-8"?><FictionBook xmlns:l="x"><description><title-info><genre match="90">g'), n, text("</genre><author><first-name>F</first-name><last-name>L"), n,
        text("</last-name></author><book-title>Old</book-title><book-title> Title "), n, text(" &amp; <strong>b</strong>old </book-title><annotation><p>A <em>x</em>.</p></annotation><lang>"), F.col("lang"),
        text('</lang><sequence name="U"><sequence name="C'), n, text('" number="7"/></sequence></title-info><src-title-info><book-title>Orig</book-title><lang>la</lang></src-title-info><document-info><id>d'), n,
        text('</id></document-info><publish-info><year>19'), F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0"), text('</year><isbn>i</isbn></publish-info><output mode="free" price="'), n,
        text('"><part type="simple" l:href="#p"/><output-document-class name="c"><part include="deny"/></output-document-class></output></description><body><section><p>'), tx.xml_escape(body), text("</p></section>"),
        F.when(F.col("doc_id") % 13 == 6, "</broken>").otherwise("</body></FictionBook>"))
    return table(spark, sf, "documents").select(F.concat(F.lit("b"), (F.col("doc_id") % 5).cast("string"), F.lit(".zip")).alias("archive"), F.col("doc_id").alias("place"), F.concat(n, F.lit(".fb2")).alias("entry"), xml.cast("binary").alias("content"))


@query("""WITH d AS (SELECT *, doc_id % 13 <> 6 AS ok, doc_id::VARCHAR AS n FROM documents)
SELECT doc_id AS book_id, ok AS fb2_present, CASE WHEN ok THEN 'Title ' || n || ' & bold' END AS title, CASE WHEN ok THEN lang END AS lang, CASE WHEN ok THEN 'A x.' END AS annotation, CASE WHEN ok THEN 'g' || n || '@90' END AS genre,
CASE WHEN ok THEN 'L' || n || ',F' END AS author, CASE WHEN ok THEN 'U/C' || n || '#7' END AS series, CASE WHEN ok THEN 'd' || n END AS document_id, CASE WHEN ok THEN '19' || lpad((doc_id % 100)::VARCHAR, 2, '0') END AS year,
CASE WHEN ok THEN 'Orig/la' END AS original, CASE WHEN ok THEN 'free,' || n || ',#p,deny' END AS output FROM d""")
def fb2_books(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptions of books read from XML in ZIP files; one that is broken has an error and no description."""
    rows = archives.scan_archives(_zips(_book_entries(spark, sf)), "fingerprint")
    first = lambda c: F.get(c, F.lit(0))
    genre, author, series, output = first("fb2_genres"), first("fb2_authors"), F.get("fb2_series", F.lit(1)), first("fb2_output")
    made = {"title": F.col("fb2_title"), "lang": F.col("fb2_lang"), "annotation": F.col("fb2_annotation"), "genre": F.concat(genre["code"], F.lit("@"), genre["match"]), "author": F.concat(author["last_name"], F.lit(","), author["first_name"]),
            "series": F.concat(F.array_join(series["path"], "/"), F.lit("#"), series["number"]), "document_id": F.col("fb2_document_id"), "year": F.col("fb2_year"), "original": F.concat("fb2_original_title", F.lit("/"), "fb2_original_lang"),
            "output": F.concat_ws(",", output["mode"], output["price"], first(output["parts"])["href"], first(first(output["document_classes"])["parts"])["include"])}
    present = F.col("fb2_present") & F.col("fb2_error").isNull()
    return rows.select("book_id", present.alias("fb2_present"), *[F.when(present, v).alias(k) for k, v in made.items()])


@query(f"""WITH sections AS (SELECT doc_id, 0 AS line, text AS t FROM documents), {_WORDS_SQL}, {_DIGEST_SQL.format(k='doc_id', h='words')}
SELECT d.doc_id AS book_id, {_text64("coalesce(hex, md5(''))")} AS key, coalesce(words, 0) >= 100 AS section FROM documents d LEFT JOIN digests USING (doc_id) WHERE d.doc_id % 13 <> 6""")
def fb2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """The root's digest of every book's body, and whether its section has words enough to be kept."""
    rows = archives.scan_archives(_zips(_book_entries(spark, sf)), "fingerprint").where("fb2_error is null")
    return rows.select("book_id", F.get("fb2_sections", F.lit(0))["key"].alias("key"), (F.size("fb2_sections") > 1).alias("section"))


# --- fingerprints as text ---------------------------------------------------------------------

def _line_sections(spark: SparkSession, sf: str) -> DataFrame:
    key = lambda c: tx.base64url(F.unhex(F.md5(c)))
    name, n = F.col("doc_id").cast("string"), F.col("line")
    lines = _lines(spark, sf).select(F.col("doc_id").alias("book"), n.cast("long").alias("pos"), (1 + n % 300).cast("int").alias("depth"), key(F.concat(name, F.lit(":"), n.cast("string"))).alias("key"), (n % 2 == 0).alias("leaf"))
    return lines.union(table(spark, sf, "documents").select(F.col("doc_id").alias("book"), F.lit(0).cast("long"), F.lit(0), key(name), F.lit(False)))


_SECTIONS_SQL = """s AS (SELECT doc_id AS book, 0 AS pos, 0 AS depth, md5(doc_id::VARCHAR) AS hex, false AS leaf FROM documents
UNION ALL SELECT doc_id, line, 1 + line % 300, md5(doc_id || ':' || line), line % 2 = 0 FROM (SELECT doc_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM documents))"""


@query(f"WITH {_SECTIONS_SQL} SELECT book, pos::INT AS pos, depth::INT AS depth, hex AS key_hex, leaf FROM s")
def fingerprint_codec(spark: SparkSession, sf: str) -> DataFrame:
    """Section trees as compact texts and back."""
    return inspection.decoded_fingerprints(fingerprints.encoded_fingerprints(_line_sections(spark, sf)))


@query(f"""WITH {_LINES_SQL}, {_WORDS_SQL}, rolled AS (SELECT doc_id, line, word, n FROM words UNION ALL SELECT doc_id, 0, word, sum(n)::BIGINT FROM words GROUP BY doc_id, word)
SELECT doc_id, line, count(*) AS words FROM rolled GROUP BY doc_id, line HAVING line = 0 OR count(*) >= 100""")
def retained_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections with words enough to be kept, and every root."""
    lines = _lines(spark, sf).withColumn("line", F.explode(F.array("line", F.lit(0))))
    digests = fingerprints.section_digests(fingerprints.section_words(lines, ["doc_id", "line"], "t"), None, ["doc_id", "line"])
    return fingerprints.retained(digests.withColumn("depth", (F.col("line") > 0).cast("int"))).select("doc_id", "line", "words")


@query(f"""WITH {_SECTIONS_SQL} SELECT book, '[' || string_agg('[' || depth || ',"' || {_text64('hex')} || '",' || leaf || ']', ',' ORDER BY pos) || ']' AS json FROM s GROUP BY book""")
def section_json(spark: SparkSession, sf: str) -> DataFrame:
    """Section trees as JSON."""
    return fingerprints.section_json(_line_sections(spark, sf))


@query("""WITH s AS (SELECT c_custkey AS book, p AS pos, CASE WHEN p = 0 THEN 0 ELSE (p - 1) % 3 + 1 END AS depth FROM customer, range(c_custkey % 9 + 1) AS r(p))
SELECT book, pos, depth::INT AS depth, (SELECT max(b.pos) FROM s b WHERE b.book = a.book AND b.pos < a.pos AND b.depth = a.depth - 1) AS parent,
    coalesce((SELECT min(b.pos) FROM s b WHERE b.book = a.book AND b.pos > a.pos AND b.depth <= a.depth) - 1, (SELECT max(b.pos) FROM s b WHERE b.book = a.book)) AS subtree_end FROM s a""")
def section_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Sections with the one above and the last one below."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("book"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("c_custkey") % 9)).alias("pos"))
    return fingerprints.section_tree(rows.withColumn("depth", F.when(F.col("pos") == 0, 0).otherwise((F.col("pos") - 1) % 3 + 1).cast("int")))


# --- datasets and caches ----------------------------------------------------------------------

@query("SELECT f.compression, s_suppkey AS id, s_name AS name, s_acctbal AS balance, (SELECT count(*) FROM supplier) AS records FROM supplier, (VALUES ('none'), ('gz'), ('zst'), ('zip')) AS f(compression)")
def dataset_formats(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset written and read again in all its compressions, its header's count checked."""
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    dataset = datasets.Dataset(datasets.dataset_header(rows, library="lib"), rows)
    folder = new_folder(spark, "dataset")
    spark.range(1).write.parquet(f"{folder}/made")  # the folder is there for the driver's own files
    found = None
    for compression in ("none", "gz", "zst", "zip"):
        path = datasets.write_dataset(dataset, f"{folder.removeprefix('file:')}/{compression}", ["id"], compression)
        again = datasets.read_dataset(spark, path, "id long, name string, balance double")
        part = again.rows.select(F.lit(compression).alias("compression"), "id", "name", "balance", F.lit(again.header["records"]).cast("long").alias("records"))
        found = part if found is None else found.union(part)
    return found


@query("""SELECT c_custkey AS id, '{"id":' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ',"name":"' || c_name || '"' ELSE '' END || CASE WHEN c_custkey % 3 = 0 THEN ',"nested":{"a":"x"}' ELSE '' END
|| CASE WHEN c_custkey % 4 = 0 THEN ',"items":[{"b":"y"},{}]' ELSE '' END || '}' AS json FROM customer""")
def record_json(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON without what is empty in them."""
    key, empty = F.col("c_custkey"), F.array().cast("array<struct<b:string>>")
    item = lambda t: F.struct(F.lit(t).alias("b"))
    rows = table(spark, sf, "customer").select(key.alias("id"), F.when(key % 2 == 0, F.col("c_name")).otherwise("").alias("name"), F.struct(F.when(key % 3 == 0, "x").otherwise("").alias("a")).alias("nested"),
                                               F.when(key % 4 == 0, F.array(item("y"), item(""))).otherwise(empty).alias("items"))
    return rows.select("id", F.to_json(F.struct(*[datasets.compacted(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields])).alias("json"))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS o_custkey FROM orders")
def cache_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """A cache of which one partition was made anew; the others stay."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = new_folder(spark, "cache")
    datasets.write_cache(rows, path, ["o_orderstatus"])
    datasets.write_cache(rows.where("o_orderstatus = 'F'").withColumn("o_custkey", F.lit(0).cast("long")), path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """Of rows with one key the first."""
    return datasets.keep_first(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"])


@query("""WITH d AS (SELECT p_partkey % 4 <> 0 AS found, p_partkey % 10 <> 0 AS agrees, 1000 > p_retailprice AS newer FROM part)
SELECT count(*) FILTER (found AND agrees AND newer) AS ready, count(*) FILTER (found AND agrees) AS valid, count(*) FILTER (found AND newer) AS fresh, count(*) FILTER (NOT found) AS missing FROM d""")
def manifest_summary(spark: SparkSession, sf: str) -> DataFrame:
    """How many caches can be used, and how many are there, are right, are new enough."""
    part = table(spark, sf, "part")
    sources = part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("facts"), F.col("p_retailprice").alias("modified"))
    cache = part.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 10 == 0, -1).otherwise(F.col("p_size")).alias("facts"), F.lit(1000).alias("built"))
    return validate.manifest_summary(validate.manifest_decisions(sources, cache, "id", ["facts"]))


@query("SELECT p_brand || '/' || p_partkey % 3 || '/x.zip' AS path, CASE WHEN row_number() OVER (ORDER BY p_brand, p_partkey % 3) = 1 THEN 'x.zip' ELSE replace(p_brand, '#', '_') || '_' || p_partkey % 3 || '_x.zip' END || '.manifest' AS manifest FROM part GROUP BY p_brand, p_partkey % 3")
def manifest_names(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of one name in many folders: all but the first are named by their whole path."""
    paths = table(spark, sf, "part").select(F.concat("p_brand", F.lit("/"), (F.col("p_partkey") % 3).cast("string"), F.lit("/x.zip")).alias("path")).distinct()
    return archives.manifest_names(paths)


@query("SELECT count(*) = count(*) FILTER (p_size >= 0) AS matches, false AS changed FROM part")
def same_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a manifest and its sources agree on all facts, and that they do not once one has changed."""
    part = table(spark, sf, "part").select("p_partkey", "p_size")
    same = validate.same_sources(part, part, ["p_partkey"], ["p_size"])
    other = validate.same_sources(part, part.withColumn("p_size", F.when(F.col("p_partkey") == 7, -1).otherwise(F.col("p_size"))), ["p_partkey"], ["p_size"])
    return same.join(other.withColumnRenamed("matches", "changed"))  # one row each


# --- streams ----------------------------------------------------------------------------------

def _event_files(spark: SparkSession, sf: str) -> str:
    path = new_folder(spark, "events")
    table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type").write.parquet(path)
    return path


def _drained(stream: DataFrame, name: str) -> DataFrame:
    """All that a stream gives until its input is used up."""
    spark, out = stream.sparkSession, new_folder(stream.sparkSession, name)
    stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, n FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per hour and kind of events as a stream, of the hours that the watermark has closed."""
    stream = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string").parquet(_event_files(spark, sf))
    counted = ingest.windowed_counts(stream, "ts", ["event_type"], "1 hour", "10 minutes")
    return _drained(counted, "windows").select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query("SELECT DISTINCT user_id FROM events")
def stream_once(spark: SparkSession, sf: str) -> DataFrame:
    """The users of a stream of events, each once while the watermark remembers it."""
    stream = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string").parquet(_event_files(spark, sf))
    return _drained(ingest.once_per_id(stream.select("user_id", "ts"), ["user_id"], "ts", "3650 days"), "once").select("user_id")


@query("SELECT event_type, count(*) AS n FROM events WHERE user_id % 2 = 0 OR event_type = 'purchase' GROUP BY event_type HAVING count(*) > 0")
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """New files handed on once each: the second run sees the second file only, and replaces its partition only."""
    source, target, state = new_folder(spark, "in"), new_folder(spark, "out"), new_folder(spark, "state")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    for part in (events.where("user_id % 2 = 0"), events.where("event_type = 'purchase'")):
        part.coalesce(1).write.mode("append").parquet(source)
        ingest.ingest_new_files(spark, source, state, ingest.upsert_partitions(target, "event_type"), schema="event_id long, user_id long, event_type string").awaitTermination()
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"))


# --- the catalogue ----------------------------------------------------------------------------

def _tables_a(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    t = lambda name: table(spark, sf, name)
    key = F.col("o_orderkey")
    return {
        "libbook": t("orders").select(key.alias("BookId"), F.col("o_totalprice").cast("long").alias("FileSize"), F.col("o_orderpriority").alias("Title"), F.lit("ru").alias("Lang"), F.when(key % 9 == 0, "pdf").otherwise("fb2").alias("FileType"),
                                      F.year("o_orderdate").alias("Year"), F.lit("0").alias("Deleted"), F.lit("abc\0\0").alias("md5"), (key % 3).alias("ReplacedBy")),
        "libavtor": t("lineitem").select(F.col("l_orderkey").alias("BookId"), F.col("l_partkey").alias("AvtorId"), F.col("l_linenumber").alias("Pos")).distinct(),
        "libavtorname": t("part").select(F.col("p_partkey").alias("AvtorId"), F.col("p_brand").alias("FirstName"), F.lit("").alias("MiddleName"), F.col("p_name").alias("LastName"), F.lit("").alias("NickName")),
        "libavtoraliase": t("part").where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("BadId"), (F.col("p_partkey") + 1).alias("GoodId")),
        "libgenre": t("orders").select(key.alias("BookId"), (F.col("o_custkey") % 25).alias("GenreId")),
        "libgenrelist": t("nation").select(F.col("n_nationkey").alias("GenreId"), F.col("n_name").alias("GenreCode"), F.lit("d").alias("GenreDesc"), F.lit("m").alias("GenreMeta")),
        "libgenretranslate": t("nation").where("n_nationkey % 2 = 0").select(F.col("n_name").alias("srcGenreCode"), F.lower("n_name").alias("trgGenreCode")),
        "libseq": t("orders").select(key.alias("BookId"), F.col("o_custkey").alias("SeqId"), (key % 5).alias("SeqNumb"), F.lit(1).alias("Level"), (key % 2).alias("Type")),
        "libseqname": t("customer").select(F.col("c_custkey").alias("SeqId"), F.col("c_name").alias("SeqName")),
        "librate": t("lineitem").select(F.col("l_orderkey").alias("BookId"), (F.col("l_quantity").cast("int") % 5 + 1).cast("string").alias("Rate")),
        "libfilename": t("orders").where("o_orderkey % 4 = 0").select(key.alias("BookId"), F.concat(F.lit("f"), key.cast("string")).alias("FileName")),
        "libjoinedbooks": t("events").select(F.col("event_id").alias("Id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Time"), F.col("user_id").alias("BadId"), (F.col("event_id") % 50).alias("GoodId"), F.lit(None).cast("long").alias("realId")),
    }


def _flat_record(record: DataFrame) -> DataFrame:
    joined = lambda c, item: F.array_join(F.transform(c, item), ",")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return record.select("book_id", "file_size", "title", "year", F.col("md5"), F.coalesce("replaced_by", F.lit(0)).alias("replaced_by"),
                         joined("authors", lambda a: text(a["pos"].cast("string"), ":", a["person_id"].cast("string"), ":", a["last_name"])).alias("authors"),
                         joined("translators", lambda a: a["person_id"].cast("string")).alias("translators"), joined("genres", lambda g: g["code"]).alias("genres"),
                         joined("series", lambda s: text(s["name"], "#", s["number"], "/", s["type"].cast("string"))).alias("series"), joined("filenames", lambda f: f["file_name"]).alias("filenames"),
                         F.size(F.coalesce("joined_books", F.array())).alias("merges"), F.col("rating_average").cast("int").alias("rating"), F.coalesce("rating_count", F.lit(0)).alias("ratings"))


@query("""WITH links AS (SELECT DISTINCT l_orderkey AS b, l_partkey AS a, l_linenumber AS pos FROM lineitem),
people AS (SELECT b, pos, p_partkey AS id, p_name FROM links JOIN part ON p_partkey = CASE WHEN a % 7 = 0 THEN a + 1 ELSE a END),
authors AS (SELECT b, string_agg(pos || ':' || id || ':' || p_name, ',' ORDER BY pos, id) AS authors FROM people GROUP BY b),
merges AS (SELECT id AS b, count(*) AS n FROM (SELECT event_id, user_id AS id FROM events UNION SELECT event_id, event_id % 50 FROM events) WHERE id > 0 GROUP BY id),
rates AS (SELECT l_orderkey AS b, round(avg(trunc(l_quantity)::INT % 5 + 1))::INT AS rating, count(*) AS ratings FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS book_id, trunc(o_totalprice)::BIGINT AS file_size, o_orderpriority AS title, year(o_orderdate)::BIGINT AS year, 'abc' AS md5, o_orderkey % 3 AS replaced_by, authors, NULL::VARCHAR AS translators,
CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS genres, c_name || '#' || o_orderkey % 5 || '/' || o_orderkey % 2 AS series, CASE WHEN o_orderkey % 4 = 0 THEN 'f' || o_orderkey END AS filenames, coalesce(n, 0)::INT AS merges,
rating, coalesce(ratings, 0) AS ratings FROM orders LEFT JOIN authors ON authors.b = o_orderkey LEFT JOIN nation ON n_nationkey = o_custkey % 25 LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN merges ON merges.b = o_orderkey
LEFT JOIN rates ON rates.b = o_orderkey WHERE o_orderkey % 9 <> 0""")
def catalogue_a(spark: SparkSession, sf: str) -> DataFrame:
    """One nested record per book of the first schema: aliases, translated genres, ordered people, ratings, names and merges."""
    return _flat_record(facets.Catalogue(_tables_a(spark, sf)).record())


def _tables_b(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    t = lambda name: table(spark, sf, name)
    key, role = F.col("o_orderkey"), F.element_at(F.array(F.lit("a"), F.lit("t"), F.lit("i")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return {
        "libbook": t("orders").select(key.alias("bid"), F.col("o_totalprice").cast("long").alias("FileSize"), F.col("o_orderpriority").alias("Title"), F.lit("fb2").alias("FileType"), F.year("o_orderdate").alias("Year"), F.lit("x").alias("md5")),
        "libavtor": t("lineitem").select(F.col("l_orderkey").alias("bid"), F.col("l_partkey").alias("aid"), F.col("l_linenumber").alias("Pos"), role.alias("role")).distinct(),
        "libavtors": t("part").select(F.col("p_partkey").alias("aid"), F.col("p_brand").alias("FirstName"), F.lit("").alias("MiddleName"), F.col("p_name").alias("LastName"), F.lit("").alias("NickName"),
                                      F.when(F.col("p_partkey") % 5 == 0, F.col("p_partkey") + 1).otherwise(0).alias("main")),
        "libgenre": t("orders").select(key.alias("bid"), (F.col("o_custkey") % 25).alias("gid")),
        "libgenres": t("nation").select(F.col("n_nationkey").alias("gid"), F.col("n_name").alias("code"), F.lit("d").alias("gdesc")),
        "libseq": t("orders").select(key.alias("bid"), F.col("o_custkey").alias("sid"), F.concat((key % 5).cast("string"), F.lit(".90")).alias("sn")),
        "libseqs": t("customer").select(F.col("c_custkey").alias("sid"), F.col("c_name").alias("seqname"), F.element_at(F.array(F.lit("a"), F.lit("p"), F.lit("z")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("type")),
        "librate": t("lineitem").select(F.col("l_orderkey").alias("bid"), (F.col("l_quantity").cast("int") % 5 + 1).cast("string").alias("Rate")),
    }


@query("""WITH links AS (SELECT DISTINCT l_orderkey AS b, l_partkey AS a, l_linenumber AS pos FROM lineitem),
main AS (SELECT p_partkey AS a, CASE WHEN p_partkey % 5 = 0 THEN p_partkey + 1 ELSE p_partkey END AS id FROM part),
people AS (SELECT b, pos, p_partkey AS id, p_name FROM links JOIN main USING (a) JOIN part ON p_partkey = id),
authors AS (SELECT b, string_agg(pos || ':' || id || ':' || p_name, ',' ORDER BY pos, id) FILTER (pos % 3 = 0) AS authors, string_agg(id::VARCHAR, ',' ORDER BY pos, id) FILTER (pos % 3 = 1) AS translators FROM people GROUP BY b),
rates AS (SELECT l_orderkey AS b, round(avg(trunc(l_quantity)::INT % 5 + 1))::INT AS rating, count(*) AS ratings FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS book_id, trunc(o_totalprice)::BIGINT AS file_size, o_orderpriority AS title, year(o_orderdate)::BIGINT AS year, 'x' AS md5, 0::BIGINT AS replaced_by, authors, translators, n_name AS genres,
CASE WHEN c_custkey % 3 < 2 THEN c_name || '#' || o_orderkey % 5 || '/' || c_custkey % 3 END AS series, NULL::VARCHAR AS filenames, 0 AS merges, rating, coalesce(ratings, 0) AS ratings
FROM orders LEFT JOIN authors ON authors.b = o_orderkey LEFT JOIN nation ON n_nationkey = o_custkey % 25 LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN rates ON rates.b = o_orderkey""")
def catalogue_b(spark: SparkSession, sf: str) -> DataFrame:
    """One nested record per book of the second schema: roles, main entries, kinds of series, numbers truncated; absent tables are empty."""
    return _flat_record(facets.Catalogue(_tables_b(spark, sf)).record())
