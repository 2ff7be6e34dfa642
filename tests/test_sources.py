import io
import zipfile

import pytest
from pyspark.sql import functions as F

from shelf.operators import claims, exports, fingerprints, inspection, validate
from shelf.sources import archives, books, datasets, dumps, exchange

BOOK = """<?xml version="1.0" encoding="utf-8"?>
<FictionBook xmlns="http://example.org/fb" xmlns:l="http://www.w3.org/1999/xlink"><description>
<title-info><genre match="90">sf</genre><genre>det</genre>
<author><first-name>Ann</first-name><middle-name>M</middle-name><last-name>Lee</last-name><nickname>al</nickname><home-page>h</home-page><email>e</email><id>7</id></author>
<translator><last-name>Tran</last-name></translator><book-title>Old</book-title><book-title>A  Title</book-title>
<annotation><p>A <emphasis>B</emphasis> C</p><p>Hello <strong>world</strong>.</p></annotation><keywords>one, two</keywords><date value="2001-02-03">2001</date><lang>en</lang><src-lang>fr</src-lang>
<sequence name="U"><sequence name="Cycle" number="7"/></sequence></title-info>
<src-title-info><book-title>Titre</book-title></src-title-info>
<document-info><author><nickname>maker</nickname></author><id>doc-1</id><version>1.1</version><date>yesterday</date><src-url>u</src-url></document-info>
<publish-info><book-name>N</book-name><publisher>P</publisher><city>C</city><year>1999</year><isbn>1-2</isbn><sequence name="Pub"/></publish-info>
<custom-info info-type="x">y</custom-info></description>
<body><title><p>Head</p></title><section><section>%s</section><section><p>few words</p></section></section></body><body><section><p>notes</p></section></body></FictionBook>"""


def many(n):
    letters = "abcdefghijklmnopqrst"
    return "<p>" + " ".join("w" + letters[i // 20] + letters[i % 20] + "x" * (i % 4) for i in range(n)) + "</p>"


def test_a_full_description():
    row = books.parse_book((BOOK % "").encode())
    assert row["fb2_present"] and row["fb2_error"] is None
    assert row["fb2_title"] == "A Title" and row["fb2_lang"] == "en" and row["fb2_src_lang"] == "fr" and row["fb2_original_title"] == "Titre"
    assert row["fb2_annotation"] == "A B C Hello world." and row["fb2_keywords"] == "one, two" and row["fb2_date"] == "2001-02-03"
    assert row["fb2_authors"][0] == {"first_name": "Ann", "middle_name": "M", "last_name": "Lee", "nick_name": "al", "home_pages": ["h"], "emails": ["e"], "id": "7"}
    assert row["fb2_genres"] == [{"code": "sf", "match": "90"}, {"code": "det", "match": ""}]
    assert [(s["path"], s["number"], s["is_leaf"]) for s in row["fb2_series"]] == [(["U"], "", False), (["U", "Cycle"], "7", True)]
    assert row["fb2_publisher"] == "P" and row["fb2_year"] == "1999" and row["fb2_isbn"] == "1-2" and row["fb2_document_id"] == "doc-1" and row["fb2_custom_info"] == ["x=y"]
    assert [s["name"] for s in row["fb2_publication_series"]] == ["Pub"] and row["fb2_sections"] is None


def test_title_only_leaves_the_rest_empty():
    row = books.parse_book((BOOK % "").encode(), "title")
    assert row["fb2_title"] == "A Title" and row["fb2_publisher"] == "" and row["fb2_document_id"] == ""


def test_fingerprints_keep_large_sections():
    row = books.parse_book((BOOK % many(120)).encode(), "fingerprint")
    assert [(s["depth"], s["leaf"]) for s in row["fb2_sections"]] == [(0, False), (1, False), (2, True)]
    words = {}
    for w in books.body_tokens(many(120)[3:-4]):
        words[w] = words.get(w, 0) + 1
    assert row["fb2_sections"][2]["key"] == fingerprints.digest_words(words)
    assert row["fb2_title"] == "A Title"


def test_words_do_not_cross_markup():
    assert list(books.body_tokens("Ёж, ВЫОН a-b 1x2")) == ["еж", "вьюн", "a", "b", "x"]


@pytest.mark.parametrize("content", [b"<FictionBook><description>", b"no xml", b"", b"<a>" * 300 + b"</a>" * 300, b'<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>',
                                     b"<FictionBook><description><title-info>" + b"<sequence name='a'>" * 70 + b"</sequence>" * 70 + b"</title-info></description></FictionBook>"])
def test_bad_books_are_errors_of_their_row(content):
    row = books.parse_book(content)
    assert row["fb2_error"] and not row["fb2_present"]


def test_a_book_without_description_is_absent():
    row = books.parse_book(b"<FictionBook><body/></FictionBook>")
    assert row["fb2_error"] is None and not row["fb2_present"]


def test_other_encodings():
    text = '<?xml version="1.0" encoding="windows-1251"?><FictionBook><description><title-info><book-title>Книга</book-title></title-info></description></FictionBook>'
    assert books.parse_book(text.encode("windows-1251"))["fb2_title"] == "Книга"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    where = tmp_path_factory.mktemp("archives")
    with zipfile.ZipFile(where / "b.zip", "w") as z:
        z.writestr("000.txt", "x")
        z.writestr("1.fb2", BOOK % many(120))
        z.writestr("2.fb2", "broken <")
        z.writestr("3.fb2.org", "backup")
        z.writestr("dir/", "")
        z.writestr("name.fb2", BOOK % "")
    with zipfile.ZipFile(where / "a.zip", "w"):
        pass
    (where / "c.zip").write_bytes(b"not a zip")
    return str(where)


def test_archives(spark, folder):
    files = archives.archive_files(spark, folder)
    rows = {(r.archive, r.entry_index): r for r in archives.scan_archives(files, "fingerprint", with_hash=True).collect()}
    assert {k: v.kind for k, v in rows.items()} == {("b.zip", 0): "dummy", ("b.zip", 1): "book", ("b.zip", 2): "book", ("b.zip", 3): "ignored", ("b.zip", 4): "ignored", ("b.zip", 5): "book", ("c.zip", None): "error"}
    assert rows["b.zip", 1].book_id == 1 and rows["b.zip", 5].book_id == 0 and rows["b.zip", 1].fb2_title == "A Title" and rows["b.zip", 2].error
    import hashlib

    assert rows["b.zip", 1].content_md5 == hashlib.md5((BOOK % many(120)).encode()).hexdigest()
    entries = archives.scan_archives(files)
    layout = {r.name: (r.id, r.ordinal, r.entries, r.fb2_entries) for r in archives.archive_layouts(entries).collect()}
    assert layout["b.zip"] == ("archive-0001", 0, 6, 3) and layout["c.zip"][2:] == (0, 0)
    assert [tuple(r) for r in archives.layout_ranges(entries, "ignored").select("start", "end").collect()] == [(3, 4)]
    paths = spark.createDataFrame([("x/a.zip",), ("y/a.zip",), ("b.zip",)], "path string")
    assert {r.path: r.manifest for r in archives.manifest_names(paths).collect()} == {"x/a.zip": "a.zip.manifest", "y/a.zip": "y_a.zip.manifest", "b.zip": "b.zip.manifest"}


DUMP = """-- dump
ALTER DATABASE x;
DROP TABLE IF EXISTS `libavtoraliase`;
CREATE TABLE `libavtoraliase` (
  `BadId` int NOT NULL,
  `GoodId` int NOT NULL,
  `Note` text,
  PRIMARY KEY (`BadId`)
) ENGINE=InnoDB;
INSERT INTO `libavtoraliase` VALUES (10,20,'it''s \\'quoted\\' (a,b);\\n'),(11,21,NULL);
INSERT INTO `libavtoraliase` VALUES (0,12,22,'x');
-- Dump completed on 2026-06-22  1:02:03
"""


def test_dumps(spark, tmp_path):
    (tmp_path / "libavtoraliase.sql").write_text(DUMP)
    (tmp_path / "libbook.sql").write_text(DUMP.replace("2026-06-22", "2026-06-23").replace("libavtoraliase", "libbook"))
    (tmp_path / "other.txt").write_text("")
    files = dumps.dump_files(spark, str(tmp_path))
    assert [(r.name, r.dump_date, r.dump_time) for r in files.collect()] == [("libavtoraliase.sql", "2026-06-22", "01:02:03"), ("libbook.sql", "2026-06-23", "01:02:03")]
    with pytest.raises(ValueError):
        dumps.dump_date(files)
    assert dumps.dump_date(files, allow_mismatch=True) == "" and dumps.dump_date(files.limit(1)) == "2026-06-22"
    assert [r.name for r in dumps.dump_files(spark, str(tmp_path), "b").collect()] == ["libbook.sql"]
    tables = dumps.read_catalogue(spark, str(tmp_path))
    assert sorted(tuple(r) for r in tables["libavtoraliase"].collect()) == [("10", "20", "it's 'quoted' (a,b);\n"), ("11", "21", None), ("12", "22", "x")]


def records(spark):
    return spark.createDataFrame([
        ("archive-0001", 0, "1.fb2", 1, True, True, "Db one", "Fb one", "ru", "en", 10, "fb2", "0", "one,two;three", "1975", "<note> & more", 2),
        ("archive-0001", 2, "2.fb2", 0, False, True, None, "Fb two", None, "en", None, None, None, None, None, "", None),
        ("archive-0001", 3, "x.fb2", 0, False, False, None, None, None, None, None, None, None, None, None, "", None),
        (None, None, None, 9, True, False, "Online", None, "ru", None, 5, "fb2", "1", "", "", None, 0)],
        "archive string, entry_index long, entry string, book_id long, db_present boolean, fb2_present boolean, title string, fb2_title string, lang string, fb2_lang string, file_size long, file_type string, deleted string, "
        "keywords string, year string, fb2_annotation string, replaced_by long")


def test_claims_views_and_validation(spark):
    rows = claims.dataset_rows(records(spark))
    view = {r.book_id: r for r in claims.flat_view(rows).collect()}
    assert view["1"].db_title == "Db one" and view["1"].fb2_title == "Fb one" and view["1"].deleted == "0" and view["1"].size == 10 and view["1"].replaced_by == "2"
    assert view["2"].db_title == "" and not view["2"].has_db and view["9"].locator.kind == "database_book" and view["x"].has_fb2 is False
    assert validate.undeclared_observations(rows).count() == 0
    broken = rows.withColumn("claim_title", F.array(F.struct(F.lit("ghost").alias("observation"), F.lit("t").alias("value"))))
    assert {tuple(r)[1:] for r in validate.undeclared_observations(broken).collect()} == {("claim_title", "ghost")}
    layout = spark.createDataFrame([("archive-0001", 0, 3)], "id string, ordinal long, entries long")
    assert [tuple(r) for r in validate.bad_archive_indexes(rows, layout).select("index").collect()] == [(3,)]
    assert validate.undeclared_sources(rows, layout).count() == 0 and validate.undeclared_sources(rows, layout.where("false")).count() > 0
    placed = rows.withColumn("pos", F.coalesce(-F.col("locator.index"), F.lit(5)))
    assert validate.order_errors(placed.where("locator.kind = 'archive_entry'"), layout).count() == 2
    assert validate.count_error(4, rows).count() == 0 and validate.count_error(5, rows).count() == 1
    assert claims.claims_of(rows, ["title"]).count() == 4


def test_lookups(spark):
    rows = claims.dataset_rows(records(spark))
    find = lambda c: [r.book_id for r in claims.flat_view(inspection.first_match(rows, c, ["locator.source", "locator.index"])).collect()]
    assert find(inspection.has_book(9)) == ["9"] and find(inspection.at_entry("archive-0001", 2)) == ["2"] and find(inspection.has_file("1.FB2")) == ["1"] and find(inspection.has_book(77)) == []
    assert inspection.lookup_mode(book_id=1) == "book_id" and inspection.lookup_mode() == "summary"
    for bad in ({"book_id": 1, "file": "x"}, {"index": 0}):
        with pytest.raises(ValueError):
            inspection.lookup_mode(**bad)
    assert tuple(inspection.dataset_summary(rows).first()) == (4, 2, 2, 0)


def test_layouts(spark, tmp_path):
    view = claims.flat_view(claims.dataset_rows(records(spark)))
    layout = spark.createDataFrame([("archive-0001", 5)], "id string, entries long")
    ignored = spark.createDataFrame([("archive-0001", 4, 4)], "archive string, start long, end long")
    lines = {r["index"]: r for r in exports.positional_export(view, layout, ignored).collect()}
    assert {i: r.is_dummy for i, r in lines.items()} == {0: False, 1: True, 2: False, 3: True}
    fields = lines[1].line.rstrip("\r\n").split("\x04")
    assert fields == ["dummy:", "other:", "dummy record", "", "", "", "1", "2", "1", "EXT", "2000-01-01", "en", "0", "", ""]
    fields = lines[0].line.rstrip("\r\n").split("\x04")
    assert fields[:3] == ["неизвестный,автор,:", "other:", "Db one"] and fields[5:10] == ["1", "10", "1", "0", "fb2"] and len(fields) == 15
    assert len(exports.positional_rows(view, exports.Options(extended=True)).where("line is not null").first().line.split("\x04")) == 17
    multi = {r["index"]: r.line.split("\x04") for r in exports.multi_series_export(view, exports.Options(source_library="lib")).collect()}
    assert set(multi) == {0, 2} and len(multi[0]) == len(exports.MULTI_FIELDS.split(";")) and multi[0][13] == "one:two:three:" and multi[0][14] == "1975" and multi[0][15] == "lib"
    alone = exports.multi_series_export(view.where("locator.kind <> 'archive_entry'"), online=True).collect()
    assert [(r.archive, r["index"]) for r in alone] == [("online", 0)]
    placed = exports.positional_export(view.where("locator.kind <> 'archive_entry'"), layout.where("false"))
    assert [(r.archive, r["index"], r.is_dummy) for r in placed.collect()] == [("online", 0, False)]
    for bad in (view.union(view), view.withColumn("locator", F.col("locator").withField("source", F.when(F.col("locator.kind") == "archive_entry", "ghost").otherwise("database")))):
        with pytest.raises(Exception, match="two records|undeclared"):
            exports.positional_export(bad, layout).collect()
    from shelf.functions.text import register_functions

    register_functions(spark)
    cut = exports.slice_export(view, "title like '%one'", "concat('part/', lib_id)")
    assert [(r.member, r.accepted_row, r.accepted_book, r.input_record) for r in cut.collect()] == [("part_1.inp", 1, 1, 1)]
    assert len(cut.first().line.split("\x04")) == len(exports.SLICE_FIELDS.split(";"))
    assert "&lt;note&gt; &amp; more" in exports.annotations(view).first().xml
    target = str(tmp_path / "out.inpx")
    info = {"collection.info": exchange.collection_info("lib", "20260622"), "version.info": exchange.version_info("20260622")}
    exchange.write_zip(exports.slice_export(view), target, order=["index"], members=["empty.inp"], info=info, comment="c")
    with zipfile.ZipFile(target) as z:
        assert sorted(z.namelist()) == ["archive-0001.inp", "collection.info", "empty.inp", "version.info"]
        assert z.read("archive-0001.inp").count(b"\r\n") == 2 and z.read("empty.inp") == b"" and b"2026-06-22" in z.read("collection.info")
    exchange.write_members(exports.slice_export(view), str(tmp_path / "members"), order=["index"])
    parts = list((tmp_path / "members").glob("member=*/part-*"))
    assert len(parts) == 1 and parts[0].read_bytes().count(b"\r\n") == 2


@pytest.mark.parametrize("compression", ["none", "gz", "zst", "zip"])
def test_datasets_round_trip(spark, tmp_path, compression):
    rows = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "id long, t string")
    header = datasets.dataset_header(rows, library="lib")
    path = datasets.write_dataset(datasets.Dataset(header, rows), str(tmp_path / "d"), ["id"], compression)
    assert datasets.find_dataset(str(tmp_path / "d")) == path
    again = datasets.read_dataset(spark, path, "id long, t string")
    assert [(r.id, r.t) for r in again.rows.orderBy("pos").collect()] == [(1, "a"), (2, "b"), (3, None)] and again.header["records"] == 3
    bad = datasets.Dataset(header | {"records": 4}, rows)
    with pytest.raises(ValueError):
        datasets.read_dataset(spark, datasets.write_dataset(bad, str(tmp_path / "e"), ["id"], compression), "id long, t string")
    assert validate.header_errors(header) == []


def test_bad_headers():
    good = {"records": 1, "archives": [{"id": "a", "ordinal": 0}], "ordering": {"mode": "archive_entry"}}
    assert validate.header_errors(good) == []
    for change in ({"records": -1}, {"archives": [{"id": "a", "ordinal": 1}]}, {"archives": [{"id": "a", "ordinal": 0}, {"id": "a", "ordinal": 1}]}, {"ordering": {"mode": "x"}}, {"archives": []}):
        assert validate.header_errors(good | change)


def test_encoded_fingerprints_are_read(spark):
    row = books.parse_book((BOOK % many(120)).encode(), "fingerprint")
    sections = [(s["depth"], s["key"], s["leaf"]) for s in row["fb2_sections"]]
    frame = spark.createDataFrame([(1, fingerprints.encode_fingerprint(sections)), (2, "zz"), (3, None)], "book long, fingerprint string")
    got = inspection.decoded_fingerprints(frame).orderBy("pos").collect()
    assert [(r.depth, r.leaf) for r in got] == [(d, leaf) for d, _, leaf in sections] and all(len(r.key_hex) == 32 for r in got)


def test_incremental_ingestion(spark, tmp_path):
    from shelf.streaming.ingest import ingest_new_files, upsert_partitions

    source, target, seen = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "seen")
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, archive string").write.parquet(source)
    for more in (None, [(3, "b")]):
        if more:
            spark.createDataFrame(more, "id long, archive string").write.mode("append").parquet(source)
        ingest_new_files(spark, source, seen, upsert_partitions(target, "archive"), schema="id long, archive string").awaitTermination()
    assert sorted((r.id, r.archive) for r in spark.read.parquet(target).collect()) == [(1, "a"), (3, "b")]
