"""Queries through the functions of fields, the parts of dataset rows, their checks, and the smaller exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.functions import text as tx
from shelf.functions import values as vl
from shelf.operators import authors, claims, exports, facets, inspection, language, ranges, rollup, series, validate
from shelf.plans.catalogue import _RECORD_SQL, _records, query
from shelf.session import table
from shelf.sources import exchange

_ODD = (" , a:b,", "x y", "�z", "", "a\r\nb", "one\x04two", " :c;d: ", "1", "true", "Deleted", "no", "2")


def _odd(name: str) -> Column:
    """One of the awkward texts, by a number."""
    return F.element_at(F.array(*map(F.lit, _ODD)), (F.col(name) % len(_ODD) + 1).cast("int"))


_ODD_SQL = "[' , a:b,', 'x' || chr(160) || 'y', chr(65533) || 'z', '', 'a' || chr(13) || chr(10) || 'b', 'one' || chr(4) || 'two', ' :c;d: ', '1', 'true', 'Deleted', 'no', '2']"


# --- functions --------------------------------------------------------------------------------

@query(f"""WITH v AS (SELECT c_custkey AS id, {_ODD_SQL}[c_custkey % 12 + 1] AS t FROM customer),
p AS (SELECT id, t, trim(regexp_replace(replace(replace(replace(t, chr(13) || chr(10), ' '), chr(4), ' '), chr(160), ' '), '\\s+', ' ', 'g')) AS c FROM v)
SELECT id, CASE WHEN contains(c, chr(65533)) THEN '' ELSE translate(trim(c, ' ,:'), ',:', '，：') END AS author, CASE WHEN contains(c, chr(65533)) THEN '' ELSE translate(trim(c, ' :'), ':', '：') END AS genre,
lower(trim(t)) IN ('1', 'true', 'yes', 'deleted') AS deleted, CASE WHEN t IN ('0', 'false', 'no') THEN 'active' WHEN t IN ('1', 'true', 'yes') THEN 'deleted' ELSE 'unknown' END AS state,
lower(trim(t)) AS key, CASE WHEN lower(t) = 'fb2' THEN 'application/fb2+xml' END AS media FROM p""")
def cleansing(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of names, genres, marks of deletion, keys and media types of awkward texts."""
    value = _odd("c_custkey")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), tx.cleanse_author(value).alias("author"), tx.cleanse_genre(value).alias("genre"), tx.is_deleted(value).alias("deleted"),
                                               tx.deletion_state(value).alias("state"), tx.file_key(value).alias("key"), tx.media_type(value).alias("media"))


@query("""SELECT p_partkey AS id, p_brand || '.' || p_partkey AS stem, CASE p_partkey % 3 WHEN 0 THEN 'fb2' WHEN 1 THEN 'ZIP' ELSE '' END AS ext, 'dir_' || p_partkey || '_x-1.y' AS label, CASE WHEN p_partkey % 3 = 0 THEN 'application/fb2+xml' END AS media
FROM (SELECT p_partkey, 'b' || p_partkey % 9 AS p_brand FROM part)""")
def file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Stems and extensions of paths, and paths as labels."""
    key = F.col("p_partkey").cast("string")
    end = F.when(F.col("p_partkey") % 3 == 0, ".fb2").when(F.col("p_partkey") % 3 == 1, ".ZIP").otherwise(".")
    path = F.concat(F.lit("x/y\\b"), (F.col("p_partkey") % 9).cast("string"), F.lit("."), key, end)
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), tx.file_stem(path).alias("stem"), tx.file_ext(path).alias("ext"), tx.path_label(F.concat(F.lit("/dir/"), key, F.lit(" / x-1.y/"))).alias("label"), tx.media_type(tx.file_ext(path)).alias("media"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, trunc(l_extendedprice)::BIGINT AS number, CASE WHEN l_partkey % 4 = 0 THEN 'part ' || l_partkey ELSE trunc(l_extendedprice)::BIGINT::VARCHAR END AS shown,
CASE WHEN l_linenumber > 2 THEN l_linenumber END AS positive, CASE WHEN l_linenumber > 2 THEN (l_linenumber - 2)::VARCHAR ELSE '' END AS positive_text, CASE WHEN l_partkey % 4 <> 0 THEN trunc(l_quantity)::BIGINT END AS year,
strftime(l_shipdate, '%Y%m%d') AS compact, strftime(l_shipdate, '%Y-%m-%d') AS display, CASE WHEN l_linenumber % 2 = 0 THEN '09:01' ELSE '10:01' END AS hour, l_linenumber % 3 < 2 AS same FROM lineitem""")
def value_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of series, positive ids, years, and dates in their several forms."""
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    raw = F.when(part % 4 == 0, F.concat(F.lit("part "), part.cast("string"))).otherwise(F.col("l_extendedprice").cast("string"))
    iso = F.date_format("l_shipdate", "yyyy-MM-dd")
    year = F.when(part % 4 == 0, "about").otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string")))
    shipped = F.col("l_shipdate").cast("timestamp")
    moved = F.timestamp_micros(F.unix_micros(shipped) + (line % 3))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", vl.series_number(F.col("l_extendedprice").cast("string")).alias("number"), vl.series_number_text(raw).alias("shown"),
        F.when(line > 2, vl.positive(line)).alias("positive"), vl.positive_text(line - 2).alias("positive_text"), vl.number_of(year, "bigint").alias("year"), vl.compact_date(iso).alias("compact"),
        vl.display_date(vl.compact_date(iso)).alias("display"), vl.zero_pad_hour(F.when(line % 2 == 0, "9:01").otherwise("10:01")).alias("hour"), vl.same_time(shipped, moved).alias("same"))


@query("""WITH r AS (SELECT user_id, round(avg(trunc(value)::INT), 0) AS a, count(value) AS n FROM events WHERE value IS NOT NULL GROUP BY user_id)
SELECT user_id, CASE WHEN n > 0 THEN a::BIGINT::VARCHAR ELSE '' END AS shown, a::BIGINT::VARCHAR AS whole, '' AS none FROM r""")
def rating_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Averages as the shortest decimal and as a whole number."""
    stats = facets.rating_stats(table(spark, sf, "events").select("user_id", F.col("value").cast("int").alias("rate")), "user_id", "rate")
    shown = vl.rating_text(F.col("rating_average"), F.col("rating_count"))
    return stats.select("user_id", shown.alias("shown"), vl.rating_whole(F.concat(shown, F.lit(".75"))).alias("whole"), vl.rating_whole(F.lit("none")).alias("none"))


@query("""WITH n AS (SELECT c_custkey AS id, c_name AS last, CASE WHEN c_custkey % 3 = 0 THEN '[#' || c_custkey || ']' ELSE '' END AS tail, c_mktsegment AS first FROM customer),
cut AS (SELECT *, 11 - length(tail) - 1 AS room FROM n)
SELECT id, CASE WHEN tail = '' THEN rtrim(substr(last, 1, 11)) WHEN room <= 0 THEN tail ELSE trim(rtrim(substr(last, 1, room)) || ' ' || tail) END || ',' || substr(first, 1, 4) || ',:' AS limited,
trim(last || ' ' || tail) || ',' || first || ',:' AS plain FROM cut""")
def limited_names(spark: SparkSession, sf: str) -> DataFrame:
    """Authors with each part cut to its limit, but never what tells them apart; and uncut."""
    tail = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("[#"), F.col("c_custkey").cast("string"), F.lit("]"))).otherwise("")
    none = F.lit("")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), tx.limited_person(F.col("c_name"), F.col("c_mktsegment"), none, tail, (12, 5, 5)).alias("limited"),
                                               tx.person_name(F.col("c_name"), F.col("c_mktsegment"), none, tail).alias("plain"))


@query("""SELECT o_orderkey AS id, o_orderpriority IN ('1-URGENT', '5-LOW') AS one, o_orderstatus IN ('F', 'P') AS has, CASE WHEN o_orderkey % 2 = 0 THEN printf('%010d-%010d', ((o_orderkey - 1) // 7) * 7 + 1, ((o_orderkey - 1) // 7 + 1) * 7) ELSE 'x' END AS bucket FROM orders WHERE o_orderkey > 0""")
def user_expressions(spark: SparkSession, sf: str) -> DataFrame:
    """The functions of user expressions."""
    tx.register_functions(spark)
    key = "if(o_orderkey % 2 = 0, cast(o_orderkey AS STRING), 'none')"
    return table(spark, sf, "orders").where("o_orderkey > 0").select(F.col("o_orderkey").alias("id"), F.expr("one_of(o_orderpriority, array('1-URGENT', '5-LOW'))").alias("one"),
                                                                     F.expr("contains_value(array('F', 'P'), o_orderstatus)").alias("has"), F.expr(f"range_name({key}, 7, 'x')").alias("bucket"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE 'es' END AS language FROM documents""")
def language_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Names of languages and codes with regions as base subtags."""
    raw = F.element_at(F.array(*map(F.lit, (" English ", "FR-ca", "german", "ES-mx"))), (F.col("doc_id") % 4 + 1).cast("int"))
    rows = table(spark, sf, "documents").select("doc_id", raw.alias("db_lang"), F.lit("").alias("fb2_lang"))
    return language.canonical_language(rows).select("doc_id", "language")


# --- people, series, merges -------------------------------------------------------------------

@query("""SELECT c_mktsegment || ',' || c_nationkey AS key, string_agg(DISTINCT c_custkey::VARCHAR, ',' ORDER BY c_custkey::VARCHAR) AS ids, count(DISTINCT c_custkey % 4) AS nicks FROM customer GROUP BY 1 HAVING count(*) > 1""")
def ambiguous_authors(spark: SparkSession, sf: str) -> DataFrame:
    """Names that several authors have, as a header lists them."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("last_name"), F.col("c_nationkey").cast("string").alias("first_name"), F.lit("").alias("middle_name"),
                                                 (F.col("c_custkey") % 4).cast("string").alias("nick_name"))
    groups = authors.collision_groups(people)
    return groups.groupBy(F.regexp_replace("key", ",$", "").alias("key")).agg(F.array_join(F.sort_array(F.collect_set("id")), ",").alias("ids"), F.countDistinct("nick_name").alias("nicks"))


@query("""SELECT event_id, (CASE WHEN user_id > 0 THEN 'bad=' || user_id || ';' ELSE '' END) || 'good=' || event_id % 50 || CASE WHEN event_id % 3 = 0 THEN ';real=' || user_id ELSE '' END AS who FROM events WHERE user_id > 0""")
def event_maps(spark: SparkSession, sf: str) -> DataFrame:
    """The books of a merge by their part in it, those unknown left out."""
    real = F.when(F.col("event_id") % 3 == 0, F.col("user_id"))
    who = F.map_entries(facets.event_map(F.col("user_id"), F.col("event_id") % 50, real))
    return table(spark, sf, "events").where("user_id > 0").select("event_id", F.array_join(F.transform(F.sort_array(who), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("who"))


@query("""SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n = 1""")
def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The last row of each key, whole."""
    return facets.latest(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query("""WITH s AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 3 > 0 THEN 'Db' || c_custkey % 3 END AS db, CASE WHEN c_custkey % 4 > 0 THEN 'Fb' || c_custkey % 4 END AS fb FROM customer)
SELECT id, coalesce(db, fb, '') AS complement, coalesce(fb, db, '') AS replace, concat_ws(',', db, fb) AS merge, coalesce(db, '') AS ignore, coalesce(fb, db) AS single FROM s""")
def series_choices(spark: SparkSession, sf: str) -> DataFrame:
    """The series of two sources under every preference."""
    key = F.col("c_custkey")
    db = F.when(key % 3 > 0, F.array(F.struct(F.concat(F.lit("Db"), (key % 3).cast("string")).alias("name"), F.lit("1").alias("number"), F.lit(0).cast("long").alias("type"), F.lit(1).cast("long").alias("level"))))
    name = F.concat(F.lit("Fb"), (key % 4).cast("string"))
    nodes = F.when(key % 4 > 0, F.array(F.struct(F.array(name).alias("path"), name.alias("name"), F.lit("2").alias("number"), F.lit(True).alias("is_leaf"))))
    mode = series.SeriesMode.AUTHOR
    left, right = series.db_series(F.coalesce(db, F.array().cast("array<struct<name:string,number:string,type:bigint,level:bigint>>")), mode), series.fb2_series(nodes, F.lit(None).cast("array<struct<path:array<string>,name:string,number:string,is_leaf:boolean>>"), mode)
    listed = lambda c: F.array_join(F.transform(c, lambda s: s["name"]), ",")
    chosen = {p.value: listed(series.select_series(left, right, p)) for p in series.Preference}
    single = series.single_series(db, nodes, mode, series.Preference.REPLACE)["name"]
    return table(spark, sf, "customer").select(key.alias("id"), *[v.alias(k) for k, v in chosen.items()], single.alias("single"))


# --- dataset rows and their checks ------------------------------------------------------------

_MERGED = "joined_books"


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Records with two merges of books each."""
    event = lambda i: F.struct(F.lit("t").alias("time"), F.lit(i).cast("long").alias("event_id"), F.col("book_id").alias("bad"), (F.col("book_id") % 5).alias("good"), F.lit(None).cast("long").alias("real"))
    return _records(spark, sf).where("book_id > 0").withColumn(_MERGED, F.array(event(1), event(2)))


@query(f"""WITH {_RECORD_SQL} SELECT o_orderkey AS book, 'replaced_by' AS kind, (o_orderkey % 7)::VARCHAR AS target, NULL::VARCHAR AS event_id, NULL::VARCHAR AS bad, NULL::VARCHAR AS good, NULL::VARCHAR AS real FROM rec WHERE o_orderkey > 0 AND db AND o_orderkey % 7 > 0
UNION ALL SELECT o_orderkey, 'joined_books', NULL, e::VARCHAR, o_orderkey::VARCHAR, CASE WHEN o_orderkey % 5 > 0 THEN (o_orderkey % 5)::VARCHAR ELSE '' END, '' FROM rec, (VALUES (1), (2)) AS x(e) WHERE o_orderkey > 0 AND db""")
def relations(spark: SparkSession, sf: str) -> DataFrame:
    """What the catalogue says about a book and others; a book that it does not have says nothing."""
    rows = claims.dataset_rows(_merged(spark, sf)).select(claims.book_id(F.col("locator"), F.col("identities"), F.col("artifact")).cast("long").alias("book"), F.explode("relations").alias("r"))
    return rows.select("book", "r.kind", "r.target", "r.event_id", *[F.col("r.participants")[k].alias(k) for k in ("bad", "good", "real")])


@query(f"""WITH {_RECORD_SQL}, o AS (SELECT o_orderkey AS book, 'archive' AS id, 'present' AS status, 'inventory' AS coverage FROM rec UNION ALL SELECT o_orderkey, 'db', CASE WHEN db THEN 'present' ELSE 'absent' END, CASE WHEN db THEN 'complete' END FROM rec
UNION ALL SELECT o_orderkey, 'fb2', CASE WHEN fb2 THEN 'present' WHEN o_orderkey % 10 = 0 THEN 'error' ELSE 'absent' END, CASE WHEN fb2 THEN CASE WHEN o_orderkey % 4 = 1 THEN 'description' ELSE 'title_info' END END FROM rec)
SELECT * FROM o WHERE book > 0""")
def observations(spark: SparkSession, sf: str) -> DataFrame:
    """What was seen of each book where, and how much of it."""
    records = _records(spark, sf).where("book_id > 0").withColumns({"errors": F.when(F.col("book_id") % 10 == 0, F.array(F.lit("broken"))), "fb2_isbn": F.when(F.col("book_id") % 4 == 1, "i")})
    rows = claims.dataset_rows(records).select(F.regexp_extract("artifact.name", r"^(\d+)", 1).cast("long").alias("book"), F.explode("observations").alias("o"))
    return rows.select("book", "o.id", "o.status", "o.coverage")


@query(f"""WITH {_RECORD_SQL} SELECT o_orderkey AS book, 'db' AS observation, 'catalog.book' AS scheme, o_orderkey::VARCHAR AS value FROM rec WHERE db AND o_orderkey > 0 UNION ALL SELECT o_orderkey, 'archive', 'catalog.book', o_orderkey::VARCHAR FROM rec WHERE o_orderkey > 0
UNION ALL SELECT o_orderkey, 'fb2', 'document.id', 'd' || o_orderkey FROM rec WHERE fb2 AND o_orderkey > 0""")
def identities(spark: SparkSession, sf: str) -> DataFrame:
    """By what each source knows a book."""
    records = _records(spark, sf).where("book_id > 0").withColumn("fb2_document_id", F.concat(F.lit("d"), F.col("book_id").cast("string")))
    rows = claims.dataset_rows(records).select(F.col("locator.index").alias("index"), F.col("artifact.name").alias("name"), F.explode("identities").alias("i"))
    return rows.select(F.regexp_extract("name", r"^(\d+)", 1).cast("long").alias("book"), "i.observation", "i.scheme", "i.value")


@query(f"""WITH {_RECORD_SQL} SELECT o_orderkey AS book, CASE WHEN db THEN trunc(o_totalprice)::BIGINT || ',' ELSE '' END || '1' AS sizes, CASE WHEN db THEN 'db:reported:' || o_orderstatus || ',' ELSE '' END || 'archive:calculated:h' AS checksums, 'application/fb2+xml' AS media,
(CASE WHEN o_orderkey % 6 = 0 THEN 'parse:fb2:bad,' ELSE '' END) || CASE WHEN o_orderkey % 8 = 0 THEN 'match:db:conflict' ELSE '' END AS issues FROM rec WHERE o_orderkey > 0""")
def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """A book's file: sizes and checksums by who says so, its kind, and what was wrong with it."""
    records = _records(spark, sf).where("book_id > 0").withColumns({"content_md5": F.lit("h"), "errors": F.when(F.col("book_id") % 6 == 0, F.array(F.lit("bad"))), "issue": F.when(F.col("book_id") % 8 == 0, "conflict")})
    rows = claims.dataset_rows(records)
    joined = lambda c, *fields: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ",")
    issues = F.concat(F.when(F.exists("issues", lambda i: i["stage"] == "parse"), "parse:fb2:bad,").otherwise(""), F.when(F.exists("issues", lambda i: (i["stage"] == "match") & (i["message"] == "conflict") & (i["observation"] == "db")), "match:db:conflict").otherwise(""))
    return rows.select(F.regexp_extract("artifact.name", r"^(\d+)", 1).cast("long").alias("book"), joined("artifact.sizes", "value").alias("sizes"), joined("artifact.checksums", "observation", "origin", "value").alias("checksums"),
                       F.col("artifact.media_type").alias("media"), issues.alias("issues"))


@query(f"""WITH {_RECORD_SQL} SELECT o_orderkey AS book, 'title' AS field, 'db' AS observation, db_title AS value FROM rec WHERE db_title <> '' AND o_orderkey > 0 UNION ALL SELECT o_orderkey, 'title', 'fb2', fb2_title FROM rec WHERE fb2_title <> '' AND o_orderkey > 0
UNION ALL SELECT o_orderkey, 'year', 'db', 'about ' || o_orderkey % 4 FROM rec WHERE db AND o_orderkey > 0""")
def claim_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All that sources claim, as rows."""
    records = _records(spark, sf).where("book_id > 0").withColumn("year", F.concat(F.lit("about "), (F.col("book_id") % 4).cast("string")))
    rows = claims.claims_of(claims.dataset_rows(records), ["title", "year"])
    return rows.select((F.col("locator.index") * 4 + F.regexp_extract("locator.source", r"(\d+)$", 1).cast("long")).alias("book"), "field", "observation", "value")


@query(f"""WITH {_RECORD_SQL} SELECT o_orderkey AS book, CASE WHEN db AND o_orderkey % 2 = 0 THEN (1900 + o_orderkey % 90)::BIGINT END AS number, CASE WHEN db THEN CASE WHEN o_orderkey % 2 = 0 THEN (1900 + o_orderkey % 90)::VARCHAR ELSE 'old' END ELSE '' END AS shown,
CASE WHEN fb2 THEN 'A1,B2' ELSE 'A1,B2' END AS people FROM rec WHERE o_orderkey > 0""")
def numbered_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Years beside their text, and people of the book file in their places."""
    person = lambda name: F.struct(F.lit(name).alias("last_name"), F.lit("").alias("first_name"), F.lit("").alias("middle_name"))
    year = F.when(F.col("book_id") % 2 == 0, (1900 + F.col("book_id") % 90).cast("string")).otherwise("old")
    view = claims.flat_view(claims.dataset_rows(_records(spark, sf).where("book_id > 0").withColumns({"year": year, "fb2_authors": F.array(person("A"), person("B"))})))
    people = F.array_join(F.transform("fb2_authors", lambda p: F.concat(p["last_name"], p["position"].cast("string"))), ",")
    return view.select(F.col("book_id").cast("long").alias("book"), F.col("db_year_number").alias("number"), F.col("db_year").alias("shown"), people.alias("people"))


@query("SELECT place, count(*) AS n FROM (SELECT unnest(['claim_title', 'relation']) AS place FROM orders WHERE o_orderkey > 0 AND o_orderkey % 5 = 1) GROUP BY place")
def undeclared_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Claims and relations that name an observation their row does not have."""
    rows = claims.dataset_rows(_records(spark, sf).where("book_id > 0"))
    broken = (F.regexp_extract("artifact.name", r"^(\d+)", 1).cast("long") % 5) == 1
    ghost = F.array(F.struct(F.lit("ghost").alias("observation"), F.lit("t").alias("value")))
    relation = F.from_json(F.lit('[{"observation":"ghost","kind":"replaced_by"}]'), rows.schema["relations"].dataType)
    rows = rows.withColumns({"claim_title": F.when(broken, ghost).otherwise(F.col("claim_title")), "relations": F.when(broken, relation).otherwise(F.col("relations"))})
    return validate.undeclared_observations(rows).groupBy("place").agg(F.count("*").alias("n"))


@query(f"""WITH {_RECORD_SQL} SELECT 'archive-3' AS id, (count(*) + count(*) FILTER (fb2))::BIGINT AS n FROM rec WHERE o_orderkey > 0 AND o_orderkey % 4 = 3""")
def undeclared_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Observations of an archive that the header does not declare."""
    rows = claims.dataset_rows(_records(spark, sf).where("book_id > 0"))
    layout = spark.range(3).select(F.concat(F.lit("archive-"), F.col("id").cast("string")).alias("id"))
    return validate.undeclared_sources(rows, layout).groupBy("id").agg(F.count("*").alias("n"))


@query("SELECT 'archive-' || o_orderkey % 4 AS id, o_orderkey // 4 AS index, 20::BIGINT AS entries FROM orders WHERE o_orderkey > 0 AND o_orderkey // 4 >= 20")
def bad_indexes(spark: SparkSession, sf: str) -> DataFrame:
    """Positions that their archive does not have."""
    layout = spark.range(4).select(F.concat(F.lit("archive-"), F.col("id").cast("string")).alias("id"), F.lit(20).cast("long").alias("entries"))
    return validate.bad_archive_indexes(claims.dataset_rows(_records(spark, sf).where("book_id > 0")), layout)


@query("""WITH p AS (SELECT 'archive-' || o_orderkey % 4 AS archive, o_orderkey // 4 AS index, o_orderkey % 4 * 1000000000 + (CASE WHEN o_orderkey % 20 = 8 THEN -1 ELSE 1 END) * (o_orderkey // 4) AS pos FROM orders WHERE o_orderkey > 0)
SELECT archive, index, pos FROM (SELECT *, lag(index) OVER (PARTITION BY archive ORDER BY pos) AS before, min(pos) OVER (PARTITION BY archive) AS first FROM p) WHERE index < before
UNION SELECT archive, index, pos FROM p WHERE archive <> 'archive-0' AND pos <= (SELECT max(b.pos) FROM p b WHERE b.archive < p.archive)""")
def order_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that stand before one of a lesser place in their archive, and archives out of turn."""
    rows = claims.dataset_rows(_records(spark, sf).where("book_id > 0"))
    index = F.col("locator.index")
    number = F.regexp_extract("locator.source", r"(\d+)$", 1).cast("long")
    odd = (index * 4 + number) % 20 == 8
    rows = rows.withColumn("pos", number * 1_000_000_000 + F.when(odd, -1).otherwise(1) * index)
    layout = spark.range(4).select(F.concat(F.lit("archive-"), F.col("id").cast("string")).alias("id"), F.col("id").alias("ordinal"))
    return validate.order_errors(rows, layout).select(F.col("locator.source").alias("archive"), F.col("locator.index").alias("index"), "pos")


@query("SELECT (SELECT count(*) FROM orders) AS actual, 7::BIGINT AS declared")
def count_errors(spark: SparkSession, sf: str) -> DataFrame:
    """A header that declares another number of records."""
    return validate.count_error(7, table(spark, sf, "orders"))


@query(f"""WITH {_RECORD_SQL} SELECT count(*) AS records, count(*) FILTER (db) AS db_records, count(*) FILTER (fb2) AS fb2_records, 0::BIGINT AS issues, 4::BIGINT AS archives, 40::BIGINT AS entries, 36::BIGINT AS fb2_entries FROM rec""")
def dataset_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a dataset and of its archives."""
    layout = spark.range(4).select(F.lit(10).cast("long").alias("entries"), F.lit(9).cast("long").alias("fb2_entries"))
    return inspection.dataset_summary(claims.dataset_rows(_records(spark, sf)), layout)


@query("SELECT 'entry' AS by, '41.fb2' AS file FROM orders WHERE o_orderkey = 41 UNION ALL SELECT 'file', '41.fb2' FROM orders WHERE o_orderkey = 41 UNION ALL SELECT 'observation', '43.fb2' FROM orders WHERE o_orderkey = 43")
def lookups(spark: SparkSession, sf: str) -> DataFrame:
    """A row by its place in an archive, by its file's name in any case, and by a book that only an observation names."""
    rows = claims.dataset_rows(_records(spark, sf))
    other = rows.withColumns({"identities": F.slice("identities", 1, 0), "observations": F.transform("observations", lambda o: o.withField("book_id", F.when(o["id"] == "db", o["book_id"])))})
    asked = (("entry", rows, inspection.at_entry("archive-1", 10)), ("file", rows, inspection.has_file("41.FB2")), ("observation", other, inspection.has_book(43)))
    found = [inspection.first_match(frame, condition, ["locator.source", "locator.index"]).select(F.lit(by).alias("by"), F.col("artifact.name").alias("file")) for by, frame, condition in asked]
    return found[0].union(found[1]).union(found[2])


@query("SELECT 'none' AS case, 'absent' AS coverage UNION ALL SELECT 'some', 'partial' UNION ALL SELECT 'all', 'complete'")
def coverage_classes(spark: SparkSession, sf: str) -> DataFrame:
    """How much of what there is was read."""
    n = F.count_if(F.col("p_size") < 10)
    part = table(spark, sf, "part").agg(n.alias("some"), F.count("*").alias("all"))
    return part.select(F.explode(F.array(*[F.struct(F.lit(name).alias("case"), inspection.coverage(a, F.col("all")).alias("coverage")) for name, a in (("none", F.lit(0)), ("some", F.col("some")), ("all", F.col("all")))])).alias("r")).select("r.*")


# --- smaller exports and rollups --------------------------------------------------------------

@query("""WITH a AS (SELECT 'archive-' || o_orderkey % 4 AS archive, string_agg('<annotation file="' || o_orderkey || '">&lt;b&gt; &amp; ' || o_orderpriority || '</annotation>', chr(10) ORDER BY o_orderkey // 4) AS x FROM orders WHERE o_orderkey > 0 AND o_orderkey % 5 <> 0 GROUP BY 1)
SELECT archive, '<annotations>' || chr(10) || x || chr(10) || '</annotations>' AS xml FROM a""")
def annotations_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations of an archive's books as one document, in order."""
    records = _records(spark, sf).where("book_id > 0").withColumn("fb2_annotation", F.concat(F.lit("<b> & "), F.col("series")[0]["name"]))
    return exports.annotations(claims.flat_view(claims.dataset_rows(records)))


@query("""SELECT c_custkey AS book, '{"folder":"f","file":"' || c_custkey || '.fb2","compilation":[{"part":0,"folder":"f","file":"' || (c_custkey + 1) || '.fb2"},{"part":1,"folder":"f","file":"' || (c_custkey + 2) || '.fb2"}],"covered":true}' AS json
FROM customer WHERE c_custkey + 2 <= (SELECT max(c_custkey) FROM customer)""")
def compilations_json(spark: SparkSession, sf: str) -> DataFrame:
    """Books that hold others, as JSON."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("book"))
    last = rows.agg(F.max("book").alias("last"))
    books = rows.select("book", F.lit("f").alias("folder"), F.concat(F.col("book").cast("string"), F.lit(".fb2")).alias("file"))
    parts = rows.join(last).where("book + 2 <= last").select("book", F.explode(F.array(F.lit(0), F.lit(1))).alias("part"), F.lit(True).alias("covered")).withColumn("match", F.col("book") + 1 + F.col("part"))  # one row beside
    return exports.compilations_json(parts, books)


@query(f"""WITH {_RECORD_SQL}, r AS (SELECT *, 'archive-' || o_orderkey % 4 AS archive, o_orderkey % 3 AS n FROM rec WHERE o_orderkey > 0)
SELECT archive, count(*) AS books, count(*) FILTER (n = 1) AS disambiguated_books, count(*) FILTER (n = 1) AS disambiguated_authors, count(*) FILTER (db) AS canonical_languages FROM r GROUP BY archive""")
def export_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """What an export changed: authors told apart, and languages made canonical."""
    person = F.struct(F.lit("a").alias("last_name"), F.lit("b").alias("first_name"), F.lit("").alias("middle_name"), F.when(F.col("book_id") % 3 == 1, "[x]").otherwise("").alias("suffix"))
    view = claims.flat_view(claims.dataset_rows(_records(spark, sf).where("book_id > 0").withColumn("authors", F.array(person))))
    return exports.export_diagnostics(view.withColumn("language", F.when(F.col("has_db"), F.upper("db_language")).otherwise(F.col("db_language"))), raw_language="db_language")


@query("""SELECT o_orderkey AS book, row_number() OVER (ORDER BY o_orderkey) - 1 AS index FROM orders""")
def running_index(spark: SparkSession, sf: str) -> DataFrame:
    """Records without an archive, numbered through."""
    return ranges.running_index(table(spark, sf, "orders").select(F.col("o_orderkey").alias("book")), "book", "index", width=1000)


@query("""SELECT o_orderkey AS id, 'lib - 2026-06-22' || chr(13) || chr(10) || 'lib_20260622' || chr(13) || chr(10) || '65536' || chr(13) || chr(10) || 'lib' || chr(13) || chr(10) AS collection, '20260622' || chr(13) || chr(10) AS version, 'A;B;' || chr(13) || chr(10) AS structure,
'lib_20260622' AS comment, 'x lib' || chr(13) || chr(10) AS made, 'out_20260622.zip' AS path FROM orders WHERE o_orderkey = 1""")
def info_members(spark: SparkSession, sf: str) -> DataFrame:
    """The small texts beside an export."""
    made = {"collection": exchange.collection_info("lib", "20260622"), "version": exchange.version_info("20260622"), "structure": exchange.structure_info("A;B;"), "comment": exchange.zip_comment("lib", "20260622"),
            "made": exchange.render_template("x {database}\n", database="lib"), "path": vl.output_path("out.zip", vl.ensure_dump_date("", "2026-06-22")[0])}
    return table(spark, sf, "orders").where("o_orderkey = 1").select(F.col("o_orderkey").alias("id"), *[F.lit(v).alias(k) for k, v in made.items()])


@query("""WITH RECURSIVE e AS (SELECT p_partkey AS book, p_size AS size, row_number() OVER (ORDER BY p_partkey) AS n FROM part WHERE p_partkey > 20 AND p_size > 3),
f(n, book, size, room, bin) AS (SELECT n, book, size, 1900 - size, 0 FROM e WHERE n = 1 UNION ALL SELECT e.n, e.book, e.size, (CASE WHEN f.room <= 0 THEN 2000 ELSE f.room END) - e.size, f.bin + CASE WHEN f.room <= 0 THEN 1 ELSE 0 END FROM f JOIN e ON e.n = f.n + 1)
SELECT bin, min(book) AS begin, max(book) AS "end", count(*) AS entries, sum(size)::BIGINT AS bytes, sum(size) >= CASE WHEN bin = 0 THEN 1900 ELSE 2000 END AS finalised FROM f GROUP BY bin""")
def rollup_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Archives that updates would fill: entries beyond the finalised ones, empty ones left out, the archive in progress first."""
    entries = table(spark, sf, "part").select(F.col("p_partkey").alias("book_id"), F.when(F.col("p_size") > 3, F.col("p_size")).otherwise(0).cast("long").alias("size"))
    fresh = rollup.new_entries(entries, 20, entries.where("false"), order=["size"])
    return rollup.plan_archives(fresh, 2000, used=100)


@query("""SELECT p_partkey AS book_id, 'last' AS archive FROM part WHERE p_partkey BETWEEN 11 AND 20 UNION ALL SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'u0' ELSE 'u1' END FROM part WHERE p_partkey > 20""")
def rollup_with_last(spark: SparkSession, sf: str) -> DataFrame:
    """The last archive, which has room, taken in before the updates, whose repeats go by their archives' order."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("book_id"), F.lit(1).cast("long").alias("size"))
    last = part.where("book_id between 11 and 20").withColumn("archive", F.lit("last"))
    updates = part.where("book_id % 2 = 0").withColumn("archive", F.lit("u0")).union(part.withColumn("archive", F.lit("u1")))
    return rollup.with_last_archive(last, updates, finalised_end=20, target=50).select("book_id", "archive")


@query("""SELECT 'fb2-' || lpad(p_partkey::VARCHAR, 6, '0') || '-' || lpad((p_partkey + p_size)::VARCHAR, 6, '0') || '.zip' AS name, p_partkey AS begin FROM part""")
def archive_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names of merged archives."""
    return table(spark, sf, "part").select(rollup.archive_name("fb2", F.col("p_partkey"), F.col("p_partkey") + F.col("p_size"), 6).alias("name"), F.col("p_partkey").alias("begin"))
