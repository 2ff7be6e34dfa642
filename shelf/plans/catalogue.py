"""Queries over the driver's tables, by name, with DuckDB oracles.

The star schema stands in for a catalogue: orders are books, lineitem links them to people (part),
customers give genres, ratings come from quantities, documents are texts whose lines are sections.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.functions import text as tx
from shelf.functions import values as vl
from shelf.operators import authors, claims, exports, facets, fingerprints, inspection, language, matching, ranges, rollup, series, validate
from shelf.session import materialised, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with its SQL."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


# --- facets and joins -------------------------------------------------------------------------

_PEOPLE_SQL = """
links AS (SELECT l_orderkey AS book_id, l_linenumber AS pos, CASE WHEN l_partkey % 7 = 0 THEN l_partkey + 1 ELSE l_partkey END AS good, l_partkey, l_suppkey FROM lineitem),
people AS (SELECT l.book_id, l.pos, p.p_partkey AS person_id, l.l_suppkey AS sup, p.p_name || ',' || p.p_brand || ',:' AS name
    FROM links l JOIN part p ON p.p_partkey = CASE WHEN l.l_partkey % 7 = 0 AND l.good IN (SELECT p_partkey FROM part) THEN l.good ELSE l.l_partkey END)"""


def _aliases(parts: DataFrame) -> DataFrame:
    """Every seventh part is an alias of the next, where there is one."""
    ids = parts.select(F.col("p_partkey").alias("good_id"))
    return ids.withColumn("bad_id", F.col("good_id") - 1).where("bad_id % 7 = 0")


def _contributors(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    links = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("book_id"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("person_id"), F.col("l_suppkey").alias("sup"))
    people = parts.select(F.col("p_partkey").alias("person_id"), F.col("p_name").alias("last_name"), F.col("p_brand").alias("first_name"), F.lit("").alias("middle_name"), F.lit("").alias("suffix"))
    return facets.redirect(links, _aliases(parts)).join(people, "person_id")


@query(f"""
WITH {_PEOPLE_SQL},
authors AS (SELECT book_id, string_agg(name, '' ORDER BY pos, person_id, sup, name) AS authors FROM people GROUP BY book_id),
rated AS (SELECT l_orderkey AS book_id, round(avg(l_quantity::INT % 5 + 1)) AS rate FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS book_id, coalesce(authors, 'неизвестный,автор,:') || chr(4) || c_mktsegment || ':' || chr(4) || o_orderpriority || chr(4) || o_orderkey || chr(4)
    || strftime(o_orderdate, '%Y-%m-%d') || chr(4) || o_orderstatus || chr(4) || coalesce(trunc(rate)::BIGINT::VARCHAR, '') || chr(4) || chr(13) || chr(10) AS line
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN authors a ON a.book_id = o_orderkey LEFT JOIN rated r ON r.book_id = o_orderkey""")
def export_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One export line per book: authors through aliases in order, genre, title, date, rating."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    ratings = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("book_id"), (F.col("l_quantity").cast("int") % 5 + 1).alias("rate"))
    books = orders.select(F.col("o_orderkey").alias("book_id"), "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate")
    books = books.join(customers.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left")
    books = facets.attach(books, _contributors(spark, sf), "book_id", "authors", ["pos", "person_id", "sup", "last_name", "first_name", "middle_name", "suffix"])
    books = books.join(facets.rating_stats(ratings, "book_id", "rate"), "book_id", "left")
    line = tx.join_fields(tx.people(F.col("authors")), tx.genre_codes(F.array("c_mktsegment")), tx.cleanse(F.col("o_orderpriority")), F.col("book_id").cast("string"),
                          F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderstatus"), vl.rating_whole(vl.rating_text(F.col("rating_average"), F.col("rating_count"))))
    return books.select("book_id", line.alias("line"))


@query("""SELECT o_custkey AS person_id, string_agg(o_orderkey::VARCHAR || '@' || o_orderpriority, ',' ORDER BY o_orderdate, o_orderkey) AS books FROM orders GROUP BY o_custkey""")
def ordered_collect(spark: SparkSession, sf: str) -> DataFrame:
    """Each customer's orders in the order of their dates."""
    rows = table(spark, sf, "orders").withColumn("person_id", F.col("o_custkey"))
    listed = facets.ordered_collect(rows, "person_id", "o", ["o_orderdate", "o_orderkey"], ["o_orderpriority"])
    return listed.select("person_id", F.array_join(F.transform("o", lambda x: F.concat(x["o_orderkey"].cast("string"), F.lit("@"), x["o_orderpriority"])), ",").alias("books"))


@query(f"""WITH {_PEOPLE_SQL} SELECT person_id, count(*) AS links, count(DISTINCT book_id) AS books FROM people GROUP BY person_id""")
def alias_redirect_join(spark: SparkSession, sf: str) -> DataFrame:
    """Links per person after aliases are resolved; links that fall together are all counted."""
    return _contributors(spark, sf).groupBy("person_id").agg(F.count("*").alias("links"), F.countDistinct("book_id").alias("books"))


@query("""WITH p AS (SELECT c_custkey AS id, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey ELSE 0 END, 0), c_custkey) AS main FROM customer)
SELECT o_orderkey AS book_id, p.main AS person_id, c.c_name AS last_name FROM orders JOIN p ON o_custkey = p.id JOIN customer c ON c.c_custkey = p.main""")
def main_canonical_self_join(spark: SparkSession, sf: str) -> DataFrame:
    """People resolved to their main entry by a self-join; 0 means the person."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("person_id"), F.col("c_name").alias("last_name"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey")).otherwise(0).alias("main"))
    links = table(spark, sf, "orders").select(F.col("o_orderkey").alias("book_id"), F.col("o_custkey").alias("person_id"))
    return facets.canonical_people(links, people).select("book_id", "person_id", "last_name")


@query("""SELECT s_suppkey AS book_id, coalesce(t.trg, n_name) AS code, r_name AS meta FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT n_name AS src, lower(n_name) AS trg FROM nation WHERE n_nationkey % 2 = 0) t ON t.src = n_name""")
def dim_left_translate(spark: SparkSession, sf: str) -> DataFrame:
    """Genres with their dimension, codes translated where there is a translation."""
    nation = table(spark, sf, "nation")
    rows = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.select(F.col("s_suppkey").alias("book_id"), F.col("n_name").alias("code"), F.col("r_name").alias("meta"))
    return facets.translate_codes(rows, nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("src"), F.lower("n_name").alias("trg")))


@query("""WITH e AS (SELECT event_id, user_id AS bad, event_id % 50 AS good, CASE WHEN event_id % 3 = 0 THEN user_id END AS real FROM events)
SELECT b.id AS book_id, e.event_id FROM (SELECT DISTINCT user_id AS id FROM events UNION SELECT DISTINCT event_id % 50 FROM events) b JOIN e ON b.id > 0 AND (e.bad = b.id OR e.good = b.id OR e.real = b.id)""")
def merge_events_disjunctive(spark: SparkSession, sf: str) -> DataFrame:
    """Merge events of every book in them, once per book: an equi-join after exploding distinct participants."""
    events = table(spark, sf, "events").select("event_id", F.col("user_id").alias("bad"), (F.col("event_id") % 50).alias("good"), F.when(F.col("event_id") % 3 == 0, F.col("user_id")).alias("real"))
    return facets.events_by_participant(events, ["bad", "good", "real"]).select("book_id", "event_id")


@query("""SELECT user_id AS book_id, round(avg(value::INT % 5)) AS rating_average, count(*) AS rating_count, min(trunc(value)::INT % 5) AS rating_min, max(trunc(value)::INT % 5) AS rating_max
FROM (SELECT user_id, trunc(value) AS value FROM events WHERE value IS NOT NULL) GROUP BY user_id""")
def rating_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rounded average, count, least and greatest rating."""
    rows = table(spark, sf, "events").select(F.col("user_id").alias("book_id"), (F.col("value").cast("int") % 5).alias("rate"))
    return facets.rating_stats(rows, "book_id", "rate")


@query("""SELECT p_brand AS book_id, arg_min(p_name, {'a': p_name, 'b': p_partkey}) AS file_name FROM part GROUP BY p_brand""")
def first_alias(spark: SparkSession, sf: str) -> DataFrame:
    """The first file name of each book."""
    rows = table(spark, sf, "part").select(F.col("p_brand").alias("book_id"), F.col("p_name").alias("file_name"), "p_partkey")
    return facets.first_per_key(rows, "book_id", "file_name", ["file_name", "p_partkey"])


@query("""SELECT o_orderkey AS book_id, o_custkey AS author, c_name, n_name AS genre, rating_count FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) AS rating_count FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""")
def star_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Books with their facets, each aggregated first, so nothing fans out."""
    counts = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("rating_count"))
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.join(counts, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(F.col("o_orderkey").alias("book_id"), F.col("o_custkey").alias("author"), "c_name", F.col("n_name").alias("genre"), "rating_count")


@query("""SELECT o_orderkey AS book_id, coalesce(f.name, o_orderkey::VARCHAR) AS stem, CASE WHEN f.name IS NULL THEN 'fb2' ELSE 'zip' END AS ext FROM orders
LEFT JOIN (SELECT l_orderkey, min(l_shipdate::DATE::VARCHAR) AS name FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) f ON f.l_orderkey = o_orderkey""")
def file_identities(spark: SparkSession, sf: str) -> DataFrame:
    """A book's file: its first known name, or its number."""
    books = table(spark, sf, "orders").select(F.col("o_orderkey").alias("book_id"), F.lit("fb2").alias("file_type"))
    names = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("book_id"), F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".zip")).alias("file_name"))
    return facets.file_identities(books, names)


# --- matching ---------------------------------------------------------------------------------

_ALIAS_SQL = "aliases AS (SELECT lower(trim(p_name || p_brand)) AS key, p_partkey AS book_id FROM part)"


def _alias_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(tx.file_key(F.concat("p_name", "p_brand")).alias("key"), F.col("p_partkey").alias("book_id"))


@query(f"WITH {_ALIAS_SQL} SELECT key, min(book_id) AS book_id FROM aliases GROUP BY key HAVING count(DISTINCT book_id) = 1")
def unique_alias_index(spark: SparkSession, sf: str) -> DataFrame:
    """File names that point to one book only."""
    return matching.alias_index(_alias_rows(spark, sf), "key", "book_id")


@query(f"WITH {_ALIAS_SQL} SELECT key, count(DISTINCT book_id) AS targets FROM aliases GROUP BY key HAVING count(DISTINCT book_id) > 1")
def ambiguous_alias(spark: SparkSession, sf: str) -> DataFrame:
    """File names of several books."""
    return matching.ambiguous_keys(_alias_rows(spark, sf), "key", "book_id")


@query("""WITH entries AS (SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey::VARCHAR || '.fb2' WHEN o_orderkey % 3 = 1 THEN 'Book' || (o_custkey % 97) || '.fb2' ELSE 'x' || o_orderkey || '.zip' END AS entry,
    CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE 0 END AS entry_number FROM orders),
books AS (SELECT c_custkey AS book_id FROM customer WHERE c_custkey % 2 = 0),
raw AS (SELECT 'book' || c_custkey % 131 AS key, c_custkey AS book_id FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT (c_custkey + 2)::VARCHAR || '.fb2', c_custkey FROM customer WHERE c_custkey % 4 = 1),
aliases AS (SELECT key, min(book_id) AS book_id FROM raw GROUP BY key HAVING count(DISTINCT book_id) = 1),
cand AS (SELECT record_id, 0 AS pos, lower(regexp_replace(entry, '\\.[^.]*$', '')) AS key FROM entries UNION ALL SELECT record_id, 1, lower(entry) FROM entries),
hit AS (SELECT record_id, arg_min(a.book_id, pos) AS alias_id, arg_min(key, pos) AS alias_key FROM cand JOIN aliases a USING (key) GROUP BY record_id)
SELECT e.record_id, entry, entry_number, coalesce(b.book_id, alias_id) AS matched_id, CASE WHEN b.book_id IS NOT NULL THEN 'numeric_entry_stem' WHEN alias_id IS NOT NULL THEN 'filename_alias' ELSE 'none' END AS method,
    alias_id, alias_key, CASE WHEN b.book_id IS NOT NULL AND alias_id <> b.book_id THEN 'conflicting_match_evidence' WHEN b.book_id IS NULL AND alias_id IS NOT NULL AND entry_number > 0 AND alias_id <> entry_number THEN 'catalog_id_conflict' END AS issue
FROM entries e LEFT JOIN books b ON b.book_id = entry_number LEFT JOIN hit h ON h.record_id = e.record_id""")
def match_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """Entries to books: by number, else by the first known name; evidence against a match is an issue."""
    key = F.col("o_orderkey")
    entry = F.when(key % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".fb2"))).when(key % 3 == 1, F.concat(F.lit("Book"), (F.col("o_custkey") % 97).cast("string"), F.lit(".fb2"))).otherwise(F.concat(F.lit("x"), key.cast("string"), F.lit(".zip")))
    entries = table(spark, sf, "orders").select(key.alias("record_id"), entry.alias("entry")).withColumn("entry_number", tx.entry_id(F.col("entry")))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("book_id"))
    named = customers.where("book_id % 5 = 0").select(F.concat(F.lit("book"), (F.col("book_id") % 131).cast("string")).alias("key"), "book_id")
    numbered = customers.where("book_id % 4 = 1").select(F.concat((F.col("book_id") + 2).cast("string"), F.lit(".fb2")).alias("key"), "book_id")
    return matching.match_cascade(entries, customers.where("book_id % 2 = 0"), matching.alias_index(named.union(numbered), "key", "book_id"))


@query("""WITH g AS (SELECT c_mktsegment || ',' || c_nationkey || ',' AS key, c_custkey::VARCHAR AS id, (c_custkey % 4)::VARCHAR AS nick FROM customer),
c AS (SELECT *, count(*) OVER (PARTITION BY key) AS n, count(*) OVER (PARTITION BY key, nick) AS same FROM g),
s AS (SELECT *, CASE WHEN same = 1 THEN '[' || nick || ']' ELSE '[#' || id || ']' END AS first, '[' || nick || ' #' || id || ']' AS second FROM c WHERE n > 1)
SELECT key, id, CASE WHEN row_number() OVER (PARTITION BY key, first ORDER BY id) = 1 THEN first ELSE second END AS suffix FROM s""")
def collision_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Authors of one name, with suffixes that tell them apart."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("last_name"), F.col("c_nationkey").cast("string").alias("first_name"),
                                                 F.lit("").alias("middle_name"), (F.col("c_custkey") % 4).cast("string").alias("nick_name"))
    return authors.author_suffixes(authors.collision_groups(people)).select("key", "id", "suffix")


@query("""WITH g AS (SELECT c_mktsegment || ',' || c_nationkey AS key, count(*) AS n FROM customer GROUP BY 1) SELECT count(*) AS groups, sum(n)::BIGINT AS authors FROM g WHERE n > 1""")
def ambiguity_totals(spark: SparkSession, sf: str) -> DataFrame:
    """How many names collide, and how many authors have them."""
    people = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("last_name"), F.col("c_nationkey").cast("string").alias("first_name"), F.lit("").alias("middle_name"), F.lit("").alias("nick_name"))
    return authors.ambiguity_totals(authors.collision_groups(people))


# --- positions --------------------------------------------------------------------------------

@query("""WITH s AS (SELECT p_brand AS archive, max(p_size)::BIGINT + 3 AS entries FROM part GROUP BY p_brand),
i(a, b) AS (VALUES (2, 4)) SELECT archive, x.position::BIGINT AS position FROM s, range(s.entries) AS x(position) WHERE position NOT BETWEEN 2 AND 4
    AND NOT EXISTS (SELECT 1 FROM part WHERE p_brand = archive AND p_size = position)""")
def gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of each archive that no entry has and that are not ignored."""
    part = table(spark, sf, "part")
    sizes = part.groupBy(F.col("p_brand").alias("archive")).agg((F.max("p_size").cast("long") + 3).alias("entries"))
    rows = part.select(F.col("p_brand").alias("archive"), F.col("p_size").cast("long").alias("position"))
    return ranges.missing_positions(sizes, rows, "archive", "position", sizes.select("archive", F.lit(2).alias("start"), F.lit(4).alias("end")))


@query("""WITH d AS (SELECT DISTINCT p_brand AS archive, p_size AS i FROM part WHERE p_size % 7 <> 0), r AS (SELECT *, i - row_number() OVER (PARTITION BY archive ORDER BY i) AS run FROM d)
SELECT archive, min(i) AS start, max(i) AS "end", count(*) AS n FROM r GROUP BY archive, run""")
def index_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of consecutive positions."""
    rows = table(spark, sf, "part").where("p_size % 7 <> 0").select(F.col("p_brand").alias("archive"), F.col("p_size").alias("i"))
    return ranges.index_ranges(rows, ["archive"], "i")


@query("""WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, lag(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS before FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM o WHERE l_suppkey < before""")
def order_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that are out of order."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ranges.order_violations(rows, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], ["l_suppkey"])


@query("""SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, text) AS before FROM conversations) WHERE role < before""")
def conversation_order(spark: SparkSession, sf: str) -> DataFrame:
    """Turns whose role stands before the previous one's by name."""
    return ranges.order_violations(table(spark, sf, "conversations"), ["conv_id"], ["turn", "text"], ["role"]).select("conv_id", "turn", "role")


@query("""WITH n AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS input_record FROM orders), a AS (SELECT * FROM n WHERE o_totalprice > 50000)
SELECT o_custkey, o_orderkey, input_record, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS accepted_row, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS accepted_book,
    o_orderpriority AS split_key FROM a""")
def accepted_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    """Running numbers of input and accepted rows, and the key by which a record is split."""
    rows = ranges.accepted_ordinals(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_totalprice") > 50000, F.col("o_orderpriority"))
    return rows.select("o_custkey", "o_orderkey", "input_record", "accepted_row", "accepted_book", "split_key")


@query("""SELECT o_orderkey AS book_id, CASE WHEN o_orderkey <= 0 THEN 'other' ELSE printf('%010d-%010d', ((o_orderkey - 1) // 1000) * 1000 + 1, ((o_orderkey - 1) // 1000 + 1) * 1000) END AS bucket FROM orders""")
def range_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The range of ids that a book's member is named by, through the SQL function of user expressions."""
    tx.register_functions(spark)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("book_id"), F.expr("range_name(cast(o_orderkey AS STRING), 1000, 'other')").alias("bucket"))


@query("""WITH RECURSIVE e AS (SELECT o_custkey, o_orderkey, trunc(o_totalprice)::BIGINT AS size, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
f(o_custkey, n, size, "left", bin) AS (SELECT o_custkey, n, size, 300000 - size, 0 FROM e WHERE n = 1
    UNION ALL SELECT e.o_custkey, e.n, e.size, (CASE WHEN f."left" <= 0 THEN 300000 ELSE f."left" END) - e.size, f.bin + CASE WHEN f."left" <= 0 THEN 1 ELSE 0 END FROM f JOIN e ON e.o_custkey = f.o_custkey AND e.n = f.n + 1)
SELECT o_custkey, o_orderkey, e.size, bin FROM f JOIN e USING (o_custkey, n)""")
def greedy_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Entries dealt to archives that are closed once their size is reached."""
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").cast("long").alias("size"))
    return ranges.greedy_bins(rows, ["o_custkey"], ["o_orderkey"], "size", 300000)


# --- fingerprints -----------------------------------------------------------------------------

_WORDS_SQL = """words AS (SELECT doc_id, line, w AS word, count(*) AS n FROM (SELECT doc_id, line, unnest(list_transform(regexp_split_to_array(translate(lower(translate(t, 'İΣ', 'iσ')), 'ёйъ', 'еиь'),
    '[\\p{Zs}\\p{Zl}\\p{Zp}\\p{Cc}\\p{P}]'), lambda x: regexp_replace(replace(x, 'ыо', 'ью'), '\\P{L}', '', 'g'))) AS w FROM sections) WHERE w <> '' GROUP BY ALL)"""
_DIGEST_SQL = """ranked AS (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY least(8, length(word)) DESC, n DESC, word DESC) AS r FROM {h}),
digests AS (SELECT {k}, md5(coalesce(string_agg(word, '' ORDER BY r) FILTER (r <= 10), '')) AS hex, count(*) AS words FROM ranked GROUP BY {k})"""


def _text64(hex_: str) -> str:
    return f"rtrim(translate(to_base64(unhex({hex_})), '+/', '-_'), '=')"


@query(f"""WITH sections AS (SELECT doc_id, 0 AS line, text AS t FROM documents), {_WORDS_SQL}, {_DIGEST_SQL.format(k='doc_id', h='words')}
SELECT d.doc_id, coalesce(words, 0) AS words, {_text64("coalesce(hex, md5(''))")} AS digest FROM documents d LEFT JOIN digests USING (doc_id)""")
def fingerprint_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The body digest of every document."""
    docs = table(spark, sf, "documents")
    return fingerprints.section_digests(fingerprints.section_words(docs, ["doc_id"], "text"), docs, ["doc_id"])


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line", "t")).withColumn("line", F.col("line") + 1)


_LINES_SQL = "sections AS (SELECT doc_id, line, lines[line] AS t FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))"


@query(f"""WITH {_LINES_SQL}, {_WORDS_SQL}, rolled AS (SELECT doc_id, line, word, n FROM words UNION ALL SELECT doc_id, 0, word, sum(n)::BIGINT FROM words GROUP BY doc_id, word),
{_DIGEST_SQL.format(k='doc_id, line', h='rolled')} SELECT doc_id, line, words, {_text64('hex')} AS digest FROM digests""")
def section_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of lines and, over all their lines, of documents."""
    lines = _lines(spark, sf)
    own = fingerprints.section_words(lines, ["doc_id", "line"], "t")
    ancestors = lines.select("doc_id", "line", F.explode(F.array(F.col("line"), F.lit(0))).alias("ancestor"))
    rolled = fingerprints.roll_up(own, ancestors, "doc_id", "line")
    return fingerprints.section_digests(rolled, None, ["doc_id", "line"])


_BOOK_SQL = f"""{_LINES_SQL}, {_WORDS_SQL}, {_DIGEST_SQL.format(k='doc_id, line', h='words')},
whole AS (SELECT doc_id, word, sum(n)::BIGINT AS n FROM words GROUP BY ALL)"""


def _digested(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Lines and, as line 0, documents with their digests: every word is counted for both at once."""
    lines = _lines(spark, sf).withColumn("line", F.explode(F.array("line", F.lit(0))))
    digests = materialised(fingerprints.section_digests(fingerprints.section_words(lines, ["doc_id", "line"], "t"), None, ["doc_id", "line"]))
    return digests.where("line > 0"), digests.where("line = 0").drop("line")


@query(f"""WITH {_BOOK_SQL} SELECT {_text64('hex')} AS digest, count(DISTINCT doc_id) AS books, count(*) AS sections FROM digests GROUP BY hex HAVING count(DISTINCT doc_id) > 1""")
def shared_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections that several books have."""
    own, _ = _digested(spark, sf)
    return own.groupBy("digest").agg(F.countDistinct("doc_id").alias("books"), F.count("*").alias("sections")).where("books > 1")


@query(f"""WITH {_BOOK_SQL}, wr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY least(8, length(word)) DESC, n DESC, word DESC) AS r FROM whole),
bodies AS (SELECT doc_id, md5(string_agg(word, '' ORDER BY r)) AS hex FROM wr WHERE r <= 10 GROUP BY doc_id),
roots AS (SELECT doc_id AS match, hex FROM digests WHERE line = 1),
own AS (SELECT d.doc_id, d.line, d.hex FROM digests d JOIN bodies o ON o.doc_id = d.doc_id WHERE o.hex <> d.hex),
hits AS (SELECT doc_id, line, hex FROM own WHERE hex IN (SELECT hex FROM roots)),
firsts AS (SELECT doc_id, hex, min(line) AS line FROM hits GROUP BY ALL),
parts AS (SELECT h.doc_id, h.line, h.hex, (SELECT count(*) FROM firsts f WHERE f.doc_id = h.doc_id AND f.line < h.line) AS part FROM hits h)
SELECT p.doc_id AS book, part::INT AS part, {_text64('p.hex')} AS key, r.match, r.matches, NOT EXISTS (SELECT 1 FROM own o WHERE o.doc_id = p.doc_id AND o.hex NOT IN (SELECT hex FROM roots)) AS covered
FROM parts p JOIN (SELECT hex, min(match) AS match, count(*) AS matches FROM roots GROUP BY hex) r ON r.hex = p.hex WHERE (SELECT count(*) FROM firsts f WHERE f.doc_id = p.doc_id) > 1""")
def compilations(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold the opening lines of others: each opening line is a book of its own; a class per line, with its number of documents and the least."""
    own, whole = _digested(spark, sf)
    leaves = own.select(F.col("doc_id").alias("book"), F.col("line").cast("long").alias("pos"), F.lit(1).alias("depth"), F.col("digest").alias("key"), F.lit(True).alias("leaf"))
    heads = whole.select(F.col("doc_id").alias("book"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("depth"), F.col("digest").alias("key"), F.lit(False).alias("leaf"))
    openings = own.where("line = 1").select(F.col("digest").alias("key"), F.col("doc_id").alias("match"))
    return fingerprints.compilation_classes(leaves.union(heads), openings)


@query(f"""WITH {_BOOK_SQL}, wr AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY least(8, length(word)) DESC, n DESC, word DESC) AS r FROM whole),
roots AS (SELECT doc_id AS match, md5(string_agg(word, '' ORDER BY r)) AS hex FROM wr WHERE r <= 10 GROUP BY doc_id),
own AS (SELECT d.doc_id, d.line, d.hex FROM digests d JOIN roots o ON o.match = d.doc_id WHERE o.hex <> d.hex),
hits AS (SELECT doc_id, line, hex FROM own WHERE hex IN (SELECT hex FROM roots)),
firsts AS (SELECT doc_id, hex, min(line) AS line FROM hits GROUP BY ALL),
parts AS (SELECT h.doc_id, h.line, h.hex, (SELECT count(*) FROM firsts f WHERE f.doc_id = h.doc_id AND f.line < h.line) AS part FROM hits h)
SELECT p.doc_id AS book, part::INT AS part, {_text64('p.hex')} AS key, r.match, r.matches, NOT EXISTS (SELECT 1 FROM own o WHERE o.doc_id = p.doc_id AND o.hex NOT IN (SELECT hex FROM roots)) AS covered
FROM parts p JOIN (SELECT hex, min(match) AS match, count(*) AS matches FROM roots GROUP BY hex) r ON r.hex = p.hex WHERE (SELECT count(*) FROM firsts f WHERE f.doc_id = p.doc_id) > 1""")
def body_compilations(spark: SparkSession, sf: str) -> DataFrame:
    """Documents made of other documents: lines whose digest is another document's, a class of equal ones with their number and the least."""
    own, whole = _digested(spark, sf)
    leaves = own.select(F.col("doc_id").alias("book"), F.col("line").cast("long").alias("pos"), F.lit(1).alias("depth"), F.col("digest").alias("key"), F.lit(True).alias("leaf"))
    heads = whole.select(F.col("doc_id").alias("book"), F.lit(0).cast("long").alias("pos"), F.lit(0).alias("depth"), F.col("digest").alias("key"), F.lit(False).alias("leaf"))
    return fingerprints.compilation_classes(leaves.union(heads), whole.select(F.col("digest").alias("key"), F.col("doc_id").alias("match")))


# --- text, values, languages ------------------------------------------------------------------



_CLEANSE = "replace(replace(replace(replace(replace({0}, chr(13) || chr(10), ' '), chr(13), ' '), chr(10), ''), chr(4), ' '), chr(160), ' ')"


@query(f"SELECT doc_id, md5({_CLEANSE.format('text')}) AS digest, length({_CLEANSE.format('text')}) AS n FROM documents")
def cleanse_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts on one line."""
    clean = tx.cleanse(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(clean).alias("digest"), F.length(clean).cast("long").alias("n"))


@query(f"SELECT doc_id, CASE WHEN length({_CLEANSE.format('text')}) > 149 THEN regexp_replace(substr({_CLEANSE.format('text')}, 1, 149), '\\s+$', '') ELSE {_CLEANSE.format('text')} END AS title FROM documents")
def truncate_field(spark: SparkSession, sf: str) -> DataFrame:
    """Titles cut to their limit."""
    return table(spark, sf, "documents").select("doc_id", tx.truncate_field(F.col("text"), 150).alias("title"))


@query("SELECT p_partkey AS id, list_aggregate(list_transform(list_filter(list_transform(regexp_split_to_array(p_type || ', ' || p_name || ';;/x', '[,;/.()\\[\\]:]'), lambda x: trim(x)), lambda x: x <> ''), lambda x: x || ':'), 'string_agg', '') AS keywords FROM part")
def keywords_split(spark: SparkSession, sf: str) -> DataFrame:
    """Keywords, each with its colon."""
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), tx.keywords(F.concat("p_type", F.lit(", "), "p_name", F.lit(";;/x"))).alias("keywords"))


@query("SELECT page_id, CASE WHEN k IN ('', '.', '..') THEN 'other' ELSE k END || '.inp' AS member FROM (SELECT page_id, trim(regexp_replace(trim(url), '[/\\\\\\x00-\\x1f\\x7f-\\x{9f}]+', '_', 'g'), '. ') AS k FROM pages)")
def split_key(spark: SparkSession, sf: str) -> DataFrame:
    """URLs as members' names."""
    return table(spark, sf, "pages").select("page_id", tx.split_key(F.col("url")).alias("member"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&#34;'), '''', '&#39;')) AS digest FROM pages")
def xml_escape(spark: SparkSession, sf: str) -> DataFrame:
    """Pages escaped for XML."""
    return table(spark, sf, "pages").select("page_id", F.md5(tx.xml_escape(F.col("html"))).alias("digest"))


@query("SELECT page_id, regexp_extract(html, '<html[^>]*\\slang=\"([^\"]*)\"', 1) AS lang, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def html_lang(spark: SparkSession, sf: str) -> DataFrame:
    """An attribute and an element of each page."""
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", r'<html[^>]*\slang="([^"]*)"', 1).alias("lang"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("""WITH v AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN upper(lang) WHEN 1 THEN lang || '-XX' WHEN 2 THEN CASE lang WHEN 'en' THEN 'english' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'французский' ELSE 'esp' END WHEN 3 THEN '???' ELSE 'quux' END AS db_lang, lang AS fb2_lang FROM documents)
SELECT doc_id, CASE WHEN db_lang = 'quux' THEN 'quux' ELSE fb2_lang END AS language FROM v""")
def language_canon(spark: SparkSession, sf: str) -> DataFrame:
    """Noisy language values as base subtags; ignored ones give way to the book's own, unresolved ones do not."""
    n = F.col("doc_id") % 5
    named = F.when(F.col("lang") == "en", "english").when(F.col("lang") == "de", "German").when(F.col("lang") == "fr", "французский").otherwise("esp")
    noisy = F.when(n == 0, F.upper("lang")).when(n == 1, F.concat("lang", F.lit("-XX"))).when(n == 2, named).when(n == 3, "???").otherwise("quux")
    docs = table(spark, sf, "documents").select("doc_id", noisy.alias("db_lang"), F.col("lang").alias("fb2_lang"))
    return language.canonical_language(docs).select("doc_id", "language")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    """A field of a JSON text."""
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT event_id, coalesce(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '') AS time, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE 'about ' || event_id END AS day FROM events")
def rfc3339(spark: SparkSession, sf: str) -> DataFrame:
    """Times with their zone, and dates where a text starts with one."""
    time = vl.rfc3339(F.col("ts"))
    mixed = F.when(F.col("event_id") % 2 == 0, time).otherwise(F.concat(F.lit("about "), F.col("event_id").cast("string")))
    return table(spark, sf, "events").select("event_id", time.alias("time"), vl.date_only(mixed).alias("day"))


# --- series -----------------------------------------------------------------------------------

_SERIES_SQL = """db AS (SELECT o_custkey AS book_id, o_orderpriority AS name, (o_orderkey % 3)::BIGINT AS type, (o_orderkey % 5)::BIGINT AS level, o_orderkey::VARCHAR AS number FROM orders)"""


def _db_series(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("book_id"), F.struct(F.col("o_orderpriority").alias("name"), key.cast("string").alias("number"), (key % 3).cast("long").alias("type"), (key % 5).cast("long").alias("level")).alias("s"))
    return rows.groupBy("book_id").agg(F.collect_list("s").alias("series"))


@query(f"""WITH {_SERIES_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY type, level, name, number) AS n FROM db WHERE type IN (0, 1)), f AS (SELECT *, row_number() OVER (PARTITION BY book_id, lower(trim(name)) ORDER BY n) AS k FROM o)
SELECT book_id, string_agg(trim(name) || '#' || number, ';' ORDER BY n) AS series FROM f WHERE k = 1 GROUP BY book_id""")
def series_preference(spark: SparkSession, sf: str) -> DataFrame:
    """Each book's series of the known kinds in order, none twice whatever its case."""
    mode = series.SeriesMode.ALL
    none = F.array().cast(series.NONE)
    rows = _db_series(spark, sf).select("book_id", series.select_series(series.db_series(F.col("series"), mode), none, series.Preference.MERGE, series.Dedup.CASE_INSENSITIVE).alias("s"))
    return rows.where(F.size("s") > 0).select("book_id", F.array_join(F.transform("s", lambda x: F.concat(x["name"], F.lit("#"), x["number"])), ";").alias("series"))


@query("""SELECT c_custkey AS book_id, r_name || '/' || n_name || '/' || c_name AS path, c_name AS leaf FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def series_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested series as paths and as leaves."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = [F.col("r_name"), F.col("n_name"), F.col("c_name")]
    nodes = F.array(*[F.struct(F.array(*names[: i + 1]).alias("path"), names[i].alias("name"), F.lit("").alias("number"), F.lit(i == 2).alias("is_leaf")) for i in range(3)])
    flat = series.flatten_series(nodes, series.Flatten.PATH_LEAF)
    return rows.select(F.col("c_custkey").alias("book_id"), flat.alias("s")).select("book_id", F.get("s", F.lit(0))["name"].alias("path"), F.get("s", F.lit(1))["name"].alias("leaf"))


# --- claims, exports, validation --------------------------------------------------------------

def _records(spark: SparkSession, sf: str) -> DataFrame:
    """Joined records: every order an archive entry, two in three of them in the catalogue, with both sources' titles."""
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("archive-"), (key % 4).cast("string")).alias("archive"), F.floor(key / 4).cast("long").alias("entry_index"), F.concat(key.cast("string"), F.lit(".fb2")).alias("entry"),
        key.alias("book_id"), (key % 3 != 0).alias("db_present"), (key % 5 != 0).alias("fb2_present"), F.when(key % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("title"),
        F.concat(F.lit("Order "), key.cast("string")).alias("fb2_title"), F.lit("ru").alias("lang"), F.lit("en").alias("fb2_lang"), F.col("o_totalprice").cast("long").alias("file_size"),
        F.lit("fb2").alias("file_type"), F.lit("0").alias("deleted"), F.col("o_orderdate").alias("time"), F.lit(1).alias("uncompressed_size"), F.col("o_orderstatus").alias("md5"),
        (key % 7).alias("replaced_by"), F.array(F.struct(F.lit("a").alias("last_name"), F.lit("b").alias("first_name"), F.lit("").alias("middle_name"))).alias("authors"),
        F.array(F.struct(F.col("o_orderpriority").alias("name"), F.lit("7").alias("number"), F.lit(0).cast("long").alias("type"), F.lit(1).cast("long").alias("level")),
                F.struct(F.lit("Other").alias("name"), F.lit("").alias("number"), F.lit(1).cast("long").alias("type"), F.lit(1).cast("long").alias("level"))).alias("series"))


_RECORD_SQL = """rec AS (SELECT *, o_orderkey % 3 <> 0 AS db, o_orderkey % 5 <> 0 AS fb2, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS db_title,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'Order ' || o_orderkey ELSE '' END AS fb2_title FROM orders)"""


@query(f"""WITH {_RECORD_SQL} SELECT o_orderkey::VARCHAR AS book_id, db AS has_db, fb2 AS has_fb2, db_title, fb2_title, CASE WHEN db THEN 'ru' ELSE '' END AS db_language, CASE WHEN fb2 THEN 'en' ELSE '' END AS fb2_language,
    CASE WHEN db AND o_orderkey % 7 > 0 THEN (o_orderkey % 7)::VARCHAR ELSE '' END AS replaced_by, CASE WHEN db THEN trunc(o_totalprice)::BIGINT ELSE 1 END AS size,
    CASE WHEN db THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS time, CASE WHEN db THEN o_orderstatus ELSE '' END AS md5, db::INT + 0 AS checksums FROM rec WHERE o_orderkey > 0""")
def claims_view(spark: SparkSession, sf: str) -> DataFrame:
    """Records to claims and back to a flat view."""
    view = claims.flat_view(claims.dataset_rows(_records(spark, sf).where("book_id > 0")))
    return view.select("book_id", "has_db", "has_fb2", "db_title", "fb2_title", "db_language", "fb2_language", "replaced_by", "size", "time", "md5", F.size("artifact.checksums").alias("checksums"))


_SEP = "chr(4)"


@query(f"""WITH {_RECORD_SQL}, b AS (SELECT *, CASE WHEN db_title <> '' THEN db_title ELSE fb2_title END AS title FROM rec WHERE o_orderkey > 0), s AS (SELECT *, CASE WHEN db OR true THEN o_orderpriority END AS series FROM b WHERE title <> '')
SELECT 'archive-' || o_orderkey % 4 AS archive, o_orderkey // 4 AS index, 0 AS book_row, concat_ws({_SEP}, 'a,b,:', 'other:', title, series, '7', o_orderkey::VARCHAR, CASE WHEN db THEN trunc(o_totalprice)::BIGINT::VARCHAR ELSE '1' END, o_orderkey::VARCHAR,
    CASE WHEN db THEN '0' ELSE '' END, 'fb2', CASE WHEN db THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END, CASE WHEN db THEN 'ru' ELSE CASE WHEN fb2 THEN 'en' ELSE '' END END, '', '', '', 'lib') || {_SEP} || chr(13) || chr(10) AS line FROM s""")
def multi_series_export(spark: SparkSession, sf: str) -> DataFrame:
    """The layout with a row per series."""
    view = claims.flat_view(claims.dataset_rows(_records(spark, sf).where("book_id > 0").withColumn("deleted", F.when(F.col("db_present"), F.col("deleted")))))
    return exports.multi_series_export(view, exports.Options(source_library="lib"))


@query(f"""WITH {_RECORD_SQL}, b AS (SELECT *, CASE WHEN db_title <> '' THEN db_title ELSE fb2_title END AS title, 'archive-' || o_orderkey % 4 AS archive, o_orderkey // 4 AS index FROM rec WHERE o_orderkey > 0),
n AS (SELECT *, dense_rank() OVER (ORDER BY archive, index) AS input_record FROM b WHERE title <> ''), a AS (SELECT * FROM n WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
SELECT printf('%010d-%010d', ((o_orderkey - 1) // 1000) * 1000 + 1, ((o_orderkey - 1) // 1000 + 1) * 1000) || '.inp' AS member, archive, index, input_record, row_number() OVER (ORDER BY archive, index) AS accepted_row,
    dense_rank() OVER (ORDER BY archive, index) AS accepted_book, concat_ws(chr(4), 'a,b,:', 'other:', title, o_orderpriority, '2', o_orderkey::VARCHAR, CASE WHEN db THEN trunc(o_totalprice)::BIGINT::VARCHAR ELSE '1' END, o_orderkey::VARCHAR,
    CASE WHEN db THEN '0' ELSE '' END, 'fb2', CASE WHEN db THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END, (index + 1)::VARCHAR, archive, CASE WHEN db THEN 'ru' WHEN fb2 THEN 'en' ELSE '' END, '', '', '') || chr(4) || chr(13) || chr(10) AS line FROM a""")
def slice_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A user's filter and partition key, as SQL over a row's columns; a number of 2.5 in a series shows as 2."""
    tx.register_functions(spark)
    numbered = _records(spark, sf).where("book_id > 0").withColumn("series", F.transform("series", lambda s: s.withField("number", F.when(s["number"] == "7", "2.5").otherwise(s["number"]))))
    view = claims.flat_view(claims.dataset_rows(numbered))
    rows = exports.slice_export(view, "one_of(series_name, array('1-URGENT', '2-HIGH'))", "range_name(lib_id, 1000, 'other')")
    return rows.select("member", "archive", "index", "input_record", "accepted_row", "accepted_book", "line")


@query(f"""WITH {_RECORD_SQL}, r AS (SELECT *, 'archive-' || o_orderkey % 4 AS archive, o_orderkey // 4 AS index, CASE WHEN db_title <> '' THEN db_title ELSE fb2_title END AS title FROM rec WHERE o_orderkey % 11 <> 0 AND o_orderkey > 0),
s AS (SELECT 'archive-' || k AS archive, (SELECT max(o_orderkey) // 4 + 1 FROM orders) AS entries FROM range(4) AS x(k)),
p AS (SELECT archive, i AS index FROM s, range(s.entries) AS y(i) WHERE i NOT BETWEEN 5 AND 9)
SELECT p.archive, p.index, r.o_orderkey IS NULL OR NOT (db OR fb2) AS is_dummy, CASE WHEN r.o_orderkey IS NULL OR NOT (db OR fb2)
    THEN concat_ws({_SEP}, 'dummy:', 'other:', 'dummy record', '', '', '', '1', (p.index + 1)::VARCHAR, '1', 'EXT', '2000-01-01', 'en', '0', '')
    ELSE concat_ws({_SEP}, 'a,b,:', 'other:', title, o_orderpriority, '7', o_orderkey::VARCHAR, CASE WHEN db THEN trunc(o_totalprice)::BIGINT::VARCHAR ELSE '1' END, o_orderkey::VARCHAR, CASE WHEN db THEN '0' ELSE '' END, 'fb2',
        CASE WHEN db THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END, CASE WHEN db THEN 'ru' WHEN fb2 THEN 'en' ELSE '' END, '', '') END || {_SEP} || chr(13) || chr(10) AS line
FROM p LEFT JOIN r USING (archive, index)""")
def positional_export(spark: SparkSession, sf: str) -> DataFrame:
    """The layout with a line for every position that is not ignored, dummies included."""
    records = _records(spark, sf).where("book_id % 11 <> 0 and book_id > 0")
    names = spark.range(4).select(F.concat(F.lit("archive-"), F.col("id").cast("string")).alias("id"))
    archives = table(spark, sf, "orders").agg((F.floor(F.max("o_orderkey") / 4) + 1).cast("long").alias("entries")).select(F.explode(F.array(*[F.lit(f"archive-{i}") for i in range(4)])).alias("id"), "entries")
    ignored = names.select(F.col("id").alias("archive"), F.lit(5).cast("long").alias("start"), F.lit(9).cast("long").alias("end"))
    return exports.positional_export(claims.flat_view(claims.dataset_rows(records)), archives, ignored)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 48)")
def integrity_violations(spark: SparkSession, sf: str) -> DataFrame:
    """References to what is not declared."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_partkey").alias("p_partkey"))
    return validate.dangling(rows, table(spark, sf, "part").where("p_size < 48"), ["p_partkey"]).select("l_orderkey", "l_linenumber", F.col("p_partkey").alias("l_partkey"), "l_suppkey")


@query(f"""WITH {_RECORD_SQL} SELECT count(*) AS records, count(*) FILTER (db) AS db_records, count(*) FILTER (fb2) AS fb2_records, 0::BIGINT AS issues FROM rec""")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a dataset."""
    return inspection.dataset_summary(claims.dataset_rows(_records(spark, sf)))


@query("SELECT o_orderkey::VARCHAR AS book_id, 'archive-' || o_orderkey % 4 AS archive, o_orderkey // 4 AS index FROM orders WHERE o_orderkey = 77")
def lookup_point(spark: SparkSession, sf: str) -> DataFrame:
    """The first row of a book."""
    rows = claims.dataset_rows(_records(spark, sf))
    found = inspection.first_match(rows, inspection.has_book(77), ["locator.source", "locator.index"])
    return claims.flat_view(found).select("book_id", F.col("locator.source").alias("archive"), F.col("locator.index").alias("index"))


@query("""SELECT l_returnflag AS archive, count(*) AS "rows", count(*) FILTER (l_linestatus = 'O') AS open, count(*) FILTER (l_quantity > 25) AS large FROM lineitem GROUP BY l_returnflag""")
def export_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of a run, by archive."""
    return exports.export_counts(table(spark, sf, "lineitem").withColumn("archive", F.col("l_returnflag")), ["archive"], open=F.col("l_linestatus") == "O", large=F.col("l_quantity") > 25)


@query("""SELECT 0 AS ordinal, o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000 UNION ALL SELECT 1, o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 300000""")
def union_archives(spark: SparkSession, sf: str) -> DataFrame:
    """Archives' rows one after the other, by an ordinal."""
    orders = table(spark, sf, "orders").where("o_totalprice > 300000")
    parts = [orders.where(F.col("o_orderstatus") == s).select(F.lit(i).alias("ordinal"), F.col("o_orderkey").alias("id")) for i, s in enumerate("FO")]
    return parts[0].unionByName(parts[1])


@query("""WITH src AS (SELECT p_partkey AS id, p_size AS facts, p_retailprice AS modified FROM part), cache AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 10 = 0 THEN -1 ELSE p_size END AS facts, 1000 AS built FROM part WHERE p_partkey % 4 <> 0),
j AS (SELECT s.id, c.id IS NULL AS missing, coalesce(c.facts = s.facts, false) AS valid, coalesce(c.built > s.modified, false) AS fresh FROM src s LEFT JOIN cache c USING (id))
SELECT id, valid, fresh, missing, CASE WHEN missing THEN 'missing' WHEN NOT valid THEN 'mismatch' WHEN NOT fresh THEN 'stale' ELSE '' END AS reason, CASE WHEN missing THEN 'create' WHEN valid AND fresh THEN 'use' ELSE 'none' END AS decision FROM j""")
def manifest_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Which caches can be used, and which must be made."""
    part = table(spark, sf, "part")
    sources = part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("facts"), F.col("p_retailprice").alias("modified"))
    cache = part.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 10 == 0, -1).otherwise(F.col("p_size")).alias("facts"), F.lit(1000).alias("built"))
    return validate.manifest_decisions(sources, cache, "id", ["facts"]).select("id", "valid", "fresh", "missing", "reason", "decision")


# --- rollup -----------------------------------------------------------------------------------

@query("""SELECT user_id AS book_id, min(event_id) AS event_id FROM events WHERE user_id > 40 AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND event_id < 100) GROUP BY user_id""")
def rollup_new_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries beyond the finalised ids that the active archive does not have, once each."""
    events = table(spark, sf, "events").select(F.col("user_id").alias("book_id"), "event_id", "event_type")
    present = events.where("event_type = 'purchase' and event_id < 100")
    return rollup.new_entries(events, 40, present, order=["event_id"]).select("book_id", "event_id")


@query("""SELECT p_brand AS archive, min(p_partkey) AS begin, max(p_partkey) AS "end", count(*) AS entries FROM part WHERE p_partkey > 0 GROUP BY p_brand""")
def actual_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The ids that archives really hold."""
    return rollup.actual_ranges(table(spark, sf, "part").select(F.col("p_brand").alias("archive"), F.col("p_partkey").alias("book_id")))


@query("""WITH n AS (SELECT 'fb2-' || printf('%06d', o_orderkey) || '-' || printf('%06d', o_orderkey + o_custkey % 50) || '.zip' AS link, o_orderkey AS begin, o_orderkey + o_custkey % 50 AS "end" FROM orders) SELECT * FROM n WHERE "end" > 1200""")
def new_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Offered archives that end beyond what is here."""
    end = F.col("o_orderkey") + F.col("o_custkey") % 50
    names = table(spark, sf, "orders").select(F.format_string("fb2-%06d-%06d.zip", F.col("o_orderkey"), end).alias("link"))  # longer ids stay whole, which lpad would cut
    return rollup.new_ranges(names, r"fb2-(\d+)-(\d+)\.zip", 1200)


@query("""SELECT 'f.' || arg_max(p_partkey, {'a': p_size, 'b': p_partkey}) || '-' || max(p_size) || '.zip' AS name, arg_max(p_partkey, {'a': p_size, 'b': p_partkey})::BIGINT AS begin, max(p_size)::BIGINT AS "end" FROM part""")
def high_water(spark: SparkSession, sf: str) -> DataFrame:
    """The last archive that is here, by the end of its range."""
    names = table(spark, sf, "part").select(F.concat(F.lit("f."), F.col("p_partkey").cast("string"), F.lit("-"), F.col("p_size").cast("string"), F.lit(".zip")).alias("name"))
    return rollup.high_water(names, "name", r"f\.(\d+)-(\d+)\.zip")


@query("""SELECT DISTINCT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages""")
def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links of index pages."""
    return rollup.page_links(table(spark, sf, "pages"), "html", r'href="([^"]*)"')
