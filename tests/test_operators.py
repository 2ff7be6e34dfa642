import random

import pytest
from pyspark.sql import functions as F

from shelf.operators import authors, facets, fingerprints, language, matching, ranges, rollup, series, validate


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture(scope="module")
def catalogue_a(spark):
    make = spark.createDataFrame
    return {
        "libbook": make([(1, 123, "T", "ru", "en", "fb2", 1972, "0", "k", "abc\0\0", 2), (2, 5, "U", "ru", "", "fb2", 0, "1", "", "", 0), (3, 5, "V", "ru", "", "pdf", 0, "1", "", "", 0)],
                        "BookId long, FileSize long, Title string, Lang string, SrcLang string, FileType string, Year long, Deleted string, keywords string, md5 string, ReplacedBy long"),
        "libavtor": make([(1, 11, 2), (1, 10, 1), (2, 20, 0)], "BookId long, AvtorId long, Pos long"),
        "libtranslator": make([(1, 10, 0)], "BookId long, TranslatorId long, Pos long"),
        "libavtorname": make([(i, f"F{i}", "", f"L{i}", "") for i in (10, 11, 20)], "AvtorId long, FirstName string, MiddleName string, LastName string, NickName string"),
        "libavtoraliase": make([(10, 20)], "BadId long, GoodId long"),
        "libgenre": make([(1, 30), (1, 31)], "BookId long, GenreId long"),
        "libgenrelist": make([(30, "sf", "d", "m"), (31, "det", "d", "m")], "GenreId long, GenreCode string, GenreDesc string, GenreMeta string"),
        "libgenretranslate": make([("sf", "sci-fi")], "srcGenreCode string, trgGenreCode string"),
        "libseq": make([(1, 40, 1, 2, 1), (1, 41, 7, 1, 0)], "BookId long, SeqId long, SeqNumb long, Level long, Type long"),
        "libseqname": make([(40, "Pub"), (41, "Cycle")], "SeqId long, SeqName string"),
        "librate": make([(1, "1"), (1, "4"), (2, "5")], "BookId long, Rate string"),
        "libfilename": make([(1, "z.fb2"), (1, "a.fb2")], "BookId long, FileName string"),
        "libjoinedbooks": make([(50, 1, 2, 1), (51, 9, 2, None)], "Id long, BadId long, GoodId long, realId long"),
    }


def test_catalogue_of_the_first_schema(catalogue_a):
    found = {r.book_id: r for r in facets.Catalogue(catalogue_a).record().collect()}
    assert sorted(found) == [1, 2]
    one = found[1]
    assert one.md5 == "abc" and one.replaced_by == 2
    assert [(a.person_id, a.last_name) for a in one.authors] == [(20, "L20"), (11, "L11")]  # 10 is an alias of 20
    assert [t.person_id for t in one.translators] == [10]  # translators are not redirected
    assert sorted(g.code for g in one.genres) == ["det", "sci-fi"]
    assert [(s.type, s.name) for s in one.series] == [(0, "Cycle"), (1, "Pub")]
    assert (one.rating_average, one.rating_count, one.rating_min, one.rating_max) == (3.0, 2, 1, 4)
    assert [e.event_id for e in one.joined_books] == [50] and sorted(e.event_id for e in found[2].joined_books) == [50, 51]


def test_catalogue_of_the_second_schema(spark):
    make = spark.createDataFrame
    tables = {
        "libbook": make([(1, "fb2", "T")], "bid long, FileType string, Title string"),
        "libavtor": make([(1, 100, "a"), (1, 200, "t"), (1, 300, "i")], "bid long, aid long, role string"),
        "libavtors": make([(100, "F", "", "L", "", 0), (200, "F", "", "M", "", 100), (300, "F", "", "N", "", 0)], "aid long, FirstName string, MiddleName string, LastName string, NickName string, main long"),
        "libseq": make([(1, 5, "7.90")], "bid long, sid long, sn string"), "libseqs": make([(5, "Cycle", "a"), (6, "X", "z")], "sid long, seqname string, type string"),
    }
    one = facets.Catalogue(tables).record().first()
    assert [a.person_id for a in one.authors] == [100] and [t.person_id for t in one.translators] == [100] and [i.person_id for i in one.illustrators] == [300]
    assert [(s.number, s.type) for s in one.series] == [("7", 0)] and one.genres is None and one.rating_count is None
    for columns in (["a"], ["BookId", "bid"]):
        with pytest.raises(ValueError):
            facets.detect_dialect(columns)


def test_ambiguous_names_are_gone_for_good(spark):
    names = spark.createDataFrame([("a", 42), ("a", 42), ("b", 1), ("b", 2), ("b", 1), ("", 3), (None, 4)], "key string, book_id long")
    assert rows(matching.alias_index(names, "key", "book_id"), "key", "book_id") == [("a", 42)]


def test_match_evidence(spark):
    entries = spark.createDataFrame([(1, "7.fb2", 7), (2, "8.fb2", 8), (3, "Named.FB2", 0), (4, "none.fb2", 0)], "record_id long, entry string, entry_number long")
    aliases = spark.createDataFrame([("7", 42), ("8.fb2", 42), ("named", 5)], "key string, book_id long")
    books = spark.createDataFrame([(8,), (42,)], "book_id long")
    got = {r.record_id: (r.matched_id, r.method, r.issue) for r in matching.match_cascade(entries, books, aliases).collect()}
    assert got == {1: (42, "filename_alias", "catalog_id_conflict"), 2: (8, "numeric_entry_stem", "conflicting_match_evidence"), 3: (5, "filename_alias", None), 4: (None, "none", None)}


def test_author_suffixes(spark):
    people = spark.createDataFrame([("1", "A", "", "X", "nick"), ("2", "A", "", "X", ""), ("3", "A", "", "X", "same"), ("4", "A", "", "X", "same"), ("9", "B", "", "Y", "n")],
                                   "id string, first_name string, middle_name string, last_name string, nick_name string")
    got = dict(rows(authors.author_suffixes(authors.collision_groups(people)), "id", "suffix"))
    assert got == {"1": "[nick]", "2": "[#2]", "3": "[#3]", "4": "[#4]"}


@pytest.mark.parametrize("value,want,method", [
    ("RU", "ru", "valid_tag"), ("en-US", "en", "valid_tag"), ("sr_Latn", "sr", "valid_tag"), ("ua", "uk", "alias"), ("russian", "ru", "english_display_name"), ("русский", "ru", "russian_display_name"),
    ("български", "bg", "bulgarian_display_name"), ("engl", "en", "english_display_name_prefix"), ("ru, en", "ru", "split_valid_tag"), ("??", "", "ignored"), ("gibberish", "gibberish", "unresolved"), ("en\\n", "en", "split_valid_tag"),
    ("Человеческое, слишком человеческое", "ru", "alias")])
def test_language_rules(value, want, method):
    got = language.LanguageRules().resolve(value)
    assert (got.value, got.method) == (want, method)


def test_language_context_rule():
    rules = language.LanguageRules()
    assert rules.resolve("ba", is_source=True, sources=("balkar",)).value == "krc" and rules.resolve("ba", is_source=True, sources=("ru",)).value == "ba"


def test_unresolved_values_block_the_book_file(spark):
    frame = spark.createDataFrame([(1, "quux", "ru"), (2, "??", "RU"), (3, None, "en-GB"), (4, "", "")], "id long, db_lang string, fb2_lang string")
    assert rows(language.canonical_language(frame), "id", "language") == [(1, "quux"), (2, "ru"), (3, "en"), (4, "")]


def series_of(spark, make):
    frame = spark.sql("""select array(named_struct('name','P','number','10','type',1L,'level',101L), named_struct('name','B','number','2','type',0L,'level',1L), named_struct('name','A','number','1','type',0L,'level',1L), named_struct('name','N','number','','type',null,'level',0L)) as db,
        array(named_struct('path',array('U'),'name','U','number','','is_leaf',false), named_struct('path',array('U','Cycle'),'name','Cycle','number','7','is_leaf',true), named_struct('path',array('',  'x'),'name','x','number','','is_leaf',true)) as fb2""")
    return [(s["name"], s["number"]) for s in frame.select(make(F.col("db"), F.col("fb2"))).first()[0]]


def test_series_modes(spark):
    m = series.SeriesMode
    assert series_of(spark, lambda d, f: series.db_series(d, m.AUTHOR)) == [("A", "1"), ("B", "2")]
    assert series_of(spark, lambda d, f: series.db_series(d, m.PUBLISHER)) == [("P", "10")]
    assert series_of(spark, lambda d, f: series.db_series(d, m.PUBLISHER, by_type=False)) == [("P", "10"), ("A", "1"), ("B", "2")]
    assert series_of(spark, lambda d, f: series.db_series(d, m.IGNORE)) == []
    t = series.Flatten
    assert series_of(spark, lambda d, f: series.flatten_series(f, t.ALL)) == [("U", ""), ("Cycle", "7")]
    assert series_of(spark, lambda d, f: series.flatten_series(f, t.LEAF)) == [("Cycle", "7")]
    assert series_of(spark, lambda d, f: series.flatten_series(f, t.PATH, " > ")) == [("U > Cycle", "7")]
    assert series_of(spark, lambda d, f: series.flatten_series(f, t.PATH_LEAF)) == [("U/Cycle", "7"), ("Cycle", "7")]
    p = series.Preference
    db, fb2 = (lambda d: series.db_series(d, m.AUTHOR)), (lambda f: series.flatten_series(f, t.LEAF))
    assert series_of(spark, lambda d, f: series.select_series(db(d), fb2(f), p.MERGE)) == [("A", "1"), ("B", "2"), ("Cycle", "7")]
    assert series_of(spark, lambda d, f: series.select_series(db(d), fb2(f), p.REPLACE)) == [("Cycle", "7")]
    assert series_of(spark, lambda d, f: series.select_series(db(d), fb2(f), p.COMPLEMENT)) == [("A", "1"), ("B", "2")]
    assert series.SeriesMode.parse(" Publisher ") is m.PUBLISHER and series.Flatten.parse("") is t.ALL
    with pytest.raises(ValueError):
        series.Preference.parse("both")


def test_gaps_runs_and_bins(spark):
    sizes = spark.createDataFrame([("a", 6), ("b", 2)], "archive string, entries long")
    present = spark.createDataFrame([("a", 1), ("a", 4), ("a", 4)], "archive string, position long")
    ignored = spark.createDataFrame([("a", 2, 2), ("b", 0, 5)], "archive string, start long, end long")
    assert rows(ranges.missing_positions(sizes, present, "archive", "position", ignored), "archive", "position") == [("a", 0), ("a", 3), ("a", 5)]
    assert rows(ranges.index_ranges(present.union(present), ["archive"], "position"), "archive", "start", "end", "n") == [("a", 1, 1, 1), ("a", 4, 4, 1)]
    entries = spark.createDataFrame([(1, i, s) for i, s in enumerate([60, 60, 10, 95, 5, 1])], "g long, id long, size long")
    assert [r[1] for r in rows(ranges.greedy_bins(entries, ["g"], ["id"], "size", 100), "id", "bin")] == [0, 0, 1, 1, 2, 2]
    assert [tuple(r) for r in rollup.plan_archives(entries.select(F.col("id").alias("book_id"), "size"), 100, used=50).orderBy("bin").select("begin", "end", "bytes", "finalised").collect()] == [(0, 0, 60, True), (1, 3, 165, True), (4, 5, 6, False)]


def walk(sections, roots):
    """A recursive walk over one book's tree: the definition of compilation parts."""
    tree, stack = {}, []
    for pos, (depth, key, leaf) in enumerate(sections):
        stack = stack[:depth]
        if stack:
            tree.setdefault(stack[-1], []).append(pos)
        stack.append(pos)
    own, found, missing, parts = sections[0][1], {}, [], []

    def down(nodes):
        for n in nodes:
            _, key, leaf = sections[n]
            if key == own:
                down(tree.get(n, []))
            elif key in roots:
                parts.append((len(found), key))
                found.setdefault(key, 0)
            elif leaf:
                missing.append(key)
            else:
                down(tree.get(n, []))

    down(tree.get(0, []))
    return [(p, k, m, not missing) for p, k in parts for m in roots[k]] if len(found) > 1 else []


def test_compilations_match_a_recursive_walk(spark):
    rng = random.Random(6)
    frame, want = [], []
    roots = {k: [f"book-{k}"] + ([f"copy-{k}"] if k in "ab" else []) for k in "abcd"}
    for book in range(150):
        sections = [(0, rng.choice("aqr"), False)]
        for _ in range(rng.randrange(1, 14)):
            sections.append((rng.randrange(1, sections[-1][0] + 2), rng.choice("abcdqrst"), rng.random() < 0.5))
        frame += [(book, i, d, k, leaf) for i, (d, k, leaf) in enumerate(sections)]
        want += [(book, *w) for w in walk(sections, roots)]
    frame += [(900, 0, 0, "a", False), (900, 1, 2, "b", True), (901, 0, 0, "a", False), (901, 1, 0, "b", True)]  # a jump; two roots
    got = fingerprints.compilation_parts(spark.createDataFrame(frame, "book long, pos long, depth int, key string, leaf boolean"),
                                         spark.createDataFrame([(k, m) for k, ms in roots.items() for m in ms], "key string, match string"))
    assert len(want) > 100
    assert rows(got, "book", "part", "key", "match", "covered") == sorted(want, key=str)


def test_section_trees_match_a_stack(spark):
    rng = random.Random(7)
    frame, want = [], []
    for book in range(40):
        depths = [0]
        for _ in range(rng.randrange(0, 20)):
            depths.append(rng.randrange(1, depths[-1] + 2))
        frame += [(book, i, d) for i, d in enumerate(depths)]
        for i, d in enumerate(depths):
            parent = max((k for k in range(i) if depths[k] == d - 1), default=None)
            want.append((book, i, parent, next((k for k in range(i + 1, len(depths)) if depths[k] <= d), len(depths)) - 1))
    frame += [(900, 0, 0), (900, 1, 2), (901, 0, 0), (901, 1, 0)]
    got = fingerprints.section_tree(spark.createDataFrame(frame, "book long, pos long, depth int"))
    assert rows(got, "book", "pos", "parent", "subtree_end") == sorted(want, key=str)


def test_fingerprint_codec():
    import base64
    import hashlib

    key = lambda s: base64.urlsafe_b64encode(hashlib.md5(s.encode()).digest()).decode().rstrip("=")
    sections = [(0, key("r"), False), (1, key("a"), True), (200, key("b"), False)]
    assert fingerprints.decode_fingerprint(fingerprints.encode_fingerprint(sections)) == sections
    assert fingerprints.decode_fingerprint(fingerprints.encode_fingerprint(sections[:1])) == [(0, key("r"), True)]
    for bad in ([], [(1, key("r"), True)], [(0, key("r"), False), (0, key("a"), True)], [(0, "AAAA", False)]):
        with pytest.raises(ValueError):
            fingerprints.encode_fingerprint(bad)
    with pytest.raises(ValueError):
        fingerprints.decode_fingerprint(fingerprints.encode_fingerprint(sections)[:-4])


def test_digests_agree_between_engines(spark):
    text = "Слово слово другое длиннейшее x yy yy zzz Объём one two three four five six"
    frame = spark.createDataFrame([(1, text), (2, "")], "id long, t string")
    own = fingerprints.section_words(frame, ["id"], "t")
    words = {r.word: r.n for r in own.collect()}
    got = dict(rows(fingerprints.section_digests(own, frame, ["id"]), "id", "digest"))
    assert got == {1: fingerprints.digest_words(words), 2: fingerprints.digest_words({})}


def test_manifest_decisions(spark):
    sources = spark.createDataFrame([("a", 1, 10), ("b", 1, 10), ("c", 1, 10), ("d", None, 10)], "id string, size long, modified long")
    cache = spark.createDataFrame([("a", 1, 11), ("b", 1, 10), ("c", 2, 99), ("d", None, 12)], "id string, size long, built long")
    got = {r.id: (r.valid, r.fresh, r.decision) for r in validate.manifest_decisions(sources, cache, "id", ["size"]).collect()}
    assert got == {"a": (True, True, "use"), "b": (True, False, "none"), "c": (False, True, "none"), "d": (True, True, "use")}
    assert {r.decision for r in validate.manifest_decisions(sources, cache.where("false"), "id", ["size"]).collect()} == {"create"}
    assert validate.same_sources(sources, sources, ["id"], ["size"]).first()[0] is True
    assert validate.same_sources(sources, sources.where("id <> 'a'"), ["id"], ["size"]).first()[0] is False


def test_rollup_selection(spark):
    links = spark.createDataFrame([("fb2-1-100.zip",), ("fb2-101-150.zip",), ("x.zip",)], "link string")
    assert rows(rollup.new_ranges(links, r"fb2-(\d+)-(\d+)\.zip", 100), "link", "begin", "end") == [("fb2-101-150.zip", 101, 150)]
    assert tuple(rollup.high_water(links, "link", r"fb2-(\d+)-(\d+)\.zip").first()) == ("fb2-101-150.zip", 101, 150)
    entries = spark.createDataFrame([(50, "u1"), (101, "u1"), (101, "u2"), (102, "u1"), (0, "u1")], "book_id long, archive string")
    fresh = rollup.new_entries(entries, 100, spark.createDataFrame([(102,)], "book_id long"), order=["archive"])
    assert rows(fresh, "book_id", "archive") == [(101, "u1")]
    assert rows(rollup.actual_ranges(entries), "archive", "begin", "end", "entries") == [("u1", 50, 102, 3), ("u2", 101, 101, 1)]


def folded(sizes, target, first):
    """Bins by the rule itself, row after row: (first place, last place, entries, bytes) each."""
    bins, left = [], first
    for at, size in enumerate(sizes):
        if not bins or left <= 0:
            left = target if bins else first
            bins.append([at, at, 0, 0])
        bins[-1] = [bins[-1][0], at, bins[-1][2] + 1, bins[-1][3] + size]
        left -= size
    return [tuple(b) for b in bins]


@pytest.mark.parametrize("most, target, used", [(9, 40, 7), (9, 3000, 0), (1, 7, 0), (50, 20, 25), (9, 100_000, 90_000), (9, 1, 0)])
def test_one_stream_is_binned_without_one_task_for_all(spark, most, target, used):
    draw = random.Random(most * target)
    sizes = [draw.randint(0, most) for _ in range(2000)]
    entries = spark.createDataFrame(draw.sample(list(enumerate(sizes)), len(sizes)), "book_id long, size long")
    plan = rollup.plan_archives(entries, target, used=used)
    assert [tuple(r) for r in plan.orderBy("bin").select("begin", "end", "entries", "bytes").collect()] == folded(sizes, target, target - used)
    binned = ranges.stream_bins(entries, ["book_id"], "size", target, target - used)
    assert binned.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).max() < len(sizes) / 2
    assert "collect_list" not in plan._jdf.queryExecution().toString()


def test_streams_without_rows_or_sizes(spark):
    entries = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 5), (None, 5)], "book_id long, size int")
    assert ranges.stream_bins(entries.where("false"), ["book_id"], "size", 10).collect() == []
    binned = ranges.stream_bins(entries, ["book_id"], "size", 10)
    assert sorted(binned.collect(), key=lambda r: r.book_id or 0) == [(None, 5, 0), (1, None, 0), (2, 5, 0), (3, None, 1), (4, 5, 1)] and dict(binned.dtypes) == {"book_id": "bigint", "size": "int", "bin": "int"}
    with pytest.raises(ValueError):
        ranges.stream_bins(entries, ["book_id"], "size", 0)
