import pytest
from pyspark.sql import functions as F

from shelf.functions import text as t
from shelf.functions import values as v


def one(spark, make, **columns):
    """The value of an expression over one row of text columns."""
    frame = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} string" for c in columns))
    return frame.select(make(*[F.col(c) for c in columns])).first()[0]


@pytest.mark.parametrize("raw,want", [("a\r\nb", "a b"), ("a\rb", "a b"), ("a\nb", "ab"), ("a\x04b c", "a b c"), (None, None)])
def test_cleanse(spark, raw, want):
    assert one(spark, t.cleanse, x=raw) == want


@pytest.mark.parametrize("raw,want", [("  a   b ", "a b"), (" ,:a,b:c:, ", "a，b：c"), ("bad�name", ""), ("", ""), ("a  b", "a b")])
def test_cleanse_author(spark, raw, want):
    assert one(spark, t.cleanse_author, x=raw) == want


def test_cleanse_genre_keeps_commas(spark):
    assert one(spark, t.cleanse_genre, x=" :sf, x:y: ") == "sf, x：y"


@pytest.mark.parametrize("raw,want", [("abcdef", "abcd"), ("abc  f", "abc"), ("abcd", "abcd"), ("", "")])
def test_truncate(spark, raw, want):
    assert one(spark, lambda x: t.truncate_field(x, 5), x=raw) == want


def test_keywords(spark):
    assert one(spark, t.keywords, x="one, two;three/(four) [five]: ;") == "one:two:three:four:five:"
    assert one(spark, t.keywords, x=None) == ""


@pytest.mark.parametrize("raw,want", [("a/b", "a_b.inp"), (" ..a. ", "a.inp"), ("", "other.inp"), ("..", "other.inp"), ("a//\\\x01b", "a_b.inp")])
def test_split_key(spark, raw, want):
    assert one(spark, t.split_key, x=raw) == want


@pytest.mark.parametrize("raw,stem,ext,number", [("dir/12.fb2", "12", "fb2", 12), ("a.b.zip", "a.b", "zip", 0), ("plain", "plain", "", 0)])
def test_file_parts(spark, raw, stem, ext, number):
    assert one(spark, t.file_stem, x=raw) == stem and one(spark, t.file_ext, x=raw) == ext and one(spark, t.entry_id, x=raw) == number


def test_people_and_genres(spark):
    frame = spark.sql("select array(named_struct('last_name','L','first_name','F','middle_name',null,'suffix','[n]'), named_struct('last_name','','first_name','','middle_name','','suffix',null)) as p, array('sf', ' :x: ', '') as g")
    assert tuple(frame.select(t.people(F.col("p")), t.genre_codes(F.col("g"))).first()) == ("L [n],F,:", "sf:x:")
    empty = spark.sql("select cast(null as array<struct<last_name:string,first_name:string,middle_name:string,suffix:string>>) as p, cast(array() as array<string>) as g")
    assert tuple(empty.select(t.people(F.col("p")), t.genre_codes(F.col("g"))).first()) == (t.UNKNOWN_AUTHOR, t.OTHER_GENRE)


@pytest.mark.parametrize("value,want", [("1", "0000000001-0000001000"), ("1000", "0000000001-0000001000"), ("1001", "0000001001-0000002000"), ("0", "x"), ("-5", "x"), ("a", "x"), (None, "x")])
def test_range_names(spark, value, want):
    t.register_functions(spark)
    assert one(spark, lambda x: t.range_name(x, 1000, "x"), x=value) == want
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(F.expr("range_name(v, 1000, 'x')")).first()[0] == want
    with pytest.raises(ValueError):
        t.range_name(F.lit("1"), 0)


def test_user_functions(spark):
    t.register_functions(spark)
    assert tuple(spark.sql("select one_of('a', array('b', 'a')), one_of(null, array('a')), contains_value(array('x'), 'y')").first()) == (True, False, False)


def test_body_words(spark):
    assert one(spark, t.body_words, x="Ёжик, Объём-ВЫОН! a1b2 İΣ") == ["ежик", "обьем", "вьюн", "ab", "iσ"]


def test_escapes_and_deletion(spark):
    assert one(spark, t.xml_escape, x="<a & \"b\" 'c'>") == "&lt;a &amp; &#34;b&#34; &#39;c&#39;&gt;"
    assert [one(spark, t.is_deleted, x=x) for x in ("1", " YES ", "0", None, "deleted")] == [True, True, False, False, True]
    assert [one(spark, t.deletion_state, x=x) for x in ("0", "1", "maybe")] == ["active", "deleted", "unknown"]


@pytest.mark.parametrize("raw,want", [("7.90", 7), ("-2.7", -2), ("x", None), ("", None), (None, None)])
def test_series_number(spark, raw, want):
    assert one(spark, v.series_number, x=raw) == want


def test_ratings(spark):
    row = spark.sql("select v.* from (select 4.0D as a, 3L as n) v").select(v.rating_text(F.col("a"), F.col("n")), v.rating_text(F.lit(2.5), F.lit(0)), v.rating_whole(F.lit("3.9")), v.rating_whole(F.lit(""))).first()
    assert tuple(row) == ("4", "", "3", "")


@pytest.mark.parametrize("raw,want", [("2026-06-22T01:02:03Z", "2026-06-22"), ("2026-13-40T", "2026-13-40T"), ("about", "about"), ("", "")])
def test_date_only(spark, raw, want):
    assert one(spark, v.date_only, x=raw) == want


def test_dump_stamps(spark):
    assert tuple(one(spark, v.dump_stamp, x="..\n-- Dump completed on 2026-06-22  1:02:03\n")) == ("2026-06-22", "01:02:03")
    assert tuple(one(spark, v.dump_stamp, x="nothing")) == (None, None)
    assert v.output_path("a/b.inpx", "20260622") == "a/b_20260622.inpx" == v.output_path("a/b_20260622.inpx", "20260622")
    with pytest.raises(ValueError):
        v.output_path("a", "2026")


def test_language_rules_are_checked():
    from shelf.operators.language import LanguageRules

    LanguageRules()
    for bad in ({"aliases": {"x": "not a tag!"}}, {"aliases": {" ": "en"}}, {"aliases": {"Abc": "en", "abc": "de"}}, {"ignore": ("(",)}, {"locales": ("zz9",)}):
        with pytest.raises(ValueError):
            LanguageRules(**bad)
