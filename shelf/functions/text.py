"""Text functions of the catalogue: Column in, Column out, all inside code generation or built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_SEP, LINE_END = "\x04", "\r\n"
#: What stands in for a book without authors, and for one without genres.
UNKNOWN_AUTHOR, OTHER_GENRE = "неизвестный,автор,:", "other:"
#: Punctuation that separates keywords.
KEYWORD_SEPARATORS = ",;/.()[]:"


def absent(value: Column) -> Column:
    """Null for the empty string: both mean that nothing is known."""
    return F.nullif(value, F.lit(""))


def present(value: Column) -> Column:
    """The empty string for null."""
    return F.coalesce(value, F.lit(""))


def cleanse(value: Column) -> Column:
    """One line: CR LF, CR, the field separator and no-break spaces become spaces, and a lone LF goes."""
    for old, new in (("\r\n", " "), ("\r", " "), ("\n", ""), (FIELD_SEP, " "), ("\u00a0", " ")):
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def _component(value: Column, trimmed: str) -> Column:
    plain = F.trim(F.regexp_replace(cleanse(value), r"[\s\p{Z}\x85]+", " "))
    return F.when(F.contains(plain, F.lit("\ufffd")), "").otherwise(F.btrim(plain, F.lit(trimmed)))


def cleanse_author(value: Column) -> Column:
    """A name's part: cleansed, white space collapsed, outer commas and colons cut, inner ones made full-width."""
    return F.translate(_component(value, " ,:"), ",:", "\uff0c\uff1a")


def cleanse_genre(value: Column) -> Column:
    """A genre code: as a name's part, but commas stay."""
    return F.translate(_component(value, " :"), ":", "\uff1a")


def truncate_field(value: Column, most: int, enabled: bool = True) -> Column:
    """Cleansed and, when enabled, at most `most` - 1 characters, without trailing white space if cut."""
    plain = cleanse(value)
    if not enabled:
        return plain
    return F.when(F.length(plain) > most - 1, F.regexp_replace(F.substring(plain, 1, most - 1), r"\s+$", "")).otherwise(plain)


def keywords(value: Column) -> Column:
    """Keywords, each with a colon after it."""
    parts = F.transform(F.split(present(value), r"[,;/.()\[\]:]", -1), lambda p: F.trim(cleanse(p)))
    return F.array_join(F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(p, F.lit(":"))), "")


def xml_escape(value: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("'", "&#39;")):
        value = F.replace(value, F.lit(old), F.lit(new))
    return value


def split_key(value: Column) -> Column:
    """A partition's member name: separators and control characters become one underscore, never empty, with .inp."""
    name = F.btrim(F.regexp_replace(F.trim(value), r"[/\\\x00-\x1f\x7f-\u009f]+", "_"), F.lit(". "))
    return F.concat(F.when(name.isin("", ".", ".."), "other").otherwise(name), F.lit(".inp"))


def file_key(value: Column) -> Column:
    """The key by which file names match."""
    return F.lower(F.trim(value))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def file_ext(path: Column) -> Column:
    """The extension without its dot; empty without one."""
    return F.regexp_extract(file_name(path), r"\.([^.]*)$", 1)


def file_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def entry_id(path: Column) -> Column:
    """The number that an entry's stem is; 0 if it is none."""
    return F.coalesce(file_stem(path).try_cast("bigint"), F.lit(0).cast("bigint"))


def media_type(ext: Column) -> Column:
    return F.when(F.lower(ext) == "fb2", "application/fb2+xml")


def is_deleted(value: Column) -> Column:
    return F.lower(F.trim(present(value))).isin("1", "true", "yes", "deleted")


def deletion_state(value: Column) -> Column:
    return F.when(value.isin("0", "false", "no"), "active").when(value.isin("1", "true", "yes"), "deleted").otherwise("unknown")


def join_fields(*fields: Column) -> Column:
    """Fields, each with a separator after it, and the line's end."""
    return F.concat(F.array_join(F.array(*[present(f) for f in fields]), FIELD_SEP), F.lit(FIELD_SEP + LINE_END))


def person_name(last: Column, first: Column, middle: Column, suffix: Column | None = None) -> Column:
    """Last,First,Middle: of one person; empty if all parts are."""
    names = [cleanse_author(present(p)) for p in (last, first, middle)]
    if suffix is not None:
        names[0] = F.when(present(suffix) == "", names[0]).otherwise(F.trim(F.concat(names[0], F.lit(" "), suffix)))
    return F.when(F.concat(*names) == "", "").otherwise(F.concat(names[0], F.lit(","), names[1], F.lit(","), names[2], F.lit(":")))


def limited_person(last: Column, first: Column, middle: Column, suffix: Column, most: tuple[int, int, int], enabled: bool = True) -> Column:
    """Last,First,Middle: with each part cut to its limit; what tells authors apart is never cut, the name before it is."""
    family, tail = cleanse_author(present(last)), cleanse_author(present(suffix))
    if enabled and most[0] > 0:
        room = most[0] - 2 - F.length(tail)
        cut = F.when(F.length(family) > room, F.regexp_replace(family.substr(F.lit(1), F.greatest(room, F.lit(0))), r"[ \t]+$", "")).otherwise(family)
        tailed = F.when(room <= 0, tail).otherwise(F.trim(F.concat(cut, F.lit(" "), tail)))
    else:
        tailed = F.trim(F.concat(family, F.lit(" "), tail))
    names = [F.when(tail == "", truncate_field(family, most[0], enabled)).otherwise(tailed), truncate_field(cleanse_author(present(first)), most[1], enabled),
             truncate_field(cleanse_author(present(middle)), most[2], enabled)]
    return F.when(F.concat(*names) == "", "").otherwise(F.concat(names[0], F.lit(","), names[1], F.lit(","), names[2], F.lit(":")))


def limited_people(array: Column, most: tuple[int, int, int], enabled: bool = True) -> Column:
    """All names of an array of persons, each cut to its limits; a fixed literal for none."""
    listed = F.array_join(F.transform(array, lambda p: limited_person(p["last_name"], p["first_name"], p["middle_name"], p["suffix"], most, enabled)), "")
    return F.when(present(listed) == "", UNKNOWN_AUTHOR).otherwise(listed)


def people(array: Column) -> Column:
    """All names of an array of persons (last_name, first_name, middle_name, suffix); a fixed literal for none."""
    listed = F.array_join(F.transform(array, lambda p: person_name(p["last_name"], p["first_name"], p["middle_name"], p["suffix"])), "")
    return F.when(present(listed) == "", UNKNOWN_AUTHOR).otherwise(listed)


def genre_codes(codes: Column) -> Column:
    """Codes with a colon after each; a fixed literal for none."""
    kept = F.filter(F.transform(codes, cleanse_genre), lambda c: c != "")
    return F.when(F.coalesce(F.size(kept), F.lit(0)) > 0, F.concat(F.array_join(kept, ":"), F.lit(":"))).otherwise(OTHER_GENRE)


def path_label(path: Column) -> Column:
    """A path as part of a file name: unsafe runs become one underscore."""
    return F.btrim(F.regexp_replace(path, r"[^\p{L}\p{N}._-]+", "_"), F.lit("._"))


def base64url(binary: Column) -> Column:
    """Base64 for file names and URLs, without padding or line ends."""
    return F.rtrim(F.translate(F.base64(binary), "+/\r\n", "-_"), F.lit("="))


def body_words(text: Column) -> Column:
    """The normalised words of a run of book text: lower case, look-alike letters unified, letters only."""
    lower = F.translate(F.lower(F.translate(text, "İΣ", "iσ")), "ёйъ", "еиь")
    tokens = F.split(lower, r"[\p{Zs}\p{Zl}\p{Zp}\p{Cc}\p{P}]", -1)
    return F.filter(F.transform(tokens, lambda t: F.regexp_replace(F.replace(t, F.lit("ыо"), F.lit("ью")), r"\P{L}", "")), lambda t: t != "")


#: The functions that user expressions may call, as SQL bodies: name -> (parameters, type, body).
SQL_FUNCTIONS = {
    "one_of": ("value STRING, options ARRAY<STRING>", "BOOLEAN", "coalesce(array_contains(options, value), false)"),
    "contains_value": ("items ARRAY<STRING>, value STRING", "BOOLEAN", "coalesce(array_contains(items, value), false)"),
    "range_name": ("value STRING, size BIGINT, fallback STRING", "STRING",
                   "CASE WHEN size <= 0 THEN raise_error('the size of a range must be positive') WHEN coalesce(try_cast(value AS BIGINT), 0) <= 0 THEN fallback "
                   "ELSE concat(lpad(cast(((cast(value AS BIGINT) - 1) div size) * size + 1 AS STRING), 10, '0'), '-', "
                   "lpad(cast(((cast(value AS BIGINT) - 1) div size + 1) * size AS STRING), 10, '0')) END"),
}


def register_functions(spark) -> None:
    """Make the functions of user expressions known to a session, as SQL functions that the optimiser inlines."""
    for name, (parameters, kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")


def range_name(value: Column, size: int, fallback: str = "other") -> Column:
    """The inclusive range of `size` numbers that holds a value, as zero-padded bounds."""
    if size <= 0:
        raise ValueError("the size of a range must be positive")
    number = value.try_cast("bigint")
    first = F.floor((number - 1) / F.lit(size)).cast("bigint") * size + 1
    pad = lambda c: F.lpad(c.cast("string"), 10, "0")
    return F.when(F.coalesce(number, F.lit(0)) <= 0, fallback).otherwise(F.concat(pad(first), F.lit("-"), pad(first + size - 1)))
