"""Catalogue dumps: discovery, completion stamps, and rows of INSERT statements without a database server."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.functions.values import dump_stamp
from shelf.operators.facets import DIALECT_B, IMPORTED_B

TAIL = 4096
#: Fixed value: the dump whose rows may have a surrogate key before the declared columns.
ALIAS_DUMP = "libavtoraliase.sql"
_ESCAPES = {"0": "\0", "n": "\n", "r": "\r", "t": "\t", "b": "\b", "Z": "\x1a"}
_INSERT = re.compile(r"INSERT\s+(?:IGNORE\s+)?INTO\s+`?(\w+)`?\s*(?:\(([^)]*)\))?\s*VALUES\s*", re.I)
_CREATE = re.compile(r"CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?`?(\w+)`?\s*\((.*?)\)\s*(?:ENGINE|;|$)", re.I | re.S)


def dump_files(spark: SparkSession, folder: str, dialect: str | None = None) -> DataFrame:
    """(name, path, modificationTime, dump_date, dump_time) of the *.sql files of a folder, by name; with the second schema, only those it imports."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.sql").load(folder)
    tail = F.expr(f"cast(substring(content, greatest(1, octet_length(content) - {TAIL} + 1)) as string)")
    rows = files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path", "modificationTime", dump_stamp(tail).alias("_s"))
    rows = rows.select("name", "path", "modificationTime", F.col("_s.date").alias("dump_date"), F.col("_s.time").alias("dump_time"))
    if dialect == DIALECT_B:
        rows = rows.where(F.lower("name").isin(*IMPORTED_B))
    return rows.orderBy("name")


def dump_date(files: DataFrame, allow_mismatch: bool = False) -> str:
    """The one date of all dumps. Several are an error unless allowed, and then there is none."""
    dates = [r[0] for r in files.where("dump_date is not null").select("dump_date").distinct().limit(2).collect()]
    if len(dates) > 1 and not allow_mismatch:
        raise ValueError(f"dumps of several dates: {sorted(dates)}")
    return dates[0] if len(dates) == 1 else ""


def latest_change(files: DataFrame) -> DataFrame:
    """One row: the time of the last change of any dump; null without dumps."""
    return files.agg(F.max("modificationTime").alias("modified"))


def import_provenance(files: DataFrame, dialect: str, imported: str, allow_mismatch: bool = False) -> DataFrame:
    """One row on an import: the schema, when it was made, the dumps' common date, and each dump's name, date, time and size by name."""
    listed = F.sort_array(F.collect_list(F.struct("name", "dump_date", "dump_time", F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("modified"))))
    return files.agg(F.lit(dialect).alias("dialect"), F.lit(imported).alias("imported"), F.lit(dump_date(files, allow_mismatch)).alias("dump_date"), listed.alias("dumps"))


def provenance_sources(provenance: DataFrame) -> DataFrame:
    """A provenance's dumps as rows (name, dump_date, dump_time, modified): what a cache made from that import depends on."""
    return provenance.select(F.explode("dumps").alias("d")).select("d.*")


def declared_columns(text: str) -> list[str]:
    """The columns of a dump's CREATE TABLE, in order."""
    found = _CREATE.search(text)
    return re.findall(r"^\s*`(\w+)`\s", found.group(2), re.M) if found else []


def parse_tuples(text: str, at: int = 0) -> Iterator[list[str | None]]:
    """The values of `(..), (..);` from a position, with quotes and escapes resolved; NULL is None."""
    n = len(text)
    while at < n and text[at] != "(":
        at += 1
    while at < n and text[at] == "(":
        values: list[str | None] = []
        at += 1
        while True:
            while text[at] in " \t\r\n":
                at += 1
            if text[at] == "'":
                out, at = [], at + 1
                while True:
                    stop = at
                    while text[stop] not in "'\\":
                        stop += 1
                    out.append(text[at:stop])
                    if text[stop] == "\\":
                        out.append(_ESCAPES.get(text[stop + 1], text[stop + 1]))
                        at = stop + 2
                    elif text[stop + 1:stop + 2] == "'":
                        out.append("'")
                        at = stop + 2
                    else:
                        at = stop + 1
                        break
                values.append("".join(out))
            else:
                stop = at
                while text[stop] not in ",)":
                    stop += 1
                word = text[at:stop].strip()
                values.append(None if word.upper() == "NULL" else word)
                at = stop
            while text[at] in " \t\r\n":
                at += 1
            at += 1
            if text[at - 1] == ")":
                break
        yield values
        while at < n and text[at] in ", \t\r\n":
            at += 1


def read_dump(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A dump's rows as text columns.

    Lines are read in parallel; a statement is one line, as dump programs write it. Values go by the
    statement's own column list, else the table's declaration, wherever that stands. In the alias table a
    tuple with one value more than columns loses its first, a surrogate key; elsewhere another number of
    values than columns, or a tuple that is cut short, is an error. Other statements are ignored.
    """
    lines = spark.read.text(path)
    alias = path.rsplit("/", 1)[-1].lower() == ALIAS_DUMP
    if columns is None:
        # all of the file but its rows: some dozen lines, which hold the declaration
        columns = declared_columns("\n".join(r[0] for r in lines.where(~F.upper(F.ltrim("value")).startswith("INSERT")).collect()))
    names = list(columns)
    if not names:
        raise ValueError(f"{path} declares no table")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for line in pdf["value"]:
                found = _INSERT.match(line)
                if not found:
                    continue
                own = re.findall(r"\w+", found.group(2)) if found.group(2) else names
                rows = []
                try:
                    for values in parse_tuples(line, found.end()):
                        if alias and len(values) == len(own) + 1:
                            values = values[1:]
                        if len(values) != len(own):
                            raise ValueError(f"{len(values)} values for {len(own)} columns")
                        row = dict(zip(own, values, strict=True))
                        rows.append([row.get(c) for c in names])
                except IndexError:
                    raise ValueError(f"{path}: a statement is cut short: {line[:80]!r}") from None
                except ValueError as error:
                    raise ValueError(f"{path}: {error}: {line[:80]!r}") from None
                yield pd.DataFrame(rows, columns=names, dtype=object)

    return lines.where(F.upper(F.ltrim("value")).startswith("INSERT")).mapInPandas(run, ", ".join(f"`{c}` string" for c in names))


def read_catalogue(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables of a folder of dumps by name."""
    return {r["name"][:-4].lower(): read_dump(spark, r["path"]) for r in dump_files(spark, folder).select("name", "path").collect()}


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A table of a running database server; a partition column with bounds reads it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
