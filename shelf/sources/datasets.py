"""Datasets on disk: JSON Lines with a header first, in any supported compression, and Parquet caches."""

from __future__ import annotations

import gzip
import io
import json
import os
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelf.functions.values import dataset_id
from shelf.operators.inspection import coverage
from shelf.operators.validate import DATASET_SCHEMA, ORDERING_KEYS, RECORD_SCHEMA

SUFFIXES = (".jsonl", ".jsonl.gz", ".jsonl.zst", ".jsonl.zip")


@dataclass(frozen=True)
class Dataset:
    """A header and its rows."""

    header: dict
    rows: DataFrame


def _decompressed(name: str, content: bytes) -> Iterator[str]:
    """The lines of a zstd or zip file, read as they are decompressed."""
    if name.endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = z.namelist()
            if len(names) != 1:
                raise ValueError(f"a compressed dataset has one member, not {len(names)}")
            with z.open(names[0]) as stream:
                yield from io.TextIOWrapper(stream, "utf-8", newline="\n")
    else:
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)) as stream:
            yield from io.TextIOWrapper(stream, "utf-8", newline="\n")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value): the lines of a text file that may be compressed, in file order.

    Plain and gzip files go through Spark's text reader, zstd and zip ones through one task, which holds
    their compressed bytes and a block of lines at a time.
    """
    if path.endswith((".zst", ".zstd", ".zip")):
        def run(batches):
            import pandas as pd

            for pdf in batches:
                for name, content in zip(pdf["path"], pdf["content"], strict=True):
                    lines = enumerate(x.removesuffix("\n") for x in _decompressed(name, content))
                    while block := list(islice(lines, 10_000)):
                        yield pd.DataFrame(block, columns=["pos", "value"])

        return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "pos long, value string")
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), "value")


def read_dataset(spark: SparkSession, path: str, schema: str, check: bool = True) -> Dataset:
    """The header (first line) and the records after it, typed by a schema, with their position.

    With check, a missing header, or another number of records than it declares, is an error.
    """
    lines = read_lines(spark, path)
    first = lines.orderBy("pos").limit(1).collect()
    if not first:
        raise ValueError(f"{path} has no header")
    header = json.loads(first[0]["value"])
    records = lines.where(F.col("pos") != first[0]["pos"])
    if check:
        found = records.count()
        if found != header.get("records"):
            raise ValueError(f"{path} declares {header.get('records')} records and has {found}")
    rows = records.select("pos", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("pos", "r.*")
    return Dataset(header, rows)


def fb2_coverage(rows: DataFrame) -> str:
    """How much of the archives' books was read: absent, partial or complete."""
    of = lambda ok: F.count_if(F.exists("observations", lambda o: (o["id"] == "fb2") & ok(o["status"])))
    counts = rows.agg(of(lambda s: s == "present").alias("a"), of(lambda s: s.isNotNull()).alias("n"))
    return counts.select(coverage(F.col("a"), F.col("n"))).first()[0]


def dataset_header(rows: DataFrame, archives: DataFrame | None = None, *, library: str = "", created: str = "", dump_date: str = "", dumps: DataFrame | None = None,
                   collisions: DataFrame | None = None, read: str = "") -> dict:
    """The header of rows: an id of its own, counts, archives in order with their ignored and dummy ranges, the dumps, authors of one name, and how records are ordered."""
    listed = [r.asDict(recursive=True) for r in archives.orderBy("ordinal").collect()] if archives is not None else []  # one row per archive
    listed = [{k: v for k, v in a.items() if v is not None} for a in listed]
    mode = "archive_entry" if listed else "database_book"
    database = {"dump_date": dump_date} if dump_date else {}
    if dumps is not None:
        database["dumps"] = [r.asDict() for r in dumps.orderBy("name").collect()]  # one row per dump
    if collisions is not None:
        groups = collisions.groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("authors")).orderBy("key")
        if found := [{"key": r["key"], "authors": r["authors"]} for r in groups.collect()]:  # a row per name that several authors have
            database["ambiguous_authors"] = found
    made = rows.sparkSession.range(1).select(dataset_id()).first()[0]
    return {"schema": DATASET_SCHEMA, "id": made, "record_schema": RECORD_SCHEMA, "library": library, "created": created, "records": rows.count(), "generator": {"name": "shelf"}, "normalization": {"model": "claims"},
            "database": database or None, "archives": listed, "ordering": ordering_of(mode), "processing": {"fb2": read} if read else None}


def ordering_of(mode: str) -> dict:
    """How a dataset's records are ordered: by archive and entry, or by the catalogue's book."""
    return {"mode": mode, **ORDERING_KEYS[mode], "direction": "ascending"}


def _compressed(target: str, compression: str):
    if compression == "none":
        return open(target, "wb")
    if compression == "gz":
        return gzip.open(target, "wb")
    if compression == "zst":
        return zstandard.ZstdCompressor(level=9).stream_writer(open(target, "wb"), closefd=True)
    if compression == "zip":
        return zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED)
    raise ValueError(f"unknown compression {compression!r}")


def compacted(value: Column, kind: T.DataType, inside: bool = False) -> Column:
    """A value without what says nothing: empty texts, arrays, maps and structs are null, at any depth; an array's own members stay."""
    if isinstance(kind, T.StringType):
        return value if inside else F.nullif(value, F.lit(""))
    if isinstance(kind, T.ArrayType):
        kept = F.transform(value, lambda x: compacted(x, kind.elementType, inside=True)) if isinstance(kind.elementType, (T.StructType, T.ArrayType)) else value
        return kept if inside else F.when(F.size(value) > 0, kept)
    if isinstance(kind, T.MapType):
        return value if inside else F.when(F.size(value) > 0, value)
    if isinstance(kind, T.StructType):
        fields = [compacted(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        told = F.coalesce(*[F.when(f.isNotNull(), F.lit(True)) for f in fields])
        return F.when(value.isNotNull() if inside else told, F.struct(*fields))
    return value


def write_dataset(dataset: Dataset, path: str, order: list[str], compression: str = "zst", columns: list[str] | None = None) -> str:
    """One ordered file, published by a rename; returns its path. Rows stream through the driver one partition at a time, without what is empty in them.

    This is an export for other programs. Spark's own copies of datasets are Parquet (write_cache).
    """
    base = next((path[: -len(s)] for s in sorted(SUFFIXES, key=len, reverse=True) if path.endswith(s)), path)
    target = base + {"none": ".jsonl", "gz": ".jsonl.gz", "zst": ".jsonl.zst", "zip": ".jsonl.zip"}[compression]
    rows = dataset.rows.select(*(columns or [c for c in dataset.rows.columns if c != "pos"]), *[F.col(o) for o in order if o not in (columns or dataset.rows.columns)])
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    lines = rows.orderBy(*order).select(F.to_json(F.struct(*[compacted(F.col(c), kinds[c]).alias(c) for c in (columns or rows.columns)])).alias("value"))
    hidden = os.path.join(os.path.dirname(target) or ".", f".{os.path.basename(target)}.part")
    try:
        with _compressed(hidden, compression) as out:
            stream = out.open(os.path.basename(base) + ".jsonl", "w") if compression == "zip" else out
            stream.write((json.dumps({k: v for k, v in dataset.header.items() if v not in (None, [], "")}, ensure_ascii=False) + "\n").encode())
            for row in lines.toLocalIterator():
                stream.write((row["value"] + "\n").encode())
            if compression == "zip":
                stream.close()
        os.replace(hidden, target)
    finally:
        if os.path.exists(hidden):
            os.remove(hidden)
    return target


def find_dataset(path: str) -> str:
    """The dataset that a path or prefix names: itself, or the one file with a known suffix."""
    if path.endswith(SUFFIXES) and os.path.exists(path):
        return path
    found = [path + s for s in SUFFIXES if os.path.exists(path + s)]
    if len(found) != 1:
        raise FileNotFoundError(f"{path}: {len(found)} datasets of that name")
    return found[0]


def write_cache(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Materialise rows as Parquet; with partitions, only those present in df are replaced."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def keep_first(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by partial aggregation: repeated positions keep the first."""
    others = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_r")).select(*key, "_r.*")
