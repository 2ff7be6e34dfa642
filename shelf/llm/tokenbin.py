"""Token ids in length-delimited binary records with masked checksums, and an offset index.

A data file is a run of records, each: payload length (8 bytes, little-endian), masked checksum of the
length (4), payload, masked checksum of the payload (4), and a line feed. The payload is a flag byte
(0: no id), the document's id (8, signed), the number of tokens (8) and the tokens in 2 bytes each, or
4 where the vocabulary needs them. A masked checksum is the CRC-32 rotated right by 15 bits plus a
constant. The index is a table: file, offset, length, id, tokens and first token of every record.

Files are written by Spark's own text writer (bytes as they are, one record per row), so they commit
like any Spark output, in any store, and a lost executor leaves nothing half-written.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelf.llm.bpe import LATIN, byte_symbols, default_path, latin, sure
from shelf.llm.common import map_rows, new_folder, read_table

#: Bytes of text per file, aimed at; distinct pieces that a worker remembers.
FILE_BYTES, REMEMBERED = 24 << 20, 400_000
#: The most files: their edges are one constant of the plan.
MAX_FILES = 32_768
END_ID = 1
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<Qi")


def masked(data: bytes) -> int:
    """The masked CRC-32 of data, as a signed 32-bit number."""
    crc = zlib.crc32(data)
    value = (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF
    return value - (1 << 32) if value >> 31 else value


def frame(payload: bytes) -> bytes:
    """A record of the data file, but for its line feed."""
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<i", masked(size)), payload, struct.pack("<i", masked(payload))))


def unframe(data: bytes | memoryview, offset: int = 0) -> tuple[memoryview, int]:
    """The payload of the record at an offset, and the offset after it; raises ValueError where a checksum fails."""
    view = memoryview(data)
    if offset + 12 > len(view):
        raise ValueError(f"record at {offset}: cut short")
    size, check = _HEAD.unpack_from(view, offset)
    if masked(bytes(view[offset:offset + 8])) != check:
        raise ValueError(f"record at {offset}: length fails its checksum")
    end = offset + 12 + size
    if end + 5 > len(view):
        raise ValueError(f"record at {offset}: cut short")
    payload = view[offset + 12:end]
    if masked(payload) != struct.unpack_from("<i", view, end)[0] or view[end + 4] != 0x0A:
        raise ValueError(f"record at {offset}: payload fails its checksum")
    return payload, end + 5


def serialize(doc_id: int | None, tokens: bytes, width: int) -> bytes:
    """The payload of a document: its tokens are packed in `width` bytes each."""
    return struct.pack("<BqQ", doc_id is not None, doc_id or 0, len(tokens) // width) + tokens


def parse(payload: memoryview, width: int) -> tuple[int | None, np.ndarray]:
    """(doc_id, tokens) of a payload."""
    known, doc_id, n = struct.unpack_from("<BqQ", payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", count=n, offset=17)


class WordBpe:
    """A vocabulary with word ends, in the library's JSON format; distinct pieces are encoded once per worker."""

    _LATIN = re.compile(rf"'(?:[stmd]|re|ve|ll)|[a-z{LATIN}]+|[0-9]|[^\t-\r a-z0-9{LATIN}]+")
    _PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str, width: int | None = None, remembered: int = REMEMBERED):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = width or (2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4)
        self._symbols = byte_symbols()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self._special = re.compile("|".join(map(re.escape, special))) if special else None
        self._known: dict[str, bytes] = {}
        self._remembered = remembered

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _piece(self, piece: str) -> bytes:
        # a piece needs neither normalising nor splitting any more: the library's model merges its bytes
        packed = self.pack([t.id for t in self.library.model.tokenize("".join(map(self._symbols.__getitem__, piece.encode())))])
        if len(piece) <= 64:
            if len(self._known) >= self._remembered:
                self._known.clear()
            self._known[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a whole text as the library gives them without special tokens added; null counts as empty.

        The library itself encodes whole texts with special tokens in them, or with characters on which
        normalisers may differ.
        """
        if not text:
            return b""
        simple = latin(text)  # composed already, and lower case needs no context
        if not (simple or sure(text)) or (self._special and self._special.search(text)):
            return self.pack(self.library.encode(text, add_special_tokens=False).ids)
        known, piece = self._known, self._piece
        pieces = self._LATIN.findall(text.lower()) if simple else self._PIECES.findall(unicodedata.normalize("NFC", text).lower())
        return b"".join([known.get(p) or piece(p) for p in pieces])


@lru_cache(2)
def load_word_bpe(path: str) -> WordBpe:
    """One vocabulary per worker."""
    return WordBpe(path)


def _edges_below(bounds: Column, value: Column) -> Column:
    """How many of the ascending bounds are less than a value, by halving: bounds may be many, and rows more."""
    steps = F.sequence(F.lit(1), F.greatest(F.ceil(F.log2(F.size(bounds) + 1)).cast("int"), F.lit(1)))
    first = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))

    def halve(a: Column, _: Column) -> Column:
        middle = F.floor((a["low"] + a["high"]) / 2).cast("int")
        less = (a["low"] < a["high"]) & (F.get(bounds, middle) < value)
        return F.struct(F.when(less, middle + 1).otherwise(a["low"]).alias("low"), F.when(less | (a["low"] >= a["high"]), a["high"]).otherwise(middle).alias("high"))

    return F.aggregate(steps, first, halve, lambda a: a["low"])


def write_tokens(df: DataFrame, folder: str, path: str | None = None, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 file_bytes: int = FILE_BYTES) -> None:
    """Encode all texts and write folder/data (records in ascending id order over the files) and folder/index.

    Texts are encoded where they are read, and records of about two bytes a token go to their file, not
    texts: which file follows from the ids alone, cut at their percentiles. Null ids come first; rows with one
    id are in the order of a hash of their texts within a file, and an id with more rows than a file holds
    has several, so that no repeated row makes a file too large to read; a single record may be larger.
    Null and empty texts are the end id alone. An empty table writes files without records. Extra columns
    are ignored. Files hold about `file_bytes` of text each, or more where they would be over MAX_FILES.
    """
    path = path or default_path("word_bpe_49k.json")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    files = max(1, min(MAX_FILES, -(-total // file_bytes)))
    shares = [(i + 1) / files for i in range(files - 1)]
    edges = rows.agg(F.percentile_approx(F.coalesce("doc_id", F.lit(-(1 << 63))), shares, 50 * files)).first()[0] if shares else []  # an edge per file
    bounds = F.from_json(F.lit(json.dumps(edges or [])), "array<bigint>")  # one constant, however many
    below = _edges_below(bounds, F.coalesce("doc_id", F.lit(-(1 << 63))))
    equal = _edges_below(bounds, F.coalesce("doc_id", F.lit(-(1 << 63))) + F.lit(1)) - below
    dealt = rows.withColumn("file", (below + F.pmod(F.monotonically_increasing_id(), F.greatest(equal, F.lit(1)))).cast("int")) if edges else rows.withColumn("file", F.lit(0))

    def make():
        bpe = load_word_bpe(path)
        end = bpe.pack([end_id])
        return lambda doc_id, text: (zlib.crc32((text or "").encode("utf-8", "surrogatepass")), frame(serialize(doc_id, bpe.encode(text) + end, bpe.width)))

    records = map_rows(dealt, ["doc_id", "file"], {"hash": "long", "record": "binary"}, make, given=["doc_id", "text"])
    ordered = records.repartitionById(files, F.col("file")).sortWithinPartitions("doc_id", "hash")
    # the writer ends each record with its line feed, and passes the other bytes on as they are
    ordered.select(F.col("record").cast("string").alias("value")).write.text(f"{folder}/data", lineSep="\n")
    index = scan_files(spark_files(df.sparkSession, folder), load_width(path))
    index.select("file", "offset", "length", "doc_id", "n_tokens").write.parquet(f"{folder}/index")


def load_width(path: str) -> int:
    """Bytes per token in files that a vocabulary's tokens are written to."""
    return load_word_bpe(path).width


def spark_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, content): the data files by their number."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")
    return files.select(F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long").alias("file"), "content")


def scan_files(files: DataFrame, width: int) -> DataFrame:
    """file, offset, length, doc_id, before, n_tokens, ids_crc32 of every record, checksums verified; before counts tokens in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                data, at, before, rows = memoryview(content.as_buffer()), 0, 0, []
                while at < len(data):
                    payload, end = unframe(data, at)
                    doc_id, tokens = parse(payload, width)
                    rows.append((file, at, end - at, doc_id, before, len(tokens), zlib.crc32(tokens.astype("<u4").tobytes())))
                    at, before = end, before + len(tokens)
                names = ["file", "offset", "length", "doc_id", "before", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)

    return files.mapInArrow(run, "file long, offset long, length long, doc_id long, before long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every record, read back from the files; start counts the tokens before it in all of them.

    The totals of the files come from the index: one row per file, the bound of the broadcast.
    """
    records = scan_files(spark_files(spark, folder), load_width(path or default_path("word_bpe_49k.json")))
    totals = spark.read.parquet(f"{folder}/index").groupBy(F.col("file").alias("of")).agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("of", F.coalesce(before, F.lit(0)).alias("offset_tokens"))
    return records.join(F.broadcast(totals), F.col("file") == F.col("of")).select(
        "doc_id", (F.col("offset_tokens") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def read_record(content: bytes, offset: int, width: int) -> tuple[int | None, np.ndarray]:
    """(doc_id, tokens) of one record that the index names: for reads in any order."""
    return parse(unframe(content, offset)[0], width)


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written in ascending id order, and read back."""
    folder = new_folder(spark, "tokens")
    write_tokens(read_table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder)
