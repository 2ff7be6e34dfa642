"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Every source's documents, in a seeded order, are one stream of words cut into blocks of equal
length. Blocks are seats: highest quotients target / (2 k + 1) give each source an integer quota for
every shard. A source then fills its seats from a seeded start in its stream, round and round, shard
after shard: every shard gets its quota of blocks, and documents are taken whole but for those at a
shard's or a round's ends.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelf.llm.common import cut, read_table, words

#: Words per block, output shards, most copies of a source, and the seed of orders and starts.
BLOCK, SHARDS, MOST, SEED = 32, 16, 3, 20_260
#: Hashed pieces in which the streams are summed up.
CHUNKS = 1024
#: Up to this many sources the quotas are broadcast.
SMALL_SOURCES = 10_000


def water_fill(sizes: np.ndarray, weights: np.ndarray, most: float = MOST) -> np.ndarray:
    """Targets in proportion to weights that add up to all sizes; none above `most` times its size, the excess reshared."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    target, open_, left = np.zeros(len(sizes)), np.ones(len(sizes), bool), sizes.sum()
    while open_.any() and left > 0:
        share = left * weights[open_] / weights[open_].sum()
        over = share > most * sizes[open_]
        at = np.flatnonzero(open_)
        if not over.any():
            target[at] = share
            break
        target[at[over]] = most * sizes[at[over]]
        open_[at[over]] = False
        left = sizes.sum() - target.sum()
    return target


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2 k + 1), at most caps each; ties go to the earlier index."""
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    seats = int(min(seats, caps[votes > 0].sum())) if len(votes) else 0
    if seats <= 0:
        return np.zeros(len(votes), np.int64)
    got = np.minimum(np.floor(votes / (votes.sum() / seats) + 0.5).astype(np.int64), caps)
    free = int(seats - got.sum())
    if free < 0:
        heap = [(v / (2 * g - 1), -i) for i, (v, g) in enumerate(zip(votes, got, strict=True)) if g > 0]
        heapq.heapify(heap)
        for _ in range(-free):
            i = -heapq.heappop(heap)[1]
            got[i] -= 1
            if got[i] > 0:
                heapq.heappush(heap, (votes[i] / (2 * got[i] - 1), -i))
    heap = [(-v / (2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, got, caps, strict=True)) if g < c and v > 0]
    heapq.heapify(heap)
    for _ in range(max(0, free)):
        i = heapq.heappop(heap)[1]
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def quotas(sizes: np.ndarray, weights: np.ndarray, block: int = BLOCK, shards: int = SHARDS, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Targets, and blocks per (source, shard). Adding seats never takes one away, so shards are runs of seats."""
    sizes = np.asarray(sizes, np.int64)
    target = water_fill(sizes, weights, most)
    caps, seats = most * -(-sizes // block), int(round(target.sum() / block))
    upto = [sainte_lague(target, round(seats * (h + 1) / shards), caps) for h in range(shards)]
    return target, np.diff(np.stack([np.zeros(len(sizes), np.int64), *upto], axis=1), axis=1)


def row_key(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> Column:
    """A hash of id and whole text, in which a null id or text differs from an empty one."""
    text = F.col(text_col)
    return F.xxhash64(F.lit(seed), F.col(id_col).isNull(), F.col(id_col).cast("string"), text.isNull(), text, F.crc32(F.coalesce(text, F.lit("")).cast("binary")))


def document_sizes(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, h): words of each whole text, and the seeded place in its source's stream."""
    data = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                     F.coalesce(F.regexp_count(data, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long").alias("size"),
                     row_key(df, id_col=id_col, text_col=text_col, seed=seed).alias("h"))


def source_plan(sizes: DataFrame, *, cycle: tuple[int, ...] = (1, 2, 3), block: int = BLOCK, shards: int = SHARDS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per source: its size, weight, target, its seats before each shard and in all (`seats`), and its first block.

    The table has a row per source; one task apportions it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches), ignore_index=True)
        if not len(pdf):
            return
        pdf["key"] = [(s is None, (s or "").encode()) for s in pdf["of"]]  # UTF-8 sorts as code points do
        pdf = pdf.sort_values("key", ignore_index=True)
        size = pdf["source_size"].to_numpy(np.int64)
        weight = np.array([cycle[i % len(cycle)] for i in range(len(pdf))])
        target, quota = quotas(size, weight, block, shards, most)
        n = np.maximum(-(-size // block), 1)
        seats = np.concatenate([np.zeros((len(pdf), 1), np.int64), quota.cumsum(1)], axis=1)
        start = np.array([zlib.crc32(f"{seed}:{s}".encode()) % k for s, k in zip(pdf["of"], n, strict=True)], dtype=np.int64)
        yield pd.DataFrame({"of": pdf["of"], "source_size": size, "weight": weight, "target": target, "seats": list(seats), "blocks": n, "first": start})

    totals = sizes.groupBy(F.col("source").alias("of")).agg(F.sum("size").alias("source_size"))
    return totals.coalesce(1).mapInPandas(run, "of string, source_size long, weight int, target double, seats array<long>, blocks long, first long")


def _runs(block: int) -> Column:
    """The (shard, from, to) of the words taken, counted from a document's first word, in the order of seats.

    A row has start and size (words in its source's stream), and its source's seats, blocks and first.
    Block b fills the seats (b - first) mod blocks, plus blocks, plus twice as many, and so on. A
    document's blocks are one run of offsets, or two where it holds the first block.
    """
    start, size, n = F.col("start"), F.col("size"), F.col("blocks")
    low, high = F.floor(start / F.lit(block)).cast("long"), F.ceil((start + size) / F.lit(block)).cast("long")
    offset = F.pmod(low - F.col("first"), n)
    part = lambda seat, to, at: F.struct(seat.alias("seat"), to.alias("to"), at.alias("at"))
    pieces = F.filter(F.array(part(offset, F.least(offset + high - low, n), low), part(F.lit(0).cast("long"), offset + high - low - n, F.col("first"))), lambda x: x["seat"] < x["to"])
    total = F.element_at("seats", -1)
    rounds = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(total / n).cast("long") - 1, F.lit(0).cast("long")))
    placed = F.flatten(F.transform(rounds, lambda r: F.transform(pieces, lambda x: part(x["seat"] + r * n, F.least(x["to"] + r * n, total), x["at"]))))

    def shards(x: Column) -> Column:
        def one(h: Column) -> Column:
            a, b = F.greatest(x["seat"], F.element_at("seats", h)), F.least(x["to"], F.element_at("seats", h + 1))
            word = lambda seat: (x["at"] + seat - x["seat"]) * block - start
            return F.struct((h - 1).alias("shard"), F.greatest(word(a), F.lit(0)).cast("long").alias("from"), F.least(word(b), size).cast("long").alias("to"))

        return F.transform(F.sequence(F.lit(1), F.size("seats") - 1), one)

    runs = F.filter(F.flatten(F.transform(F.filter(placed, lambda x: x["seat"] < x["to"]), shards)), lambda r: r["from"] < r["to"])
    return F.when(size > 0, runs).otherwise(F.array().cast("array<struct<shard:int,from:bigint,to:bigint>>"))


def mix(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cycle: tuple[int, ...] = (1, 2, 3),
        block: int = BLOCK, shards: int = SHARDS, most: int = MOST, seed: int = SEED, chunks: int = CHUNKS) -> DataFrame:
    """doc_id, source, h, size, source_size, target, taken, and runs: array of (shard, from, to), the words of the
    document that each shard takes (counted from 0), once per copy or part of one.

    A null text has no words; a null source is a source of its own, the last. Repeated rows are
    documents of their own. Sources without words get target 0. An empty table gives no rows. Extra
    columns are ignored. The order of a stream depends on seed, id and text only, so reruns agree; rows
    equal in both are alike. Streams are summed up in hashed pieces, so a source of any size is spread
    over tasks.
    """
    sizes = cut(document_sizes(df, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed)
                .withColumn("chunk", F.pmod(F.col("h"), F.lit(chunks)).cast("int")))
    plan = cut(source_plan(sizes, cycle=cycle, block=block, shards=shards, most=most, seed=seed))
    pieces = sizes.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(earlier, F.lit(0)).alias("offset"))
    inside = F.sum("size").over(Window.partitionBy("source", "chunk").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    placed = sizes.withColumn("inside", F.coalesce(inside, F.lit(0)))
    placed = placed.join(pieces, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    placed = placed.withColumn("start", F.col("offset") + F.col("inside")).drop("s", "c", "offset", "inside")
    small = F.broadcast(plan) if plan.count() <= SMALL_SOURCES else plan
    placed = placed.join(small, F.col("source").eqNullSafe(F.col("of"))).withColumn("runs", _runs(block))
    taken = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["to"] - r["from"])
    return placed.select("doc_id", "source", "h", "size", "source_size", "target", taken.alias("taken"), "runs")


def mixed_documents(df: DataFrame, *, shard_col: str | None = None, **options) -> DataFrame:
    """The documents of the mix, with the columns of df whatever their names: a row per run taken. A run of a
    whole document is its text, one of a part its words, space-joined. With shard_col, a last column has the shard.

    Documents of which nothing is taken go, among them those without words. Rows are matched by a hash
    of id and text, so repeated rows must be whole repeats. The texts are shuffled once, by that hash.
    """
    id_col, text_col, seed = options.get("id_col", "doc_id"), options.get("text_col", "text"), options.get("seed", SEED)
    taken = mix(df, **options).where("taken > 0").groupBy("h").agg(F.first("size").alias("size"), F.flatten(F.collect_list("runs")).alias("runs"))  # one each, but for repeated rows
    name = lambda c: "`" + c.replace("`", "``") + "`"
    row = F.struct(*[F.col(name(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])  # columns go by place
    keyed = df.select(row_key(df, id_col=id_col, text_col=text_col, seed=seed).alias("key"), row.alias("row")).dropDuplicates(["key"])
    joined = keyed.join(taken, F.col("key") == F.col("h")).select("row", "size", F.explode("runs").alias("run"))
    text = F.col("row")[f"c{df.columns.index(text_col)}"]
    part = F.when((F.col("run.from") == 0) & (F.col("run.to") == F.col("size")), text).otherwise(
        F.array_join(F.slice(words(text), F.col("run.from").cast("int") + 1, (F.col("run.to") - F.col("run.from")).cast("int")), " "))
    out = [(part if c == text_col else F.col("row")[f"c{i}"]).alias(c) for i, c in enumerate(df.columns)]
    return joined.select(*out, *([F.col("run.shard").alias(shard_col)] if shard_col else []))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' part in the mix of sources weighted 1, 2, 3, 1, ..., and the shards that take it: shard:from-to, by seat."""
    runs = F.array_join(F.transform("runs", lambda r: F.concat(r["shard"].cast("string"), F.lit(":"), r["from"].cast("string"), F.lit("-"), r["to"].cast("string"))), ",")
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", runs.alias("shard_runs"))
