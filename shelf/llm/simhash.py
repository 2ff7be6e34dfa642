"""Near-duplicate documents by SimHash and multi-index hashing.

Fingerprints are 64 bits over word shingles. Two fingerprints within 3 bits agree up to 1 bit in at
least one 32-bit half, so each half is a table: every fingerprint looks up the Hamming ball of
radius 1 around its half, and the full distance of what it meets is verified. Links join distinct
fingerprints, never copies, and components are found without leaving the cluster.

Texts at a Jaccard similarity of 0.8 are some 10 bits of 64 apart, beyond any table of halves. For them
(`similar_documents`) the fingerprint is wider: as many segments as make it next to sure that two such
texts stand within a small ball in one of them, each segment a table of its own. A ball holds the changes
of a segment's least certain bits, those whose sums were nearest 0, for there nearly all differences
fall. What is met is verified by the distance of 64 more bits, and then by the whole sets of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.llm import jaccard
from shelf.llm.common import cut, map_rows, read_table
from shelf.llm.components import connected_components

SHINGLE, MAX_BITS = 3, 3
#: Wide fingerprints: sums that signs are taken of, least certain bits of a segment that its ball changes, and the most bits of the check that may differ.
SUMS, FLIPS, CHECK_BITS, SEED = 4096, 3, 20, 17
#: The planned share of links at the least similarity that no segment meets, and what hashing to sums may add to the cosine's angle.
MISSED, SLACK = 0.002, 0.01
#: A half that more fingerprints than this share is looked up by finer keys too.
HOT_HALF = 2048


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text: a bit is set if it is in over half the shingles' XXH64 (seed 42)."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII white space
    if not found:
        return 0
    if len(found) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), 42)]
    else:
        joined = b" ".join(found)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: len(found) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = np.array(hashes[at:at + 65_536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed long. A null or wordless text has fingerprint 0."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return map_rows(rows, ["doc_id"], {"fp": "long"}, lambda: lambda text: (signed(fingerprint(text, shingle)),))


def _half(fp: Column, which: int) -> Column:
    """A half of the fingerprint, with its number above it, as a non-negative long."""
    bits = F.shiftrightunsigned(fp, 32) if which == 0 else fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return bits.cast("long").bitwiseOR(F.lit(which << 32).cast("long"))


def _flips(fp: Column, which: int) -> Column:
    """The half's ball of radius 1, each pair of halves once: the half itself, and it with one more bit set."""
    key = _half(fp, which)
    more = [F.when(key.bitwiseAND(F.lit(1 << b)) == 0, key.bitwiseOR(F.lit(1 << b))) for b in range(32)]
    return F.array_compact(F.array(key, *more))


def _fine(fp: Column, which: int) -> Column:
    """Four keys of 8 bits of the other half: halves within 3 bits agree in at least one of the four."""
    shift = 0 if which == 0 else 32
    return F.array(*[F.shiftrightunsigned(fp, shift + 8 * j).bitwiseAND(F.lit(255)).cast("int") + F.lit(256 * j) for j in range(4)])


def near_pairs(prints: DataFrame, max_bits: int = MAX_BITS, hot: int = HOT_HALF) -> DataFrame:
    """(src, dst): all pairs of distinct fingerprints at most max_bits (up to 3) apart, src < dst.

    prints has one column fp without repeats. A half that over `hot` fingerprints share would make
    too many pairs to verify, so these keys are dealt by 8 more bits, which loses no link: the other
    halves differ in 3 bits at most, so one of their four bytes is equal.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two halves with balls of radius 1 find up to 3 differing bits")
    fp = F.col("fp")
    table = prints.select("fp", F.explode(F.array(_half(fp, 0), _half(fp, 1))).alias("key"))
    probes = prints.select(fp.alias("probe"), F.explode(F.concat(_flips(fp, 0), _flips(fp, 1))).alias("key"))
    crowded = cut(table.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"))
    met = probes.join(table, "key")
    if not crowded.isEmpty():
        by_key = lambda df, col: df.join(crowded, "key", "left_semi").withColumn(
            "fine", F.explode(F.when(F.col("key") < 1 << 32, _fine(F.col(col), 0)).otherwise(_fine(F.col(col), 1))))
        met = (probes.join(table.join(crowded, "key", "left_anti"), "key").select("probe", "fp")
               .union(by_key(probes, "probe").join(by_key(table, "fp"), ["key", "fine"]).select("probe", "fp")))
    near = (F.col("probe") != fp) & (F.bit_count(F.col("probe").bitwiseXOR(fp)) <= max_bits)
    return met.where(near).select(F.least("probe", "fp").alias("src"), F.greatest("probe", "fp").alias("dst")).distinct()


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): the group of near duplicates of every row, named by its smallest id.

    Null and wordless texts share fingerprint 0 and so a group. Rows with a null id are kept and
    grouped, but never name a group; a group of null ids only has a null name. Repeated rows are
    kept. Copies share a fingerprint and are linked once, through it. An empty table gives no rows.
    """
    rows = cut(fingerprints(df, id_col, text_col))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    groups = connected_components(near_pairs(distinct.select("fp"), max_bits))
    named = distinct.join(groups, distinct.fp == groups.node, "left").withColumn("root", F.coalesce("component", "fp"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    names = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


def _hadamard(n: int) -> np.ndarray:
    h = np.ones((1, 1), np.float32)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h


def wide_sums(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, SUMS): for each of SUMS bits the sum of +1 and -1 over a text's shingles.

    Bit j of a shingle is the parity of j AND the shingle's bucket, flipped by its sign; sums of all bits
    are a Hadamard transform of the signed counts of buckets, so their cost does not grow with the text.
    """
    side = int(math.sqrt(SUMS))
    counts = np.zeros((len(sets), SUMS), np.float32)
    for i, x in enumerate(sets):
        mixed = x * np.uint32(0x9E3779B1)
        signs = 1 - 2 * (mixed >> np.uint32(31)).astype(np.float32)
        counts[i] = np.bincount((x & np.uint32(SUMS - 1)).astype(np.int64), signs, SUMS)
    h = _hadamard(side)
    return (h @ counts.reshape(-1, side, side) @ h).reshape(len(sets), SUMS)


def segment_bits(n: int) -> int:
    """Bits of a segment for n fingerprints: about one foreign fingerprint per value."""
    return min(26, max(12, math.ceil(math.log2(max(n, 2)))))


@lru_cache(64)
def segments_needed(bits: int, least: float, missed: float = MISSED) -> int:
    """Segments of so many bits after which two texts of one size at the least similarity miss each other with this probability.

    Sums over two texts at a cosine c are normal with that correlation. They meet where all signs that differ are
    among the FLIPS least certain ones of either, as drawn pairs show.
    """
    cosine = 2 * least / (1 + least) - SLACK
    x, z = np.random.default_rng(SEED).standard_normal((2, 20_000, bits))
    y = cosine * x + math.sqrt(1 - cosine * cosine) * z
    differ = np.signbit(x) != np.signbit(y)
    inside = lambda v: (differ & (np.abs(v).argsort(1).argsort(1) < FLIPS)).sum(1) == differ.sum(1)
    met = float((inside(x) | inside(y)).mean())
    return min((SUMS - 65) // bits, math.ceil(math.log(missed) / math.log1p(-met)))


def _sketcher(bits: int, segments: int) -> Callable[[list[np.ndarray]], tuple[np.ndarray, np.ndarray]]:
    """A function of sets of shingles: the 64 check bits as longs, and per segment its number, bits and least certain places in one long."""
    order = 1 + np.random.default_rng(SEED).permutation(SUMS - 1)
    check, columns = order[:64], order[64:64 + bits * segments]
    powers, number = 1 << np.arange(bits, dtype=np.int64), np.arange(segments, dtype=np.int64) << 26

    def sketch(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sums = wide_sums(sets)
        checks = np.ascontiguousarray(np.packbits(sums[:, check] > 0, axis=1)).view(">i8").astype(np.int64)[:, 0]
        parts = sums[:, columns].reshape(len(sets), segments, bits)
        weak = np.argpartition(np.abs(parts), FLIPS - 1, axis=2)[:, :, :FLIPS].astype(np.int64)
        values = (parts > 0) @ powers + number
        for k in range(FLIPS):
            values = values << 5 | weak[:, :, k]
        return checks, values

    return sketch


def wide_fingerprints(texts: DataFrame, shingle: int, least: float, bits: int, segments: int) -> DataFrame:
    """(doc_id, name, check, segments, found) of rows of doc_id and text: found is the set of shingles, name its hash; sets too small to have a near one have no segments."""

    def make():
        sketch = _sketcher(bits, segments)

        def run(batch: list) -> list[tuple]:
            sets = [jaccard.shingles(t, shingle) for t in batch]
            names = [int(np.uint64(xxhash.xxh64_intdigest(x.tobytes(), SEED)).astype(np.int64)) for x in sets]
            searched = [i for i, x in enumerate(sets) if len(x) >= jaccard.least_size(least)]
            rows = [(name, 0, [], b"") for name in names]
            if searched:
                checks, values = sketch([sets[i] for i in searched])
                for i, c, v in zip(searched, checks.tolist(), values.tolist(), strict=True):
                    rows[i] = (names[i], c, v, sets[i].tobytes())
            return rows

        return run

    return map_rows(texts, ["doc_id"], {"name": "long", "check": "long", "segments": "array<long>", "found": "binary"}, make, 64)


def _segment(packed: Column) -> Column:
    return F.shiftright(packed, 5 * FLIPS)


def _ball(packed: Column) -> Column:
    """A segment's value under all changes of its least certain bits, itself first."""
    places = [F.shiftright(packed, 5 * k).bitwiseAND(F.lit(31)).cast("int") for k in range(FLIPS)]
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]
    values = [_segment(packed)]
    for mask in masks:
        values += [v.bitwiseXOR(mask) for v in values]
    return F.array(*values)


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = jaccard.SHINGLE, least: float = jaccard.SIMILARITY) -> DataFrame:
    """(doc_id, component_id): the group of every row with an id, linked by the Jaccard similarity of word shingles, named by its smallest id.

    Links are verified on whole sets, so none is false; two texts of one size at exactly the least
    similarity miss each other with a probability of about MISSED, more similar ones with far less. Texts
    with equal sets are one class and never compared. Null and wordless texts are one group. Repeated
    rows are kept; extra columns are ignored; an empty table gives no rows. Pairs within a group are never
    listed, only who meets anyone in which bucket.
    """
    texts = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bits = segment_bits(texts.select("doc_id").count())
    rows = cut(wide_fingerprints(texts, shingle, least, bits, segments_needed(bits, least)))
    classes = cut(rows.groupBy("name").agg(F.min("doc_id").alias("first_id"), F.first("check").alias("check"), F.first("segments").alias("segments"))
                  .withColumn("cls", F.monotonically_increasing_id()))
    entries = classes.select("cls", "check", F.explode("segments").alias("packed"))
    table = entries.select(F.col("cls").alias("met"), F.col("check").alias("met_check"), _segment(F.col("packed")).alias("key"))
    probes = entries.select("cls", "check", F.explode(_ball(F.col("packed"))).alias("key"))
    apart = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= CHECK_BITS
    apart = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= CHECK_BITS
    meets = (F.col("cls") != F.col("met")) & apart(F.col("check"), F.col("met_check"))
    # rows that meet any other, not the pairs: a group of n copies has n rows a bucket, and foreign rows of a bucket go
    probing = cut(probes.join(table, (probes.key == table.key) & meets, "left_semi"))
    entered = cut(table.join(probing, (probing.key == table.key) & meets, "left_semi").select("key", F.col("met").alias("cls"), F.col("met_check").alias("check")))
    wanted = probing.select("cls").union(entered.select("cls")).distinct().join(classes.select("cls", "name"), "cls")
    sets = cut(rows.select("name", "found").join(wanted, "name").groupBy("name").agg(F.first("cls").alias("cls"), F.first("found").alias("found")).select("cls", "found"))
    groups = jaccard.groups_of(probing, entered, sets, apart, least=least)
    named = classes.join(groups, classes.cls == groups.node, "left").select("name", "first_id", F.coalesce("component", "cls").alias("root"))
    names = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("name", "component_id")
    return rows.select("doc_id", "name").join(names, "name").select("doc_id", "component_id")


def deduplicate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = jaccard.SHINGLE, least: float = jaccard.SIMILARITY) -> DataFrame:
    """One row of each group of similar documents, with all its columns whatever their names: the group's smallest id stays.

    Of repeated rows with that id one stays. Rows without an id name no group and are kept as they are.
    """
    groups = similar_documents(df, id_col, text_col, shingle, least)
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias(id_col)).distinct()
    kept = df.where(F.col(id_col).isNotNull()).join(keep, id_col, "left_semi").dropDuplicates([id_col])
    return kept.union(df.where(F.col(id_col).isNull()))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
