"""Jaccard similarity of sets of word shingles, for pairs and groups that a search proposes.

Sets are distributed tables of sorted 32-bit hashes. Pairs are verified in rounds, so that a group of n
similar texts costs about n comparisons and not all its pairs: each text with the least that it may be
near to, then with the least of another group, and at last all that is still in different groups. Pairs
are never listed before that, only the buckets that the search has put texts into. Buckets of many texts
make no pairs at all: the texts that they join are a crowd, whose sets are all compared in tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelf.llm.common import cut, lean
from shelf.llm.components import connected_components

SHINGLE, SIMILARITY = 5, 0.8
#: Texts that one task compares with a hot one, and rounds of one comparison a text before all of the rest.
SHARE, ROUNDS = 512, 2
#: A bucket of more texts makes a crowd of them. Texts and bytes of sets in a block of a crowd; shingles that a tile multiplies at a time.
CROWD, BLOCK, BLOCK_BYTES, COLUMNS = 16, 512, 4 << 20, 4096


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct low halves of the XXH64 (seed 42) of a text's word shingles; a shorter text is one shingle, a wordless one has none."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint32)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(size, len(found))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], 42) for a, b in zip(starts[: len(found) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)], np.uint64).astype(np.uint32))


def least_size(least: float) -> int:
    """Smaller sets are never this similar to another set."""
    return max(1, int(round(least / (1 - least), 9))) if least < 1 else 1


def _near(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted sets are at least so similar."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return both >= least * (len(a) + len(b) - both)


def _set(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.uint32)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the distinct pairs (src, dst) whose sets (cls, found) are near.

    The set of every dst goes to that of its src once. Where many share one src, it is dealt to as many tasks as they need.
    """
    counts = pairs.groupBy("src").agg(F.ceil(F.count("*") / F.lit(SHARE)).cast("int").alias("parts"))
    centres = counts.select("src", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(sets, F.col("src") == F.col("cls")).select("src", "part", F.col("src").alias("dst"), "found")
    placed = pairs.join(counts, "src").select("src", F.pmod(F.xxhash64("dst"), F.col("parts")).cast("int").alias("part"), "dst")
    members = placed.join(sets, F.col("dst") == F.col("cls")).select("src", "part", "dst", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, centre = None, None
        for batch in batches:
            src, part, dst, hit = batch.column("src").to_pylist(), batch.column("part").to_pylist(), batch.column("dst").to_pylist(), []
            for i, found in enumerate(batch.column("found")):
                if src[i] == dst[i]:
                    held, centre = (src[i], part[i]), _set(found)
                elif held == (src[i], part[i]) and _near(centre, _set(found), least):
                    hit.append(i)
            yield batch.select(["src", "dst"]).take(pa.array(hit, pa.int64()))

    rows = centres.union(members).withColumn("other", F.col("src") != F.col("dst"))
    return rows.repartition("src", "part").sortWithinPartitions("src", "part", "other").drop("other").mapInArrow(lean(run), "src long, dst long")


def near_forest(left: list[np.ndarray], right: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Pairs (i, j) of near sets left[i] and right[j] that join all that such pairs join."""
    rows = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    _, column, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    shared = times > 1  # the others are in one set only
    place = np.cumsum(shared) - 1
    rows, column = rows[shared[column]], place[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    both = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        has = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        has[rows[a:b], column[a:b] - at] = 1
        both += has[:len(left)] @ has[len(left):].T
    sizes = np.array([len(x) for x in (*left, *right)], np.float64)
    near = both >= least * (sizes[:len(left), None] + sizes[None, len(left):] - both)
    found, open_left, open_right = [], np.ones(len(left), bool), np.ones(len(right), bool)
    for start in range(len(left)):
        todo = [start] if open_left[start] else []
        open_left[start] = False
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & open_right).tolist():
                open_right[j] = False
                found.append((i, j))
                more = np.flatnonzero(near[:, j] & open_left).tolist()
                open_left[more] = False
                found += [(k, j) for k in more]
                todo += more
    return found


def _crowd_links(crowds: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(src, dst): near pairs that join all that near pairs within each crowd (node, component) join.

    A crowd is dealt to blocks, and every two blocks, and each with itself, are compared in one tile; no pair is a row.
    """
    members = sets.join(crowds, F.col("cls") == F.col("node")).select(F.col("component").alias("crowd"), "cls", "found")
    blocks = F.greatest(F.ceil(F.count("*") / F.lit(BLOCK)), F.ceil(F.sum(F.octet_length("found")) / F.lit(BLOCK_BYTES))).cast("int")
    placed = (members.join(members.groupBy("crowd").agg(blocks.alias("blocks")), "crowd")
              .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    tiles = placed.select("crowd", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "cls", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, ([], [], [], [])  # classes and sets of the lower block, then of the higher one

        def flush() -> pa.RecordBatch:
            low, a, high, b = held if tile[1] != tile[2] else (*held[:2], *held[:2])
            found = [(low[i], high[j]) for i, j in near_forest(a, b, least) if low[i] != high[j]] if a and b else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["src", "dst"])

        for batch in batches:
            names, block, cls = list(zip(*[batch.column(c).to_pylist() for c in ("crowd", "low", "high")], strict=True)), batch.column("block").to_pylist(), batch.column("cls").to_pylist()
            for i, found in enumerate(batch.column("found")):
                if names[i] != tile:
                    if tile:
                        yield flush()
                    tile, held = names[i], ([], [], [], [])
                side = 2 * (block[i] != tile[1])
                held[side].append(cls[i])
                held[side + 1].append(_set(found))
        if tile:
            yield flush()

    return tiles.repartition("crowd", "low", "high").sortWithinPartitions("crowd", "low", "high").mapInArrow(lean(run), "src long, dst long")


def groups_of(probing: DataFrame, entered: DataFrame, sets: DataFrame, apart: Callable[[Column, Column], Column], *, least: float = SIMILARITY) -> DataFrame:
    """(node, component): the classes that links join, given what a search proposes.

    Both have (key, cls, check): who looks a bucket up, and who is in it. One of the first and one of the second
    may be near in a common bucket if apart(check, check) says so; sets has (cls, found) of all. Such a pair is compared
    unless links found before join its ends, so nothing is lost, and a group of similar texts costs few comparisons.
    Texts that buckets of over CROWD join are compared each with each in tiles first, so that only rows of smaller
    buckets, and of different crowds, are matched: at most CROWD a row.
    """
    session, kind = probing.sparkSession, "node long, component long"
    groups, links, tried = session.createDataFrame([], kind), session.createDataFrame([], "src long, dst long"), session.createDataFrame([], "src long, dst long")
    crowds = groups
    crowded = cut(entered.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key"))
    if not crowded.isEmpty():
        rows = probing.select("key", "cls").union(entered.select("key", "cls")).join(crowded, "key", "left_semi")
        first = rows.groupBy("key").agg(F.min("cls").alias("dst"))
        crowds = cut(connected_components(rows.join(first, "key").select(F.col("cls").alias("src"), "dst").distinct()))
        links = cut(_crowd_links(crowds, sets, least))
        groups = cut(connected_components(links))
        probing, entered = probing.join(crowded, "key", "left_anti"), entered.join(crowded, "key", "left_anti")

    def placed(rows: DataFrame) -> DataFrame:
        """Rows with their class's component and crowd."""
        named, crowd = groups.toDF("cls", "component"), crowds.toDF("cls", "crowd")
        return rows.join(named, "cls", "left").join(crowd, "cls", "left").select("key", "cls", "check", F.coalesce("component", "cls").alias("component"), F.coalesce("crowd", "cls").alias("crowd"))

    for turn in range(ROUNDS + 1):
        left, right = placed(probing), placed(entered)
        if turn:  # buckets that one group has to itself are done
            both = left.union(right).groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
            left, right = left.join(both, "key", "left_semi"), right.join(both, "key", "left_semi")
        if turn < ROUNDS:  # one of each group in a bucket stands for it, and at first one for all
            right = right.groupBy("key", *(["component"] if turn else [])).agg(F.min(F.struct("cls", "check", "component", "crowd")).alias("m")).select("key", "m.*")
        right = right.select(F.col("key").alias("of"), F.col("cls").alias("met"), F.col("check").alias("met_check"), F.col("component").alias("met_component"), F.col("crowd").alias("met_crowd"))
        near = (F.col("key") == F.col("of")) & (F.col("component") != F.col("met_component")) & (F.col("crowd") != F.col("met_crowd")) & apart(F.col("check"), F.col("met_check"))
        met = left.join(right, near)
        if turn < ROUNDS:
            met = met.groupBy("cls").agg(F.min("met").alias("met"))
        asked = met.select(F.least("cls", "met").alias("src"), F.greatest("cls", "met").alias("dst")).distinct()
        asked = cut(asked.join(tried, ["src", "dst"], "left_anti") if turn else asked)
        if asked.isEmpty() and turn < ROUNDS:
            continue
        found = cut(_verified(asked, sets, least))
        tried = tried.union(asked)
        if not found.isEmpty():
            links = links.union(found)
            groups = cut(connected_components(links))
    return groups
