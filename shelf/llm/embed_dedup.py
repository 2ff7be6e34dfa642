"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to 64 signs of random projections and sorts all vectors by the
concatenated signs. Vectors that stand within a window of each other are compared exactly. The
number of passes follows the number of vectors. What share of its links a vector's windows must have
met follows from the prefixes it shares with the vectors at their ends; where the direction is so
dense that over MISSED of them may stand outside, the vector is crowded, and all crowded vectors
near enough to hold a link are compared tile by tile. The verified pairs, united across the passes, are
the links, and join into components. A component that no window can hold, or with crowded vectors in it,
is beyond the windows' bound: there the members are compared with each other tile by tile, which finds
all of its links however dense it is. Copies of a vector are one class throughout and never compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelf.llm.common import cut, read_table
from shelf.llm.components import connected_components

THRESHOLD = 0.95
#: The least passes, neighbours compared on each side, and the seed of the projections.
PASSES, WINDOW, SEED = 16, 32, 7
#: Vectors per block of a sorted pass, and per tile of a component.
BLOCK, TILE = 2048, 1024
#: The share of a vector's links at the threshold that its windows may miss: as passes are planned, and before it counts as crowded.
PLANNED, MISSED = 0.001, 0.01
#: Pivots that crowded vectors are dealt around.
PIVOTS = 256


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two that bring their greatest components near 1: squares neither overflow nor vanish, and no bit is lost."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def usable(vector: Column) -> Column:
    """Not null, with components that are neither null nor non-finite, and not all zero."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _directions(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _planes(dim: int, passes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * 64))


#: The normal distribution at the points of a grid.
GRID = np.linspace(0, 6, 3001)
BELOW = np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in GRID])


def _kept_signs(x: np.ndarray, planes: np.ndarray, threshold: float) -> np.ndarray:
    """For each of x and n, the logarithm of the probability that a vector at the threshold from it has its first n signs too.

    The vector's projection is threshold times that of x, plus a normal draw times the sine, so a
    projection of x near 0 makes its sign uncertain.
    """
    tangent = threshold / math.sqrt(max(1 - threshold**2, 1e-12))
    each = np.log(np.interp(np.abs(_directions(x) @ planes) * tangent, GRID, BELOW))
    return np.concatenate([np.zeros((len(x), 1)), np.cumsum(each, axis=1)], axis=1)


def enough_passes(n: int, threshold: float, window: int, least: int) -> int:
    """Passes after which n vectors in all directions have a link at the threshold missed with a probability of PLANNED."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    met = agree ** (max(0.0, math.log2(max(n, 1) / window)) + 1.5)
    return least if met >= 1 else max(least, math.ceil(math.log(PLANNED) / math.log1p(-met)))


def _shared_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of leading bits that signatures share."""
    x, n = (a ^ b).view(np.uint64).copy(), np.zeros(len(a), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        clear = x >> np.uint64(64 - step) == 0
        n[clear] += step
        x[clear] <<= np.uint64(step)
    return np.where(a == b, 64, n)


def _signatures(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """(pass, dim, sig, cls): signs of projections, as longs that sort like the sign bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = _planes(int(dim), passes, seed)
                x = _vectors(part.column("embedding"))
                signs = (_scaled(x) @ planes[dim] > 0).reshape(len(part), passes, 64)
                packed = np.packbits(signs, axis=2, bitorder="big").view(">u8")[:, :, 0].astype(np.uint64) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(passes, dtype=np.int32), len(part))), pa.array(np.full(len(part) * passes, dim, np.int32)),
                    pa.array(packed.view(np.int64).ravel()), pa.array(np.repeat(part.column("cls").to_numpy(), passes))], ["pass", "dim", "sig", "cls"])

    return classes.select("cls", "dim", "embedding").mapInArrow(run, "pass int, dim int, sig long, cls long")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []

    def split(done: bool) -> Iterator[pa.Table]:
        table = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        cols = [table.column(k).to_numpy() for k in keys]
        new = np.zeros(len(table), bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        ends = [*np.flatnonzero(new).tolist(), len(table)]
        at = 0
        for end in ends[: len(ends) if done else -1]:
            yield table.slice(at, end - at)
            at = end
        if at < len(table):
            held.extend(table.slice(at).combine_chunks().to_batches())

    waiting = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            waiting += batch.num_rows
            if waiting >= 4096:
                yield from split(False)
                waiting = 0
    if held:
        yield from split(True)


def _positions(signatures: DataFrame) -> DataFrame:
    """cls and sig with its pass and its position in the order of all passes, by a distributed sort and counts per partition."""
    ordered = signatures.repartitionByRange("pass", "dim", "sig", "cls").sortWithinPartitions("pass", "dim", "sig", "cls")
    ordered = cut(ordered.select("pass", "dim", "sig", "cls", F.spark_partition_id().alias("part"),
                                 F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return ordered.join(F.broadcast(offsets), "part").select("pass", "dim", "sig", "cls", (F.col("at") + F.col("offset")).alias("pos"))  # one row per partition


def _least(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that links i - j reach from it."""
    least = np.arange(n)
    while True:
        before = least.copy()
        np.minimum.at(least, i, least[j])
        np.minimum.at(least, j, least[i])
        least = least[least]
        if (least == before).all():
            return least


def neighbour_pairs(classes: DataFrame, *, threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(src, dst, missed): verified pairs that stand within `window` of each other in some pass; pairs may repeat.
    Where more than `window` vectors of a block are joined, a pair a vector joins them instead of all their pairs.

    classes has cls, dim and embedding. Blocks of `block` positions also get the next block's first
    `window` rows and the last block's last ones, so no pair is lost at an edge. Rows without dst
    have, for src in one pass, the logarithm of the probability that a link at the threshold is missed.
    """
    here = F.floor(F.col("pos") / F.lit(block)).cast("long")
    placed = _positions(_signatures(classes, passes, seed)).withColumn("home", here)
    placed = placed.withColumn("block", F.explode(F.array_compact(F.array(
        "home", F.when((F.col("pos") % block < window) & (F.col("home") > 0), F.col("home") - 1), F.when(F.col("pos") % block >= block - window, F.col("home") + 1)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for table in _groups(batches, ["block"]):
            for dim in np.unique(table.column("dim").to_numpy()):
                part = table.filter(pa.array(table.column("dim").to_numpy() == dim))
                x, cls, which = _scaled(_vectors(part.column("embedding"))), part.column("cls").to_numpy(), part.column("pass").to_numpy()
                own = part.column("home").to_numpy() == part.column("block").to_numpy()
                norm = np.sqrt(np.einsum("ij,ij->i", x, x))
                found = [np.zeros((0, 2), np.int64)]
                for off in range(1, min(window, len(x) - 1) + 1):
                    cos = np.einsum("ij,ij->i", x[:-off], x[off:]) / (norm[:-off] * norm[off:])
                    hit = np.flatnonzero((cos >= threshold) & own[:-off] & (which[:-off] == which[off:]))
                    found.append(np.stack([hit, hit + off], 1))
                i, j = np.concatenate(found).T
                root = _least(len(x), i, j)
                wide = np.bincount(root, minlength=len(x))[root] > window  # such a component is compared as a whole later: a pair a row joins it
                rows = np.flatnonzero(wide & (root != np.arange(len(x))))
                src, dst = np.concatenate([cls[i[~wide[i]]], cls[rows]]), np.concatenate([cls[j[~wide[i]]], cls[root[rows]]])
                if len(src):
                    yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst), pa.nulls(len(src), pa.float64())], ["src", "dst", "missed"])
                most = np.full(len(x), -1)  # bits shared with what stands at the window's ends; what shares more stands inside
                if len(x) > window:
                    sig = part.column("sig").to_numpy()
                    bits = np.where(which[:-window] == which[window:], _shared_bits(sig[:-window], sig[window:]), -1)
                    most[:-window] = bits
                    most[window:] = np.maximum(most[window:], bits)
                met = np.zeros(len(x))
                for k in np.unique(which):
                    if (dim, k) not in planes:
                        planes.clear()
                        planes[dim, k] = _planes(int(dim), passes, seed)[:, 64 * k:64 * k + 64].copy()
                    rows = np.flatnonzero(which == k)
                    met[rows] = _kept_signs(x[rows], planes[dim, k], threshold)[np.arange(len(rows)), np.minimum(most[rows] + 1, 64)]
                missed = np.log(np.maximum(-np.expm1(met[own]), 1e-300))
                yield pa.RecordBatch.from_arrays([pa.array(cls[own]), pa.nulls(len(missed), pa.int64()), pa.array(missed)], ["src", "dst", "missed"])

    joined = placed.join(classes.select("cls", "embedding"), "cls")
    return joined.repartition("block").sortWithinPartitions("block", "pos").mapInArrow(run, "src long, dst long, missed double")


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            yield int(dim), batch.filter(pa.array(dims == dim))


def crowded_pairs(crowded: DataFrame, *, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(src, dst): pairs that join all crowded classes (cls, dim, embedding) that links join; every link among them is looked at.

    Each vector lives in the cell of its nearest pivot and visits the later cells of its length where
    a link can be, by the triangle inequality of angles. A cell's own vectors are compared with each
    other and with its visitors, in tiles.
    """
    n = crowded.count()
    chosen: dict[int, list] = {}
    for r in crowded.orderBy(F.xxhash64("cls"), "cls").limit(min(PIVOTS, -(-n // tile))).select("dim", "embedding").collect():  # PIVOTS vectors at most
        chosen.setdefault(r.dim, []).append(r.embedding)
    pivots = {dim: _directions(np.array(v, np.float64)) for dim, v in chosen.items()}
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-6

    def angles(dim: int, part: pa.RecordBatch) -> np.ndarray:
        x = _directions(_vectors(part.column("embedding")))
        return np.arccos(np.clip(x @ pivots[dim].T, -1, 1)) if dim in pivots else np.zeros((len(x), 1))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in _by_dim(batches):
            far = angles(dim, part)
            home = far.argmin(1)
            yield pa.RecordBatch.from_arrays([part.column("dim"), pa.array(home.astype(np.int32)), pa.array(far[np.arange(len(far)), home])], ["dim", "cell", "far"])

    source = crowded.select("cls", "dim", "embedding")
    radii = {(r.dim, r.cell): r.far for r in source.mapInArrow(settle, "dim int, cell int, far double").groupBy("dim", "cell").agg(F.max("far").alias("far")).collect()}

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, part in _by_dim(batches):
            far = angles(dim, part)
            home = far.argmin(1)
            wide = np.array([radii.get((dim, j), -np.inf) for j in range(far.shape[1])])
            at, cell = np.nonzero((far <= wide + reach) & (np.arange(far.shape[1]) > home[:, None]) | (np.arange(far.shape[1]) == home[:, None]))
            yield pa.RecordBatch.from_arrays([part.column("cls").take(pa.array(at)), part.column("dim").take(pa.array(at)), pa.array(cell.astype(np.int32)), pa.array(cell == home[at])],
                                             ["cls", "dim", "cell", "own"])

    placed = cut(source.mapInArrow(visit, "cls long, dim int, cell int, own boolean"))
    tiles = lambda own: F.ceil(F.count(F.when(F.col("own") == own, 1)) / F.lit(tile)).cast("int")
    sizes = placed.groupBy("dim", "cell").agg(tiles(True).alias("owned"), tiles(False).alias("visited"))
    slot = F.xxhash64("cls", F.lit(1))
    dealt = placed.join(sizes, ["dim", "cell"]).withColumn(
        "mine", F.when(F.col("own"), F.pmod(slot, F.col("owned"))).otherwise(F.col("owned") + F.pmod(slot, F.greatest("visited", F.lit(1)))).cast("int"))
    last = F.when(F.col("own"), F.col("owned") + F.col("visited")).otherwise(F.col("owned")) - 1
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.select("dim", "cell", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "cls").join(crowded.select("cls", "embedding"), "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["dim", "cell", "a", "b"]):
            a, b, mine = table.column("a")[0].as_py(), table.column("b")[0].as_py(), table.column("mine").to_numpy()
            x, cls = _scaled(_vectors(table.column("embedding"))), table.column("cls").to_numpy()
            left, right = np.flatnonzero(mine == a), np.flatnonzero(mine == b)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            i, j = np.nonzero(x[left] @ x[right].T / (norm[left][:, None] * norm[right][None, :]) >= threshold)
            least = _least(len(x), left[i], right[j])  # so a dense tile gives a pair per row
            joined = least != np.arange(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(cls[joined]), pa.array(cls[least[joined]])], ["src", "dst"])

    keys = ["dim", "cell", "a", "b"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "src long, dst long")


def _tile_links(members: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(cls, links): for each class the rows of other classes of its component that it links with.

    members has component, n (its classes), cls, copies, dim and embedding. A component is dealt into hashed tiles of
    about `tile` classes, and every pair of tiles is one unit of work of bounded size.
    """
    dealt = members.withColumn("tiles", F.ceil(F.col("n") / F.lit(tile)).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("component", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "mine", "cls", "copies", "dim", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["component", "a", "b"]):
            a, b, mine = table.column("a")[0].as_py(), table.column("b")[0].as_py(), table.column("mine").to_numpy()
            x, cls, copies = _scaled(_vectors(table.column("embedding"))), table.column("cls").to_numpy(), table.column("copies").to_numpy()
            left, right = np.flatnonzero(mine == a), np.flatnonzero(mine == b)
            norm = np.sqrt(np.einsum("ij,ij->i", x, x))
            near = x[left] @ x[right].T / (norm[left][:, None] * norm[right][None, :]) >= threshold
            near &= cls[left][:, None] != cls[right][None, :]
            links = np.zeros(len(x), np.int64)
            links[left] += near @ copies[right]
            if a != b:
                links[right] += copies[left] @ near
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(links)], ["cls", "links"])

    keys = ["component", "a", "b"]
    counted = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "cls long, links long")
    return counted.groupBy("cls").agg(F.sum("links").alias("links"))


def near_vectors(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, passes: int = PASSES,
                 window: int = WINDOW, seed: int = SEED, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors that are null, zero, or hold null or non-finite components, and rows without an id, link
    with nothing (n_links 0, their own component, kept). Vectors of different lengths never link.
    Copies of a vector link with each other; repeated rows count as copies. An id must not stand for
    different vectors. An empty table gives no rows; extra columns are ignored.
    """
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    good = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    classes = cut(rows.where(good).groupBy("embedding").agg(F.min("vec_id").cast("long").alias("cls"), F.count("*").alias("copies"))
                  .withColumn("dim", F.size("embedding")))
    passes = enough_passes(classes.count(), threshold, window, passes)
    pairs = cut(neighbour_pairs(classes, threshold=threshold, passes=passes, window=window, seed=seed, block=block))
    crowded = pairs.where("dst is null").groupBy("src").agg(F.sum("missed").alias("missed")).where(F.col("missed") > math.log(MISSED)).select(F.col("src").alias("cls"))
    crowded = cut(crowded.join(classes, "cls").select("cls", "dim", "embedding"))
    edges = pairs.where("dst is not null").select("src", "dst")
    if not crowded.isEmpty():
        edges = edges.union(crowded_pairs(crowded, threshold=threshold, tile=tile))
    components = cut(connected_components(edges).select(F.col("node").alias("cls"), "component"))
    marked = components.join(crowded.select("cls", F.lit(True).alias("beyond")), "cls", "left")
    dense = marked.groupBy("component").agg(F.count("*").alias("n"), F.max("beyond").alias("beyond")).where((F.col("n") > window) | F.col("beyond")).select("component", "n")
    copies = classes.select(F.col("cls").alias("dst"), "copies")
    both = pairs.where("dst is not null").select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("p")).select("p.*").distinct()
    seen = both.join(copies, "dst").groupBy(F.col("src").alias("cls")).agg(F.sum("copies").alias("seen"))
    links = _tile_links(components.join(dense, "component").join(classes, "cls"), threshold, tile)
    found = cut(classes.select("cls", "copies").join(components, "cls", "left").join(seen, "cls", "left").join(links, "cls", "left")
                .select("cls", (F.col("copies") - 1 + F.coalesce("links", "seen", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("component_id")))
    copied = classes.where("copies > 1").select(F.col("embedding").alias("shared"), F.col("cls").alias("first"))
    named = rows.where(good).join(copied, F.col("embedding") == F.col("shared"), "left").select("vec_id", F.coalesce("first", F.col("vec_id").cast("long")).alias("cls"))
    linked = named.join(found, "cls").select("vec_id", "n_links", "component_id")
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and component of every vector."""
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


#: All pairs in DuckDB: what the passes must come to wherever they miss no component.
ORACLE = f"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM rows WHERE vec_id IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.rid, a.vec_id AS src, b.vec_id AS dst FROM good a JOIN good b ON a.rid <> b.rid AND len(a.e) = len(b.e)
    WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {THRESHOLD!r}),
reach AS (SELECT vec_id AS node, vec_id AS to_ FROM good UNION SELECT r.node, l.dst FROM reach r JOIN links l ON l.src = r.to_),
least AS (SELECT node, min(to_) AS component_id FROM reach GROUP BY node),
counted AS (SELECT rid, count(*) AS n FROM links GROUP BY rid)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id)::BIGINT AS component_id, vec_id IS NOT DISTINCT FROM coalesce(component_id, vec_id) AS kept
FROM rows LEFT JOIN counted USING (rid) LEFT JOIN least ON node = vec_id
"""
