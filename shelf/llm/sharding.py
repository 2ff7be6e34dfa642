"""Sharding by a hierarchical weighted hash tree (native: DataFrame functions only).

A row descends region, rack and shard. At each level every child draws -ln(u) / weight from a hash
of the level, the child and the key; the smallest draw wins, so a child gets rows in proportion to
its weight. A child's draw depends on nothing but itself: when weights change, rows move only into
the children whose weight grew, or out of those whose weight shrank, and subtrees without a change
keep their rows. Shards beyond the base tree are commissioned as regions of their own, so one more
shard takes rows only into itself (law "key").
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelf.llm.common import read_table

SHARDS = 24
#: The base tree: shards per rack, racks per region.
RACK, REGION = 4, 3
#: Pieces into which the numbering of slots cuts a shard.
CHUNKS = 1024


@dataclass(frozen=True)
class Leaf:
    """A shard and its place; a rack's or region's weight is the sum of its shards' weights."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def shard_tree(n: int = SHARDS, base: int = SHARDS) -> list[Leaf]:
    """n equal shards: the first `base` in full racks and regions, each later one a region of its own."""
    if n < 1:
        raise ValueError("at least one shard is needed")
    racks = -(-base // RACK)
    regions = -(-racks // REGION)
    return [Leaf(s // RACK // REGION, s // RACK, s) if s < base else
            Leaf(regions + s - base, racks + s - base, s) for s in range(n)]


def _children(tree: list[Leaf]) -> list[tuple[str, dict[int, dict[int, float]]]]:
    """By level: parent -> child -> weight."""
    levels: list[tuple[str, dict[int, dict[int, float]]]] = [("region", {}), ("rack", {}), ("shard", {})]
    for leaf in tree:
        for (_, nodes), parent, child in zip(levels, (0, leaf.region, leaf.rack), (leaf.region, leaf.rack, leaf.shard), strict=True):
            kids = nodes.setdefault(parent, {})
            kids[child] = kids.get(child, 0.0) + leaf.weight
    return levels


def _draw(level: str, child: int, weight: float, key: Column) -> Column:
    """The child's draw for a key: exponential with rate `weight`."""
    digest = F.md5(F.concat(F.lit(f"{level}:{child}:"), key))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return F.struct((-F.log(u) / F.lit(weight)).alias("draw"), F.lit(child).alias("child"))


def place(key: Column, tree: list[Leaf]) -> Column:
    """The shard of a string key."""
    if any(leaf.weight <= 0 for leaf in tree):
        raise ValueError("weights must be positive")

    def winner(level: str, kids: dict[int, float]) -> Column:
        if len(kids) == 1:
            return F.lit(next(iter(kids)))
        return F.array_min(F.array(*[_draw(level, c, w, key) for c, w in sorted(kids.items())]))["child"]

    levels = dict(_children(tree))

    def descend(level: str, below: list[str], parent: int) -> Column:
        kids = levels[level][parent]
        won = winner(level, kids)
        if not below:
            return won
        if len(kids) == 1:
            return descend(below[0], below[1:], next(iter(kids)))
        chosen = F.lit(None).cast("int")
        for child in sorted(kids, reverse=True):
            chosen = F.when(won == child, descend(below[0], below[1:], child)).otherwise(chosen)
        return chosen

    return descend("region", ["rack", "shard"], 0)


def shard_rows(df: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None, *, id_col: str = "doc_id",
               text_col: str = "text", chunks: int = CHUNKS) -> DataFrame:
    """Place every row, and number the rows of each shard from 0 without gaps.

    Returns id, size, text_crc32, law, shard, slot, grown_shard. The id alone decides the shard; a
    null id counts as the empty key, a null text as no bytes (size 8, crc32 0). Repeated rows share a
    shard and get slots of their own, in no fixed order among themselves. Extra columns are ignored;
    an empty table gives no rows. Slots are numbered in `chunks` hashed pieces per shard whose
    offsets come from one small table of counts (shards x chunks rows, the bound of the broadcast),
    so no shard is ever sorted by one task and the texts are never shuffled.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    placed = df.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        place(key, tree).alias("shard"), (place(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    placed = placed.withColumn("chunk", F.pmod(F.conv(F.substring(F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text_crc32").cast("string"))), 1, 4), 16, 10).cast("int"), F.lit(chunks)))
    counts = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    rows = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "chunk", F.coalesce(before, F.lit(0)).alias("offset"))
    return (placed.withColumn("rank", rows).join(F.broadcast(offsets), ["shard", "chunk"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards, and where each would be among 25."""
    return shard_rows(read_table(spark, sf_dir, "documents"), shard_tree(SHARDS), shard_tree(SHARDS + 1))


def _nodes(tree: list[Leaf], name: str) -> str:
    rows = [f"('{level}', {parent}, {child}, {weight!r})" for level, nodes in _children(tree)
            for parent, kids in nodes.items() for child, weight in kids.items()]
    return f"{name}(level, parent, child, weight) AS (VALUES {', '.join(rows)})"


def _descent(nodes: str, name: str) -> str:
    def step(level: str, before: str, parent: str) -> str:
        return f"""SELECT b.rid, b.k, arg_min(n.child, -ln((('0x' || substr(md5('{level}:' || n.child || ':' || b.k), 1, 13))::BIGINT + 0.5)
            / 4503599627370496.0) / n.weight) AS child FROM ({before}) b JOIN {nodes} n ON n.level = '{level}' AND n.parent = {parent} GROUP BY ALL"""

    return f"{name} AS ({step('shard', step('rack', step('region', 'SELECT rid, k FROM docs', '0'), 'b.child'), 'b.child')})".replace(
        "GROUP BY ALL", "GROUP BY b.rid, b.k")


#: The same in DuckDB: each level is a join with its children and an arg_min; CRC-32 folds over the bytes.
ORACLE = f"""
WITH crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id::VARCHAR, '') AS k,
        octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
            lambda h: ('0x' || h)::BIGINT)), lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1]))) AS text_crc32 FROM documents, crc),
{_nodes(shard_tree(SHARDS), 'tree')}, {_nodes(shard_tree(SHARDS + 1), 'grown')},
{_descent('tree', 'placed')}, {_descent('grown', 'placed_grown')}
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, p.child::INT AS shard,
    row_number() OVER (PARTITION BY p.child ORDER BY ('0x' || substr(md5(docs.k || ':' || text_crc32), 1, 4))::BIGINT % {CHUNKS}, doc_id, text_crc32, size) - 1 AS slot,
    g.child::INT AS grown_shard
FROM docs JOIN placed p USING (rid) JOIN placed_grown g USING (rid)
"""
