"""URL filters: a blocked Bloom filter in front of exact hash joins (native: DataFrame functions only).

What is listed - host and path prefixes of rules, and canonical URLs - is hashed into 512-bit blocks:
one block per key, one bit in each of its eight words. A URL's own keys are looked up there; only
possible hits reach the exact hash join, which removes the false positives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.llm.common import cut, read_table

WORDS = 8
#: Keys per block of 512 bits; about 1 in 10,000 foreign keys passes.
KEYS_PER_BLOCK = 24
#: Blocks that are embedded in the plan (64 bytes each), and blocks that are broadcast.
MAX_LITERAL_BLOCKS, MAX_BROADCAST_BLOCKS = 1024, 1 << 20


@dataclass(frozen=True)
class Rule:
    """allow or block for a host with its subdomains, where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


#: Labels of hosts whose pages the query's list names: advertising, gambling, pills, pornography, spam and trackers.
UNWANTED = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")

#: The rules of the query.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """What follows the first ://, up to /, ?, # or the end, A-Z lower-cased; empty without a ://."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without a ://."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host and path, with the query but without fragment, scheme, default port and utm_ parameters; null without a host."""
    query = F.regexp_extract(url, "(?s)^.*?://[^?#]*\\?([^#]*)", 1)
    query = F.array_join(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    host = F.regexp_replace(url_host(url), ":(80|443)$", "")
    return F.when(host != "", F.concat(host, F.when(url_path(url) == "", "/").otherwise(url_path(url)), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _bits(key: Column) -> list[Column]:
    """The bit of each word that a key sets: 6 bits of a hash per word."""
    digest = F.xxhash64(key, F.lit("bit"))
    at = [F.shiftrightunsigned(digest, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), a) for a in at]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of a frame with a column key; partial ORs meet in one row per block."""
    bits = _bits(F.col("key"))
    return (keys.where("key is not null").select(_block(F.col("key"), blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
            .groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]))


def _maybe(key: Column, words: list[Column]) -> Column:
    """Whether a key may be among those hashed into its block's words; false where there is no block."""
    hit = F.lit(True)
    for bit, word in zip(_bits(key), words, strict=True):
        hit = hit & (bit.bitwiseAND(word) != 0)
    return F.coalesce(hit, F.lit(False))


def _rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, verdict): one row per host and path; of two rules with the same, block wins."""
    known: dict[str, str] = {}
    for r in rules:
        known[r.key] = max(r.verdict, known.get(r.key, ""))
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("verdict")) for k, v in known.items()])))


def _rule_columns(df: DataFrame, rules: tuple[Rule, ...], host: Column, path: Column) -> tuple[DataFrame, Column, Column]:
    """df joined to the rules by each kind of key a URL can have; the longest wins, and of equally long ones the longer host."""
    blocks = max(1, -(-len(rules) // KEYS_PER_BLOCK))
    if blocks > MAX_LITERAL_BLOCKS:
        raise ValueError(f"at most {MAX_LITERAL_BLOCKS * KEYS_PER_BLOCK} rules; give more as listed URLs")
    exact = _rule_table(df.sparkSession, rules)
    filled = {r["block"]: [r[f"w{i}"] for i in range(WORDS)] for r in bloom_blocks(exact, blocks).collect()}  # at most `blocks` rows
    kinds = sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})
    labels = F.split(host, "\\.", -1)
    best = F.struct(F.lit(-1).alias("n"), F.lit(-1).alias("h"), F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for i, (n_labels, n_path) in enumerate(kinds):
        fits = (F.size(labels) >= n_labels) & (F.length(path) >= n_path) & (host != "")
        key = F.when(fits, F.concat(F.array_join(F.slice(labels, F.size(labels) - n_labels + 1, n_labels), "."), F.substring(path, 1, n_path)))
        at = _block(key, blocks)
        words = [F.element_at(F.array(*[F.lit(filled.get(b, [0] * WORDS)[w]) for b in range(blocks)]), at + 1) for w in range(WORDS)]
        df = df.withColumn(f"_key{i}", F.when(_maybe(key, words), key))
        listed = exact.select(F.col("key").alias(f"_rule{i}"), F.col("verdict").alias(f"_verdict{i}"))
        df = df.join(F.broadcast(listed), F.col(f"_key{i}") == F.col(f"_rule{i}"), "left")  # at most as many rows as rules
        n = F.coalesce(F.length(f"_rule{i}"), F.lit(-2))
        best = F.greatest(best, F.struct(n.alias("n"), (n - n_path).alias("h"), F.col(f"_rule{i}").alias("rule"), F.col(f"_verdict{i}").alias("verdict")))
    return df, best["rule"], best["verdict"]


def _listed(df: DataFrame, listed: DataFrame) -> DataFrame:
    """df with _listed: whether its canonical URL is in `listed` (a column url)."""
    keys = cut(listed.select(canonical_url(F.col("url")).alias("key")).where("key is not null").distinct())
    blocks = max(1, -(-keys.count() // KEYS_PER_BLOCK))
    filled = bloom_blocks(keys, blocks).withColumnRenamed("block", "_block")
    if blocks <= MAX_BROADCAST_BLOCKS:
        filled = F.broadcast(filled)
    probed = df.withColumn("_canonical", canonical_url(F.col("_url"))).withColumn("_at", _block(F.col("_canonical"), blocks))
    probed = probed.join(filled, F.col("_at") == F.col("_block"), "left").withColumn("_maybe", _maybe(F.col("_canonical"), [F.col(f"w{i}") for i in range(WORDS)]))
    probed = probed.drop("_at", "_block", *[f"w{i}" for i in range(WORDS)])
    # only possible hits are shuffled to the exact join
    hits = probed.where("_maybe").join(keys.withColumn("_listed", F.lit(True)), F.col("_canonical") == F.col("key"), "left").drop("key")
    rest = probed.where("not _maybe").withColumn("_listed", F.lit(None).cast("boolean"))
    return hits.unionByName(rest).withColumn("_listed", F.coalesce("_listed", F.lit(False))).drop("_canonical", "_maybe")


def judge_urls(df: DataFrame, rules: tuple[Rule, ...] = RULES, listed: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row.

    The longest fitting rule gives the verdict; without one, a listed canonical URL is blocked and
    any other allowed. Null URLs and those without :// have an empty host and path and are allowed.
    Repeated rows are judged alike; extra columns are ignored; an empty table gives no rows. Of two
    rules with one host and path, block wins; of two equally long ones, the one with the longer host.
    Listed URLs that are null or have no host list nothing, and repeated ones count once.
    """
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url"))
    rows = rows.withColumns({"host": url_host(F.col("_url")), "path": url_path(F.col("_url"))})
    rows = _listed(rows, listed) if listed is not None else rows.withColumn("_listed", F.lit(False))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    if rules:
        rows, rule, verdict = _rule_columns(rows, rules, F.col("host"), F.col("path"))
    return rows.select("page_id", "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("_listed"), "block").otherwise("allow")).alias("verdict"))


def unwanted_urls(pages: DataFrame, *, url_col: str = "url", unwanted: tuple[str, ...] = UNWANTED) -> DataFrame:
    """(url): the list of the query, all URLs of pages on hosts that have an unwanted label."""
    labels = F.split(url_host(F.col(url_col)), "\\.", -1)
    return pages.where(F.arrays_overlap(labels, F.array(*[F.lit(x) for x in unwanted]))).select(F.col(url_col).alias("url"))


def op3_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' URLs under the fixed rules and the list of unwanted URLs."""
    pages = read_table(spark, sf_dir, "pages")
    return judge_urls(pages, listed=unwanted_urls(pages))


#: The same in DuckDB: every rule against every host, the longest that fits; canonical URLs against the list.
ORACLE = f"""
WITH rules(verdict, host, path) AS (VALUES {', '.join(str((r.verdict, r.host, r.path)) for r in RULES)}),
urls AS (SELECT row_number() OVER () AS rid, page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
asked AS (SELECT *, array_to_string(list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_')), '&') AS query FROM urls),
canonical AS (SELECT *, CASE WHEN regexp_replace(host, ':(80|443)$', '') <> '' THEN regexp_replace(host, ':(80|443)$', '') || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS key FROM asked),
listed AS (SELECT DISTINCT key FROM canonical WHERE list_has_any(string_split(host, '.'), {list(UNWANTED)!r}) AND key IS NOT NULL),
best AS (SELECT rid, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM urls u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict FROM canonical LEFT JOIN best USING (rid) LEFT JOIN listed USING (key)
"""
