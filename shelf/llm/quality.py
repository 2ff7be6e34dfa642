"""Quality rules with risk-controlled thresholds (native: DataFrame functions only).

Every document gets counts over its whole text. Beyond two fixed base rules, each signal has a
cutoff per stratum (language), chosen on labelled documents: the strictest of a fixed grid whose
exact binomial test shows, at the corrected level, that it rejects no more than the allowed share of
good documents. The grid is tested from lenient to strict and stops at the first failure, so within
a grid no correction is needed; across signals and strata the level is divided (Bonferroni), and
the allowed share is divided among the signals, so their union keeps the bound.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelf.llm.common import cut, let, read_table, words

#: Most good documents that may be rejected, as a share per stratum, and the chance that this fails.
RISK, DELTA = 0.05, 0.05
#: Signals, all of the kind "more is worse", and their cutoffs from lenient to strict.
SHARES = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04)
RATES = (3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04)
GRID = {"symbols": RATES, "bangs": RATES, "caps": SHARES, "dup_lines": SHARES, "repeats": SHARES}
#: Tables of thresholds up to this many strata are broadcast.
SMALL_STRATA = 10_000


def _covered(grams: Column) -> Column:
    """Words in windows of 3 that occur at least twice, given the windows in order; overlaps count once."""

    def starts(s: Column) -> Column:
        last = F.size(s) - 1
        twin = lambda k: ((k > 0) & (F.get(s, k - 1)["g"] == F.get(s, k)["g"])) | (
            (k < last) & (F.get(s, k + 1)["g"] == F.get(s, k)["g"]))
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), last), twin), lambda k: F.get(s, k)["p"]))

    def union(p: Column) -> Column:
        gaps = F.transform(F.sequence(F.lit(0), F.size(p) - 1), lambda k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - F.get(p, k)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("p"))))
    return let(placed, lambda s: let(starts(s), union))


def _repeat_words(w: Column) -> Column:
    grams = F.when(F.size(w) < 3, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    # most texts repeat no window: a hash set tells, and only the others are sorted
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(_covered(g)))


def text_stats(text: Column) -> Column:
    """A struct of counts over the whole text; null counts as empty, and everything is 0 then."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    by_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).cast("long").alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                             (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return F.struct(by_words.alias("w"), by_lines.alias("l"), F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                    F.regexp_count(text, F.lit("!")).cast("long").alias("n_bangs"), F.regexp_count(text, F.lit("\\p{Lu}")).cast("long").alias("n_caps"))


def document_stats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per document: id, stratum, counts, the base verdict and the signals."""
    share = lambda a, b: (F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("double")
    return (df.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), text_stats(F.col(text_col)).alias("s"))
            .select("doc_id", "stratum", "s.w.n_words", "s.w.word_chars", "s.n_symbols", "s.l.n_lines", "s.l.n_dup_lines", "s.w.n_repeat_words", "s.n_bangs", "s.n_caps")
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .withColumns({"symbols": share("n_symbols", "n_words"), "bangs": share("n_bangs", "n_words"), "caps": share("n_caps", "word_chars"),
                          "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words")}))


def _log_gamma(x: Column) -> Column:
    """ln gamma for x >= 1, by Stirling's series at x + 8."""
    product = F.lit(1.0)
    for i in range(8):
        product = product * (x + i)
    y = x + 8
    return ((y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)) - F.log(product)


def _stirling_error(x: Column) -> Column:
    """ln(x!) less Stirling's formula, for x >= 1."""
    near = _log_gamma(x + 1) - ((x + 0.5) * F.log(x) - x + 0.9189385332046727)
    return F.when(x < 16, near).otherwise(1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x))


def _binomial_term(n: Column, k: Column, p: float) -> Column:
    """P(X = k) for X ~ Bin(n, p) and k < n, without differences of great logarithms (Loader's saddle point)."""
    q = 1 - p
    away = k * F.log(k / (n * p)) + (n - k) * F.log((n - k) / (n * q))
    error = _stirling_error(n) - _stirling_error(k) - _stirling_error(n - k)
    return F.when(k > 0, F.sqrt(n / (2 * math.pi * k * (n - k))) * F.exp(error - away)).otherwise(F.exp(n * math.log1p(-p)))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), to double precision for any n; 1 where k >= n p.

    The terms below k shrink at least as exp(-j^2 / 2k) after j of them, so those after the first
    10 sqrt(k) + 50 are less than 1e-21 of the first and cannot change the sum.
    """
    n, k = n.cast("double"), k.cast("double")
    odds = (1 - p) / p
    zero = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))

    def step(a: Column, i: Column) -> Column:
        at = k - i + 1
        term = F.when(at > 0, a["term"] * at / (n - at + 1) * odds).otherwise(F.lit(0.0))
        return F.struct((a["sum"] + term).alias("sum"), term.alias("term"))

    below = k < n * p
    terms = F.when(below, F.least(k, F.ceil(10 * F.sqrt(k)) + 50)).otherwise(F.lit(0)).cast("int")
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(terms, F.lit(1))), zero, step)
    return F.when(below, F.least(F.lit(1.0), _binomial_term(n, k, p) * folded["sum"])).otherwise(F.lit(1.0))


def thresholds(stats: DataFrame, labels: DataFrame, *, grid: dict[str, tuple[float, ...]] = GRID, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum: n good labelled documents and cut_<signal>, null where no cutoff is certified.

    labels has doc_id and good (boolean); several labels of a document must agree to count as good.
    Documents that fail the base rules take no part. A cutoff rejects values above it.
    """
    good = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.col("good").cast("int")).alias("good")).where("good = 1")
    held = stats.where(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    over = [F.count_if(F.col(s) > c).alias(f"{s}_{i}") for s, cuts in grid.items() for i, c in enumerate(cuts)]
    counts = held.groupBy("stratum").agg(F.count("*").alias("n"), *over)
    tests = F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(i).alias("i"), F.lit(float(c)).alias("cutoff"), F.col(f"{s}_{i}").alias("k"))
                      for s, cuts in grid.items() for i, c in enumerate(cuts)])
    everything = Window.partitionBy()
    counts = counts.withColumn("strata", F.count("*").over(everything))  # one row per stratum
    rows = counts.select("stratum", "n", "strata", F.explode(tests).alias("t")).select("stratum", "n", "strata", "t.*")
    rows = rows.withColumn("ok", binomial_tail(F.col("n"), F.col("k"), risk / len(grid)) <= F.lit(delta) / (F.lit(len(grid)) * F.col("strata")))
    so_far = Window.partitionBy("stratum", "signal").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    certified = rows.withColumn("ok", F.min("ok").over(so_far))
    return certified.groupBy("stratum").agg(F.first("n").alias("n"), *[
        F.min(F.when(F.col("ok") & (F.col("signal") == s), F.col("cutoff"))).alias(f"cut_{s}") for s in grid])


def apply_rules(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                grid: dict[str, tuple[float, ...]] = GRID, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The statistics of every document with kept: base rules passed and no signal above its stratum's cutoff.

    A null stratum is a stratum of its own. Null and empty texts have no words and fail the base
    rules. Without labels nothing is certified and only the base rules reject. Repeated rows are
    kept and judged alike; extra columns are ignored; an empty table gives no rows.
    """
    stats = cut(document_stats(df, id_col=id_col, text_col=text_col, stratum_col=stratum_col))
    cuts = cut(thresholds(stats, labels, grid=grid, risk=risk, delta=delta).withColumnRenamed("stratum", "of"))
    small = F.broadcast(cuts) if cuts.count() <= SMALL_STRATA else cuts
    rejected = F.lit(False)
    for s in grid:
        rejected = rejected | F.coalesce(F.col(s) > F.col(f"cut_{s}"), F.lit(False))
    return stats.join(small, F.col("stratum").eqNullSafe(F.col("of")), "left").withColumn("kept", ~F.col("base_failed") & ~rejected)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts for all documents; quality = 1 marks the good ones among the labelled."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    judged = apply_rules(read_table(spark, sf_dir, "documents"), labels)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    signals = {"symbols": "n_symbols / greatest(n_words, 1)", "bangs": "n_bangs / greatest(n_words, 1)", "caps": "n_caps / greatest(word_chars, 1)",
               "dup_lines": "n_dup_lines / greatest(n_lines, 1)", "repeats": "n_repeat_words / greatest(n_words, 1)"}
    cutoffs = ", ".join(f"('{s}', {i}, {c!r}::DOUBLE)" for s, cuts in GRID.items() for i, c in enumerate(cuts))
    p = RISK / len(GRID)
    values = " UNION ALL ".join(f"SELECT doc_id, stratum, good, '{s}' AS signal, ({e})::DOUBLE AS v FROM stats" for s, e in signals.items())
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, lang AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM base),
grams AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + d) AS n FROM twice, range(3) AS r(d) GROUP BY rid),
counts AS (SELECT rid, doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs,
    (length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')))::BIGINT AS n_caps, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered USING (rid)),
marked AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
stats AS (SELECT counts.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(quality = 1, false) AS good
    FROM counts LEFT JOIN marked USING (doc_id)),
vals AS ({values.replace('FROM stats', 'FROM stats WHERE NOT base_failed')}),
cutoffs(signal, i, cutoff) AS (VALUES {cutoffs}),
tests AS (SELECT stratum, c.signal, c.i, c.cutoff, count(*) AS n, count(*) FILTER (v > cutoff) AS k FROM vals JOIN cutoffs c USING (signal) WHERE good GROUP BY ALL),
tails AS (SELECT *, CASE WHEN k >= n * {p!r} THEN 1.0 ELSE list_sum(list_transform(range(k + 1), lambda x: exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1)
    + x * ln({p!r}) + (n - x) * ln({1 - p!r})))) END AS tail, (SELECT count(DISTINCT coalesce(stratum, '?')) FROM tests) AS strata FROM tests),
chosen AS (SELECT stratum, signal, min(cutoff) AS cutoff FROM (SELECT *, max(tail) OVER (PARTITION BY stratum, signal ORDER BY i) AS worst FROM tails)
    WHERE worst <= {DELTA!r} / ({len(GRID)} * strata) GROUP BY ALL),
flagged AS (SELECT DISTINCT s.rid FROM stats s JOIN chosen c ON s.stratum IS NOT DISTINCT FROM c.stratum
    WHERE CASE c.signal {' '.join(f"WHEN '{s}' THEN {e}" for s, e in signals.items())} END > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM flagged) AS kept FROM stats
"""


#: The same in DuckDB, with its own log gamma.
ORACLE = _oracle()
