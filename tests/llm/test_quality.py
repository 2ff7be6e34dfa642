import math
import re
from collections import Counter
from decimal import Decimal
from fractions import Fraction

import numpy as np

from pyspark.sql import functions as F

from shelf.llm import quality as q


def plain(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    covered = {i + d for i, g in enumerate(grams) if n[g] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_match_brute_force(spark, documents):
    extra = ["a b c a b c", "a a a a", "x y z\nx y z\n\n \nx y z", "é|ü<>&%$*#", "b c d e b c x c d e", "\x1c a\x0bb\x0cc", "w " * 3000 + "v", "\n".join(["dup line here"] * 400)]
    rows = [(r.doc_id, r.text, r.lang) for r in documents.collect()] + [(1000 + i, t, "en") for i, t in enumerate(extra)]
    got = q.document_stats(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted((str(r.doc_id), *[r[n] for n in names]) for r in got) == sorted((str(i), *plain(t)) for i, t, _ in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)


def exact_tail(n, k, p):
    """Whole sums of fractions for small numbers, of all terms' logarithms for great ones."""
    if n <= 1000:
        return float(sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1)))
    i = np.arange(k, -1, -1)[:-1]
    below = np.concatenate([[0.0], np.cumsum(np.log(i) - np.log(n - i + 1) + math.log((1 - p) / p))])
    top = float(Decimal(math.comb(n, k)).ln() + Decimal(k) * Decimal(p).ln() + Decimal(n - k) * (1 - Decimal(p)).ln())
    return math.exp(top) * float(np.exp(below).sum())


def test_binomial_tail_is_exact(spark):
    """Far beyond a few thousand terms too."""
    cases = [(n, k, p) for n in (1, 5, 40, 300, 1000) for k in (0, 1, 3, 9) if k <= n for p in (0.01, 0.05)]
    cases += [(400_000, 3_850, 0.01), (400_000, 3_999, 0.01), (900_000, 8_600, 0.01), (200_000, 10_500, 0.05), (200_000, 9_700, 0.05)]
    for p in (0.01, 0.05):
        mine = [(n, k) for n, k, x in cases if x == p]
        got = spark.createDataFrame(mine, "n long, k long").select("n", "k", q.binomial_tail(F.col("n"), F.col("k"), p).alias("t")).collect()
        for r in got:
            assert r.t == 1.0 if r.k >= r.n * p else math.isclose(r.t, exact_tail(r.n, r.k, p), rel_tol=1e-8), r


def sample(spark, n=4000):
    rows = []
    for i in range(n):
        junk = i % 10 == 0
        text = " ".join((f"w{i}x{j}" + ("$$$" if junk else "")) for j in range(60))
        rows.append((i, text, "en" if i % 2 else None, 0 if junk else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


def test_cutoffs_keep_the_good_and_reject_junk(spark):
    docs = sample(spark)
    labels = docs.select("doc_id", (F.col("quality") == 1).alias("good"))
    got = q.apply_rules(docs, labels).collect()
    assert len(got) == 4000
    assert all(r.kept == (r.doc_id % 10 != 0) for r in got)


def test_without_labels_only_the_base_rules_reject(spark, documents):
    none = spark.createDataFrame([], "doc_id long, good boolean")
    got = q.apply_rules(documents, none).collect()
    assert len(got) == documents.count() and all(r.kept == (not r.base_failed) for r in got)


def test_false_rejections_stay_below_the_risk(spark):
    docs = sample(spark, 2000).withColumn("text", F.when(F.col("doc_id") % 25 == 1, F.concat(F.col("text"), F.lit(" !!!!!!!!!!!!!!!!!!!!!!!!!!!!!!"))).otherwise(F.col("text")))
    labels = docs.select("doc_id", (F.col("quality") == 1).alias("good"))
    kept = {r.doc_id: r.kept for r in q.apply_rules(docs, labels).collect()}
    good = [i for i in range(2000) if i % 10]
    assert sum(not kept[i] for i in good) / len(good) <= q.RISK


def test_empty_table(no_documents, spark):
    none = spark.createDataFrame([], "doc_id long, good boolean")
    assert q.apply_rules(no_documents, none).count() == 0
