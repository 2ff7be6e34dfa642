import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelf.llm import toxicity as t


def corpus(spark, n=1500, seed=2):
    rng = random.Random(seed)
    clean = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    bad = [f"zzq{rng.choice('klmnop')}{i}" for i in range(12)]
    rows = []
    for i in range(n):
        toxic = i % 8 == 0
        words = [rng.choice(clean) for _ in range(40)]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_held_out_rows(spark):
    got = spark.range(200).select("id", t.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    labels = docs.where("doc_id % 2 = 0").select("doc_id", "toxic")
    got = t.score_documents(docs, t.train(docs, labels)).collect()
    assert len(got) == 1500
    held = [r for r in got if r.held_out]
    hits = sum(r.predicted for r in held if r.doc_id % 8 == 0) / sum(r.doc_id % 8 == 0 for r in held)
    false = sum(r.predicted for r in held if r.doc_id % 8) / sum(r.doc_id % 8 != 0 for r in held)
    assert hits >= 0.95 and false <= 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = corpus(spark, 400)
    labels = docs.select("doc_id", "toxic")
    flipped = labels.withColumn("toxic", F.when(t.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert t.train(docs, labels) == t.train(docs, flipped)


def test_awkward_rows_and_no_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = t.train(documents, none)
    got = t.score_documents(documents, model).collect()
    assert len(got) == documents.count() and all(r.score == 0 and r.predicted == 0 for r in got)
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    got = t.score_documents(documents, t.train(documents, labels)).collect()
    assert all(0 <= r.score <= 1 for r in got)


def test_gradient_matches_differences():
    """Of both risks where the clean one is not negative, and of the step back where it is."""
    rng = np.random.default_rng(0)
    for zp, zu, prior in ((rng.standard_normal(5), rng.standard_normal(9), 0.1), (rng.standard_normal(5) + 3, rng.standard_normal(9) - 4, 0.4)):
        def goal(zp, zu):
            toxic, clean = t.pu_risks(zp, zu, prior)
            return toxic + clean if back else -clean

        back = t.pu_risks(zp, zu, prior)[1] >= 0
        gp, gu = t.pu_gradient(zp, zu, prior)
        for grad, z in ((gp, zp), (gu, zu)):
            for i in range(len(z)):
                before = goal(zp, zu)
                z[i] += 1e-6
                assert abs((goal(zp, zu) - before) / 1e-6 - grad[i]) < 1e-4
                z[i] -= 1e-6


def test_counts_cover_all_texts(spark, documents):
    texts = [r.text for r in documents.collect()]
    want = [set(t.text_features(x)) for x in texts]
    buckets = np.array(sorted(set().union(*want)))
    got, n = t.feature_counts(documents.select("text").repartition(5), buckets)
    assert n == len(texts) and got.tolist() == [sum(b in x for x in want) for b in buckets]


def test_scores_are_sums_of_word_weights(spark, documents):
    rng = np.random.default_rng(1)
    words = sorted({b for r in documents.collect() for b in t.text_features(r.text)})
    model = t.Model({b: float(rng.standard_normal()) for b in words}, -0.7)
    texts = {r.doc_id: r.text for r in documents.collect() if r.doc_id is not None}
    for r in t.score_documents(documents, model).collect():
        if r.doc_id is not None:
            z = sum(model.weights[b] for b in t.text_features(texts[r.doc_id])) + model.bias
            assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9


def test_the_query_scores_as_the_model_does(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    want = {r.doc_id: r for r in t.score_documents(docs, t.train(docs, labels)).collect()}
    got = t.op7_toxicity(spark, sf).collect()
    assert len(got) == len(want) and all(abs(r.score - want[r.doc_id].score) < 1e-9 and r.predicted == want[r.doc_id].predicted and r.held_out == want[r.doc_id].held_out for r in got)


def test_copies_and_columns_of_any_name(spark):
    docs = corpus(spark, 600)
    hot = docs.limit(1).withColumn("doc_id", F.explode(F.sequence(F.lit(10_000).cast("long"), F.lit(10_400).cast("long"))))
    both = docs.union(hot).union(hot).withColumn("_score", F.lit("mine")).withColumnRenamed("toxic", "a.b")
    model = t.train(both, docs.select("doc_id", "toxic"))
    got = t.keep_clean(both, model)
    assert got.columns == both.columns and {r["_score"] for r in got.collect()} == {"mine"}
    found = t.score_documents(docs, model).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in found) >= 0.95 * len(found)


def test_keep_clean_keeps_columns(spark):
    docs = corpus(spark, 600)
    kept = t.keep_clean(docs, t.train(docs, docs.select("doc_id", "toxic")))
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sum(r.toxic for r in rows) <= 4 and sum(1 - r.toxic for r in rows) >= 0.97 * 525


def test_empty_table(spark, no_documents):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert t.score_documents(no_documents, t.train(no_documents, labels)).count() == 0
