"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier in numpy learns from confirmed toxic texts and unlabelled text. The risk of the
unlabelled part, less what the class prior says toxic texts contribute to it, estimates the risk on
clean text; where that estimate turns negative, a step is taken back (Kiryo et al., 2017), so the model
cannot profit from fitting the toxic texts hidden among the unlabelled ones. Features are a text's
distinct words and their first letters, hashed; those that confirmed toxic texts have no more often
than unlabelled text are left out. How often unlabelled text has a feature, and the intercept, are
aggregates over all unlabelled documents; only the gradient steps use bounded samples.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.llm.common import SLICE, cut, filter_rows, lean, map_rows, read_table

#: Buckets of hashed features; lengths of the beginnings that count beside the word itself.
BUCKETS, STEMS = 1 << 20, (4, 5)
#: Gradient steps see at most so many confirmed and unlabelled texts, chosen by a hash of the id.
MAX_POSITIVE, MAX_UNLABELLED = 4000, 8000
#: Only features that this many confirmed texts have, and this many standard errors more often than unlabelled ones, are used.
MIN_TEXTS, MIN_Z = 4, 4.0
#: Copies of a text count once among the unlabelled where they are over 1 / HOT of all rows; so at most HOT texts are hot.
HOT = 10_000
#: Scores are counted in bins of this width to set the intercept.
BIN = 0.01
STEPS, RATE, DECAY, SEED = 600, 0.05, 1e-4, 11
#: Share of a text's features that a step sees.
KEEP = 0.15
#: Scores from here on are toxic.
CUT = 0.3
REMEMBERED = 50_000
_WORD = re.compile(r"\w+")


def word_features(word: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets of a word: itself and its beginnings."""
    return [zlib.crc32(f"{n}:{word[:n] if n else word}".encode("utf-8", "surrogatepass")) % buckets for n in (0, *STEMS) if len(word) > n]


def text_features(text: str | None) -> list[int]:
    """The buckets of a text's distinct words, lower-cased; a bucket counts once per distinct word."""
    return [b for w in sorted(set(_WORD.findall((text or "").lower()))) for b in word_features(w)]


@dataclass
class Model:
    """Weights by bucket and an intercept; without weights every text scores 0."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -50.0

    def weigher(self) -> Callable[[str | None], float]:
        """A function from text to the sum of its features' weights that remembers those of words."""
        known: dict[str, float] = {}
        find, weights = _WORD.findall, self.weights

        def weigh(word: str) -> float:
            if len(known) >= REMEMBERED:
                known.clear()
            known[word] = found = sum(weights.get(b, 0.0) for b in word_features(word))
            return found

        return lambda text: float(sum([w if (w := known.get(x)) is not None else weigh(x) for x in sorted(set(find(text.lower())))])) if text and weights else 0.0

    def scorer(self) -> Callable[[str | None], float]:
        """A function from text to score."""
        weigh = self.weigher()
        return lambda text: float(1 / (1 + np.exp(-np.clip(weigh(text) + self.bias, -500, 500)))) if self.weights else 0.0


def _presence(texts: list[list[int]], buckets: int) -> np.ndarray:
    counts = np.zeros(buckets, np.int64)
    for x in texts:
        counts[np.unique(x).astype(np.int64)] += 1
    return counts


def _distinct(texts: list[list[int]]) -> list[list[int]]:
    """One text of each group with equal features: copies would make their chance words look telling."""
    return list({tuple(sorted(int(b) for b in x)): x for x in texts}.values())


def telling(in_p: np.ndarray, n_p: int, in_u: np.ndarray, n_u: int) -> np.ndarray:
    """Which features confirmed texts have often enough, and enough more often than unlabelled ones, given how many have each."""
    p, u = in_p / n_p, in_u / n_u
    mean = (in_p + in_u) / (n_p + n_u)
    z = (p - u) / np.sqrt(np.maximum(mean * (1 - mean), 1e-12) * (1 / n_p + 1 / n_u))
    return (in_p >= MIN_TEXTS) & (z >= MIN_Z)


def fit(positive: list[list[int]], unlabelled: list[list[int]], prior: float, *, buckets: int = BUCKETS, steps: int = STEPS, rate: float = RATE,
        decay: float = DECAY, keep: float = KEEP, chosen: np.ndarray | None = None, seed: int = SEED) -> Model:
    """Minimise the non-negative PU risk of a logistic loss over the texts' features.

    prior is the share of toxic texts among the unlabelled. Without confirmed or unlabelled texts,
    or with a prior of 0, nothing can be learnt and every text scores 0. chosen are the buckets that
    count, by default those telling in the given texts. At last the intercept is set so that the
    given unlabelled texts score the class prior on average.
    """
    if not positive or not unlabelled or not prior > 0:
        return Model()
    prior = min(prior, 0.99)
    positive, unlabelled = _distinct(positive), _distinct(unlabelled)
    if chosen is None:
        chosen = np.flatnonzero(telling(_presence(positive, buckets), len(positive), _presence(unlabelled, buckets), len(unlabelled)))
    if not len(chosen):
        return Model()
    place = np.full(buckets, -1, np.int64)
    place[chosen] = np.arange(len(chosen))

    def sparse(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        cols = [c[c >= 0] for c in (place[np.asarray(x, np.int64)] for x in texts)]
        return np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate(cols)

    (rp, cp), (ru, cu) = sparse(positive), sparse(unlabelled)
    w, b = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    rng = np.random.default_rng(seed)
    for t in range(1, steps + 1):
        # each step hides most features of each text, so that a few toxic words suffice
        seen_p, seen_u = rng.random(len(cp)) < keep, rng.random(len(cu)) < keep
        zp = np.bincount(rp, w[cp] * seen_p, len(positive)) + b
        zu = np.bincount(ru, w[cu] * seen_u, len(unlabelled)) + b
        gp, gu = pu_gradient(zp, zu, prior)
        grad = np.append(np.bincount(cp, gp[rp] * seen_p, len(w)) + np.bincount(cu, gu[ru] * seen_u, len(w)), gp.sum() + gu.sum())
        grad[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    zu = np.bincount(ru, w[cu], len(unlabelled))
    return Model({int(c): float(x) for c, x in zip(chosen, w, strict=True) if x}, intercept(zu, np.ones(len(zu)), prior))


def pu_risks(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The risk on toxic text, and the estimated risk on clean text, which a model can drive below 0."""
    soft = lambda x: np.logaddexp(0, x)
    return prior * soft(-zp).mean(), soft(zu).mean() - prior * soft(zp).mean()


def pu_gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives by the scores of both risks' sum; where the clean risk is negative, of its negative alone: the step back."""
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    as_toxic, as_clean_p, as_clean_u = (sigmoid(zp) - 1) / len(zp), sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)
    return (prior * as_toxic - prior * as_clean_p, as_clean_u) if pu_risks(zp, zu, prior)[1] >= 0 else (prior * as_clean_p, -as_clean_u)


def intercept(scores: np.ndarray, counts: np.ndarray, prior: float) -> float:
    """The number that added to all scores makes their mean probability the class prior."""
    low, high = -100.0, 100.0
    for _ in range(80):
        b = (low + high) / 2
        mean = (counts / (1 + np.exp(-np.clip(scores + b, -60, 60)))).sum() / counts.sum()
        low, high = (b, high) if mean < prior else (low, b)
    return float(b)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, modulo 4, is 2. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _sampled(documents: DataFrame, ids: list, id_col: str, text_col: str) -> list[np.ndarray]:
    """The features of the documents with the given ids, one text an id, in the order of ids."""
    wanted = documents.sparkSession.createDataFrame([(i,) for i in ids], f"wanted {dict(documents.dtypes)[id_col]}")
    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted")).select("doc_id", "text")
    found = map_rows(texts, ["doc_id"], {"features": "array<int>"}, lambda: lambda text: (text_features(text),))
    rows = found.groupBy("doc_id").agg(F.min("features").alias("features")).toArrow().sort_by("doc_id")  # as many rows as ids, of repeated ones the least
    return [x.values.to_numpy(zero_copy_only=False) for x in rows.column("features")]


def feature_counts(texts: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """How many of all texts (one column, text) have each wanted bucket, and how many texts there are: a sum per task, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows, known = np.zeros(len(wanted), np.int64), 0, {}
        place = {int(b): i for i, b in enumerate(wanted)}
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, len(b), SLICE)):
            rows += len(batch)
            for text in batch.column(0).to_pylist():
                seen: set[int] = set()
                for word in set(_WORD.findall((text or "").lower())):
                    if (at := known.get(word)) is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known[word] = at = tuple(place[b] for b in word_features(word) if b in place)
                    seen.update(at)
                counts[list(seen)] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], rows))], ["at", "n"])

    total, rows = np.zeros(len(wanted), np.int64), 0
    for r in texts.mapInArrow(lean(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # a row per wanted bucket
        if r.at < 0:
            rows = r.n
        else:
            total[r.at] = r.n
    return total, rows


@dataclass
class Learnt:
    """Weights without their intercept yet, the class prior, and the texts (hash, first id) that count once."""

    weights: dict[int, float]
    prior: float
    hot: DataFrame | None = None


def learn(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, seed: int = SEED) -> Learnt:
    """Fit on confirmed toxic documents and unlabelled ones, held-out rows aside.

    labels has doc_id and toxic (0/1); a document counts as toxic if any of its labels says so; labels
    without an id or a mark say nothing. The class prior is the toxic share among the labelled documents.
    Of the texts of a repeated id one counts. Ids are sampled by a seeded hash, ties by id, at most
    max_positive and max_unlabelled, for the gradient steps; feature frequencies of unlabelled text are
    taken over all unlabelled documents, whose number nothing bounds. To the driver go the samples' hashed
    features and a count per feature of the confirmed texts.
    """
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    prior = marks.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return Learnt({}, 0.0)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null").where(~held_out(F.col("doc_id")))
    picked = [r[0] for r in marks.where("toxic = 1").join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(order, "doc_id").limit(max_positive).select("doc_id").collect()]
    positive = _distinct(_sampled(rows, picked, "doc_id", "text")) if picked else []
    if not positive:
        return Learnt({}, 0.0)
    in_p = _presence(positive, BUCKETS)
    wanted = np.flatnonzero(in_p >= MIN_TEXTS)
    groups = rows.groupBy(F.xxhash64("text").alias("hash")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    hot = groups.withColumn("all", F.lit(rows.count())).where(F.col("n") * HOT > F.col("all")).where("n > 1").select("hash", "first")  # fewer than HOT rows
    once = rows.join(F.broadcast(hot), F.xxhash64("text") == F.col("hash"), "left").where("hash is null or doc_id = first")
    in_u, n_u = feature_counts(once.select("text"), wanted)
    chosen = wanted[telling(in_p[wanted], len(positive), in_u, n_u)]
    others = [r[0] for r in rows.select("doc_id").distinct().orderBy(order, "doc_id").limit(max_unlabelled).collect()]
    return Learnt(fit(positive, _sampled(rows, others, "doc_id", "text"), float(prior), chosen=chosen).weights, min(float(prior), 0.99), hot)


def weigh_documents(documents: DataFrame, learnt: Learnt, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, counted and z of every row: the sum of its features' weights, and whether the intercept is set by it."""
    rows = documents.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    own = F.col("doc_id").isNotNull() & ~F.col("held_out")
    if learnt.hot is not None:
        rows = rows.join(F.broadcast(learnt.hot), F.xxhash64("text") == F.col("hash"), "left")
        own = own & (F.col("hash").isNull() | (F.col("doc_id") == F.col("first")))
    rows = rows.select("doc_id", "held_out", F.coalesce(own, F.lit(False)).alias("counted"), "text")

    weights = learnt.weights

    def make():
        weigh = Model(weights, 0.0).weigher()
        return lambda text: (weigh(text),)

    return map_rows(rows, ["doc_id", "held_out", "counted"], {"z": "double"}, make)


def calibrated(learnt: Learnt, weighed: DataFrame) -> Model:
    """The model whose mean score over the counted rows is the class prior; a count per bin of z goes to the driver."""
    if not learnt.weights:
        return Model()
    binned = weighed.where("counted").groupBy(F.round(F.col("z") / BIN).cast("long").alias("bin")).agg(F.count("*").alias("n")).toArrow()
    return Model(learnt.weights, intercept(binned.column("bin").to_numpy() * BIN, binned.column("n").to_numpy().astype(float), learnt.prior))


def train(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, seed: int = SEED) -> Model:
    """The model of a corpus and its labels (see learn), its intercept set over all unlabelled documents."""
    learnt = learn(documents, labels, id_col=id_col, text_col=text_col, max_positive=max_positive, max_unlabelled=max_unlabelled, seed=seed)
    return calibrated(learnt, weigh_documents(documents, learnt, id_col=id_col, text_col=text_col)) if learnt.weights else Model()


def score_documents(documents: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts get the score of a text without words.

    Whole texts count, however long. Repeated rows are scored alike; extra columns are ignored; an empty table gives no rows.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))

    def make():
        score = model.scorer()
        return lambda text: (score(text),)

    return map_rows(rows, ["doc_id", "held_out"], {"score": "double"}, make).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_clean(documents: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns whatever their names, that the model does not call toxic."""

    def make():
        score = model.scorer()
        return lambda text: score(text) < CUT

    return filter_rows(documents, text_col, make)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of this corpus; each is weighed once, for the intercept and its score."""
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    learnt = learn(documents, labels)
    weighed = cut(weigh_documents(documents, learnt))
    model = calibrated(learnt, weighed)
    score = 1 / (1 + F.exp(-(F.col("z") + F.lit(model.bias)))) if model.weights else F.lit(0.0)
    return weighed.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
