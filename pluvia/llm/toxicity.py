"""Toxicity by non-negative positive-unlabelled learning: numpy classifiers over the words of a text.

Confirmed toxic examples (P) and unlabelled text (U) train linear classifiers.  With the class prior p, the risk of
calling U negative holds a part p of positives too, so it is corrected to ``R_U(-) - p R_P(-)``.  That estimate of the
negatives' risk may not go below zero: where it does in a batch, the step climbs it instead of descending (the
non-negative estimator), which keeps the model from learning P by heart.  Several classifiers start from different
seeds, and a text's score is their mean probability.

Training reads a bounded sample: ``MAX_POSITIVE`` confirmed examples and ``MAX_UNLABELLED`` other texts, those with the
smallest hashes of their ids, so that reruns agree; of rows that share a drawn id the one with the smallest hash of its
words.  Whole texts are read, near copies in the sample count once, and the vocabulary is what ``MIN_EXAMPLES`` of P use,
``MAX_VOCABULARY`` words at most.  The class prior is the share of toxic ones among all training labels.  Only word numbers of the sample reach the driver.  Scoring covers every whole text, in tasks that get
the weights alone.

Inputs of a score are the words of the text only, and labels are learnt only from rows that ``training`` admits.
Defined cases: null and empty texts have no words and get the score of the intercept; without confirmed examples or
unlabelled texts every score is the class prior (0 without any label); null labels and labels without an id are no
labels; of several labels of a document the toxic one counts; empty tables give empty results; rows that repeat an id
are scored each by its own text; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_slices, written

#: Bounds of the training sample.
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 18_000
#: A word enters the vocabulary if this many examples of P use it, and this many times the share of P that uses it in U;
#: the most used ones, if there are too many.
MIN_EXAMPLES, MIN_LIFT, MAX_VOCABULARY = 5, 3.0, 20_000
#: A document with this score or more is called toxic.
THRESHOLD = 0.7
#: Of the optimiser (Adam): steps, how many of them with logistic loss, texts of P and of U in each, rate, decay; and
#: the number of classifiers.
STEPS, WARM, BATCH_P, BATCH_U, RATE, DECAY, MODELS = 1000, 100, 1024, 2048, 0.05, 1e-6, 3
#: Within the sample, texts that share so many smallest word hashes are compared; so large a common part of the words of
#: either makes a copy.
SKETCH, COPY = 4, 0.8

_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """Distinct lower-cased runs of letters."""
    return set(_WORDS.findall((text or "").lower()))


@dataclass(frozen=True)
class Model:
    """Weights per word and intercepts, a column for each classifier."""

    vocabulary: dict[str, int]
    weights: np.ndarray
    intercepts: np.ndarray

    def score(self, text: str | None) -> float:
        known = [n for n in map(self.vocabulary.get, words(text)) if n is not None]
        margins = self.intercepts + self.weights[sorted(known)].sum(0)
        return float(_sigmoid(margins).mean())


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _rows(documents: list[np.ndarray], chosen: np.ndarray):
    """Word numbers of the chosen documents one after the other, and for each the document it is in."""
    lengths = np.array([len(documents[i]) for i in chosen])
    return np.concatenate([documents[i] for i in chosen]), np.repeat(np.arange(len(chosen)), lengths)


def train_one(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int, seed: int
) -> tuple[np.ndarray, float]:
    """One linear classifier under the non-negative risk estimator.

    The first ``WARM`` steps use logistic loss, which is convex and finds the direction; the others sigmoid loss, which is
    bounded, so that wrong labels do not pull at it, and sharpens the scores.
    """
    random = np.random.default_rng(seed)
    weights = np.append(np.zeros(size), np.log(prior / (1 - prior)))  # the last is the intercept
    mean, square = np.zeros(size + 1), np.zeros(size + 1)

    def side(documents, count):
        """Margins of a random batch, and the gradient that belongs to slopes of its losses."""
        chosen = random.permutation(len(documents))[:count]
        numbers, owner = _rows(documents, chosen)

        def gradient(slopes):
            slopes = slopes / len(chosen)
            return np.append(np.bincount(numbers, slopes[owner], size), slopes.sum())

        return np.bincount(owner, weights[numbers], len(chosen)) + weights[-1], gradient

    for step in range(1, STEPS + 1):
        (margin_p, gradient_p), (margin_u, gradient_u) = side(positive, BATCH_P), side(unlabelled, BATCH_U)
        score_p, score_u = _sigmoid(margin_p), _sigmoid(margin_u)
        # Losses of a negative call in P and U, their slopes, and the slopes of a positive call in P.
        if step <= WARM:
            loss_p, loss_u = np.logaddexp(0, margin_p), np.logaddexp(0, margin_u)
            down_p, down_u, up_p = score_p, score_u, score_p - 1
        else:
            loss_p, loss_u = score_p, score_u
            down_p, down_u = score_p * (1 - score_p), score_u * (1 - score_u)
            up_p = -down_p
        negatives = loss_u.mean() - prior * loss_p.mean()
        slope = gradient_u(down_u) - prior * gradient_p(down_p)
        slope = slope + prior * gradient_p(up_p) if negatives >= 0 else -slope
        slope[:-1] += DECAY * weights[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def _word_rows(batch):
    sets = [sorted(words(text.as_py())) for text in batch.column(2)]
    hashes = [sorted(zlib.crc32(word.encode()) for word in held) for held in sets]
    arrays = [
        batch.column(0),
        batch.column(1),
        pa.array(hashes, pa.list_(pa.int64())),
        pa.array(sets, pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "positive", "hashes", "words"])


def _unlike(group):
    """Of sampled texts that share their smallest hashes, those that are no copy of one before them."""
    group = group.sort_values(["draw", "doc_id"], ignore_index=True)
    kept, places = [], []
    for place, hashes in enumerate(group["hashes"]):
        held = set(hashes)
        if not any(len(held & other) >= COPY * len(held | other) for other in kept):
            kept.append(held)
            places.append(place)
    return group.loc[places, ["positive", "doc_id"]]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Train on rows of ``labels`` and ``docs`` that ``training`` (a condition on a column ``doc_id``) admits."""
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & training)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    prior = float(seen["toxic"] or 0) / max(1, seen["n"])

    def nothing(score):
        return Model({}, np.zeros((0, 1)), np.array([np.log(score / (1 - score)) if 0 < score < 1 else score * 80 - 40]))

    if not 0 < prior < 1:
        return nothing(prior)
    draw = F.xxhash64("doc_id")
    ids = docs.select(F.col(id_col).alias("doc_id")).where(F.col("doc_id").isNotNull() & training).distinct()
    positive = known.where("toxic = 1").select("doc_id").orderBy(draw, "doc_id").limit(MAX_POSITIVE)
    unlabelled = ids.orderBy(draw, "doc_id").limit(MAX_UNLABELLED)
    chosen = positive.withColumn("positive", F.lit(True)).union(unlabelled.withColumn("positive", F.lit(False)))
    # At most MAX_POSITIVE + MAX_UNLABELLED ids: a bounded side to broadcast.
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    held = texts.select("doc_id", "positive", "text").mapInArrow(
        in_slices(_word_rows), "doc_id long, positive boolean, hashes array<long>, words array<string>"
    )
    # One row per drawn id, however many rows share it: the sample is bounded from here on.
    least = F.min(F.struct(F.xxhash64("words").alias("words_hash"), "hashes", "words")).alias("row")
    one = written(
        held.groupBy("positive", "doc_id").agg(least).select("positive", "doc_id", draw.alias("draw"), "row.*"), "toxicity-one"
    )
    kept = (
        one.select("positive", "draw", "doc_id", "hashes")
        .groupBy("positive", F.slice("hashes", 1, SKETCH))
        .applyInPandas(_unlike, "positive boolean, doc_id long")
    )
    sample = written(one.join(kept, ["positive", "doc_id"]).select("positive", "draw", "doc_id", "words"), "toxicity-sample")
    sizes = {row["positive"]: row["count"] for row in sample.groupBy("positive").count().collect()}
    if len(sizes) < 2:
        return nothing(prior)
    uses = (
        sample.select("positive", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    )
    lift = (F.col("p") / sizes[True]) / ((F.col("u") + 1) / (sizes[False] + 1))
    chosen_words = uses.where((F.col("p") >= MIN_EXAMPLES) & (lift >= MIN_LIFT))
    counts = chosen_words.orderBy(F.desc("p"), "word").limit(MAX_VOCABULARY)
    vocabulary = {row["word"]: n for n, row in enumerate(counts.collect())}

    def numbers(batch):
        rows = [
            np.array(sorted(n for n in map(vocabulary.get, held) if n is not None), np.int32)
            for held in batch.column(3).to_pylist()
        ]
        columns = [*batch.columns[:3], pa.array(rows, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(columns, names=["positive", "draw", "doc_id", "numbers"])

    table = (
        sample.mapInArrow(in_slices(numbers), "positive boolean, draw long, doc_id long, numbers array<int>")
        .orderBy("draw", "doc_id", "numbers")
        .toArrow()
    )
    sides = {True: [], False: []}
    for is_positive, held_numbers in zip(table.column("positive").to_pylist(), table.column("numbers")):
        sides[is_positive].append(held_numbers.values.to_numpy())
    p, u = sides[True], sides[False]
    trained = [train_one(p, u, prior, len(vocabulary), seed) for seed in range(MODELS)]
    return Model(vocabulary, np.stack([w for w, _ in trained], axis=1), np.array([b for _, b in trained]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` -> (doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batch):
        scores = [shared.value.score(held.as_py()) for held in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text))
    return chosen.mapInArrow(in_slices(step), "doc_id long, score double")


def reject_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with the columns of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def step(batch):
        scores = [shared.value.score(held.as_py()) for held in batch.column(place)]
        return batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    # Plain names on the way, since a name may hold a dot.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(in_slices(step), plain.schema).toDF(*docs.columns)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
