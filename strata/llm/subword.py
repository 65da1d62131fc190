"""Operator 9, quality classifier: supervised subword embeddings.

A document is the average of learned vectors: one for each word (hashed), for
each character n-gram of the word between its bounds, and for each pair of
neighbouring words' shapes (letter case, last character, and whether the two
words are equal). A softmax layer over the average gives the label; vectors and
layer are trained together by stochastic gradient descent in numpy, over
whole texts of a bounded sample of labelled rows (``PER_CLASS`` of each label).
The sample holds both labels in equal parts as far as it can; the score is
moved back to the labels' shares among all labelled rows that may be learned
from.

With a linear output the score of a document is a mean of one number per
feature, so tasks get one table of ``BUCKETS`` numbers.

Defined results
  null, empty and blank texts: no features, the score is that of the bias;
  no labels: 0.5 for all; one label only: its smoothed share; null ids: held
  out; repeated rows: the same score each; empty table: no rows; extra columns
  are ignored (``accepted`` keeps them); very long texts: scored whole, and learned from
  whole; ties: equal texts have equal scores, and a score equal to the threshold is accepted;
  of several texts under one labelled id the one of the least hash is learned from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, held_out, labelled_sample, small_batches

BUCKETS, DIM = 1 << 17, 12
GRAMS = (3, 4)
PER_CLASS, EPOCHS, RATE = 1000, 6, 0.6
THRESHOLD = 0.3
#: Words whose features a worker remembers, at most.
REMEMBERED = 400_000
#: Kinds of last character times kinds of letter case.
SHAPES = 24


def _grams(word: bytes) -> list[int]:
    """Buckets of the word and of its character n-grams."""
    bound, crc = b"<" + word + b">", zlib.crc32
    out = [crc(bound, 1) % BUCKETS]
    if bound.isascii():  # bytes are characters
        for n in GRAMS:
            out += [crc(bound[i:i + n], n) % BUCKETS for i in range(len(bound) - n + 1)]
        return out
    text = bound.decode("utf-8", "replace")
    for n in GRAMS:
        out += [crc(text[i:i + n].encode("utf-8", "replace"), n) % BUCKETS for i in range(len(text) - n + 1)]
    return out


def _shape(word: bytes) -> int:
    text = word.decode("utf-8", "replace")
    upper = 0 if text.islower() else sum(map(str.isupper, text))
    letters = upper if not upper else sum(map(str.isalpha, text))
    case = (1 if text.islower() else 0) if not upper else 2 if upper == letters and upper > 1 else 3
    last = text[-1]
    end = 0 if last.isalpha() else 1 if last.isdigit() else 2 if last in ".," else 3 if last in "!?" else 4 if ord(last) < 128 else 5
    return case * 6 + end


def _pair_bucket() -> np.ndarray:
    pairs = np.arange(SHAPES * SHAPES * 2)
    return np.array([zlib.crc32(b"pair%d" % p) % BUCKETS for p in pairs])


PAIRS = _pair_bucket()
#: The worker's words under the model of the given broadcast; Spark gives a worker many tasks.
_KNOWN: dict[tuple, "Words"] = {}


class Words:
    """What a task knows of the words it has met: a number each and its shape; per word
    its buckets or, with a table of feature scores, their sum and count."""

    def __init__(self, scores: np.ndarray | None = None):
        self.scores = None if scores is None else scores.tolist()  # plain numbers: quicker for a few at a time
        self.forget()

    def forget(self) -> None:
        self.number, self.buckets = {}, []
        self.shapes, self.facts = np.zeros(1024, np.int64), np.zeros((1024, 2))

    def _learn(self, word: bytes) -> int:
        n = len(self.number)
        if n == len(self.shapes):
            self.shapes, self.facts = np.resize(self.shapes, 2 * n), np.resize(self.facts, (2 * n, 2))
        buckets = _grams(word)
        self.shapes[n] = _shape(word)
        if self.scores is None:
            self.buckets.append(buckets)
        else:
            self.facts[n] = sum(map(self.scores.__getitem__, buckets)), len(buckets)
        self.number[word] = n
        return n

    def of(self, text: str | None) -> np.ndarray:
        if len(self.number) > REMEMBERED:
            self.forget()
        known, learn = self.number, self._learn
        words = (text or "").encode("utf-8", "surrogatepass").split()
        return np.array([known[w] if w in known else learn(w) for w in words], np.int64)

    def pairs(self, ids: np.ndarray) -> np.ndarray:
        s = self.shapes[ids]
        return (s[:-1] * SHAPES + s[1:]) * 2 + (ids[:-1] == ids[1:])

    def bag(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a text's features, and how often each occurs."""
        ids = self.of(text)
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0)
        met, times = np.unique(ids, return_counts=True)
        own = [np.array(self.buckets[i]) for i in met]
        every = np.concatenate([*own, PAIRS[self.pairs(ids)]])
        weight = np.concatenate([np.repeat(times, [len(x) for x in own]), np.ones(len(ids) - 1)])
        bucket, place = np.unique(every, return_inverse=True)
        return bucket.astype(np.int64), np.bincount(place, weight, len(bucket))


@dataclass
class Bags:
    """The features of all learned documents in flat arrays: those of document ``i`` lie from
    ``ends[i]`` to ``ends[i + 1]``."""
    labels: np.ndarray
    ends: np.ndarray
    buckets: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, parts: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> Bags:
        """From one (label, buckets, times) a document."""
        labels, ends, buckets, times = [], [0], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)]
        for label, own, n in parts:
            labels.append(label)
            ends.append(ends[-1] + len(own))
            buckets.append(np.asarray(own, np.int32))
            times.append(np.asarray(n, np.float32))
        return cls(np.array(labels, np.int64), np.array(ends), np.concatenate(buckets), np.concatenate(times))


def train(bags: Bags, share: float, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> tuple[np.ndarray, float]:
    """Score of each bucket and the bias, whose mean and sum give the log odds of label 1."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    documents = len(bags.labels)
    total, step = epochs * documents, 0
    for _ in range(epochs):
        for i in rng.permutation(documents):
            own = slice(bags.ends[i], bags.ends[i + 1])
            bucket, times, label = bags.buckets[own], bags.times[own], bags.labels[i]
            lr, step = rate * (1 - step / total), step + 1
            weight = (times / max(times.sum(), 1)).astype(np.float32)
            mean = weight @ vectors[bucket]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = out @ p
            out -= lr * np.outer(mean, p)
            bias -= lr * 0.1 * p
            # a vector moves by its share of the average, scaled so that rare features learn too
            vectors[bucket] -= lr * np.sqrt(weight)[:, None] * back
    ones = bags.labels.sum()
    drawn = np.log((ones + 1) / (documents - ones + 1))
    shift = np.log(share / (1 - share)) - drawn
    return vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0] + shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """Feature scores and bias, learned from at most ``2 * per_class`` labelled documents.

    One task trains: it holds the features of that sample (at most ``BUCKETS`` of a document,
    whatever its length) and returns ``BUCKETS + 1`` numbers, all that the driver sees."""
    spark = docs.sparkSession
    small_batches(spark)
    sample = cut(labelled_sample(labels, per_class, label_col, id_col), "sample")
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
             .join(F.broadcast(sample), "doc_id")  # at most 2 * per_class ids
             .groupBy("doc_id", "label").agg(F.min_by("t", F.xxhash64("t")).alias("t")))
    share = (labels.filter(F.col(label_col).isin(0, 1) & ~held_out(id_col)).agg(F.avg(F.col(label_col)).alias("m"),
                                                                           F.count("*").alias("n")).first())
    n = share["n"]
    smoothed = ((share["m"] or 0) * n + 1) / (n + 2)

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for pdf in batches:
            got = [words.bag(t) for t in pdf["t"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"],
                                "buckets": [g[0].astype(np.int32) for g in got], "times": [g[1].astype(np.float32) for g in got]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = Bags.of((y, b, t) for pdf in batches for y, b, t in zip(pdf["label"], pdf["buckets"], pdf["times"]))
        if len(np.unique(got.labels)) == 2:
            scores, bias = train(got, smoothed)
            yield pd.DataFrame({"scores": [scores.astype(np.float32).tobytes()], "bias": [bias]})

    bagged = texts.mapInPandas(bags, "doc_id long, label int, buckets array<int>, times array<float>")
    model = bagged.repartition(1).sortWithinPartitions("doc_id").mapInPandas(learn, "scores binary, bias double").collect()
    if not model:
        return np.zeros(BUCKETS, np.float32), float(np.log(smoothed / (1 - smoothed)))
    return np.frombuffer(model[0]["scores"], np.float32), model[0]["bias"]


def with_score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
               out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in column ``out``."""
    small_batches(docs.sparkSession)
    table = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scores, bias = table.value
        mark = (len(scores), hash(scores.tobytes()))
        if mark not in _KNOWN:
            _KNOWN.clear()  # one model at a time
            _KNOWN[mark] = Words(scores)
        words, pair_scores = _KNOWN[mark], scores[PAIRS].astype(np.float64)
        for texts in batches:
            odds = []
            for t in texts:
                ids = words.of(t)
                if not len(ids):
                    odds.append(bias)
                    continue
                total = words.facts[ids].sum(0) + (pair_scores[words.pairs(ids)].sum(), len(ids) - 1)
                odds.append(bias + total[0] / total[1])
            yield pd.Series(1 / (1 + np.exp(-np.clip(odds, -30, 30))))

    return docs.withColumn(out, score(F.col(text_col)))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score and predicted (1 if the score reaches ``threshold``) for every row."""
    model = fit(docs, labels, id_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    return with_score(rows, model, "t").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, all columns as they are."""
    model, names = fit(docs, labels, id_col, text_col, **options), docs.columns
    rows = docs.select(F.struct(*[F.col(c).alias(f"in_{c}") for c in names]).alias("r"), F.col(text_col).alias("t"))
    return with_score(rows, model, "t").filter(F.col("score") >= threshold).select(
        *[F.col(f"r.in_{c}").alias(c) for c in names])
