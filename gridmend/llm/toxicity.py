"""Toxicity scores: character n-gram embeddings, averaged over a document's words, in a linear softmax."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmend.llm import words
from gridmend.llm.tables import saved
from gridmend.shipping import ship

#: The classifier is fitted on at most so many labelled documents of each label.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
BUCKETS, DIMENSIONS, GRAMS, LONG = 1 << 16, 8, (3, 4, 5), 40
EPOCHS, STEPS, BATCH, RATE, DECAY, SEED = 10, 800, 32, 0.05, 1e-5, 7
MARKS = " .,;:!?\"'()[]{}<>"


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(word numbers, words of each text, distinct words): lower case, without marks around them."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    owner = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    flat = pc.dictionary_encode(pc.list_flatten(split))
    clean = pc.dictionary_encode(pc.utf8_trim(pc.utf8_lower(flat.dictionary), MARKS))
    codes = clean.indices.to_numpy(zero_copy_only=False)[flat.indices.to_numpy(zero_copy_only=False)]
    names = clean.dictionary.to_pylist()
    if "" in names:  # nothing but marks
        full = codes != names.index("")
        codes, owner = codes[full], owner[full]
    return codes.astype(np.int64), np.bincount(owner, minlength=len(texts)), names


def subwords(names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, buckets) of the n-grams of ``<word>`` and of the whole, in vectorised portions."""
    lengths = np.fromiter(map(len, names), dtype=np.int64, count=len(names)) + 2
    short = np.flatnonzero(lengths <= LONG).astype(np.int32)
    for i in np.flatnonzero(lengths > LONG):
        yield from _long_word(int(i), f"<{names[i]}>")
    for rows in (short[lengths[short] <= 12], short[lengths[short] > 12]):
        if not len(rows):
            continue
        width = int(lengths[rows].max())
        text = np.array([f"<{names[i]}>" for i in rows], dtype=f"U{width}")
        chars = text.view(np.uint32).reshape(len(rows), width).astype(np.uint64)
        long = lengths[rows]
        for n in (*GRAMS, 0):  # 0: the word itself
            spans = range(1) if n == 0 else range(width - n + 1)
            for j in spans:
                span = chars if n == 0 else chars[:, j : j + n]
                value = np.full(len(rows), 1469598103934665603 + n, np.uint64)
                for k in range(span.shape[1]):
                    value = (value ^ span[:, k]) * np.uint64(1099511628211)
                inside = np.flatnonzero(long >= j + n) if n else np.arange(len(rows))
                yield np.asarray(rows)[inside], _buckets(value[inside])


def _long_word(number: int, word: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As ``subwords`` for one word of any length, all its n-grams of a size at once."""
    chars = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    for n in GRAMS:
        value = np.full(len(chars) - n + 1, 1469598103934665603 + n, np.uint64)
        for k in range(n):
            value = (value ^ chars[k : k + len(value)]) * np.uint64(1099511628211)
        yield np.full(len(value), number, np.int32), _buckets(value)
    places = (np.arange(len(chars), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    yield np.array([number], np.int32), _buckets(((chars * np.uint64(1099511628211)) ^ places).sum(keepdims=True) * np.uint64(0x94D049BB133111EB))


def _buckets(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (value >> np.uint64(48)).astype(np.uint16)  # BUCKETS of them


@dataclass
class Model:
    """What a linear softmax over averages comes to, a number for each bucket, and the calibration of its margin."""

    weights: np.ndarray
    terms: np.ndarray

    def word_scores(self, names: list[str]) -> np.ndarray:
        total, count = np.zeros(len(names)), np.zeros(len(names))
        for rows, buckets in subwords(names):
            if len(rows) > 1 and rows[0] == rows[-1]:  # the n-grams of one long word
                total[rows[0]] += self.weights[buckets].sum()
                count[rows[0]] += len(rows)
                continue
            total[rows] += self.weights[buckets]  # every portion has a word once
            count[rows] += 1
        return total / np.maximum(count, 1)

    def terms_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the average over each text's words with what its certainty depends on, number of words)."""
        codes, counts, names = bags(texts)
        n = np.maximum(counts, 1)
        sums = np.add.reduceat(np.append(self.word_scores(names)[codes], 0.0), np.minimum(words.offsets(counts)[:-1], len(codes)))
        mean = np.where(counts > 0, sums / n, 0.0)
        return np.stack([mean, mean * np.sqrt(n) / 10, np.log(n), np.ones(len(n))], axis=1), counts

    @property
    def usable(self) -> bool:
        return bool(self.weights.any())

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.usable:
            return np.zeros(len(texts))
        terms, counts = self.terms_of(texts)
        return np.where(counts > 0, 1 / (1 + np.exp(-np.clip(terms @ self.terms, -40, 40))), 0.0)


def calibrated(texts: pa.Array, labels: np.ndarray, toxic_share: float) -> Model:
    """A model trained on four fifths of a sample and calibrated on the rest.

    An average over many words is surer than one over few, so the chance is a logistic regression on the average, the
    average times the root of the number of words, and that number's logarithm, with labels weighted as
    where ``toxic_share`` of the documents are toxic.
    """
    rest = np.arange(len(labels)) % 5 == 0
    if len(set(labels[rest])) < 2 or len(set(labels[~rest])) < 2:  # too few of a label to part them
        rest = np.ones(len(labels), bool)
        model = Model(train(texts, labels), np.zeros(4))
    else:
        model = Model(train(texts.filter(pa.array(~rest)), labels[~rest]), np.zeros(4))
    terms, counts = model.terms_of(texts.filter(pa.array(rest)))
    terms, toxic = terms[counts > 0], labels[rest][counts > 0]
    share = np.where(toxic == 1, toxic_share, 1 - toxic_share) / np.maximum(np.bincount(toxic, minlength=2), 1)[toxic]
    scale = np.maximum(terms.std(axis=0), 1e-9)
    scale[-1] = 1
    fitted = np.zeros(4)
    for _ in range(50):  # Newton's method with a small ridge
        chance = 1 / (1 + np.exp(-np.clip(terms / scale @ fitted, -30, 30)))
        slope = (terms / scale).T @ (share * (chance - toxic)) + 1e-4 * fitted
        bend = (terms / scale).T @ ((share * chance * (1 - chance))[:, None] * terms / scale) + 1e-4 * np.eye(4)
        fitted -= np.linalg.solve(bend, slope)
    return Model(model.weights, fitted / scale)


def train(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    """Embeddings of the buckets and the softmax over their averages, trained jointly by Adam on minibatches.

    Both labels weigh the same in sum.
    """
    codes, counts, names = bags(texts)
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    soft, bias = rng.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)
    word, bucket = (np.concatenate(p) for p in zip(*subwords(names)))
    per_word = np.bincount(word, minlength=len(names))
    bucket = bucket[np.argsort(word, kind="stable")]
    del word
    word_at, text_at = words.offsets(per_word), words.offsets(counts)
    balance = len(labels) / 2 / np.maximum(np.bincount(labels, minlength=2), 1)
    moments = [np.zeros_like(table), np.zeros_like(table)], [np.zeros_like(soft), np.zeros_like(soft)], [np.zeros(2), np.zeros(2)]
    step, batches = 0, max(1, len(labels) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // batches))
    for epoch in range(epochs):
        for some in np.array_split(rng.permutation(len(labels)), batches):
            step += 1
            rows = words.ragged(text_at[some], counts[some])
            pair, times = np.unique(np.repeat(np.arange(len(some)), counts[some]) * len(names) + codes[rows], return_counts=True)
            text, name = pair // len(names), pair % len(names)
            grams = bucket[words.ragged(word_at[name], per_word[name])]
            text_of = np.repeat(text, per_word[name])
            share = np.repeat(times / per_word[name], per_word[name]) / np.maximum(counts[some], 1)[text_of]
            used, at = np.unique(grams, return_inverse=True)
            matrix = np.bincount(text_of * len(used) + at, weights=share, minlength=len(some) * len(used)).reshape(len(some), len(used))
            mean = matrix @ table[used]
            logits = mean @ soft + bias
            chance = np.exp(logits - logits.max(1, keepdims=True))
            chance /= chance.sum(1, keepdims=True)
            error = chance.copy()
            error[np.arange(len(some)), labels[some]] -= 1
            error *= balance[labels[some], None] / len(some)
            rate = RATE * (1 - epoch / epochs) * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for values, slots, gradient, where in (
                (table, moments[0], matrix.T @ (error @ soft.T), used), (soft, moments[1], mean.T @ error, slice(None)), (bias, moments[2], error.sum(0), slice(None)),
            ):
                gradient = gradient + DECAY * values[where]
                slots[0][where] = 0.9 * slots[0][where] + 0.1 * gradient
                slots[1][where] = 0.999 * slots[1][where] + 0.001 * gradient**2
                values[where] -= rate * slots[0][where] / (np.sqrt(slots[1][where]) + 1e-8)
    return table @ (soft[:, 1] - soft[:, 0])


def in_fold(doc_id, fold: int = 5):
    """Whether a document is held out: crc32 of its id as text is divisible by ``fold``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % fold == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, fold: int = 5) -> Model:
    """A model from labelled documents outside the held-out fold. Actions.

    The sample is bounded (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents) and chosen by a hash of doc_id; one task trains on it
    in numpy and returns the table of bucket weights. Labels of one value only, or none, give a model that scores every document 0.
    """
    spark = documents.sparkSession
    ship(spark)
    usable = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~in_fold(F.col("doc_id"), fold))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    many = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = usable.where("toxic = 1").orderBy(*order).limit(SAMPLE_TOXIC).unionAll(usable.where("toxic = 0").orderBy(*order).limit(SAMPLE_CLEAN))
    texts = documents.select("doc_id", "text").where("text IS NOT NULL AND doc_id IS NOT NULL")
    sample = texts.join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id"))
    # A repeated doc_id must not bring more documents than the bound.
    sample = sample.groupBy("_id", "toxic").agg(F.min("text").alias("text"))
    sample = saved(sample.select(F.xxhash64("_id").alias("at"), F.col("_id").alias("id"), "text", "toxic"), "toxic-sample")
    share = many.get(1, 0) / max(1, sum(many.values()))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        rows = pa.Table.from_batches(parts) if parts else None
        if rows is not None and len(set(rows["toxic"].to_pylist())) == 2:
            model = calibrated(rows["text"].combine_chunks(), rows["toxic"].to_numpy().astype(np.int64), share)
            yield pa.RecordBatch.from_pydict({"weights": [model.weights.tolist()], "terms": [model.terms.tolist()]})

    trained = sample.repartitionByRange(1, "at", "id").sortWithinPartitions("at", "id").select("text", "toxic").mapInArrow(learn, "weights array<double>, terms array<double>")
    found = trained.first()
    return Model(np.zeros(BUCKETS), np.zeros(4)) if found is None else Model(np.array(found["weights"]), np.array(found["terms"]))


def score(documents: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``documents`` and the chance that each is toxic, from its whole text; 0 for a NULL text, one without words and a model without labels.

    A column called ``column`` is replaced; all others are kept as they are.
    """
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    documents = documents.drop(column)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(batch["text"]))], names=[*batch.schema.names, column])

    schema = T.StructType([*documents.schema.fields, T.StructField(column, T.DoubleType())])
    return documents.mapInArrow(scored, schema)
