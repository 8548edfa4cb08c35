"""Quality rules: counted facts first, then a hashed n-gram model with calibrated probabilities and a fixed threshold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.memo import Memo, per_batch, rows_where

# Words are stretches without space, tab, newline, vertical tab, form feed and carriage return: what bytes.split() yields.
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
KEEP_FROM = 0.5
BITS = 18
CHAR_SIZES = (2, 3, 4)
# At most so many labelled rows of each class are trained on.
ROWS_PER_CLASS = 1000
WORDS = 200_000
# Pairs of a place and a share that the fit works on at once.
CHUNK = 1 << 17
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def word_codes(data: bytes) -> tuple[list[bytes], np.ndarray]:
    """The different words in order of appearance, and the place of every word among them."""
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in data.split()]
    return list(numbers), np.array(codes, np.int64)


def repeated_words(codes: np.ndarray, different: int) -> int:
    """Words inside a window of three words that occurs at least twice; overlapping windows count a word once."""
    if len(codes) < 4:
        return 0
    if different < 1 << 21:  # three codes fit 63 bits
        windows = (codes[:-2] * different + codes[1:-1]) * different + codes[2:]
    else:
        pairs = np.unique(codes[:-2] * different + codes[1:-1], return_inverse=True)[1]
        windows = pairs * different + codes[2:]
    _, which, found = np.unique(windows, return_inverse=True, return_counts=True)
    again = found[which] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def counts(text: str | None, codes: np.ndarray, different: int) -> tuple[int, ...]:
    """COUNTS of a text whose words are known."""
    text = text or ""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(codes),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(codes, different),
    )


class Features:
    """N-grams hashed to places: n-grams of code points of the text in one half, words and word pairs in the other. A document's
    features are the shares of its n-grams, so neither its length nor its neighbours in a batch matter."""

    def __init__(self):
        self.hashes = Memo(xxhash.xxh32_intdigest, WORDS)

    def places(self, text: str, words: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint32(32 - BITS)
        b, chars = np.frombuffer(text.encode("utf-32-le"), np.uint32), []
        for size in CHAR_SIZES:
            if len(b) >= size:
                h = np.full(len(b) - size + 1, size, np.uint32)
                for i in range(size):
                    h = h * np.uint32(0x01000193) + b[i : len(b) - size + 1 + i]
                chars.append((h * np.uint32(0x9E3779B1)) >> shift)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint32, len(words))[codes]
        self.hashes.trim()
        pairs = (h[:-1] * np.uint32(0x85EBCA6B) + h[1:]) * np.uint32(0x9E3779B1)
        both = (np.concatenate([h * np.uint32(0x9E3779B1), pairs]) >> shift) + np.uint32(1 << BITS)
        return (np.concatenate(chars) if chars else np.zeros(0, np.uint32)), both


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, char_places: np.ndarray, word_places: np.ndarray) -> float:
        """The calibrated probability that a document is good."""
        z = self.bias
        for places in (char_places, word_places):
            if len(places):
                z += float(self.weights[places].mean(dtype=np.float64))
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slope * z + self.shift, -50, 50))))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """doc_id, text, good: of each class at most ``rows_per_class`` labelled documents, those with the smallest hashes of
    their doc_id. Documents with contradicting labels, null labels or null text take no part; of rows with one doc_id, the
    smallest text does."""
    agreed = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("good"), F.max("quality").alias("most"))
        .filter("good = most")
        .drop("most")
    )
    few = [agreed.filter(F.col("good") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class) for v in (0, 1)]
    chosen = F.broadcast(few[0].unionByName(few[1]))  # 2 * rows_per_class rows of two numbers
    return (
        docs.select("doc_id", "text").filter("text IS NOT NULL").join(chosen, "doc_id")
        .groupBy("doc_id", "good").agg(F.min("text").alias("text"))
    )


def _feature_rows(sample: DataFrame) -> DataFrame:
    def start():
        features = Features()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            places, values = [], []
            for text in batch.column("text"):
                text = text.as_py()
                at, share = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
                for found in features.places(text, *word_codes(text.encode())):
                    if len(found):
                        u, n = np.unique(found, return_counts=True)
                        at.append(u.astype(np.int64))
                        share.append((n / len(found)).astype(np.float32))
                places.append(np.concatenate(at).astype(np.int32))
                values.append(np.concatenate(share))
            lists = [pa.array(places, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("good"), *lists], ["doc_id", "good", "places", "shares"]
            )

        return work

    rows = sample.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(good AS int) AS good", "text")
    return per_batch(rows, start, "doc_id long, good int, places array<int>, shares array<float>")


@dataclass
class Sparse:
    """Rows of (place, share) pairs, one after the other."""

    good: np.ndarray
    lengths: np.ndarray
    places: np.ndarray
    shares: np.ndarray

    @staticmethod
    def of(table: pa.Table, rows: np.ndarray) -> Sparse:
        """The given rows of a table in this order, copied one at a time."""
        lengths = pa.compute.list_value_length(table.column("places")).to_numpy()[rows]

        def flat(name: str, kind: type) -> np.ndarray:
            column, values, end = table.column(name), np.empty(lengths.sum(), kind), 0
            for i, n in zip(rows.tolist(), lengths.tolist()):
                values[end : end + n] = column[i].values.to_numpy()
                end += n
            return values

        good = table.column("good").to_numpy()[rows].astype(np.float64)
        return Sparse(good, lengths, flat("places", np.int32), flat("shares", np.float32))

    def parts(self) -> Iterator[tuple[slice, slice]]:
        """Stretches of rows with about CHUNK pairs, and their pairs: what is made of pairs is never made of all at once."""
        ends = np.cumsum(self.lengths)
        first = at = 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, at + CHUNK, side="right")))
            yield slice(first, last), slice(at, int(ends[last - 1]))
            first, at = last, int(ends[last - 1])

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Each row's shares times weights. No row is empty: every text in it has a byte."""
        total = np.empty(len(self.lengths))
        for rows, pairs in self.parts():
            products = weights[self.places[pairs]]
            products *= self.shares[pairs]
            n = self.lengths[rows]
            total[rows] = np.add.reduceat(products, np.cumsum(n) - n, dtype=np.float64)
        return total

    def spread(self, by_row: np.ndarray) -> np.ndarray:
        """Per place the sum of its shares times a number of their row."""
        total = np.zeros(2 << BITS)
        for rows, pairs in self.parts():
            steps = np.repeat(by_row[rows].astype(np.float32), self.lengths[rows])
            steps *= self.shares[pairs]
            np.add.at(total, self.places[pairs].astype(np.intp), steps.astype(np.float64))
        return total

    def importance(self) -> np.ndarray:
        """Both classes weigh the same."""
        return np.where(self.good == 1, 0.5 / max(self.good.sum(), 1), 0.5 / max((1 - self.good).sum(), 1))


def _descend(rows: Sparse, rounds: int = 150, rate: float = 2.0, keep: float = 1e-6) -> tuple[np.ndarray, float]:
    """Logistic regression by gradients with a rate per weight."""
    importance = rows.importance()
    weights, bias, past, past_bias = np.zeros(2 << BITS), 0.0, np.full(2 << BITS, 1e-12), 1e-12
    for _ in range(rounds):
        z = rows.sums(weights) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - rows.good) * importance
        gradient = rows.spread(error) + keep * weights
        past += gradient**2
        weights -= rate * gradient / np.sqrt(past)
        past_bias += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(past_bias)
    return weights, bias


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model | None:
    """Fit on the bounded sample, calibrate on the quarter of it that the fit did not see.

    Only sparse shares of at most ``2 * rows_per_class`` documents reach the driver. The calibration (a slope and a shift of
    the model's logit) maximises the held-out likelihood, both classes weighing the same. Without two documents of either
    class in both parts there is no model.
    """
    rows = _feature_rows(labelled_sample(docs, labels, rows_per_class).filter("text <> ''")).toArrow()
    ids = rows.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    held = np.array([xxhash.xxh32_intdigest(str(i)) % 4 == 0 for i in ids[order].tolist()], bool)
    fitted, check = Sparse.of(rows, order[~held]), Sparse.of(rows, order[held])
    if any((part.good == v).sum() < 2 for part in (fitted, check) for v in (0, 1)):
        return None
    del rows
    pa.default_memory_pool().release_unused()
    weights, bias = _descend(fitted)
    del fitted
    z, good, importance = check.sums(weights) + bias, check.good, check.importance()
    # Platt's targets keep a perfectly split sample from an infinite slope.
    target = np.where(good == 1, (good.sum() + 1) / (good.sum() + 2), 1 / ((1 - good).sum() + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(slope * z + shift, -50, 50)))
        error, curve = (p - target) * importance, np.maximum(p * (1 - p), 1e-9) * importance
        gradient = np.array([error @ z, error.sum()])
        hessian = np.array([[curve @ z**2, curve @ z], [curve @ z, curve.sum()]]) + 1e-6 * np.eye(2)
        step = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        slope, shift = slope - step[0], shift - step[1]
    return Model(weights.astype(np.float32), bias, max(slope, 0.0), shift)


def verdict(text: str | None, features: Features, model: Model | None, keep_from: float) -> tuple:
    """The counts, whether the base rule fails, whether the document is kept, the probability that it is good."""
    text = text or ""
    words, codes = word_codes(text.encode())
    found = counts(text, codes, len(words))
    failed = found[0] < LEAST_WORDS or 100 * found[4] > MOST_REPEATED_PERCENT * found[0]
    score = model.probability(*features.places(text, words, codes)) if model else 1.0
    return *found, failed, not failed and score >= keep_from, score


def judge(docs: DataFrame, model: Model | None, keep_from: float = KEEP_FROM) -> DataFrame:
    """Per document its counts, the base rule, the probability that it is good, and the verdict.

    The base rule rejects documents of fewer than 50 words (null text has none) and those with over half of their words in
    repeated windows. Of the others the model rejects those below ``keep_from``; without a model it rejects none.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        features, model = Features(), held.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [verdict(t.as_py(), features, model, keep_from) for t in batch.column("text")]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else [[]] * 8, kinds)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", *COUNTS, "base_failed", "kept", "score"]
            )

        return work

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, score double"
    return per_batch(docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text"), start, schema)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs, train(docs, labels))


def keep_good(docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents that pass base rule and model, as they are."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def start():
        features, model = Features(), held.value
        return lambda batch: [verdict(t.as_py(), features, model, keep_from)[-2] for t in batch.column("text")]

    return rows_where(docs, start)
