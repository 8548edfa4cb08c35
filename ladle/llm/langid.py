"""Language identification: known words by their frequency in each language, unknown ones by ever shorter n-grams."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.memo import per_batch, rows_where

LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"
# About so many different texts of each language are learned from.
DOCS_PER_LANG = 2000
# Of each language its most frequent words and n-grams are kept: an equal share of these numbers, but never fewer than LEAST.
WORDS, GRAMS, LEAST = 50_000, 100_000, 1_000
SIZES = (5, 4, 3, 2, 1)
HELD_OUT = 2
SMOOTH = 0.5
# Documents whose language is less certain than this are not kept.
KEEP_FROM = 0.5
# Looked-up words of a task are held in a table of at most so many numbers.
TABLE = 1 << 21
SLICE = 20_000


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id in decimal, mod 4. Null for a null doc_id, which is neither held out nor learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def grams(word: str, size: int) -> list[str]:
    """Its n-grams, with the word's ends marked (a single character is never a mark)."""
    marked = word if size == 1 else f"^{word}$"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """lang, text: about ``docs_per_lang`` different texts of each language, from documents that may be learned from.

    The rate of a language follows from an estimate of its different texts over all documents, and a hash of the text tells
    who is taken, so copies are taken or left together and count once. Of copies that of the smallest doc_id is read; only
    hashes and ids are grouped. The driver holds one rate per language.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    usable = usable.filter((fold(F.col("doc_id")) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    usable = usable.withColumn("key", F.xxhash64("text"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()
    if not counts:
        return usable.select("lang", "text")
    rates = F.create_map(*[F.lit(v) for r in counts for v in (r["lang"], docs_per_lang / max(r["n"], 1))])
    drawn = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))
    taken = usable.filter(drawn < F.element_at(rates, F.col("lang")))
    firsts = taken.groupBy("lang", "key").agg(F.min("doc_id").alias("doc_id"))
    found = taken.join(firsts, ["lang", "key", "doc_id"], "left_semi")
    return found.groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", "text")


def _word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, n. Words are runs of letters in lower case."""

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found.update((lang, w) for w in LETTERS.findall(text.as_py().lower()))
            langs, words = zip(*found) if found else ((), ())
            columns = [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        return work

    counted = per_batch(texts.select("lang", "text"), start, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    """lang, size, word (the n-gram), n."""

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found: Counter = Counter()
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                for size in SIZES:
                    for gram in grams(word, size):
                        found[lang, size, gram] += n
            langs, sizes, names = zip(*found) if found else ((), (), ())
            columns = [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(names, pa.string())]
            columns.append(pa.array(list(found.values()), pa.int64()))
            return pa.RecordBatch.from_arrays(columns, ["lang", "size", "word", "n"])

        return work

    counted = per_batch(words.select("lang", "word", "n"), start, "lang string, size int, word string, n long")
    return counted.groupBy("lang", "size", "word").agg(F.sum("n").alias("n"))


def _most_frequent(counts: DataFrame, langs: int, most: int, *key: str) -> pd.DataFrame:
    """lang, key, n of the entries that are among the most frequent of some language and were seen at least twice."""
    share = max(most // langs, LEAST)
    seen = counts.join(counts.groupBy(*key).agg(F.sum("n").alias("total")).filter("total > 1").drop("total"), list(key))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), *key))
    chosen = seen.withColumn("nth", nth).filter(F.col("nth") <= share).select(*key).distinct()
    return seen.join(chosen, list(key), "left_semi").select("lang", *key, "n").toArrow().to_pandas()


@dataclass
class Model:
    """Per word and per n-gram its row of ``voices``: the log frequency in each language, less the mean over languages."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    voices: np.ndarray

    def word(self, word: str) -> np.ndarray:
        """A known word by its frequencies. Else at each place the longest known n-gram speaks, and the word's voice is the
        mean over its places: a place falls back to shorter ones until one is known, down to single letters."""
        known = self.words.get(word)
        if known is not None:
            return self.voices[known]
        rows, marked, grams = [], f"^{word}$", self.grams
        for i in range(len(marked) - 1):
            for size in SIZES:
                gram = marked[i : i + size] if size > 1 else marked[max(i, 1)]
                if len(gram) == size and (row := grams.get(gram)) is not None:
                    rows.append(row)
                    break
        if not rows:
            return np.zeros(len(self.langs), np.float32)
        return np.add.reduce(self.voices[rows], axis=0) / len(rows)


def train(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> Model:
    """Learn from a bounded sample. The words and n-grams that reach the driver are bounded per language, so no language is
    crowded out by others, however many there are. Null lang is not learned; without any lang the model is empty."""
    words = _word_counts(sample(docs, docs_per_lang)).checkpoint()
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    if not langs:
        return Model([], {}, {}, np.zeros((0, 0), np.float32))
    number = {lang: i for i, lang in enumerate(langs)}

    def centred(table: pd.DataFrame) -> tuple[list[str], np.ndarray]:
        rows, names = pd.factorize(table["word"], sort=True)
        n = np.full((len(names), len(langs)), SMOOTH)
        n[rows, table["lang"].map(number)] += table["n"]
        logs = np.log(n / n.sum(axis=0))
        return list(names), (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)

    known, voice = centred(_most_frequent(words, len(langs), WORDS, "word"))
    names: list[str] = []
    voices = [voice]
    for _, table in _most_frequent(_gram_counts(words), len(langs), GRAMS, "size", "word").groupby("size"):
        some, voice = centred(table)
        names += some
        voices.append(voice)
    grams_at = {name: len(known) + i for i, name in enumerate(names)}
    return Model(langs, {w: i for i, w in enumerate(known)}, grams_at, np.concatenate(voices))


class Scorer:
    """Sums the voices of a text's words. Stretches without white space are looked up once and remembered by number, in a
    table that is emptied when full; a text is read in slices, so its length is no matter."""

    def __init__(self, model: Model):
        self.model, width = model, len(model.langs) + 1
        self.size = max(2 * SLICE, TABLE // width)
        self.table = np.zeros((self.size, width), np.float32)
        self.numbers: dict[str, int] = {}

    def _number(self, stretch: str) -> int:
        number = self.numbers.get(stretch)
        if number is None:
            number = self.numbers[stretch] = len(self.numbers)
            low = stretch.lower()
            row = self.model.words.get(low)
            if row is not None:
                self.table[number, :-1] = self.model.voices[row]
                self.table[number, -1] = 1
                return number
            words = LETTERS.findall(low)
            self.table[number] = 0
            for word in words:
                self.table[number, :-1] += self.model.word(word)
            self.table[number, -1] = len(words)
        return number

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the confidence: a softmax of the summed voices over the root of the number of words. Ties go to
        the language that comes first by name. A text with letters gets a learned language, whatever they are."""
        stretches = (text or "").split()
        total = np.zeros(len(self.model.langs) + 1)
        for i in range(0, len(stretches), SLICE):
            if len(self.numbers) > self.size - SLICE:
                self.numbers.clear()
            part = [self._number(s) for s in stretches[i : i + SLICE]]
            total += self.table[part].sum(axis=0, dtype=np.float64)
        if not total[-1] or not self.model.langs:
            return UNKNOWN, 0.0
        z = total[:-1] / np.sqrt(total[-1])
        p = np.exp(z - z.max())
        return self.model.langs[int(z.argmax())], float(p.max() / p.sum())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every document. Null text, text without a letter, or a model without languages: und, 0."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        scorer = Scorer(held.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [scorer.predict(t.as_py()) for t in batch.column("text")]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *columns], ["doc_id", "held_out", "lang_pred", "score"]
            )

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "text",
    )
    return per_batch(rows, start, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then predict every document from its text alone. Repeated rows give
    repeated results, an empty table none; null text, empty text and text without a letter are ``und``."""
    return identify(docs, train(docs))


def keep_identified(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents whose language is known with some certainty, as they are. Null text, empty text and text without a letter
    go; other columns, whatever their names, stay untouched."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs))

    def start():
        scorer = Scorer(held.value)

        def keep(batch: pa.RecordBatch) -> list[bool]:
            found = [scorer.predict(t.as_py()) for t in batch.column("text")]
            return [lang != UNKNOWN and score >= keep_from for lang, score in found]

        return keep

    return rows_where(docs, start)
