"""Ranked lexical search: documents as an FP-tree of restricted term vectors, searched depth first with bounds."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.tables import landed

MOST = 10
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Items are searched in blocks of about so many terms; a task holds so many cells (documents x terms).
BLOCK_TERMS, CELLS = 20_000, 8_000_000
# A subtree of at most so many documents is not divided further: its documents are scored.
LEAF = 32

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _KEPT else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased."""
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Block:
    """Some items: their ids, each item's terms as numbers, and the number of every term of the block."""

    items: list
    wanted: list[np.ndarray]
    numbers: dict[bytes, int]

    @staticmethod
    def of(rows) -> Block:
        texts: dict = {}
        for item_id, text in rows:
            texts.setdefault(item_id, []).extend(terms(text))
        numbers: dict[bytes, int] = {}
        wanted = [np.array(sorted({numbers.setdefault(t, len(numbers)) for t in found}), np.int64) for found in texts.values()]
        return Block(list(texts), wanted, numbers)


def _vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), terms (numbers, different), tf of every document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = numbers.get
        for batch in batches:
            ids, sizes, offsets, found, counts = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                tf: dict[int, int] = {}
                for k in map(get, words):
                    if k is not None:
                        tf[k] = tf.get(k, 0) + 1
                ids.append(doc_id)
                sizes.append(len(words))
                found.extend(tf)
                counts.extend(tf.values())
                offsets.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v, pa.int32())) for v in (found, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score before its weight: it grows with tf and falls with m."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """Documents as a trie. A document is the sequence of its terms, most frequent first, so documents that share frequent
    terms share a path; paths without a branch are one step. Every node holds, for each term, the largest tf among its
    documents and their smallest m: no document below it can score more than these would."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, m: np.ndarray, tf: np.ndarray):
        """``tf``: documents x terms, the columns by falling frequency; ``known``: whether the id is one."""
        has = tf > 0
        # Equal prefixes are neighbours once documents are sorted by their vectors: a term that is there comes before one that is not.
        packed = np.packbits(~has, axis=1)
        order = np.lexsort((ids, *packed.T[::-1])) if packed.shape[1] else np.argsort(ids)
        self.ids, self.known, self.m, self.tf = ids[order], known[order], m[order], tf[order]
        has = has[order]
        # The column at which a document leaves the path of the one before it.
        differ = has[1:] != has[:-1]
        self.leaves = np.where(differ.any(1), differ.argmax(1), tf.shape[1]) if tf.shape[1] else np.zeros(len(differ), np.int64)
        self.first, self.last, self.children = [0], [len(ids)], [[]]
        self._grow()
        self.most = np.stack([self.tf[a:b].max(0) for a, b in zip(self.first, self.last)])
        self.least = np.array([self.m[a:b].min() for a, b in zip(self.first, self.last)])
        self.children = [np.array(c, np.int64) for c in self.children]

    def _grow(self) -> None:
        """Divide nodes where their documents' paths part, while they hold more than a leaf's documents."""
        at = 0
        while at < len(self.first):
            a, b = self.first[at], self.last[at]
            inner = self.leaves[a : b - 1]
            if b - a > LEAF and inner.min() < self.tf.shape[1]:
                edges = [a, *(a + 1 + np.flatnonzero(inner == inner.min())).tolist(), b]
            elif b - a > LEAF:  # equal vectors: no path parts, so any cut will do
                edges = [*range(a, b, LEAF), b]
            else:
                edges = []
            for low, high in zip(edges, edges[1:]):
                self.children[at].append(len(self.first))
                self.first.append(low)
                self.last.append(high)
                self.children.append([])
            at += 1

    def search(self, best: Best, columns: np.ndarray, weights: np.ndarray) -> None:
        """Depth first, the most promising child first; what cannot enter the best is not visited."""
        stack = [(0, None)]
        while stack:
            node, bound = stack.pop()
            if bound is not None and bound < best.least:
                continue
            below = self.children[node]
            if len(below):
                bounds = share(self.most[below[:, None], columns], self.least[below][:, None]) @ weights
                going = np.flatnonzero((bounds > 0) & (bounds >= best.least))
                stack.extend((int(below[i]), int(bounds[i])) for i in going[np.argsort(bounds[going], kind="stable")])
            else:
                a, b = self.first[node], self.last[node]
                scores = share(self.tf[a:b, columns], self.m[a:b, None]) @ weights
                for i in np.flatnonzero((scores > 0) & (scores >= best.least)).tolist():
                    best.add(int(scores[i]), int(self.ids[a + i]) if self.known[a + i] else None)


class Best:
    """The highest scores met so far; of equal ones those with the smaller ids, an unknown id being the largest."""

    def __init__(self, most: int):
        self.most, self.heap, self.least = most, [], 0

    def add(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if len(self.heap) < self.most:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)
        if len(self.heap) == self.most:
            self.least = self.heap[0][0]


def _ranked(vectors: DataFrame, block: Block, order: np.ndarray, weights: np.ndarray, total: int, length: int, most: int) -> DataFrame:
    """item (number in the block), doc_id, score: the best of every task."""
    width = len(order)
    column_of = np.empty(width, np.int64)
    column_of[order] = np.arange(width)
    items = [(i, column_of[t], weights[t]) for i, t in enumerate(block.wanted) if len(t)]
    rows = max(2 * LEAF, CELLS // max(width, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(most) for _ in block.items]
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found, counts = part.column("terms"), part.column("tf")
                lengths = np.diff(found.offsets.to_numpy())
                tf = np.zeros((part.num_rows, width), np.int32)
                tf[np.repeat(np.arange(part.num_rows), lengths), column_of[found.flatten().to_numpy()]] = counts.flatten().to_numpy()
                n = part.column("n").to_numpy()
                ids = part.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                tree = Tree(ids.fill_null(0).to_numpy(), known, 10 + (90 * n * total) // length, tf)
                for i, columns, w in items:
                    tree.search(best[i], columns, w)
        out = [(i, -d if known else None, s) for i, b in enumerate(best) for s, known, d in b.heap]
        columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else ([], [], []), (pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``most`` best documents of every item.

    Items come in blocks of bounded vocabulary (their number grows with the items, and each block reads the documents once);
    the driver holds one block at a time. Per block, documents are reduced to the counts of the block's terms and landed;
    document frequencies come from all of them. Every task then keeps building trees over its documents, as many as fit
    ``CELLS``, and searches each for all items with the scores reached so far; the best of all tasks are ranked.

    A null text has no term; a document without terms counts nowhere. A document with null doc_id counts, and is the last
    among equal scores. Rows with one item_id (null too) are one item with all their terms; an item without terms has no
    rows. Equal rows of documents are ranked one by one. Other columns are not looked at.
    """
    spark = docs.sparkSession
    items = items.select("item_id", "text")
    size = items.agg(F.sum(F.regexp_count("text", F.lit(TERM)))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_TERMS))
    results = []
    for b in range(blocks):
        block = Block.of(items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect())
        if not block.numbers:
            continue
        vectors = landed(_vectors(docs, block.numbers), "vectors")
        total, length = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        df = np.zeros(len(block.numbers), np.int64)
        for term, n in held:
            df[term] = n
        weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        if not total:
            continue
        found = _ranked(vectors, block, np.argsort(-df, kind="stable"), weights, total, length, most)
        names = spark.createDataFrame(list(enumerate(block.items)), "item int, item_id long")
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
        results.append(landed(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole


def oracle() -> str:
    """The query as DuckDB SQL, scoring all documents."""
    found = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '" + TERM + "')"
    return f"""
    WITH words AS (SELECT row_number() OVER () AS r, doc_id, {found.format("text")} AS t FROM documents WHERE text IS NOT NULL
    ), texts AS (SELECT r, doc_id, t, len(t) AS n FROM words WHERE len(t) > 0
    ), size AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM texts
    ), wanted AS (SELECT DISTINCT item_id, unnest({found.format("text")}) AS term FROM benchmark
    ), held AS (
        SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM texts)
        WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * total + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, size GROUP BY term, total
    ), scores AS (
        SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // length)))) AS BIGINT) AS score
        FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN texts USING (r), size GROUP BY item_id, r
    ), ranked AS (
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
        FROM scores JOIN texts USING (r) WHERE score > 0
    )
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {MOST}
    """
