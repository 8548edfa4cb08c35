"""Substring dedup on a De Bruijn graph: long passages that repeat across documents, and documents without them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.memo import Memo
from ladle.llm.ngram_join import Filter
from ladle.llm.tables import landed

# An edge of the graph is a window of so many words, a node the words that two windows in a row share.
WINDOW = 50
# Windows are looked for by the least hash of the stretches of 16 words in them: 35 stretches, of which about one in 18 is kept.
STRETCH = 16
WORDS = 200_000
BATCH_ROWS = 200_000
NOTHING = hashlib.sha256(b"").hexdigest()

_M, _N = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _doubled(w: np.ndarray, base: int) -> dict[int, np.ndarray]:
    """Polynomial hashes of all stretches of 1, 2, 4 ... 32 words."""
    h = {1: w}
    for n in (1, 2, 4, 8, 16):
        h[2 * n] = h[n][:-n] * _power(base, n) + h[n][n:]
    return h


def _whole(h: dict[int, np.ndarray], base: int, count: int) -> np.ndarray:
    """Hashes of the windows: 50 = 32 + 16 + 2 words."""
    return (h[32][:count] * _power(base, 16) + h[16][32 : 32 + count]) * _power(base, 2) + h[2][48 : 48 + count]


class Windows:
    """The windows of one text's words, by arrays: ``anchors`` holds the least stretch of each window."""

    def __init__(self, w: np.ndarray):
        self.w, self.count = w, len(w) - WINDOW + 1
        self.h = _doubled(w, _M)
        least = _spread(self.h[STRETCH])
        for n in (1, 2, 4, 8, 16):
            least = np.minimum(least[:-n], least[n:])
        # 32 stretches and 32 from the fourth on make the 35 of a window.
        self.anchors = np.minimum(least[: self.count], least[3 : 3 + self.count])

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of every window, 64 and 31 bits."""
        other = _doubled(_spread(self.w), _N)
        return _spread(_whole(self.h, _M, self.count)), _spread(_whole(other, _N, self.count)) >> np.uint64(33)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _hasher():
    hashes = Memo(xxhash.xxh3_64_intdigest, WORDS)

    def hashed(words: list[bytes]) -> np.ndarray:
        w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
        hashes.trim()
        return w

    return hashed


def _key(words: list[bytes]) -> bytes:
    """128 bits that name a sequence of words."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def _row(key: bytes) -> int:
    """64 bits of a key: they tell apart documents of one doc_id."""
    return int.from_bytes(key[:8], "little", signed=True)


def profiles(docs: DataFrame) -> DataFrame:
    """doc_id, key (equal for equal word sequences), row, n_words, words_sha256, anchors of every document, landed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _hasher()
        for batch in batches:
            keys, rows, sizes, digests, anchors, offsets, total = [], [], [], [], [], [0], 0
            for text in batch.column("text"):
                words = _words(text.as_py())
                joined = b" ".join(words)
                keys.append(xxhash.xxh3_128_digest(joined))
                rows.append(_row(keys[-1]))
                sizes.append(len(words))
                digests.append(hashlib.sha256(joined).hexdigest())
                if len(words) >= WINDOW:
                    anchors.append(np.unique(Windows(hashed(words)).anchors))
                    total += len(anchors[-1])
                offsets.append(total)
            flat = np.concatenate(anchors).view(np.int64) if anchors else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(rows, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), lists],
                ["doc_id", "key", "row", "n_words", "words_sha256", "anchors"],
            )

    schema = "doc_id long, key binary, row long, n_words long, words_sha256 string, anchors array<long>"
    return landed(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema), "profiles")


def suspects(docs: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, text, anchors (those met in several documents) of the documents that hold such an anchor, landed. ``anchors``:
    doc_id, anchor. A filter of bounded size spares most other texts the shuffle; the join decides."""
    held = anchors.groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    held = landed(held.withColumn("mark", F.xxhash64("doc_id")), "held")
    filter_ = docs.sparkSession.sparkContext.broadcast(Filter.of(held, F.col("mark")))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(filter_.value.holds(batch.column("mark").to_numpy().view(np.uint64)), pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("doc_id").cast("long")).alias("mark")).filter("doc_id IS NOT NULL")
    texts = texts.mapInArrow(near, "doc_id long, text string, mark long").drop("mark")
    return landed(texts.join(held.drop("mark"), "doc_id"), "suspects")


def occurrences(found: DataFrame) -> DataFrame:
    """Edges where they occur: edge and tag (its two hashes), doc_id, row, pos (its first word), before (hash of the word in
    front) and after (the next edge), both null where the edge beside it is no candidate. Candidates are the windows whose
    own anchor was met in several documents; a window that repeats has an anchor that does."""
    names = ["edge", "tag", "doc_id", "row", "pos", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = _hasher()
        held, n = [], 0

        def flush():
            columns = [pa.concat_arrays(c) for c in zip(*held)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "text", "anchors")]
            for doc_id, text, anchors in zip(*columns):
                words = _words(text.as_py())
                if len(words) < WINDOW:
                    continue
                windows = Windows(hashed(words))
                wanted = np.sort(anchors.values.to_numpy().view(np.uint64))
                at = np.minimum(np.searchsorted(wanted, windows.anchors), len(wanted) - 1)
                candidate = wanted[at] == windows.anchors
                pos = np.flatnonzero(candidate)
                if not len(pos):
                    continue
                edges, tags = windows.names()
                edges = edges.view(np.int64)
                follows = np.append(candidate[1:], False)[pos]
                led = np.append(False, candidate[:-1])[pos]
                before = (windows.w >> np.uint64(33)).astype(np.int32)
                held.append([
                    pa.array(edges[pos]), pa.array(tags[pos].astype(np.int32)), pa.repeat(doc_id, len(pos)), pa.repeat(pa.scalar(_row(_key(words)), pa.int64()), len(pos)),
                    pa.array(pos.astype(np.int32)), pa.array(before[pos - 1], mask=~led), pa.array(edges[np.minimum(pos + 1, windows.count - 1)], mask=~follows),
                ])
                n += len(pos)
                if n >= BATCH_ROWS:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    return landed(found.mapInArrow(run, "edge long, tag int, doc_id long, row long, pos int, before int, after long"), "occurrences")


def paths(found: DataFrame) -> DataFrame:
    """The repeated edges, compacted: edge, tag, doc_id, row, pos (the place of its first occurrence: smallest doc_id, row,
    pos), path (the first edge of its path) and step (its number there).

    Edges follow one another without a branch if the first has one follower and the second one edge before it. Such edges
    with neighbouring places are one piece, by a window over the repeated edges of a document. Pieces that follow one another
    without a branch are joined by pointer jumping, in as many rounds as the logarithm of the pieces of a path; a
    follower has the larger place, so there are no cycles.
    """
    edges = found.groupBy("edge", "tag").agg(
        F.min(F.struct("doc_id", "row", "pos")).alias("first"), F.max("doc_id").alias("last"),
        F.min("before").alias("b0"), F.max("before").alias("b1"), F.min("after").alias("a0"), F.max("after").alias("a1"),
    )
    edges = edges.filter(F.col("first.doc_id") < F.col("last")).select(
        "edge", "tag", "first.*", F.when(F.col("a0") == F.col("a1"), F.col("a0")).alias("after"), (F.col("b0") == F.col("b1")).alias("one_before")
    )
    line = Window.partitionBy("doc_id", "row").orderBy("pos")
    joined = (F.lag("pos").over(line) == F.col("pos") - 1) & (F.lag("after").over(line) == F.col("edge")) & F.col("one_before")
    edges = edges.withColumn("head", ~F.coalesce(joined, F.lit(False)))
    start = lambda c: F.last(F.when(F.col("head"), F.col(c)), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, 0))
    edges = edges.withColumns({"piece": start("edge"), "step": F.col("pos") - start("pos"), "tail": F.coalesce(F.lead("head").over(line), F.lit(True))})
    edges = landed(edges, "edges")

    place = F.struct("doc_id", "row", "pos")
    heads = edges.filter(F.col("head") & F.col("one_before")).select(F.col("edge").alias("after"), place.alias("to"))
    tails = edges.filter(F.col("tail") & F.col("after").isNotNull()).select("after", place.alias("from"), "piece", "step")
    links = tails.join(heads, "after").filter(F.col("to") > F.col("from"))
    links = landed(links.select(F.col("after").alias("piece"), F.col("piece").alias("path"), (F.col("step") + 1).cast("long").alias("steps")), "links")
    while True:
        further = links.select(F.col("piece").alias("path"), F.col("path").alias("beyond"), F.col("steps").alias("more"))
        links = links.join(further, "path", "left")
        links = landed(links.select("piece", F.coalesce("beyond", "path").alias("path"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("beyond").isNotNull().alias("moved")), "links")
        if links.filter("moved").isEmpty():
            break
        links = links.drop("moved")
    whole = edges.join(links.drop("moved"), "piece", "left")
    return whole.select(
        "edge", "tag", F.col("doc_id").alias("source"), F.col("row").alias("source_row"), F.col("pos").alias("source_pos"),
        F.coalesce("path", "piece").alias("path"), (F.col("step") + F.coalesce("steps", F.lit(0))).cast("long").alias("step"),
    )


def spans(found: DataFrame, repeated: DataFrame) -> DataFrame:
    """doc_id, row, spans: the passages of a document that also stand in one with a smaller doc_id.

    An occurrence belongs to a span where its source is a document with a smaller id. A span is a stretch of windows that
    follows one path step by step while its source follows word by word: (pos, n windows, path, step, source,
    source_pos). The positions of a document are bounded by its length, so one task can hold them.
    """
    later = found.select("edge", "tag", "doc_id", "row", "pos").join(repeated, ["edge", "tag"]).filter(F.col("source") < F.col("doc_id"))
    # Both are constant along a span. A hash that met two windows would break one; it cannot lengthen one.
    later = later.select("doc_id", "row", "pos", "path", (F.col("step") - F.col("pos")).alias("on_path"), "source", (F.col("source_pos") - F.col("pos")).alias("on_source"))
    line = Window.partitionBy("doc_id", "row").orderBy("pos")
    same = F.lag("pos").over(line) >= F.col("pos") - 1  # the same place again: a row of documents that is there twice
    for c in ("path", "on_path", "source", "on_source"):
        same &= F.lag(c).over(line) == F.col(c)
    begins = F.last(F.when(F.coalesce(same, F.lit(False)), None).otherwise(F.col("pos")), ignorenulls=True)
    later = later.withColumn("begin", begins.over(line.rowsBetween(Window.unboundedPreceding, 0)))
    one = later.groupBy("doc_id", "row", "begin").agg(
        (F.max("pos") - F.col("begin") + 1).alias("n"), F.first("path").alias("path"), F.first("on_path").alias("on_path"),
        F.first("source").alias("source"), F.first("on_source").alias("on_source"),
    )
    span = F.struct(
        F.col("begin").alias("pos"), "n", "path", (F.col("on_path") + F.col("begin")).alias("step"),
        "source", (F.col("on_source") + F.col("begin")).alias("source_pos"),
    )
    return one.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def _without(texts: DataFrame) -> DataFrame:
    """doc_id, row, n_removed, kept_sha256, kept of texts with the spans that go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(*[batch.column(c) for c in ("doc_id", "text", "spans")]):
                words = _words(text.as_py())
                key = _row(_key(words))
                of = next((s["spans"] for s in found.as_py() if s["row"] == key), None)
                if of is None:
                    continue
                gone = np.zeros(len(words) + 1, np.int64)
                for s in of:
                    gone[s["pos"]] += 1
                    gone[s["pos"] + s["n"] + WINDOW - 1] -= 1
                keep = np.cumsum(gone)[:-1] == 0
                kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k)
                out.append((doc_id.as_py(), key, int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            columns = list(zip(*out)) if out else [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "row", "n_removed", "kept_sha256", "kept"])

    return texts.mapInArrow(run, "doc_id long, row long, n_removed long, kept_sha256 string, kept string")


def find(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The steps of a search: profiles, the first document id of every repeated key, suspects, and their spans (landed)."""
    known = profiles(docs)
    # Texts of equal words: the smallest id stands for all; the others hold nothing that is not in it.
    first = known.filter("doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = landed(first.filter("first < last").select("key", "first"), "copied")
    single = known.filter("doc_id IS NOT NULL").join(copied, "key", "left").filter("first IS NULL OR doc_id = first")
    anchors = single.select("doc_id", F.explode("anchors").alias("anchor"))
    anchors = landed(anchors, "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    texts = suspects(docs, anchors.join(shared.select("anchor"), "anchor"))
    found = occurrences(texts)
    passages = landed(spans(found, paths(found)), "spans")
    return known, copied, texts, passages


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, first_word, n_words, path, step, source_id, source_word: passages of documents whose text is no copy of an
    earlier one, and where they stand in the first document that holds them."""
    *_, passages = find(docs)
    s = passages.select("doc_id", F.explode("spans").alias("s"))
    return s.select(
        "doc_id", F.col("s.pos").cast("long").alias("first_word"), (F.col("s.n") + WINDOW - 1).cast("long").alias("n_words"),
        F.col("s.path").alias("path"), F.col("s.step").alias("step"), F.col("s.source").alias("source_id"), F.col("s.source_pos").cast("long").alias("source_word"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: words of windows that also start in a document with a smaller doc_id go.

    Null, empty and short texts keep all their words. A null doc_id is no smaller than any other and has no smaller one, so
    such a document is neither cut nor a source; documents of one doc_id do not cut each other. Equal rows have equal results.
    Other columns are not looked at. Windows are told apart by 95 bits.
    """
    known, copied, texts, passages = find(docs)
    held = passages.groupBy("doc_id").agg(F.collect_list(F.struct("row", "spans")).alias("spans"))
    cut = _without(texts.select("doc_id", "text").join(held, "doc_id")).drop("kept").dropDuplicates(["doc_id", "row"])
    all_ = known.select("doc_id", "key", "row", "n_words", "words_sha256").join(copied, "key", "left").join(cut, ["doc_id", "row"], "left")
    copy = F.coalesce((F.col("first") < F.col("doc_id")) & (F.col("n_words") >= WINDOW), F.lit(False))
    return all_.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
    )


def oracle() -> str:
    """The query as DuckDB SQL: all windows of all documents as texts."""
    return rf"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), windows AS (
        SELECT r, doc_id, p, md5(array_to_string(words[p:p + {WINDOW - 1}], ' ')) AS name
        FROM texts, unnest(range(1, len(words) - {WINDOW - 2})) AS t(p)
    ), firsts AS (SELECT name, min(doc_id) AS first FROM windows GROUP BY name
    ), gone AS (
        SELECT DISTINCT r, unnest(range(p, p + {WINDOW})) AS i FROM windows JOIN firsts USING (name) WHERE first < doc_id
    ), places AS (
        SELECT r, doc_id, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts
    ), kept AS (
        SELECT r, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone.r IS NULL) AS words, count(gone.r) AS n_removed
        FROM places LEFT JOIN gone USING (r, i) GROUP BY r
    )
    SELECT doc_id, CAST(len(texts.words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept.words, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (r)
    """
