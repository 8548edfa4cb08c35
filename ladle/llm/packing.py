"""Packing documents into sequences by the sum-of-squares rule."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm.memo import Memo, kept, per_batch
from ladle.session import ensure_checkpoint_dir

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
# About so many pieces are packed together: more fill sequences better, fewer spread over more tasks.
PIECES_PER_PACK = 20_000
WORDS = 300_000


class Tokens:
    """Ids of whole texts as little-endian 32-bit bytes, word by word.

    The vocabulary's split pattern matches from a single space on, so where every space of a text is followed by something
    other than white space, its words (each with the space before it) are split as inside the text, and as inside any other
    such text. All words of a text that are new are encoded by the library as one such text, whose ids fall to the words by
    their lengths in bytes; they are remembered. A text with other spaces is encoded as a whole. Strings of special tokens
    are ordinary text.

    Known words are looked up once each. Only words that follow their space as they should are ever remembered, so other
    spaces show among the new words.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary)
        self.library.encode_special_tokens = True
        names = self.library.get_vocab()
        self.lengths = np.zeros(max(names.values()) + 1, np.int64)
        self.lengths[list(names.values())] = [len(name) for name in names]  # a byte is a character of the name
        # Words by what follows their space.
        self.words = Memo(lambda w: self.encode(f" {w}"), WORDS)

    def encode(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        text = " " + " ".join(words)
        ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        held = text.encode()
        ends = np.append(np.flatnonzero(np.frombuffer(held, np.uint8) == 0x20)[1:], len(held))
        cuts = (4 * np.searchsorted(np.cumsum(self.lengths[ids]), ends, side="right")).tolist()
        data = ids.tobytes()
        self.words.update(zip(words, map(data.__getitem__, map(slice, [0, *cuts], cuts))))

    def ids(self, text: str) -> bytes:
        first, *words = text.split(" ")
        known, before = self.words, self.words.old
        found = list(map(known.get, words))
        missing = {w for w, ids in zip(words, found) if ids is None}
        if missing:
            new = [w for w in missing if w not in before]
            if any(not w or w[0].isspace() for w in new):
                return self.encode(text)
            if new:
                self.learn(new)
            found = [ids or known[w] for w, ids in zip(words, found)]  # a word has an id at least
        joined = (self.encode(first) if first else b"") + b"".join(found)
        known.trim()
        return joined


def _tokens(vocabulary: str) -> Tokens:
    """One for all tasks of a Python worker."""
    return kept(Tokens, vocabulary)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids. All pieces of a longer document but the first fill a sequence."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document. A null text is empty: the end id alone.

    ``vocabulary`` is the path of a tokenizer file, read by the driver; its text (a fixed size, under two megabytes) goes to
    the tasks as a broadcast variable.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def start():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokens = _tokens(held.value)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = tokens.ids(text.as_py() or "") + end
                for piece, (at, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc_id, piece, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)

        return work

    rows = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    return per_batch(rows, start, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, placed one after the other.

    ``open[g]`` counts the open sequences with a gap of g. A length goes where the sum of the squares of ``open`` becomes
    smallest: into gap g that changes it by 2 (open[g-length] - open[g] + 1), closed sequences not counted. A new sequence
    is opened when no open one has room. Ties go to the smallest gap. Of the open sequences of one gap the latest is taken.
    """
    count = np.zeros(capacity + 1, np.int64)
    standing: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequences, offsets, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, n in enumerate(lengths):
        gaps, after = count[n:capacity], count[: capacity - n]
        change = np.where(gaps > 0, 2 * (after - gaps) + 2, never)
        if len(change):
            if gaps[0]:  # an exact fit closes a sequence: the smaller square goes, no other grows
                change[0] = 1 - 2 * gaps[0]
            best = int(change.argmin())
        if len(change) and change[best] != never:
            gap = n + best
            sequence = standing[gap].pop()
            count[gap] -= 1
        else:
            gap, sequence, used = capacity, used, used + 1
        sequences[i], offsets[i] = sequence, capacity - gap
        if gap > n:
            standing[gap - n].append(sequence)
            count[gap - n] += 1
    return sequences, offsets


def pack(rows: DataFrame, capacity: int = CAPACITY, pieces_per_pack: int = PIECES_PER_PACK) -> DataFrame:
    """Add sequence_id and offset to pieces (columns doc_id, piece, start, length, ids_crc32).

    Pieces that fill a sequence get one of their own. The others are dealt out to packs by a hash of the whole row and its
    place, so copies spread too; packs grow in number with the input, not in size. In a pack, long pieces come first (ties:
    by doc_id and piece), which leaves the short ones to fill gaps.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.withColumn("row", F.monotonically_increasing_id()).checkpoint()
    partial = F.col("length") < capacity
    packs = 1 + rows.filter(partial).count() // pieces_per_pack

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True], ignore_index=True)
        sequence, offset = sum_of_squares(pdf["length"].to_numpy(), capacity)
        # Numbers of a pack follow from its own: the packs count up in the remainder.
        return pdf.assign(sequence_id=2 * (sequence * packs + pdf["pack"]), offset=offset).drop(columns="pack")

    dealt = rows.filter(partial).withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(packs)))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, row long, sequence_id long, offset long"
    packed = dealt.groupBy("pack").applyInPandas(place, schema)
    full = rows.filter(~partial).withColumn("sequence_id", 2 * F.col("row") + 1).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(full).drop("row")


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs))
