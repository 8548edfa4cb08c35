"""Byte-level BPE by a tree of merges: halves are encoded apart, then joined where their encodings meet."""

from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ladle.llm.memo import Memo, kept, per_batch

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_BYTES = 3
# Short stretches come back in many words; their encodings are remembered.
SHORT_BYTES = 8
NONE = 1 << 40
# Words held per generation of a task's memo.
WORDS = 250_000


class Encoder:
    """Encodes bytes by ranks: of all neighbouring tokens, those whose joint bytes have the lowest rank merge first, the
    leftmost first among equals, until none can merge.

    Encodings form a monoid under ``join``. Its law: a sequence of tokens is *the* encoding of its bytes exactly when every
    two neighbours, encoded on their own, come out as these two tokens. (The first merge across a boundary would be the
    best one between the two tokens at it, with all merges so far inside tokens; it would then happen for the two alone.)
    So when a window around a seam is encoded anew, everything outside is settled as soon as the tokens at the window's
    two edges agree with their outer neighbours; else the window grows by as many tokens again.
    """

    def __init__(self, ranks: dict[bytes, int], leaf_bytes: int = LEAF_BYTES):
        self.ranks, self.leaf_bytes = ranks, leaf_bytes
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.decimal_of = {rank: str(rank) for rank in ranks.values()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.short = Memo(self._tree, 100_000)
        self.meeting = Memo(lambda pair: self.leaf(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]), 100_000)

    def leaf(self, data: bytes) -> list[int]:
        """Encode few bytes merge by merge."""
        ids, pairs = [self.single[b] for b in data], self.pairs
        ranks = [pairs.get(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [best]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = pairs.get(best << 32 | ids[i + 1], NONE)
            if i:
                ranks[i - 1] = pairs.get(ids[i - 1] << 32 | best, NONE)
        return ids

    def settled(self, a: int, b: int) -> bool:
        """Whether two tokens stay as they are when they meet."""
        return self.meeting[a, b] == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings, one after the other."""
        if not left or not right:
            return left + right
        window, reach = self.meeting[left[-1], right[0]], 1
        if window == [left[-1], right[0]]:
            return left + right
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            if reach > 1:
                window = self.leaf(self.decode(left[a:] + right[:b]))
            if (not a or self.settled(left[a - 1], window[0])) and (b == len(right) or self.settled(window[-1], right[b])):
                return left[:a] + window + right[b:]
            reach *= 2

    def _tree(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf_bytes:
            return self.leaf(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def tree(self, data: bytes) -> list[int]:
        """Encode by halves. The depth is the logarithm of the length."""
        return self.short[data] if len(data) <= SHORT_BYTES else self._tree(data)

    def trim(self) -> None:
        self.short.trim()
        self.meeting.trim()

    def piece(self, data: bytes) -> list[int]:
        """A match of the split pattern: a token if it is one as a whole, else its merges."""
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.tree(data)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def as_white_space(pattern: str) -> str:
    """White space as the pattern means it: by the character property, which leaves out the separators U+001C to U+001F."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class TextEncoder:
    """Encodes whole texts, word by word where that is safe.

    The split pattern never matches across a place where one space stands between two characters that aren't white space:
    there a match ends, and the next one starts with the space. When every space of a text is followed by something other
    than white space, the text falls apart at its spaces into words that split as they would inside the text; the encodings
    of words are remembered. Any other text is split as a whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder, self.split = Encoder(ranks), regex.compile(as_white_space(pattern))
        self.open_space = regex.compile(as_white_space(r" (?:\s|\Z)"))
        self.letters = regex.compile(r" \p{L}+")
        self.pieces = Memo(lambda p: self.encoder.piece(p.encode()), WORDS)
        # Words by what follows their space.
        self.words = Memo(lambda w: self._word(f" {w}"), WORDS)

    def ids(self, text: str) -> list[int]:
        return [i for piece in self.split.findall(text) for i in self.pieces[piece]]

    def _word(self, word: str) -> tuple[int, bytes, bytes]:
        # Letters after a space are one match of the pattern's letter branch; words that are no such match are split.
        whole = self.letters.fullmatch(word)
        ids = self.encoder.piece(word.encode()) if whole else self.ids(word)
        return len(ids), ",".join([self.encoder.decimal_of[i] for i in ids]).encode(), self.encoder.decode(ids)

    def text(self, text: str) -> tuple[int, bytes, bytes]:
        """Number of ids, the ids in decimal joined by commas, the decoded bytes. Decoding joins the parts' decodings."""
        if self.open_space.search(text):
            return self._word(text)
        first, *rest = text.split(" ")
        parts = [self._word(first)] * bool(first) + list(map(self.words.__getitem__, rest))
        self.words.trim()
        self.pieces.trim()
        self.encoder.trim()
        return sum([p[0] for p in parts]), b",".join([p[1] for p in parts]), b"".join([p[2] for p in parts])


def _new_encoder(vocabulary: bytes, pattern: str) -> TextEncoder:
    return TextEncoder(read_ranks(vocabulary), pattern)


def _text_encoder(vocabulary: bytes, pattern: str) -> TextEncoder:
    """One for all tasks of a Python worker."""
    return kept(_new_encoder, vocabulary, pattern)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per document the number of its tokens and the digests of its ids and of what they decode to. A null text is empty.

    ``vocabulary`` is the path of a rank file, read by the driver; its bytes (a fixed size, about a megabyte) go to the
    tasks as a broadcast variable.
    """
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        encoder = _text_encoder(ranks.value, pattern)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids, decoded = [], [], []
            for text in batch.column("text"):
                count, joined, back = encoder.text(text.as_py() or "")
                n.append(count)
                ids.append(hashlib.sha256(joined).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return work

    docs = docs.selectExpr("CAST(doc_id AS bigint) AS doc_id", "text")
    return per_batch(docs, start, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
