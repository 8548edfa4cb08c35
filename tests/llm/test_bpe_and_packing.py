import base64
import gc
import hashlib
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ladle.llm import bpe, memo, packing

from .data import awkward, docs

PIECES = ["a", "b", "aa", "é", " ", "  ", "\n", "\t", "\x1c", " ", "1", "12", ".", "'s", "ing", " the", "😀", "語", "==", "'"]


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@pytest.fixture(scope="module")
def truth(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.TextEncoder(ranks, public_tokenizers.PATTERN)


@settings(max_examples=400, deadline=None)
@given(parts=st.lists(st.sampled_from(PIECES), max_size=40))
def test_bpe_is_the_library_s(parts, encoder, truth):
    text = "".join(parts)
    n, ids, back = encoder.text(text)
    expected = truth.encode_ordinary(text)
    assert (n, ids, back) == (len(expected), ",".join(map(str, expected)).encode(), text.encode())


@settings(max_examples=200, deadline=None)
@given(left=st.text("etaoin", max_size=30), right=st.text("etaoin", max_size=30))
def test_joining_encodings_encodes_the_joint_bytes(left, right, encoder):
    e = encoder.encoder
    a, b = left.encode(), right.encode()
    assert e.join(e.tree(a), e.tree(b)) == e.leaf(a + b)


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, " " * 4000, "=-" * 2000, "é" * 3000, "\n" * 999 + " x"])
def test_bpe_of_long_runs(text, encoder, truth):
    assert encoder.text(text)[1] == ",".join(map(str, truth.encode_ordinary(text))).encode()


def test_bpe_of_awkward_documents(spark, truth):
    rows = bpe.encode_documents(docs(spark, awkward())).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for doc_id, text in awkward():
        ids = truth.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    assert bpe.encode_documents(docs(spark, [])).count() == 0


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    t.encode_special_tokens = True
    return t


@settings(max_examples=200, deadline=None)
@given(parts=st.lists(st.sampled_from([*PIECES, "<|endoftext|>"]), max_size=40))
def test_tokens_are_the_library_s(parts, library):
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as f:
        ours = packing._tokens(f.read())
    text = "".join(parts)
    assert ours.ids(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_known_words_are_looked_up_once(library, monkeypatch):
    """Also when words move from one generation of the memo to the next, and with spaces of any kind after a space."""
    looked_up = []

    class Counted(memo.Memo):
        def get(self, *key):
            looked_up.append(key[0])
            return super().get(*key)

        def __contains__(self, key):
            looked_up.append(key)
            return super().__contains__(key)

        def __getitem__(self, key):
            looked_up.append(key)
            return super().__getitem__(key)

    monkeypatch.setattr(packing, "Memo", Counted)
    monkeypatch.setattr(packing, "WORDS", 150)
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as f:
        ours = packing.Tokens(f.read())
    truth = lambda text: np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    text = " ".join(f"w{i}é" for i in range(101))
    assert ours.ids(text) == truth(text)
    looked_up.clear()
    assert ours.ids(text) == truth(text) and len(looked_up) == 100
    for start in range(0, 400, 40):
        for end in ("", " ", "  x", " \n", " \x1c.", " \u2003a", "\n b"):
            other = " ".join(f"w{i}é" for i in range(start, start + 90)) + end
            assert ours.ids(other) == truth(other)


@given(n=st.integers(1, 9000))
def test_cuts_cover_a_document(n):
    parts = packing.cut(n)
    assert [s for s, _ in parts] == [sum(k for _, k in parts[:i]) for i in range(len(parts))]
    assert sum(k for _, k in parts) == n and all(k == packing.CAPACITY for _, k in parts[1:])


@settings(max_examples=50, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=200))
def test_sum_of_squares_follows_its_rule(lengths):
    """Every step against all choices, computed from the counts anew."""
    capacity = 64
    sequences, offsets = packing.sum_of_squares(np.array(lengths, np.int64), capacity)
    fill = {}
    for n, s, at in zip(lengths, sequences.tolist(), offsets.tolist()):
        gaps = [capacity - f for f in fill.values() if f < capacity]

        def squares(without, new):
            left = [*gaps]
            left.remove(without)
            left += [new] * (new > 0)
            return sum(left.count(g) ** 2 for g in set(left))

        choices = {g: squares(g, g - n) for g in set(gaps) if g >= n}
        assert fill.get(s, 0) == at
        if choices:
            assert choices[capacity - at] == min(choices.values()) and s in fill
        else:
            assert at == 0 and s not in fill
        fill[s] = at + n
    assert all(f <= capacity for f in fill.values())


def check_packing(rows, texts, library):
    """Pieces cover the documents; sequences are gapless and within capacity."""
    by_sequence, pieces = {}, []
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.append((r.doc_id, r.piece, r.start, r.length, r.ids_crc32))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= packing.CAPACITY
    expected = []
    for doc_id, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, (start, n) in enumerate(packing.cut(len(ids))):
            expected.append((doc_id, piece, start, n, zlib.crc32(ids[start : start + n].tobytes())))
    assert sorted(map(str, pieces)) == sorted(map(str, expected))
    return len(by_sequence)


def test_packing(spark, folder, library):
    assert packing.pack_documents(docs(spark, [])).count() == 0
    check_packing(packing.pack_documents(docs(spark, awkward())).collect(), awkward(), library)
    table = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in table.collect()]
    rows = packing.pack_documents(table).collect()
    used, least = check_packing(rows, texts, library), -(-sum(r.length for r in rows) // packing.CAPACITY)
    assert used <= 1.03 * least + 1


def test_packs_share_no_sequence(spark, folder, library):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = packing.pack(packing.pieces(table), pieces_per_pack=20).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in table.collect()], library)


def test_a_worker_keeps_the_words_of_one_operator():
    """Tasks of one operator share what they keep; a task of another one lets it go."""
    with open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8") as f:
        vocabulary = f.read()
    first = memo.begun(lambda: packing._tokens(vocabulary))
    assert memo.begun(lambda: packing._tokens(vocabulary)) is first
    gone = weakref.ref(first)
    del first
    memo.begun(dict)
    gc.collect()
    assert gone() is None
