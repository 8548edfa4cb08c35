import re
import zlib

import numpy as np

from ladle.llm import langid, quality

from .data import awkward, docs, prose


def plain_counts(text):
    """The counted facts, word by word."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(inside),
    )


def test_counts_and_base_rule(spark):
    texts = [(i, t) for i, t in awkward() if len(t or "") < 5000]
    texts += [(100 + i, t) for i, t in enumerate(["a b c a b c d", "a a a a", "x\nx\n\n \nx # *|", "a b c\x85d e", prose() + "\n" + prose()])]
    rows = quality.judge(docs(spark, texts), None).collect()
    expected = sorted(str((i, *plain_counts(t))) for i, t in texts)
    assert sorted(str(tuple(r)[:6]) for r in rows) == expected
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # no model, no verdict of one


def test_windows_of_many_different_words():
    codes = np.array([0, 1, 2, 3, 0, 1, 2])
    assert quality.repeated_words(codes, 4) == quality.repeated_words(codes, 1 << 21) == 6


def test_model_on_held_out_labels(spark, folder):
    """Trained on three quarters of the labelled documents, right on the others."""
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    ours = labels.filter("doc_id % 4 <> 1")
    model = quality.train(table, ours)
    judged = quality.judge(table, model).join(labels.filter("doc_id % 4 = 1"), "doc_id").filter("not base_failed").collect()
    right = [r.kept == (r.quality == 1) for r in judged]
    assert len(right) > 10 and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 for r in judged)


def test_quality_without_rows_or_labels(spark, folder):
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    assert quality.train(table, labels.limit(0)) is None
    assert quality.train(table.limit(0), labels) is None
    both = labels.selectExpr("doc_id", "quality", "toxic").unionByName(labels.selectExpr("doc_id", "1 - quality AS quality", "toxic"))
    assert quality.train(table, both) is None  # every label is contradicted
    assert quality.quality_rules(table.limit(0), labels).count() == 0


def test_keeping_good_documents_keeps_their_columns(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    table = docs(spark, awkward())
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns
    rejected = {r.doc_id for r in quality.judge(table, None).filter("base_failed").collect()}
    assert not rejected & {r.doc_id for r in kept.collect()}


def test_languages_on_held_out_documents(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    rows = langid.identify_languages(table).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert len(held) > 20 and np.mean(held) > 0.97


def test_language_of_awkward_documents(spark):
    texts = awkward()
    learned = docs(spark, [(i, prose(i, 60)) for i in range(20, 60)], "aa").unionByName(
        docs(spark, [(i, "zorg blimp kraut " * 30) for i in range(60, 99)], "bb")
    )
    model = langid.train(learned.unionByName(docs(spark, [(100, "no language")], None)))
    assert model.langs == ["aa", "bb"]
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(docs(spark, texts), model).collect()}
    has = lambda t: any(c.isalpha() for c in t or "")
    assert all((langid.UNKNOWN == pred) == (not any(has(t) for i, t in texts if i == doc)) for doc, pred in found)
    assert langid.identify(docs(spark, texts), langid.train(learned.limit(0))).filter("lang_pred <> 'und'").count() == 0
    table = docs(spark, texts)
    assert langid.keep_identified(learned).count() == learned.count() and langid.keep_identified(table).columns == table.columns


def test_unknown_words_fall_back_to_shorter_grams():
    voices = np.array([[1, -1], [0, 2], [4, 0]], np.float32)
    model = langid.Model(["a", "b"], {"known": 0}, {"^ab": 1, "x": 2}, voices)
    assert model.word("known").tolist() == [1, -1]
    assert model.word("ab").tolist() == [0, 2]  # only the first place speaks
    assert model.word("xx").tolist() == [4, 0]
    assert model.word("qq").tolist() == [0, 0]


def test_a_full_table_of_words_starts_anew():
    voices = np.array([[i, -i] for i in range(26)], np.float32)
    model = langid.Model(["a", "b"], {f"w{chr(97 + i)}": i for i in range(26)}, {}, voices)
    scorer = langid.Scorer(model)
    text = " ".join(f"w{chr(97 + i % 26)}" for i in range(100))
    before = scorer.predict(text)
    scorer.size = langid.SLICE  # every slice empties it
    assert scorer.predict(text) == before


def test_the_fit_makes_no_arrays_as_large_as_its_pairs():
    import tracemalloc

    rng = np.random.default_rng(3)
    lengths = np.full(100, 20_000)
    places = rng.integers(0, 2 << quality.BITS, lengths.sum()).astype(np.int32)
    rows = quality.Sparse(np.arange(100) % 2.0, lengths, places, np.full(len(places), 5e-5, np.float32))
    by_row = rng.normal(size=100)
    exact = np.bincount(places, np.repeat(by_row.astype(np.float32), lengths) * rows.shares, 2 << quality.BITS)
    assert np.array_equal(rows.spread(by_row), exact)
    tracemalloc.start()
    quality._descend(rows, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20  # the weights and their steps are five arrays of 4 MB; the pairs are 16 MB
