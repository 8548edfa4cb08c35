import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ladle.llm import multi_index, ngram_join, tables

from .data import awkward, docs


def brute_search(ids, vectors, every=20, most=20):
    found = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = multi_index.inner_products(vectors[i : i + 1], vectors)[0]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:most]
        found[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def searched(df, **options):
    got = defaultdict(list)
    for r in sorted(multi_index.search(df, **options).collect()):
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return dict(got)


def recall(got, expected):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / max(1, len(expected[q])) for q in expected])


def test_index_over_the_table(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = sorted(table.collect())
    expected = brute_search(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64))
    got = searched(table)
    assert set(got) == set(expected) and recall(got, expected) >= 0.9
    scores = {(q, i): s for q, near in expected.items() for i, s in near}
    assert all(scores[q, i] == s for q, near in got.items() for i, s in near if (q, i) in scores)


def test_index_that_skips_cells(spark):
    """Clustered vectors: most cells are never visited, and recall holds."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    vectors = (centres[rng.integers(0, 40, 4000)] + 0.1 * rng.normal(size=(4000, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>")
    assert recall(searched(df), brute_search(np.arange(4000), vectors.astype(np.float64))) >= 0.9


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(size=(100, 8)), np.repeat(rng.normal(size=(1, 8)), 200, axis=0)]).astype(np.float32)
    fine = [(i, v, "x") for i, v in enumerate(vectors.tolist())]
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [float("nan")] * 8), (1060, [float("inf")] * 8), (1080, [1.0, None] + [1.0] * 6)]
    bad += [(None, [1.0] * 8), (1100, [1.0] * 3), (1120, [])]
    schema = "vec_id long, embedding array<float>, cell string"
    df = spark.createDataFrame(fine + [(*b, "y") for b in bad] + fine[120:125], schema)
    got, expected = searched(df), brute_search(np.arange(300), vectors.astype(np.float64))
    assert set(got) == set(expected) and recall(got, expected) >= 0.9
    assert got[120] == expected[120] and [i for i, _ in got[120] if i >= 100][:3] == [100, 101, 102]
    assert searched(df.limit(0)) == {} and searched(spark.createDataFrame(bad[:5], "vec_id long, embedding array<float>")) == {}
    assert len(searched(spark.createDataFrame(fine[:4], schema))[0]) == 3  # all candidates, if fewer


def test_few_scores_leave_the_units(spark, monkeypatch):
    """Noise: a query visits all units, and only what can be among its nearest leaves them."""
    vectors = np.random.default_rng(6).normal(size=(8000, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>")
    rows, rerank = [], multi_index._rerank
    monkeypatch.setattr(multi_index, "_rerank", lambda *a: rows.append((out := rerank(*a)).count()) or out)
    assert recall(searched(df), brute_search(np.arange(8000), vectors.astype(np.float64))) >= 0.9
    assert rows == [400 * 21]


def test_traversal_is_by_summed_distance():
    rng = np.random.default_rng(5)
    book = multi_index.fit(rng.normal(size=(300, 6)), 8)
    query, filled = rng.normal(size=6), np.ones(64, np.int64)
    filled[rng.choice(64, 20, replace=False)] = 0
    first, second = book.distances(query)
    order = list(book.traverse(query, filled))
    sums = [first[c // 8] + second[c % 8] for c in order]
    assert sorted(order) == np.flatnonzero(filled).tolist() and sums == sorted(sums)


@pytest.mark.parametrize("seed", range(5))
def test_layout_covers_all_cells(seed):
    rng = np.random.default_rng(seed)
    counts = rng.choice([0, 0, 5, 300, 1500, 9000], 64)
    layout = multi_index.Layout.of(counts, rng.integers(0, 200_000, 64))
    held = np.bincount(layout.group, counts, 64) / layout.chunks
    assert (held[layout.group] <= multi_index.UNIT_ROWS).all()
    for values in (layout.chunks, layout.replicas):
        assert all(len(set(values[layout.group == g])) == 1 for g in set(layout.group))


def brute_groups(rows):
    sets = []
    for _, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    smallest = {r: min((d for d in docs if d is not None), default=None) for r, docs in ids.items()}
    return [(doc_id, len(sets[i]), smallest[find(i)]) for i, (doc_id, _) in enumerate(rows)]


def hard_texts():
    """A large group of near copies, a common passage, small vocabularies, copies, a chain of overlapping windows."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts, base = [], [rnd.choice(words) for _ in range(80)]
    for _ in range(150):
        t = list(base)
        for _ in range(rnd.randint(0, 3)):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        texts.append(" ".join(t))
    hot = " ".join(rnd.choice(words) for _ in range(30))
    texts += [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) + " " + hot for _ in range(100)]
    texts += [" ".join(rnd.choice(words[:4]) for _ in range(rnd.randint(0, 12))) for _ in range(80)]
    texts += ["A b c", "a B c", "one"] * 2 + [" ".join(words)] * 30
    texts += [" ".join(str(j) for j in range(i * 3, i * 3 + 100)) for i in range(40)]
    rnd.shuffle(texts)
    return [(i * 7 % 1009, t) for i, t in enumerate(texts)]


def test_groups_are_those_of_all_pairs(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    same = lambda got, expected: assert_equal(sorted(map(str, map(tuple, got))), sorted(map(str, expected)))
    same(ngram_join.link(table).collect(), brute_groups([(r.doc_id, r.text) for r in table.collect()]))
    rows = hard_texts()
    same(ngram_join.link(docs(spark, rows).repartition(5)).collect(), brute_groups(rows))
    same(ngram_join.link(docs(spark, awkward())).collect(), brute_groups(awkward()))
    assert ngram_join.link(table.limit(0)).count() == 0


def assert_equal(got, expected):
    assert got == expected


@pytest.mark.parametrize("text", [None, "", " \n\t", "a", "A b\x0bc", "one two three four five six", "x\x00 x", "é É ß 中文 " * 9, "q r " * 40_000])
def test_shingles_are_those_of_the_words(text):
    words = (text or "").encode().lower().split()
    size = min(len(words), 5)
    different = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    found = ngram_join.Shingler()(text)
    assert len(found) == len(different) and (found[1:] > found[:-1]).all()
    assert (ngram_join.Shingler()(b"\r".join(words).decode()) == found).all()


def test_without_hubs_the_full_join_finds_the_same(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", 0)
    rows = hard_texts()
    got = ngram_join.link(docs(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows))


@pytest.mark.parametrize("rounds", [0, 3])
def test_short_documents_around_one(spark, monkeypatch, rounds):
    """Sets of 4 to 7 shingles, similar to the middle one only: they share fewer tokens than the longest prefix asks for."""
    monkeypatch.setattr(ngram_join, "HUB_ROUNDS", rounds)
    rows = []
    for size in range(8, 12):
        words = " ".join(f"s{size}w{j}" for j in range(size))
        stars = [f"{words} end{i}" if i % 2 else f"end{i} {words}" for i in range(40)]
        rows += [(100 * size + i, t) for i, t in enumerate([words, *stars])]
    got = ngram_join.link(docs(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows))
    assert {c for _, _, c in got} == {800, 900, 1000, 1100}


def test_near_copies_that_are_not_similar_make_few_pairs(spark, monkeypatch):
    """Copies of one text with four changed words each are no links; those with one change, and some with more, are."""
    rnd = random.Random(7)
    base, rows = [f"b{i}" for i in range(150)], []
    for i in range(240):
        t = list(base)
        for _ in range(rnd.choice([1, 2, 3, 3, 4])):
            t[rnd.randrange(len(t))] = f"x{rnd.randrange(60)}"
        rows.append((i, " ".join(t)))
    compared, similar = [], ngram_join._similar
    monkeypatch.setattr(ngram_join, "_similar", lambda pairs, sets: compared.append(pairs.count()) or similar(pairs, sets))
    got = ngram_join.link(docs(spark, rows)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows))
    assert compared[-1] < 6_000  # of 28,680 pairs


def test_keeping_one_of_each_group(spark):
    rows = hard_texts() + [(5000, None), (5001, ""), (5001, "")] + [(6000, "one text that is there twice as is")] * 2
    table = docs(spark, rows)
    kept = ngram_join.keep_one(table)
    assert kept.columns == table.columns
    expected = sorted(d for d, n, c in brute_groups(rows) if d == c and not (d == 6000))
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*expected, 6000])
    assert ngram_join.keep_one(table.limit(0)).count() == 0


def _components_agree(spark, edges):
    got = {r.node: r.component for r in tables.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            root[find(a)] = find(b)
    assert set(got) == set(root)
    pairs = {(find(x), c) for x, c in got.items()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(300 + rnd.randrange(99), 300 + rnd.randrange(99)) for _ in range(80)]
    _components_agree(spark, [*edges, (700, 700), (701, None), (0, 1)])
    assert tables.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_a_long_chain_and_a_sparse_graph(spark):
    rnd = random.Random(2)
    names = rnd.sample(range(100_000), 5_000)
    chain = list(zip(names, names[1:]))
    sparse = [(200_000 + rnd.randrange(3_000), 200_000 + rnd.randrange(3_000)) for _ in range(2_900)]
    _components_agree(spark, chain + sparse)


def _recorded(monkeypatch):
    """Joins in the plan of each table that is landed from now on."""
    joins, land = [], tables.landed

    def landed(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return land(df, name)

    for module in (tables, ngram_join):
        monkeypatch.setattr(module, "landed", landed)
    return joins


def test_components_follow_hooks_by_one_table(spark, monkeypatch):
    """Plans of a round stay small: the driver holds them, and each join's small side, for every round of every call."""
    joins = _recorded(monkeypatch)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)]
    _components_agree(spark, edges)
    assert 0 < max(joins) <= 3


def test_components_grow_from_those_before(spark, folder, monkeypatch):
    """Links that made components in an earlier round aren't worked through again."""
    joins = _recorded(monkeypatch)
    ngram_join.groups(spark.read.parquet(f"{folder}/documents.parquet"))
    assert len(joins) <= 60 and sum(joins) <= 70
