"""Substring dedup, lexical search and the prefix trie against brute force and their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ladle.llm import lexical, prefix_trie, substrings
from ladle.llm.queries import QUERIES, SQL

from .data import awkward, docs

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@pytest.mark.parametrize("name", ["op11_de_bruijn_dedup", "op12_fp_tree_search", "op13_prefix_trie"])
def test_same_rows_as_sql(name, spark, folder, duck):
    df = QUERIES[name](spark, folder)
    found = duck.execute(SQL[name])
    kinds = {d[0]: str(d[1]) for d in found.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    assert in_order(tuple(r) for r in df.select(*kinds).collect()) == in_order(found.fetchall())


# -- substring dedup


def brute_removal(texts):
    words = [(i, WORDS.findall(t or "")) for i, t in texts]
    first = {}
    size = substrings.WINDOW
    for i, w in words:
        for p in range(len(w) - size + 1) if i is not None else ():
            name = tuple(w[p : p + size])
            first[name] = min(first.get(name, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - size + 1) if i is not None else ():
            if first[tuple(w[p : p + size])] < i:
                gone.update(range(p, p + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return in_order(out)


def repeats():
    """Copies, passages with different surroundings, runs of one word, near copies, and passages of just 49 and 50 words."""
    rnd = random.Random(3)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    passage, other, loop = own(70), own(130), " ".join("ab"[k % 2] for k in range(120))
    w = passage.split()
    texts = [
        (50, own(30) + " " + passage + "\n" + own(20)), (51, own(5) + " " + passage), (49, passage + " " + own(9) + " " + passage),
        (60, " ".join(w[:50])), (61, " ".join(w[:49])), (62, own(3) + " " + " ".join(w[20:70]) + " " + own(3)),
        (63, " ".join(w[:60]) + " " + other), (64, other + " " + passage), (65, passage + " " + passage + " " + other[:400]),
        (70, loop), (71, own(10) + " " + loop + " " + own(10)), (72, "a " * 90), (73, "a " * 200), (74, "a\t" * 90),
        (75, "A " * 90), (None, passage), (None, passage), (80, None), (80, passage + " " + own(3)), (80, other + " x"), (80, other + " x"),
    ]
    base = own(400).split()
    for k in range(40):  # near copies: one word changed here and there
        near = list(base)
        for _ in range(k % 4):
            near[rnd.randrange(400)] = f"n{rnd.randrange(99)}"
        texts.append((100 + rnd.randrange(60), " ".join(near)))
    texts += [(300 + k, passage + " " + own(k % 5)) for k in range(30)]
    rnd.shuffle(texts)
    return texts


def test_removal_against_brute_force(spark):
    texts = repeats() + awkward()
    got = substrings.remove_repeats(docs(spark, texts).repartition(5)).collect()
    assert in_order(tuple(r) for r in got) == brute_removal(texts)
    assert sum(r.n_removed for r in got) > 5_000


def test_removal_of_short_random_alphabets(spark):
    """Few different words: paths branch and meet, and loop."""
    rnd = random.Random(4)
    pool = [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(20, 80))) for _ in range(6)]
    texts = [(rnd.randrange(30), " ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 6)))) for _ in range(60)]
    got = substrings.remove_repeats(docs(spark, texts)).collect()
    assert in_order(tuple(r) for r in got) == brute_removal(texts)


def test_spans_say_where_a_passage_stands(spark):
    texts = dict(t for t in repeats() if t[0] is not None and t[0] < 80)
    rows = substrings.repeated_spans(docs(spark, texts.items())).collect()
    assert rows
    for r in rows:
        here, there = WORDS.findall(texts[r.doc_id]), WORDS.findall(texts[r.source_id])
        assert r.source_id < r.doc_id and r.n_words >= substrings.WINDOW
        assert here[r.first_word : r.first_word + r.n_words] == there[r.source_word : r.source_word + r.n_words]


def test_paths_are_stretches_of_text(spark):
    """A path's edges stand one after another, step by step, and no edge is on two paths."""
    texts = [(i, t) for i, t in repeats() if i is not None]
    table = docs(spark, texts)
    *_, found, _ = substrings.find(table)
    rows = substrings.paths(substrings.occurrences(found)).collect()
    assert len({(r.edge, r.tag) for r in rows}) == len(rows)
    steps = defaultdict(list)
    for r in rows:
        steps[r.path].append(r.step)
    assert all(sorted(s) == [*range(len(s))] for s in steps.values())
    assert max(map(len, steps.values())) > 20


def test_removal_of_nothing(spark):
    assert substrings.remove_repeats(docs(spark, [])).count() == 0
    assert substrings.repeated_spans(docs(spark, [(1, "one"), (2, None)])).count() == 0


# -- lexical search


def brute_search(texts, items, most=10):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = lambda t: re.findall(lexical.TERM, (t or "").translate(low))
    bags = [(i, Counter(w), len(w)) for i, w in ((i, terms(t)) for i, t in texts) if w]
    total, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i].update(terms(t))
    out = []
    for item, found in wanted.items():
        scores = []
        for i, bag, n in bags:
            m = 10 + (90 * n * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in found if bag[t])
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:most])]
    return in_order(out)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "item_id long, text string, rank int, doc_id long, term string")


@pytest.mark.parametrize("block,cells,leaf", [(20_000, 8_000_000, 32), (30, 400, 2)])
def test_search_against_brute_force(spark, monkeypatch, block, cells, leaf):
    """Also with several blocks of items and many small trees."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "LEAF", leaf)
    rnd = random.Random(5)
    words = [f"t{int(rnd.paretovariate(0.6))}" for _ in range(3_000)]
    texts = [(k, " ".join(rnd.sample(words, rnd.randrange(1, 90)))) for k in range(250)]
    texts += [(1_000 + k, "Tie tie, TIE! Ünder_ünder") for k in range(15)] + [(None, "tie"), (None, "tie")] + awkward()
    items = [(k, " ".join(rnd.sample(words, 12))) for k in range(25)]
    items += [(90, "tie"), (91, None), (92, " .. "), (93, "nowhere"), (94, "the river"), (94, "tie ünder"), (None, "one, TWO"), (95, "ÜNDER 语")]
    got = lexical.search(docs(spark, texts).repartition(4), items_of(spark, items)).collect()
    assert in_order(tuple(r) for r in got) == brute_search(texts, items)


def test_search_of_nothing(spark):
    none, some = docs(spark, []), docs(spark, [(1, "a b"), (2, None)])
    assert lexical.search(none, items_of(spark, [(1, "a")])).count() == 0
    assert lexical.search(some, items_of(spark, [])).count() == 0
    assert [tuple(r) for r in lexical.search(some, items_of(spark, [(1, "B")])).collect()] == brute_search([(1, "a b"), (2, None)], [(1, "b")])


def test_bounds_hold():
    """No document scores more than the bound of any node it lies below."""
    import numpy as np

    rnd = np.random.default_rng(6)
    tf = (rnd.random((300, 12)) < 0.3) * rnd.integers(1, 9, (300, 12)).astype(np.int32)
    tf[:80] = tf[0]
    m = rnd.integers(10, 300, 300)
    tree = lexical.Tree(np.arange(300), np.ones(300, bool), m, tf)
    weights = rnd.integers(0, 5_000, 12)
    scores = lexical.share(tree.tf, tree.m[:, None]) @ weights
    below = np.zeros(300, int)
    for node, (a, b) in enumerate(zip(tree.first, tree.last)):
        assert (lexical.share(tree.most[node], tree.least[node]) @ weights >= scores[a:b]).all()
        if not len(tree.children[node]):
            below[a:b] += 1
            assert b - a <= lexical.LEAF
    assert (below == 1).all() and sorted(tree.ids) == [*range(300)]


# -- prefix trie


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, own in sorted(convs.items()):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        whole = convs.get(base, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append(c)
        ends[tuple(whole)].append(c)
    leaves, saved = Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        saved[p] += (len(members[p]) - 1) * len(WORDS.findall(p[-1][1])) if p else 0
        if p:
            children[p[:-1]].add(p)
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return in_order(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(children[p]), leaves[p], saved[p], sha(ends[p])) for p, m in members.items()
    )


def turns_of(spark, rows):
    schema = "conv_id long, turn long, role string, text string, depth long, name binary, conv long, words long"
    return spark.createDataFrame([(*r, 7, b"n", 1, 2) for r in rows], schema)


def conversations():
    rnd = random.Random(7)
    says = ["hello", "hello there you", "", None, "one two  three\n four", "语 ünder"]
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(says)) for c in range(-45, 130) for t in range(rnd.randrange(0, 7))]
    rows += [(c, t, "user", "always the same") for c in range(400, 700) for t in range(3)]  # copies
    rows += [(900, t, "user", f"turn {t // 2}") for t in range(150)] + [(921, t, "user", f"turn {t // 2}") for t in range(145)]  # long
    rows += [(1000, None, "user", "first"), (1000, 0, None, None), (1000, -5, "user", "second")]
    rows += [(None, 1, "user", "nobody"), (1001, 1, None, "x" * 20_000), (1002, 1, "user", "x" * 20_000), (2**62, 1, "user", "far")]
    rnd.shuffle(rows)
    return rows


def test_trie_against_brute_force(spark):
    got = prefix_trie.prefix_trie(turns_of(spark, conversations()).repartition(6))
    assert in_order(tuple(r) for r in got.collect()) == brute_trie(conversations())


def test_ties_in_turn_have_one_order(spark):
    rows = [(3, 1, r, t) for r in ("b", "a", None) for t in ("y", "x", "x", None)] + [(4, None, "a", "x")] * 3
    got = [prefix_trie.prefix_trie(turns_of(spark, rnd).repartition(n)).collect() for rnd, n in ((rows, 1), (rows[::-1], 7))]
    assert in_order(map(tuple, got[0])) == in_order(map(tuple, got[1]))


def test_trie_of_nothing_and_of_one_conversation_without_turns(spark):
    assert prefix_trie.prefix_trie(turns_of(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(turns_of(spark, [(None, 1, "a", "b")])).count() == 0
    alone = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    rows = [(alone, 0, "user", "taken away")]  # the first conversation of its group is not there
    got = [tuple(r) for r in prefix_trie.prefix_trie(turns_of(spark, rows)).collect()]
    assert got == brute_trie(rows) and got[0][:5] == (alone, 0, None, 1, 0)
