"""Jaccard join on word n-grams with adaptive prefixes: near-duplicate documents and their groups."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.memo import begun, map_batches, rows_where
from ladle.llm.tables import components, landed

WORDS_PER_SHINGLE = 5
# Similar are documents whose intersection is at least this share of their union.
SIMILARITY = Fraction(4, 5)
# A prefix is lengthened for at most so many shared tokens. Verifying a candidate costs about so many list entries.
MOST_SHARED, VERIFY_COST = 8, 8
# Tokens from the lowest two fifths of the hash range are counted and come first in the global order.
REGION = np.uint64(int(0.4 * 2**64))
# Bits of the filters that keep rows without a partner from being shuffled.
FILTER_BITS = 26
# So many times each set is compared with a hub of its tokens.
HUB_ROUNDS = 3
SEEN = 250_000
BATCH_ROWS = 100_000

_MULTIPLIERS = [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
# An odd number, its inverse modulo 2^64, white space, and what a byte counts: lower-cased, and never 0.
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACES = np.zeros(256, np.bool_)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_CODES = np.arange(1, 257, dtype=np.uint64)
_CODES[ord("A") : ord("Z") + 1] += np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a number modulo 2^64."""
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def _mixed_bits(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(_MULTIPLIERS[1])
    return h ^ (h >> np.uint64(29))


class Shingler:
    """64-bit hashes of a text's different shingles in unsigned order. A-Z are lower-cased; words are runs without ASCII
    white space; a text of fewer words than a shingle has is one shingle; one without words has none.

    A word's hash is a polynomial of its bytes modulo 2^64, taken from running sums over the text, so that no step is done
    word by word. Powers of the odd base have inverses, which move a word to the front. A text longer than the powers that
    are held makes them grow to its length.
    """

    def __init__(self):
        self.up, self.down = _powers(_BASE, 1 << 14), _powers(_INVERSE, 1 << 14)

    def _words(self, text: bytes) -> np.ndarray:
        """Hashes of the words in order."""
        codes = np.frombuffer(text, np.uint8)
        inside = np.zeros(len(codes) + 2, np.bool_)
        inside[1:-1] = ~_SPACES.take(codes)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        if len(codes) > len(self.up):
            self.up, self.down = _powers(_BASE, len(codes)), _powers(_INVERSE, len(codes))
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_CODES.take(codes) * self.up[: len(codes)], out=sums[1:])
        return _mixed_bits((sums[ends] - sums[starts]) * self.down[starts])

    def __call__(self, text: str | None) -> np.ndarray:
        w = self._words((text or "").encode())
        if not len(w):
            return w
        size = min(len(w), WORDS_PER_SHINGLE)
        h = np.full(len(w) - size + 1, size, np.uint64)
        for i in range(size):
            h += w[i : len(w) - size + 1 + i] * np.uint64(_MULTIPLIERS[i])
        h = np.sort(_mixed_bits(h))
        return h[np.concatenate(([True], h[1:] != h[:-1]))]


def set_key(tokens: np.ndarray) -> int:
    """A 64-bit name of a set, signed. Documents with equal sets share it."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_length(n: int, shared: int = 1) -> int:
    """How many tokens of a set of n, in any global order, hold at least ``shared`` tokens of every similar set: the
    overlap is at least ceil(n * SIMILARITY), so at most n - that many tokens of this set are missing there."""
    return min(n, n - math.ceil(n * SIMILARITY) + shared)


def posted(tokens: np.ndarray) -> tuple[int, int]:
    """How many of a set's tokens in hash order are posted, and how many of them lie in the counted region: the region's,
    or the prefix where that is more."""
    region = int(np.searchsorted(tokens, REGION))
    return max(region, prefix_length(len(tokens))), region


@dataclass
class Filter:
    """A Bloom filter of one hash: bounded bits, so it saturates with size and then only lets more rows through to the
    exact joins behind it."""

    words: np.ndarray

    @staticmethod
    def of(values: DataFrame, column: Column) -> Filter:
        low = column.bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
        bit = F.expr("shiftleft(1L, CAST(low & 63 AS int))")
        rows = values.select(low.alias("low")).select(F.shiftright("low", 6).alias("word"), bit.alias("bit"))
        found = rows.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        return Filter(words.view(np.uint64))

    def holds(self, values: np.ndarray) -> np.ndarray:
        low = values & np.uint64((1 << FILTER_BITS) - 1)
        return (self.words[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _rows(docs: DataFrame, start, schema: str) -> DataFrame:
    """Rows from documents: ``start()`` builds, once per task, a function of (doc_id, text) that yields column arrays of
    equal length, in the order of the schema. Batches leave as they fill."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = begun(start)
        held: list[list] = []
        n = 0

        def flush():
            columns = [pa.concat_arrays(c) if isinstance(c[0], pa.Array) else pa.array(np.concatenate(c)) for c in zip(*held)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                made = make(doc_id, text.as_py())
                if made is not None and len(made[0]):
                    held.append(made)
                    n += len(made[0])
                    if n >= BATCH_ROWS:
                        yield flush()
                        held, n = [], 0
        if held:
            yield flush()

    return map_batches(docs.select("doc_id", "text"), run, schema)


class _Once:
    """Whether a name is new to this task, as far as the last SEEN names tell: spares work, decides nothing."""

    def __init__(self):
        self.seen: set = set()

    def __call__(self, name) -> bool:
        if name in self.seen:
            return False
        if len(self.seen) >= SEEN:
            self.seen.clear()
        self.seen.add(name)
        return True


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, key of every document (n 0: no words), and a hash of its text, which Spark's xxhash64 gives as well."""

    def start():
        shingles = Shingler()

        def make(doc_id, text):
            tokens = shingles(text)
            text_hash = np.array([xxhash.xxh64_intdigest((text or "").encode(), 42)], np.uint64).view(np.int64)
            numbers = [np.array([len(tokens)], np.int64), np.array([set_key(tokens)], np.int64), text_hash]
            return [pa.array([doc_id], pa.int64()), *numbers]

        return make

    return _rows(docs, start, "doc_id long, n long, key long, text_hash long")


def _mixed(key: int, doc_id: int | None) -> np.ndarray:
    """What filters hold of a set's first document."""
    return np.array([key ^ (doc_id or 0)], np.int64).view(np.uint64)


def _tokens(docs: DataFrame, firsts) -> DataFrame:
    """token: every token that is posted."""

    def start():
        shingles, once, keep = Shingler(), _Once(), firsts.value

        def make(doc_id, text):
            tokens = shingles(text)
            if len(tokens) and keep.holds(_mixed(key := set_key(tokens), doc_id))[0] and once(key):
                return [tokens[: posted(tokens)[0]].view(np.int64)]

        return make

    return _rows(docs, start, "token long")


def _postings(docs: DataFrame, firsts, live) -> DataFrame:
    """token, key, n, place (in hash order), region: of posted tokens, those that ``live`` holds."""

    def start():
        shingles, once, keep, tokens_kept = Shingler(), _Once(), firsts.value, live.value

        def make(doc_id, text):
            tokens = shingles(text)
            if not len(tokens) or not keep.holds(_mixed(key := set_key(tokens), doc_id))[0] or not once(key):
                return None
            count, region = posted(tokens)
            places = np.flatnonzero(tokens_kept.holds(tokens[:count]))
            n = len(places)
            return [
                tokens[places].view(np.int64), np.full(n, key, np.int64), np.full(n, len(tokens), np.int32),
                places.astype(np.int32), np.full(n, region, np.int32),
            ]

        return make

    return _rows(docs, start, "token long, key long, n int, place int, region int")


def _token_sets(docs: DataFrame, wanted) -> DataFrame:
    """doc_id, key, tokens of the documents that ``wanted`` holds by key and doc_id."""

    def start():
        shingles, once, keep = Shingler(), _Once(), wanted.value

        def make(doc_id, text):
            tokens = shingles(text)
            key = set_key(tokens)
            if not len(tokens) or not keep.holds(_mixed(key, doc_id))[0] or not once((key, doc_id)):
                return None
            return [pa.array([doc_id], pa.int64()), np.array([key], np.int64), pa.array([tokens.view(np.int64)], pa.list_(pa.int64()))]

        return make

    return _rows(docs, start, "doc_id long, key long, tokens array<long>")


def _least() -> Column:
    """The smallest overlap of a set of n with a similar set."""
    s = SIMILARITY
    return F.floor((F.col("n") * s.numerator + (s.denominator - 1)) / F.lit(s.denominator)).cast("int")


def _length(shared) -> Column:
    """``prefix_length`` of n as a column."""
    return F.least(F.col("n"), F.col("n") - _least() + shared)


def candidates(docs: DataFrame, firsts) -> DataFrame:
    """key: the sets that can have a similar one, and some more. ``firsts`` (a broadcast filter of the sets' first documents)
    spares the work on most copies; a copy it lets through only makes tokens look more frequent, which keeps more sets.

    The global order of this step puts tokens of the counted region that stand in one set only first, then the region's
    others, then all others by hash. A set whose prefix in that order holds no token of a second set has no similar one.
    """
    spark = docs.sparkSession
    counts = _tokens(docs, firsts).groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").select("token")
    counts = landed(counts, "tokens")
    live = spark.sparkContext.broadcast(Filter.of(counts, F.col("token")))
    rows = _postings(docs, firsts, live).join(counts, "token", "left_semi")
    counted = F.col("place") < F.col("region")
    per_set = rows.groupBy("key").agg(
        F.first("n").alias("n"), F.first("region").alias("region"),
        F.sum(counted.cast("int")).alias("live"), F.min(F.when(~counted, F.col("place"))).alias("place"),
    )
    first_live = F.when(F.col("live") > 0, F.col("region") - F.col("live")).otherwise(F.col("place"))
    return per_set.filter(first_live < _length(1)).select("key")


def _live(sets: DataFrame, step: int) -> DataFrame:
    """key, n, token, df of the tokens that more than one set holds, and ``share``, how many of them the set has. A set with
    fewer than it must share with a similar one is left out."""
    rows = sets.select("key", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    counts = landed(rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), f"counts-{step}")
    rows = rows.join(counts, "token")
    shares = rows.groupBy("key").agg(F.first("n").alias("n"), F.count("*").cast("int").alias("share"))
    shares = landed(shares.filter(F.col("share") >= _least()).select("key", "share"), f"shares-{step}")
    return rows.join(shares, "key")


def prefixes(sets: DataFrame) -> DataFrame:
    """token, key, n, share, need, before (how many shared tokens of the set come before this one): the prefix of every set
    (key, tokens), without tokens that no other prefix can hold.

    The global order puts rare tokens first, by the number of sets that hold them, ties by hash. A set's prefix has
    ``prefix_length(n, need)`` tokens. Among similar sets x and y at
    least min(need of x, need of y) tokens are in both prefixes, so each set may pick its own ``need``: the one with the
    lowest estimated cost, which is the entries its prefix meets in the token lists, plus the candidates to verify, at
    most those entries divided by ``need``. A set asks for no more tokens than it must share with a similar one, which for
    a small set are fewer than MOST_SHARED.
    """
    # Once the sets that lack shared tokens are gone, more tokens stand in one set only.
    some = _live(sets, 1).select("key").distinct()
    rows = _live(landed(sets.join(some, "key", "left_semi"), "shared-sets"), 2)
    per_set = Window.partitionBy("key")
    at = F.col("n") - F.col("share") + F.row_number().over(per_set.orderBy("df", "token")) - 1
    ranked = rows.withColumn("at", at).filter(F.col("at") < _length(MOST_SHARED))

    def cost(need: int) -> Column:
        met = F.sum(F.when(F.col("at") < _length(need), F.col("df") - 1).otherwise(0)).over(per_set)
        priced = F.struct((met * (1.0 + VERIFY_COST / need)).alias("cost"), F.lit(need).alias("need"))
        return F.when(_least() >= need, priced)  # else null, which array_min leaves out

    best = F.array_min(F.array(*map(cost, range(1, MOST_SHARED + 1))))["need"]
    chosen = ranked.withColumn("need", best).filter(F.col("at") < _length(F.col("need")))
    before = (F.col("at") - (F.col("n") - F.col("share"))).cast("int").alias("before")
    return chosen.select("token", "key", "n", "share", "need", before)


def _near(n: Column, m: Column, share_n: Column, share_m: Column) -> Column:
    """Whether sets of these sizes can be similar that have so many tokens other sets have, too: the overlap of similar sets
    is at least n + m times SIMILARITY / (1 + SIMILARITY)."""
    s = SIMILARITY / (1 + SIMILARITY)
    return F.least(share_n, share_m) * s.denominator >= (n + m) * s.numerator


def _with_hubs(entries: DataFrame, seed: int) -> DataFrame:
    """Entries (token, key, n, share, need, before, component) with a hub for each token: its set with the smallest hash of this round.
    Tokens of one component only are left out, since nothing can be linked there any more.

    The minima combine before the shuffle and form a table of their own, so a frequent token can be split in the join.
    """
    rank = F.struct(F.xxhash64("key", F.lit(seed)).alias("rank"), "key", "n", "share", "component")
    tokens = entries.groupBy("token").agg(
        F.min(rank).alias("hub"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    hubs = landed(tokens.filter("low <> high").select("token", "hub"), "hubs")
    joined = entries.select("token", "key", "n", "share", "need", "before", "component").join(hubs, "token")
    return joined.withColumns({f"hub_{c}": F.col(f"hub.{c}") for c in ("key", "n", "share", "component")}).drop("hub")


def _hub_pairs(entries: DataFrame) -> DataFrame:
    """a, b: each set with the hub it shares most prefix tokens with, outside its component: one pair per entry at most,
    however many sets a token has."""
    pairs = entries.filter((F.col("component") != F.col("hub_component")) & _near(*map(F.col, ("n", "hub_n", "share", "hub_share"))))
    counted = pairs.groupBy(F.col("key").alias("a"), F.col("hub_key").alias("b")).agg(F.count("*").alias("shared"))
    return counted.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("most")).select("a", "most.b")


def _around_hubs(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """key, component, hub, differing, excess, centre: the sets that are about the same as the hub they share most prefix
    tokens with, and the tokens that only one of the two has.

    Sets x and y of one hub differ in d = m_x + m_y - 2s tokens, where s of their m differing tokens are the same ones. They
    are similar if d is at most n_x + n_y times (1 - SIMILARITY) / (1 + SIMILARITY), so if ``excess`` of x and of y
    together is at most twice s (times a denominator). ``centre`` is the hub's set of the smallest excess.
    """
    r = (1 - SIMILARITY) / (1 + SIMILARITY)
    alike = entries.filter("hub_n <= 2 * n AND n <= 2 * hub_n")
    counted = alike.groupBy("key", "hub_key").agg(F.count("*").alias("shared"), F.first("component").alias("component"))
    most = counted.groupBy("key").agg(F.max(F.struct("shared", "hub_key")).alias("most"), F.first("component").alias("component"))
    most = landed(most.select("key", "component", F.col("most.hub_key").alias("hub")), "hub-of")
    both = most.join(sets, "key").join(sets.select(F.col("key").alias("hub"), F.col("tokens").alias("of_hub")), "hub")
    differing = F.concat(F.array_except("tokens", "of_hub"), F.array_except("of_hub", "tokens"))
    rows = both.select("key", "component", "hub", F.size("tokens").alias("n"), differing.alias("differing"))
    excess = F.size("differing") * r.denominator - F.col("n") * r.numerator
    rows = landed(rows.filter("size(differing) <= n").withColumn("excess", excess).drop("n"), "members")
    centres = landed(rows.groupBy("hub").agg(F.min(F.struct("excess", "key", "component")).alias("centre")), "centres")
    return landed(rows.join(centres, "hub"), "around")


def _pairs_around(around: DataFrame) -> DataFrame:
    """a, b: of the sets of one hub, those of different components that can be similar.

    Where the excess of two sets is zero or less together, they are similar to the centre, which has no more than either:
    one pair per set will do. Others must have differing tokens in common. In an order that puts rare ones first, the first
    common one has enough tokens of either set from it on. Components that meet are paired first.
    """
    twice = 2 * ((1 - SIMILARITY) / (1 + SIMILARITY)).denominator
    stars = around.filter((F.col("excess") + F.col("centre.excess") <= 0) & (F.col("component") != F.col("centre.component")))
    rows = around.select("hub", "key", "component", "excess", F.col("centre.excess").alias("least"), F.explode("differing").alias("token"))
    counts = landed(rows.groupBy("hub", "token").agg(F.count("*").alias("df")).filter("df > 1"), "differing")
    rest = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("df"), F.desc("token")))
    ranked = rows.join(counts, ["hub", "token"]).withColumn("rest", rest)
    prefix = landed(ranked.filter(F.col("rest") * twice >= F.col("excess") + F.col("least")).drop("df", "least"), "differing-prefixes")

    groups = prefix.groupBy("hub", "token", "component").agg(F.min("excess").alias("excess"), F.max("rest").alias("rest"))
    groups = landed(groups, "differing-groups")
    enough = lambda a, b: F.least(f"rest_{a}", f"rest_{b}") * twice >= F.col(f"excess_{a}") + F.col(f"excess_{b}")
    part = lambda rows, x, c, *more: rows.select(
        "hub", "token", F.col("component").alias(c), *[F.col(m).alias(f"{m}_{x}") for m in ("excess", "rest", *more)]
    )
    meet = part(groups, "c", "c").join(part(groups, "d", "d"), ["hub", "token"]).filter((F.col("c") < F.col("d")) & enough("c", "d"))
    meet = meet.drop("excess_c", "rest_c")
    some = meet.join(part(prefix, "a", "c", "key"), ["hub", "token", "c"]).filter(enough("a", "d")).drop("excess_d", "rest_d")
    pairs = some.join(part(prefix, "b", "d", "key"), ["hub", "token", "d"])
    pairs = pairs.filter(enough("a", "b") & (F.col("excess_a") + F.col("excess_b") > 0))
    pairs = pairs.select(F.col("key_a").alias("a"), F.col("key_b").alias("b")).distinct()
    return stars.select(F.col("key").alias("a"), F.col("centre.key").alias("b")).unionByName(pairs)


def _reach(a: str, b: str) -> Column:
    """Whether sets (or the best of two groups) that share a token can be similar, by its place in both. If it is their k-th
    common token, the overlap is at most k - 1 and the live tokens from it on, of either; k is no larger than the tokens
    they must share, and no more tokens are common before it than either set has there."""
    s = SIMILARITY / (1 + SIMILARITY)
    common = F.least(f"rest_{a}", f"rest_{b}") + F.least(f"before_{a}", f"before_{b}", F.col(f"need_{a}") - 1, F.col(f"need_{b}") - 1)
    return common * s.denominator >= (F.col(f"n_{a}") + F.col(f"n_{b}")) * s.numerator


def _all_pairs(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: all sets of different components that can be similar: those of one hub by the tokens in which they differ from
    it, which tells near copies of one text apart, the others by as many shared prefix tokens as either needs.

    Components that meet at a token are paired first; only then are their sets, so no work goes into the pairs within a
    component, however large it is.
    """
    around = _around_hubs(entries, sets)
    entries = entries.select("token", "key", "n", "need", "before", (F.col("share") - F.col("before")).alias("rest"), "component")
    entries = entries.join(around.select("key", "hub"), "key", "left").withColumn("hub", F.coalesce("hub", "key"))
    entries = landed(entries, "last-entries")
    most = [F.min("n").alias("n"), *[F.max(c).alias(c) for c in ("need", "before", "rest")]]
    groups = landed(entries.groupBy("token", "component", "hub").agg(*most), "groups")
    part = lambda rows, x, c, *more: rows.select(
        "token", F.col("component").alias(c), F.col("hub").alias(f"hub_{c}"), *[F.col(m).alias(f"{m}_{x}") for m in ("n", "need", "before", "rest", *more)]
    )
    meet = part(groups, "c", "c").join(part(groups, "d", "d"), "token")
    meet = meet.filter((F.col("c") < F.col("d")) & (F.col("hub_c") != F.col("hub_d")) & _reach("c", "d"))
    meet = meet.drop(*[f"{m}_c" for m in ("n", "need", "before", "rest")])
    some = meet.join(part(entries, "a", "c", "key"), ["token", "c", "hub_c"]).filter(_reach("a", "d"))
    some = some.drop(*[f"{m}_d" for m in ("n", "need", "before", "rest")])
    pairs = some.join(part(entries, "b", "d", "key"), ["token", "d", "hub_d"]).filter(_reach("a", "b"))
    shared = pairs.groupBy(F.col("key_a").alias("a"), F.col("key_b").alias("b")).agg(
        F.count("*").alias("shared"), F.min(F.least("need_a", "need_b")).alias("need")
    )
    return shared.filter("shared >= need").select("a", "b").unionByName(_pairs_around(around))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar, by their whole sets. Pairs form a table first: where they are few, as they are
    after the first round, Spark sees it and leaves the sets where they lie."""
    pairs = landed(pairs, "pairs")
    first = sets.select(F.col("key").alias("a"), F.col("tokens").alias("tokens_a"))
    second = sets.select(F.col("key").alias("b"), F.col("tokens").alias("tokens_b"))
    both = pairs.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - common
    return both.filter(common * SIMILARITY.denominator >= union * SIMILARITY.numerator).select("a", "b")


def groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables: doc_id, n, key, text_hash per document; and key, component_id per set with words.

    1. Documents with equal sets are one from here on. 2. Sets without a possible partner go, by counts over all documents;
    the others get adaptive prefixes. 3. In a few rounds each set is
    compared with one hub that shares most of its prefix; what is linked forms components, so a large group of near copies
    is held together by as many links as it has members. 4. All pairs across components that share enough prefix tokens, or
    around one hub enough of the tokens in which they differ from it, are compared. Every link joins two sets that step 3 put into one component or that step 4 compares, so the components are
    exactly those of the full join. Comparisons use the whole sets.

    Null text, and text without words, is an empty set, linked with nothing. A null doc_id is no name for a component: a
    group of only such documents has a null component_id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = landed(_sets(docs), "sets")
    spark = docs.sparkSession
    member = F.col("key").bitwiseXOR(F.coalesce("doc_id", F.lit(0)))
    first = landed(named.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id")), "firsts")
    firsts = spark.sparkContext.broadcast(Filter.of(first, member))
    wanted = landed(first.join(candidates(docs, firsts), "key", "left_semi"), "wanted")
    keep = spark.sparkContext.broadcast(Filter.of(wanted, member))
    mine = wanted.select(F.col("key").alias("its_key"), F.col("doc_id").alias("its_doc"))
    found = _token_sets(docs, keep)
    same = (F.col("key") == F.col("its_key")) & F.col("doc_id").eqNullSafe(F.col("its_doc"))
    sets = landed(found.join(mine, same, "left_semi").dropDuplicates(["key"]).select("key", "tokens"), "token-sets")
    prefix = landed(prefixes(sets), "prefixes")
    entries = landed(_with_hubs(prefix.withColumn("component", F.col("key")), 0), "entries")

    labels = None
    for step in range(HUB_ROUNDS + 1):
        pairs = _hub_pairs(entries) if step < HUB_ROUNDS else _all_pairs(entries, sets)
        links = _similar(pairs, sets)
        if labels is not None:  # a component so far is a star around its name, which the first round draws together
            links = links.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        labels = components(links)
        if step < HUB_ROUNDS:
            named_by = labels.select(F.col("node").alias("key"), F.col("component").alias("now"))
            labelled = entries.drop("component").join(named_by, "key", "left")
            labelled = landed(labelled.withColumn("component", F.coalesce("now", "key")), f"labelled-{step}")
            entries = landed(_with_hubs(labelled, step + 1), f"entries-{step + 1}")

    whole = first.join(labels.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "doc_id", F.coalesce("component", "key").alias("component")
    )
    smallest = whole.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # A table of its own, so that a set with very many documents can be split in the join.
    return named, landed(whole.join(smallest, "component").select("key", "component_id"), "ids")


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id per document: the number of its different shingles, and the smallest doc_id that
    links lead to."""
    named, ids = groups(docs)
    linked = named.filter("n > 0").join(ids, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = named.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, as it is: that with the smallest doc_id (ties: the smallest hash of the text; of rows
    alike in both, one). Documents without words are groups of their own.

    Most documents are decided without a shuffle: a bounded filter of those to remove lets them through at once. Only what
    it holds meets the table of removed documents in a join.
    """
    named, ids = groups(docs)
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    rows = named.filter("n > 0").join(ids.withColumnRenamed("component_id", "group_id"), "key")
    rows = rows.select(F.coalesce("group_id", "key").alias("group_id"), F.col("group_id").isNull().alias("unnamed"), member.alias("member"))
    kept = rows.groupBy("group_id", "unnamed").agg(F.min("member").alias("keeper"))
    others = rows.join(landed(kept, "keepers"), ["group_id", "unnamed"])
    different = others.filter(F.col("member") != F.col("keeper")).select("member.doc_id", "member.text_hash", F.lit(False).alias("first"))
    # Rows alike in doc_id and text: one of them stays.
    alike = others.filter(F.col("member") == F.col("keeper")).groupBy("member").agg(F.count("*").alias("rows")).filter("rows > 1")
    alike = alike.select("member.doc_id", "member.text_hash", F.lit(True).alias("first"))
    doubtful = landed(different.unionByName(alike).distinct(), "doubtful")
    name = F.coalesce("doc_id", F.lit(0))
    held = docs.sparkSession.sparkContext.broadcast(Filter.of(doubtful, name.bitwiseXOR(F.col("text_hash"))))

    def only(inside: bool):
        def start():
            bits = held.value

            def keep(batch: pa.RecordBatch) -> np.ndarray:
                ids = batch.column("doc_id").cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                texts = [xxhash.xxh64_intdigest((t.as_py() or "").encode(), 42) for t in batch.column("text")]
                return bits.holds(ids.astype(np.int64).view(np.uint64) ^ np.array(texts, np.uint64)) == inside

            return keep

        return rows_where(docs, start)

    looked_at = only(True).select(F.struct("*").alias("row"))
    at = doubtful.select(F.struct(F.col("doc_id"), F.col("text_hash")).alias("at"), "first")
    place = F.struct(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("text_hash")
    )
    met = looked_at.withColumn("at", place).join(at, "at", "left")
    stay = met.filter("first IS NULL").select("row.*")
    once = met.filter("first").dropDuplicates(["at"]).select("row.*")
    return only(False).unionByName(stay).unionByName(once)
