"""Prefix trie of conversations by van Emde Boas recursion: depths are cut in halves, and halves of halves, all at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.tables import landed

# A conversation starts with up to MOST_SHARED turns of the first conversation of its group of GROUP ids.
GROUP, MOST_SHARED = 20, 3
# The ids that end at a node are joined in pieces of 2**PIECE_BITS consecutive ids.
PIECE_BITS = 8
WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()


def _digest(c: Column) -> Column:
    """128 bits that stand for a value."""
    return F.substring(F.unhex(F.sha2(c, 256)), 1, 16)


def numbered(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 0), token (stands for role and text), words of every turn, landed.

    Turns are numbered after one sort of the whole table by ranges, so a conversation that holds most of the rows is spread
    over many tasks: a turn's number is its place among the conversation's rows in its range, and those in earlier ranges.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        role.alias("role"),
        _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("token"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "token", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = landed(placed.select("conv", "token", "words", F.shiftright("place", 33).alias("range"), "place"), "placed")
    ranges = placed.groupBy("conv", "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("conv", "range", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return landed(placed.join(starts, ["conv", "range"]).select("conv", (F.col("place") + F.col("shift")).alias("pos"), "token", "words"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv, depth (from 1), token, words of every turn of the rebuilt conversations; and conv, depth of their last turns
    (0: none). A conversation takes its first h turns from the first one of its group, where that has them."""
    h = F.crc32(F.col("conv").cast("string")) % (MOST_SHARED + 1)
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("base"))
    first = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = own.join(first, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = landed(convs.select("conv", "base", "n", "h", "taken"), "convs")
    rest = turns.join(convs.select("conv", "h", "taken"), "conv").filter("pos >= h")
    rest = rest.select("conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "token", "words")
    heads = turns.filter(F.col("pos") < MOST_SHARED).select(F.col("conv").alias("base"), "pos", "token", "words")
    heads = heads.join(convs.select("conv", "base", "h"), "base").filter("pos < h")
    heads = heads.select("conv", (F.col("pos") + 1).alias("depth"), "token", "words")
    ends = convs.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("depth"))
    return landed(rest.unionByName(heads), "rebuilt"), ends


def name_prefixes(rows: DataFrame, deepest: int) -> DataFrame:
    """conv, depth, name of every prefix of every sequence (conv, depth from 1, token); equal prefixes have equal names.

    Halves are joined upward: a block of 2^k turns that ends at a multiple of 2^k is named by its two halves. Then prefixes
    are named downward, from the cut at half depth on: the prefix of length d is the one without the lowest bit of d, which
    an earlier round has named, and the block between. Each level is one equi-join by (conv, depth) for all sequences and
    blocks at once, on half as many rows as the level below it, and no step needs a whole sequence in one place.
    """
    blocks = [rows.select("conv", "depth", F.col("token").alias("name"))]
    for k in range(1, deepest.bit_length()):
        half, whole = 1 << (k - 1), 1 << k
        left = blocks[-1].filter(F.col("depth") % whole == half).select("conv", (F.col("depth") + half).alias("depth"), F.col("name").alias("left"))
        blocks.append(landed(blocks[-1].join(left, ["conv", "depth"]).select("conv", "depth", _digest(F.concat("left", "name")).alias("name")), "blocks"))
    named = None
    for k, level in reversed([*enumerate(blocks)]):
        size = 1 << k
        cut = level.filter(F.col("depth") % (2 * size) == size).withColumn("before", F.col("depth") - size)
        if named is None:  # only the cut at half depth, whose upper part starts at the root
            found = cut.withColumn("upper", F.lit(ROOT))
        else:
            upper = named.select("conv", F.col("depth").alias("before"), F.col("name").alias("upper"))
            found = cut.join(upper, ["conv", "before"], "left")
        found = found.select("conv", "depth", _digest(F.concat(F.coalesce("upper", F.lit(ROOT)), "name")).alias("name"))
        found = landed(found, "names")
        named = found if named is None else named.unionByName(found)
    return named


def _graft(totals: DataFrame, nodes: DataFrame, prefixes: DataFrame, deepest: int) -> DataFrame:
    """name, leaves, saved of the whole subtree below every node, from those of the nodes alone.

    After round k a node holds the total of its block of 2^k depths: the forests below each half-depth cut are done, so each
    of their roots is grafted onto its ancestors in the upper half. A root of depth d has 2^(k-1) of them, and such depths
    are one in 2^k, so a round makes about half as many rows as there are nodes, and there are log2(depth) rounds.
    """
    for k in range(1, deepest.bit_length() + 1):
        half, whole = 1 << (k - 1), 1 << k
        roots = nodes.filter(F.col("depth") % whole == half).join(totals, "name")
        up = roots.select("conv", F.explode(F.sequence(F.col("depth") - half, F.col("depth") - 1)).alias("depth"), "leaves", "saved")
        at = up.join(prefixes, ["conv", "depth"], "left").select(F.coalesce("name", F.lit(ROOT)).alias("name"), "leaves", "saved")
        totals = landed(totals.unionByName(at).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "totals")
    return totals


def _digests_of_ends(ends: DataFrame) -> DataFrame:
    """name, ends_sha256 over the ascending ids (conv) of every name. Ids are joined in pieces of bounded size; the pieces
    of a name stream through its hash in order, so no task holds them."""
    pieces = ends.groupBy("name", F.shiftright("conv", PIECE_BITS).alias("piece")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    pieces = pieces.select("name", "piece", F.concat_ws(",", F.transform("ids", lambda c: c.cast("string"))).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        row = lambda: pa.RecordBatch.from_pydict({"name": [current], "ends_sha256": [digest.hexdigest()]})
        for batch in batches:
            done = []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if name == current:
                    digest.update(b"," + ids.encode())
                else:
                    if current is not None:
                        done.append(row())
                    current, digest = name, hashlib.sha256(ids.encode())
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if current is not None:
            yield row()

    dealt = pieces.repartition("name").sortWithinPartitions("name", "piece")
    return dealt.select("name", "ids").mapInArrow(run, "name binary, ends_sha256 string")


def grow(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The trie over sequences (conv, depth from 1, token, words) with their ``ends`` (conv, depth of the last turn, 0: none).

    One row per node, that is, per different prefix: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. Without sequences there is no node, not even the root.
    """
    top = ends.agg(F.min("conv"), F.count(F.lit(1)), F.max("depth")).first()
    smallest, members, deepest = top[0], top[1], top[2] or 0
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = rows.sparkSession.createDataFrame([(ROOT, None, smallest, 0, members, 0)] if members else [], "name binary, parent binary, conv long, depth long, n_convs long, words long")
    if deepest:
        prefixes = name_prefixes(rows, deepest)
        found = prefixes.groupBy("name", "depth").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"))
        above = prefixes.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
        found = found.join(rows.select("conv", "depth", "words"), ["conv", "depth"]).join(above, ["conv", "depth"], "left")
        found = found.select("name", F.coalesce("parent", F.lit(ROOT)).alias("parent"), "conv", "depth", "n_convs", "words")
        nodes = landed(found.unionByName(root), "nodes")
    else:
        prefixes, nodes = None, root
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = landed(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    totals = nodes.select("name", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    if deepest:
        totals = _graft(totals, nodes.select("name", "conv", "depth"), prefixes, deepest)
        at = ends.join(prefixes, ["conv", "depth"], "left").select("conv", F.coalesce("name", F.lit(ROOT)).alias("name"))
    else:
        at = ends.select("conv", F.lit(ROOT).alias("name"))
    # The root may have very many children; its id is known. Other large families are split as skewed joins are.
    parents = nodes.filter("depth > 0 AND n_children > 0").select(F.col("name").alias("parent"), F.col("conv").alias("above"))
    whole = nodes.join(totals, "name").join(_digests_of_ends(at), "name", "left").join(parents, "parent", "left")
    parent = F.when(F.col("depth") == 1, F.lit(smallest).cast("long")).otherwise(F.col("above"))
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    ).select(*columns)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations.

    Turns are in the order of turn (null first), then role, then a digest of role and text; null role or text is empty.
    Equal rows are turns of their own. Rows without conv_id take no part; an empty table has no node. c % 20 has the sign of
    c, as in SQL. Other columns are not looked at.
    """
    return grow(*rebuilt(numbered(conversations)))


def oracle() -> str:
    """The query as DuckDB SQL: prefixes as lists, every node with all its ancestors. CRC-32 is folded bit by bit."""
    steps = "flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: [CAST(ascii(x) AS BIGINT)] || repeat([CAST(-1 AS BIGINT)], 8)))"
    fold = (
        "list_reduce([CAST(4294967295 AS BIGINT)] || " + steps + ", lambda a, y: CASE WHEN y >= 0 THEN xor(a, y) "
        "ELSE xor(a >> 1, (a & 1) * CAST(3988292384 AS BIGINT)) END)"
    )
    return rf"""
    WITH turns AS (
        SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k,
            {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
        FROM conversations WHERE conv_id IS NOT NULL
    ), own AS (
        SELECT c, list(t ORDER BY k) AS ts, xor({fold}, CAST(4294967295 AS BIGINT)) % {MOST_SHARED + 1} AS h FROM turns GROUP BY c
    ), whole AS (
        SELECT own.c, coalesce(base.ts[:own.h], []) || own.ts[own.h + 1:] AS ts
        FROM own LEFT JOIN own AS base ON base.c = own.c - own.c % {GROUP}
    ), prefixes AS (SELECT c, d, ts[:d] AS p, len(ts) AS n FROM whole, unnest(range(0, len(ts) + 1)) AS u(d)
    ), nodes AS (
        SELECT p, d, min(c) AS c, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends,
            CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(p[d].text, '[^\x20\x09-\x0D]+')) END AS words
        FROM prefixes GROUP BY p, d
    ), children AS (SELECT p[:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
    ), facts AS (
        SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)
    ), totals AS (
        SELECT p[:a] AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n - 1) * words) AS saved
        FROM facts, unnest(range(0, d + 1)) AS u(a) GROUP BY 1
    )
    SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, above.c AS parent_conv_id, f.n AS n_convs, f.n_children,
        CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
    FROM facts AS f JOIN totals ON totals.p = f.p LEFT JOIN facts AS above ON f.d > 0 AND above.p = f.p[:f.d - 1]
    """
