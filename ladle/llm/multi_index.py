"""Nearest neighbours by largest inner product with an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm.memo import per_batch
from ladle.session import ensure_checkpoint_dir

NEIGHBOURS = 20
QUERY_EVERY = 20
# Codebooks are fitted on at most so many vectors, and have at most so many centroids per half.
FIT_ROWS, MOST_CENTROIDS = 20_000, 1024
CELL_ROWS = 64
# How far to search is measured on so many queries: until this share of their true neighbours is met.
MEASURED_QUERIES, RECALL = 128, 0.95
# Vectors that are compared in one go, and queries that a group of vectors meets in one task.
UNIT_ROWS, UNIT_QUERIES = 2048, 50_000


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """In double precision, summed from the first component to the last, so that a score never depends on its company."""
    total = np.zeros((len(queries), len(vectors)))
    for k in range(queries.shape[1]):
        total += queries[:, k, None] * vectors[None, :, k]
    return total


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> list[np.ndarray]:
    """Per row the places of the ``most`` highest finite scores, highest first, ties to smaller ids."""
    found = []
    for row in scores:
        places = np.flatnonzero(row > -np.inf)
        if len(places) > most:
            least = np.partition(row[places], len(places) - most)[len(places) - most]
            places = places[row[places] >= least]
        found.append(places[np.lexsort((ids[places], -row[places]))[:most]])
    return found


def floors(asked: np.ndarray, paths: list[list[int]], vectors: np.ndarray, cells: np.ndarray, most: int) -> np.ndarray:
    """Per query a score that ``most`` of the given vectors in its cells reach: what scores less is not among its best. Where
    its cells hold fewer of them there is none. The vectors are picked by products of matrices and scored exactly."""
    found = np.full(len(asked), -np.inf)
    for i in range(0, len(asked), 128):
        for q, scores in enumerate(asked[i : i + 128] @ vectors.T, i):
            places = np.flatnonzero(np.isin(cells, paths[q]))
            if len(places) >= most:
                high = places[np.argpartition(scores[places], len(places) - most)[len(places) - most :]]
                found[q] = inner_products(asked[q : q + 1], vectors[high]).min()
    return found


@dataclass
class Codebook:
    """Centroids of both halves of a vector, and how far their vectors spread around each."""

    centroids: list[np.ndarray]
    spreads: list[np.ndarray]

    @property
    def size(self) -> int:
        return len(self.centroids[0])

    def halves(self, vectors: np.ndarray) -> list[np.ndarray]:
        cut = self.centroids[0].shape[1]
        return [vectors[:, :cut], vectors[:, cut:]]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector: its nearest centroids, first half times K plus second half."""
        near = [nearest(part, c) for part, c in zip(self.halves(vectors), self.centroids)]
        return near[0] * self.size + near[1]

    def distances(self, query: np.ndarray) -> list[np.ndarray]:
        """Per half the negative of the inner product to expect of a centroid's better vectors; their sum over the halves
        orders the cells."""
        parts = [h[0] for h in self.halves(query[None])]
        return [-(c @ q + 2 * np.linalg.norm(q) * s) for q, c, s in zip(parts, self.centroids, self.spreads)]

    def traverse(self, query: np.ndarray, filled: np.ndarray) -> Iterator[int]:
        """Cells by growing summed distance. The heap holds the frontier: a pair of ranks (a, b) comes in once (a-1, b) and
        (a, b-1) are out, so only cells that are visited, and their neighbours, are ever looked at."""
        first, second = self.distances(query)
        order, along = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        d, e = first[order].tolist(), second[along].tolist()
        out = [0] * (len(d) + 1)  # per rank of the first half, how many of the second are out
        heap = [(d[0] + e[0], 0, 0)]
        while heap:
            _, a, b = heapq.heappop(heap)
            out[a] = b + 1
            cell = int(order[a]) * self.size + int(along[b])
            if filled[cell]:
                yield cell
            if b + 1 < len(e) and (a == 0 or out[a - 1] > b + 1):
                heapq.heappush(heap, (d[a] + e[b + 1], a, b + 1))
            if a + 1 < len(d) and out[a + 1] == b:
                heapq.heappush(heap, (d[a + 1] + e[b], a + 1, b))

    def visited(self, query: np.ndarray, counts: np.ndarray, budget: int) -> list[int]:
        """Cells in order until they hold ``budget`` vectors together."""
        cells, held = [], 0
        for cell in self.traverse(query, counts):
            cells.append(cell)
            held += int(counts[cell])
            if held >= budget:
                break
        return cells


def nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return ((centroids**2).sum(axis=1) - 2 * rows @ centroids.T).argmin(axis=1)


def fit(sample: np.ndarray, centroids: int, rounds: int = 12, seed: int = 7) -> Codebook:
    """k-means on each half."""
    cut, rng = sample.shape[1] // 2, np.random.default_rng(seed)
    fitted, spreads = [], []
    for rows in (sample[:, :cut], sample[:, cut:]):
        c = rows[rng.choice(len(rows), centroids, replace=False)]
        for _ in range(rounds):
            near = nearest(rows, c)
            n, total = np.bincount(near, minlength=centroids), np.zeros_like(c)
            np.add.at(total, near, rows)
            c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        near = nearest(rows, c)
        n = np.maximum(np.bincount(near, minlength=centroids), 1)
        error = np.bincount(near, ((rows - c[near]) ** 2).sum(axis=1), centroids) / n / max(rows.shape[1], 1)
        fitted.append(c)
        spreads.append(np.sqrt(error))
    return Codebook(fitted, spreads)


@dataclass
class Layout:
    """Cells in groups of about UNIT_ROWS vectors. A larger cell is a group of its own, in several chunks. A group that
    very many queries visit is there in several replicas, and each query visits one of them."""

    group: np.ndarray
    chunks: np.ndarray
    replicas: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, visits: np.ndarray) -> Layout:
        group, chunks, now, held = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
        for cell, n in enumerate(counts.tolist()):
            if held and held + n > UNIT_ROWS:
                now, held = cell, 0
            group[cell] = now
            held += n
            chunks[cell] = max(1, -(-n // UNIT_ROWS))
        total = np.bincount(group, chunks > 1, len(counts))
        # A large cell stands alone in its group but for empty ones, so its chunks are the group's.
        chunks = np.where(total[group] > 0, np.maximum.reduceat(chunks, np.unique(group))[np.searchsorted(np.unique(group), group)], 1)
        replicas = np.maximum(1, -(-np.bincount(group, visits, len(counts)).astype(np.int64) // UNIT_QUERIES))
        return Layout(group, chunks, replicas[group])


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """embedding, ids: each different vector with the smallest NEIGHBOURS + 1 of its vec_ids.

    Equal vectors score alike and ties go to smaller ids, so no later copy can be among a query's nearest. The limit is
    applied before the shuffle as well, so a vector with very many copies sends few rows.
    """
    once = vectors.dropDuplicates(["vec_id", "embedding"])
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    first = once.withColumn("nth", rank).filter(F.col("nth") <= NEIGHBOURS + 1)
    return first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Vectors that take part, and their number of components (the most frequent one; ties: the smaller). Vectors that are
    null, zero, of another length or with null or non-finite components take no part, nor do rows without a vec_id."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & e.isNotNull() & fine)
    sizes = rows.groupBy(F.size(e).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = sizes["dims"] if sizes else 0
    return rows.filter(F.size(e) == dims), dims


def search(vectors: DataFrame, every: int = QUERY_EVERY, neighbours: int = NEIGHBOURS, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: for each vec_id divisible by ``every`` its nearest others.

    1. Different vectors get cells from codebooks that were fitted on a bounded sample; every vector is in the index.
    2. Some queries are searched in full. Where in their traversal the true neighbours turn up tells how many vectors a
       query has to visit, so that ``recall`` of them are met. That number is a property of the data: small where vectors
       cluster, a share of all where they are noise.
    3. Each different query vector visits that many vectors, cell by cell, and scores them exactly. Those that score less
       than as many vectors of the sample in its cells as are asked for go at once.
    4. Scores go back from different vectors to all their vec_ids, and from query vectors to all their query_ids.

    What the driver holds is bounded: the sample, the codebooks, and counts per cell (MOST_CENTROIDS squared at most).
    """
    spark = vectors.sparkSession
    ensure_checkpoint_dir(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows, dims = usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    if not dims:
        return spark.createDataFrame([], schema)
    most = neighbours + 1
    table = distinct_vectors(rows).withColumn("gid", F.monotonically_increasing_id()).checkpoint()
    asked = rows.filter(F.col("vec_id") % every == 0).distinct().join(table.select("embedding", "gid"), "embedding")
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("gid").alias("query")).checkpoint()
    queries = table.join(asked.select(F.col("query").alias("gid")).distinct(), "gid", "left_semi")

    total = table.count()
    centroids = int(2 ** np.clip(np.round(np.log2(max(total / CELL_ROWS, 1)) / 2), 0, np.log2(MOST_CENTROIDS)))
    few = table.orderBy(F.xxhash64("gid")).select("embedding").limit(FIT_ROWS).toArrow()
    sample = matrix(few.column(0).combine_chunks(), dims)
    book = fit(sample, min(centroids, len(sample)))
    held = spark.sparkContext.broadcast(book)

    def into_cells():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cells = held.value.cells(matrix(batch.column("embedding"), dims))
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], [*batch.schema.names, "cell"])

        return work

    element = table.schema["embedding"].dataType.simpleString()
    members = table.select("gid", F.get("ids", F.lit(0)).alias("first_id"), "embedding")
    members = per_batch(members, into_cells, f"gid long, first_id long, embedding {element}, cell int")
    counts = np.zeros(book.size**2, np.int64)
    found = members.groupBy("cell").count().toArrow().to_pandas()
    counts[found["cell"]] = found["count"]
    budget = _budget(members, queries, book, counts, dims, most, recall)
    numbers = spark.sparkContext.broadcast((counts, budget, sample, book.cells(sample)))

    def through_cells():
        counts, budget, *some = numbers.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            asked = matrix(batch.column("embedding"), dims)
            cells = [held.value.visited(q, counts, budget) for q in asked]
            columns = [*batch.columns, pa.array(cells, pa.list_(pa.int32())), pa.array(floors(asked, cells, *some, most))]
            return pa.RecordBatch.from_arrays(columns, ["query", "embedding", "cells", "floor"])

        return work

    paths = queries.select(F.col("gid").alias("query"), "embedding")
    paths = per_batch(paths, through_cells, f"query long, embedding {element}, cells array<int>, floor double").checkpoint()
    visits = np.zeros(len(counts), np.int64)

    def count_cells():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cells, n = np.unique(batch.column("cells").flatten().to_numpy(), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(n, pa.int64())], ["cell", "n"])

        return work

    seen = per_batch(paths.select("cells"), count_cells, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = seen.toArrow().to_pandas()
    visits[seen["cell"]] = seen["n"]
    layout = spark.sparkContext.broadcast(Layout.of(counts, visits))
    scored = _rerank(members, paths, layout, dims, most, element)

    nearest_vectors = Window.partitionBy("query").orderBy(F.desc("score"), "first_id")
    top = scored.withColumn("nth", F.row_number().over(nearest_vectors)).filter(F.col("nth") <= most)
    ids = table.select("gid", "ids")
    copies = top.join(ids, "gid").select("query", "score", F.explode("ids").alias("vec_id"))
    copies = copies.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    # A bounded list: at most ``most`` vectors of at most ``most`` copies.
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id", "score")))
    lists = copies.groupBy("query").agg(F.slice(order, 1, most).alias("near")).withColumnRenamed("query", "gid").checkpoint()
    others = F.filter("near", lambda n: n["vec_id"] != F.col("query_id"))
    result = asked.join(lists, asked["query"] == lists["gid"]).select(
        "query_id", F.posexplode(F.slice(others, 1, neighbours)).alias("place", "near")
    )
    return result.select("query_id", (F.col("place") + 1).alias("rank"), "near.vec_id", "near.score")


def _budget(members, queries, book: Codebook, counts: np.ndarray, dims: int, most: int, recall: float) -> int:
    """How many vectors a query visits: enough for ``recall`` of the true neighbours of some queries, which are compared
    with all vectors. Per task and query only ``most`` rows leave; the driver gets them for MEASURED_QUERIES queries."""
    spark = members.sparkSession
    some = queries.select("gid", "embedding").orderBy(F.xxhash64("gid", F.lit(1))).limit(MEASURED_QUERIES).toArrow()
    if not some.num_rows:
        return 1
    asked, asked_ids = matrix(some.column("embedding").combine_chunks(), dims), some.column("gid").to_numpy()
    held = spark.sparkContext.broadcast((asked, asked_ids))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, asked_ids = held.value
        tops: list[list[tuple]] = [[] for _ in asked_ids]
        for batch in batches:
            gids, cells = batch.column("gid").to_numpy(), batch.column("cell").to_numpy()
            vectors = matrix(batch.column("embedding"), dims)
            for i in range(0, len(gids), UNIT_ROWS):
                scores = inner_products(asked, vectors[i : i + UNIT_ROWS])
                scores[asked_ids[:, None] == gids[None, i : i + UNIT_ROWS]] = -np.inf
                for q, places in enumerate(best(scores, gids[i : i + UNIT_ROWS], most)):
                    new = [(-scores[q, p], int(gids[i + p]), int(cells[i + p])) for p in places]
                    tops[q] = heapq.nsmallest(most, tops[q] + new)
        rows = [(q, -s, cell) for q, top in enumerate(tops) for s, _, cell in top]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, (pa.int32(), pa.float64(), pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "score", "cell"])

    ranked = members.mapInArrow(exact, "query int, score double, cell int")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    truth = ranked.withColumn("nth", nth).filter(F.col("nth") < most).select("query", "cell").toArrow().to_pandas()
    needed = []
    for q, cells in truth.groupby("query")["cell"]:
        order = np.array(list(book.traverse(asked[q], counts)))
        met = np.zeros(len(counts), np.int64)
        met[order] = np.cumsum(counts[order])
        needed += met[cells.to_numpy()].tolist()
    # A query meets as many others as it returns, however small the cells are.
    return max(most, int(np.quantile(needed, recall))) if needed else most


def _rerank(members: DataFrame, paths: DataFrame, layout, dims: int, most: int, element: str) -> DataFrame:
    """query, gid, first_id, score: of each group of cells the best vectors of each query that visits it.

    Vectors and visits meet in a shuffle by (group, chunk, replica) and are sorted so that the vectors come first. A task
    holds the vectors of one unit, a bounded number, and streams the queries past them.
    """
    unit = ["unit", "chunk", "replica"]
    kinds = f"unit long, chunk int, replica int, kind int, id long, first_id long, embedding {element}, cells array<int>, floor double"

    def spread_members():
        plan = layout.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cells, gids = batch.column("cell").to_numpy(), batch.column("gid").to_numpy()
            at = np.repeat(np.arange(len(cells)), plan.replicas[cells])
            replica = np.concatenate([np.arange(plan.replicas[c]) for c in cells]) if len(cells) else np.zeros(0)
            chunk = (gids * 2654435761 >> 7) % plan.chunks[cells]
            columns = [
                pa.array(plan.group[cells][at]), pa.array(chunk[at], pa.int32()), pa.array(replica, pa.int32()),
                pa.array(np.zeros(len(at)), pa.int32()), batch.column("gid").take(pa.array(at)),
                batch.column("first_id").take(pa.array(at)), batch.column("embedding").take(pa.array(at)),
                pa.array(cells[at, None].tolist(), pa.list_(pa.int32())), pa.nulls(len(at), pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in kinds.split(", ")])

        return work

    def spread_visits():
        plan = layout.value

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for i, (query, cells) in enumerate(zip(batch.column("query").to_pylist(), batch.column("cells"))):
                cells = np.sort(cells.values.to_numpy())
                groups, starts = np.unique(plan.group[cells], return_index=True)
                for g, part in zip(groups.tolist(), np.split(cells, starts[1:])):
                    replica = (query * 2654435761 >> 7) % int(plan.replicas[part[0]])
                    rows += [(g, c, replica, 1, query, None, i, part) for c in range(int(plan.chunks[part[0]]))]
            columns = list(zip(*rows)) if rows else [[]] * 8
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            at = pa.array(columns[6], pa.int64())
            arrays += [batch.column("embedding").take(at), pa.array(columns[7], pa.list_(pa.int32())), batch.column("floor").take(at)]
            return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in kinds.split(", ")])

        return work

    both = per_batch(members, spread_members, kinds).unionByName(per_batch(paths, spread_visits, kinds))
    met = both.repartition(*unit).sortWithinPartitions(*unit, "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        vectors = cells = ids = firsts = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in [*unit, "kind"]], axis=1)
            cuts = [0, *(1 + np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                part, key = batch.slice(a, b - a), tuple(keys[a, :3])
                if key != now:
                    now, held, vectors = key, [], None
                if keys[a, 3] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue  # a chunk that no vector fell into
                if vectors is None:
                    vectors = np.concatenate([matrix(p.column("embedding"), dims) for p in held])
                    cells = np.concatenate([p.column("cells").flatten().to_numpy() for p in held])
                    ids = np.concatenate([p.column("id").to_numpy() for p in held])
                    firsts = np.concatenate([p.column("first_id").to_numpy() for p in held])
                    order = np.argsort(cells, kind="stable")
                    vectors, cells, ids, firsts = vectors[order], cells[order], ids[order], firsts[order]
                for i in range(0, part.num_rows, 256):
                    yield from score(part.slice(i, 256), vectors, cells, ids, firsts)

    def score(part, vectors, cells, ids, firsts) -> Iterator[pa.RecordBatch]:
        asked, paths = matrix(part.column("embedding"), dims), part.column("cells")
        scores = np.full((len(asked), len(vectors)), -np.inf)
        owner, visited = np.repeat(np.arange(len(asked)), paths.value_lengths().to_numpy()), paths.flatten().to_numpy()
        for cell in np.unique(visited):
            a, b = np.searchsorted(cells, [cell, cell + 1])
            if b > a:
                who = owner[visited == cell]
                scores[who, a:b] = inner_products(asked[who], vectors[a:b])
        scores[scores < part.column("floor").to_numpy()[:, None]] = -np.inf
        places = best(scores, firsts, most)
        who, places = np.repeat(np.arange(len(asked)), [len(p) for p in places]), np.concatenate(places).astype(np.int64)
        names, queries = ["query", "gid", "first_id", "score"], part.column("id").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries[who]), pa.array(ids[places]), pa.array(firsts[places]), pa.array(scores[who, places])], names
        )

    return met.mapInArrow(compare, "query long, gid long, first_id long, score double")
