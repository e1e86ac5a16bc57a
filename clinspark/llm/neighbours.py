"""Nearest neighbours by inner product, with a vantage-point tree per shard.

Vantage-point trees need a metric.  With M the largest norm of all vectors, a vector x gets
one more component sqrt(M^2 - |x|^2) and a query q a zero there; then the squared distance
is |q|^2 + M^2 - 2 q.x, and the nearest vectors are those with the largest inner product.

Vectors are dealt to shards by their length and a hash of their id and row: an inner product
needs vectors of one length, so those of another length are no candidates of a query.  A shard
collapses equal vectors, builds its tree, and takes the queries in batches: at a node all queries of a batch are compared
with the vantage point, go to the nearer child first and then, as far as the triangle
inequality lets them, to the other.  A child is skipped if its lower bound times ``factor``
exceeds the distance of the worst neighbour so far: factor 1 is exact, larger ones skip more.
The best of all shards are merged with a window per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.llm.common import shuffle_partitions
from clinspark.session import stage

SHARDS = 16  # at least
SHARD_ROWS = 1 << 18  # a shard's vectors and tree are in one task's memory
LEAF = 96
BATCH = 1024


class VantageTree:
    def __init__(self, vectors: np.ndarray, largest: float, seed: int = 5):
        self.vectors, self.square = vectors, largest * largest
        self.rest = np.sqrt(np.maximum(0.0, self.square - (vectors * vectors).sum(axis=1)))
        self.random = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(vectors)))

    def _build(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members, np.ascontiguousarray(self.vectors[members].T)
        # Of a few candidates, the vantage point whose distances to a few others spread most.
        tried = self.random.choice(members, 5, replace=False)
        others = self.random.choice(members, 50, replace=False)
        vantage = max(tried.tolist(), key=lambda v: float(self._distances(v, others).std()))
        distances = self._distances(vantage, members)
        order = np.argsort(distances, kind="stable")
        half = len(members) // 2
        sides = []
        for part in (order[:half], order[half:]):
            sides.append((distances[part[0]], distances[part[-1]], self._build(members[part])))
        return vantage, sides

    def _distances(self, vantage: int, members: np.ndarray) -> np.ndarray:
        apart = self.vectors[members] - self.vectors[vantage]
        return np.sqrt((apart * apart).sum(axis=1) + (self.rest[members] - self.rest[vantage]) ** 2)

    def search(self, queries: np.ndarray, k: int, factor: float) -> np.ndarray:
        """For each query the positions of its ``k`` best vectors (-1 where there are fewer), in no order."""
        best = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), -1)
        level = (queries * queries).sum(axis=1) + self.square
        reach = np.full(len(queries), np.inf)
        slack = 1e-7 * np.sqrt(level)

        def visit(node, rows: np.ndarray) -> None:
            if isinstance(node[1], np.ndarray):
                members, columns = node
                scores = queries[rows] @ columns
                better = scores.max(axis=1) > best[rows].min(axis=1)
                rows, scores = rows[better], scores[better]
                if not len(rows):
                    return
                both = np.concatenate([best[rows], scores], axis=1)
                ids = np.concatenate([found[rows], np.broadcast_to(members, scores.shape)], axis=1)
                top = np.argpartition(-both, k - 1, axis=1)[:, :k]
                best[rows] = np.take_along_axis(both, top, 1)
                found[rows] = np.take_along_axis(ids, top, 1)
                worst = best[rows].min(axis=1)
                reach[rows] = np.sqrt(np.maximum(0.0, level[rows] - 2 * worst))
                return
            vantage, sides = node
            away = np.sqrt(np.maximum(0.0, level[rows] - 2 * (queries[rows] @ self.vectors[vantage])))
            bounds = [np.maximum(0.0, np.maximum(low - away, away - high)) for low, high, _ in sides]
            inner_first = away <= (sides[0][1] + sides[1][0]) / 2
            for side, turn in ((0, inner_first), (1, ~inner_first), (1, inner_first), (0, ~inner_first)):
                go = turn & (bounds[side] * factor <= reach[rows] + slack[rows])
                if go.any():
                    visit(sides[side][2], rows[go])

        if len(queries) and len(self.vectors):
            visit(self.root, np.arange(len(queries)))
        return found


MANY_OWN = 16  # points of a query's own id beyond which all points are scored for that query


def _enough(ids: np.ndarray, k: int) -> np.ndarray:
    """Of sorted ids those that leave ``k`` rows, whichever id is taken out: ``k`` of each of the first ``k`` + 1 ids."""
    new = np.append(True, ids[1:] != ids[:-1])
    starts = np.flatnonzero(new)
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids))))
    return ids[(place < k) & (np.cumsum(new) <= k + 1)]


class Shard:
    """The vectors of a shard; equal ones are one point of its tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        as_bytes = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, group = np.unique(as_bytes, return_index=True, return_inverse=True)
        by_group = np.argsort(group, kind="stable")  # ids of a group stay in order
        starts = np.searchsorted(group[by_group], np.arange(len(first) + 1))
        self.ids = [_enough(ids[by_group[a:b]], k) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        pairs = np.unique(np.stack([ids, group]), axis=1)[0]  # each id once for each of its points
        self.owners, self.points = np.unique(pairs, return_counts=True)
        self.vectors = vectors[first]
        self.tree = VantageTree(self.vectors, largest)

    def answer(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> Iterator[tuple]:
        """Rows (query id, vector id, score): the ``k`` best of this shard for each query."""
        at = np.minimum(np.searchsorted(self.owners, query_ids), len(self.owners) - 1)
        own = np.where(self.owners[at] == query_ids, self.points[at], 0)
        some = own <= MANY_OWN
        extra = max(1, int(own[some].max(initial=1)))  # own points may be among the best
        found = self.tree.search(queries[some], min(k + extra, len(self.ids)), factor)
        every = np.arange(len(self.ids))
        lists = iter(found)
        for query_id, query, few in zip(query_ids.tolist(), queries, some.tolist(), strict=True):
            points = next(lists) if few else every
            points = points[points >= 0]
            scores = (self.vectors[points] * query).sum(axis=1)  # alike for equal vectors, wherever they are
            ids = [self.ids[p] for p in points]
            scores = np.repeat(scores, [len(i) for i in ids])
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            other = ids != query_id
            ids, scores = ids[other], scores[other]
            top = np.lexsort((ids, -scores))[:k]
            yield np.full(len(top), query_id), ids[top], scores[top]


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``embedding`` (doubles) of the rows that take part.

    Null ids, which could not be named, and vectors that are null, empty, all zero, or hold a null or a
    number that is not finite, do not.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (
        embeddings.select(F.col("vec_id").cast("long"), F.col(vector).cast("array<double>").alias("embedding"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull())
        .where(~bad & F.exists(x, lambda v: v != 0))
    )


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 1.0,
    shards: int = SHARDS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the ``k`` best of each query.

    ``is_query`` is a condition on ``vec_id``.  Every row is a candidate, so an id that several rows
    have can come several times; of such an id the smallest vector is the query.  Rows of the
    query's own id, and vectors of another length than the query's, are no candidates.  Nearest
    first, ties to the smaller ``vec_id``; with fewer candidates, all of them.
    """
    salted = usable(embeddings).withColumn("salt", F.monotonically_increasing_id())
    rows = stage(salted, "vectors")
    square = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v)
    facts = rows.agg(F.count("*").alias("n"), F.max(square).alias("square")).first()
    largest = float(np.sqrt(facts["square"] or 0.0)) * (1 + 1e-12)
    shards = max(shards, -(-facts["n"] // shard_rows))
    spark = embeddings.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))

    def run(batches):
        shard, ids, vectors, index = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0).to_numpy()
            is_query = batch.column(1).to_numpy(zero_copy_only=False)
            vec_id = batch.column(2).to_numpy()
            ends = batch.column(3).offsets.to_numpy()  # rows of a shard have one length
            numbers = batch.column(3).values.to_numpy(zero_copy_only=False)
            part = lambda a, b: numbers[ends[a] : ends[b]].reshape(b - a, -1)  # noqa: E731, B023
            cuts = np.flatnonzero((at[1:] != at[:-1]) | (is_query[1:] != is_query[:-1])) + 1
            for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(at)).tolist(), strict=True):
                if at[a] != shard:
                    shard, ids, vectors, index = at[a], [], [], None
                if not is_query[a]:
                    ids.append(vec_id[a:b])
                    vectors.append(part(a, b))
                    continue
                if not ids:
                    continue
                if index is None:
                    index = Shard(np.concatenate(ids), np.concatenate(vectors), largest, k)
                rows = list(index.answer(vec_id[a:b], part(a, b), k, factor))
                columns = [pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    first = F.size("embedding").cast("long") * shards  # the first shard of vectors of that length
    stored = rows.select(
        (first + F.pmod(F.xxhash64("vec_id", "salt"), F.lit(shards))).alias("shard"),
        F.lit(0).cast("byte").alias("kind"),
        "vec_id",
        "embedding",
    )
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = queries.select(
        F.explode(F.sequence(first, first + shards - 1)).alias("shard"), F.lit(1).cast("byte").alias("kind"), "vec_id", "embedding"
    )
    by_shard = (
        stored.union(asked)
        .repartition(max(shards, shuffle_partitions(spark)), "shard")
        .sortWithinPartitions("shard", "kind", "vec_id")
        .mapInArrow(run, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        by_shard.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
