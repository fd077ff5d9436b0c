"""Exact top-k inner products by block-at-a-time pruning.

Integer vectors are documents of signed terms: dimension d is one term where it is positive and
another where it is negative.  Candidates stay where they are read: a task takes ``GROUP`` of
them at a time, orders them so that similar ones are neighbours (by the nearest of some of
themselves, then by how near), and cuts them into blocks; a block has a forward index (its
matrix) and, per term, the largest value in it.  For a query, blocks are taken in order of their
summed term maxima (an upper bound of every score in the block) and scored through the forward
index until the bound falls below the k-th score so far; equal bounds are still scored, as ties
go to the smaller id.  Blocks are taken in growing strides, and a block is scored at once for all
queries that still want it.

The k-th score is carried from group to group of a task, and starts from the k-th best among
``SEEDS`` candidates, a lower bound of the final one.  Queries come in chunks of ``CHUNK``, each
broadcast (its size is a constant) to a pass over the candidates: no vector is copied or
shuffled; a task gives at most k rows a query and chunk, and a window per query keeps the k best.

How much is pruned depends on the data: with independent directions in 64 dimensions a block's
bound says nothing, with clusters most blocks are never scored (figures in the README).

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter
vectors are padded with zeros (an empty one scores 0); candidates that share the query's id are
the query's own; ids that are null take no part; repeated candidates are ordinary rows, repeated
queries are one; a query without other rows returns none; empty tables give no rows.  Products
that don't fit 2^53 are summed in 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import ensure_checkpoints, kept, table

GROUP, CHUNK, BLOCK, SEEDS = 16_384, 8_192, 32, 4_096


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros; longer ones are cut (their other terms meet zeros only)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    edge = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)
    row, place = np.repeat(np.arange(len(column)), np.diff(edge)), np.arange(edge[0], edge[-1])
    col = place - np.repeat(edge[:-1], np.diff(edge))
    out = np.zeros((len(column), width), np.int64)
    held = col < width
    out[row[held], col[held]] = flat[place[held]]
    return out


def similar_order(docs: np.ndarray) -> np.ndarray:
    """An order of the rows in which similar ones are neighbours."""
    some = docs[:: max(1, int(np.sqrt(len(docs))))].astype(np.float32)
    some = some / np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-9)
    near = docs.astype(np.float32) @ some.T
    cell = near.argmax(axis=1)
    return np.lexsort((-near.max(axis=1), cell))


class Search:
    """The k best rows so far of a chunk of queries; ``scored`` of ``met`` (query, block) pairs were scored."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.kth = floor.astype(float)  # no row below can be among the k best
        self.best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)  # query, id, score
        self.scored = self.met = 0

    def add(self, ids: np.ndarray, docs: np.ndarray) -> None:
        if not len(ids) or not len(self.ids):
            return
        order = similar_order(docs)
        ids, docs = ids[order], docs[order]
        exact = int(np.abs(self.queries).max(initial=0)) * int(np.abs(docs).max(initial=0)) * max(docs.shape[1], 1) < 2**53
        queries, docs = (x.astype(np.float64 if exact else np.int64) for x in (self.queries, docs))
        starts = np.arange(0, len(ids), BLOCK)
        most, least = np.maximum.reduceat(docs, starts), np.minimum.reduceat(docs, starts)
        # term maxima: positive query components meet the largest values, negative ones the smallest
        bounds = np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T
        turn = np.argsort(-bounds, axis=1, kind="stable")
        self.met += turn.size
        low = 0
        while low < len(starts):
            blocks = turn[:, low : 2 * low + 1]
            q, j = np.nonzero(np.take_along_axis(bounds, blocks, axis=1) >= self.kth[:, None])
            if not len(q):
                break  # bounds fall from here on
            self.scored += len(q)
            block = blocks[q, j]
            by = np.argsort(block, kind="stable")
            q, block = q[by], block[by]
            edge = np.flatnonzero(np.diff(block, prepend=-1))
            found = []
            for a, b in zip(edge, np.append(edge[1:], len(q)), strict=True):
                at, mine = slice(starts[block[a]], starts[block[a]] + BLOCK), q[a:b]
                scores = docs[at] @ queries[mine].T
                d, m = np.nonzero((scores >= self.kth[mine]) & (ids[at, None] != self.ids[mine]))
                if len(d):
                    found.append((mine[m], ids[at][d], scores[d, m].astype(np.int64)))
            self._merge(found)
            low = 2 * low + 1

    def _merge(self, found: list) -> None:
        q, d, s = (np.concatenate([x, *y]) for x, y in zip(self.best, zip(*found, strict=True) if found else [()] * 3, strict=True))
        order = np.lexsort((d, -s, q))
        q, d, s = q[order], d[order], s[order]
        first = np.searchsorted(q, np.arange(len(self.ids) + 1))
        keep = np.arange(len(q)) - first[q] < self.k
        full = np.flatnonzero(np.diff(first) >= self.k)
        self.kth[full] = np.maximum(self.kth[full], s[first[full] + self.k - 1])
        self.best = q[keep], d[keep], s[keep]


def _floors(seed_ids: np.ndarray, seeds: np.ndarray, k: int):
    """(vec_id, v, floor): the k-th best score of each query among the seeds."""

    def run(batches):
        for b in batches:
            ids = b.column("vec_id").to_numpy()
            search = Search(ids, _matrix(b.column("v"), seeds.shape[1]), np.full(len(ids), -np.inf), k)
            search.add(seed_ids, seeds)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(search.kth)], ["vec_id", "v", "floor"])

    return run


def _best(shared, k: int):
    def run(batches):
        ids, queries, floor = shared.value
        search, waiting = Search(ids, queries, floor, k), []
        for b in batches:
            waiting.append(b)
            if sum(map(len, waiting)) >= GROUP:
                _take(search, waiting)
                waiting = []
        _take(search, waiting)
        q, d, s = search.best
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(d), pa.array(s)], ["query_id", "vec_id", "score"])

    return run


def _take(search: Search, batches: list) -> None:
    if batches:
        t = pa.Table.from_batches(batches)
        search.add(t.column("vec_id").to_numpy(), _matrix(t.column("v"), search.queries.shape[1]))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """vectors(vec_id long, v array<long>), queries likewise: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ensure_checkpoints(spark)
    seeds = vectors.orderBy(F.xxhash64("vec_id", "v")).limit(SEEDS).toArrow()  # for lower bounds only
    queries = queries.dropDuplicates(["vec_id"])
    width = max([queries.agg(F.max(F.size("v"))).first()[0] or 0, 1])
    first = _floors(seeds.column("vec_id").to_numpy(), _matrix(seeds.column("v"), width), k)
    asks = kept(queries.select("vec_id", "v").mapInArrow(first, "vec_id long, v array<long>, floor double"))
    chunks = max(1, -(-asks.count() // CHUNK))
    found = None
    for c in range(chunks):  # each chunk is of about CHUNK queries, and one pass over the candidates
        few = asks.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c).toArrow()
        shared = spark.sparkContext.broadcast((few.column("vec_id").to_numpy(), _matrix(few.column("v"), width), few.column("floor").to_numpy()))
        part = vectors.select("vec_id", "v").mapInArrow(_best(shared, k), "query_id long, vec_id long, score long")
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        part = part.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        part = kept(part) if chunks > 1 else part
        found = part if found is None else found.unionByName(part)
    return found


def quantized(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors whose components are all finite numbers."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    good = F.col(id_col).isNotNull() & x.isNotNull() & finite
    return df.where(good).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v :: DOUBLE[], d.v :: DOUBLE[]) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
