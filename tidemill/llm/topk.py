"""Exact top-k search: segment statistics bound the scores, coarse to fine; survivors are scored exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.llm.common import stored

#: Segments a vector is cut into, coarse to fine.
LEVELS = (1, 4, 16)
#: Queries that are sent to the tasks together; more come in several passes over the vectors.
BLOCK = 8192
#: Query-candidate pairs that are bounded at once, and survivors whose rows are laid side by side at once.
_PAIRS, _SIDE_BY_SIDE = 1 << 20, 1 << 15


def summary(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Segment means and deviations, each times the square root of the segment's length, side by side.

    The inner product of two such rows is an upper bound of the inner product of the vectors: in each segment the
    means contribute their product exactly, and the rest at most the product of the deviations. It is the same as the
    lower bound of the squared distance by differences of means and deviations.
    """
    parts = [p for p in np.array_split(np.arange(vectors.shape[1]), segments) if len(p)]
    means, deviations = [], []
    for p in parts:
        part = vectors[:, p[0] : p[-1] + 1]
        mean = part.mean(axis=1)
        means.append(mean * np.sqrt(len(p)))
        deviations.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
    return np.stack(means + deviations, axis=1) if parts else np.zeros((len(vectors), 1))


def products(mine: np.ndarray, theirs: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows."""
    out = np.empty(len(q), mine.dtype)
    for start in range(0, len(q), _SIDE_BY_SIDE):
        some = slice(start, start + _SIDE_BY_SIDE)
        out[some] = np.einsum("ij,ij->i", mine[q[some]], theirs[c[some]])
    return out


class Block:
    """Queries of one length, with their best candidates so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        real = vectors.astype(np.float64)
        self.summaries = [summary(real, s) for s in LEVELS]
        self.norms = np.sqrt((real**2).sum(axis=1))
        self.best_of = np.empty(0, np.int64)
        self.best_id = np.empty(0, np.int64)
        self.best = np.empty(0, np.int64)
        self.least = np.full(len(ids), -np.inf)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(16, _PAIRS // max(1, len(self.ids)))
        for start in range(0, len(ids), step):
            self._offer(ids[start : start + step], vectors[start : start + step])

    def _offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        real = vectors.astype(np.float64)
        norms = np.sqrt((real**2).sum(axis=1))
        # The bounds are rounded; this is far more than their rounding errors.
        slack = 1e-9 * (1 + self.norms.max(initial=0)) * (1 + norms.max(initial=0))
        least = self.least - slack
        summaries = [summary(real, s) for s in LEVELS]
        bound = self.summaries[0] @ summaries[0].T
        q, c = np.nonzero((bound >= least[:, None]) & (self.ids[:, None] != ids))
        for mine, theirs in zip(self.summaries[1:], summaries[1:], strict=True):
            keep = products(mine, theirs, q, c) >= least[q]
            q, c = q[keep], c[keep]
        score = products(self.vectors, vectors, q, c)
        keep = score >= self.least[q]
        q, found, score = q[keep], ids[c[keep]], score[keep]
        if not len(q):
            return
        of = np.concatenate([self.best_of, q])
        candidates = np.concatenate([self.best_id, found])
        scores = np.concatenate([self.best, score])
        order = np.lexsort((candidates, -scores, of))
        of, candidates, scores = of[order], candidates[order], scores[order]
        first = np.searchsorted(of, of)
        kept = np.arange(len(of)) - first < self.k
        self.best_of, self.best_id, self.best = of[kept], candidates[kept], scores[kept]
        full = np.bincount(self.best_of, minlength=len(self.ids)) >= self.k
        last = np.searchsorted(self.best_of, np.arange(len(self.ids)), "right") - 1
        self.least[full] = self.best[last[full]]


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors, by length."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(1)
    edges = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(edges)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield ids[rows], values[edges[rows][:, None] + np.arange(size)].astype(np.int64)


def _usable(vector: Column) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def top_k(
    df: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of each query by integer inner product.

    A component x counts as floor(scale * x). Queries are the rows whose id is divisible by ``every``; candidates all
    rows with another id and a vector of the same length. Ties go to the smaller id. Rows with a null id take no part,
    nor do vectors that are null or have a null or non-finite component. Equal query rows are one query; a repeated
    candidate row takes a rank for each repeat. No rows, or no queries, give no rows. Scores must fit 64 bits.

    Queries travel to the tasks in blocks of at most about BLOCK; each task keeps the k best of each query over all it
    reads, so that k rows for each query and task meet in the end.
    """
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    usable = df.where(F.col(f"`{id_col}`").isNotNull() & _usable(vector))
    vectors = usable.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), whole.alias("vector"))
    queries = stored(vectors.where(F.col("vec_id") % every == 0).distinct(), "queries")
    blocks = -(-queries.count() // BLOCK)
    folder = scratch_path(spark, "best")
    for block in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        by_size = [pair for batch in own.combine_chunks().to_batches() for pair in _vectors(batch)]
        shared = spark.sparkContext.broadcast(by_size)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = {v.shape[1]: Block(ids, v, k) for ids, v in shared.value}
            for batch in batches:
                for ids, vectors in _vectors(batch):
                    if vectors.shape[1] in found:
                        found[vectors.shape[1]].offer(ids, vectors)
            for b in found.values():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.ids[b.best_of]), pa.array(b.best_id), pa.array(b.best)], ["query_id", "vec_id", "score"]
                )

        schema = "query_id long, vec_id long, score long"
        vectors.mapInArrow(run, schema).write.mode("append").parquet(folder)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = spark.read.parquet(folder).withColumn("rank", F.row_number().over(order))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def oracle_sql(k: int = 10, every: int = 100, scale: int = 1024) -> str:
    return f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % {every} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= {k}
"""
