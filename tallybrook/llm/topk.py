"""Exact inner-product search with one KD-tree per shard of the vectors."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.shards import streamed
from tallybrook.scratch import written

K = 10
SCALE = 1024
#: A shard and one batch of queries are what a task holds at a time.
SHARD_ROWS = 8192
LEAF_ROWS = 64
EVERY = 100


@dataclass
class KdTree:
    """Median splits of integer points; every node has its tight box and smallest id."""

    points: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least_id: np.ndarray
    children: list[tuple[int, int] | None]
    rows: list[tuple[int, int]]

    @classmethod
    def of(cls, points: np.ndarray, ids: np.ndarray) -> KdTree:
        order = np.arange(len(points))
        low, high, least, children, rows = [], [], [], [], []
        waiting = [(0, len(points), -1, 0)]
        while waiting:
            start, end, parent, side = waiting.pop()
            part = order[start:end]
            inside = points[part]
            lo, hi = inside.min(axis=0), inside.max(axis=0)
            node = len(rows)
            low.append(lo)
            high.append(hi)
            least.append(ids[part].min())
            children.append(None)
            rows.append((start, end))
            if parent >= 0:
                left, right = children[parent]
                children[parent] = (node, right) if side == 0 else (left, node)
            axis = int(np.argmax(hi - lo))
            # Copies of one point cannot be split and need no split: their box is the point.
            if end - start > LEAF_ROWS and hi[axis] > lo[axis]:
                half = (end - start) // 2
                order[start:end] = part[np.argpartition(inside[:, axis], half)]
                children[node] = (-1, -1)
                waiting.append((start + half, end, node, 1))
                waiting.append((start, start + half, node, 0))
        return cls(points[order], ids[order], np.array(low), np.array(high), np.array(least), children, rows)

    def search(self, query: np.ndarray, own: int, k: int, known: int | None) -> list[tuple[int, int]]:
        """The best ``(score, id)`` of the tree, no worse than the score ``known``.

        Nodes are opened by the most that a point of their box can score. The
        search ends at a box below the kth score, which begins at ``known``, the
        one found elsewhere. A box that can only tie is opened for a smaller id.
        """
        bounds = np.maximum(self.low * query, self.high * query).sum(axis=1)
        best: list[tuple[int, int]] = []
        open_nodes = [(-int(bounds[0]), 0)]
        while open_nodes:
            bound, node = heapq.heappop(open_nodes)
            bound = -bound
            full = len(best) >= k
            if (known is not None and bound < known) or (full and bound < best[-1][0]):
                break
            if full and bound == best[-1][0] and self.least_id[node] > best[-1][1]:
                continue
            pair = self.children[node]
            if pair is not None:
                for child in pair:
                    heapq.heappush(open_nodes, (-int(bounds[child]), child))
                continue
            start, end = self.rows[node]
            scores = self.points[start:end] @ query
            worst = best[-1][0] if full else known
            ids = self.ids[start:end]
            good = ids != own
            if worst is not None:
                good &= scores >= worst
            if not good.any():
                continue
            scores, ids = scores[good], ids[good]
            first = np.lexsort((ids, -scores))[:k]
            found = best + [(int(scores[i]), int(ids[i])) for i in first]
            best = sorted(found, key=lambda pair: (-pair[0], pair[1]))[:k]
        return best


def integer_vectors(vectors: DataFrame, name: str = "embedding") -> DataFrame:
    """``vec_id, vector``: floor(1024 x) of each component, for vectors that are whole."""
    whole = F.forall(
        name,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False)))
    numbers = F.transform(name, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return kept.filter(F.size(name) > 0).select(F.col("vec_id").cast("long"), numbers.alias("vector"))


def _tree(frame: pd.DataFrame) -> KdTree:
    return KdTree.of(np.stack(frame["vector"].to_numpy()).astype(np.int64), frame["vec_id"].to_numpy())


def _home(k: int, every: int):
    def search(frame: pd.DataFrame) -> pd.DataFrame:
        tree = _tree(frame)
        asked = frame[frame["vec_id"] % every == 0]
        rows = []
        for own, vector in zip(asked["vec_id"], asked["vector"], strict=True):
            best = tree.search(np.asarray(vector, np.int64), own, k, None)
            rows.append((own, vector, best[-1][0] if len(best) == k else None))
        found = pd.DataFrame(rows, columns=["query_id", "vector", "known"])
        return found.astype({"known": "Int64", "query_id": "int64"})

    return search


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _points(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """The vectors of rows of one length, one below the other."""
    column = rows.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _shard_tree(shard: pa.Table) -> KdTree:
    return KdTree.of(_points(shard), shard.column("id").to_numpy())


def _everywhere(k: int):
    def answer(tree: KdTree, asked: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[tuple[int, int, int]] = []
        owns, known = asked.column("id").to_pylist(), asked.column("known").to_pylist()
        for own, vector, floor in zip(owns, _points(asked), known, strict=True):
            rows += [(own, found, score) for score, found in tree.search(vector, own, k, floor)]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], schema=_FOUND)

    return answer


def _check_range(longest: int, most: float) -> None:
    """Scores, and the bounds of boxes, are sums of that many products of such numbers."""
    if longest * most * most >= 2.0**63:
        raise ValueError(f"scores of {longest} components of up to {most:g} do not fit in 64 bits")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The ``k`` best other vectors of each one whose id is divisible by ``every``.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller id. Each query
    first searches the shard it lives in, a random part of all vectors. The kth score
    found there goes with it to all shards. Vectors that are NULL, empty or hold NULL or
    a number that isn't finite take no part, nor do rows without an id; only vectors
    of one length are compared. Rows of the query's own id are never its results. A
    repeated candidate is found as often as it is there; of a repeated query the smallest
    vector asks. It is an error if scores could leave 64 bits, by the longest vector and the
    largest component.

    A shard is moved to one task, which builds its tree once and has all queries streamed
    through it, so the vectors that are shuffled don't grow with the queries.
    """
    numbers = written(integer_vectors(vectors).withColumn("dims", F.size("vector")), "vectors")
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    total, longest, most = numbers.agg(F.count(F.lit(1)), F.max("dims"), F.max(largest)).first()
    if total:
        _check_range(longest, most)
    shards = max(1, -(-total // SHARD_ROWS))
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    placed = numbers.withColumn("shard", shard)
    home = placed.groupBy("dims", "shard").applyInPandas(
        _home(k, every), "query_id long, vector array<long>, known long"
    )
    asked = home.groupBy("query_id").agg(F.min(F.struct("vector", "known")).alias("q"))
    asked = written(asked.select("query_id", "q.*", F.size("q.vector").alias("dims")), "queries")
    # Every query meets every shard once: the query set against all rows.
    each = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = placed.withColumnRenamed("vec_id", "id").withColumn("known", F.lit(None).cast("long"))
    found = streamed(
        held, each.withColumnRenamed("query_id", "id"), ["dims", "shard"], _shard_tree, _everywhere(k),
        "query_id long, vec_id long, score long",
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLES = {
    "op5_topk": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {K}
"""
}
