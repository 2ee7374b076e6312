"""Hard negatives by slots of the scores that the positives' upper limits make."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.shards import streamed
from tallybrook.scratch import written

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
#: Components of a shard, and of the scores that are worked out at once.
SHARD_NUMBERS = 1 << 23
LEAST_SHARD_ROWS = 2048
_SCORES = 1 << 22
_EXACT = 2.0**53


class Vectors:
    """Vectors of one length as whole numbers, with their ids and labels."""

    def __init__(self, rows: pa.Table | pa.RecordBatch) -> None:
        rows = rows.combine_chunks() if isinstance(rows, pa.Table) else rows
        lists = rows.column("vector")
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        self.ids = rows.column("id").to_numpy()
        self.labels = rows.column("label").to_numpy()
        numbers = lists.flatten().to_numpy(zero_copy_only=False)
        self.points = np.floor(numbers * SCALE).reshape(len(self.ids), -1 if len(numbers) else 0)
        self.most = float(np.abs(self.points).max(initial=0))

    def __len__(self) -> int:
        return len(self.ids)


def scores(queries: Vectors, some: np.ndarray, rows: Vectors, part: slice) -> np.ndarray:
    """Inner products as whole numbers; beyond 64 bits they are an error.

    Products of floating-point numbers are exact as long as their sums stay below 2 to
    the 53. Larger ones are worked out in whole numbers of any size.
    """
    left, right = queries.points[some], rows.points[part]
    if queries.most * rows.most * max(1, left.shape[1]) < _EXACT:
        return (left @ right.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    found = np.array(whole(left), object) @ np.array(whole(right), object).T
    if found.size and max(abs(found.min()), abs(found.max())) >= 2**63:
        raise OverflowError("a score does not fit in 64 bits")
    return found.astype(np.int64)


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by smaller id."""
    places = np.arange(len(score))
    if len(score) > k:
        places = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return places[np.lexsort((ids[places], -score[places]))][:k]


def _labelled(vectors: DataFrame) -> DataFrame:
    """``id, label, vector, dims`` of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(whole, F.lit(False)))
    return kept.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.size("embedding").alias("dims"),
    )


def _by_label(rows: pa.Table) -> Vectors:
    return Vectors(rows.take(pa.array(np.argsort(rows.column("label").to_numpy(), kind="stable"))))


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])


def _positives(k: int):
    """The best rows of each anchor's label that the shard has."""

    def answer(shard: Vectors, batch: pa.RecordBatch) -> pa.RecordBatch | None:
        asked, found = Vectors(batch), []
        for label in np.unique(asked.labels):
            low, high = np.searchsorted(shard.labels, label), np.searchsorted(shard.labels, label, "right")
            some = np.flatnonzero(asked.labels == label)
            step = max(1, _SCORES // max(1, high - low))
            for at in range(0, len(some) if high > low else 0, step):
                part = some[at : at + step]
                for row, anchor in zip(scores(asked, part, shard, slice(low, high)), asked.ids[part].tolist(), strict=True):
                    other = np.flatnonzero(shard.ids[low:high] != anchor)
                    ids, score = shard.ids[low:high][other], row[other]
                    best = _first(score, ids, k)
                    found.append((np.full(len(best), anchor), ids[best], score[best]))
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], schema=_POSITIVE)

    return answer


_CANDIDATE = pa.schema(
    [("anchor_id", pa.int64()), ("slot", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]
)


def _candidates(k: int):
    """The best rows of other labels in each slot of each anchor."""

    def answer(shard: Vectors, batch: pa.RecordBatch) -> pa.RecordBatch | None:
        asked, found = Vectors(batch), []
        limits, lowest = batch.column("limits").to_pylist(), batch.column("lowest").to_pylist()
        step = max(1, _SCORES // len(shard))
        for at in range(0, len(asked), step):
            part = np.arange(at, min(at + step, len(asked)))
            for row, i in zip(scores(asked, part, shard, slice(None)), part.tolist(), strict=True):
                upper = limits[i]
                fits = np.flatnonzero((row <= upper[0]) & (row >= lowest[i]) & (shard.labels != asked.labels[i]))
                score, ids = row[fits], shard.ids[fits]
                for slot, limit in enumerate(upper):
                    inside = score <= limit
                    if slot + 1 < len(upper):
                        inside &= score > upper[slot + 1]
                    inside = np.flatnonzero(inside)
                    best = inside[_first(score[inside], ids[inside], k)]
                    found.append((np.full(len(best), asked.ids[i]), np.full(len(best), slot, np.int32), ids[best], score[best]))
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], schema=_CANDIDATE)

    return answer


def _share(score: Column, percent: int, up: bool) -> Column:
    """``percent`` of a score that isn't negative, rounded down or up, with no product beyond 64 bits."""
    rest = (score % 100) * percent + (99 if up else 0)
    return F.call_function("div", score, F.lit(100)) * percent + F.call_function("div", rest, F.lit(100))


def hard_negatives(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    every: int = EVERY,
) -> DataFrame:
    """Per anchor and positive, the first ``negatives`` rows that score a share of the positive.

    ``vectors`` has ``vec_id, embedding, label``; rows with a NULL in these, or with a NULL or
    non-finite component, take no part. Anchors are the rows whose id is divisible by
    ``every``. A score is the inner product of floor(256 x) of the components; higher ones
    come first, ties by smaller id. An anchor's positives are its first other rows of its
    label. Rows of another label are negatives of a positive if they score ``low`` to
    ``high`` percent of it. So a positive below 0 has none. Only vectors of one length
    are compared; empty ones score 0. Rows with the anchor's own id are not its positives;
    repeated rows count as often as they are there, but of an anchor's the smallest label and
    vector ask. Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.

    Shards of all rows are read twice, with all anchors streamed through each: first for
    positives, then with the limits these set. The upper limits of an anchor cut the
    scores into slots that don't overlap. The best of each slot are kept by shard and put
    together over shards. A window is a slot and what lies below it, so the best of a
    window are those of its slot followed by those of the next window below.
    """
    rows = written(_labelled(vectors), "labelled")
    size = rows.agg(F.count(F.lit(1)), F.max("dims")).first()
    total, longest = size[0], max(1, size[1] or 0)
    spark = vectors.sparkSession
    parallel = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // LEAST_SHARD_ROWS))
    count = max(1, parallel, -(-total * longest // SHARD_NUMBERS))
    shard = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(count)).cast("int")
    none = {"limits": F.lit(None).cast("array<long>"), "lowest": F.lit(None).cast("long")}
    placed = rows.withColumn("shard", shard).withColumns(none)
    anchors = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "vector", "dims")).alias("own"))
    anchors = written(anchors.select("id", "own.*"), "anchors")
    each = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    keys = ["dims", "shard"]

    asked = anchors.withColumn("shard", each).withColumns(none)
    near = streamed(placed, asked, keys, _by_label, _positives(positives), "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    near = near.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    near = near.filter("positive_score >= 0").select(
        "anchor_id",
        "positive_id",
        "positive_score",
        "place",
        _share(F.col("positive_score"), low, True).alias("lower"),
        _share(F.col("positive_score"), high, False).alias("upper"),
    )
    near = written(near, "positives")
    windows = near.groupBy("anchor_id").agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("lowest")
    )
    windows = written(windows, "windows")

    asked = anchors.join(windows, F.col("id") == F.col("anchor_id")).drop("anchor_id").withColumn("shard", each)
    found = streamed(
        placed, asked, keys, Vectors, _candidates(negatives), "anchor_id long, slot int, negative_id long, negative_score long"
    )
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.col("negative_score").desc(), "negative_id")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= negatives)
    # From the lowest slot up: a window's best are its slot's, then the next window's.
    slots = found.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("slot", "place", "negative_id", "negative_score"))).alias("slots")
    )
    slots = slots.join(windows, "anchor_id")

    def above(known: Column, slot: Column) -> Column:
        own = F.filter("slots", lambda one: one["slot"] == slot)
        under = F.coalesce(F.get(known, F.lit(0)), F.slice("slots", 1, 0))
        return F.concat(F.array(F.slice(F.concat(own, under), 1, negatives)), known)

    upwards = F.reverse(F.sequence(F.lit(0), F.size("limits") - 1))
    merged = slots.withColumn("merged", F.aggregate(upwards, F.array().cast("array<array<struct<slot:int,place:int,negative_id:bigint,negative_score:bigint>>>"), above))
    of_each = near.join(merged.select("anchor_id", "limits", "merged"), "anchor_id")
    own = F.get("merged", (F.array_position("limits", F.col("upper")) - 1).cast("int"))
    fitting = F.filter(own, lambda one: one["negative_score"] >= F.col("lower"))
    ranked = of_each.select("anchor_id", "positive_id", "positive_score", F.posexplode(fitting).alias("at", "one"))
    return ranked.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.negative_id").alias("negative_id"),
        "positive_score",
        F.col("one.negative_score").alias("negative_score"),
    )


#: Rows whose label is wrong on purpose, and how many labels there are.
MOVED, LABELS = 7, 10


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % MOVED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")))


ORACLES = {
    "op13_negatives": f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
 AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
}
