"""Queries streamed through shards of the table that is searched."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Built = Callable[[pa.Table], Any]
Answered = Callable[[Any, pa.RecordBatch], pa.RecordBatch | None]


def streamed(shards: DataFrame, asked: DataFrame, keys: list[str], build: Built, answer: Answered, schema: str) -> DataFrame:
    """Every query that is sent to a shard, answered by what was built of that shard once.

    Both sides have the columns ``keys``, which name a shard, and the same other columns.
    A task sorts its rows so that a shard comes before its queries. It holds one shard, whose
    size the caller bounds, and one batch of queries; there may be any number of these.
    Rows of ``shards`` are moved once. Queries without a shard have no answer.
    """
    both = shards.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: tuple | None = None
        rows: list[pa.RecordBatch] = []
        built = None
        for batch in batches:
            names = list(zip(*(batch.column(key).to_pylist() for key in keys), strict=True))
            asks = batch.column("asks").to_pylist()
            start = 0
            while start < len(names):
                end = start + 1
                while end < len(names) and names[end] == names[start] and asks[end] == asks[start]:
                    end += 1
                if names[start] != shard:
                    shard, rows, built = names[start], [], None
                part = batch.slice(start, end - start)
                if not asks[start]:
                    rows.append(part)
                elif rows or built is not None:
                    if built is None:
                        built, rows = build(pa.Table.from_batches(rows)), []
                    found = answer(built, part)
                    if found is not None and found.num_rows:
                        yield found
                start = end

    dealt = both.repartition(*keys).sortWithinPartitions(*keys, "asks")
    return dealt.mapInArrow(run, schema)
