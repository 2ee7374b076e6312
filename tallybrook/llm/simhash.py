"""Near duplicates by SimHash fingerprints, found in a Gray-ordered hierarchical index.

The index has three storeys. Its upper nodes are masked bit patterns: the 64 bits are cut
into five parts, and two fingerprints that differ in two bits at most agree on three of
them, so each pair hangs below one of ten masks with a common pattern. Below a pattern
the fingerprints are sorted by their rank in the Gray code and cut into runs; runs meet
only if the bits that all of a run share differ in few enough places. In a task the runs
are leaves of a tree whose nodes hold the shared bits that the node above doesn't have.
Differences add up from the top, and a group is left as soon as they are too many.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.components import components
from tallybrook.llm.shingles import split_words
from tallybrook.llm.spread import joined_to_key
from tallybrook.scratch import written

SHINGLE = 3
SEED = 42
BITS = 64
MOST_APART = 2
#: Fingerprints of a run, children of a node, and queries that go down the tree together.
RUN = 4096
FAN = 8
TOGETHER = 256
_AT_ONCE = 1 << 16


def fingerprint(words: list[bytes], length: int = SHINGLE) -> int:
    """The bits that are set in more than half of the hashes of the shingles, repeats included."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= length:
        starts, ends = starts[: len(words) - length + 1], ends[length - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        places = zip(starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist(), strict=True)
        hashes = np.array([digest(text[start:end], SEED) for start, end in places], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    weights = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))
    return int(weights[2 * ones > len(starts)].sum(dtype=np.uint64))


def _prints(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [fingerprint(split_words(text, lower=True), length) for text in frame["text"]]
            prints = np.array(found, np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "print": prints})

    return run


def fingerprints(documents: DataFrame, length: int = SHINGLE) -> DataFrame:
    """``doc_id, print`` of every row of ``documents`` (``doc_id, text``), the 64 bits as a LONG."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInPandas(_prints(length), "doc_id long, print long")


def masks(apart: int = MOST_APART) -> list[int]:
    """Masks of which two fingerprints agree on one at least if they differ in ``apart`` bits.

    The bits are cut into ``apart + 3`` parts; a mask has three of them.
    """
    parts = apart + 3
    edges = [round(BITS * part / parts) for part in range(parts + 1)]
    bits = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(bits, parts - apart)]


def gray_rank(numbers: np.ndarray) -> np.ndarray:
    """The place of a bit pattern in the Gray code."""
    rank = numbers.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def _rank(bits: Column) -> Column:
    """The same as a LONG whose order is that of the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits.bitwiseXOR(F.lit(-(2**63)))


class GrayTree:
    """Fingerprints in Gray order; nodes hold the shared bits that the node above doesn't have."""

    def __init__(self, prints: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(prints), kind="stable")
        ones, every = prints[self.order], prints[self.order]
        patterns, shared = [ones], [np.full(len(ones), np.uint64(2**64 - 1))]
        while len(ones) > FAN:
            starts = np.arange(0, len(ones), FAN)
            ones, every = np.bitwise_or.reduceat(ones, starts), np.bitwise_and.reduceat(every, starts)
            patterns.append(every)
            shared.append(~(ones ^ every))
        own = []
        for level, mask in enumerate(shared):
            above = np.repeat(shared[level + 1], FAN)[: len(mask)] if level + 1 < len(shared) else np.uint64(0)
            own.append(mask & ~above)
        self._levels = list(zip(patterns, own, strict=True))[::-1]

    def within(self, queries: np.ndarray, apart: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``query, place`` of fingerprints that differ in ``apart`` bits at most."""
        query = node = differing = None
        for patterns, own in self._levels:
            if query is None:
                query = np.repeat(np.arange(len(queries)), len(patterns))
                node = np.tile(np.arange(len(patterns)), len(queries))
                differing = np.zeros(len(query), np.int64)
            else:
                query, differing = np.repeat(query, FAN), np.repeat(differing, FAN)
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                there = node < len(patterns)
                query, node, differing = query[there], node[there], differing[there]
            differing = differing + np.bitwise_count((queries[query] ^ patterns[node]) & own[node])
            near = differing <= apart
            query, node, differing = query[near], node[near], differing[near]
        return query, self.order[node]


def _joined_up(prints: np.ndarray, apart: int) -> np.ndarray:
    """For each fingerprint the place of one that its component has in common."""
    tree, top = GrayTree(prints), np.arange(len(prints))
    for start in range(0, len(prints), TOGETHER):
        asked = np.arange(start, min(start + TOGETHER, len(prints)))
        query, place = tree.within(prints[asked], apart)
        ends = np.stack([top[asked[query]], top[place]])
        ends = np.unique(np.sort(ends[:, ends[0] != ends[1]], axis=0), axis=1)
        if not ends.shape[1]:
            continue
        over: dict[int, int] = {}
        for one, other in ends.T.tolist():
            while one in over:
                one = over[one]
            while other in over:
                other = over[other]
            if one != other:
                over[max(one, other)] = min(one, other)
        for low in sorted(over):
            over[low] = over.get(over[low], over[low])
        moved = np.arange(len(prints))
        moved[list(over)] = list(over.values())
        top = moved[top]
    return top


_FEW = 8


def _links_of(prints: np.ndarray, group: np.ndarray, apart: int) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """Links that join up what is within ``apart`` bits, group by group; ``group`` is in order."""
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    sizes = np.diff(starts, append=len(group))
    size = np.repeat(sizes, sizes)
    for step in range(1, _FEW):
        one, other = prints[:-step], prints[step:]
        near = (group[:-step] == group[step:]) & (size[:-step] <= _FEW) & (np.bitwise_count(one ^ other) <= apart)
        yield one[near], other[near]
    for start, count in zip(starts[sizes > _FEW].tolist(), sizes[sizes > _FEW].tolist(), strict=True):
        part = prints[start : start + count]
        top = _joined_up(part, apart)
        hangs = top != np.arange(count)
        yield part[hangs], part[top[hangs]]


def _meetings(apart: int):
    """Links of the groups of a sorted partition; a group may go on in the next batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        names = ["mask", "pattern", "first", "second"]

        def links(frame: pd.DataFrame) -> pd.DataFrame:
            keys = frame[names].to_numpy()
            group = np.cumsum(np.concatenate(([0], (keys[1:] != keys[:-1]).any(axis=1).astype(np.int64))))
            prints = frame["print"].to_numpy().view(np.uint64)
            found = list(_links_of(prints, group, apart))
            ends = [np.concatenate([pair[side] for pair in found]).view(np.int64) for side in (0, 1)]
            return pd.DataFrame({"a": ends[0], "b": ends[1]})

        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = frame[names].to_numpy()
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield links(frame.iloc[:last])
            rest = frame.iloc[last:]
        if rest is not None and len(rest):
            yield links(rest)

    return run


def near_links(prints: DataFrame, apart: int = MOST_APART, run_rows: int = RUN) -> DataFrame:
    """Links ``a, b`` that join up the different ``print``s which are ``apart`` bits apart at most.

    Not every such pair is among them, but every two are connected by the links if they are
    by pairs. Each fingerprint goes to ten patterns. Most patterns have one fingerprint and
    are left at once. Those of a pattern are cut into runs of ``run_rows`` in Gray order,
    and two runs meet if the bits that are shared in both of them allow it; a pattern
    has at most 2 to the 26 fingerprints. Of a meeting come as many links as it has rows.
    """
    chosen = masks(apart)
    routed = prints.select("print", F.posexplode(F.array(*[F.lit(_signed(mask)) for mask in chosen])).alias("mask", "bits"))
    routed = routed.select("mask", F.col("print").bitwiseAND(F.col("bits")).alias("pattern"), "print")
    below = Window.partitionBy("mask", "pattern")
    in_order = below.orderBy(_rank(F.col("print")))
    placed = routed.withColumn("place", F.row_number().over(in_order) - 1).withColumn("n", F.count(F.lit(1)).over(below))
    placed = placed.filter("n > 1").withColumn("run", F.floor(F.col("place") / run_rows).cast("int"))
    placed = written(placed.select("mask", "pattern", "print", "run", "n"), "patterns")
    # Runs of the large patterns: what all of a run share, and which runs can be near.
    large = placed.filter(F.col("n") > run_rows)
    runs = large.groupBy("mask", "pattern", "run").agg(
        F.expr("bit_and(print)").alias("both"), F.expr("bit_or(print)").alias("any")
    )
    runs = runs.select("mask", "pattern", "run", "both", F.bitwise_not(F.col("both").bitwiseXOR(F.col("any"))).alias("shared"))
    runs = written(runs, "runs")
    others = runs.select("mask", "pattern", *[F.col(c).alias(f"{c}_2") for c in ("run", "both", "shared")])
    differing = F.col("both").bitwiseXOR(F.col("both_2")).bitwiseAND(F.col("shared")).bitwiseAND(F.col("shared_2"))
    near = (F.col("run") <= F.col("run_2")) & (F.bit_count(differing) <= apart)
    meeting = runs.join(others, ["mask", "pattern"]).filter(near)
    meeting = written(meeting.select("mask", "pattern", F.col("run").alias("first"), F.col("run_2").alias("second")), "meetings")
    keys = ["mask", "pattern"]
    one = large.join(meeting.withColumn("run", F.col("first")), [*keys, "run"])
    two = large.join(meeting.filter("first < second").withColumn("run", F.col("second")), [*keys, "run"])
    columns = [*keys, "first", "second", "print"]
    small = placed.filter(F.col("n") <= run_rows).select(*keys, F.lit(0).alias("first"), F.lit(0).alias("second"), "print")
    together = small.unionByName(one.select(*columns)).unionByName(two.select(*columns))
    dealt = together.repartition(*columns[:4]).sortWithinPartitions(*columns[:4])
    return dealt.mapInPandas(_meetings(apart), "a long, b long")


def near_duplicates(documents: DataFrame, length: int = SHINGLE, apart: int = MOST_APART) -> DataFrame:
    """``doc_id, print, component_id`` per row of ``documents`` (``doc_id, text``).

    Fingerprints link at ``apart`` or fewer differing bits; ``component_id`` is the least
    ``doc_id`` reachable. Words are between the six ASCII blanks, A to Z in small
    letters. A text with fewer words than ``length`` is one shingle; NULL and blank texts
    have the fingerprint 0, which links like any other. Equal fingerprints, copies or
    not, are one node. A row without an id has a fingerprint and no component, and
    joins nothing up. Rows of one id with several texts are as many nodes. Other columns
    are left out.
    """
    known = written(fingerprints(documents, length), "fingerprints")
    nodes = known.filter("doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    nodes = written(nodes, "nodes")
    links = near_links(nodes.select("print"), apart)
    joined = written(components(links), "components").join(nodes.withColumnRenamed("print", "node"), "node")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    named = joined.select("node", "component").join(least, "component").select(F.col("node").alias("print"), "component_id")
    facts = nodes.join(named, "print", "left").select(
        "print", "n", F.coalesce("component_id", "least").alias("component_id")
    )
    found = joined_to_key(known.filter("doc_id IS NOT NULL"), written(facts, "facts"), "print", "n")
    nameless = known.filter("doc_id IS NULL").withColumn("component_id", F.lit(None).cast("long"))
    columns = ["doc_id", "print", "component_id"]
    return found.select(*columns).unionByName(nameless.select(*columns))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
