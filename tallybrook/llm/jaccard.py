"""Join of documents by the Jaccard similarity of their word shingles.

The document by shingle incidence matrix is multiplied with its transpose in
blocks: a block is what one shingle contributes to the overlaps of pairs. Bounds from the
sizes of the sets say which shingles of a document have to be multiplied at all, and
which sums of overlaps can still reach the threshold; these pairs are then read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.llm.components import components
from tallybrook.llm.shingles import WordHashes, shingle_set, split_words
from tallybrook.scratch import released, written

SHINGLE, PERCENT = 3, 90
_SETS = "doc_id long, node long, n int, n_low int, keys array<long>, parity array<long>"
_GRAMS = "node long, grams array<long>"


def _node(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - 2**63


#: Bits of a set's parity sketch, a multiple of 64.
_BITS = 512


def _parity(grams: np.ndarray) -> np.ndarray:
    """Per bit, whether an odd number of shingles falls to it.

    Two sketches differ in no more bits than the sets have shingles of one only.
    """
    odd = np.bincount((grams & np.uint64(_BITS - 1)).astype(np.int64), minlength=_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _probe_length(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


def _sets(length: int, percent: int):
    """Of each text: its set's number and size, and the part of its shingles to be indexed.

    That part is made of the shingles with low numbers, the same for all texts, and
    of all shingles where the low ones are fewer than the size bounds ask for.
    """
    low = np.uint64(int(2**64 * min(0.9, 1.8 * (100 - percent) / 100)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                words = split_words(text, lower=True)
                grams = shingle_set(hashes.of(words, len(words)), length)
                n = len(grams)
                n_low = int(np.searchsorted(grams, low))
                keys = grams[:n_low] if n_low >= _probe_length(n, percent) else grams
                rows.append((doc_id, _node(grams), n, n_low, keys.view(np.int64), _parity(grams)))
            yield pd.DataFrame(rows, columns=["doc_id", "node", "n", "n_low", "keys", "parity"])

    return run


def _grams(length: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for frame in frames:
            rows = []
            for node, text in zip(frame["node"], frame["text"], strict=True):
                words = split_words(text, lower=True)
                grams = shingle_set(hashes.of(words, len(words)), length)
                if _node(grams) == node:
                    rows.append((node, grams.view(np.int64)))
            yield pd.DataFrame(rows, columns=["node", "grams"])

    return run


def _linked(both: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * both >= percent * (n + m - both)


def _index_rows(sets: DataFrame, percent: int) -> DataFrame:
    """``key, node, n, pos, typical, stored`` for the shingles that come first in the common order.

    The order puts low numbers first, then shingles that few sets have. A shingle that
    no other set was indexed with takes its place in the order and needs no row. Of two
    sets that reach the threshold, the larger has one of its first (1 - t) n + 1
    shingles among the first (1 - t) / (1 + t) n + 1 of the smaller; ``stored`` marks
    the latter. ``typical`` tells how widely a set's shingles are shared.
    """
    low = int(2**64 * min(0.9, 1.8 * (100 - percent) / 100)) - 2**63
    # As signed numbers the low half of the unsigned ones begins at 0.
    order = F.col("key").bitwiseXOR(F.lit(-(2**63)))
    rows = sets.select("node", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = rows.join(counts, "key").withColumn("high", (order >= F.lit(low)).cast("int"))
    per = shared.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("high", "df", "key"))).alias("shared"),
        F.sum(F.col("high")).alias("n_high"),
        F.sum(F.log2("df")).alias("typical"),
    )
    stored = sets.select("node", "n", "n_low", F.size("keys").alias("kept"))
    joined = per.join(stored, "node")
    alone_low = F.col("n_low") - (F.size("shared") - F.col("n_high"))
    alone = F.when(F.col("item.high") == 0, F.col("alone_low")).otherwise(
        F.col("kept") - F.size("shared")
    )
    placed = joined.withColumn("alone_low", alone_low).select(
        "node",
        "n",
        "alone_low",
        "kept",
        "shared",
        (F.col("typical") / F.col("kept")).alias("typical"),
        F.posexplode("shared").alias("at", "item"),
    )
    placed = placed.withColumn("pos", (F.col("at") + alone).cast("int"))
    n = F.col("n")
    probe = n + 1 - F.ceil(n * percent / 100)
    stored_to = n + 1 - F.ceil(n * (2 * percent) / (100 + percent))
    return placed.filter(F.col("pos") < probe).select(
        F.col("item.key").alias("key"), "node", "n", "pos", "typical", (F.col("pos") < stored_to).alias("stored")
    )


def _checked(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that reach the threshold, by their whole sets."""
    mine = grams.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    theirs = grams.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    both = F.size(F.array_intersect("grams_a", "grams_b"))
    joined = pairs.join(mine, "a").join(theirs, "b")
    return joined.filter(_linked(both, F.size("grams_a"), F.size("grams_b"), percent)).select("a", "b")


def _differing(one: Column, other: Column) -> Column:
    """Bits in which two sketches differ."""
    bits = [F.bit_count(one[i].bitwiseXOR(other[i])) for i in range(_BITS // 64)]
    return sum(bits[1:], start=bits[0])


def _allowed(n: Column, m: Column, percent: int) -> Column:
    """Shingles of only one of two sets, at most, where the sets reach the threshold."""
    return n + m - 2 * F.ceil(percent * (n + m) / (100 + percent))


def _star_pairs(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Each set with the centres of its blocks among like sizes: a few pairs for a row.

    The first centre of a block is the set with the most widely shared shingles. Where
    most sets around it differ from it in the same bits of the sketch, these are its own
    changes; without them its sketch is that of what all were copied from. The set
    nearest to this is the second centre: copies with changes at different places are
    nearer to it than to each other.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent))
    banded = rows.select("key", "node", "n", "typical", band.alias("band"))
    centres = banded.groupBy("key", "band").agg(F.max(F.struct("typical", "node", "n")).alias("centre"))
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    centres = centres.select("key", near.alias("band"), "centre")
    stars = banded.join(centres, ["key", "band"]).select(
        "node", "n", F.col("centre.node").alias("centre"), F.col("centre.n").alias("m")
    )
    stars = stars.filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m")).distinct()
    stars = stars.join(sketches, "node").join(
        sketches.select(F.col("node").alias("centre"), F.col("parity").alias("middle")), "centre"
    )
    differing = _differing(F.col("parity"), F.col("middle"))
    allowed = _allowed(F.col("n"), F.col("m"), percent)
    stars = stars.withColumn("differing", differing).filter(F.col("differing") <= 3 * allowed)
    stars = written(stars, "stars")
    # Bits by which most of a star differ from its centre.
    place = F.explode(F.sequence(F.lit(0), F.lit(_BITS - 1)))
    word, bit = F.floor(F.col("place") / 64).cast("int"), F.col("place") % 64
    changes = F.transform(F.sequence(F.lit(0), F.lit(_BITS // 64 - 1)), lambda i: F.get("parity", i).bitwiseXOR(F.get("middle", i)))
    odd = stars.withColumn("changes", changes).select("centre", "changes", place.alias("place"))
    odd = odd.filter(F.getbit(F.get("changes", word), bit) == 1)
    often = odd.groupBy("centre", "place").agg(F.count(F.lit(1)).alias("times"))
    sizes = stars.groupBy("centre").agg(F.count(F.lit(1)).alias("size"))
    own = often.join(sizes, "centre").filter(2 * F.col("times") > F.col("size"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    fixes = own.groupBy("centre").agg(
        F.array(*[F.sum(F.when(word == i, mask).otherwise(0)) for i in range(_BITS // 64)]).alias("fix")
    )
    fixed = stars.join(fixes, "centre")
    origin = F.transform(F.sequence(F.lit(0), F.lit(_BITS // 64 - 1)), lambda i: F.get("middle", i).bitwiseXOR(F.get("fix", i)))
    fixed = fixed.withColumn("origin", origin)
    nearest = fixed.groupBy("centre").agg(
        F.min(F.struct(_differing(F.col("parity"), F.col("origin")).alias("far"), "node", "n", "parity")).alias("best")
    )
    nearest = nearest.select("centre", F.col("best.node").alias("c"), F.col("best.n").alias("l"), F.col("best.parity").alias("p"))
    second = stars.join(nearest, "centre").filter(
        _differing(F.col("parity"), F.col("p")) <= _allowed(F.col("n"), F.col("l"), percent)
    )
    first = stars.filter(F.col("differing") <= allowed).select("node", F.col("centre").alias("c"))
    pairs = first.unionByName(second.select("node", "c")).filter("node <> c")
    return pairs.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()


def _open_pairs(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets whose summed overlap can reach the threshold, of those not joined up yet.

    Each block adds one to the overlap of its pairs. Shared shingles stand in the same order
    in both sets and all those up to the last that was counted are in the index, so the
    overlap is at most the sum and what either set has left after that one. Pairs
    for which this is less than the overlap that their sizes ask for are dropped. Blocks in
    one component have none of these pairs. Sets that reach the threshold differ in at most
    n + m - 2 * (overlap that is needed) shingles, and so do their sketches in bits.
    """
    mixed = rows.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    left = rows.join(mixed.select("key"), "key", "left_semi").join(sketches, "node")
    columns = ["node", "n", "pos", "component", "parity"]
    small = left.filter("stored").select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
    large = left.select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
    n, m = F.col("n_a"), F.col("n_b")
    # Rules of the pair alone: a pair meets them in all of its blocks or in none.
    rule = (
        (F.col("component_a") != F.col("component_b"))
        & ((n < m) | ((n == m) & (F.col("node_a") < F.col("node_b"))))
        & (100 * n >= percent * m)
        & (_differing(F.col("parity_a"), F.col("parity_b")) <= _allowed(n, m, percent))
    )
    pairs = small.join(large, "key").filter(rule).select(
        F.col("node_a").alias("a"),
        F.col("node_b").alias("b"),
        F.ceil(percent * (n + m) / (100 + percent)).alias("needed"),
        (n - F.col("pos_a") - 1).alias("rest_a"),
        (m - F.col("pos_b") - 1).alias("rest_b"),
    )
    sums = pairs.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("overlap"),
        F.first("needed").alias("needed"),
        F.least(F.min("rest_a"), F.min("rest_b")).alias("rest"),
    )
    return sums.filter("overlap + rest >= needed").select("a", "b")


def similar_documents(
    documents: DataFrame, length: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``): ``doc_id, n_shingles, component_id``.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of
    ``length``-word shingles; ``component_id`` is the least ``doc_id`` reachable. Equal
    sets are one node from the start, however many rows have them. NULL and blank texts
    have no shingle and link with nothing, nor do rows without an id. Sets go by 64-bit
    hashes of shingles and of whole sets.

    First every set is compared with the centres of its blocks, which joins up groups of
    copies with about as many comparisons as rows. Then all pairs of a block that are still
    apart are compared. No candidate is left out: a block without two components has
    no pair whose link could change a component.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = written(texts.filter("doc_id IS NOT NULL").mapInPandas(_sets(length, percent), _SETS), "sets")
    filled = known.filter("n > 0")
    sets = filled.groupBy("node").agg(
        F.min("doc_id").alias("least"),
        F.first("n").alias("n"),
        F.first("n_low").alias("n_low"),
        F.first("keys").alias("keys"),
        F.first("parity").alias("parity"),
    )
    sets = written(sets, "nodes")
    # From here on keys and sketches are there once, and documents have the number of their set.
    documents_of = written(known.select("doc_id", "node", "n"), "documents")
    released(known)
    known, filled = documents_of, documents_of.filter("n > 0")
    index = written(_index_rows(sets, percent), "index")
    whole, sets = sets, written(sets.select("node", "least", "n", "parity"), "sketches")
    released(whole)
    # Only sets that meet another one are read in full.
    met = index.groupBy("key").count().filter("count > 1")
    rows = written(index.join(met.select("key"), "key", "left_semi"), "blocks")
    released(index)
    wanted = rows.select("node").distinct().join(sets.select("node", "least"), "node")
    full = texts.join(wanted, F.col("doc_id") == F.col("least")).select("node", "text")
    grams = full.mapInPandas(_grams(length), _GRAMS).dropDuplicates(["node"])
    grams = written(grams, "grams")
    sketches = sets.select("node", "parity")
    links = written(_checked(_star_pairs(rows, sketches, percent), grams, percent), "star-links")
    first = written(components(links), "components")
    part = F.coalesce("component", "node").alias("component")
    tagged = rows.join(first, "node", "left").select("key", "node", "n", "pos", "stored", part)
    more = written(_checked(_open_pairs(tagged, sketches, percent), grams, percent), "open-links")
    tree = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    joined = written(components(tree.unionByName(more)), "components")
    named = joined.join(sets.select("node", "least"), "node")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = named.select("node", "component").join(least, "component").select("node", "component_id")
    of_node = (
        sets.select("node", "least").join(of_node, "node", "left")
        .select("node", F.coalesce("component_id", "least").alias("component_id"))
    )
    found = filled.select("doc_id", "node", "n").join(of_node, "node")
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"]
    alone = known.filter("n = 0").withColumn("component_id", F.col("doc_id"))
    nameless = texts.filter("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return found.select(*columns).unionByName(alone.select(*columns)).unionByName(nameless)


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))
