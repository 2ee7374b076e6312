"""Mix sources by target weights from fixed-length blocks of their words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import permuted, permuted_sql, table, word_count
from tallybrook.scratch import written

#: Weights that the sources get in turn, in the order of their names.
WEIGHTS = (5, 2, 1)
#: No source and no document is taken more often than this.
MOST = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
SEED = 20
_ROWS_PER_CHUNK = 50_000
_PAGE = 4096


def source_targets(
    sizes: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """Per source: ``number, source_size, blocks, target, quota, first``.

    The targets share the sum of all sizes by weight. Where one is above ``MOST``
    times its source it is cut to that, and the rest shared anew by weight. As
    the sources that are cut are those with the smallest size for their weight,
    one pass in that order finds the level at which all others are filled.
    ``quota`` is the target in whole blocks; ``first`` sums those before it. There
    is one row per source here, so the two windows over all of them are small.
    """
    # The pieces of a source are summed by task before they are shuffled.
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name).cast("long") - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    per = per.withColumn("number", number).withColumn("weight", weight.cast("long"))
    per = per.withColumn("most", F.col("source_size") * MOST)
    ordered = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    shared = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left / shared)
    # The first source that isn't cut has the level of all that follow; those after it
    # would have lower ones.
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level")))
    per = per.withColumn("level", open_level.over(everything))
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("weight"))
    target = F.coalesce(target, F.col("most").cast("double"))
    blocks = F.ceil(F.col("source_size") / BLOCK_WORDS).cast("long")
    per = per.withColumn("target", target).withColumn("blocks", blocks)
    quota = F.floor(F.try_divide(F.col("target") * F.col("blocks"), F.col("source_size")) + 0.5)
    per = per.withColumn("quota", F.coalesce(quota, F.lit(0)).cast("long"))
    by_number = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("first", F.coalesce(F.sum("quota").over(by_number), F.lit(0)))
    return per.select("source", "number", "source_size", "blocks", "target", "quota", "first")


def packed(sizes: DataFrame, chunks: int) -> DataFrame:
    """Add ``start``, where a document begins in the stream of its source's words.

    A source's documents follow each other by chunk and then by id. Only sums of
    chunks are added up over a whole source, so a source with most of the rows is
    spread over as many tasks as it has chunks.
    """
    chunk = F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(chunks))
    cut = sizes.withColumn("chunk", chunk)
    sums = cut.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("of"),
        F.col("chunk").alias("in"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"),
    )
    placed = cut.join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("in"))
    )
    within = Window.partitionBy("source", "chunk").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    return placed.withColumn("start", start).drop("chunk", "of", "in", "base")


def drawn_slots(targets: DataFrame, seed: int = SEED) -> DataFrame:
    """The blocks of the mix in order: ``shard, slot, number, epoch, block``.

    Every slot of every output shard draws a source. The draws are without
    replacement from the quotas, so the counts of a shard are multinomial given
    the sums over all shards: those are met to the block, and no source can be
    drawn beyond ``MOST``. A slot's rank within its source goes through a
    permutation of the source's blocks, another one for every pass over them.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("quota")).first()[0] or 0
    # Where a draw lands, by pages of the quotas: an equality join, not a range join.
    pages = F.sequence(F.floor(F.col("first") / _PAGE), F.floor((F.col("first") + F.col("quota") - 1) / _PAGE))
    spans = targets.filter("quota > 0").withColumn("page", F.explode(pages)).drop("source", "target")
    count = F.lit(max(total, 1)).cast("long")
    slots = spark.range(total).withColumn("draw", permuted(F.col("id"), count, F.lit(seed).cast("long")))
    slots = slots.withColumn("page", F.floor(F.col("draw") / _PAGE))
    rank = F.col("draw") - F.col("first")
    drawn = slots.join(spans, "page").filter((rank >= 0) & (rank < F.col("quota")))
    drawn = drawn.withColumn("rank", rank).withColumn("epoch", F.floor(F.col("rank") / F.col("blocks")))
    key = F.col("number") * 8191 + F.col("epoch") * 127 + seed + 1
    block = permuted(F.col("rank") % F.col("blocks"), F.col("blocks"), key)
    return drawn.select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"),
        (F.col("id") % SHARD_SLOTS).alias("slot"),
        "number",
        "epoch",
        block.alias("block"),
    )


def mixture(documents: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(sizes, pieces, slots)`` of the mix of ``documents``.

    ``sizes`` has a row per document with its source's target and its ``start``;
    ``pieces`` says which words of which block it fills (``number, block, start,
    words``); ``slots`` are the blocks of the mix in order. Joined on ``number``
    and ``block`` they are the mix. NULL texts and texts without words have size 0
    and no piece. A NULL source is one source, last in order. Repeated rows are
    documents of their own.
    """
    sizes = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
    )
    # One pass over the texts; what follows reads a table of numbers.
    sizes = written(sizes, "mix-sizes")
    targets = written(source_targets(sizes), "mix-targets")
    chunks = max(64, -(-sizes.count() // _ROWS_PER_CHUNK))
    known = targets.select(F.col("source").alias("of"), "number", "source_size", "target")
    placed = packed(sizes, chunks).join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((end - 1) / BLOCK_WORDS))
    pieces = placed.filter("size > 0").withColumn("block", F.explode(blocks))
    words = F.least(end, (F.col("block") + 1) * BLOCK_WORDS) - F.greatest(F.col("start"), F.col("block") * BLOCK_WORDS)
    return placed, pieces.withColumn("words", words), drawn_slots(targets, seed)


def words_taken(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``."""
    placed, pieces, slots = mixture(documents, seed)
    times = slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    # (number, start) names a row, as each row with words starts elsewhere.
    shares = (
        pieces.select("number", "start", "doc_id", "source", "size", "source_size", "target", "block", "words")
        .join(times, ["number", "block"], "left")
        .groupBy("number", "start", "doc_id", "source", "size", "source_size", "target")
        .agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken"))
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    empty = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return shares.select(*columns).unionByName(empty.select(*columns))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_taken(table(spark, sf_dir, "documents"))


def words_taken_sql(documents: str = "documents", seed: int = SEED) -> str:
    """The same for DuckDB, over the table named."""
    weight = "CASE number % 3 " + " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS)) + " END"
    draw = permuted_sql("id", "total", str(seed))
    block = permuted_sql("draw_rank % blocks", "blocks", f"number * 8191 + epoch * 127 + {seed + 1}")
    return f"""
WITH sizes AS MATERIALIZED (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM {documents}
), per AS (
  SELECT *, ({weight})::BIGINT AS weight, source_size * {MOST} AS most FROM (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS number
    FROM sizes GROUP BY source)
), levels AS (
  SELECT *, ((SELECT sum(source_size)::BIGINT FROM per)
             - coalesce(sum(most) OVER w, 0)::BIGINT)::DOUBLE
            / ((SELECT sum(weight)::BIGINT FROM per)
             - coalesce(sum(weight) OVER w, 0)::BIGINT)::DOUBLE AS level
  FROM per WINDOW w AS (ORDER BY most::DOUBLE / weight::DOUBLE, number
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS MATERIALIZED (
  SELECT *, coalesce(sum(quota) OVER (ORDER BY number
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM (
    SELECT *, CASE WHEN source_size = 0 THEN 0
                   ELSE floor(target * blocks::DOUBLE / source_size::DOUBLE + 0.5) END::BIGINT AS quota
    FROM (SELECT source, number, source_size,
                 ceil(source_size::DOUBLE / {BLOCK_WORDS})::BIGINT AS blocks,
                 coalesce(least(most::DOUBLE,
                   (SELECT max(level) FROM levels WHERE level * weight <= most) * weight),
                   most::DOUBLE) AS target
          FROM levels))
), placed AS MATERIALIZED (
  SELECT s.*, t.number, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY
           coalesce(doc_id, 0) % (SELECT greatest(64, ceil(count(*) / {_ROWS_PER_CHUNK}.0))::BIGINT FROM sizes),
           doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), slots AS MATERIALIZED (
  SELECT number, {block} AS block FROM (
    SELECT number, blocks, draw - first AS draw_rank, (draw - first) // blocks AS epoch FROM (
      SELECT id, {draw} AS draw FROM (SELECT total, unnest(range(total)) AS id FROM (
        SELECT sum(quota)::BIGINT AS total FROM targets)))
    JOIN targets ON draw >= first AND draw < first + quota)
), times AS (SELECT number, block, count(*) AS times FROM slots GROUP BY ALL
), pieces AS (
  SELECT *, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block
  FROM placed WHERE size > 0
), taken AS (
  SELECT p.number, p.start, sum((least(start + size, (block + 1) * {BLOCK_WORDS})
         - greatest(start, block * {BLOCK_WORDS})) * coalesce(times, 0))::BIGINT AS taken
  FROM pieces p LEFT JOIN times USING (number, block) GROUP BY ALL
)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE t.taken END::BIGINT AS taken
FROM placed p LEFT JOIN taken t ON p.number = t.number AND p.start = t.start AND p.size > 0
"""


ORACLES = {"op6_mixing": words_taken_sql()}
