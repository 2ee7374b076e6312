"""Drop the lines that a site repeats on too many of its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm.common import BLANKS, table
from tallybrook.scratch import written

#: A line goes if more than this part of its host's pages hold it.
RATIO = 0.1
#: On fewer pages than this no line is boilerplate, whatever the ratio.
LEAST_PAGES = 3

_OF, _DROPPED = "__host_of_lines", "__dropped_lines"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _key(line: Column) -> Column:
    return F.xxhash64(_bare(line))


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """Per host the keys of its boilerplate lines: ``host, dropped array<long>``.

    Lines are counted once per page. A page has few distinct lines for its
    length, so a host has at most (mean lines per page) / ratio such keys, however
    many pages it has.
    """
    bare = F.filter(F.transform(_lines(F.col(f"`{text}`")), _bare), lambda line: line != "")
    keys = F.array_distinct(F.transform(bare, lambda line: F.xxhash64(line)))
    found = pages.select(F.col(f"`{host}`").alias("host"), F.explode(keys).alias("key"))
    counted = found.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    frequent = counted.filter(F.col("n") >= least_pages)
    totals = pages.groupBy(F.col(f"`{host}`").alias("of")).agg(F.count(F.lit(1)).alias("total"))
    return (
        frequent.join(totals, F.col("host").eqNullSafe(F.col("of")))
        .filter(F.col("n") > ratio * F.col("total"))
        .groupBy("host")
        .agg(F.collect_set("key").alias("dropped"))
    )


def without_boilerplate(
    pages: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``pages`` with ``text`` rid of boilerplate, and the ``counts`` of lines and of dropped ones.

    Lines are compared without the blanks around them. Blank lines are neither
    counted nor dropped. NULL hosts are one host. A NULL text stays NULL and a
    page may end up empty; no page is lost. Repeated rows count as pages of their
    own. Other columns pass through, but for earlier ones with the names of the ``counts``.
    """
    # Stored, so that the planner knows its size before it picks the join.
    known = written(boilerplate(pages, host, text, ratio, least_pages), "boilerplate")
    known = known.select(F.col("host").alias(_OF), F.col("dropped").alias(_DROPPED))
    joined = pages.join(known, F.col(f"`{host}`").eqNullSafe(F.col(_OF)), "left")
    lines = _lines(F.col(f"`{text}`"))
    kept = F.filter(
        lines, lambda line: ~F.array_contains(F.col(_DROPPED), _key(line)) | (_bare(line) == "")
    )
    kept = F.when(F.col(_DROPPED).isNull(), lines).otherwise(kept)
    filled = F.size(F.filter(lines, lambda line: _bare(line) != ""))
    others = [F.col(f"`{name}`") for name in pages.columns if name not in (text, *counts)]
    blank = F.col(f"`{text}`").isNull()
    return joined.select(
        *others,
        F.array_join(kept, "\n").alias(text),
        F.when(blank, 0).otherwise(filled).alias(counts[0]),
        F.when(blank, 0).otherwise(F.size(lines) - F.size(kept)).alias(counts[1]),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return without_boilerplate(pages).select("doc_id", "source", "n_lines", "n_dropped", "text")


_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES = {
    "op9_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS lines, text FROM documents
), bare AS (
  SELECT doc_id, source,
         list_distinct(list_filter(list_transform(lines, lambda x: trim(x, {_BLANKS_SQL})),
                                   lambda x: x <> '')) AS distinct_lines
  FROM lines
), counted AS (
  SELECT source, line, count(*) AS n
  FROM (SELECT source, unnest(distinct_lines) AS line FROM bare) GROUP BY ALL
), totals AS (
  SELECT source, count(*) AS total FROM documents GROUP BY source
), dropped AS (
  SELECT c.source, list(c.line) AS gone
  FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
  WHERE c.n >= {LEAST_PAGES} AND c.n > {RATIO}::DOUBLE * t.total GROUP BY c.source
), kept AS (
  SELECT l.doc_id, l.source, l.text, l.lines,
         list_filter(l.lines, lambda x: trim(x, {_BLANKS_SQL}) = ''
           OR NOT coalesce(list_contains(d.gone, trim(x, {_BLANKS_SQL})), false)) AS kept
  FROM lines l LEFT JOIN dropped d ON l.source IS NOT DISTINCT FROM d.source
)
SELECT doc_id, source,
       coalesce(len(list_filter(lines, lambda x: trim(x, {_BLANKS_SQL}) <> '')), 0)::INTEGER AS n_lines,
       coalesce(len(lines) - len(kept), 0)::INTEGER AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text
FROM kept
""",
}
