"""Row numbers, growth over the previous row and running totals per group.

A plain window sorts each group in one task, which is fine for groups of a
bounded size such as one row per calendar week. For larger groups the functions
take ``slices``: columns that never decrease along ``order``, so that a group's
rows can be cut into consecutive pieces. What a slice needs from those before it
(row count, sum, last value) is aggregated first, one row per group and slice,
and enters the slice as a seed row ahead of its other rows. The window then
partitions by group *and* slice, in one shuffle of the table, and every value
stays a function of the data alone, so a lost executor can be recomputed.

``order`` must identify a row within its group; otherwise the result depends on
how Spark happens to read ties. Where one order value holds many rows, an id
goes to the end of ``order`` and a cut of it to the end of ``slices``:
``order=["week", "id"], slices=["week", "id_slice"]``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallybrook.functions import Addend, Span, spans
from tallybrook.scratch import written

_RANK, _TERM, _PREVIOUS = "_seed_rank", "_seed_term", "_previous"
_CUT_INPUT, _CUT_OUTPUT = "_cut_input", "_cut_output"
_SAMPLES_PER_SLICE = 200


def cut_evenly(
    df: DataFrame,
    column: str,
    name: str,
    rows_per_slice: int = 1_000_000,
    at_least: int = 8,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``, consecutive ranges of a numeric column with about as many rows each.

    ``keys`` is what the number of slices and their bounds are read from, twice: a scan
    of the column that ``df`` is made from, or else ``df`` itself, which should then be a
    stored table. There are as many slices as the rows ask for. The bounds are quantiles of a sample. They decide how even the slices are,
    not what is computed over them, and an outlier does not move them.
    """
    keys = df if keys is None else keys
    rows = keys.count()
    slices = max(at_least, -(-rows // rows_per_slice))
    bounds = _quantiles(keys, column, slices, _SAMPLES_PER_SLICE * slices / max(1, rows))
    # NULL sorts first and NaN last, which is where these two lines put them.
    shown = F.coalesce(F.col(column).cast("double"), F.lit(float("-inf")))
    bucketizer = Bucketizer(
        splits=[float("-inf"), *(bounds or [0.0]), float("inf")],
        inputCol=_CUT_INPUT,
        outputCol=_CUT_OUTPUT,
        handleInvalid="keep",
    )
    cut = bucketizer.transform(df.withColumn(_CUT_INPUT, shown))
    return cut.select(*df.columns, F.col(_CUT_OUTPUT).cast("int").alias(name))


#: Ranges of one cut; the driver holds some hundred sampled keys of each.
_MOST_RANGES = 10_000


def cut_by_range(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    rows_per_slice: int = 1_000_000,
    at_least: int = 8,
) -> DataFrame:
    """``df`` as a stored table with ``name``, consecutive ranges by ``keys`` and ``order``.

    The columns may be of any type that sorts: texts, dates, several of them. Rows are
    dealt by ranges of all of them together, so a group is cut wherever it is large and
    many small groups share a slice. Rows with equal keys and order stay together. Within a
    group the numbers never decrease along ``order``, which is what ``slices`` of
    :func:`number_rows` and :func:`add_growth` need. They are stored with the rows, so they
    stay the same when an executor is lost.
    """
    slices = min(_MOST_RANGES, max(at_least, -(-df.count() // rows_per_slice)))
    dealt = df.repartitionByRange(slices, *keys, *order)
    return written(dealt.withColumn(name, F.spark_partition_id()), "ranges")


def _quantiles(df: DataFrame, column: str, slices: int, share: float) -> list[float]:
    """Distinct inner bounds of ``slices`` ranges, in order, from a share of the rows."""
    values = df.select(F.col(column).cast("double").alias(_CUT_INPUT)).filter(
        F.col(_CUT_INPUT).isNotNull() & ~F.isnan(_CUT_INPUT)
    )
    if share < 1:
        values = values.sample(share, seed=1)
    steps = [i / slices for i in range(1, slices)]
    # Few partitions of the small sample: merging one sketch per scan task is slow.
    few = values.repartition(8)
    found = few.agg(F.percentile_approx(_CUT_INPUT, steps, 10 * slices)).first()[0]
    return sorted({bound for bound in found or [] if math.isfinite(bound)})


def _term(place: int) -> str:
    return f"{_TERM}{place}"


def _last_value(value: str, order: Sequence[str]) -> Column:
    """``value`` in the last row by ``order``, NULLs first."""
    if len(order) > 1:
        return F.max_by(F.col(value), F.struct(*order))
    # One order column keeps the aggregation hash based. max_by skips a NULL
    # order, which only the single row of a slice can have.
    last = F.max_by(F.col(value), F.col(order[0]))
    return F.when(F.count(order[0]) == 0, F.first(value)).otherwise(last)


def _seeded(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slices: Sequence[Column | str],
    terms: Sequence[Column],
    value: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """``df`` with the terms to add up and with seed rows, and the columns to partition by.

    A seed row holds the sums of the terms before its slice and, if asked for, in
    ``value`` the last value before it.
    """
    adding = [_term(place) for place in range(len(terms))]
    names = [f"_slice{i}" for i in range(len(slices))]
    cut = [*keys, *names]
    columns = [F.col(s) if isinstance(s, str) else s for s in slices]
    rows = df.withColumns({**dict(zip(names, columns)), _RANK: F.lit(1), **dict(zip(adding, terms))})
    if not slices:
        return rows, cut

    totals = [F.sum(name).alias(name) for name in adding]
    if len(slices) == 1 and dict(rows.dtypes)[names[0]] in ("int", "bigint"):
        return rows.unionByName(
            _seeds_in_levels(rows, keys, order, names[0], adding, value), allowMissingColumns=True
        ), cut
    along = W.partitionBy(*keys).orderBy(*names)
    before = along.rowsBetween(W.unboundedPreceding, -1)
    seed = [F.lit(0).alias(_RANK), *[F.sum(name).over(before).alias(name) for name in adding]]
    if value:
        totals.append(_last_value(value, order).alias(value))
        seed.append(F.lag(value).over(along).alias(value))
    seeds = rows.groupBy(*cut).agg(*totals).select(*cut, *seed)
    return rows.unionByName(seeds, allowMissingColumns=True), cut


#: Slices whose totals one window goes through.
_SLICES_TOGETHER = 1024


def _seeds_in_levels(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], cut: str, adding: Sequence[str], value: str | None
) -> DataFrame:
    """Seed rows of numbered slices, by a scan of the totals of slices in two levels.

    The slices of a group are taken by the thousand. Within such a run each slice gets what
    comes before it, and the run gets what comes before the run. So no task goes through all
    slices of a hot group.
    """
    run, last, held = "_seed_run", "_seed_last", "_seed_held"
    totals = [F.sum(name).alias(name) for name in adding]
    if value:
        # In a struct, so that a last value of NULL differs from there being none.
        totals.append(F.struct(_last_value(value, order).alias("v")).alias(last))
    parts = rows.groupBy(*keys, cut).agg(*totals).withColumn(run, F.floor(F.col(cut) / _SLICES_TOGETHER))
    inside = W.partitionBy(*keys, run).orderBy(cut)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    found = {f"{held}{name}": F.sum(name).over(before) for name in adding}
    if value:
        found[f"{held}{last}"] = F.lag(last).over(inside)
    within = parts.withColumns(found)
    # The same for the runs.
    whole = [F.sum(name).alias(name) for name in adding]
    whole += [F.max_by(last, F.struct(cut)).alias(last)] if value else []
    runs = parts.groupBy(*keys, run).agg(*whole)
    along = W.partitionBy(*keys).orderBy(run)
    ahead = {f"_ahead{name}": F.sum(name).over(along.rowsBetween(W.unboundedPreceding, -1)) for name in adding}
    if value:
        ahead[f"_ahead{last}"] = F.lag(last).over(along)
    runs = runs.select(*[F.col(key).alias(f"_of{i}") for i, key in enumerate(keys)], F.col(run).alias("_of_run"), *[c.alias(n) for n, c in ahead.items()])
    same = F.col(run).eqNullSafe(F.col("_of_run"))
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_of{i}"))
    both = within.join(runs, same)
    sums = [
        F.when(
            F.col(f"{held}{name}").isNotNull() | F.col(f"_ahead{name}").isNotNull(),
            F.coalesce(F.col(f"{held}{name}"), F.lit(0)) + F.coalesce(F.col(f"_ahead{name}"), F.lit(0)),
        ).alias(name)
        for name in adding
    ]
    if value:
        sums.append(F.coalesce(F.col(f"{held}{last}"), F.col(f"_ahead{last}"))["v"].alias(value))
    return both.select(*keys, cut, F.lit(0).alias(_RANK), *sums)


def _unseeded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(F.col(_RANK) == 1).select(*columns)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    slices: Sequence[Column | str] = (),
    name: str = "RowNum",
) -> DataFrame:
    """Add the row's position in its group, from 1."""
    seeded, cut = _seeded(df, keys, order, slices, [F.lit(1).cast("bigint")])
    upto = W.partitionBy(*cut).orderBy(_RANK, *order).rowsBetween(W.unboundedPreceding, 0)
    return _unseeded(seeded.withColumn(name, F.sum(_term(0)).over(upto)), [*df.columns, name])


def add_growth(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    *,
    slices: Sequence[Column | str] = (),
    growth: str = "PercentGrowth",
    total: str = "AccumulateValue",
    span: Span | None = None,
) -> DataFrame:
    """Add the growth over the previous row in percent and the running sum.

    Growth is 0 where the value or the previous one is NULL and NULL where the
    previous one is 0. The running sum is exact, and a double where the values are.
    Both results are rounded to 2 digits. ``span`` is that of the values, which are read
    for it otherwise.
    """
    addend = Addend.of(value, span or spans(df, {value: value})[value])
    seeded, cut = _seeded(df, keys, order, slices, list(addend.parts.values()), value)
    along = W.partitionBy(*cut).orderBy(_RANK, *order)
    upto = along.rowsBetween(W.unboundedPreceding, 0)
    now, previous = F.col(value), F.col(_PREVIOUS)
    change = F.round(F.try_divide(now - previous, previous) * 100, 2)
    running = addend.over(upto, {part: _term(place) for place, part in enumerate(addend.parts)})
    # A column of its own, so that the window works out the previous row once.
    windowed = seeded.withColumns(
        {_PREVIOUS: F.lag(value).over(along), total: F.round(running, 2)}
    )
    return _unseeded(
        windowed.withColumn(
            growth, F.when(now.isNull() | previous.isNull(), 0).otherwise(change)
        ),
        [*df.columns, growth, total],
    )
