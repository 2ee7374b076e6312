"""Sums that are the same in whatever order and layout the rows come, and lose nothing."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallybrook.functions import Addend, Span, exact_mean, exact_sum, spans
from tallybrook.operators import add_growth, per_invoice, summarise_invoices, summarise_sales
from tallybrook.plans import storage


@pytest.fixture(scope="module")
def lines(spark):
    copies = spark.range(20_000)
    value = F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / 100.0
    return copies.select(
        (F.col("id") % 500).alias("InvoiceNo"), value.alias("UnitPrice"), F.col("id").cast("double").alias("Quantity")
    )


@pytest.mark.parametrize("partitions", [3, 8, 64, 97])
def test_layouts_give_equal_sums(lines, partitions):
    def measured(df):
        whole = summarise_sales(df, price_digits=6).first().asDict()
        per = summarise_invoices(per_invoice(df), ["InvoiceNo"]).orderBy("InvoiceNo").collect()
        return whole, per

    assert measured(lines.repartition(partitions)) == measured(lines.coalesce(1))


def _drawn(kind, seed):
    """Lists of doubles of one kind."""
    generator = random.Random(seed)
    draw = {
        "money": lambda: round(generator.uniform(-1e5, 1e5), 2),
        "wide": lambda: generator.uniform(-1, 1) * 10.0 ** generator.randrange(-300, 300),
        "tiny": lambda: math.ldexp(generator.randrange(1, 100), -1074),
        "huge": lambda: generator.choice([-1, 1]) * generator.uniform(1e300, 1.7e308) / 400,
        "powers": lambda: generator.choice([-1, 1]) * 2.0 ** generator.randrange(-60, 60),
        "large whole": lambda: float(generator.randrange(10**18, 10**25)),
    }[kind]
    return [draw() for _ in range(400)]


@pytest.mark.parametrize("kind", ["money", "wide", "tiny", "huge", "powers", "large whole"])
@pytest.mark.parametrize("cancelled", [False, True])
def test_no_finite_value_is_lost(spark, kind, cancelled):
    values = _drawn(kind, 1)
    if cancelled:
        values += [-value for value in values[3:]]
        random.Random(2).shuffle(values)
    df = spark.createDataFrame([(value,) for value in values], "v double")
    span = spans(df, {"v": "v"})["v"]
    expected = math.fsum(values)
    found = [
        df.repartition(n).agg(Addend.of("v", span).total().alias("t")).first().t for n in (1, 3, 97)
    ]
    assert len(set(found)) == 1
    assert abs(found[0] - expected) <= 2 * math.ulp(expected)
    # In two steps, by way of the parts.
    parts = df.groupBy((F.abs(F.hash("v")) % 7).alias("k")).agg(Addend.of("v", span).partial().alias("p"))
    assert parts.agg(Addend.again(parts, "p").total().alias("t")).first().t == found[0]


def _summed(spark, values, kind="double"):
    df = spark.createDataFrame([(value,) for value in values], f"v {kind}")
    return df.agg(exact_sum(df, "v", 6).alias("s"), exact_mean("v", spans(df, {"v": "v"})["v"]).alias("m")).first()


def test_numbers_that_are_not_finite_count_as_in_ieee_754(spark):
    inf, nan = float("inf"), float("nan")
    assert _summed(spark, [1.0, inf, 1e300]).s == inf
    assert _summed(spark, [1.0, -inf, None]).s == -inf
    assert math.isnan(_summed(spark, [inf, -inf, 1.0]).s)
    assert math.isnan(_summed(spark, [nan, 1.0]).m)
    assert tuple(_summed(spark, [None, None])) == (None, None)
    assert tuple(_summed(spark, [])) == (None, None)
    assert tuple(_summed(spark, [0.0, -0.0, None])) == (0.0, 0.0)
    assert _summed(spark, [1.7e308, 1.7e308]).s == inf
    rows = [(1, 2.0, 1.5), (1, nan, 1.0), (1, 1.0, inf), (1, None, 4.0)]
    df = spark.createDataFrame(rows, "InvoiceNo int, Quantity double, UnitPrice double")
    row = summarise_sales(df).first()
    assert row.num_records == 4 and math.isnan(row.total_quantity) and math.isnan(row.invoice_value)
    assert row.avg_price == inf


def test_small_and_large_values_together(spark):
    row = _summed(spark, [1e19, 5.0, 1e-7, -1e19])
    assert row.s == 5.0 and row.m == pytest.approx((5 + 1e-7) / 4, rel=1e-15)
    assert tuple(_summed(spark, [0.5, 0.25], "float")) == (0.75, 0.375)
    assert tuple(_summed(spark, [3, 4], "int")) == (7, 3.5)


def test_a_span_that_is_wider_changes_nothing(spark):
    values = _drawn("money", 5)
    df = spark.createDataFrame([(value,) for value in values], "v double")
    narrow = spans(df, {"v": "v"})["v"]
    assert len(narrow.units()) <= 3
    sums = {df.agg(Addend.of("v", s).total()).first()[0] for s in (narrow, Span(-200, 300), Span(-1074, 1024, 10**6))}
    assert len(sums) == 1


def test_running_sums_are_exact(spark):
    rows = [("a", i, 0.1) for i in range(1000)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    last = add_growth(df, ["k"], ["t"], "v").orderBy(F.desc("t")).first()
    assert last.AccumulateValue == 100.0


@pytest.mark.parametrize(("rows", "files"), [(1000, 1), (1000, 9), (3, 2), (0, 1)])
def test_balance_does_not_depend_on_the_layout(spark, tmp_path, rows, files):
    orders = spark.range(rows).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1").alias("o_orderpriority"),
    )
    orders.repartition(files).write.parquet(f"{tmp_path}/orders.parquet")
    found = storage.partition_balance(spark, str(tmp_path)).first()
    assert tuple(found) == (storage.PARTITIONS, rows, True, True)


def test_running_sums_in_slices_lose_nothing(spark):
    generator = random.Random(8)
    rows = [("a", i, generator.choice([1e16, -1e16, 0.25, 1.0, None])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(9)
    for slices in ([], [F.floor(F.col("t") / 40)]):
        total = 0
        for row in add_growth(df, ["k"], ["t"], "v", slices=slices).orderBy("t").collect():
            total += int((row.v or 0) * 4)
            assert row.AccumulateValue == total / 4


def test_products_need_no_look_at_the_rows(spark):
    generator = random.Random(9)
    for scale in (1.0, 1e-200, 1e150, 1e-300):
        rows = [(generator.uniform(-9, 9) * scale, float(generator.randrange(50))) for _ in range(300)]
        rows += [(generator.uniform(-9, 9) * scale, generator.uniform(-1e-9, 1e-9) * scale) for _ in range(300)]
        df = spark.createDataFrame(rows, "Quantity double, UnitPrice double").withColumn("InvoiceNo", F.lit(1))
        exact = math.fsum(q * p for q, p in rows)
        parts = per_invoice(df)
        found = parts.select(Addend.value(parts, "InvoiceValue")).first()[0]
        assert abs(found - exact) <= 2 * math.ulp(exact)
