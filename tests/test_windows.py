"""Row numbers, growth and running totals, whole and in slices."""

import random

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import add_growth, cut_by_range, cut_evenly, number_rows
from tallybrook.operators import windows

SEVEN = [
    ("a", 1, 10.0),
    ("a", 2, None),
    ("a", 3, 15.0),
    ("a", 4, 0.0),
    ("a", 5, 5.0),
    ("b", 1, -4.0),
    ("b", 2, 2.0),
]
SEVEN_GROWN = [
    ("a", 1, 0.0, 10.0),
    ("a", 2, 0.0, 10.0),
    ("a", 3, 0.0, 25.0),
    ("a", 4, -100.0, 25.0),
    ("a", 5, None, 30.0),
    ("b", 1, 0.0, -4.0),
    ("b", 2, -150.0, -2.0),
]


@pytest.mark.parametrize("width", [None, 1, 2, 3, 100])
def test_seven_rows(spark, width):
    df = spark.createDataFrame(SEVEN, "k string, t int, v double")
    slices = [F.floor(F.col("t") / width)] if width else []
    grown = add_growth(df, ["k"], ["t"], "v", slices=slices)
    assert grown.columns == ["k", "t", "v", "PercentGrowth", "AccumulateValue"]
    rows = grown.select("k", "t", "PercentGrowth", "AccumulateValue").collect()
    assert sorted(map(tuple, rows)) == SEVEN_GROWN


def _brute_force(rows):
    """Expected (k, d, i) -> (number, growth, total) by going through each group in order."""
    expected, groups = {}, {}
    for k, d, i, v in rows:
        groups.setdefault(k, []).append((d, i, v))
    for k, group in groups.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))
        previous, total = None, None
        for number, (d, i, v) in enumerate(group, 1):
            if v is None or previous is None:
                growth = 0.0
            elif previous == 0:
                growth = None
            else:
                growth = (v - previous) / previous * 100
            if v is not None:
                total = (total or 0.0) + v
            expected[k, d, i] = (number, growth, total)
            previous = v
    return expected


def _random_rows(seed):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["x", "y", None]
    rows, value = [], [None, 0.0, 1.0, 2.0, -4.0, 8.5, 16.0]
    for i in range(600):
        rows.append((rng.choice(keys), rng.randrange(9) or None, i, rng.choice(value)))
    rows.append(("x", 3, None, 2.0))
    return rows


def _check(df, rows, keys, slices):
    expected = _brute_force(rows)
    order = ["d", "i"]
    grown = add_growth(df, keys, order, "v", slices=slices)
    numbered = number_rows(df, keys, order, slices=slices)
    got = {(r.k, r.d, r.i): [r.PercentGrowth, r.AccumulateValue] for r in grown.collect()}
    numbers = {(r.k, r.d, r.i): r.RowNum for r in numbered.collect()}
    assert got.keys() == numbers.keys() == expected.keys()
    for row, (number, growth, total) in expected.items():
        assert numbers[row] == number
        for found, wanted in zip(got[row], (growth, total)):
            assert found == (None if wanted is None else pytest.approx(wanted, abs=0.006))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cut", ["none", "leading", "both"])
def test_slices_do_not_change_results(spark, seed, cut):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, "k string, d int, i int, v double").repartition(7)
    slices = {
        "none": [],
        "leading": ["d"],
        "both": [F.col("d"), F.floor(F.col("i") / 50)],
    }[cut]
    _check(df, rows, ["k"], slices)


def test_even_cuts_do_not_change_results(spark):
    rows = _random_rows(3)
    df = spark.createDataFrame(rows, "k string, d int, i int, v double").repartition(7)
    cut = cut_evenly(df, "i", "slice", rows_per_slice=40)
    assert cut.select("slice").distinct().count() > 10
    _check(cut, rows, ["k"], ["d", "slice"])


def test_single_order_column_with_null(spark):
    rows = [("a", None, 3.0), ("a", 1, 6.0), ("a", 5, 3.0), ("a", 6, 9.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    slices = [F.floor(F.col("t") / 5)]
    grown = add_growth(df, ["k"], ["t"], "v", slices=slices).collect()
    assert sorted((r.t or 0, r.PercentGrowth, r.AccumulateValue) for r in grown) == [
        (0, 0.0, 3.0),
        (1, 100.0, 9.0),
        (5, -50.0, 12.0),
        (6, 200.0, 21.0),
    ]


def test_without_keys_the_table_is_one_group(spark):
    df = cut_evenly(spark.range(1000).withColumn("v", F.lit(2.0)), "id", "slice", 100)
    numbered = number_rows(df, [], ["id"], slices=["slice"])
    assert numbered.filter(F.col("RowNum") != F.col("id") + 1).count() == 0
    grown = add_growth(df, [], ["id"], "v", slices=["slice"])
    assert grown.agg(F.max("AccumulateValue")).first()[0] == 2000.0


def _slice_sizes(df, **options):
    cut = cut_evenly(df, df.columns[0], "slice", **options)
    return {row[0]: row[1] for row in cut.groupBy("slice").count().collect()}


def test_even_cuts_of_nothing_and_of_one_value(spark):
    assert _slice_sizes(spark.createDataFrame([], "i int")) == {}
    assert len(_slice_sizes(spark.createDataFrame([(7,), (7,)], "i int"))) == 1


def test_even_cuts_in_spite_of_an_outlier(spark):
    df = spark.range(10_000).union(spark.createDataFrame([(10**15,)], "id bigint"))
    sizes = _slice_sizes(df, rows_per_slice=500)
    assert len(sizes) == 21 and max(sizes.values()) < 1000


def test_even_cuts_follow_the_sort_order(spark):
    values = [None, float("-inf"), -1.5, 0.0, 2.5, 7.0, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = cut_evenly(df, "x", "slice", at_least=4).orderBy("x").collect()
    assert [row.slice for row in rows] == sorted(row.slice for row in rows)
    assert rows[0].slice == 0


def test_decimal_values_are_summed_exactly(spark):
    df = spark.range(1, 101).select(
        "id", (F.lit("90071992547409.93").cast("decimal(18,2)")).alias("v")
    )
    cut = cut_evenly(df, "id", "slice", 10)
    last = add_growth(cut, [], ["id"], "v", slices=["slice"]).orderBy(F.desc("id")).first()
    assert str(last.AccumulateValue) == "9007199254740993.00"
    assert last.PercentGrowth == 0


def test_other_columns_survive(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0, [1, 2], {"x": 1})], "k string, t int, v double, l array<int>, m map<string,int>"
    )
    row = number_rows(df, ["k"], ["t"], slices=[F.col("t")]).first()
    assert row.asDict() == {"k": "a", "t": 1, "v": 1.0, "l": [1, 2], "m": {"x": 1}, "RowNum": 1}


def test_a_hot_group_is_shuffled_in_slices(spark):
    # Not a literal, which the optimizer would drop from the shuffle key.
    key = F.when(F.col("id") >= 0, "hot").otherwise("cold")
    df = cut_evenly(spark.range(10_000).select(key.alias("k"), "id"), "id", "slice", 100)
    numbered = number_rows(df, ["k"], ["id"], slices=["slice"])
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and ", _slice0#" in plan
    assert "SinglePartition" not in plan
    assert numbered.agg(F.max("RowNum")).first()[0] == 10_000


@pytest.mark.parametrize("rows", [1_000, 50_000, 200_000])
def test_slices_grow_with_the_rows(spark, rows):
    cut = cut_evenly(spark.range(rows), "id", "slice", rows_per_slice=20)
    sizes = cut.groupBy("slice").count().agg(F.count("*"), F.max("count")).first()
    assert sizes[0] > rows / 40 and sizes[1] < 200


def _dated_rows(seed):
    """Groups with dates, texts and numbers in their order, two thirds of all rows in one."""
    rng = random.Random(seed)
    days = [None, *[f"2020-01-{day:02}" for day in range(1, 12)]]
    texts = [None, "", "a", "B", "\u00e9", "zz", "a\u0000"]
    rows = []
    for i in range(900):
        key = rng.choice(["hot", "hot", "hot", "hot", "x", None])
        rows.append((key, rng.choice(days), rng.choice(texts), i if i % 90 else None, rng.choice([None, 0.0, 1.5, -2.0, 8.25])))
    unique = {(row[0], row[1], row[2], row[3]): row for row in rows}
    return list(unique.values())


@pytest.mark.parametrize("together", [2, 1024])
def test_ranges_of_dates_and_texts_equal_a_plain_window(spark, monkeypatch, together):
    monkeypatch.setattr(windows, "_SLICES_TOGETHER", together)
    schema = "k string, day string, name string, i int, v double"
    df = spark.createDataFrame(_dated_rows(together), schema).withColumn("day", F.to_date("day")).repartition(5)
    order = ["day", "name", "i"]
    cut = cut_by_range(df, ["k"], order, "slice", rows_per_slice=40)
    assert cut.filter("k = 'hot'").select("slice").distinct().count() > 8
    sliced, plain = (
        add_growth(number_rows(frame, ["k"], order, slices=slices), ["k"], order, "v", slices=slices)
        .select(*df.columns, "RowNum", "PercentGrowth", "AccumulateValue").collect()
        for frame, slices in ((cut, ["slice"]), (df, []))
    )
    assert sorted(sliced, key=repr) == sorted(plain, key=repr)


def test_ranges_without_keys_and_without_rows(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("t"), F.lit(1.0).alias("v"))
    cut = cut_by_range(df, [], ["t"], "slice", rows_per_slice=20)
    found = add_growth(cut, [], ["t"], "v", slices=["slice"])
    assert [row.AccumulateValue for row in found.orderBy("t").collect()] == [float(n) for n in range(1, 501)]
    assert cut_by_range(df.limit(0), [], ["t"], "slice").isEmpty()
