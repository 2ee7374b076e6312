"""Sources and sinks on files. The Avro module is not installed here: ORC stands in."""

import datetime
import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallybrook.scratch import scratch_folder, written
from tallybrook.sinks import write_files, write_partitioned_json, write_two_formats
from tallybrook.sources import literal_table, read_files, register_view, run_sql


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [
            (2, "b,\"q\"", 1.5, datetime.datetime(2020, 1, 2, 3, 4, 5), "x"),
            (1, "", None, None, "y"),
            (3, None, -0.25, datetime.datetime(1999, 12, 31), "x"),
        ],
        "z bigint, a string, v double, t timestamp_ntz, p string",
    )


def _rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_round_trip_with_schema(sample, tmp_path, fmt):
    options = {"nullValue": r"\N"} if fmt == "csv" else {}
    write_files(sample, str(tmp_path / "out"), fmt, options)
    back = read_files(sample.sparkSession, str(tmp_path / "out"), fmt, sample.schema, options)
    assert back.columns == sample.columns
    assert _rows(back) == _rows(sample)


def test_csv_keeps_every_text(spark, tmp_path):
    texts = [" lead", "trail ", "a\nb", "a\rb", "a\r\nb", r"\N", r"\\N", r"x\N", "", None, '"', 'a","b', "\\", '\\"', ",", "\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    write_files(df, str(tmp_path / "out"), "csv")
    back = read_files(spark, str(tmp_path / "out"), "csv", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(enumerate(texts))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_a_missing_column_is_an_error(spark, sample, tmp_path, fmt):
    write_files(sample.drop("v"), str(tmp_path / "out"), fmt)
    with pytest.raises(ValueError, match="no column v"):
        read_files(spark, str(tmp_path / "out"), fmt, sample.schema)


def test_sinks_replace_their_folder(sample, tmp_path):
    for _ in range(2):
        write_files(sample, str(tmp_path / "out"), "parquet")
    assert read_files(sample.sparkSession, str(tmp_path / "out"), "parquet").count() == 3


def test_csv_inference_leaves_day_first_dates_as_text(spark, tmp_path):
    (tmp_path / "in.csv").write_text("No,Price,Date\n1,2.5,01-12-2010 8.26\n2,3.5,31-12-2010 9.00\n")
    df = read_files(spark, str(tmp_path / "in.csv"), "csv")
    assert df.dtypes == [("No", "int"), ("Price", "double"), ("Date", "string")]


def test_json_folder_inference_sorts_columns(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"id": 1, "b": "x"}\n')
    (tmp_path / "2.json").write_text('{"id": 2, "a": 0.5}\n{"id": 3}\n')
    df = read_files(spark, str(tmp_path), "json")
    assert df.columns == ["a", "b", "id"]
    assert _rows(df) == [(0.5, None, 2), (None, "x", 1), (None, None, 3)]


def test_partitioned_json(spark, tmp_path):
    df = spark.range(0, 1000, 1, 5).select(
        "id",
        F.when(F.col("id") < 700, "hot").otherwise("cold").alias("a"),
        (F.col("id") % 3).alias("b"),
    )
    path = str(tmp_path / "out")
    write_partitioned_json(df, path, ["a", "b"], 100, rebalance=True)
    files = glob.glob(f"{path}/a=*/b=*/*.json")
    sizes = [sum(1 for _ in open(name)) for name in files]
    assert sum(sizes) == 1000 and max(sizes) == 100
    assert {os.path.relpath(os.path.dirname(name), path) for name in files} == {
        f"a={a}/b={b}" for a in ("hot", "cold") for b in range(3)
    }
    back = read_files(spark, path, "json", df.schema)
    assert back.columns == ["id", "a", "b"]
    assert _rows(back) == _rows(df)
    pruned = back.filter("a = 'cold'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(a" in pruned


def test_rebalancing_saves_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).withColumn("a", F.col("id") % 6)
    write_partitioned_json(df, str(tmp_path / "as_is"), ["a"], rebalance=False)
    write_partitioned_json(df, str(tmp_path / "rebalanced"), ["a"], rebalance=True)
    counts = [len(glob.glob(f"{tmp_path}/{name}/a=*/*.json")) for name in ("as_is", "rebalanced")]
    assert counts == [48, 6]


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    hot = F.when(F.col("id") < 200_000, "hot").otherwise((F.col("id") % 5).cast("string"))
    df = spark.range(0, 300_000, 1, 8).select("id", hot.alias("a"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        write_partitioned_json(df, str(tmp_path / "out"), ["a"], rebalance=True)
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{tmp_path}/out/a=hot/*.json")) > 3
    assert spark.read.json(str(tmp_path / "out")).count() == 300_000


def test_two_formats_compute_their_input_once(spark, sample, tmp_path):
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    df = sample.mapInArrow(count, sample.schema)
    write_two_formats(df, str(tmp_path / "c"), str(tmp_path / "j"), ["p"], 10, columnar="orc")
    assert counted.value == 3
    assert _rows(spark.read.orc(str(tmp_path / "c"))) == _rows(sample)
    assert _rows(read_files(spark, str(tmp_path / "j"), "json", sample.schema)) == _rows(sample)


@pytest.mark.parametrize("fmt", ["avro", "kafka"])
def test_missing_modules_are_named(spark, fmt):
    with pytest.raises(AnalysisException, match=fmt):
        read_files(spark, "x", fmt, options={"subscribe": "t"})


def test_literal_table_and_views(spark):
    people = literal_table(spark, [("A", 31), ("B", 25)], ["Name", "Age"])
    assert people.dtypes == [("Name", "string"), ("Age", "bigint")]
    register_view(people, "people_test")
    register_view(people.filter("Age > 30"), "people_test")
    assert _rows(spark.sql("SELECT * FROM people_test")) == [("A", 31)]
    named = run_sql(spark, "SELECT Name FROM {p} WHERE Age < :limit", {"limit": 30}, p=people)
    assert _rows(named) == [("B",)]


def test_scratch_folders_are_new_and_shared(spark, sample):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    assert _rows(written(sample, "x")) == _rows(sample)

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    shared = Session(spark_checkpoint_dir="hdfs://shared/ck/", spark_master="yarn")
    assert scratch_folder(shared, "x").startswith("hdfs://shared/ck/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(Session(spark_master="yarn"), "x")
