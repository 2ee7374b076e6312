"""Batches by manifest, batches bounded by bytes, and restarts."""

import json
import shutil
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from tallybrook.sinks import FolderSink, ManifestSink, batches, read_batches
from tallybrook.sources import file_stream
from tallybrook.sources.kafka import MESSAGE_SCHEMA
from tallybrook.streaming import run_with_restarts, start_ingest

UNTIL_READ = {"availableNow": True}


def _add(spark, folder, name, offsets, size=0):
    rows = [(None, b'{"n": %d}' % i + b" " * size, "in", 0, i, None, 0, None) for i in offsets]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def inbox(spark, tmp_path):
    for number in range(3):
        _add(spark, tmp_path / "inbox", f"part={number}", range(number * 10, number * 10 + 10))
    return tmp_path / "inbox"


def _start(spark, inbox, sink, tmp_path, **more):
    messages = file_stream(spark, f"{inbox}/*", "parquet", MESSAGE_SCHEMA, **(more or {"files_per_batch": 1}))
    return start_ingest(
        messages, sink, ManifestSink(f"{tmp_path}/dead"), f"{tmp_path}/checkpoint", UNTIL_READ,
        metrics=ManifestSink(f"{tmp_path}/metrics"),
    )


def _offsets(spark, path):
    return sorted(row.offset for row in read_batches(spark, str(path)).collect())


def test_batches_are_read_by_their_manifests(spark, inbox, tmp_path):
    sink = ManifestSink(f"{tmp_path}/documents")
    _start(spark, inbox, sink, tmp_path).awaitTermination()
    assert _offsets(spark, sink.path) == list(range(30))
    found = batches(spark, sink.path).orderBy("batch_id").collect()
    assert [(row.batch_id, row.num_rows) for row in found] == [(0, 10), (1, 10), (2, 10)]
    for row in found:
        for file in row.files:
            assert Path(file.path.removeprefix("file:")).stat().st_size == file.bytes
    counts = read_batches(spark, f"{tmp_path}/metrics").collect()
    assert [(row.num_in, row.num_stored) for row in counts] == [(10, 10)] * 3
    assert read_batches(spark, f"{tmp_path}/dead").count() == 0


def test_what_has_no_whole_manifest_is_not_read(spark, tmp_path):
    path, rows = f"{tmp_path}/sink", spark.range(5)
    ManifestSink(path, query="q").write(rows, 0)
    # A writer that ended before its manifest, within its manifest, and within a file.
    spark.range(100, 105).write.parquet(f"{path}/data/stray")
    (Path(path) / "data/half").mkdir()
    (Path(path) / "data/half/part-0.parquet").write_bytes(b"PAR1 half")
    whole = next(Path(path).glob("manifests/query_id=q/batch_id=0/*.json")).read_text()
    for batch, text in ((1, whole[: len(whole) // 2]), (2, ""), (3, whole.replace('"num_files":', '"num_files":9'))):
        (Path(path) / f"manifests/query_id=q/batch_id={batch}").mkdir()
        (Path(path) / f"manifests/query_id=q/batch_id={batch}/part-0.json").write_text(text)
    assert sorted(row.id for row in read_batches(spark, path).collect()) == list(range(5))
    # The batch that was cut short is written again.
    ManifestSink(path, query="q").write(spark.range(5, 8), 1)
    assert sorted(row.id for row in read_batches(spark, path).collect()) == list(range(8))


def test_a_replay_and_two_finished_attempts_are_one_batch(spark, tmp_path):
    path = f"{tmp_path}/sink"
    sink = ManifestSink(path, query="q")
    for _ in range(2):
        sink.write(spark.range(5), 0)
    assert len(list(Path(path).glob("data/*"))) == 1
    # Two writers that did not see each other's manifest.
    ManifestSink(f"{tmp_path}/other", query="q").write(spark.range(5), 0)
    shutil.copytree(f"{tmp_path}/other/manifests", f"{path}/manifests", dirs_exist_ok=True)
    assert len(list(Path(path).glob("manifests/query_id=q/batch_id=0/*.json"))) == 2
    assert sorted(row.id for row in read_batches(spark, path).collect()) == list(range(5))
    # Another query's batch of that number is another batch.
    ManifestSink(path, query="r").write(spark.range(5), 0)
    assert read_batches(spark, path).count() == 10


def test_no_rename_makes_a_batch_visible(spark, tmp_path):
    """Data and manifests are on two mounts, between which nothing can be renamed."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in ("data", "manifests"):
        (tmp_path / name).mkdir()
        conf.set(f"fs.viewfs.mounttable.commits.link./{name}", (tmp_path / name).as_uri())
    path = "viewfs://commits"
    ManifestSink(path, query="q").write(spark.range(5), 0)
    ManifestSink(path, query="q").write(spark.range(5), 0)
    assert sorted(row.id for row in read_batches(spark, path).collect()) == list(range(5))


def test_empty_batches_formats_and_schemas(spark, tmp_path):
    path = f"{tmp_path}/sink"
    with pytest.raises(ValueError, match="no complete batch"):
        read_batches(spark, path)
    assert read_batches(spark, path, "a int").columns == ["a"]
    ManifestSink(path, query="q").write(spark.range(0), 0)
    assert read_batches(spark, path).count() == 0 and read_batches(spark, path).columns == ["id"]
    ManifestSink(path, query="q").write(spark.createDataFrame([("x",)], "other string"), 1)
    with pytest.raises(ValueError, match="differ"):
        read_batches(spark, path)
    assert read_batches(spark, path, "id bigint, other string").count() == 1
    text = ManifestSink(f"{tmp_path}/text", "text", query="q")
    text.write(spark.createDataFrame([('{"a": 1}',)], "value string"), 0)
    assert [json.loads(row.value) for row in read_batches(spark, text.path).collect()] == [{"a": 1}]


def test_batches_bounded_by_bytes(spark, tmp_path):
    """One large and many small files."""
    inbox = tmp_path / "inbox"
    for number in range(8):
        (inbox / f"part={number}").mkdir(parents=True)
        text = "x" * (9_000 if number == 3 else 900)
        (inbox / f"part={number}" / "a.txt").write_text(text)
    sizes = []
    stream = file_stream(spark, f"{inbox}/*", "text", "value string", bytes_per_batch=3_000)
    stream.writeStream.foreachBatch(
        lambda batch, _: sizes.append([len(row.value) for row in batch.collect()])
    ).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(**UNTIL_READ).start().awaitTermination()
    assert sum(map(len, sizes)) == 8 and sum(map(sum, sizes)) == 9_000 + 7 * 900
    assert all(sum(size) <= 3_000 or size == [9_000] for size in sizes)
    assert len(sizes) >= 4
    with pytest.raises(ValueError, match="not by both"):
        file_stream(spark, str(inbox), "text", "value string", 1, 1)


class Fails:
    """A sink that fails a number of times, after its write."""

    def __init__(self, sink, error, times):
        self.sink, self.error, self.left, self.fmt = sink, error, times, sink.fmt

    def write(self, batch, batch_id):
        self.sink.write(batch, batch_id)
        if batch_id == 1 and self.left:
            self.left -= 1
            raise self.error


@pytest.mark.parametrize("kind", [ManifestSink, FolderSink])
def test_a_sink_that_fails_twice_stores_each_message_once(spark, inbox, tmp_path, kind):
    sink = Fails(kind(f"{tmp_path}/documents"), ConnectionResetError("store went away"), 2)
    restarts = run_with_restarts(lambda: _start(spark, inbox, sink, tmp_path), wait=0)
    assert restarts == 2
    stored = read_batches(spark, sink.sink.path) if kind is ManifestSink else spark.read.parquet(sink.sink.path)
    assert sorted(row.offset for row in stored.collect()) == list(range(30))


def test_a_permanent_failure_and_too_many_passing_ones_stop(spark, inbox, tmp_path):
    wrong = Fails(ManifestSink(f"{tmp_path}/documents"), ValueError("wrong field"), 1)
    with pytest.raises(StreamingQueryException, match="wrong field"):
        run_with_restarts(lambda: _start(spark, inbox, wrong, tmp_path), wait=0)
    assert wrong.left == 0
    away = Fails(wrong.sink, TimeoutError("store is away"), 9)
    with pytest.raises(StreamingQueryException, match="store is away"):
        run_with_restarts(lambda: _start(spark, inbox, away, tmp_path), most=2, wait=0)
    assert away.left == 6
    away.left = 0
    assert run_with_restarts(lambda: _start(spark, inbox, away, tmp_path), wait=0) == 0
    assert _offsets(spark, wrong.sink.path) == list(range(30))


def test_conditions_of_the_query_are_permanent(spark, inbox, tmp_path):
    starts = []

    def start():
        starts.append(1)
        stream = file_stream(spark, f"{inbox}/*", "parquet", MESSAGE_SCHEMA)
        failing = stream.selectExpr("CAST(CAST(value AS STRING) AS INT) AS n")
        return failing.writeStream.format("noop").option(
            "checkpointLocation", f"{tmp_path}/checkpoint"
        ).trigger(**UNTIL_READ).start()

    with pytest.raises(StreamingQueryException):
        run_with_restarts(start, wait=0)
    assert len(starts) == 1
