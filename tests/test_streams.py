"""Streaming jobs over files in the layout of the Kafka source.

The Kafka and document store connectors are not installed here; their options
are tested in test_settings.
"""

import json
import logging
import time

import pytest
from pyspark.errors import StreamingQueryException

from tallybrook.sinks import ConnectorSink, FolderSink
from tallybrook.sources import file_stream
from tallybrook.sources.kafka import MESSAGE_SCHEMA
from tallybrook.streaming import ProgressLog, start_bridge, start_ingest

UNTIL_READ = {"availableNow": True}


def _value(i):
    if i % 7 == 3:
        return b"{broken"
    if i % 7 == 5:
        return b"[1]"
    return b'{"n": %d}' % i


def _add_file(spark, folder, name, offsets):
    rows = [
        (b"key", _value(i), "in", 0, i, None, 0, [("h", b"v")] if i % 2 else None) for i in offsets
    ]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    df.coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def inbox(spark, tmp_path):
    """Three files of 40 messages."""
    folder = tmp_path / "inbox"
    for number in range(3):
        _add_file(spark, folder, f"part={number}", range(number * 40, number * 40 + 40))
    return folder


def _stream(spark, inbox, files_per_batch=1):
    return file_stream(spark, f"{inbox}/*", "parquet", MESSAGE_SCHEMA, files_per_batch)


SOUND = {i for i in range(120) if i % 7 not in (3, 5)}


class Places:
    def __init__(self, root):
        self.documents = FolderSink(f"{root}/documents")
        self.dead = FolderSink(f"{root}/dead")
        self.metrics = FolderSink(f"{root}/metrics")
        self.checkpoint = f"{root}/checkpoint"

    def run(self, spark, inbox, documents=None, **more):
        start_ingest(
            _stream(spark, inbox),
            documents or self.documents,
            self.dead,
            self.checkpoint,
            UNTIL_READ,
            metrics=self.metrics,
            **more,
        ).awaitTermination()

    def offsets(self, spark):
        return sorted(row.offset for row in spark.read.parquet(self.documents.path).collect())

    def dead_offsets(self, spark):
        headers = spark.read.parquet(self.dead.path).select("headers").collect()
        return sorted(
            int(bytes(next(h.value for h in row.headers if h.key == "dlq-origin-offset")))
            for row in headers
        )

    def metrics_rows(self, spark):
        rows = spark.read.parquet(self.metrics.path).orderBy("batch_id").collect()
        return [(row.batch_id, row.num_in, row.num_stored, row.num_dead) for row in rows]


@pytest.fixture
def places(tmp_path):
    return Places(tmp_path / "out")


def _check_complete(spark, places):
    assert places.offsets(spark) == sorted(SOUND)
    assert places.dead_offsets(spark) == sorted(set(range(120)) - SOUND)


def test_every_message_is_stored_or_dead(spark, inbox, places):
    places.run(spark, inbox)
    _check_complete(spark, places)
    rows = places.metrics_rows(spark)
    assert [row[:2] for row in rows] == [(0, 40), (1, 40), (2, 40)]
    assert all(row[1] == row[2] + row[3] for row in rows)
    assert sum(row[2] for row in rows) == len(SOUND)


def test_restart_without_new_input_changes_nothing(spark, inbox, places):
    places.run(spark, inbox)
    before = places.metrics_rows(spark)
    places.run(spark, inbox)
    assert places.metrics_rows(spark) == before
    _check_complete(spark, places)


def test_restart_reads_only_new_input(spark, inbox, places):
    places.run(spark, inbox)
    _add_file(spark, inbox, "part=3", range(200, 210))
    places.run(spark, inbox)
    assert [row[:2] for row in places.metrics_rows(spark)][3:] == [(3, 10)]
    assert max(places.offsets(spark)) == 209


class FailsAfterWriting(FolderSink):
    def write(self, batch, batch_id):
        super().write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost connection")


def test_batch_that_failed_after_its_write_is_replayed(spark, inbox, places):
    with pytest.raises(StreamingQueryException, match="lost connection"):
        places.run(spark, inbox, FailsAfterWriting(places.documents.path))
    assert [row[0] for row in places.metrics_rows(spark)] == [0]
    places.run(spark, inbox)
    _check_complete(spark, places)
    assert [row[0] for row in places.metrics_rows(spark)] == [0, 1, 2]


def test_another_checkpoint_keeps_what_is_stored(spark, inbox, tmp_path):
    first, second = Places(tmp_path / "out"), Places(tmp_path / "out")
    first.run(spark, inbox)
    _add_file(spark, tmp_path / "more", "part=0", range(200, 210))
    second.checkpoint = f"{tmp_path}/out/second-checkpoint"
    second.run(spark, tmp_path / "more")
    later = {i for i in range(200, 210) if i % 7 not in (3, 5)}
    assert first.offsets(spark) == sorted(SOUND | later)


def test_flat_documents_are_the_objects_and_their_position(spark, tmp_path):
    texts = [b'{"a": {"b": [1, "x"]}, "n": 1.50}', b" {} ", b'{\n"t": "l\\n"\r\n}', b"[1]"]
    rows = [(b"k", text, "in", 0, i, None, 0, None) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/part=0"))
    start_ingest(
        _stream(spark, tmp_path / "in"),
        FolderSink(f"{tmp_path}/documents", "text"),
        FolderSink(f"{tmp_path}/dead"),
        f"{tmp_path}/checkpoint",
        UNTIL_READ,
        flat=True,
    ).awaitTermination()
    lines = [row.value for row in spark.read.text(f"{tmp_path}/documents").collect()]
    stored = {record.pop("_position")["offset"]: record for record in map(json.loads, lines)}
    assert stored == {i: json.loads(texts[i]) for i in range(3)}


def test_a_batch_of_faulty_messages_makes_progress(spark, tmp_path, places):
    _add_file(spark, tmp_path / "inbox", "part=0", [3, 5, 10, 12])
    places.run(spark, tmp_path / "inbox")
    assert places.metrics_rows(spark) == [(0, 4, 0, 4)]
    assert places.offsets(spark) == []


def test_typed_documents_in_a_connector(spark, inbox, places, tmp_path):
    schema = spark.createDataFrame([], "n int").schema
    places.run(
        spark, inbox, ConnectorSink("json", {"path": str(tmp_path / "store")}), schema=schema
    )
    stored = spark.read.json(str(tmp_path / "store"))
    assert stored.columns == ["n", "offset", "partition", "topic"]
    assert {row.n for row in stored.collect()} == SOUND


def test_ingest_leaves_the_session_setting_alone(spark, inbox, places):
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, "false")
    try:
        (inbox / "part=9").mkdir()
        df = spark.createDataFrame(
            [(None, b'{"n":1,"n":2}', "in", 0, 999, None, 0, None)], MESSAGE_SCHEMA
        )
        df.coalesce(1).write.mode("append").parquet(str(inbox / "part=9"))
        places.run(spark, inbox)
        assert spark.conf.get(key) == "false"
        assert 999 in places.offsets(spark)
    finally:
        spark.conf.set(key, "true")


def test_bridge_passes_values_on(spark, inbox, tmp_path):
    for _ in range(2):
        start_bridge(
            _stream(spark, inbox),
            "parquet",
            {"path": str(tmp_path / "copy")},
            str(tmp_path / "checkpoint"),
            UNTIL_READ,
            name="bridge_test",
        ).awaitTermination()
    copied = spark.read.parquet(str(tmp_path / "copy"))
    assert copied.columns == ["value"]
    assert sorted(bytes(r.value) for r in copied.collect()) == sorted(_value(i) for i in range(120))


def test_bridge_can_keep_key_and_headers(spark, inbox, tmp_path):
    start_bridge(
        _stream(spark, inbox),
        "parquet",
        {"path": str(tmp_path / "copy")},
        str(tmp_path / "checkpoint"),
        UNTIL_READ,
        keep_key_headers=True,
    ).awaitTermination()
    copied = spark.read.parquet(str(tmp_path / "copy"))
    assert copied.columns == ["key", "value", "headers"]
    assert copied.filter("headers is not null").count() == 60


def test_progress_log(spark, inbox, places, tmp_path, caplog):
    caplog.set_level(logging.INFO, logger="tallybrook.streaming")
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        start_bridge(
            _stream(spark, inbox, 3),
            "parquet",
            {"path": str(tmp_path / "copy")},
            str(tmp_path / "checkpoint"),
            UNTIL_READ,
            name="copy_test",
        ).awaitTermination()
        places.run(spark, inbox, name="logged_test")
        deadline = time.time() + 20
        while caplog.text.count("stopped") < 2 and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert "query copy_test batch 0: 120 rows {'copied': {'num_copied': 120}}" in caplog.text
    assert "query logged_test batch 0: 40 rows" in caplog.text
    assert "batch 2: stored " in caplog.text and " of 40 messages" in caplog.text
