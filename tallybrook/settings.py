"""Layered connection settings turned into Spark connector options."""

from __future__ import annotations

from collections.abc import Mapping


# Sections by name, for instance a ConfigParser.
Sections = Mapping[str, Mapping[str, str]]


class SettingsError(ValueError):
    """A setting is missing or cannot be used."""


# Client setting name -> Spark Kafka connector option name.
_SHARED_KEYS = {
    "bootstrap.servers": "kafka.bootstrap.servers",
    "security.protocol": "kafka.security.protocol",
    "sasl.mechanisms": "kafka.sasl.mechanism",
}
_WRITER_KEYS = {
    "acks": "kafka.acks",
    "retries": "kafka.retries",
    "batch.size": "kafka.batch.size",
    "linger.ms": "kafka.linger.ms",
}
# SASL mechanism -> login module of the Kafka client.
_LOGIN_MODULES = {
    "PLAIN": "org.apache.kafka.common.security.plain.PlainLoginModule",
    "SCRAM-SHA-256": "org.apache.kafka.common.security.scram.ScramLoginModule",
    "SCRAM-SHA-512": "org.apache.kafka.common.security.scram.ScramLoginModule",
}
# Other names of a client setting, and settings passed on under their name.
_SAME_KEYS = {"sasl.mechanism": "sasl.mechanisms"}
_PASSED_ON = (
    "client.id",
    "client.dns.lookup",
    "request.timeout.ms",
    "retry.backoff.ms",
    "reconnect.backoff.ms",
    "reconnect.backoff.max.ms",
    "metadata.max.age.ms",
    "connections.max.idle.ms",
    "compression.type",
    "delivery.timeout.ms",
    "max.in.flight.requests.per.connection",
    "max.request.size",
    "fetch.min.bytes",
    "fetch.max.bytes",
    "max.partition.fetch.bytes",
    "session.timeout.ms",
    "heartbeat.interval.ms",
    "isolation.level",
    "ssl.truststore.location",
    "ssl.truststore.password",
    "ssl.truststore.type",
    "ssl.truststore.certificates",
    "ssl.keystore.location",
    "ssl.keystore.password",
    "ssl.keystore.type",
    "ssl.key.password",
    "ssl.endpoint.identification.algorithm",
)
# Spark decides these, or another function reads them.
_MANAGED = frozenset(
    {
        "sasl.username",
        "sasl.password",
        "auto.offset.reset",
        "enable.auto.commit",
        "group.id",
        "queue.buffering.max.kbytes",
        "key.serializer",
        "value.serializer",
        "key.deserializer",
        "value.deserializer",
    }
)
_SECRET_MARKS = ("password", "jaas", "secret", "connection.uri", "connection.string")


def layered(*sections: Mapping[str, str]) -> dict[str, str]:
    """Overlay sections from left to right; the right-most value of a key wins."""
    merged: dict[str, str] = {}
    for section in sections:
        merged.update(section)
    return merged


def redacted(options: Mapping[str, str]) -> dict[str, str]:
    """A copy that is safe to log."""
    return {
        key: "***" if any(mark in key.lower() for mark in _SECRET_MARKS) else value
        for key, value in options.items()
    }


def whole_number(section: Mapping[str, str], key: str, minimum: int = 1) -> int:
    try:
        number = int(section[key])
    except KeyError:
        raise SettingsError(f"{key} is missing") from None
    except ValueError:
        raise SettingsError(f"{key} is not a whole number: {section[key]!r}") from None
    if number < minimum:
        raise SettingsError(f"{key} must be at least {minimum}: {number}")
    return number


def _connection(section: Mapping[str, str]) -> dict[str, str]:
    section = {_SAME_KEYS.get(key, key): value for key, value in section.items()}
    if not section.get("bootstrap.servers"):
        raise SettingsError("bootstrap.servers is missing")
    known = {*_SHARED_KEYS, *_WRITER_KEYS, *_PASSED_ON, *_MANAGED}
    unknown = sorted(set(section) - known)
    if unknown:
        raise SettingsError(f"no Spark option for {', '.join(unknown)}")
    options = {new: section[old] for old, new in _SHARED_KEYS.items() if old in section}
    options |= {f"kafka.{key}": section[key] for key in _PASSED_ON if key in section}
    user, password = section.get("sasl.username"), section.get("sasl.password")
    if (user is None) != (password is None):
        raise SettingsError("sasl.username and sasl.password go together")
    if user is not None:
        mechanism = section.get("sasl.mechanisms", "PLAIN")
        if mechanism not in _LOGIN_MODULES:
            raise SettingsError(f"no login module for sasl.mechanisms {mechanism!r}")
        quoted = [part.replace("\\", "\\\\").replace('"', '\\"') for part in (user, password)]
        options["kafka.sasl.jaas.config"] = (
            f"{_LOGIN_MODULES[mechanism]} required "
            f'username="{quoted[0]}" password="{quoted[1]}";'
        )
    return options


def reader_options(
    section: Mapping[str, str],
    topic: str,
    batch_records: int | None = None,
    wait_records: int | None = None,
    wait_seconds: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Kafka source options for one topic.

    A batch starts once there are ``wait_records`` or, if there is anything,
    after ``wait_seconds``, and takes at most ``batch_records``.

    ``auto.offset.reset`` only decides where a query without a checkpoint starts,
    like a consumer group without a committed offset. ``min_partitions`` splits
    a topic partition over several tasks, so that one partition holding most of
    the backlog does not become one long task.
    """
    start = section.get("auto.offset.reset", "latest")
    if start not in ("earliest", "latest"):
        raise SettingsError(f"auto.offset.reset must be earliest or latest: {start!r}")
    if section.get("enable.auto.commit", "false").strip().lower() != "false":
        raise SettingsError("enable.auto.commit must be false: the checkpoint keeps progress")
    options = _connection(section)
    options["subscribe"] = topic
    # Spark commits to no group; a broker that permits groups by name sees this prefix.
    if section.get("group.id"):
        options["groupIdPrefix"] = section["group.id"]
    options["startingOffsets"] = start
    options["includeHeaders"] = "true"
    options["failOnDataLoss"] = "true"
    bounds = {
        "maxOffsetsPerTrigger": batch_records,
        "minOffsetsPerTrigger": wait_records,
        "maxTriggerDelay": wait_seconds,
        "minPartitions": min_partitions,
    }
    for option, bound in bounds.items():
        if bound is None:
            continue
        if bound < 1:
            raise SettingsError(f"{option} must be positive: {bound}")
        options[option] = f"{bound}s" if option == "maxTriggerDelay" else str(bound)
    return options


def writer_options(section: Mapping[str, str], topic: str) -> dict[str, str]:
    """Kafka sink options for one topic."""
    options = _connection(section)
    options["topic"] = topic
    for old, new in _WRITER_KEYS.items():
        if old in section:
            options[new] = section[old]
    if "queue.buffering.max.kbytes" in section:
        kilobytes = whole_number(section, "queue.buffering.max.kbytes")
        options["kafka.buffer.memory"] = str(kilobytes * 1024)
    return options


def document_store_options(section: Mapping[str, str]) -> dict[str, str]:
    """MongoDB connector write options.

    The message position is the document's identity, so a replayed batch
    replaces its documents instead of inserting them again. JSON text in a
    column is stored as the object it describes.
    """
    try:
        options = {
            "connection.uri": section["connection.string"],
            "database": section["database.name"],
            "collection": section["collection.name"],
        }
    except KeyError as missing:
        raise SettingsError(f"{missing.args[0]} is missing") from None
    options["ordered"] = "false"
    options["operationType"] = "replace"
    options["upsertDocument"] = "true"
    options["idFieldList"] = "topic,partition,offset"
    options["convertJson"] = "objectOrArrayOnly"
    return options


# How many polls of a client one batch stands for. A batch is spread over executors,
# so callers with many of them ask for more.
POLLS_PER_BATCH = 1


def _polled(
    section: Mapping[str, str], other: Mapping[str, str], side: str, topic: str, polls: int,
    min_partitions: int | None,
) -> dict[str, str]:
    records = whole_number(other, f"{side}.max.poll.records")
    return reader_options(
        section,
        _named(other, topic),
        batch_records=records * polls,
        wait_records=records,
        wait_seconds=whole_number(other, f"{side}.poll.timeout"),
        min_partitions=min_partitions,
    )


def _named(section: Mapping[str, str], key: str) -> str:
    if not section.get(key):
        raise SettingsError(f"{key} is missing")
    return section[key]


def bridge_options(
    sections: Sections, polls_per_batch: int = POLLS_PER_BATCH, min_partitions: int | None = None
) -> tuple[dict[str, str], dict[str, str]]:
    """Source and sink options of the topic copy."""
    other = sections["other"]
    remote = layered(sections["kafka_remote"], sections["remote_consumer_config"])
    source = _polled(
        remote, other, "remote", "remote.topic.name", polls_per_batch, min_partitions
    )
    local = layered(sections["kafka_main"], sections["producer_config"])
    return source, writer_options(local, _named(other, "source.topic.name"))


def ingest_options(
    sections: Sections, polls_per_batch: int = POLLS_PER_BATCH, min_partitions: int | None = None
) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Source, document store and dead letter topic options of the ingestion."""
    other = sections["other"]
    main = layered(sections["kafka_main"], sections["consumer_config"])
    source = _polled(main, other, "source", "source.topic.name", polls_per_batch, min_partitions)
    dead = layered(sections["kafka_main"], sections["producer_config"])
    return (
        source,
        document_store_options(sections["mongodb"]),
        writer_options(dead, _named(other, "source.dlq.topic.name")),
    )
