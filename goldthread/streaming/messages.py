"""Message streams: ``message_id, publish_time TIMESTAMP, data BINARY, attributes MAP``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldthread.functions.extract import with_json_value
from goldthread.functions.text import utf8_text

MESSAGE_SCHEMA = (
    "message_id string, publish_time timestamp, data binary, attributes map<string,string>")
KEY_PATH = ("payload", "personaId")


def file_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages from a folder of Parquet files, in order of arrival."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def queue_messages(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages from a Kafka topic; needs the Kafka connector on the class path."""
    return from_queue_records(
        spark.readStream.format("kafka").options(**options).option("includeHeaders", "true").load())


def from_queue_records(records: DataFrame) -> DataFrame:
    """Kafka records as messages: headers are the attributes.

    The id and the event time come from the headers ``message_id`` and ``publish_time``; without
    them the position in the topic and the record time take their place.
    """
    headers = F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string")))
    attributes = F.coalesce(F.map_from_entries(headers), F.create_map().cast("map<string,string>"))
    position = F.concat_ws("-", "topic", "partition", "offset")
    return records.withColumn("attributes", attributes).select(
        F.coalesce(F.try_element_at("attributes", F.lit("message_id")), position).alias("message_id"),
        F.coalesce(F.try_element_at("attributes", F.lit("publish_time")).try_cast("timestamp"), "timestamp")
        .alias("publish_time"),
        F.col("value").alias("data"), "attributes")


def deduplicate(messages: DataFrame, delay: str) -> DataFrame:
    """Each ``message_id`` once; rows later than ``delay`` behind the newest event time are dropped.

    State is kept per id and only until the watermark has passed it.
    """
    return messages.withWatermark("publish_time", delay).dropDuplicatesWithinWatermark(["message_id"])


def with_event_key(messages: DataFrame, key: str = "persona_id", path: Sequence[str] = KEY_PATH) -> DataFrame:
    """Add the key found in the message's JSON; null when there is none or the message is unreadable."""
    return with_json_value(messages, key, utf8_text(F.col("data")), path)


def event_keys(messages: DataFrame, key: str = "persona_id", path: Sequence[str] = KEY_PATH) -> DataFrame:
    """Messages that carry a key."""
    return with_event_key(messages, key, path).filter(F.col(key) != "")
