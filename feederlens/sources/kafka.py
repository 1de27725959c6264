"""Kafka topics with text keys and values. Needs Spark's Kafka connector on the class path."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def stream_options(
    brokers: str, topics: str | Sequence[str], start: str = "latest", max_records: int | None = None
) -> dict[str, str]:
    """``start`` only counts for a new query: later ones go on from the checkpoint."""
    names = topics.split(",") if isinstance(topics, str) else topics
    names = [n.strip() for n in names if n.strip()]
    if not names:
        raise ValueError("no topic given")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(names),
        "startingOffsets": start,
    }
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def _text(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset"
    )


def read_stream(
    spark: SparkSession, brokers: str, topics: str | Sequence[str], start: str = "latest",
    max_records: int | None = None,
) -> DataFrame:
    options = stream_options(brokers, topics, start, max_records)
    return _text(spark.readStream.format("kafka").options(**options).load())


def peek_options(brokers: str, topic: str, partition: int, offset: int) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": brokers,
        "assign": json.dumps({topic: [partition]}),
        "startingOffsets": json.dumps({topic: {str(partition): offset}}),
        "endingOffsets": json.dumps({topic: {str(partition): -1}}),
    }


def peek_topic(
    spark: SparkSession, brokers: str, topic: str, partition: int, offset: int, count: int = 20
) -> DataFrame:
    """Up to ``count`` records of one partition from an offset on. One partition is one task, which
    reads in the order of offsets, so the limit ends it early."""
    options = peek_options(brokers, topic, partition, offset)
    return _text(spark.read.format("kafka").options(**options).load()).limit(count)


def records_in_order(lines: DataFrame) -> DataFrame:
    """Lines (``value``, ``file``, ``line``) as records: the lines of a file follow each other in one task and
    have one key, so they reach one partition of a topic in their order. Files are spread over tasks; the sort
    spills, so a task holds no file. Without ``line`` only files are kept together."""
    place = ["file", "line"] if "line" in lines.columns else ["file"]
    dealt = lines.repartition("file").sortWithinPartitions(*place)
    return dealt.select(F.col("file").alias("key"), "value")


def feed_topic(lines: DataFrame, brokers: str, topic: str) -> None:
    """Sends lines of files, each file's in their order."""
    (
        records_in_order(lines)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )
