"""Where flows go: text and JSON lines, keyed messages, partitioned flow tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from packetloom.functions.render import json_line, partition_key, text_line

DEFAULT_KEY = ["SamplerAddress", "DstAS"]
DEFAULT_TOPIC = "flow-messages"


def flows_to_text(flows: DataFrame, fields=None) -> DataFrame:
    return flows.select(text_line(fields).alias("value"))


def flows_to_json(flows: DataFrame, fields=None) -> DataFrame:
    return flows.select(json_line(fields).alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Text or JSON lines (one ``value`` column) to text files."""
    lines.write.mode(mode).text(path)


def read_json_lines(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """What ``flows_to_json`` wrote, every value a string as it was rendered."""
    schema = StructType([StructField(f, StringType()) for f in fields])
    return spark.read.schema(schema).json(path)


def flows_to_messages(flows: DataFrame, topic: str = DEFAULT_TOPIC, key: list[str] | None = None,
                      value=None) -> DataFrame:
    """One (topic, key, value) row per flow. No ``key`` means unkeyed; the value is the JSON line by default."""
    return flows.select(
        F.lit(topic).alias("topic"),
        (partition_key(key) if key is not None else F.lit(None).cast("string")).alias("key"),
        (value if value is not None else json_line()).alias("value"))


def distribute(messages: DataFrame, partitions: int, keyed: bool) -> DataFrame:
    """Spread messages: equal keys to one partition, or evenly where they are unkeyed."""
    return messages.repartition(partitions, "key") if keyed else messages.repartition(partitions)


def write_messages(messages: DataFrame, fmt: str = "parquet", path: str | None = None, **options) -> None:
    """Append to a message log. ``fmt='kafka'`` needs the connector jar and ``kafka.bootstrap.servers``."""
    writer = messages.write.format(fmt).mode("append").options(**options)
    writer.save(path) if path else writer.save()


def write_flow_table(flows: DataFrame, path: str, mode: str = "append", files: int = 8) -> None:
    """Flow table partitioned by receive date and flow type, for pruning; at most ``files`` files in each partition.

    Rows are spread by partition and a salt first. Without that every task would open a file in every partition.
    """
    dated = flows.withColumn("date", F.to_date(F.timestamp_seconds("TimeReceived"))).withColumn("flow_type", F.col("Type"))
    salt = F.pmod(F.xxhash64("SequenceNum", "SrcAddr", "DstAddr", "SrcPort", "DstPort"), F.lit(files))
    dated.repartition("date", "flow_type", salt).write.mode(mode).partitionBy("date", "flow_type").parquet(path)


def register_flows(flows: DataFrame, name: str = "flows") -> None:
    flows.createOrReplaceTempView(name)
