"""Packet tables and streams, and the columns every decoder derives from a packet."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from packetloom.functions.binary import span
from packetloom.functions.text import V4_MAPPED, ip_text
from packetloom.schema import PACKET_SCHEMA

SFLOW, NETFLOW, NETFLOW5 = "sFlow", "NetFlow", "NetFlowV5"

# The UDP port each channel listens on by default.
CHANNEL_PORT = {SFLOW: 6343, NETFLOW: 2055, NETFLOW5: 2056}


#: Bytes of a datagram that a collector reads.
READ_BYTES = 9000


def as_read(packets: DataFrame, read_bytes: int | None = READ_BYTES) -> DataFrame:
    """Payloads as a collector has them, which cuts longer datagrams off at its read buffer; ``None`` cuts nothing."""
    if read_bytes is None:
        return packets
    return packets.withColumn("payload", F.substring("payload", 1, read_bytes))


def read_packets(spark: SparkSession, path: str, fmt: str = "parquet", read_bytes: int | None = READ_BYTES, **options) -> DataFrame:
    return as_read(spark.read.format(fmt).schema(PACKET_SCHEMA).options(**options).load(path), read_bytes)


def read_packet_stream(spark: SparkSession, path: str, fmt: str = "parquet", read_bytes: int | None = READ_BYTES,
                       **options) -> DataFrame:
    """Packet stream over a directory; pass e.g. ``maxFilesPerTrigger`` to bound a micro-batch."""
    return as_read(spark.readStream.format(fmt).schema(PACKET_SCHEMA).options(**options).load(path), read_bytes)


def packets_from_kafka(records: DataFrame, channel: str) -> DataFrame:
    """Rows of Spark's Kafka source (value = datagram, headers src/src_port) as packets.

    The connector is not part of Spark itself; supply its jar. ``packet_id`` is built from partition and
    offset, so it grows with arrival order inside each partition.
    """
    def header(name):
        return F.get(F.filter("headers", lambda h: h["key"] == name), 0)["value"]

    return records.select(
        (F.col("partition").cast("bigint") * F.lit(1 << 44) + F.col("offset")).alias("packet_id"),
        F.lit(channel).alias("channel"),
        header("src").alias("src"),
        header("src_port").cast("string").cast("int").alias("src_port"),
        F.col("value").alias("payload"),
        F.col("timestamp").alias("recv_time"),
    )


def of_channel(packets: DataFrame, channel: str) -> DataFrame:
    return packets.where(F.col("channel") == channel)


def pinned(packets: DataFrame) -> DataFrame:
    """Packets without a receive time get the time of this call, one literal for all jobs over the result.

    Several jobs look at the same packets (templates, rates, records); with a clock of its own each would order
    them differently. Packets pinned together are ordered by ``packet_id``.
    """
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    return packets.withColumn("recv_time", F.coalesce("recv_time", now))


def received_second() -> Column:
    """Receive time in whole epoch seconds; now, where the capture set none."""
    return F.unix_timestamp(F.coalesce(F.col("recv_time"), F.current_timestamp()))


def router_key() -> Column:
    """Text of the UDP source, the name state and counters are kept under."""
    return ip_text(F.col("src"))


def sampler_address() -> Column:
    """UDP source, v4-mapped addresses in their 4-byte form."""
    src = F.col("src")
    mapped = (F.octet_length(src) == 16) & (span(src, 0, 12) == F.lit(V4_MAPPED))
    return F.when(mapped, span(src, 12, 4)).otherwise(src)
