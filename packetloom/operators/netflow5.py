"""NetFlow v5: header checks, record explode and projection, all narrow."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from packetloom.functions.binary import bitfield, bits64, span, uint, uptime_to_epoch
from packetloom.schema import NETFLOW_V5, PROVENANCE, to_flow_columns
from packetloom.sources.packets import received_second, router_key, sampler_address

HEADER_BYTES = 24
RECORD_BYTES = 48
MAX_RECORDS = 65535 // RECORD_BYTES


def read_headers(packets: DataFrame) -> DataFrame:
    """Packets with their v5 header fields and the ``error`` that rejects them, if any.

    A header cut short leaves the fields it no longer holds at zero.
    """
    def field(pos, size):
        whole = F.octet_length("payload") >= pos + size
        return F.when(whole, uint(F.col("payload"), pos, size)).otherwise(F.lit(0).cast("bigint"))

    version, count = field(0, 2), field(2, 2)
    return packets.select(
        "*",
        router_key().alias("router"),
        version.cast("int").alias("version"),
        count.cast("int").alias("record_count"),
        field(4, 4).alias("uptime"),
        field(8, 4).alias("base_time"),
        field(16, 4).alias("sequence"),
        field(22, 2).alias("sampling_interval"),
        F.when(version != 5, "error_version").when(count > MAX_RECORDS, "error_decoding").alias("error"),
    )


def read_records(headers: DataFrame) -> DataFrame:
    """One row per declared record; records the payload no longer holds come out as zero padding."""
    accepted = headers.where(F.col("error").isNull() & (F.col("record_count") > 0))
    rows = accepted.withColumn("record_idx", F.explode(F.sequence(F.lit(0), F.col("record_count") - 1)))
    start = F.col("record_idx") * RECORD_BYTES + HEADER_BYTES
    held = F.octet_length("payload") >= start + RECORD_BYTES
    body = F.when(held, span(F.col("payload"), start, RECORD_BYTES)).otherwise(F.lit(bytes(RECORD_BYTES)))
    return rows.select(*[c for c in rows.columns if c != "payload"], body.alias("rec"), (~held).alias("is_padding"))


def flows_from_netflow5(packets: DataFrame) -> DataFrame:
    """NetFlow v5 packets to flows."""
    recs = read_records(read_headers(packets))
    rec = F.col("rec")
    words = recs.withColumns({
        "w_if": uint(rec, 12, 4),
        "w_vol": bits64(rec, 16),
        "w_time": bits64(rec, 24),
        "w_l4": bits64(rec, 32),
        "w_as": uint(rec, 40, 6),
    })
    base, uptime = F.col("base_time"), F.col("uptime")
    return to_flow_columns(words, {
        "Type": F.lit(NETFLOW_V5),
        "TimeReceived": received_second(),
        "SequenceNum": F.col("sequence"),
        "SamplingRate": F.col("sampling_interval"),
        "SamplerAddress": sampler_address(),
        "TimeFlowStart": uptime_to_epoch(base, uptime, bitfield(F.col("w_time"), 32, 32)),
        "TimeFlowEnd": uptime_to_epoch(base, uptime, bitfield(F.col("w_time"), 0, 32)),
        "Packets": bitfield(F.col("w_vol"), 32, 32),
        "Bytes": bitfield(F.col("w_vol"), 0, 32),
        "SrcAddr": span(rec, 0, 4),
        "DstAddr": span(rec, 4, 4),
        "NextHop": span(rec, 8, 4),
        "Etype": F.lit(0x800),
        "InIf": bitfield(F.col("w_if"), 16, 16),
        "OutIf": bitfield(F.col("w_if"), 0, 16),
        "SrcPort": bitfield(F.col("w_l4"), 48, 16),
        "DstPort": bitfield(F.col("w_l4"), 32, 16),
        "TCPFlags": bitfield(F.col("w_l4"), 16, 8),
        "Proto": bitfield(F.col("w_l4"), 8, 8),
        "IPTos": bitfield(F.col("w_l4"), 0, 8),
        "SrcAS": bitfield(F.col("w_as"), 32, 16),
        "DstAS": bitfield(F.col("w_as"), 16, 16),
        "SrcNet": bitfield(F.col("w_as"), 8, 8),
        "DstNet": bitfield(F.col("w_as"), 0, 8),
    }, PROVENANCE)
