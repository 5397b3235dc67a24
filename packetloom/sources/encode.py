"""Jobs that write export packets from rows, for round-trip tests and benchmarks.

Rows carry their record as hex digits; records of one packet are sorted and laid end to end. A group key
should bound its group (exporter, month, block of order keys), since a group is gathered before it is
cut into packets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from packetloom.functions.binary import be_hex


def v4(number: Column) -> Column:
    """4-byte address from its number."""
    return F.unhex(be_hex(number, 4))


def gather_records(rows: DataFrame, keys: list[str], order: list[str], record: str, per_packet: int) -> DataFrame:
    """One row per packet: ``keys``, ``slice_no``, ``records`` (array of hex strings, at most ``per_packet``)."""
    entry = F.struct(*order, F.col(record).alias("hex"))
    groups = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    cut = groups.withColumn("slice_no", F.explode(F.sequence(
        F.lit(0), F.floor((F.size("entries") - 1) / per_packet).cast("int"))))
    part = F.slice("entries", F.col("slice_no") * per_packet + 1, F.lit(per_packet))
    return cut.select(*keys, "slice_no", F.transform(part, lambda e: e["hex"]).alias("records"))


def set_hex(set_id, body: Column) -> Column:
    """A v9 / IPFIX set: id, length including its header, body."""
    return F.concat(be_hex(set_id, 2), be_hex(F.length(body) / 2 + 4, 2), body)


def tlv_hex(tag, body: Column) -> Column:
    """An sFlow sample or record: 4-byte format, 4-byte body length, body."""
    return F.concat(be_hex(tag, 4), be_hex(F.length(body) / 2, 4), body)


def fields_hex(fields: list[tuple[int, int]]) -> Column:
    """Template fields as (type, length) pairs."""
    return F.lit("".join(f"{t:04x}{n:04x}" for t, n in fields))
