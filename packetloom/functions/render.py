"""Flows as text: field selection, text and JSON lines, partition keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from packetloom.functions.binary import unsigned
from packetloom.functions.text import byte_list_text, flow_type_name, ip_text, mac_text
from packetloom.schema import FLOW_COLUMNS, FLOW_KIND

DEFAULT_FIELDS = [name for name in FLOW_COLUMNS if name != "FlowDirection"]


def unsigned_text(bits: Column) -> Column:
    return F.when(bits >= 0, bits.cast("string")).otherwise(unsigned(bits).cast("string"))


def field_text(name: str) -> Column:
    value, kind = F.col(name), FLOW_KIND[name]
    if kind == "e":
        return flow_type_name(value)
    if kind == "a":
        return ip_text(value)
    if name in ("SrcMac", "DstMac"):
        return mac_text(value)
    return unsigned_text(value) if kind == "q" else value.cast("string")


def known_fields(fields: str | list[str] | None) -> list[str]:
    """Ordered field list; unknown names are dropped, repeats kept. ``FlowDirection`` only when named."""
    if fields is None:
        return DEFAULT_FIELDS
    names = fields.split(",") if isinstance(fields, str) else fields
    return [n for n in names if n in FLOW_KIND]


def select_fields(flows: DataFrame, fields: str | list[str] | None = None) -> DataFrame:
    """The chosen fields, all as text."""
    return flows.select(*[field_text(n).alias(n) for n in known_fields(fields)])


def text_line(fields: str | list[str] | None = None) -> Column:
    return F.concat_ws(" ", *[F.concat(F.lit(n + ":"), field_text(n)) for n in known_fields(fields)])


def json_line(fields: str | list[str] | None = None) -> Column:
    """One JSON object, every value a string, in the order of the field list (repeats included)."""
    items = [F.concat(F.lit(f'"{n}":"'), field_text(n), F.lit('"')) for n in known_fields(fields)]
    return F.concat(F.lit("{"), F.concat_ws(",", *items), F.lit("}"))


def partition_key(fields: list[str]) -> Column:
    """Values of the named fields, each followed by ``-``; bytes as ``[10 0 0 1]``, unknown names skipped."""
    parts = []
    for name in fields:
        kind = FLOW_KIND.get(name)
        if kind is None:
            continue
        value = F.col(name)
        text = (byte_list_text(value) if kind == "a" else flow_type_name(value) if kind == "e"
                else unsigned_text(value) if kind == "q" else value.cast("string"))
        parts.append(F.concat(text, F.lit("-")))
    return F.concat(*parts) if parts else F.lit("")
