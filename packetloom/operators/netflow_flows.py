"""NetFlow v9 / IPFIX data records to flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from packetloom.functions.binary import span, udiv, uptime_to_epoch
from packetloom.operators.layout import ADDRESS_SLOTS, ICMP_SLOTS, NUMBER_SLOTS, SLOT_INDEX
from packetloom.operators.netflow_sets import frame
from packetloom.operators.netflow_state import (Timeline, announcing, attach_sampling, record_count, resolve_sets,
                                                sampling_timeline, telling_packets, template_timeline,
                                                unlearnt_announcements)
from packetloom.plans.tables import unnest
from packetloom.schema import IPFIX, NETFLOW_V9, PROVENANCE, to_flow_columns

PACKET_COLUMNS = ["packet_id", "router", "version", "domain", "t", "received", "sampler", "uptime", "base_time",
                  "sequence"]


def explode_records(resolved: DataFrame, kind: str | None, keep: list[str]) -> DataFrame:
    """One row per record of the accepted packets' sets of a kind, or of all: ``rec`` holds the record's bytes."""
    wanted = F.filter("rsets", lambda s: (F.lit(True) if kind is None else s["layout"]["kind"] == kind) & (record_count(s) > 0))
    sets = unnest(resolved, [*keep, "payload"], F.when(F.col("error").isNull(), wanted), "s")
    rows = sets.select("*", F.explode(F.sequence(F.lit(0), record_count(F.col("s")) - 1)).alias("rec_idx"))
    size = F.col("s.layout.size")
    return rows.select(*keep, F.col("s.idx").alias("set_idx"), F.col("s.id").alias("template_id"), "rec_idx",
                       F.col("s.layout").alias("layout"), *_optional_fields(rows),
                       span(F.col("payload"), F.col("s.pos") + F.col("rec_idx") * size, size).alias("rec"))


def _optional_fields(rows: DataFrame) -> list[Column]:
    names = rows.schema["s"].dataType.fieldNames()
    return [F.col(f"s.{c}").alias(c) for c in ("scopes", "fields") if c in names]


def project_flows(records: DataFrame) -> DataFrame:
    """Records with their layout to flows."""
    def raw(name):
        packed = f"get(layout.slots, {SLOT_INDEX[name]})"
        return f"substring(rec, cast(shiftright({packed}, 16) as int) + 1, cast({packed} & 65535 as int))"

    def number(name, base=10):
        return f"cast(conv(hex({raw(name)}), 16, {base}) as bigint)"

    values = {}
    for name, (_, width) in NUMBER_SLOTS.items():
        values[name] = F.expr(number(name, -10 if width == 8 else 10))
    for name in ICMP_SLOTS:
        values[name] = F.expr(number(name))
    for name in ADDRESS_SLOTS:
        values[name] = F.expr(raw(name))
    v9 = F.col("version") == 9
    for name, unit in (("TimeFlowStart", "layout.start_unit"), ("TimeFlowEnd", "layout.end_unit")):
        ticks = F.expr(f"coalesce({number(name, -10)}, 0L)")
        from_uptime = uptime_to_epoch(F.col("base_time"), F.col("uptime"), ticks)
        values[name] = F.when(F.expr(f"get(layout.slots, {SLOT_INDEX[name]})").isNotNull(), F.when(
            v9, from_uptime).otherwise(udiv(ticks, F.col(unit))))
    values["FragmentOffset"] = F.expr("""CASE WHEN size(layout.fragments) > 0 THEN aggregate(
        layout.fragments, 0L, (acc, p) -> acc | coalesce(cast(conv(hex(substring(
            rec, cast(shiftright(p, 16) as int) + 1, cast(p & 65535 as int))), 16, 10) as bigint), 0L)) END""")
    values["Etype"] = F.col("layout.etype")
    values["Type"] = F.when(v9, NETFLOW_V9).otherwise(IPFIX)
    values["TimeReceived"] = F.col("received")
    values["SequenceNum"] = F.col("sequence")
    values["SamplerAddress"] = F.col("sampler")
    values["SamplingRate"] = F.col("sampling_rate")
    return to_flow_columns(records.withColumn("is_padding", F.lit(False)), values, PROVENANCE)


def templates_in(framed: DataFrame, templates: DataFrame | None = None, with_fields: bool = False) -> Timeline:
    """The template timeline that framed packets build; a template behind a set without one is never learnt."""
    control = announcing(framed)
    timeline = template_timeline(control, templates, with_fields, unlearnt_announcements(control))
    control.unpersist()
    return timeline


def resolve(packets: DataFrame, templates: DataFrame | None = None, with_fields: bool = False) -> DataFrame:
    """Frame packets and look their sets up in the template timeline the packets themselves build.

    A set without a template ends its packet.
    """
    framed = frame(packets)
    return resolve_sets(framed, templates_in(framed, templates, with_fields), with_fields)


def resolve_rated(packets: DataFrame, templates: DataFrame | None = None, sampling: DataFrame | None = None,
                  sampling_rate: int | None = None) -> DataFrame:
    """``resolve`` with ``sampling_rate``: a constant, or what the exporter told last. Rates are looked for only in
    packets that can tell one."""
    framed = frame(packets)
    timeline = templates_in(framed, templates)
    resolved = resolve_sets(framed, timeline)
    if sampling_rate is not None:
        return resolved.withColumn("sampling_rate", F.lit(sampling_rate).cast("bigint"))
    telling = resolve_sets(telling_packets(framed, timeline), timeline)
    return attach_sampling(resolved, sampling_timeline(telling, sampling))


def with_sampling(resolved: DataFrame, sampling: DataFrame | None = None,
                  sampling_rate: int | None = None) -> DataFrame:
    """``sampling_rate`` for packets already resolved."""
    if sampling_rate is not None:
        return resolved.withColumn("sampling_rate", F.lit(sampling_rate).cast("bigint"))
    return attach_sampling(resolved, sampling_timeline(resolved, sampling))


def flows_from_netflow(packets: DataFrame, templates: DataFrame | None = None, sampling: DataFrame | None = None,
                       sampling_rate: int | None = None) -> DataFrame:
    """NetFlow v9 and IPFIX packets to flows.

    ``templates`` and ``sampling`` add templates and rates known beforehand; ``sampling_rate`` replaces rate
    lookup by a constant.
    """
    rated = resolve_rated(packets, templates, sampling, sampling_rate)
    return project_flows(explode_records(rated, "data", [*PACKET_COLUMNS, "sampling_rate"]))
