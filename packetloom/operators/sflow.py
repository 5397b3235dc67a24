"""sFlow v5 framing: packet headers, samples, records and counter tables.

All narrow. A sample keeps its records as an array, so folding them into one flow needs no grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from packetloom.functions.binary import span
from packetloom.operators.netflow_sets import sql_empty, sql_let, sql_uint
from packetloom.plans.tables import unnest
from packetloom.sources.packets import received_second, router_key

# Limits of a 65,535-byte datagram.
MAX_FLOW_RECORDS, MAX_COUNTER_RECORDS, MAX_PATH, MAX_COMMUNITIES = 8191, 511, 16383, 16383

FLOW_SAMPLE, COUNTER_SAMPLE, EXPANDED_FLOW_SAMPLE, EXPANDED_COUNTER_SAMPLE = 1, 2, 3, 4
SAMPLE_NAMES = {1: "FlowSample", 2: "CounterSample", 3: "ExpandedFlowSample", 4: "ExpandedCounterSample"}
RAW, IPV4, IPV6, SWITCH, ROUTER, GATEWAY = 1, 3, 4, 1001, 1002, 1003

# Counter layouts as (name, bytes).
IF_COUNTERS = [
    ("IfIndex", 4), ("IfType", 4), ("IfSpeed", 8), ("IfDirection", 4), ("IfStatus", 4), ("IfInOctets", 8),
    ("IfInUcastPkts", 4), ("IfInMulticastPkts", 4), ("IfInBroadcastPkts", 4), ("IfInDiscards", 4),
    ("IfInErrors", 4), ("IfInUnknownProtos", 4), ("IfOutOctets", 8), ("IfOutUcastPkts", 4),
    ("IfOutMulticastPkts", 4), ("IfOutBroadcastPkts", 4), ("IfOutDiscards", 4), ("IfOutErrors", 4),
    ("IfPromiscuousMode", 4)]
ETHERNET_COUNTERS = [
    ("Dot3StatsAlignmentErrors", 4), ("Dot3StatsFCSErrors", 4), ("Dot3StatsSingleCollisionFrames", 4),
    ("Dot3StatsMultipleCollisionFrames", 4), ("Dot3StatsSQETestErrors", 4), ("Dot3StatsDeferredTransmissions", 4),
    ("Dot3StatsLateCollisions", 4), ("Dot3StatsExcessiveCollisions", 4), ("Dot3StatsInternalMacTransmitErrors", 4),
    ("Dot3StatsCarrierSenseErrors", 4), ("Dot3StatsFrameTooLongs", 4), ("Dot3StatsInternalMacReceiveErrors", 4),
    ("Dot3StatsSymbolErrors", 4)]

_ITEM = "struct<idx:int,fmt:bigint,pos:int,len:int>"


UNROLLED = 4


def _walk_rest(start: str, end: str, count: str) -> str:
    """SQL: ``{format u32, length u32, body}`` items from a position on, behind the unrolled ones."""
    take = f"""IF(h.len > {end} - acc.pos - 8,
        named_struct('pos', acc.pos, 'going', false, 'items', acc.items),
        named_struct('pos', acc.pos + 8 + cast(h.len as int), 'going', true, 'items', array_append(
            acc.items, named_struct('idx', {UNROLLED} + size(acc.items), 'fmt', h.fmt, 'pos', acc.pos + 8,
                                    'len', cast(h.len as int)))))"""
    head = f"named_struct('fmt', {sql_uint('acc.pos', 4)}, 'len', {sql_uint('acc.pos + 4', 4)})"
    most = f"cast(least({count} - {UNROLLED}, cast(greatest({end} - {start}, 0) div 8 as bigint)) as int)"
    return f"""aggregate(sequence(1, {most}),
        named_struct('pos', {start}, 'going', true, 'items', {sql_empty(_ITEM)}),
        (acc, i) -> CASE WHEN acc.going AND {end} - acc.pos >= 8 THEN {sql_let("h", head, take)} ELSE acc END,
        acc -> acc.items)"""


def walk_items(df: DataFrame, start: str, end: str, count: str, name: str) -> DataFrame:
    """Add ``name``: the items from ``start`` to ``end``, at most ``count`` of them.

    The walk stops where fewer than eight bytes are left or an item claims more than is left. The first items
    are read by plain columns, which run in generated code; a fold is entered only for packets with more.
    """
    at, word = f"{name}_p{{}}", f"{name}_w{{}}"
    df = df.selectExpr("*", f"CASE WHEN {count} > 0 AND {end} - ({start}) >= 8 THEN {start} END AS {at.format(0)}")
    for k in range(UNROLLED):
        p, w, after = at.format(k), word.format(k), at.format(k + 1)
        df = df.selectExpr("*", f"cast(conv(hex(substring(payload, {p} + 1, 8)), 16, -10) as bigint) AS {w}")
        # the next position; -1 once an item has claimed too much
        df = df.selectExpr("*", f"""CASE WHEN {p} IS NULL OR {p} < 0 THEN {p}
            WHEN ({w} & 4294967295L) > {end} - {p} - 8 THEN -1 ELSE {p} + 8 + cast({w} & 4294967295L as int) END
            AS {name}_n{k}""")
        df = df.selectExpr("*", f"""CASE WHEN {name}_n{k} < 0 THEN -1
            WHEN {count} > {k + 1} AND {end} - {name}_n{k} >= 8 THEN {name}_n{k} END AS {after}""")
    items = ", ".join(f"""named_struct('idx', {k}, 'fmt', shiftrightunsigned({word.format(k)}, 32), 'pos', {at.format(k)} + 8,
        'len', cast({word.format(k)} & 4294967295L as int))""" for k in range(UNROLLED))
    held = " + ".join(f"IF({at.format(k)} >= 0 AND {name}_n{k} >= 0, 1, 0)" for k in range(UNROLLED))
    last = at.format(UNROLLED)
    df = df.selectExpr("*", f"""IF({at.format(0)} IS NULL, {sql_empty(_ITEM)}, slice(array({items}), 1, {held})) AS {name}_few""")
    df = df.selectExpr("*", f"""IF({last} >= 0, concat({name}_few, {_walk_rest(last, end, count)}), {name}_few) AS {name}""")
    helpers = [f"{name}_few", *[f"{name}_n{k}" for k in range(UNROLLED)], *[word.format(k) for k in range(UNROLLED)],
               *[at.format(k) for k in range(UNROLLED + 1)]]
    return df.drop(*helpers)


def read_headers(packets: DataFrame) -> DataFrame:
    """Header columns, ``error`` (the packet is rejected) and ``samples``, the framed samples."""
    n = "octet_length(payload)"
    head = packets.select("*", router_key().alias("router"), received_second().alias("received")).selectExpr(
        "*", f"{sql_uint('0', 4)} AS version", f"{sql_uint('4', 4)} AS ip_version")
    head = head.selectExpr("*", "IF(ip_version = 2, 24, 12) AS base", f"""CASE
        WHEN {n} < 4 THEN 'error_decoding' WHEN version <> 5 THEN 'error_version'
        WHEN {n} < 8 THEN 'error_decoding' WHEN ip_version NOT IN (1, 2) THEN 'error_ip_version'
        WHEN {n} < IF(ip_version = 2, 40, 28) THEN 'error_decoding' END AS error""")
    head = head.selectExpr(
        "*", "substring(payload, 9, base - 8) AS agent", f"{sql_uint('base', 4)} AS sub_agent",
        f"{sql_uint('base + 4', 4)} AS sequence", f"{sql_uint('base + 8', 4)} AS uptime",
        f"IF(error IS NULL, {sql_uint('base + 12', 4)}, 0L) AS sample_count")
    return walk_items(head, "base + 16", n, "sample_count", "samples").drop("base", "ip_version")


PACKET_COLUMNS = ["packet_id", "router", "received", "agent", "sequence", "payload"]


def read_samples(headers: DataFrame) -> DataFrame:
    """One row per framed sample, with its header fields, its records and whether it could be decoded."""
    rows = unnest(headers, PACKET_COLUMNS, F.col("samples"), "s").selectExpr(
        *PACKET_COLUMNS, "s.idx AS sample_idx", "s.fmt AS format", "s.pos AS pos", "s.len AS len",
        "s.pos + s.len AS sample_end", "s.pos + IF(s.fmt IN (1, 2), 8, 12) AS at",
        "s.len - IF(s.fmt IN (1, 2), 8, 12) AS left")
    rows = rows.selectExpr(
        *PACKET_COLUMNS, "sample_idx", "format", "sample_end", "at", "left",
        f"{sql_uint('pos', 4)} AS sample_sequence", f"{sql_uint('pos + 4', 4)} AS source",
        f"IF(format IN (3, 4), {sql_uint('pos + 8', 4)}, 0L) AS source_value",
        "CASE WHEN format = 1 THEN 24 WHEN format = 3 THEN 32 ELSE 4 END AS fixed")
    is_flow = "format IN (1, 3)"
    rows = rows.selectExpr(
        *PACKET_COLUMNS, "sample_idx", "format", "sample_end", "sample_sequence", "at + fixed AS records_at",
        "IF(format IN (1, 2), shiftright(source, 24), source) AS source_type",
        "IF(format IN (1, 2), source & 16777215L, source_value) AS source_id",
        "format IN (1, 2, 3, 4) AND left >= fixed AS whole",
        f"IF({is_flow}, {sql_uint('at', 4)}, 0L) AS sampling_rate",
        f"IF({is_flow}, {sql_uint('at + 4', 4)}, 0L) AS sample_pool",
        f"IF({is_flow}, {sql_uint('at + 8', 4)}, 0L) AS drops",
        f"CASE format WHEN 1 THEN {sql_uint('at + 12', 4)} WHEN 3 THEN {sql_uint('at + 16', 4)} ELSE 0L END AS input",
        f"CASE format WHEN 1 THEN {sql_uint('at + 16', 4)} WHEN 3 THEN {sql_uint('at + 24', 4)} ELSE 0L END AS output",
        f"IF(format = 3, {sql_uint('at + 12', 4)}, 0L) AS input_format",
        f"IF(format = 3, {sql_uint('at + 20', 4)}, 0L) AS output_format",
        f"{sql_uint('at + fixed - 4', 4)} AS record_count")
    rows = rows.withColumn("decoded", F.expr(f"""whole AND NOT (format = 1 AND record_count > {MAX_FLOW_RECORDS})
        AND NOT (format IN (2, 4) AND record_count > {MAX_COUNTER_RECORDS})""")).drop("whole")
    rows = rows.withColumn("walkable", F.expr("IF(decoded, record_count, 0L)"))
    return walk_items(rows, "records_at", "sample_end", "walkable", "records").drop(
        "records_at", "sample_end", "walkable")


def flow_samples(samples: DataFrame) -> DataFrame:
    """Decoded flow samples; counters never become flows."""
    return samples.where(F.col("decoded") & F.col("format").isin(FLOW_SAMPLE, EXPANDED_FLOW_SAMPLE))


def counter_samples(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("decoded") & F.col("format").isin(COUNTER_SAMPLE, EXPANDED_COUNTER_SAMPLE))


def read_gateway(df: DataFrame, pos: str, length: str, g: str) -> DataFrame:
    """Add the guarded positions of an extended-gateway record at ``pos`` as columns with prefix ``g``.

    Path and community counts are checked against the bytes left less four, then against their own bytes.
    Only the first path segment is read. ``{g}ok`` is false, or null, where the record is cut or absent.
    """
    df = df.selectExpr("*", f"CASE {sql_uint(pos, 4)} WHEN 1 THEN 8 WHEN 2 THEN 20 END AS {g}a")
    df = df.selectExpr("*", f"{length} >= {g}a + 16 AS {g}whole", f"{sql_uint(f'{pos} + {g}a + 12', 4)} <> 0 AS {g}path")
    df = df.selectExpr("*", f"IF({g}path, {sql_uint(f'{pos} + {g}a + 20', 4)}, 0L) AS {g}n")
    df = df.selectExpr(
        "*", f"cast(IF({g}path, {g}a + 24 + 4 * least({g}n, {MAX_PATH}L), {g}a + 16L) as int) AS {g}c",
        f"""{g}whole AND (NOT {g}path OR ({length} >= {g}a + 24 AND {g}n <= {length} - {g}a - 28 AND {g}n <= {MAX_PATH}
            AND 4 * {g}n <= {length} - {g}a - 24)) AS {g}path_ok""")
    df = df.selectExpr("*", f"{sql_uint(f'{pos} + {g}c', 4)} AS {g}m")
    return df.selectExpr("*", f"""{g}path_ok AND {length} >= {g}c + 4 AND {g}m <= {length} - {g}c - 8
        AND {g}m <= {MAX_COMMUNITIES} AND 4 * {g}m + 4 <= {length} - {g}c - 4 AS {g}ok""")


def sql_gateway_ok(pos: str, length: str) -> str:
    """SQL: the ``ok`` of ``read_gateway`` as one expression, for use inside a lambda."""
    communities = sql_let("m", sql_uint(f"{pos} + c", 4), f"""{length} >= c + 4 AND m <= {length} - c - 8
        AND m <= {MAX_COMMUNITIES} AND 4 * m + 4 <= {length} - c - 4""")
    path = f"""{length} >= a + 16 AND (n < 0 OR ({length} >= a + 24 AND n <= {length} - a - 28 AND n <= {MAX_PATH}
        AND 4 * n <= {length} - a - 24))"""
    after = f"cast(IF(n < 0, a + 16L, a + 24 + 4 * least(n, {MAX_PATH}L)) as int)"
    count = f"IF({sql_uint(f'{pos} + a + 12', 4)} <> 0, {sql_uint(f'{pos} + a + 20', 4)}, -1L)"
    return sql_let("a", f"CASE {sql_uint(pos, 4)} WHEN 1 THEN 8 WHEN 2 THEN 20 END", sql_let(
        "n", count, f"({path}) AND {sql_let('c', after, communities)}"))


def _u32_list(pos: str, count: str) -> str:
    return (f"IF({count} > 0, transform(sequence(0, cast({count} as int) - 1), i -> {sql_uint(f'{pos} + 4 * i', 4)}), "
            "cast(array() as array<bigint>))")


def sql_address(pos: str) -> str:
    """SQL: address behind its 4-byte version word."""
    return f"substring(payload, {pos} + 5, IF({sql_uint(pos, 4)} = 2, 16, 4))"


def flow_records(samples: DataFrame) -> DataFrame:
    """One row per record of a flow sample, one nullable struct column per record kind.

    Records that cannot be decoded (cut short, unknown format) have every struct null.
    """
    keys = ["packet_id", "router", "agent", "sequence", "sample_idx", "format", "sampling_rate"]
    rows = unnest(flow_samples(samples), [*keys, "payload"], F.col("records"), "r").selectExpr(
        *keys, "payload", "r.idx AS record_idx", "r.fmt AS record_format", "r.len AS record_length", "r.pos AS p",
        f"CASE WHEN r.fmt = {GATEWAY} THEN r.pos END AS gp")
    rows = read_gateway(rows, "gp", "record_length", "g_")
    fmt, n = "record_format", "record_length"

    def u(offset):
        return sql_uint(f"p + {offset}", 4)

    def ip(width, last):
        after = 8 + 2 * width
        return f"""named_struct('length', {u(0)}, 'protocol', {u(4)}, 'src', substring(payload, p + 9, {width}),
            'dst', substring(payload, p + {9 + width}, {width}), 'src_port', {u(after)}, 'dst_port', {u(after + 4)},
            'tcp_flags', {u(after + 8)}, '{last}', {u(after + 12)})"""

    nh = f"IF({u(0)} = 2, 20, 8)"
    return rows.selectExpr(
        *keys, "record_idx", fmt, n,
        f"""IF({fmt} = {RAW} AND {n} >= 16, named_struct('protocol', {u(0)}, 'frame_length', {u(4)},
            'stripped', {u(8)}, 'original_length', {u(12)}, 'header', substring(payload, p + 17, {n} - 16)),
            null) AS raw""",
        f"IF({fmt} = {IPV4} AND {n} >= 32, {ip(4, 'tos')}, null) AS ipv4",
        f"IF({fmt} = {IPV6} AND {n} >= 56, {ip(16, 'priority')}, null) AS ipv6",
        f"""IF({fmt} = {SWITCH} AND {n} >= 16, named_struct('src_vlan', {u(0)}, 'src_priority', {u(4)},
            'dst_vlan', {u(8)}, 'dst_priority', {u(12)}), null) AS switch""",
        f"""IF({fmt} = {ROUTER} AND {u(0)} IN (1, 2) AND {n} >= {nh} + 8, named_struct(
            'next_hop', {sql_address('p')}, 'src_mask_len', {u(nh)}, 'dst_mask_len', {u(nh + ' + 4')}), null) AS router_ext""",
        f"""IF(g_ok, named_struct('next_hop', {sql_address('p')}, 'as', {sql_uint('p + g_a', 4)},
            'src_as', {sql_uint('p + g_a + 4', 4)}, 'src_peer_as', {sql_uint('p + g_a + 8', 4)},
            'as_path', {_u32_list('p + g_a + 24', 'g_n')}, 'communities', {_u32_list('p + g_c + 4', 'g_m')},
            'local_pref', {sql_uint('p + g_c + 4 + 4 * cast(g_m as int)', 4)}), null) AS gateway""")


def _counters(samples: DataFrame, fmt: int, layout: list[tuple[str, int]]) -> DataFrame:
    keys = ["packet_id", "router", "agent", "sequence", "received", "sample_idx", "sample_sequence", "source_type",
            "source_id"]
    rows = unnest(counter_samples(samples), [*keys, "payload"], F.col("records"), "r").where(f"r.fmt = {fmt}")
    size = sum(n for _, n in layout)
    # a record cut short is reported with all counters zero
    rows = rows.select(*keys, F.col("r.idx").alias("record_idx"), F.when(
        F.col("r.len") >= size, span(F.col("payload"), F.col("r.pos"), size)).otherwise(F.lit(bytes(size))).alias("rec"))
    columns, at = [], 0
    for name, n in layout:
        base = -10 if n == 8 else 10
        columns.append(f"cast(conv(hex(substring(rec, {at + 1}, {n})), 16, {base}) as bigint) AS {name}")
        at += n
    return rows.selectExpr(*keys, "record_idx", *columns)


def interface_counters(samples: DataFrame) -> DataFrame:
    """Generic interface counters, 19 columns; 64-bit ones keep their bit pattern (see ``unsigned``)."""
    return _counters(samples, 1, IF_COUNTERS)


def ethernet_counters(samples: DataFrame) -> DataFrame:
    return _counters(samples, 2, ETHERNET_COUNTERS)
