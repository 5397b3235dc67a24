"""Registered queries over the driver's tables, each with the SQL that says what it must return.

A query encodes table rows as export packets, decodes them with the engine and reports flow columns; its SQL
reads the same rows directly. Addresses are reported as text, times as epoch seconds, sums as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from packetloom.functions import render
from packetloom.functions.names import IPFIX_FLOW_ELEMENTS, with_field_name
from packetloom.functions.text import flow_type_name, ip_text, mac_text
from packetloom.operators import analytics, describe, health, netflow5, sflow
from packetloom.operators.netflow_flows import flows_from_netflow, resolve, with_sampling
from packetloom.operators.netflow_sets import data_sets, frame, options_template_sets, template_sets
from packetloom.operators.netflow_state import sampling_changes
from packetloom.operators.sflow_flows import flows_from_sflow
from packetloom.plans import roundtrip as rt
from packetloom.plans.tables import fresh_folder, where_once
from packetloom.plans.union import ERRORS, errors_of, flows_of, with_live_counts
from packetloom.schema import FLOW_KIND
from packetloom.sources.packets import read_packets
from packetloom.sources.sinks import (distribute, flows_to_json, flows_to_messages, flows_to_text, read_json_lines, register_flows,
                                      write_lines, write_messages)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# --- shared SQL -------------------------------------------------------------------------------------------------

LI = """WITH li AS (
  SELECT l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, CAST(l_linenumber AS BIGINT) AS ln,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS octets, CAST(l_quantity AS BIGINT) AS pkts,
         CASE l_returnflag WHEN 'A' THEN 6 WHEN 'N' THEN 17 ELSE 1 END AS proto,
         CASE l_linestatus WHEN 'O' THEN 2 ELSE 16 END AS tcp,
         CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS m,
         CAST(epoch(date_trunc('month', l_shipdate)) AS BIGINT) AS received
  FROM lineitem)
"""


def dotted(number: str) -> str:
    return (f"concat_ws('.', CAST(({number}) // 16777216 AS VARCHAR), CAST((({number}) // 65536) % 256 AS VARCHAR), "
            f"CAST((({number}) // 256) % 256 AS VARCHAR), CAST(({number}) % 256 AS VARCHAR))")


SRC, DST = dotted("167772160 + sk"), dotted("3232235520 + pk % 65536")
NEXT_HOP, EXPORTER = dotted("184483840 + ln"), dotted("167837696 + sk")
V6 = "'2001:db8::' || printf('%x:%x', ({n}) // 65536, ({n}) % 65536)"
SRC6, DST6 = V6.format(n="167772160 + sk"), V6.format(n="3232235520 + pk % 65536")
RATE = "CASE WHEN m >= TIMESTAMP '2000-01-01' THEN 2000 ELSE 1000 END"
SPORT, DPORT = "1024 + ok % 60000", "1000 + ln"
SRC_AS, DST_AS = "64512 + sk % 1000", "64512 + pk % 1000"

FLOW_SQL = {
    "TimeReceived": "received", "SamplerAddress": EXPORTER, "TimeFlowStart": "1700000000 - ok % 1000",
    "TimeFlowEnd": "1700000000 - ok % 100", "Bytes": "octets", "Packets": "pkts", "SrcAddr": SRC, "DstAddr": DST,
    "Etype": "2048", "Proto": "proto", "SrcPort": SPORT, "DstPort": DPORT, "InIf": "ln", "OutIf": "sk % 48",
    "TCPFlags": "tcp", "IPTos": "pk % 64", "SrcAS": SRC_AS, "DstAS": DST_AS, "SrcNet": "24", "DstNet": "ln",
    "NextHop": NEXT_HOP,
}


def big(sql: str) -> str:
    return f"CAST({sql} AS BIGINT)"


def select_sql(columns: dict[str, str], tail: str = "FROM li") -> str:
    items = ", ".join(f"{sql if FLOW_KIND.get(n) in ('a', 'b') else big(sql)} AS {n}" for n, sql in columns.items())
    return f"{LI} SELECT {items} {tail}"


def shown(flows: DataFrame, columns) -> DataFrame:
    """Flow columns for comparison: addresses as text, numbers as BIGINT."""
    def show(n):
        kind = FLOW_KIND[n]
        return ip_text(F.col(n)) if kind == "a" else F.col(n) if kind == "b" else F.col(n).cast("bigint")
    return flows.select(*[show(n).alias(n) for n in columns])


def register(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def v5_flows(spark, sf_dir, **kw):
    return netflow5.flows_from_netflow5(rt.v5_packets(spark, sf_dir, **kw))


def sf_samples(spark, sf_dir, records, sample=None):
    return sflow.read_samples(sflow.read_headers(rt.sflow_packets(spark, sf_dir, records, sample)))


# --- NetFlow v5 -------------------------------------------------------------------------------------------------

V5_SQL = FLOW_SQL | {"SamplingRate": "100"}


@register("v5_flows", select_sql(V5_SQL))
def _(spark, sf_dir):
    return shown(v5_flows(spark, sf_dir), V5_SQL)


WRAPPED = {"Bytes": "octets", "SrcAddr": SRC, "TimeFlowStart": "1700000000 - (5000 + 1000 * (1 + ok % 1000)) // 1000"}


@register("v5_time_wrap", select_sql(WRAPPED))
def _(spark, sf_dir):
    # uptime is five seconds, the first ticks lie before the counter wrapped
    return shown(v5_flows(spark, sf_dir, uptime=5000, first_age=F.lit(6) + F.col("ok") % 1000), WRAPPED)


@register("v5_bytes_by_as", f"""{LI} SELECT {big(SRC_AS)} AS SrcAS, CAST(sum(octets * 100) AS BIGINT) AS bytes,
    CAST(sum(pkts * 100) AS BIGINT) AS packets, count(*) AS flows FROM li GROUP BY 1""")
def v5_bytes_by_as(spark, sf_dir):
    rows = analytics.with_scaled_volume(v5_flows(spark, sf_dir))
    return rows.groupBy("SrcAS").agg(F.sum("ScaledBytes").cast("bigint").alias("bytes"),
                                     F.sum("ScaledPackets").cast("bigint").alias("packets"), F.count("*").alias("flows"))


# --- NetFlow v9 and IPFIX ---------------------------------------------------------------------------------------

NF_SQL = FLOW_SQL | {"SamplingRate": RATE, "SrcVlan": "sk % 4096", "VlanId": "sk % 4096", "SrcMac": "ok"}


@register("v9_flows", select_sql(NF_SQL | {"Type": "3"}))
def _(spark, sf_dir):
    return shown(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9)), NF_SQL | {"Type": ""})


@register("ipfix_flows", select_sql(NF_SQL | {"Type": "4"}))
def _(spark, sf_dir):
    return shown(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 10)), NF_SQL | {"Type": ""})


@register("v9_template_change", f"""{LI} SELECT m >= TIMESTAMP '2000-01-01' AS wide, {EXPORTER} AS router,
    count(*) AS flows, CAST(sum(octets) AS BIGINT) AS bytes FROM li GROUP BY 1, 2""")
def _(spark, sf_dir):
    flows = flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9), sampling_rate=1)
    return flows.groupBy((F.col("TimeReceived") >= 946684800).alias("wide"), ip_text(F.col("SamplerAddress")).alias("router")
                         ).agg(F.count("*").alias("flows"), F.sum("Bytes").cast("bigint").alias("bytes"))


MISSING_SQL = {"Bytes": "octets", "SrcAddr": SRC, "SamplerAddress": EXPORTER, "SamplingRate": RATE}


@register("v9_missing_template", select_sql(MISSING_SQL, "FROM li WHERE sk % 5 <> 0"))
def _(spark, sf_dir):
    return shown(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9, missing=True)), MISSING_SQL)


TIME_UNITS = {150: (4, 1), 152: (8, 1000), 154: (8, 1_000_000), 156: (8, 1_000_000_000)}


@register("v9_template_behind_missing", f"""{LI} SELECT {EXPORTER} AS router, CAST(sum(octets) AS BIGINT) AS bytes,
    count(*) AS flows FROM li WHERE sk % 5 <> 0 GROUP BY 1""")
def _(spark, sf_dir):
    # their templates stand behind a set without one, so a fifth of the exporters never has any
    flows = flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9, hidden=True), sampling_rate=1)
    return flows.groupBy(ip_text(F.col("SamplerAddress")).alias("router")).agg(
        F.sum("Bytes").cast("bigint").alias("bytes"), F.count("*").alias("flows"))


@register("v9_null_times", f"""{LI} SELECT {EXPORTER} AS router, CAST(sum(octets) AS BIGINT) AS bytes, count(*) AS flows
    FROM li GROUP BY 1""")
def _(spark, sf_dir):
    # without receive times the packet number alone says that templates come first
    sent = rt.netflow_packets(spark, sf_dir, 9, fields=rt.flow_fields(9, False)).withColumn(
        "recv_time", F.lit(None).cast("timestamp")).repartition(5, F.xxhash64("packet_id"))
    return flows_from_netflow(sent, sampling_rate=1).groupBy(ip_text(F.col("SamplerAddress")).alias("router")).agg(
        F.sum("Bytes").cast("bigint").alias("bytes"), F.count("*").alias("flows"))


@register("v9_constant_rate", f"""{LI} SELECT {EXPORTER} AS router, CAST(7 AS BIGINT) AS rate, count(*) AS flows FROM li GROUP BY 1""")
def _(spark, sf_dir):
    flows = flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9), sampling_rate=7)
    return flows.groupBy(ip_text(F.col("SamplerAddress")).alias("router"), F.col("SamplingRate").alias("rate")).agg(
        F.count("*").alias("flows"))


@register("ipfix_times", "\nUNION ALL\n".join(f"""SELECT {start} AS unit_field, CAST(l_orderkey AS BIGINT) AS src_mac,
    CAST(1700000000 - l_orderkey % 1000 AS BIGINT) AS time_start, CAST(1700000000 - l_orderkey % 100 AS BIGINT) AS time_end
    FROM lineitem""" for start in TIME_UNITS))
def _(spark, sf_dir):
    ok, parts = F.col("ok"), []
    for start, (size, unit) in TIME_UNITS.items():
        extra = unit - 1  # parts of a second are cut off
        fields = [(56, 6, ok), (start, size, (rt.BASE - ok % 1000) * unit + extra),
                  (start + 1, size, (rt.BASE - ok % 100) * unit + extra)]
        flows = flows_from_netflow(rt.netflow_packets(spark, sf_dir, 10, fields), sampling_rate=1)
        parts.append(flows.select(F.lit(start).alias("unit_field"), F.col("SrcMac").alias("src_mac"),
                                  F.col("TimeFlowStart").alias("time_start"), F.col("TimeFlowEnd").alias("time_end")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@register("nf_icmp_split", select_sql({"SrcMac": "ok", "IcmpType": "ln", "IcmpCode": "sk % 16"}))
def _(spark, sf_dir):
    fields = [(56, 6, F.col("ok")), (32, 2, F.col("ln") * 256 + F.col("sk") % 16)]
    return shown(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9, fields), sampling_rate=1),
                 ["SrcMac", "IcmpType", "IcmpCode"])


@register("nf_fragment_or", select_sql({"SrcMac": "ok", "FragmentOffset": "(pk % 256) | (ln * 256)"}))
def _(spark, sf_dir):
    fields = [(56, 6, F.col("ok")), (88, 2, F.col("pk") % 256), (197, 2, F.col("ln") * 256)]
    return shown(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 10, fields), sampling_rate=1),
                 ["SrcMac", "FragmentOffset"])


@register("nf_sampling_asof", f"""SELECT {dotted('167837696 + s_suppkey')} AS router, 9 AS version, v.since AS since,
    CAST(v.rate AS BIGINT) AS rate FROM supplier CROSS JOIN (VALUES (CAST(631152000 AS BIGINT), 1000),
    (CAST(946684800 AS BIGINT), 2000)) AS v(since, rate)""")
def _(spark, sf_dir):
    changed = sampling_changes(resolve(rt.netflow_packets(spark, sf_dir, 9)))
    return changed.select("router", "version", F.floor(F.col("t") / 1_000_000).cast("bigint").alias("since"), "rate")


@register("nf_options_data", f"""SELECT {dotted('167837696 + s_suppkey')} AS router, v.packet AS packet,
    CAST(1 AS BIGINT) AS scope_value, CAST(v.rate AS BIGINT) AS interval FROM supplier
    CROSS JOIN (VALUES (0, 1000), (1, 2000)) AS v(packet, rate)""")
def _(spark, sf_dir):
    resolved = resolve(rt.netflow_packets(spark, sf_dir, 10), with_fields=True)
    rows = describe.record_values(resolved, "options")

    def number(raw):
        return F.conv(F.hex(raw), 16, 10).cast("bigint")
    rate = number(describe.first_value("values", rt.SAMPLING_INTERVAL_FIELD))
    return rows.select("router", (rate == rt.SECOND_RATE).cast("int").alias("packet"),
                       number(describe.first_value("scopes", 1)).alias("scope_value"), rate.alias("interval"))


TEMPLATE_LIST = f"""SELECT {dotted('167837696 + s_suppkey')} AS router, 9 AS version, CAST(7 AS BIGINT) AS domain,
    v.template_id AS template_id, v.kind AS kind, v.field_count AS field_count, CAST(v.size AS BIGINT) AS size
    FROM supplier CROSS JOIN (VALUES (300, 'data', 20, 71), (400, 'options', 2, 8)) AS v(template_id, kind, field_count, size)"""


@register("template_listing", TEMPLATE_LIST)
def _(spark, sf_dir):
    listing = describe.template_listing(frame(rt.netflow_packets(spark, sf_dir, 9)))
    return listing.select("router", "version", "domain", "template_id", "kind", "field_count", "size")


NAMES_SQL = ", ".join(f"({i}, '{n}')" for i, n in [
    (8, "IPV4_SRC_ADDR"), (12, "IPV4_DST_ADDR"), (1, "IN_BYTES"), (2, "IN_PKTS"), (7, "L4_SRC_PORT"),
    (11, "L4_DST_PORT"), (4, "PROTOCOL"), (6, "TCP_FLAGS"), (5, "SRC_TOS"), (10, "INPUT_SNMP"), (14, "OUTPUT_SNMP"),
    (16, "SRC_AS"), (17, "DST_AS"), (9, "SRC_MASK"), (13, "DST_MASK"), (15, "IPV4_NEXT_HOP"), (58, "SRC_VLAN"),
    (56, "IN_SRC_MAC"), (22, "FIRST_SWITCHED"), (21, "LAST_SWITCHED")])


@register("packet_describe", f"""SELECT 'field' AS part, f.id AS field_id, f.name AS field_name, count(*) AS n
    FROM lineitem CROSS JOIN (VALUES {NAMES_SQL}) AS f(id, name) GROUP BY 1, 2, 3
    UNION ALL SELECT v.part, v.id, v.name, count(*) * 2 FROM supplier
    CROSS JOIN (VALUES ('scope', 1, 'System'), ('field', 34, 'SAMPLING_INTERVAL')) AS v(part, id, name) GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    long = describe.describe_packets(resolve(rt.netflow_packets(spark, sf_dir, 9), with_fields=True))
    return long.groupBy("part", "field_id", "field_name").agg(F.count("*").alias("n"))


ELEMENTS_SQL = ", ".join(f"({i}, '{n}')" for i, n in IPFIX_FLOW_ELEMENTS.items())


@register("field_names", f"""WITH ids AS (SELECT CAST(l_partkey % 33000 AS INTEGER) AS field_id FROM lineitem)
    SELECT field_id, 10 AS version, CASE WHEN field_id BETWEEN 105 AND 127 THEN 'Assigned for NetFlow v9 compatibility'
         WHEN field_id BETWEEN 468 AND 32767 THEN 'Unassigned' ELSE coalesce(e.name, '') END AS field_name, count(*) AS n
    FROM ids LEFT JOIN (VALUES {ELEMENTS_SQL}) AS e(id, name) ON e.id = field_id GROUP BY 1, 2, 3""")
def _(spark, sf_dir):
    ids = rt.table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 33000).cast("int").alias("field_id"), F.lit(10).alias("version"))
    counted = ids.groupBy("field_id", "version").agg(F.count("*").alias("n"))
    return with_field_name(counted, F.lit("field")).select("field_id", "version", "field_name", "n")


# --- sFlow ------------------------------------------------------------------------------------------------------

SF_BASE = {"TimeReceived": "received", "TimeFlowStart": "received", "SamplerAddress": EXPORTER,
           "SamplingRate": "512 * (1 + ln)", "InIf": "ln", "OutIf": "sk % 48", "Bytes": "octets", "Packets": "1"}
L4 = {"Proto": "proto", "SrcPort": f"CASE WHEN proto = 1 THEN 0 ELSE {SPORT} END",
      "DstPort": f"CASE WHEN proto = 1 THEN 0 ELSE {DPORT} END", "TCPFlags": "CASE WHEN proto = 6 THEN tcp ELSE 0 END",
      "IcmpType": "CASE WHEN proto = 1 THEN ln ELSE 0 END", "IcmpCode": "CASE WHEN proto = 1 THEN sk % 16 ELSE 0 END"}
HEADER4 = {"SrcAddr": SRC, "DstAddr": DST, "Etype": "2048", "IPTos": "pk % 64", "IPTTL": "ln", "FragmentId": "ok % 65536",
           "FragmentOffset": "16384"}


def plain4() -> Column:
    return F.concat(rt.ipv4_hex(F.col("proto"), rt.src_number(), rt.dst_number(), F.col("pk") % 64, F.col("ln"),
                                F.col("ok") % 65536, 16384), rt.l4_hex())


def sf_flows(spark, sf_dir, *records, **kw):
    return flows_from_sflow(rt.sflow_packets(spark, sf_dir, list(records)), **kw)


def frame_query(name: str, columns: dict[str, str], frame_hex: Callable[[], Column], **kw) -> None:
    @register(name, select_sql(columns))
    def _(spark, sf_dir):
        return shown(sf_flows(spark, sf_dir, rt.raw_hex(frame_hex()), **kw), columns)


SF_SQL = SF_BASE | L4 | HEADER4 | {
    "SrcVlan": "sk % 4096", "DstVlan": "ln", "NextHop": NEXT_HOP, "SrcNet": "24", "DstNet": "ln",
    "SrcAS": f"CASE WHEN ln > 1 THEN {SRC_AS} ELSE 65000 END",
    "DstAS": f"CASE WHEN ln > 1 THEN {DST_AS} + ln - 1 ELSE {SRC_AS} END",
    "NextHopAS": f"CASE WHEN ln > 1 THEN {DST_AS} + 1 ELSE 0 END"}


@register("sflow_flows", select_sql(SF_SQL))
def _(spark, sf_dir):
    return shown(sf_flows(spark, sf_dir, rt.switch_hex(), rt.raw_hex(rt.ethernet_hex(0x800, plain4())), rt.router_hex(),
                          rt.gateway_hex()), SF_SQL)


IP4_SQL = SF_BASE | {"SrcAddr": SRC, "DstAddr": DST, "Etype": "2048", "Proto": "proto", "SrcPort": SPORT, "DstPort": DPORT,
                     "IPTos": "pk % 64", "TCPFlags": "0"}
IP6_SQL = IP4_SQL | {"SrcAddr": SRC6, "DstAddr": DST6, "Etype": "34525"}


@register("sflow_ipv4", select_sql(IP4_SQL))
def _(spark, sf_dir):
    return shown(sf_flows(spark, sf_dir, rt.ip_record_hex(False)), IP4_SQL)


@register("sflow_ipv6", select_sql(IP6_SQL))
def _(spark, sf_dir):
    return shown(sf_flows(spark, sf_dir, rt.ip_record_hex(True)), IP6_SQL)


@register("sflow_gateway", f"""{LI} SELECT {NEXT_HOP} AS next_hop, {big(SRC_AS)} AS own_as, {big('65000')} AS src_as,
    CASE WHEN ln > 1 THEN array_to_string(list_transform(range(1, ln), lambda i: {DST_AS} + i), ' ') ELSE '' END AS path,
    concat(ln, ' ', pk % 1000) AS communities, {big('100')} AS local_pref FROM li""")
def _(spark, sf_dir):
    rows = where_once(sflow.flow_records(sf_samples(spark, sf_dir, [rt.gateway_hex()])), F.col("gateway").isNotNull())
    return rows.select(
        ip_text(F.col("gateway.next_hop")).alias("next_hop"), F.col("gateway.as").alias("own_as"),
        F.col("gateway.src_as").alias("src_as"), F.array_join(F.col("gateway.as_path").cast("array<string>"), " ").alias("path"),
        F.array_join(F.col("gateway.communities").cast("array<string>"), " ").alias("communities"),
        F.col("gateway.local_pref").alias("local_pref"))


@register("sflow_router", f"""{LI} SELECT {NEXT_HOP} AS next_hop, {big('24')} AS src_mask_len, {big('ln')} AS dst_mask_len FROM li""")
def _(spark, sf_dir):
    rows = sflow.flow_records(sf_samples(spark, sf_dir, [rt.router_hex()])).where("router_ext IS NOT NULL")
    return rows.select(ip_text(F.col("router_ext.next_hop")).alias("next_hop"), "router_ext.src_mask_len",
                       "router_ext.dst_mask_len")


@register("sflow_switch", f"""{LI} SELECT {big('sk % 4096')} AS src_vlan, {big('1')} AS src_priority, {big('ln')} AS dst_vlan,
    {big('2')} AS dst_priority FROM li""")
def _(spark, sf_dir):
    rows = sflow.flow_records(sf_samples(spark, sf_dir, [rt.switch_hex()])).where("switch IS NOT NULL")
    return rows.select("switch.*")


frame_query("sflow_hdr_vlan", SF_BASE | L4 | HEADER4 | {"VlanId": "ln * 8192 + sk % 4096", "SrcMac": str(int(rt.MACS[12:], 16)),
                                                        "DstMac": str(int(rt.MACS[:12], 16))},
            lambda: rt.ethernet_hex(0x8100, rt.be_hex(F.col("ln") * 8192 + F.col("sk") % 4096, 2), F.lit("0800"), plain4()))


def mpls_hex() -> Column:
    """As many labels as the line number; label i is 100 i + 16 and has TTL i."""
    ln = F.col("ln")
    return F.array_join(F.transform(F.sequence(F.lit(1).cast("bigint"), ln), lambda i: rt.be_hex(
        (i * 100 + 16) * 4096 + F.when(i == ln, 256).otherwise(0) + i, 4)), "")


def label_sql(i: int) -> str:
    return f"CASE WHEN ln >= {i} THEN {i * 100 + 16} ELSE 0 END"


frame_query("sflow_hdr_mpls", SF_BASE | L4 | HEADER4 | {
    "HasMPLS": "true", "MPLSCount": "ln", "MPLS1Label": label_sql(1), "MPLS2Label": label_sql(2), "MPLS3Label": label_sql(3),
    "MPLS3TTL": "CASE WHEN ln >= 3 THEN 3 ELSE 0 END", "MPLSLastLabel": "CASE WHEN ln >= 4 THEN ln * 100 + 16 ELSE 0 END",
    "MPLSLastTTL": "CASE WHEN ln >= 4 THEN ln ELSE 0 END"}, lambda: rt.ethernet_hex(0x8847, mpls_hex(), plain4()))

INNER6 = {"SrcAddr": SRC6, "DstAddr": DST6, "IPTos": "pk % 64", "IPTTL": "ln", "IPv6FlowLabel": "ok % 65536"}
PROTO6 = {"Proto": "CASE WHEN proto = 1 THEN 58 ELSE proto END"}


def plain6() -> Column:
    proto = F.when(F.col("proto") == 1, 58).otherwise(F.col("proto"))
    return F.concat(rt.ipv6_hex(proto, rt.src_number(), rt.dst_number(), F.col("pk") % 64, F.col("ok") % 65536, F.col("ln")),
                    rt.l4_hex())


frame_query("sflow_hdr_ipv6", SF_BASE | L4 | PROTO6 | INNER6 | {"Etype": "34525"}, lambda: rt.ethernet_hex(0x86DD, plain6()))
frame_query("sflow_hdr_icmp", SF_BASE | {"Proto": "1", "IcmpType": "pk % 256", "IcmpCode": "ln", "SrcPort": "0"},
            lambda: rt.ethernet_hex(0x800, rt.ipv4_hex(1, rt.src_number(), rt.dst_number()),
                                    rt.be_hex(F.col("pk") % 256, 1), rt.be_hex(F.col("ln"), 1)))

# an ICMP header, a tagged one and a plain one in each sample: the ICMP word and the tag outlive the last header
@register("sflow_several_headers", select_sql(SF_BASE | L4 | HEADER4 | {
    "VlanId": "sk % 4096", "IcmpType": "CASE WHEN proto = 1 THEN ln ELSE pk % 256 END",
    "IcmpCode": "CASE WHEN proto = 1 THEN sk % 16 ELSE ln END"}))
def _(spark, sf_dir):
    icmp = rt.ethernet_hex(0x800, rt.ipv4_hex(1, rt.src_number(), rt.dst_number()), rt.be_hex(F.col("pk") % 256, 1),
                           rt.be_hex(F.col("ln"), 1))
    tagged = rt.ethernet_hex(0x8100, rt.be_hex(F.col("sk") % 4096, 2), F.lit("0806"), F.lit("00" * 28))
    rows = sf_flows(spark, sf_dir, *[rt.raw_hex(h) for h in (icmp, tagged, rt.ethernet_hex(0x800, plain4()))])
    return shown(rows, SF_BASE | L4 | HEADER4 | dict.fromkeys(["VlanId", "IcmpType", "IcmpCode"]))


OUTER_SRC, OUTER_DST = dotted("3221225984 + ln"), dotted("3221225984 + ln + 1")
OUTER = {"SrcAddr": OUTER_SRC, "DstAddr": OUTER_DST, "Proto": "47", "IPTTL": "99", "IPTos": "3", "FragmentId": "ln"}
INNER = {"SrcAddr": SRC6, "DstAddr": DST6, "Proto": PROTO6["Proto"], "IPTTL": "ln", "IPTos": "pk % 64", "FragmentId": "ln"}


def gre_hex() -> Column:
    ln = F.col("ln")
    return rt.ethernet_hex(0x800, rt.ipv4_hex(47, 3221225984 + ln, 3221225985 + ln, 3, 99, ln), F.lit("000086dd"), plain6())


def encap(columns: dict[str, str]) -> dict[str, str]:
    return {n + "Encap": sql for n, sql in columns.items()}


ENCAP = {"HasEncap": "true", "Etype": "34525", "EtypeEncap": "2048"}
TUNNEL_L4 = {n: s for n, s in L4.items() if n != "Proto"}


def gre_query(name: str, main: dict[str, str], inside: dict[str, str], label: str, decode_gre: bool) -> None:
    columns = SF_BASE | TUNNEL_L4 | main | ENCAP | encap(inside) | {label: "ok % 65536"}

    @register(name, f"""{LI} SELECT {', '.join(
        f"{s if ('Addr' in n or n == 'HasEncap') else big(s)} AS {n}" for n, s in columns.items())} FROM li""")
    def _(spark, sf_dir):
        return shown(sf_flows(spark, sf_dir, rt.raw_hex(gre_hex()), decode_gre=decode_gre), columns)


gre_query("sflow_hdr_gre_outer", OUTER, INNER, "IPv6FlowLabelEncap", False)
gre_query("sflow_hdr_gre_inner", INNER, OUTER, "IPv6FlowLabel", True)


def counter_sql(layout, values: list[str]) -> str:
    items = ", ".join(f"{big(v)} AS {n}" for (n, _), v in zip(layout, values))
    return f"{LI} SELECT {big('ok')} AS sample_sequence, {big('ln')} AS source_id, {items} FROM li"


@register("sflow_if_counters", counter_sql(sflow.IF_COUNTERS, [
    "ln", "6", "10000000000", "1", "3", "octets", "pkts", *[f"ln + {i}" for i in range(5)], "octets * 2", "ok",
    *[f"ln * {i}" for i in range(5)], "0"]))
def _(spark, sf_dir):
    rows = sflow.interface_counters(sf_samples(spark, sf_dir, [], rt.counter_sample_hex(1)))
    return rows.select("sample_sequence", "source_id", *[n for n, _ in sflow.IF_COUNTERS])


@register("sflow_eth_counters", counter_sql(sflow.ETHERNET_COUNTERS, [f"ln * 100 + {i}" for i in range(13)]))
def _(spark, sf_dir):
    rows = sflow.ethernet_counters(sf_samples(spark, sf_dir, [], rt.counter_sample_hex(2)))
    return rows.select("sample_sequence", "source_id", *[n for n, _ in sflow.ETHERNET_COUNTERS])


# --- all channels, rendering, messages --------------------------------------------------------------------------


def all_packets(spark, sf_dir) -> DataFrame:
    """v5, v9 and sFlow packets of the same rows, in one table."""
    rows = rt.settled_rows(spark, sf_dir)
    return rt.v5_packets(spark, sf_dir, rows=rows).unionByName(
        rt.netflow_packets(spark, sf_dir, 9, missing=True, rows=rows)).unionByName(
        rt.sflow_packets(spark, sf_dir, [rt.raw_hex(rt.ethernet_hex(0x800, plain4()))], rows=rows))


@register("flows_union", f"""{LI} SELECT v.flow_type AS flow_type, {big('proto')} AS Proto, count(*) AS flows,
    CAST(sum(octets) AS BIGINT) AS bytes, CAST(sum(octets * CASE v.flow_type WHEN 'NETFLOW_V5' THEN 100
        WHEN 'NETFLOW_V9' THEN {RATE} ELSE 512 * (1 + ln) END) AS BIGINT) AS scaled
    FROM li CROSS JOIN (VALUES ('NETFLOW_V5'), ('NETFLOW_V9'), ('SFLOW_5')) AS v(flow_type)
    WHERE v.flow_type <> 'NETFLOW_V9' OR sk % 5 <> 0 GROUP BY 1, 2""")
def _(spark, sf_dir):
    flows = analytics.with_scaled_volume(flows_of(all_packets(spark, sf_dir)))
    return flows.groupBy(flow_type_name(F.col("Type")).alias("flow_type"), "Proto").agg(
        F.count("*").alias("flows"), F.sum("Bytes").cast("bigint").alias("bytes"),
        F.sum("ScaledBytes").cast("bigint").alias("scaled"))


LINE_FIELDS = ["Type", "SamplingRate", "Bytes", "SrcAddr", "DstAddr", "NextHop", "SrcMac", "HasPPP", "SrcAddrEncap", "DstPort"]
LINE_SQL = {"Type": "'NETFLOW_V5'", "SamplingRate": "'100'", "Bytes": "CAST(octets AS VARCHAR)", "SrcAddr": SRC, "DstAddr": DST,
            "NextHop": NEXT_HOP, "SrcMac": "'00:00:00:00:00:00'", "HasPPP": "'false'", "SrcAddrEncap": "'<nil>'",
            "DstPort": f"CAST({DPORT} AS VARCHAR)"}


@register("render_text", f"""{LI} SELECT concat_ws(' ', {', '.join(f"'{n}:' || {s}" for n, s in LINE_SQL.items())}) AS line FROM li""")
def _(spark, sf_dir):
    return v5_flows(spark, sf_dir).select(render.text_line(",".join(["NoSuchField", *LINE_FIELDS])).alias("line"))


JSON_ITEMS = ", ".join(f"""'"{n}":"' || {s} || '"'""" for n, s in LINE_SQL.items())


@register("render_json", f"""{LI} SELECT '{{' || concat_ws(',', {JSON_ITEMS}) || '}}' AS line FROM li""")
def _(spark, sf_dir):
    return v5_flows(spark, sf_dir).select(render.json_line(LINE_FIELDS).alias("line"))


@register("ip_text", f"""{LI} SELECT {SRC} AS v4, {SRC6} AS v6, {DST} AS mapped,
    printf('%x::%x', 1 + ln, 1 + sk % 65535) AS gap, '<nil>' AS none, '?' || printf('%06x', pk % 65536) AS odd FROM li""")
def _(spark, sf_dir):
    rows = rt.lineitem_rows(spark, sf_dir)
    be = rt.be_hex
    return rows.select(
        ip_text(F.unhex(be(rt.src_number(), 4))).alias("v4"),
        ip_text(rt.from_hex(F.lit("20010db8" + "0" * 16), be(rt.src_number(), 4))).alias("v6"),
        ip_text(rt.from_hex(F.lit("0" * 20 + "ffff"), be(rt.dst_number(), 4))).alias("mapped"),
        ip_text(rt.from_hex(be(1 + F.col("ln"), 2), F.lit("0" * 24), be(1 + F.col("sk") % 65535, 2))).alias("gap"),
        ip_text(F.lit(b"")).alias("none"), ip_text(F.unhex(be(F.col("pk") % 65536, 3))).alias("odd"))


@register("mac_text", """SELECT regexp_replace(printf('%012x', l_orderkey * 65536 + l_partkey % 65536), '(..)(..)(..)(..)(..)(..)',
    '\\1:\\2:\\3:\\4:\\5:\\6') AS mac FROM lineitem""")
def _(spark, sf_dir):
    rows = rt.lineitem_rows(spark, sf_dir)
    return rows.select(mac_text(F.col("ok") * 65536 + F.col("pk") % 65536).alias("mac"))


KEY_SQL = f"'[' || replace({EXPORTER}, '.', ' ') || ']-' || CAST({DST_AS} AS VARCHAR) || '-'"


@register("partition_key", f"""{LI} SELECT {KEY_SQL} AS key, 'NETFLOW_V5-false-' AS other, count(*) AS flows FROM li GROUP BY 1, 2""")
def _(spark, sf_dir):
    flows = v5_flows(spark, sf_dir)
    return flows.groupBy(render.partition_key(["SamplerAddress", "NoSuchField", "DstAS"]).alias("key"),
                         render.partition_key(["Type", "HasEncap"]).alias("other")).agg(F.count("*").alias("flows"))


@register("messages", f"""{LI} SELECT 'flow-messages' AS topic, {KEY_SQL} AS key,
    '{{"Bytes":"' || octets || '"}}' AS value FROM li""")
def _(spark, sf_dir):
    messages = flows_to_messages(v5_flows(spark, sf_dir), key=["SamplerAddress", "DstAS"], value=render.json_line("Bytes"))
    return distribute(messages, 8, keyed=True)


@register("messages_by_partition", f"""{LI} SELECT {KEY_SQL} AS key, count(*) AS messages, CAST(1 AS BIGINT) AS partitions
    FROM li GROUP BY 1""")
def _(spark, sf_dir):
    messages = flows_to_messages(v5_flows(spark, sf_dir), key=["SamplerAddress", "DstAS"], value=render.json_line("Bytes"))
    placed = distribute(messages, 8, keyed=True).withColumn("partition", F.spark_partition_id())
    return placed.groupBy("key").agg(F.count("*").alias("messages"), F.countDistinct("partition").alias("partitions"))


@register("flows_sql_view", f"""{LI} SELECT {big('proto')} AS Proto, {big(DPORT)} AS DstPort,
    CAST(sum(octets) AS BIGINT) AS bytes FROM li GROUP BY 1, 2""")
def _(spark, sf_dir):
    register_flows(v5_flows(spark, sf_dir), "flows")
    return spark.sql("SELECT Proto, DstPort, CAST(sum(Bytes) AS BIGINT) AS bytes FROM flows GROUP BY 1, 2")


# --- health -----------------------------------------------------------------------------------------------------

PACKETS_SQL = """, grouped AS (SELECT sk, m, count(*) AS n FROM li GROUP BY 1, 2, ok // 1048576),
  sent AS (SELECT sk, m, n, {per} AS per FROM grouped)"""


@register("health_traffic", f"""{LI}{PACKETS_SQL.format(per=24)} SELECT {EXPORTER} AS remote_ip, 2055 AS remote_port,
    '' AS local_ip, 2056 AS local_port, 'NetFlowV5' AS type, CAST(sum(n * 48 + 24 * ((n + 23) // 24)) AS BIGINT) AS bytes,
    CAST(sum((n + 23) // 24) AS BIGINT) AS packets FROM sent GROUP BY 1""")
def _(spark, sf_dir):
    return health.traffic(rt.v5_packets(spark, sf_dir)).drop("size_quantiles")


QUANTILE_SQL = ", ".join(f"min(CASE WHEN rn * 100 >= {q} * n THEN v END) AS p{q}" for q in (50, 90, 99))


@register("health_traffic_sizes", f"""{LI}{PACKETS_SQL.format(per=24)}, sizes AS (SELECT sk, CAST(24 + 48 * least(24, n - 24 * i)
      AS INTEGER) AS v FROM (SELECT sk, n, unnest(range((n + 23) // 24)) AS i FROM sent)),
    ranked AS (SELECT sk, v, row_number() OVER (PARTITION BY sk ORDER BY v) AS rn, count(*) OVER (PARTITION BY sk) AS n FROM sizes)
    SELECT {EXPORTER} AS remote_ip, CAST(max(n) AS BIGINT) AS packets, {QUANTILE_SQL} FROM ranked GROUP BY 1""")
def _(spark, sf_dir):
    return health.traffic(rt.v5_packets(spark, sf_dir)).select(
        "remote_ip", "packets", *[F.get("size_quantiles", F.lit(i)).alias(n) for i, n in enumerate(("p50", "p90", "p99"))])


@register("health_nf", f"""{LI}{PACKETS_SQL.format(per=24)} SELECT {EXPORTER} AS router, 9 AS version,
    CAST(sum(CASE WHEN sk % 5 = 0 THEN 0 ELSE (n + 23) // 24 END) + 2 AS BIGINT) AS packets FROM sent GROUP BY 1
    UNION ALL SELECT {EXPORTER}, 5, CAST(sum((n + 23) // 24) AS BIGINT) FROM sent GROUP BY 1""")
def _(spark, sf_dir):
    rows = rt.settled_rows(spark, sf_dir)
    return health.netflow_packets(resolve(rt.netflow_packets(spark, sf_dir, 9, missing=True, rows=rows)),
                                  netflow5.read_headers(rt.v5_packets(spark, sf_dir, rows=rows)))


@register("health_nf_errors", f"""{LI}{PACKETS_SQL.format(per=24)} SELECT {EXPORTER} AS router, 'template_not_found' AS error,
    CAST(sum((n + 23) // 24) AS BIGINT) AS packets FROM sent WHERE sk % 5 = 0 GROUP BY 1""")
def _(spark, sf_dir):
    rows = rt.settled_rows(spark, sf_dir)
    return health.netflow_errors(resolve(rt.netflow_packets(spark, sf_dir, 9, missing=True, rows=rows)),
                                 netflow5.read_headers(rt.v5_packets(spark, sf_dir, rows=rows)))


@register("health_nf_sets", f"""{LI}{PACKETS_SQL.format(per=24)}, per_router AS (SELECT {EXPORTER} AS router,
      CAST(sum((n + 23) // 24) AS BIGINT) AS packets, CAST(sum(n) AS BIGINT) AS records,
      CAST(sum(CASE WHEN month(m) = 1 THEN (n + 23) // 24 ELSE 0 END) AS BIGINT) AS january FROM sent GROUP BY 1)
    SELECT router, 10 AS version, 'DataFlowSet' AS type, packets AS sets, records AS records FROM per_router
    UNION ALL SELECT router, 10, 'TemplateFlowSet', january + 2, january + 2 FROM per_router
    UNION ALL SELECT router, 10, 'OptionsTemplateFlowSet', 1, 1 FROM per_router
    UNION ALL SELECT router, 10, 'OptionsDataFlowSet', 2, 2 FROM per_router
    UNION ALL SELECT router, 5, 'DataFlowSet', records, 0 FROM per_router""")
def _(spark, sf_dir):
    return health.netflow_sets(resolve(rt.netflow_packets(spark, sf_dir, 10)),
                               netflow5.read_headers(rt.v5_packets(spark, sf_dir)))


@register("health_delay", f"""{LI} SELECT {EXPORTER} AS router, 9 AS version,
    CAST(sum(received - (1700000000 - ok % 100)) AS BIGINT) AS delay_sum, count(*) AS flows FROM li GROUP BY 1""")
def _(spark, sf_dir):
    return health.delay(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9), sampling_rate=1)).drop("quantiles")


@register("health_delay_quantiles", f"""{LI}, delays AS (SELECT sk, received - (1700000000 - ok % 100) AS v FROM li),
    ranked AS (SELECT sk, v, row_number() OVER (PARTITION BY sk ORDER BY v) AS rn, count(*) OVER (PARTITION BY sk) AS n FROM delays)
    SELECT {EXPORTER} AS router, 9 AS version, {QUANTILE_SQL} FROM ranked GROUP BY 1""")
def _(spark, sf_dir):
    rows = health.delay(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9), sampling_rate=1))
    return rows.select("router", "version", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("p50", "p90", "p99"))])


@register("health_templates", f"""{LI}{PACKETS_SQL.format(per=24)}, per_router AS (SELECT {EXPORTER} AS router,
      CAST(sum(CASE WHEN month(m) = 1 THEN (n + 23) // 24 ELSE 0 END) AS BIGINT) AS january FROM sent GROUP BY 1)
    SELECT router, 9 AS version, CAST(7 AS BIGINT) AS obs_domain_id, 300 AS template_id, 'template' AS type,
           january + 2 AS templates FROM per_router
    UNION ALL SELECT router, 9, 7, 400, 'options_template', 1 FROM per_router""")
def _(spark, sf_dir):
    return health.template_counts(resolve(rt.netflow_packets(spark, sf_dir, 9)))


def broken_sflow(spark, sf_dir) -> DataFrame:
    """sFlow packets, every one again with another version word and again cut inside its header."""
    good = rt.sflow_packets(spark, sf_dir, [rt.switch_hex()])
    wrong = good.withColumn("payload", F.concat(F.lit(b"\0\0\0\4"), F.expr("substring(payload, 5)")))
    cut = good.withColumn("payload", F.expr("substring(payload, 1, 20)"))
    return good.unionByName(wrong).unionByName(cut)


SF_PACKETS = PACKETS_SQL.format(per=8)


@register("health_sf", f"""{LI}{SF_PACKETS} SELECT {EXPORTER} AS router, {EXPORTER} AS agent, 5 AS version,
    CAST(sum((n + 7) // 8) AS BIGINT) AS packets FROM sent GROUP BY 1""")
def _(spark, sf_dir):
    return health.sflow_packets(sflow.read_headers(broken_sflow(spark, sf_dir)))


@register("health_sf_errors", f"""{LI}{SF_PACKETS} SELECT {EXPORTER} AS router, e.error AS error,
    CAST(sum((n + 7) // 8) AS BIGINT) AS packets FROM sent
    CROSS JOIN (VALUES ('error_version'), ('error_decoding')) AS e(error) GROUP BY 1, 2""")
def _(spark, sf_dir):
    return health.sflow_errors(sflow.read_headers(broken_sflow(spark, sf_dir)))


@register("health_sf_samples", f"""{LI} SELECT {EXPORTER} AS router, {EXPORTER} AS agent, 5 AS version,
    CASE WHEN ln % 2 = 1 THEN 'FlowSample' ELSE 'ExpandedFlowSample' END AS type, count(*) AS samples,
    count(*) * 2 AS records FROM li GROUP BY 1, 4""")
def _(spark, sf_dir):
    headers = sflow.read_headers(rt.sflow_packets(spark, sf_dir, [rt.switch_hex(), rt.router_hex()]))
    return health.sflow_samples(headers)


@register("errors_split", f"""{LI}{PACKETS_SQL.format(per=24)} SELECT 'NetFlow' AS channel, 'template_not_found' AS error,
    CAST(sum((n + 23) // 24) AS BIGINT) AS packets FROM sent WHERE sk % 5 = 0
    UNION ALL SELECT 'sFlow', e.error, CAST(sum((n + 7) // 8) AS BIGINT) FROM sent
    CROSS JOIN (VALUES ('error_version'), ('error_decoding')) AS e(error) GROUP BY 1, 2""")
def _(spark, sf_dir):
    packets = rt.v5_packets(spark, sf_dir).unionByName(rt.netflow_packets(spark, sf_dir, 9, missing=True)).unionByName(
        broken_sflow(spark, sf_dir))
    return errors_of(packets).groupBy("channel", "error").agg(F.count("*").alias("packets"))


# --- analytics --------------------------------------------------------------------------------------------------


@register("scaled_volume", f"""{LI} SELECT {EXPORTER} AS router, CAST(sum(octets * ({RATE})) AS BIGINT) AS bytes,
    CAST(sum(pkts * ({RATE})) AS BIGINT) AS packets FROM li GROUP BY 1""")
def _(spark, sf_dir):
    rows = analytics.with_scaled_volume(flows_from_netflow(rt.netflow_packets(spark, sf_dir, 9)))
    return rows.groupBy(ip_text(F.col("SamplerAddress")).alias("router")).agg(
        F.sum("ScaledBytes").cast("bigint").alias("bytes"), F.sum("ScaledPackets").cast("bigint").alias("packets"))


def event_flows(spark, sf_dir) -> DataFrame:
    """``events`` as flows: bytes from the value, one packet each, four sampling rates."""
    return rt.table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("event_time"), "event_id",
        F.round(F.col("value") * 100).cast("bigint").alias("Bytes"), F.lit(1).cast("bigint").alias("Packets"),
        (1 + F.col("event_id") % 4).alias("SamplingRate"))


EV = """WITH ev AS (SELECT user_id, ts, event_id, CAST(round(value * 100) AS BIGINT) * (1 + event_id % 4) AS b,
    1 + event_id % 4 AS p FROM events)"""


@register("session_volume", f"""{EV}, marked AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL 5 MINUTE
      OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS starts FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked)
    SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS start_us, CAST(epoch_us(max(ts)) + 300000000 AS BIGINT) AS end_us,
           CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(p) AS BIGINT) AS packets, count(*) AS flows
    FROM numbered GROUP BY user_id, session""")
def _(spark, sf_dir):
    rows = analytics.session_volume(event_flows(spark, sf_dir), ["user_id"])
    return rows.select("user_id", F.unix_micros("session_start").alias("start_us"), F.unix_micros("session_end").alias("end_us"),
                       F.col("bytes").cast("bigint").alias("bytes"), F.col("packets").cast("bigint").alias("packets"), "flows")


@register("late_flows", """WITH ev AS (SELECT event_id, ts,
      ts - CASE WHEN event_id % 10 = 0 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS event_time,
      CAST(floor(epoch(ts) / 60) AS BIGINT) AS slot FROM events),
    newest AS (SELECT slot, max(event_time) AS newest FROM ev GROUP BY 1),
    marks AS (SELECT slot, max(newest) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM newest)
    SELECT event_id, CAST(epoch_us(event_time) AS BIGINT) AS event_us FROM ev JOIN marks USING (slot)
    WHERE event_time < mark - INTERVAL 2 MINUTE""")
def _(spark, sf_dir):
    arrived = event_flows(spark, sf_dir).withColumnRenamed("event_time", "arrival")
    delayed = F.when(F.col("event_id") % 10 == 0, F.expr("arrival - INTERVAL 30 MINUTES")).otherwise(F.col("arrival"))
    late = analytics.late_flows(arrived.withColumn("event_time", delayed), "event_time", "arrival")
    return late.select("event_id", F.unix_micros("event_time").alias("event_us"))


@register("as_port_grouping_sets", f"""{LI} SELECT CASE WHEN grouping(a) = 0 THEN a ELSE -1 END AS SrcAS,
    CASE WHEN grouping(p) = 0 THEN p ELSE -1 END AS DstPort, CASE WHEN grouping(r) = 0 THEN r ELSE 'all' END AS router,
    CAST(sum(b) AS BIGINT) AS bytes, count(*) AS flows
    FROM (SELECT {big(SRC_AS)} AS a, {big(DPORT)} AS p, {EXPORTER} AS r, octets * 100 AS b FROM li)
    GROUP BY GROUPING SETS ((a, r), (a), (p, r), (p))""")
def _(spark, sf_dir):
    rows = analytics.as_port_volumes(v5_flows(spark, sf_dir))
    return rows.select(F.coalesce("SrcAS", F.lit(-1)).alias("SrcAS"), F.coalesce("DstPort", F.lit(-1)).alias("DstPort"),
                       F.coalesce(ip_text(F.col("SamplerAddress")), F.lit("all")).alias("router"),
                       F.col("bytes").cast("bigint").alias("bytes"), "flows")


@register("rollup_minute", f"""{EV} SELECT user_id, CAST(epoch(date_trunc('minute', ts)) AS BIGINT) AS minute,
    CAST(sum(b) AS BIGINT) AS bytes, CAST(sum(p) AS BIGINT) AS packets, count(*) AS flows FROM ev GROUP BY 1, 2""")
def _(spark, sf_dir):
    rows = analytics.minute_rollup(event_flows(spark, sf_dir), ["user_id"])
    return rows.select("user_id", F.unix_seconds("window_start").alias("minute"), F.col("bytes").cast("bigint").alias("bytes"),
                       F.col("packets").cast("bigint").alias("packets"), "flows")


@register("enrich_dictionary", f"""{LI} SELECT country, CAST(sum(octets) AS BIGINT) AS bytes, count(*) AS flows
    FROM li JOIN (SELECT 64512 + s_suppkey % 1000 AS a, max(n_name) AS country
                  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1) d ON d.a = {SRC_AS} GROUP BY 1""")
def _(spark, sf_dir):
    # several suppliers share an AS from the thousandth on; the dictionary repeats its key there
    dictionary = rt.table(spark, sf_dir, "supplier").join(
        rt.table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        (64512 + F.col("s_suppkey") % 1000).alias("SrcAS"), F.col("n_name").alias("country"))
    rows = analytics.enrich(v5_flows(spark, sf_dir), dictionary, ["SrcAS"])
    return rows.groupBy("country").agg(F.sum("Bytes").cast("bigint").alias("bytes"), F.count("*").alias("flows"))


# prefixes from supplier: 10.0.0.0/8, a /24 per 256 suppliers, a /28 per third group of 16, a /32 per seventh supplier
@register("lpm_asn", f"""{LI} SELECT CAST(CASE WHEN sk % 7 = 0 THEN 32000000 + sk WHEN (sk // 16) % 3 = 0 THEN 28000000 + sk // 16
    WHEN (sk // 256) % 2 = 0 THEN 24000000 + sk // 256 ELSE 8000000 END AS BIGINT) AS asn,
    CAST(sum(octets) AS BIGINT) AS bytes, count(*) AS flows FROM li GROUP BY 1""")
def _(spark, sf_dir):
    sk = F.col("s_suppkey")
    suppliers = rt.table(spark, sf_dir, "supplier")

    def level(length, size, where):
        network = (167772160 + rt.int_div(sk, size) * size)
        return suppliers.where(where).select(rt.v4(network).alias("network"), F.lit(length).alias("prefix_len"),
                                             (length * 1_000_000 + rt.int_div(sk, size)).cast("bigint").alias("asn")).distinct()

    prefixes = level(32, 1, sk % 7 == 0).unionByName(level(28, 16, rt.int_div(sk, 16) % 3 == 0)).unionByName(
        level(24, 256, rt.int_div(sk, 256) % 2 == 0)).unionByName(level(8, 1 << 24, F.lit(True)))
    rows = analytics.longest_prefix_match(v5_flows(spark, sf_dir), prefixes, "SrcAddr")
    return rows.groupBy("asn").agg(F.sum("Bytes").cast("bigint").alias("bytes"), F.count("*").alias("flows"))


# --- stored packets, guards, files ------------------------------------------------------------------------------

def order_packets(spark: SparkSession, sf_dir: str, tail: Column) -> DataFrame:
    """A NetFlow v5 packet with one record per order, and what ``tail`` puts behind it. Every seventh has another version,
    every fifth declares more records than a packet may."""
    ok = F.col("o_orderkey")
    version = F.when(ok % 7 == 0, 8).otherwise(5)
    count = F.when(ok % 5 == 0, 1366 + ok % 100).otherwise(1)
    head = F.concat(rt.be_hex(version, 2), rt.be_hex(count, 2), F.lit("00" * 20))
    record = F.concat(rt.be_hex(167772160 + F.col("o_custkey"), 4), F.lit("00" * 16), rt.be_hex(ok, 4), F.lit("00" * 24))
    return rt.table(spark, sf_dir, "orders").select(
        ok.alias("packet_id"), F.lit("NetFlowV5").alias("channel"), rt.v4(3221225984 + ok % 16).alias("src"), F.lit(2056).alias("src_port"),
        rt.from_hex(head, record, tail).alias("payload"), F.to_timestamp("o_orderdate").alias("recv_time"))


@register("packets_stored", """SELECT o_orderkey % 4 AS longer, count(*) AS packets,
    CAST(sum(least(72 + 8910 + 8 * (o_orderkey % 4), 9000)) AS BIGINT) AS bytes_read,
    CAST(sum(CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 THEN o_orderkey ELSE 0 END) AS BIGINT) AS bytes_seen
    FROM orders GROUP BY 1""")
def _(spark, sf_dir):
    # written to a packet table and read from it; datagrams beyond the read buffer are cut
    longer = F.col("o_orderkey") % 4
    path = fresh_folder(spark, "packets")
    order_packets(spark, sf_dir, F.repeat(F.lit("00"), (8910 + 8 * longer).cast("int"))).write.parquet(path)
    packets = read_packets(spark, path)
    seen = netflow5.flows_from_netflow5(packets).groupBy("packet_id").agg(F.sum("Bytes").alias("seen"))
    rows = packets.select("packet_id", F.octet_length("payload").alias("size")).join(seen, "packet_id", "left")
    return rows.groupBy((F.col("packet_id") % 4).alias("longer")).agg(
        F.count("*").alias("packets"), F.sum("size").cast("bigint").alias("bytes_read"),
        F.coalesce(F.sum("seen"), F.lit(0)).cast("bigint").alias("bytes_seen"))


GUARD_SQL = """SELECT error, count(*) AS packets FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'error_version'
    WHEN o_orderkey % 5 = 0 THEN 'error_decoding' END AS error FROM orders) GROUP BY 1"""


@register("v5_count_guard", GUARD_SQL)
def _(spark, sf_dir):
    heads = netflow5.read_headers(order_packets(spark, sf_dir, F.lit("")))
    return heads.groupBy("error").agg(F.count("*").alias("packets"))


@register("errors_observed", f"""SELECT coalesce(error, 'packets') AS error, CASE WHEN error IS NULL THEN
    (SELECT count(*) FROM orders) ELSE packets END AS packets FROM ({GUARD_SQL})""")
def _(spark, sf_dir):
    # counted while another job runs over the rows
    watch = Observation("packets")
    heads = netflow5.read_headers(order_packets(spark, sf_dir, F.lit("")))
    with_live_counts(heads, watch).select("error").write.format("noop").mode("overwrite").save()
    counts = [(k, v) for k, v in watch.get.items() if v and k in ["packets", *ERRORS]]
    return spark.createDataFrame(counts, "error string, packets bigint")


@register("nf_sets_by_kind", f"""SELECT {dotted('167837696 + s_suppkey')} AS router, v.kind AS kind, CAST(v.n AS BIGINT) AS sets,
    CAST(v.n * v.least_id AS BIGINT) AS ids FROM supplier CROSS JOIN
    (VALUES ('template', 2, 0), ('options template', 1, 1), ('data', 2, 400)) AS v(kind, n, least_id)""")
def _(spark, sf_dir):
    # the two packets by which every exporter sets up
    framed = frame(rt.netflow_packets(spark, sf_dir, 9)).where("packet_id < 0")
    kinds = [("template", template_sets), ("options template", options_template_sets), ("data", data_sets)]
    rows = [of(framed).select("router", F.lit(kind).alias("kind"), "id") for kind, of in kinds]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("router", "kind").agg(
        F.count("*").alias("sets"), F.sum("id").cast("bigint").alias("ids"))


@register("text_sink", ORACLES["render_text"])
def _(spark, sf_dir):
    path = fresh_folder(spark, "text")
    write_lines(flows_to_text(v5_flows(spark, sf_dir), LINE_FIELDS), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@register("json_sink", f"{LI} SELECT {', '.join(f'{s} AS {n}' for n, s in LINE_SQL.items())} FROM li")
def _(spark, sf_dir):
    path = fresh_folder(spark, "json")
    write_lines(flows_to_json(v5_flows(spark, sf_dir), LINE_FIELDS), path)
    return read_json_lines(spark, path, LINE_FIELDS)


@register("message_log", ORACLES["messages"])
def _(spark, sf_dir):
    path = fresh_folder(spark, "messages")
    write_messages(flows_to_messages(v5_flows(spark, sf_dir), key=["SamplerAddress", "DstAS"], value=render.json_line("Bytes")),
                   path=path)
    return spark.read.parquet(path)


# the same levels as lpm_asn under an IPv6 network: /104, /120, /124 and /128
@register("lpm_asn6", ORACLES["lpm_asn"].replace("ELSE 8000000", "ELSE 104000000").replace("24000000 +", "120000000 +").replace(
    "28000000 +", "124000000 +").replace("32000000 +", "128000000 +"))
def _(spark, sf_dir):
    sk = F.col("s_suppkey")
    suppliers = rt.table(spark, sf_dir, "supplier")

    def level(length, size, where):
        network = rt.from_hex(F.lit("20010db8" + "0" * 16), rt.be_hex(167772160 + rt.int_div(sk, size) * size, 4))
        return suppliers.where(where).select(network.alias("network"), F.lit(length).alias("prefix_len"),
                                             (length * 1_000_000 + rt.int_div(sk, size)).cast("bigint").alias("asn")).distinct()

    prefixes = level(128, 1, sk % 7 == 0).unionByName(level(124, 16, rt.int_div(sk, 16) % 3 == 0)).unionByName(
        level(120, 256, rt.int_div(sk, 256) % 2 == 0)).unionByName(level(104, 1 << 24, F.lit(True)))
    flows = sf_flows(spark, sf_dir, rt.ip_record_hex(True))
    return analytics.longest_prefix_match(flows, prefixes, "SrcAddr").groupBy("asn").agg(
        F.sum("Bytes").cast("bigint").alias("bytes"), F.count("*").alias("flows"))
