import ipaddress
import json
import struct

from pyspark.sql import functions as F

from packetloom.functions import names, render
from packetloom.functions.binary import udiv, unsigned
from packetloom.functions.text import ip_text, mac_text
from packetloom.operators import analytics, health
from packetloom.operators.describe import describe_packets, template_listing
from packetloom.operators.netflow5 import flows_from_netflow5
from packetloom.operators.netflow_flows import resolve
from packetloom.operators.netflow_sets import data_sets, frame, options_template_sets, template_sets
from packetloom.operators.sflow import read_headers
from packetloom.plans.tables import join_small, settle
from packetloom.plans.union import errors_of, flows_of
from packetloom.sources.sinks import distribute, flows_to_json, flows_to_messages, flows_to_text, write_flow_table, write_messages
from tests.wire import (fset, flow_sample, ipfix, netflow5, packets, record5, sflow, switch, template, tlv, v4, v9,
                        v9_options)


def test_address_text_agrees_with_the_standard_library(spark):
    cases = [bytes(16), bytes(15) + b"\1", b"\x20\1" + bytes(14), bytes.fromhex("20010db8000000010000000000000001"),
             bytes.fromhex("20010db8000000000001000000000001"), bytes.fromhex("00010000000200030004000500060007"),
             bytes.fromhex("fd010000ff018210cdffff1c00000150"), b"\xff" * 16, bytes.fromhex("0001" * 6 + "00000000"),
             bytes.fromhex("0000" * 2 + "0001" * 3 + "0000" * 3), bytes.fromhex("0" * 28 + "0a0b"), v4("10.0.255.1")]
    df = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(cases)], "i int, b binary")
    got = [r.t for r in df.select("i", ip_text(F.col("b")).alias("t")).orderBy("i").collect()]
    assert got == [str(ipaddress.ip_address(c)) for c in cases]
    odd = spark.createDataFrame([(bytearray(bytes(10) + b"\xff\xff" + v4("1.2.3.4")), bytearray(b""), bytearray(b"\1\xab"))],
                                "m binary, e binary, o binary")
    assert list(odd.select(*[ip_text(F.col(c)) for c in "meo"]).first()) == ["1.2.3.4", "<nil>", "?01ab"]


def test_unsigned_numbers(spark):
    df = spark.createDataFrame([(-1,), (7,)], "b bigint")
    rows = df.select(unsigned(F.col("b")).alias("u"), udiv(F.col("b"), 1000).alias("d"),
                     mac_text(F.col("b")).alias("m")).collect()
    assert [int(r.u) for r in rows] == [2**64 - 1, 7]
    assert [r.d for r in rows] == [(2**64 - 1) // 1000, 0]
    assert rows[0].m == "ff:ff:ff:ff:ff:ff"


def test_lines_keys_and_messages(spark, tmp_path):
    flows = flows_from_netflow5(packets(spark, [netflow5([record5("10.0.0.1", "10.0.0.2", octets=82, dst_as=5)])],
                                        "NetFlowV5", src=v4("10.0.0.1")))
    row = flows.select(
        render.partition_key(["SamplerAddress", "InvalidField"]).alias("key"), render.partition_key(["Type", "HasPPP", "SrcAddrEncap"]).alias("k2"),
        render.text_line("Bytes,Nope,SrcAddr,Bytes").alias("text"), render.json_line().alias("json"),
        render.json_line(["FlowDirection", "Bytes"]).alias("named")).first()
    assert (row.key, row.k2) == ("[10 0 0 1]-", "NETFLOW_V5-false-[]-")
    assert row.text == "Bytes:82 SrcAddr:10.0.0.1 Bytes:82"
    parsed = json.loads(row.json)
    assert len(parsed) == 62 and "FlowDirection" not in parsed and list(parsed) == render.DEFAULT_FIELDS
    assert (parsed["Bytes"], parsed["HasPPP"], parsed["SrcMac"], parsed["SrcAddrEncap"]) == ("82", "false", "00:00:00:00:00:00", "<nil>")
    assert json.loads(row.named) == {"FlowDirection": "0", "Bytes": "82"}
    assert flows_to_text(flows).columns == flows_to_json(flows).columns == ["value"]
    write_messages(distribute(flows_to_messages(flows, key=["DstAS"]), 2, keyed=True), path=str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).first().key == "5-"
    write_flow_table(flows, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f")).where("date = DATE'2024-05-01' AND flow_type = 2").count() == 1


def test_field_names(spark):
    registry = spark.createDataFrame([(1, "octetDeltaCount"), (433, "ignoredLayer2FrameTotalCount"), (500, "later")], "id int, name string")
    ids = spark.createDataFrame([(9, 0), (9, 1), (9, 97), (9, 104), (9, 105), (9, 234), (10, 1), (10, 110), (10, 433), (10, 468),
                                 (10, 32768)], "version int, field_id int")
    got = {(r.version, r.field_id): r.field_name for r in names.with_field_name(ids, F.lit("field"), ipfix_registry=registry).collect()}
    assert got == {(9, 0): "Unassigned", (9, 1): "IN_BYTES", (9, 97): "", (9, 104): "layer2packetSectionData", (9, 105): "Unassigned",
                   (9, 234): "Unassigned", (10, 1): "octetDeltaCount", (10, 110): "Assigned for NetFlow v9 compatibility",
                   (10, 433): "ignoredLayer2FrameTotalCount", (10, 468): "Unassigned", (10, 32768): ""}


def test_netflow_health_and_description(spark):
    sent = [v9(fset(0, template(300, [(1, 4)])), fset(1, v9_options(400, [(1, 4)], [(34, 4)])), fset(300, struct.pack(">II", 5, 6)),
               fset(400, struct.pack(">II", 1, 9))),
            v9(fset(0, template(301, [(2, 4)])), fset(999, b"")), ipfix(fset(9, b""))]
    table = packets(spark, sent)
    resolved = resolve(table, with_fields=True).persist()
    sets = {(r.version, r.type): (r.sets, r.records) for r in health.netflow_sets(resolved).collect()}
    assert sets == {(9, "TemplateFlowSet"): (1, 1), (9, "OptionsTemplateFlowSet"): (1, 1), (9, "DataFlowSet"): (1, 2),
                    (9, "OptionsDataFlowSet"): (1, 1)}
    compat = {(r.version, r.type): (r.sets, r.records) for r in health.netflow_sets(resolved, compat_labels=True).collect()}
    assert compat[(9, "TemplateFlowSet")] == (1, 0) and compat[(9, "OptionsTemplateFlowSet")] == (1, 2)
    assert {(r.error, r.packets) for r in health.netflow_errors(resolved).collect()} == {("template_not_found", 1), ("error_flow_id", 1)}
    counts = {(r.template_id, r.type): r.templates for r in health.template_counts(resolved).collect()}
    assert counts == {(300, "template"): 1, (400, "options_template"): 1, (301, "template"): 1}
    long = {(r.part, r.field_id, r.field_name, r.value_hex) for r in describe_packets(resolved).collect()}
    assert long == {("field", 1, "IN_BYTES", "00000005"), ("field", 1, "IN_BYTES", "00000006"), ("scope", 1, "System", "00000001"),
                    ("field", 34, "SAMPLING_INTERVAL", "00000009")}
    framed = frame(table)
    assert {(r.template_id, r.kind, r.size) for r in template_listing(framed).collect()} == {(300, "data", 4), (400, "options", 8), (301, "data", 4)}
    assert [template_sets(framed).count(), options_template_sets(framed).count(), data_sets(framed).count()] == [2, 1, 3]


def test_sflow_sample_health(spark):
    sent = [sflow(flow_sample(switch(1, 2), count=7), tlv(1, b"cut"), count=5), b"\0"]
    headers = read_headers(packets(spark, sent, "sFlow"))
    got = {(r.type, r.samples, r.records) for r in health.sflow_samples(headers).collect()}
    assert got == {("FlowSample", 1, 7), ("unknown", 4, 0)}


def test_union_of_channels(spark):
    table = packets(spark, [sflow(flow_sample(switch(1, 2)))], "sFlow").union(
        packets(spark, [v9(fset(0, template(300, [(1, 4)])), fset(300, b"\0\0\0\5")), v9(fset(5, b""))], start=10)).union(
        packets(spark, [netflow5([record5("1.1.1.1", "2.2.2.2")])], "NetFlowV5", start=20))
    assert sorted(r.Type for r in flows_of(table).select("Type").collect()) == [1, 2, 3]
    assert [r.Type for r in flows_of(table, channels=("NetFlowV5",)).select("Type").collect()] == [2]
    assert [(r.packet_id, r.error) for r in errors_of(table).collect()] == [(11, "error_flow_id")]


def test_prefixes_and_small_joins(spark):
    prefixes = spark.createDataFrame([
        (bytearray(v4("10.0.0.0")), 8, 1), (bytearray(v4("10.1.0.0")), 16, 2), (bytearray(v4("10.1.2.3")), 32, 3),
        (bytearray(v4("0.0.0.0")), 0, 9), (bytearray(b"\x20\1" + bytes(14)), 16, 4),
        (bytearray(b"\x20\1" + bytes(8) + b"\xff" + bytes(5)), 88, 5)], "network binary, prefix_len int, asn bigint")
    addresses = [("10.9.9.9", v4("10.9.9.9"), 1), ("b", v4("10.1.9.9"), 2), ("c", v4("10.1.2.3"), 3), ("d", v4("192.0.2.1"), 9),
                 ("e", b"\x20\1" + bytes(13) + b"\1", 4), ("f", b"\x20\1" + bytes(8) + b"\xff" + bytes(4) + b"\1", 5),
                 ("g", b"\x30" + bytes(15), None), ("h", b"", None)]
    flows = spark.createDataFrame([(n, bytearray(a)) for n, a, _ in addresses], "name string, SrcAddr binary")
    got = {r["name"]: r.asn for r in analytics.longest_prefix_match(flows, prefixes, "SrcAddr").collect()}
    assert got == {n: want for n, _, want in addresses}
    big, small = spark.range(100).withColumn("k", F.col("id") % 7), spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    for limit in (1 << 20, 0):  # broadcast and shuffle give the same
        joined = join_small(big, settle(small), ["k"], limit=limit)
        assert joined.count() == 100 and joined.where("v IS NULL").count() == 28


def test_sessions_over_slots_equal_one_pass(spark):
    import random
    rng = random.Random(4)
    rows, t = [], {"hot": 0, "cold": 0, None: 0}
    for _ in range(400):
        k = rng.choice(["hot", "hot", "hot", "cold", None])
        t[k] += rng.choice([1, 60, 299, 300, 301, 3000, 7300])
        rows.append((k, t[k]))
    rows += rows[:20]
    flows = spark.createDataFrame(rows, "user string, s long").selectExpr(
        "user", "timestamp_seconds(s) AS event_time", "s AS Bytes", "1L AS Packets", "2L AS SamplingRate")
    want = []
    for k in t:
        last = None
        for s in sorted(s for u, s in rows if u == k):
            if last is None or s > last + 300:
                want.append([k, s, s, 0, 0])
            want[-1][2], want[-1][3], want[-1][4] = s + 300, want[-1][3] + 2 * s, want[-1][4] + 1
            last = s
    got = analytics.session_volume(flows, ["user"]).selectExpr(
        "user", "unix_seconds(session_start) AS a", "unix_seconds(session_end) AS b", "bytes", "flows").collect()
    assert sorted(map(str, [[r.user, r.a, r.b, int(r.bytes), r.flows] for r in got])) == sorted(map(str, want))


def test_a_dictionary_that_repeats_a_key_does_not_multiply_flows(spark):
    flows = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    dictionary = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, name string")
    assert sorted(map(tuple, analytics.enrich(flows, dictionary, ["k"]).collect())) == [(1, 10, "b"), (2, 20, "c"), (3, 30, None)]
