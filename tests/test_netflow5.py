import struct

from pyspark.sql import functions as F

from packetloom.functions.text import ip_text
from packetloom.operators.netflow5 import flows_from_netflow5, read_headers
from packetloom.schema import FLOW_COLUMNS
from tests.wire import netflow5, packets, record5

UP, BASE = 8_569_672, 1_540_209_179
RECORDS = [
    record5("10.128.2.121", "10.128.2.1", 9, 2, 5, 590, 8_559_500, 8_559_504, 8080, 47_384, 27),
    record5("10.128.2.119", "10.129.2.1", 7, 1, 2, 148, 8_557_993, 8_559_355, 8080, 49_452, 18, tos=3, src_as=64_512,
            dst_as=65_535, src_mask=24, dst_mask=16, next_hop="1.2.3.4"),
]


def test_records(spark):
    df = flows_from_netflow5(packets(spark, [netflow5(RECORDS, sampling=0x4064)], "NetFlowV5"))
    assert df.columns[:63] == FLOW_COLUMNS
    got = [r.asDict() for r in df.withColumns({c: ip_text(F.col(c)) for c in ("SrcAddr", "DstAddr", "NextHop", "SamplerAddress")}
                                              ).orderBy("InIf", ascending=False).collect()]
    for row, want in zip(got, [
        {"Type": 2, "SequenceNum": 25_661, "SamplingRate": 0x4064, "SamplerAddress": "192.0.2.1", "SrcAddr": "10.128.2.121",
         "DstAddr": "10.128.2.1", "InIf": 9, "OutIf": 2, "Packets": 5, "Bytes": 590, "SrcPort": 8080, "DstPort": 47_384,
         "TCPFlags": 27, "Proto": 6, "Etype": 0x800, "TimeFlowStart": 1_540_209_169, "TimeFlowEnd": 1_540_209_169,
         "TimeReceived": 1_714_564_800, "NextHop": "0.0.0.0", "HasMPLS": False, "is_padding": False},
        {"TimeFlowStart": 1_540_209_168, "IPTos": 3, "SrcAS": 64_512, "DstAS": 65_535, "SrcNet": 24, "DstNet": 16,
         "NextHop": "1.2.3.4"}]):
        assert {k: row[k] for k in want} == want


def test_guards_padding_and_wrap(spark):
    wrap = record5("1.1.1.1", "2.2.2.2", first=2**32 - 1000, last=0)
    sent = [netflow5(RECORDS, version=6), netflow5([], count=1366), b"\0", netflow5([]), netflow5(RECORDS, count=4)[:-10],
            netflow5([wrap], uptime=5_000)]
    table = packets(spark, sent, "NetFlowV5")
    assert [r.error for r in read_headers(table).orderBy("packet_id").collect()] == [
        "error_version", "error_decoding", "error_version", None, None, None]
    rows = flows_from_netflow5(table).orderBy("packet_id", "is_padding").collect()
    assert [(r.packet_id, r.is_padding) for r in rows] == [(4, False), (4, True), (4, True), (4, True), (5, False)]
    assert (bytes(rows[1].SrcAddr), rows[1].Bytes, rows[1].TimeFlowStart) == (bytes(4), 0, BASE - UP // 1000)
    assert (rows[4].TimeFlowStart, rows[4].TimeFlowEnd) == (BASE - 6, BASE - 5)


def test_random_cuts_never_raise(spark):
    whole = netflow5(RECORDS)
    table = packets(spark, [whole[:n] for n in range(0, len(whole), 7)], "NetFlowV5")
    heads = read_headers(table)
    assert heads.count() == len(range(0, len(whole), 7))
    flows_from_netflow5(table).collect()
