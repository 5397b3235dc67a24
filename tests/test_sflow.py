import struct

from pyspark.sql import functions as F

from packetloom.functions.text import ip_text, mac_text
from packetloom.operators import sflow
from packetloom.operators.sflow_flows import flows_from_sflow
from tests.wire import (ethernet, expanded_flow_sample, flow_sample, gateway, ipv4, ipv6, packets, raw, router,
                        switch, tcp, tlv, v4)
from tests.wire import sflow as datagram

ADDRESSES = ["SrcAddr", "DstAddr", "NextHop", "SrcAddrEncap", "DstAddrEncap", "SamplerAddress"]


def flows(spark, payloads, **kw):
    df = flows_from_sflow(packets(spark, payloads, "sFlow"), **kw)
    text = {c: ip_text(F.col(c)) for c in ADDRESSES} | {c: mac_text(F.col(c)) for c in ("SrcMac", "DstMac")}
    return [r.asDict() for r in df.withColumns(text).orderBy("packet_id", "InIf").collect()]


def check(got, wanted):
    assert len(got) == len(wanted)
    for i, (row, want) in enumerate(zip(got, wanted)):
        assert {k: row[k] for k in want} == want, i


def udp(sport, dport):
    return struct.pack(">HHHH", sport, dport, 8, 0)


def mpls(*labels):
    n = len(labels)
    return b"".join(struct.pack(">I", (label << 12) | ((i == n - 1) << 8) | ttl) for i, (label, ttl) in enumerate(labels))


def gre(etype):
    return struct.pack(">HH", 0, etype)


OUTER = {"SrcAddr": "172.16.32.254", "DstAddr": "172.16.32.241", "Proto": 47, "IPTTL": 124, "FragmentId": 23_559}


def test_flow_sample(spark):
    ping = ethernet(0x8100, b"\0\x20\x08\0", ipv4(1), b"\x08\0" + bytes(44))
    check(flows(spark, [datagram(flow_sample(raw(ping)))]), [{
        "Type": 1, "SamplerAddress": "172.16.0.17", "SequenceNum": 426, "SamplingRate": 2048, "InIf": 1194,
        "OutIf": 1043, "Bytes": 82, "Packets": 1, "DstMac": "00:ff:12:34:35:1b", "SrcMac": "ff:ab:cd:ef:ab:64",
        "VlanId": 32, "Etype": 0x800, "SrcAddr": "172.16.32.254", "DstAddr": "172.16.32.241", "Proto": 1,
        "IPTTL": 124, "FragmentId": 23_559, "IcmpType": 8, "IcmpCode": 0, "HasEncap": False, "SrcAddrEncap": "<nil>",
        "TimeFlowStart": 1714564800, "TimeFlowEnd": 1714564800}])


def test_dissection(spark):
    cases = [
        # plain TCP over IPv6
        (ethernet(0x86DD, ipv6(6, bytes.fromhex("fd010000ff018210cdffff1c00000150"),
                               bytes.fromhex("fd010000ff01000102ffff9300000246")), tcp(53_194, 80)),
         {"Etype": 0x86DD, "SrcAddr": "fd01:0:ff01:8210:cdff:ff1c:0:150", "DstAddr": "fd01:0:ff01:1:2ff:ff93:0:246",
          "IPTos": 2, "IPTTL": 64, "IPv6FlowLabel": 967_916, "Proto": 6, "SrcPort": 53_194, "DstPort": 80,
          "TCPFlags": 24, "FragmentId": 0}),
        (ethernet(0x800, ipv4(17, tos=24, frag=16_384), udp(53, 54)),
         {"Proto": 17, "SrcPort": 53, "DstPort": 54, "TCPFlags": 0, "IPTos": 24, "FragmentOffset": 16_384}),
        (ethernet(0x86DD, ipv6(58), b"\x87\x05"), {"IcmpType": 0x87, "IcmpCode": 5, "Proto": 58}),
        # the whole tag is kept, priority bits included; a second tag is not entered
        (ethernet(0x8100, b"\x60\x05\x81\0", b"\0\6\x08\0", ipv4(6)), {"VlanId": 0x6005, "Etype": 0x8100, "Proto": 0}),
        (ethernet(0x8100, b"\x60\x05\x81"), {"VlanId": 0, "Etype": 0x8100}),
        (ethernet(0x806, bytes(28)), {"Etype": 0x806, "Proto": 0, "SrcAddr": "<nil>"}),
        # header cut inside IP, inside L4
        (ethernet(0x800, ipv4(6)[:19]), {"Etype": 0x800, "Proto": 0, "SrcAddr": "<nil>"}),
        (ethernet(0x800, ipv4(6), b"\0\1\0"), {"Proto": 6, "SrcPort": 0, "DstPort": 0}),
        (ethernet(0x800, ipv4(6), b"\0\1\0\2"), {"SrcPort": 1, "DstPort": 2, "TCPFlags": 0}),
        # MPLS
        (ethernet(0x8847, mpls((100, 9)), ipv4(6), tcp(1, 2)),
         {"HasMPLS": True, "MPLSCount": 1, "MPLS1Label": 100, "MPLS1TTL": 9, "Etype": 0x800, "SrcPort": 1}),
        (ethernet(0x8847, mpls((100, 9), (200, 8), (300, 7), (400, 6), (500, 5)), ipv6(6), tcp(1, 2)),
         {"MPLSCount": 5, "MPLS2Label": 200, "MPLS3Label": 300, "MPLS3TTL": 7, "MPLSLastLabel": 500, "MPLSLastTTL": 5,
          "Etype": 0x86DD, "DstPort": 2}),
        (ethernet(0x8847, struct.pack(">I", (3 << 12) | 4), ipv4(17), udp(7, 8)),  # reserved label ends the stack
         {"MPLSCount": 1, "MPLS1Label": 3, "MPLS1TTL": 4, "SrcPort": 7, "MPLSLastLabel": 0}),
        (ethernet(0x8847, mpls((100, 9))), {"HasMPLS": True, "MPLSCount": 0, "Etype": 0x8847}),
        (ethernet(0x8847, mpls((100, 9)), b"\x10"), {"MPLSCount": 1, "Etype": 0x8847}),
        # GRE
        (ethernet(0x800, ipv4(47), gre(0x800), ipv4(6, "10.0.0.1", "10.0.0.2", ttl=3, ident=4), tcp(1, 2)),
         OUTER | {"HasEncap": True, "SrcAddrEncap": "10.0.0.1", "DstAddrEncap": "10.0.0.2", "ProtoEncap": 6,
                  "IPTTLEncap": 3, "FragmentIdEncap": 4, "Etype": 0x800, "EtypeEncap": 0x800, "SrcPort": 1,
                  "TCPFlags": 24}),
        (ethernet(0x800, ipv4(47), gre(0x86DD), ipv6(6), tcp(1, 2)),
         OUTER | {"HasEncap": True, "SrcAddrEncap": "::1", "ProtoEncap": 6, "IPv6FlowLabelEncap": 967_916,
                  "IPv6FlowLabel": 0, "FragmentIdEncap": 23_559, "Etype": 0x86DD, "EtypeEncap": 0x800}),
        (ethernet(0x800, ipv4(47), gre(0x6558), bytes(30)), OUTER | {"HasEncap": False, "EtypeEncap": 0x6558, "Etype": 0x800}),
        # inner header cut: the tunnel counts, the inner values stay the outer ones
        (ethernet(0x800, ipv4(47), gre(0x800), b"\x45"),
         OUTER | {"HasEncap": True, "SrcAddrEncap": "172.16.32.254", "ProtoEncap": 47}),
        # PPTP
        (ethernet(0x800, ipv4(47), gre(0x880B), bytes(8), b"\xff\x03\0\x21", ipv4(17, "10.0.0.1"), udp(5, 6)),
         OUTER | {"HasEncap": True, "HasPPP": True, "PPPAddressControl": 0xFF03, "SrcAddrEncap": "10.0.0.1",
                  "Etype": 0x800, "EtypeEncap": 0x800, "DstPort": 6}),
        (ethernet(0x800, ipv4(47), gre(0x880B), bytes(8), b"\xff\x03\xc0\x21", bytes(3)),
         OUTER | {"HasEncap": False, "HasPPP": True, "EtypeEncap": 0x880B}),
        (ethernet(0x800, ipv4(47), gre(0x880B), bytes(11)), OUTER | {"HasPPP": False, "EtypeEncap": 0x880B}),
        # a tunnel in a tunnel is noted, not entered
        (ethernet(0x800, ipv4(47), gre(0x800), ipv4(47, "10.0.0.1"), gre(0x86DD), ipv6(6)),
         {"HasEncap": True, "SrcAddr": "10.0.0.1", "SrcAddrEncap": "10.0.0.1", "Proto": 47, "ProtoEncap": 47,
          "Etype": 0x86DD, "EtypeEncap": 0x800}),
    ]
    check(flows(spark, [datagram(flow_sample(raw(h))) for h, _ in cases]), [w for _, w in cases])
    swapped = [(h, w) for h, w in cases if w.get("HasEncap")]
    got = flows(spark, [datagram(flow_sample(raw(h))) for h, _ in swapped[:2]], decode_gre=True)
    check(got, [
        {"SrcAddr": "10.0.0.1", "Proto": 6, "IPTTL": 3, "SrcAddrEncap": "172.16.32.254", "ProtoEncap": 47,
         "Etype": 0x800, "SrcPort": 1},
        {"SrcAddr": "::1", "Proto": 6, "IPv6FlowLabel": 967_916, "SrcAddrEncap": "172.16.32.254", "Etype": 0x86DD,
         "EtypeEncap": 0x800, "FragmentId": 23_559}])


def test_several_headers_of_one_sample(spark):
    icmp = raw(ethernet(0x800, ipv4(1), b"\x08\x03"))
    plain = raw(ethernet(0x800, ipv4(6), tcp(1, 2)))
    tag = raw(ethernet(0x8100, b"\0\x20\x08\0", ipv4(17), udp(7, 8)))
    deep = raw(ethernet(0x800, ipv4(47), gre(0x86DD), ipv6(58), b"\x87\x05"))
    many = [switch(1, 2)] * 9
    last = {"Proto": 6, "SrcPort": 1, "TCPFlags": 24}
    cases = [
        ([icmp, plain], last | {"IcmpType": 8, "IcmpCode": 3, "VlanId": 0}),
        ([tag, plain], last | {"VlanId": 32, "Etype": 0x800, "IcmpType": 0}),
        ([icmp, tag, plain], last | {"IcmpType": 8, "IcmpCode": 3, "VlanId": 32}),
        ([icmp, deep, plain], last | {"IcmpType": 0x87, "IcmpCode": 5, "HasEncap": False}),
        ([deep, icmp], {"IcmpType": 8, "IcmpCode": 3, "Proto": 1, "HasEncap": False}),
        ([plain, icmp], {"IcmpType": 8, "IcmpCode": 3, "SrcPort": 0, "TCPFlags": 0}),
        ([icmp, raw(b"short"), raw(b"x" * 20, protocol=11)], {"IcmpType": 8, "IcmpCode": 3, "Proto": 1}),
        ([icmp, tag, *many, plain], last | {"IcmpType": 8, "VlanId": 32, "SrcVlan": 1}),
    ]
    check(flows(spark, [datagram(flow_sample(*r)) for r, _ in cases]), [w for _, w in cases])


def test_records_fold_in_order(spark):
    ip_record = tlv(3, struct.pack(">II4s4sIIII", 500, 17, v4("1.1.1.1"), v4("2.2.2.2"), 5, 6, 3, 9))
    ip6_record = tlv(4, struct.pack(">II", 600, 6) + bytes(15) + b"\1" + bytes(15) + b"\2" + struct.pack(">IIII", 7, 8, 0, 4))
    frame = raw(ethernet(0x800, ipv4(6), tcp(1, 2)))
    cases = [
        ([ip_record], {"Bytes": 500, "Proto": 17, "SrcAddr": "1.1.1.1", "SrcPort": 5, "DstPort": 6, "IPTos": 9,
                       "Etype": 0x800, "TCPFlags": 0}),
        ([ip6_record], {"Bytes": 600, "SrcAddr": "::1", "DstAddr": "::2", "IPTos": 4, "Etype": 0x86DD}),
        ([frame, ip_record], {"Bytes": 500, "SrcAddr": "1.1.1.1", "TCPFlags": 24, "IPTTL": 124}),
        ([ip_record, frame], {"Bytes": 82, "SrcAddr": "172.16.32.254", "SrcPort": 1}),
        ([ip_record, raw(b"x" * 20, protocol=11)], {"Bytes": 82, "SrcAddr": "1.1.1.1"}),
        ([raw(b"short")], {"Bytes": 82, "SrcMac": "00:00:00:00:00:00"}),
        ([switch(5, 6), router(v4("9.9.9.9"), 24, 16)], {"SrcVlan": 5, "DstVlan": 6, "NextHop": "9.9.9.9", "SrcNet": 24, "DstNet": 16}),
        ([gateway(v4("8.8.8.8"), 65001, 65002, [11, 12, 13], [1, 2])],
         {"NextHop": "8.8.8.8", "SrcAS": 65001, "DstAS": 13, "NextHopAS": 11}),
        ([gateway(bytes(15) + b"\5", 65001, 65002, [])], {"NextHop": "::5", "SrcAS": 65002, "DstAS": 65001, "NextHopAS": 0}),
        ([gateway(v4("8.8.8.8"), 1, 2, [5]), router(v4("9.9.9.9"), 24, 16)], {"NextHop": "9.9.9.9", "DstAS": 5}),
        ([router(v4("9.9.9.9"), 24, 16), gateway(v4("8.8.8.8"), 1, 2, [5])], {"NextHop": "8.8.8.8", "SrcNet": 24}),
        ([gateway(v4("8.8.8.8"), 1, 2, [5], path_length=400)], {"NextHop": "<nil>", "DstAS": 0}),
        ([gateway(v4("8.8.8.8"), 1, 2, [5]), gateway(v4("7.7.7.7"), 3, 4, [6], path_length=400)],
         {"NextHop": "8.8.8.8", "DstAS": 5, "SrcAS": 1}),
        ([gateway(v4("8.8.8.8"), 1, 2, [5]), gateway(v4("7.7.7.7"), 3, 4, [])], {"NextHop": "7.7.7.7", "DstAS": 3, "SrcAS": 4, "NextHopAS": 5}),
        ([switch(n, n) for n in range(1, 7)], {"SrcVlan": 6}),           # more records than are unrolled
        ([tlv(1001, b"short"), switch(5, 6)], {"SrcVlan": 5}),           # a cut record is skipped
        ([tlv(77, bytes(20)), switch(5, 6)], {"SrcVlan": 5}),            # so is an unknown one
        ([tlv(1001, bytes(16), length=999), switch(5, 6)], {"SrcVlan": 0, "Packets": 1}),  # an overlong one ends the sample
        ([], {"Bytes": 0, "Packets": 1}),
    ]
    check(flows(spark, [datagram(flow_sample(*r)) for r, _ in cases]), [w for _, w in cases])


def test_samples(spark):
    vlan = flow_sample(switch(5, 6))
    cases = [
        [expanded_flow_sample(switch(30, 31))],
        [tlv(1, b"cut"), vlan],                       # undecodable sample: skipped, the packet survives
        [tlv(9, bytes(40)), vlan],
        [flow_sample(switch(1, 1), count=8192), vlan],
        [tlv(1, bytes(40), length=5000), vlan],       # claims more than there is: the rest is not read
    ]
    got = flows(spark, [datagram(*c) for c in cases] + [datagram(vlan, vlan, count=1), datagram(vlan, count=2**32 - 1),
                                                        datagram(vlan, agent=bytes(15) + b"\x07"),
                                                        datagram(*[flow_sample(switch(9, 9), in_if=n) for n in range(7)])])
    check(got, [{"SrcVlan": 30, "InIf": 1_000_100, "OutIf": 1_000_018, "SamplingRate": 16_383}, {"SrcVlan": 5},
                {"SrcVlan": 5}, {"SrcVlan": 5}, {"SrcVlan": 5}, {"SrcVlan": 5}, {"SamplerAddress": "::7"},
                *[{"SrcVlan": 9, "InIf": n} for n in range(7)]])


def test_packet_errors(spark):
    sent = [b"", b"\0\0\0\4" + bytes(40), b"\0\0\0\5", datagram(ip_version=3), datagram()[:20], datagram()]
    got = sflow.read_headers(packets(spark, sent, "sFlow")).orderBy("packet_id").select("error").collect()
    assert [r.error for r in got] == ["error_decoding", "error_version", "error_decoding", "error_ip_version",
                                      "error_decoding", None]


def test_counters(spark):
    def counter(fmt, *records, count=None):
        source = struct.pack(">II", 3, (2 << 24) | 17) if fmt == 2 else struct.pack(">III", 3, 2, 17)
        return tlv(fmt, source + struct.pack(">I", len(records) if count is None else count) + b"".join(records))

    values = list(range(1, 20))
    sizes = [n for _, n in sflow.IF_COUNTERS]
    if_record = tlv(1, b"".join(v.to_bytes(n, "big") for v, n in zip(values, sizes)))
    eth_record = tlv(2, b"".join(struct.pack(">I", v) for v in range(1, 14)))
    sent = [datagram(counter(2, if_record, eth_record), counter(4, eth_record, if_record, tlv(9, b"")),
                     counter(2, if_record, count=512), counter(2, tlv(1, b"cut")))]
    samples = sflow.read_samples(sflow.read_headers(packets(spark, sent, "sFlow")))
    got = sflow.interface_counters(samples).orderBy("sample_idx").collect()
    assert [[r[n] for n, _ in sflow.IF_COUNTERS] for r in got] == [values, values, [0] * 19]
    assert [(r.source_type, r.source_id) for r in got] == [(2, 17)] * 3
    got = sflow.ethernet_counters(samples).collect()
    assert [[r[n] for n, _ in sflow.ETHERNET_COUNTERS] for r in got] == [list(range(1, 14))] * 2


def test_record_table(spark):
    ip6 = tlv(4, struct.pack(">II", 600, 6) + bytes(15) + b"\1" + bytes(15) + b"\2" + struct.pack(">IIII", 7, 8, 2, 4))
    sent = [datagram(flow_sample(switch(5, 6), raw(b"abc"), gateway(v4("8.8.8.8"), 1, 2, [11, 12], [21, 22, 23]), ip6,
                                 router(v4("9.9.9.9"), 24, 16), tlv(1001, b"")))]
    df = sflow.flow_records(sflow.read_samples(sflow.read_headers(packets(spark, sent, "sFlow"))))
    got = df.orderBy("record_idx").collect()
    assert got[0].switch.asDict() == {"src_vlan": 5, "src_priority": 0, "dst_vlan": 6, "dst_priority": 0}
    assert (bytes(got[1].raw.header), got[1].raw.original_length) == (b"abc", 78)
    assert (got[2].gateway.as_path, got[2].gateway.communities, got[2].gateway.local_pref) == ([11, 12], [21, 22, 23], 100)
    assert (got[3].ipv6.src_port, got[3].ipv6.priority, bytes(got[3].ipv6.dst)) == (7, 4, bytes(15) + b"\2")
    assert (bytes(got[4].router_ext.next_hop), got[4].router_ext.dst_mask_len) == (bytes([9, 9, 9, 9]), 16)
    assert [c for c in ("raw", "ipv4", "ipv6", "switch", "router_ext", "gateway") if got[5][c] is not None] == []
