"""Captured packets, byte by byte, against the flows they must give."""

from pyspark.sql import functions as F

from packetloom.functions.text import ip_text, mac_text
from packetloom.operators.netflow5 import flows_from_netflow5
from packetloom.operators.sflow_flows import flows_from_sflow
from tests.wire import packets

# One captured NetFlow v5 packet with six records.
V5_CAPTURE = bytes.fromhex("""
0005 0006 0082c348 5bcdba1b 05976dc7 0000643d 0808 0000
0a800279 0a800201 00000000 0009 0002 00000005 0000024e 00829b8c 00829b90 1f90 b918 001b0600 0000 0000 0000 0000
0a800277 0a810201 00000000 0007 0001 00000002 00000094 008295a9 00829afb 1f90 c12c 00120600 0000 0000 0000 0000
0a810201 0a800277 00000000 0001 0007 00000003 000000c2 008295a9 00829afc c12c 1f90 00160600 0000 0000 0000 0000
0a800201 0a800279 00000000 0002 0009 00000005 000001f1 00829b8c 00829b8f b918 1f90 001b0600 0000 0000 0000 0000
0a800201 0a800279 00000000 0002 0009 00000005 0000022e 00829b90 00829b9d b91a 1f90 001b0600 0000 0000 0000 0000
0a800279 0a800201 00000000 0009 0002 00000005 00000bac 00829b90 00829b9d 1f90 b91a 001b0600 0000 0000 0000 0000
""")

# One captured sFlow packet with one flow sample of a tagged ICMP frame.
SFLOW_CAPTURE = bytes.fromhex("""
00000005 00000001 ac100011 00000001 000001aa 67eeaa01 00000001
00000001 00000088 00000006 00000413 00000800 00003000 00000000 000004aa 00000413 00000001
00000001 00000060 00000001 00000052 00000004 0000004e
00ff1234351b ffabcdefab64 8100 0020 0800
4500003c 5c070000 7c0148a0 ac1020fe ac1020f1
08009761 a9480cb2 6162636465666768696a6b6c6d6e6f7071727374757677616263646566676869 0000
""")


def test_captured_netflow_v5(spark):
    df = flows_from_netflow5(packets(spark, [V5_CAPTURE], "NetFlowV5"))
    assert len(V5_CAPTURE) == 312
    columns = ["InIf", "OutIf", "Packets", "Bytes", "SrcPort", "DstPort", "TCPFlags", "TimeFlowStart", "TimeFlowEnd"]
    got = sorted(map(tuple, df.select(ip_text(F.col("SrcAddr")), ip_text(F.col("DstAddr")), *columns).collect()))
    assert got == sorted([
        ("10.128.2.121", "10.128.2.1", 9, 2, 5, 590, 8080, 47384, 27, 1540209169, 1540209169),
        ("10.128.2.119", "10.129.2.1", 7, 1, 2, 148, 8080, 49452, 18, 1540209168, 1540209169),
        ("10.129.2.1", "10.128.2.119", 1, 7, 3, 194, 49452, 8080, 22, 1540209168, 1540209169),
        ("10.128.2.1", "10.128.2.121", 2, 9, 5, 497, 47384, 8080, 27, 1540209169, 1540209169),
        ("10.128.2.1", "10.128.2.121", 2, 9, 5, 558, 47386, 8080, 27, 1540209169, 1540209169),
        ("10.128.2.121", "10.128.2.1", 9, 2, 5, 2988, 8080, 47386, 27, 1540209169, 1540209169)])
    rest = df.select("Proto", "IPTos", "SrcAS", "DstAS", "SrcNet", "DstNet", "Etype", "SamplingRate", "SequenceNum").distinct()
    assert [tuple(r) for r in rest.collect()] == [(6, 0, 0, 0, 0, 0, 0x800, 0, 25661)]


def test_captured_sflow_sample(spark):
    flow = flows_from_sflow(packets(spark, [SFLOW_CAPTURE], "sFlow")).withColumns(
        {c: ip_text(F.col(c)) for c in ("SrcAddr", "DstAddr", "SamplerAddress")} | {
            c: mac_text(F.col(c)) for c in ("SrcMac", "DstMac")}).first().asDict()
    want = {"SamplerAddress": "172.16.0.17", "SequenceNum": 426, "SamplingRate": 2048, "InIf": 1194, "OutIf": 1043, "Bytes": 82,
            "Packets": 1, "DstMac": "00:ff:12:34:35:1b", "SrcMac": "ff:ab:cd:ef:ab:64", "VlanId": 32, "Etype": 0x800,
            "SrcAddr": "172.16.32.254", "DstAddr": "172.16.32.241", "Proto": 1, "IPTTL": 124, "FragmentId": 23559,
            "IcmpType": 8, "IcmpCode": 0}
    assert {k: flow[k] for k in want} == want
