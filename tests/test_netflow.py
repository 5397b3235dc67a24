import struct

import pytest
from pyspark.sql import functions as F

from packetloom.operators.netflow_flows import flows_from_netflow, resolve
from packetloom.operators.netflow_sets import frame
from tests.wire import fset, ipfix, ipfix_options, packets, template, v9, v9_options

BASIC = [(8, 4), (12, 4), (1, 4), (2, 4), (7, 2), (11, 2), (4, 1)]


def basic(i):
    return struct.pack(">4s4sIIHHB", bytes([10, 0, 0, i]), bytes([10, 0, 1, i]), 100 + i, i, 1000 + i, 80, 6)


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("packet_id", *cols).select(*cols).collect()]


def errors(spark, *payloads, **kw):
    return [r.error for r in resolve(packets(spark, payloads), **kw).orderBy("packet_id").select("error").collect()]


def each_alone(payloads):
    """Every payload from a router of its own, so that one job checks many independent packets."""
    return [(p, bytes([198, 51, i // 256, i % 256])) for i, p in enumerate(payloads)]


def test_one_field_record(spark):
    for make, sid, kind in ((v9, 0, 3), (ipfix, 2, 4)):
        p = make(fset(sid, template(300, [(8, 4)])), fset(300, bytes([10, 0, 0, 1])))
        flow = flows_from_netflow(packets(spark, [p]), sampling_rate=1).first()
        assert (flow.Type, bytes(flow.SrcAddr), flow.Etype, flow.SamplingRate) == (kind, b"\x0a\0\0\x01", 0x800, 1)
        assert flow.Bytes == 0 and bytes(flow.DstAddr) == b"" and flow.HasEncap is False


def test_records_padding_and_later_packets(spark):
    first = v9(fset(0, template(300, BASIC)), fset(300, basic(1) + basic(2) + b"\0\0\0"))
    second = v9(fset(300, basic(3)), seq=8)
    got = rows(flows_from_netflow(packets(spark, [first, second])), "Bytes", "SrcPort", "SequenceNum")
    assert got == [(101, 1001, 7), (102, 1002, 7), (103, 1003, 8)]


def test_template_is_looked_up_as_of_arrival(spark):
    old = v9(fset(0, template(300, [(1, 4), (2, 4)])))
    new = v9(fset(0, template(300, [(2, 4), (1, 4)])))
    data = v9(fset(300, struct.pack(">II", 5, 9)))
    got = rows(flows_from_netflow(packets(spark, [data, old, data, old, data, new, data, new])), "Bytes", "Packets")
    assert got == [(5, 9), (5, 9), (9, 5)]


def test_templates_are_kept_per_router_version_and_domain(spark):
    tpl = fset(0, template(300, [(1, 4)]))
    data = fset(300, struct.pack(">I", 5))
    other = bytes([192, 0, 2, 2])
    sent = [v9(tpl, source=1), v9(data, source=2), (v9(data, source=1), other), ipfix(data, domain=1),
            v9(data, source=1)]
    assert [r.error for r in resolve(packets(spark, sent)).orderBy("packet_id").collect()] == [
        None, "template_not_found", "template_not_found", "template_not_found", None]


def test_missing_template_rejects_the_whole_packet(spark):
    p = v9(fset(0, template(300, [(1, 4)])), fset(300, struct.pack(">I", 5)), fset(999, b"abcd"))
    later = v9(fset(300, struct.pack(">I", 6)))
    df = flows_from_netflow(packets(spark, [p, later]))
    assert rows(df, "packet_id", "Bytes") == [(1, 6)]
    assert errors(spark, p, later) == ["template_not_found", None]


def test_template_behind_a_failing_set_is_not_learnt(spark):
    p = v9(fset(999, b"abcd"), fset(0, template(300, [(1, 4)])))
    later = v9(fset(300, struct.pack(">I", 6)))
    # 301 is only announced behind a set that waits for 300
    chained = v9(fset(300, b"abcd"), fset(0, template(301, [(1, 4)])))
    last = v9(fset(301, b"abcd"))
    assert errors(spark, p, later, chained, last) == ["template_not_found"] * 4


def test_framing_errors(spark):
    tpl = fset(0, template(300, [(1, 4)]))
    assert errors(spark, *each_alone([
        struct.pack(">HH", 8, 0),                       # neither 9 nor 10
        v9(tpl, fset(5, b"abcd")),                      # reserved id
        v9(tpl + b"\0\0\0", count=2),                   # bytes left over
        v9(fset(300, b"", length=3)),                   # length below its own header
        v9(fset(0, template(300, []))),                 # template without fields
        ipfix(fset(3, struct.pack(">HHH", 300, 1, 2))),  # more scopes than fields
        v9(tpl, fset(5, b"abcd"), count=1),             # walk ends at the header's count
        v9(),
    ])) == ["error_version", "error_flow_id", "error_decoding", "error_decoding", "error_decoding", "error_decoding",
          None, None]


def test_templates_before_a_framing_error_stay(spark):
    bad = v9(fset(0, template(300, [(1, 4)])), fset(5, b""))
    assert errors(spark, bad, v9(fset(300, b"abcd"))) == ["error_flow_id", None]


def test_zero_count_discards_its_whole_set(spark):
    bad = v9(fset(0, template(300, [(1, 4)]) + template(301, [])))
    assert errors(spark, bad, v9(fset(300, b"abcd"))) == ["error_decoding", "template_not_found"]


def test_empty_template_yields_no_records(spark):
    p = v9(fset(0, template(300, [(1, 0)])), fset(300, b"abcd"))
    assert errors(spark, p) == ["empty_template"]
    assert flows_from_netflow(packets(spark, [p])).count() == 0


def test_many_sets(spark):
    tpl = fset(0, template(300, [(1, 4)]))
    p = ipfix(fset(2, template(300, [(1, 4)])), *[fset(300, struct.pack(">I", i)) for i in range(40)])
    assert rows(flows_from_netflow(packets(spark, [p])), "Bytes") == [(i,) for i in range(40)]
    assert len(frame(packets(spark, [p])).first().sets) == 41
    q = v9(tpl, *[fset(300, struct.pack(">I", i)) for i in range(40)], count=20)
    assert flows_from_netflow(packets(spark, [q])).count() == 19


def test_truncated_last_set_is_read_as_far_as_it_goes(spark):
    p = v9(fset(0, template(300, [(1, 4)])), fset(300, struct.pack(">II", 5, 6), length=4000))
    assert rows(flows_from_netflow(packets(spark, [p])), "Bytes") == [(5,), (6,)]


def test_truncated_template_keeps_the_fields_it_has(spark):
    cut = fset(0, template(300, [(1, 4), (2, 4)])[:-4])
    assert rows(flows_from_netflow(packets(spark, [v9(cut), v9(fset(300, struct.pack(">II", 5, 6)))])), "Bytes") == [
        (5,), (6,)]


def test_last_field_wins_and_oversized_numbers_are_ignored(spark):
    cases = [
        ([(1, 4), (23, 4)], struct.pack(">II", 5, 6), {"Bytes": 6}),
        ([(1, 4), (23, 9)], struct.pack(">I9s", 5, b"x" * 9), {"Bytes": 5}),
        ([(7, 8)], struct.pack(">Q", (3 << 32) + 9), {"SrcPort": 9}),
        ([(1, 8)], b"\xff" * 8, {"Bytes": -1}),
        ([(1, 3)], b"\x01\x02\x03", {"Bytes": 66051}),
        ([(1, 4), (1, 0)], b"\0\0\0\5", {"Bytes": 0}),
        ([(8, 4), (28, 16)], bytes(20), {"Etype": 0x86DD}),
        ([(28, 16), (8, 4)], bytes(20), {"Etype": 0x800}),
        ([(15, 4), (63, 16)], b"\1\2\3\4" + b"n" * 16, {"NextHop": b"n" * 16}),
        ([(32, 2)], b"\x08\x03", {"IcmpType": 8, "IcmpCode": 3}),
        ([(32, 1)], b"\x08", {"IcmpType": 0, "IcmpCode": 8}),
        ([(32, 2), (178, 1)], b"\x08\x03\x07", {"IcmpType": 7, "IcmpCode": 3}),
        ([(176, 1), (139, 9)], b"\x08" + b"x" * 9, {"IcmpType": 0, "IcmpCode": 0}),
        ([(88, 2), (197, 1), (88, 2)], struct.pack(">HBH", 0x100, 2, 0x4), {"FragmentOffset": 0x106}),
        ([(58, 2), (59, 2)], struct.pack(">HH", 5, 6), {"VlanId": 5, "SrcVlan": 5, "DstVlan": 6}),
        ([(56, 6), (57, 6)], b"\0\1\2\3\4\5" + b"\xff" * 6, {"SrcMac": 0x0102030405, "DstMac": (1 << 48) - 1}),
        ([(234, 4), (235, 4), (239, 1), (61, 1)], struct.pack(">IIBB", 1, 2, 3, 4),
         {"IngressVrfID": 1, "EgressVrfID": 2, "BiFlowDirection": 3, "FlowDirection": 4}),
    ]
    sent = each_alone([ipfix(fset(2, template(300, fields)), fset(300, body)) for fields, body, _ in cases])
    got = flows_from_netflow(packets(spark, sent)).orderBy("packet_id").collect()
    assert len(got) == len(cases)
    for row, (fields, _, want) in zip(got, cases):
        have = {k: bytes(row[k]) if isinstance(row[k], bytearray) else row[k] for k in want}
        assert have == want, fields


def test_times(spark):
    base = 1_700_000_000
    v9_cases = [([(22, 4), (21, 4)], struct.pack(">II", 4_000, 9_500), (base - 6, base)),
                ([(22, 4), (21, 4)], struct.pack(">II", 2**32 - 5_000, 10_000), (base - 15, base)),
                ([(21, 4)], struct.pack(">I", 10_000), (0, base))]
    ipfix_cases = [([(150, 4), (151, 4)], struct.pack(">II", 7, 8), (7, 8)),
                   ([(152, 8), (153, 8)], struct.pack(">QQ", 7_999, 8_000), (7, 8)),
                   ([(154, 8), (155, 8)], struct.pack(">QQ", 7_000_001, 8_000_000), (7, 8)),
                   ([(156, 8), (157, 8)], struct.pack(">QQ", 7 * 10**9, 2**64 - 1), (7, (2**64 - 1) // 10**9)),
                   ([(150, 4), (152, 9)], struct.pack(">I9s", 7, b"x" * 9), (7, 0)),
                   ([(22, 4), (158, 4)], struct.pack(">II", 7, 8), (0, 0))]
    sent = each_alone([v9(fset(0, template(300, f)), fset(300, body)) for f, body, _ in v9_cases]
                      + [ipfix(fset(2, template(300, f)), fset(300, body)) for f, body, _ in ipfix_cases])
    got = rows(flows_from_netflow(packets(spark, sent)), "TimeFlowStart", "TimeFlowEnd")
    assert got == [want for _, _, want in v9_cases + ipfix_cases]


@pytest.mark.parametrize("make,sid,options", [(v9, 1, v9_options), (ipfix, 3, ipfix_options)])
def test_sampling_rate_from_option_data(spark, make, sid, options):
    data_set = 0 if sid == 1 else 2
    setup = make(fset(data_set, template(300, [(1, 4)])), fset(sid, options(400, [(1, 4)], [(34, 4), (50, 4)])))
    before = make(fset(300, b"\0\0\0\1"))
    tell = make(fset(300, b"\0\0\0\2"), fset(400, struct.pack(">III", 1, 10, 20) + struct.pack(">III", 1, 30, 40)))
    after = make(fset(300, b"\0\0\0\3"))
    got = rows(flows_from_netflow(packets(spark, [setup, before, tell, after])), "Bytes", "SamplingRate")
    assert got == [(1, 0), (2, 20), (3, 20)]


def test_narrow_and_wide_sampling_options(spark):
    setup = v9(fset(0, template(300, [(1, 4)])), fset(1, v9_options(400, [(1, 4)], [(34, 2)])),
               fset(1, v9_options(401, [(1, 4)], [(305, 8)])))
    wide = v9(fset(401, struct.pack(">IQ", 1, (77 << 32) + 5)), fset(300, b"\0\0\0\1"))
    narrow = v9(fset(400, struct.pack(">IH", 1, 9)), fset(300, b"\0\0\0\2"))
    after = v9(fset(300, b"\0\0\0\3"))
    got = rows(flows_from_netflow(packets(spark, [setup, wide, narrow, after])), "Bytes", "SamplingRate")
    assert got == [(1, 77), (2, 0), (3, 0)]


def test_rejected_packet_tells_no_rate(spark):
    setup = v9(fset(0, template(300, [(1, 4)])), fset(1, v9_options(400, [], [(34, 4)])))
    bad = v9(fset(400, struct.pack(">I", 9)), fset(999, b""))
    after = v9(fset(300, b"\0\0\0\3"))
    assert rows(flows_from_netflow(packets(spark, [setup, bad, after])), "Bytes", "SamplingRate") == [(3, 0)]


def test_seeded_templates_and_rates(spark):
    from packetloom.operators.netflow_state import announcements, sampling_changes
    earlier = packets(spark, [v9(fset(0, template(300, [(1, 4)])), fset(1, v9_options(400, [], [(34, 4)]))),
                              v9(fset(400, struct.pack(">I", 9)))])
    known = announcements(frame(earlier))
    rates = sampling_changes(resolve(earlier))
    data = packets(spark, [v9(fset(300, b"\0\0\0\3"))], start=10)
    got = rows(flows_from_netflow(data, templates=known, sampling=rates), "Bytes", "SamplingRate")
    assert got == [(3, 9)]


def test_null_receive_times_keep_the_order_of_packets(spark):
    data, announce = v9(fset(300, b"abcd")), v9(fset(0, template(300, [(1, 4)])))
    sent = packets(spark, [data, announce, data]).withColumn("recv_time", F.lit(None).cast("timestamp"))
    got = [r.error for r in resolve(sent).orderBy("packet_id").select("error").collect()]
    assert got == ["template_not_found", None, None]


def test_equal_packet_numbers_of_other_exporters_stay_learnt(spark):
    # packet 0 of one router hides a template behind a missing one; packet 0 of another announces it plainly
    hidden = packets(spark, [v9(fset(999, b"abcd"), fset(0, template(300, [(1, 4)])))])
    plain = packets(spark, [v9(fset(1, v9_options(400, [], [(34, 4)])), fset(0, template(300, [(1, 4)]))),
                            v9(fset(300, b"abcd"))], src=bytes([192, 0, 2, 9]))
    rows_ = resolve(hidden.unionByName(plain)).orderBy("router", "packet_id").select("router", "error").collect()
    assert [r.error for r in rows_] == ["template_not_found", None, None]
