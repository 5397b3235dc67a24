"""Templates and rates of exporters that change them often, on both sides of the broadcast limit."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from packetloom.operators.netflow_flows import PACKET_COLUMNS, explode_records, project_flows, templates_in
from packetloom.operators.netflow_sets import frame
from packetloom.operators.netflow_state import (BUSY, PER_SLOT, attach_sampling, join_timeline, resolve_sets, sampling_timeline,
                                                telling_packets)
from packetloom.plans.tables import table_bytes
from tests.wire import fset, packets, template, v9, v9_options

ORDERS = [[(1, 4), (2, 4)], [(2, 4), (1, 4)], [(1, 4)], [(2, 4)]]


def history(seed, changes):
    """Payloads of one exporter that announces often, and (place, bytes, packets, rate) of the flows they give."""
    pick = random.Random(seed)
    sent, flows, known, rate = [v9(fset(1, v9_options(400, [], [(34, 4)])))], [], {}, 0
    for _ in range(changes):
        sid = pick.choice([300, 301, 302])
        known[sid] = pick.choice(ORDERS)
        sent.append(v9(fset(0, template(sid, known[sid]))))
        for _ in range(pick.randint(0, 2)):
            sid = pick.choice([300, 301, 302])
            a, b = pick.randint(1, 1000), pick.randint(1, 1000)
            if sid in known:
                fields = known[sid]
                values = dict(zip([f for f, _ in fields], (a, b), strict=False))
                flows.append((len(sent), values.get(1, 0), values.get(2, 0), rate))
            sent.append(v9(fset(sid, struct.pack(">II", a, b)[:4 * len(known.get(sid, ORDERS[0]))])))
        if pick.random() < 0.3:
            rate = pick.randint(1, 9)
            sent.append(v9(fset(400, struct.pack(">I", rate))))
    return sent, flows


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_an_exporter_with_a_thousand_changes(spark, limit):
    # it sends more than half of all packets; others have a few changes or one
    tables, want = [], []
    for i, changes in enumerate((1000, 5, 40, 1, 60)):
        sent, flows = history(i, changes)
        tables.append(packets(spark, sent, src=bytes([192, 0, 2, i])))
        want += [(f"192.0.2.{i}", *f) for f in flows]
    table = tables[0]
    for t in tables[1:]:
        table = table.unionByName(t)
    framed = frame(table)
    timeline = templates_in(framed)
    rates = sampling_timeline(resolve_sets(telling_packets(framed, timeline), timeline, limit=limit))
    rated = attach_sampling(resolve_sets(framed, timeline, limit=limit), rates, limit)
    flows = project_flows(explode_records(rated, "data", [*PACKET_COLUMNS, "sampling_rate"]))
    router = F.concat_ws(".", *[F.conv(F.hex(F.substring("SamplerAddress", i, 1)), 16, 10) for i in range(1, 5)])
    got = [tuple(r) for r in flows.select(router, "packet_id", "Bytes", "Packets", "SamplingRate").collect()]
    assert sorted(got) == sorted(want)
    # no row holds an exporter's whole history
    assert timeline.busy.count() == 3
    assert timeline.rows.agg(F.max(F.size("templates"))).first()[0] <= BUSY + 4 * PER_SLOT
    assert timeline.rows.count() > 40


def test_few_changes_are_one_row_per_exporter(spark):
    sent, _ = history(1, 5)
    timeline = templates_in(frame(packets(spark, sent)))
    assert timeline.busy is None and timeline.rows.count() == 1


def test_plans_on_both_sides_of_the_limit(spark):
    framed = frame(packets(spark, history(1, 5)[0]))
    timeline = templates_in(framed)
    assert 0 < table_bytes(timeline.rows) < 1 << 20

    def plan(limit):
        return join_timeline(framed, timeline, limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(1 << 20) and "strategy=broadcast" not in plan(0)


def test_bursts_and_times_outside_the_changes(spark):
    # all changes within one second: the slots are a microsecond wide at least, and packets before and after find them
    sent = [v9(fset(300, b"\0\0\0\1"))]
    for i in range(50):
        sent.append(v9(fset(0, template(300, ORDERS[2 + i % 2]))))
    sent += [v9(fset(300, b"\0\0\0\2"))] * 2
    table = packets(spark, sent)
    late = F.expr("recv_time + interval 400 days")
    same = F.expr("timestamp'2020-01-01 00:00:00'")
    table = table.withColumn("recv_time", F.when(F.col("packet_id") >= 51, late).when(F.col("packet_id") > 0, same).otherwise(
        F.expr("timestamp'2019-01-01 00:00:00'")))
    framed = frame(table)
    timeline = templates_in(framed)
    resolved = resolve_sets(framed, timeline)
    flows = project_flows(explode_records(resolved.withColumn("sampling_rate", F.lit(0)), "data", [*PACKET_COLUMNS, "sampling_rate"]))
    assert sorted((r.packet_id, r.Packets) for r in flows.collect()) == [(51, 2), (52, 2)]
    assert [r.error for r in resolved.where("packet_id = 0").collect()] == ["template_not_found"]
