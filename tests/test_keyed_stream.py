"""Keyed NetFlow state: the rows of the table, with late packets, over a restart, and with templates that expire."""

import random
import struct

from pyspark.sql import functions as F

from packetloom.operators.netflow_flows import flows_from_netflow
from packetloom.sources.packets import read_packet_stream
from packetloom.streaming.keyed import flows_from_netflow_stream, resolved_stream
from tests.test_timelines import history
from tests.wire import fset, packets, template, v9, v9_options

SHOWN = ["SamplerAddress", "packet_id", "Bytes", "Packets", "SamplingRate", "SequenceNum"]


def shown(df):
    return sorted((bytes(r[0]), *r[1:]) for r in df.select(SHOWN).collect())


def run(df, path, checkpoint):
    query = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination(240)
    assert query.exception() is None and not query.isActive


def put(table, source):
    table.coalesce(1).write.mode("append").parquet(source)


def test_late_packets_and_a_restart_give_the_rows_of_the_table(spark, tmp_path):
    pick = random.Random(4)
    table = None
    for i, changes in enumerate((25, 4)):
        sent, _ = history(i, changes)
        one = packets(spark, sent, src=bytes([192, 0, 2, i]))
        table = one if table is None else table.unionByName(one)
    table = table.cache()
    n = table.agg(F.max("packet_id")).first()[0]
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    # every packet comes in one of three batches near its place, so many come late
    place = {i: min(2, max(0, int(3 * i / (n + 1) + pick.choice([-0.7, 0, 0, 0.7])))) for i in range(n + 1)}
    batch = F.create_map(*[F.lit(x) for kv in place.items() for x in kv])[F.col("packet_id")]
    for b in (0, 1):
        put(table.where(batch == b), source)
    run(flows_from_netflow_stream(read_packet_stream(spark, source, maxFilesPerTrigger=1), "10 minutes"), out, checkpoint)
    # the stream ends here and starts again from its checkpoint; a far later packet lets the watermark pass all others
    put(table.where(batch == 2), source)
    end = packets(spark, [v9(fset(999, b"abcd"))], src=bytes([192, 0, 2, 99]), start=100_000)
    put(end.withColumn("recv_time", F.expr("recv_time + interval 10 days")), source)
    put(end.withColumn("recv_time", F.expr("recv_time + interval 20 days")), source)
    run(flows_from_netflow_stream(read_packet_stream(spark, source, maxFilesPerTrigger=1), "10 minutes"), out, checkpoint)
    want = shown(flows_from_netflow(table))
    assert len(want) > 20 and shown(spark.read.parquet(out)) == want


def test_errors_and_expiry(spark, tmp_path):
    sent = [v9(fset(0, template(300, [(1, 4)])), fset(999, b"abcd"), fset(0, template(301, [(1, 4)]))),  # 301 is not learnt
            v9(fset(300, b"\0\0\0\1")), v9(fset(301, b"\0\0\0\2")),
            v9(fset(1, v9_options(400, [], [(34, 4)])), fset(400, struct.pack(">I", 7)), fset(300, b"\0\0\0\3")),
            v9(fset(300, b"\0\0\0\4"))]
    table = packets(spark, sent)
    days = F.when(F.col("packet_id") == 4, F.expr("recv_time + interval 3 days")).otherwise(F.col("recv_time"))
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    put(table.withColumn("recv_time", days), source)
    put(packets(spark, [v9(fset(5, b""))], src=bytes([192, 0, 2, 9]), start=9).withColumn(
        "recv_time", F.expr("recv_time + interval 9 days")), source)
    put(packets(spark, [v9(fset(5, b""))], src=bytes([192, 0, 2, 9]), start=10).withColumn(
        "recv_time", F.expr("recv_time + interval 19 days")), source)
    rows = resolved_stream(read_packet_stream(spark, source, maxFilesPerTrigger=1), "10 seconds", 86_400)
    run(rows.select("packet_id", "error", "sampling_rate"), out, checkpoint)
    got = sorted((r.packet_id, r.error, r.sampling_rate) for r in spark.read.parquet(out).collect())
    missing = "template_not_found"
    # the template of the last packet was last announced three days before
    assert got[:5] == [(0, missing, 0), (1, None, 0), (2, missing, 0), (3, None, 7), (4, missing, 7)]
