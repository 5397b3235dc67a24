import datetime as dt
import struct

from pyspark.sql import functions as F

from packetloom.operators.netflow_flows import flows_from_netflow
from packetloom.operators.netflow_state import RATE_VALUE, compacted
from packetloom.schema import FLOW_COLUMNS, PACKET_SCHEMA
from packetloom.sources.packets import read_packet_stream

from packetloom.streaming.netflow import RATE_HISTORY, netflow_batch, start_netflow, to_parquet
from packetloom.streaming.windows import late_batch, read_rollup, rollup_batch, start_sessions
from tests.wire import T0, fset, packets, template, v9, v9_options


def test_stream_gives_the_flows_of_the_table(spark, tmp_path):
    sent = [
        v9(fset(300, b"\0\0\0\7")),                                           # nothing known yet
        v9(fset(0, template(300, [(1, 4)])), fset(1, v9_options(400, [], [(34, 4)])), fset(400, struct.pack(">I", 10))),
        v9(fset(300, b"\0\0\0\1")),
        v9(fset(300, b"\0\0\0\2"), fset(0, template(300, [(2, 4)])), fset(300, b"\0\0\0\3")),
        v9(fset(300, b"\0\0\0\4")),
        v9(fset(400, struct.pack(">I", 20)), fset(300, b"\0\0\0\5")),
    ]
    table = packets(spark, sent)
    source = str(tmp_path / "packets")
    for bounds in ((0, 2), (2, 4), (4, 6)):
        table.where(F.col("packet_id").between(bounds[0], bounds[1] - 1)).coalesce(1).write.mode("append").parquet(source)
    stream = read_packet_stream(spark, source, maxFilesPerTrigger=1)
    q = start_netflow(stream, str(tmp_path / "state"), str(tmp_path / "ckpt"), to_parquet(str(tmp_path / "flows")),
                      to_parquet(str(tmp_path / "errors")), availableNow=True)
    q.awaitTermination(240)
    assert q.exception() is None and not q.isActive

    def key(df):
        return sorted(map(tuple, df.select("packet_id", "Bytes", "Packets", "SamplingRate").collect()))
    got = spark.read.parquet(str(tmp_path / "flows"))
    assert set(FLOW_COLUMNS) <= set(got.columns)
    want = [(2, 1, 0, 10), (3, 0, 3, 10), (3, 2, 0, 10), (4, 0, 4, 10), (5, 0, 5, 20)]
    assert key(got) == want == key(flows_from_netflow(table))
    errors = spark.read.parquet(str(tmp_path / "errors")).collect()
    assert [(r.packet_id, r.error) for r in errors] == [(0, "template_not_found")]
    # the third micro-batch announces no template, so it writes no snapshot
    versions = sorted(p.name for p in (tmp_path / "state" / "templates").iterdir())
    assert versions == ["version=0", "version=1"]
    history = spark.read.parquet(str(tmp_path / "state" / "templates" / "version=1"))
    assert history.groupBy("template_id").count().orderBy("template_id").collect() == [(300, 2), (400, 1)]


def test_a_late_packet_leaves_the_history_of_a_table(spark, tmp_path):
    one, two = fset(0, template(300, [(1, 4)])), fset(0, template(300, [(2, 4)]))
    options = fset(1, v9_options(400, [], [(34, 4)]))

    def rate(n):
        return fset(400, struct.pack(">I", n))
    sent = [v9(one, options, rate(10)), v9(two, rate(20)), v9(one, rate(10)), v9(fset(300, b"\0\0\0\5")), v9(one, rate(10)),
            v9(fset(300, b"\0\0\0\6")), v9(fset(300, b"\0\0\0\7"))]
    table = packets(spark, sent)
    # packet 1 comes in last but one, between equal announcements
    batches = [[0, 2, 4], [1], [3, 5, 6]]
    got = []
    run = netflow_batch(str(tmp_path), lambda df, _: got.extend(
        map(tuple, df.select("packet_id", "Bytes", "Packets", "SamplingRate").collect())))
    for i, ids in enumerate(batches):
        run(table.where(F.col("packet_id").isin(ids)), i)
    want = sorted(map(tuple, flows_from_netflow(table).select("packet_id", "Bytes", "Packets", "SamplingRate").collect()))
    assert sorted(got) == want == [(3, 5, 0, 10), (5, 6, 0, 10), (6, 7, 0, 10)]
    # a batch that is run again gives the same; two snapshots are kept
    again = []
    netflow_batch(str(tmp_path), lambda df, _: again.extend(df.select("packet_id").collect()))(
        table.where(F.col("packet_id").isin(batches[2])), 2)
    assert len(again) == 3


def test_histories_before_the_horizon_keep_changes_only(spark):
    rows = [("r", 9, 1, t * 10, t, 5 if t < 4 else 6) for t in range(10)]
    history = spark.createDataFrame(rows, RATE_HISTORY)
    kept = compacted(history, *RATE_VALUE, ["t", "packet_id"], 25).orderBy("t").collect()
    assert [(r.t, r.rate) for r in kept] == [(0, 5), (40, 6), (70, 6), (80, 6), (90, 6)]


def flows(spark, path, batches):
    """Write (key, seconds, bytes) rows, one file per batch, and read them as a stream."""
    schema = "user string, event_time timestamp, Bytes bigint, Packets bigint, SamplingRate bigint"
    for rows in batches:
        data = [(k, T0 + dt.timedelta(seconds=s), b, 1, 2) for k, s, b in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None and not query.isActive


def test_sessions_close_and_drop_what_is_too_late(spark, tmp_path):
    batches = [[("a", 0, 10), ("a", 300, 5)], [("a", 230, 1)], [("b", 2000, 7)], [("b", 2010, 3)],
               [("a", 100, 99)], [("b", 9000, 1)], [("b", 9001, 1)]]
    stream = flows(spark, str(tmp_path / "in"), batches)
    finish(start_sessions(stream, ["user"], str(tmp_path / "out"), str(tmp_path / "ckpt"), availableNow=True))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("user").collect()
    # five minutes apart still belong together; the flow sent after the session closed is not taken
    assert [(r.user, int(r.bytes), r.flows) for r in got] == [("a", 32, 3), ("b", 20, 2)]


def test_rollup_and_late_table(spark, tmp_path):
    batches = [[("a", 0, 10), ("a", 500, 5)], [("a", 10, 1), ("a", 600, 2)]]
    stream = flows(spark, str(tmp_path / "in"), batches)
    finish(stream.writeStream.foreachBatch(rollup_batch(str(tmp_path / "rollup"), ["user"])).option(
        "checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start())
    got = read_rollup(spark, str(tmp_path / "rollup"), ["user"]).orderBy("window_start").collect()
    assert [(int(r.bytes), r.flows) for r in got] == [(22, 2), (10, 1), (4, 1)]
    seen = to_parquet(str(tmp_path / "late"))
    finish(stream.writeStream.foreachBatch(late_batch(str(tmp_path / "newest"), seen)).option(
        "checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start())
    assert [r.Bytes for r in spark.read.parquet(str(tmp_path / "late")).collect()] == [1]
