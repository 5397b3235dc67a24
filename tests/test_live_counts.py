"""Errors counted while packets pass: on a table by one observation, on a stream by a listener; and the read buffer's cut."""

import time

from pyspark.sql import Observation, functions as F

from packetloom.operators.netflow5 import read_headers
from packetloom.plans.union import ErrorCounts, with_live_counts
from packetloom.sources.packets import read_packet_stream, read_packets
from tests.wire import netflow5, packets, record5


def sent(spark):
    good = netflow5([record5("1.1.1.1", "2.2.2.2")])
    return packets(spark, [good, b"\0\7" + good[2:], good, good[:2] + b"\xff\xff" + good[4:], b""], "NetFlowV5")


def test_counts_of_a_table(spark):
    watch = Observation("packets")
    rows = with_live_counts(read_headers(sent(spark)), watch)
    assert rows.where("error IS NOT NULL").count() == 3
    got = {k: v for k, v in watch.get.items() if v}
    assert got == {"packets": 5, "error_version": 2, "error_decoding": 1}


def test_counts_of_a_stream(spark, tmp_path):
    for i in range(5):
        sent(spark).where(F.col("packet_id") == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    listener = ErrorCounts("watched")
    spark.streams.addListener(listener)
    try:
        stream = with_live_counts(read_headers(read_packet_stream(spark, str(tmp_path / "in"), maxFilesPerTrigger=2)), "watched")
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        for _ in range(50):  # progress arrives by another thread
            if listener.total["packets"] == 5:
                break
            time.sleep(0.2)
        assert dict(listener.total) == {"packets": 5, "error_version": 2, "error_decoding": 1}
    finally:
        spark.streams.removeListener(listener)


def test_datagrams_are_cut_at_the_read_buffer(spark, tmp_path):
    path = str(tmp_path / "p")
    packets(spark, [bytes(8999), bytes(9000), bytes(9001), b""]).write.parquet(path)
    sizes = [r.n for r in read_packets(spark, path).orderBy("packet_id").select(F.octet_length("payload").alias("n")).collect()]
    assert sizes == [8999, 9000, 9000, 0]
    whole = read_packets(spark, path, read_bytes=None)
    assert whole.agg(F.max(F.octet_length("payload"))).first()[0] == 9001
