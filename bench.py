"""Headline timings. Packets are encoded once, outside the timed part; then each query runs over all of them.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; ``BENCH_ROUNDS`` the runs per query
(the best one counts).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from packetloom.operators import analytics, health, netflow5, sflow  # noqa: E402
from packetloom.operators.netflow_flows import flows_from_netflow  # noqa: E402
from packetloom.operators.sflow_flows import flows_from_sflow  # noqa: E402
from packetloom.plans import queries, roundtrip as rt  # noqa: E402


def session(cpus: str, scratch: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("packetloom-bench")
             .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", scratch)
             .config("spark.sql.files.maxPartitionBytes", "4m").config("spark.sql.files.openCostInBytes", "1m")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    scratch = tempfile.mkdtemp(prefix="packetloom-bench-")
    spark = session(cpus, scratch)

    def capture(name, df):
        df.repartition(int(cpus) if cpus.isdigit() else 8).write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    v5 = capture("v5", rt.v5_packets(spark, sf_dir))
    v9 = capture("v9", rt.netflow_packets(spark, sf_dir, 9))
    sf = capture("sflow", rt.sflow_packets(spark, sf_dir, [
        rt.switch_hex(), rt.raw_hex(rt.ethernet_hex(0x800, queries.plain4())), rt.gateway_hex()]))
    events = capture("events", queries.event_flows(spark, sf_dir))
    suppliers = rt.table(spark, sf_dir, "supplier")
    prefixes = suppliers.select(rt.v4(167772160 + F.col("s_suppkey")).alias("network"),
                                (F.lit(32) - F.col("s_suppkey") % 9).cast("int").alias("prefix_len"),
                                F.col("s_suppkey").alias("asn"))
    timed = {
        "v5_decode": lambda: netflow5.flows_from_netflow5(v5),
        "v5_bytes_by_as": lambda: analytics.with_scaled_volume(netflow5.flows_from_netflow5(v5)).groupBy("SrcAS").agg(
            F.sum("ScaledBytes"), F.sum("ScaledPackets")),
        "v9_resolve_decode": lambda: flows_from_netflow(v9),
        "v9_bytes_by_router": lambda: flows_from_netflow(v9).groupBy("SamplerAddress").agg(F.sum("Bytes")),
        "sflow_decode": lambda: flows_from_sflow(sf),
        "sflow_samples": lambda: health.sflow_samples(sflow.read_headers(sf)),
        "session_rollup": lambda: analytics.session_volume(events, ["user_id"]),
        "lpm": lambda: analytics.longest_prefix_match(netflow5.flows_from_netflow5(v5), prefixes, "SrcAddr").groupBy(
            "asn").agg(F.sum("Bytes")),
        "as_port_grouping_sets": lambda: analytics.as_port_volumes(netflow5.flows_from_netflow5(v5)),
    }
    seconds = {}
    for name, build in timed.items():
        best = None
        for _ in range(rounds):
            start = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus}))


if __name__ == "__main__":
    main()
