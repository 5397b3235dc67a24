"""What makes a job grow faster than its input: plans and expressions that once did."""

import ipaddress
import re
import time

import pytest
from pyspark.sql import functions as F

from packetloom.functions.text import ip_text
from packetloom.operators.netflow_sets import sql_let
from packetloom.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(spark, df) -> str:
    for name, value in (("spark.sql.debug.maxToStringFields", "10000"), ("spark.sql.maxPlanStringLength", "100000000")):
        spark.conf.set(name, value)
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
        spark.conf.unset("spark.sql.maxPlanStringLength")


def test_nested_bindings_take_time_by_their_number(spark):
    body = "x23"
    for i in reversed(range(24)):
        body = sql_let(f"x{i}", f"x{i - 1} + 1" if i else "v", body)
    rows = spark.range(2000).select(F.when(F.col("id") >= 0, F.col("id")).alias("v"))
    began = time.time()
    total = rows.agg(F.sum(F.expr(body)).alias("s")).first()["s"]
    assert total == sum(range(2000)) + 23 * 2000
    assert time.time() - began < 15


def kept_rows(df) -> list[str]:
    """The columns of the kept tables that a query reads rows to gather, or whole packets, from."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    columns = [re.sub(r"#\d+L?", "", leaves.apply(i).output().mkString(" ")) for i in range(leaves.size())]
    return [c for c in columns if "payload" in c or "octets" in c]


@pytest.mark.parametrize("name", ["v9_flows", "ipfix_flows", "health_delay_quantiles", "health_nf_errors", "flows_union"])
def test_rows_are_kept_and_no_payloads(spark, name):
    kept = kept_rows(QUERIES[name](spark, SF))
    # one table of rows, whatever number of channels reads it
    assert len(set(kept)) == 1 and "payload" not in kept[0]


def test_packets_are_described_in_one_pass(spark):
    assert len(kept_rows(QUERIES["packet_describe"](spark, SF))) == 1


def test_a_filter_on_gateways_reads_no_record_again(spark):
    plan = plan_of(spark, QUERIES["sflow_gateway"](spark, SF))
    assert max(line.count("conv(") for line in plan.splitlines() if re.match(r"[\s:+\-]*Filter", line)) < 10


def test_long_addresses_without_a_conversion_per_group(spark):
    texts = ["::", "::1", "1::", "2001:db8::a00:1", "1:0:0:2::3", "0:1::", "fe80::a:b0:c00:d000", "1:2:3:4:5:6:7:8", "0:0:1::",
             "1:0:2:0:3:0:4:0", "abcd:ef01:2345:6789:abcd:ef01:2345:6789", "1::2:0:0:3:4"]
    rows = spark.createDataFrame([(bytearray(ipaddress.ip_address(t).packed),) for t in texts], "raw binary")
    shown = rows.select("raw", ip_text(F.col("raw")).alias("text"))
    assert "sequence(" not in plan_of(spark, shown)
    assert [r["text"] for r in shown.collect()] == [str(ipaddress.ip_address(bytes(r["raw"]))) for r in shown.collect()]
