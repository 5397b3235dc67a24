"""Collector health: counters and summaries as group-by queries. All aggregates combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from packetloom.functions.text import ip_text
from packetloom.operators.netflow_state import record_count
from packetloom.operators.sflow import SAMPLE_NAMES, read_samples
from packetloom.plans.tables import unnest
from packetloom.schema import IPFIX, NETFLOW_V9
from packetloom.sources.packets import CHANNEL_PORT, router_key

#: In hundredths.
QUANTILES = (50, 90, 99)


def _summary(rows: DataFrame, keys: list[str], value: str, shown: dict[str, Column] | None = None) -> DataFrame:
    """Exact sum, count and discrete quantiles of ``value`` per ``keys``.

    Equal values are counted first, map-side, so what is ordered per key is its distinct values (datagram sizes, whole
    seconds), however many rows it has. ``shown`` replaces keys by what they are shown as, behind the counting.
    """
    counts = rows.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("c")).where("v is not null").withColumns(
        shown or {})
    upto = W.partitionBy(*keys).orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.select(*keys, "v", "c", F.sum("c").over(upto).alias("r"), F.sum("c").over(W.partitionBy(*keys)).alias("n"))
    return ranked.groupBy(*keys).agg(
        F.array(*[F.min(F.when(F.col("r") * 100 >= F.col("n") * q, F.col("v"))) for q in QUANTILES]).alias("quantiles"),
        F.sum(F.col("v") * F.col("c")).cast("bigint").alias("sum"), F.sum("c").alias("count"))


def traffic(packets: DataFrame) -> DataFrame:
    """Bytes, packets and datagram sizes per remote and local endpoint.

    Tables with ``local_ip`` / ``local_port`` columns use them; others get the channel's default port.
    """
    port = F.lit(None).cast("int")
    for channel, number in CHANNEL_PORT.items():
        port = F.when(F.col("channel") == channel, number).otherwise(port)
    local_ip = F.col("local_ip") if "local_ip" in packets.columns else F.lit("")
    local_port = F.col("local_port") if "local_port" in packets.columns else port
    rows = packets.select(router_key().alias("remote_ip"), F.col("src_port").alias("remote_port"),
                          local_ip.alias("local_ip"), local_port.alias("local_port"), F.col("channel").alias("type"),
                          F.octet_length("payload").alias("size"))
    keys = ["remote_ip", "remote_port", "local_ip", "local_port", "type"]
    return _summary(rows, keys, "size").select(*keys, F.col("sum").alias("bytes"), F.col("count").alias("packets"),
                                               F.col("quantiles").alias("size_quantiles"))


def netflow_packets(resolved: DataFrame | None, v5_headers: DataFrame | None = None) -> DataFrame:
    """Decoded packets per router and version."""
    return _of_both(resolved, v5_headers).where("error IS NULL").groupBy("router", "version").agg(
        F.count("*").alias("packets"))


def netflow_errors(resolved: DataFrame | None, v5_headers: DataFrame | None = None) -> DataFrame:
    """Rejected packets per router and error."""
    return _of_both(resolved, v5_headers).where("error IS NOT NULL").groupBy("router", "error").agg(
        F.count("*").alias("packets"))


def _of_both(resolved: DataFrame | None, v5_headers: DataFrame | None) -> DataFrame:
    parts = [d.select("router", "version", "error") for d in (resolved, v5_headers) if d is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def netflow_sets(resolved: DataFrame, v5_headers: DataFrame | None = None, compat_labels: bool = False) -> DataFrame:
    """Sets and records per router, version and set type, of accepted packets.

    v5 has no sets: its declared record counts are added to the sets of type ``DataFlowSet``.
    ``compat_labels`` books the records of v9 template sets under ``OptionsTemplateFlowSet``.
    """
    def accepted(items):
        return F.when(F.col("error").isNull(), F.col(items))

    announced = unnest(resolved, ["router", "version", "announced"], accepted("sets"), "s").where("s.id < 256").select(
        "router", "version", F.when(F.col("s.id").isin(0, 2), "TemplateFlowSet").otherwise(
            "OptionsTemplateFlowSet").alias("type"),
        F.size(F.filter("announced", lambda a: a["set_idx"] == F.col("s.idx"))).alias("records"))
    data = unnest(resolved, ["router", "version"], accepted("rsets"), "s").select(
        "router", "version", F.when(F.col("s.layout.kind") == "data", "DataFlowSet").otherwise(
            "OptionsDataFlowSet").alias("type"), record_count(F.col("s")).alias("records"))
    rows = announced.unionByName(data).withColumn("sets", F.lit(1))
    if compat_labels:
        moved = (F.col("version") == 9) & (F.col("type") == "TemplateFlowSet")
        rows = rows.select("router", "version", F.explode(F.array(
            F.struct("type", "sets", F.when(moved, 0).otherwise(F.col("records")).alias("records")),
            F.struct(F.when(moved, "OptionsTemplateFlowSet").otherwise(F.col("type")).alias("type"),
                     F.lit(0).alias("sets"), F.when(moved, F.col("records")).otherwise(0).alias("records")))).alias("x"))
        rows = rows.select("router", "version", "x.*")
    if v5_headers is not None:
        rows = rows.unionByName(v5_headers.where("error IS NULL").select(
            "router", "version", F.lit("DataFlowSet").alias("type"), F.lit(0).alias("records"),
            F.col("record_count").alias("sets")))
    return rows.groupBy("router", "version", "type").agg(
        F.sum("sets").cast("bigint").alias("sets"), F.sum("records").cast("bigint").alias("records"))


def delay(flows: DataFrame) -> DataFrame:
    """Seconds between the end of a v9 / IPFIX flow and its receipt; negative under clock skew."""
    rows = flows.where(F.col("Type").isin(NETFLOW_V9, IPFIX)).select(
        F.col("SamplerAddress").alias("router"),
        F.when(F.col("Type") == NETFLOW_V9, 9).otherwise(10).alias("version"),
        (F.col("TimeReceived") - F.col("TimeFlowEnd")).alias("delay"))
    return _summary(rows, ["router", "version"], "delay", {"router": ip_text(F.col("router"))}).select(
        "router", "version", "quantiles", F.col("sum").alias("delay_sum"), F.col("count").alias("flows"))


def template_counts(resolved: DataFrame) -> DataFrame:
    """Templates announced, also in packets rejected by a later set."""
    rows = unnest(resolved, ["router", "version", "domain", "error_idx"], F.col("announced"), "a").where(
        F.col("error_idx").isNull() | (F.col("a.set_idx") < F.col("error_idx")))
    return rows.groupBy(
        "router", "version", F.col("domain").alias("obs_domain_id"), F.col("a.template_id").alias("template_id"),
        F.when(F.col("a.kind") == "data", "template").otherwise("options_template").alias("type")).agg(
        F.count("*").alias("templates"))


def sflow_packets(headers: DataFrame) -> DataFrame:
    return headers.where("error IS NULL").groupBy(
        "router", ip_text(F.col("agent")).alias("agent"), F.lit(5).alias("version")).agg(F.count("*").alias("packets"))


def sflow_errors(headers: DataFrame) -> DataFrame:
    return headers.where("error IS NOT NULL").groupBy("router", "error").agg(F.count("*").alias("packets"))


def sflow_samples(headers: DataFrame) -> DataFrame:
    """Samples and the records they declare; declared samples that were not decoded count as ``unknown``.

    One pass: every accepted packet gets one more item that stands for what its header declares. Counts per exporter and
    type come first, the difference is taken of those few rows.
    """
    keys = ["router", "agent", "version"]
    kind = F.when(F.col("sample_idx") < 0, "declared")
    for fmt, name in SAMPLE_NAMES.items():
        kind = kind.when(F.col("decoded") & (F.col("format") == fmt), name)
    whole = F.struct(F.lit(-1).alias("idx"), F.lit(0).cast("bigint").alias("fmt"), F.lit(0).alias("pos"), F.lit(0).alias("len"))
    # the declared number travels in the place of the sequence number, which is not asked for here
    rows = read_samples(headers.where("error IS NULL").withColumn("sequence", F.col("sample_count")).withColumn(
        "samples", F.concat("samples", F.array(whole))))
    counts = rows.select("router", ip_text(F.col("agent")).alias("agent"), F.lit(5).alias("version"), kind.alias("type"), F.when(
        F.col("sample_idx") < 0, F.col("sequence")).otherwise(1).cast("bigint").alias("samples"), F.when(
        F.col("sample_idx") < 0, 0).otherwise(F.col("record_count")).cast("bigint").alias("records")).where(
        "type IS NOT NULL").groupBy(*keys, "type").agg(F.sum("samples").alias("samples"), F.sum("records").alias("records"))
    declared = F.col("type") == "declared"
    parts = F.array(F.struct(F.when(declared, "unknown").otherwise(F.col("type")).alias("type"), "samples", "records"),
                    F.struct(F.lit("unknown").alias("type"), F.when(declared, 0).otherwise(-F.col("samples")).cast(
                        "bigint").alias("samples"), F.lit(0).cast("bigint").alias("records")))
    return counts.select(*keys, F.explode(parts).alias("p")).groupBy(*keys, "p.type").agg(
        F.sum("p.samples").cast("bigint").alias("samples"), F.sum("p.records").cast("bigint").alias("records")).where(
        (F.col("type") != "unknown") | (F.col("samples") > 0))
