"""Packets built from the driver's tables, so that decoded flows can be compared with SQL on the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from packetloom.functions.binary import be_hex, from_hex, int_div
from packetloom.plans.tables import settle
from packetloom.sources.encode import fields_hex, gather_records, set_hex, tlv_hex, v4
from packetloom.sources.packets import NETFLOW, NETFLOW5, SFLOW

UPTIME, BASE = 100_000_000, 1_700_000_000
RECORDS_PER_PACKET = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with the flow values the encoders write (mapping of FIXTURES §3)."""
    li = table(spark, sf_dir, "lineitem")
    month = F.date_trunc("month", F.col("l_shipdate")).cast("timestamp")
    return li.select(
        F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"),
        F.col("l_linenumber").cast("bigint").alias("ln"), F.col("l_linestatus").alias("status"),
        month.alias("recv_time"),
        int_div(F.col("l_orderkey"), 1 << 20).alias("block"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("octets"),
        F.col("l_quantity").cast("bigint").alias("pkts"),
        F.when(F.col("l_returnflag") == "A", 6).when(F.col("l_returnflag") == "N", 17).otherwise(1).alias("proto"),
        F.when(F.col("l_linestatus") == "O", 2).otherwise(16).alias("tcp"),
        F.col("l_shipdate").cast("timestamp").alias("ship"),
    )


PACKET_KEY = ["sk", "recv_time", "block"]


def packet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem_rows`` dealt by what packets are gathered by. Numbers travel; records, several times as wide, are written behind that."""
    return lineitem_rows(spark, sf_dir).drop("status", "ship").repartition(*PACKET_KEY)


def settled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``packet_rows`` for packets that are read several times. Rows are kept and not payloads, which take several times the
    room; sorted, a column of equal values takes next to none."""
    return settle(packet_rows(spark, sf_dir).sortWithinPartitions(*PACKET_KEY, "ok", "ln"))


def exporter(sk: Column) -> Column:
    return v4(F.lit((10 << 24) + (1 << 16)) + sk)


def packet_number(sk: Column, month: Column, block: Column, slice_no: Column) -> Column:
    """Distinct number per (exporter, month, block, slice)."""
    months = F.year(month) * 12 + F.month(month)
    return ((sk * 65536 + months) * 131072 + block) * 64 + slice_no


def v5_packets(spark: SparkSession, sf_dir: str, uptime: int = UPTIME, first_age=None, rows: DataFrame | None = None) -> DataFrame:
    """NetFlow v5 packets, up to 24 lineitem rows each; ``first_age`` = age of a record's first tick in seconds, ``rows`` the
    rows where they are at hand."""
    rows = packet_rows(spark, sf_dir) if rows is None else rows
    age = first_age if first_age is not None else F.col("ok") % 1000
    first = F.pmod(F.lit(uptime) - age * 1000, F.lit(1 << 32))
    last = F.pmod(F.lit(uptime) - (F.col("ok") % 100) * 1000, F.lit(1 << 32))
    sk, pk, ln = F.col("sk"), F.col("pk"), F.col("ln")
    record = F.concat(
        be_hex(167772160 + sk, 4), be_hex(3232235520 + pk % 65536, 4), be_hex(184483840 + ln, 4),
        be_hex(ln, 2), be_hex(sk % 48, 2), be_hex(F.col("pkts"), 4), be_hex(F.col("octets"), 4),
        be_hex(first, 4), be_hex(last, 4), be_hex(1024 + F.col("ok") % 60000, 2), be_hex(1000 + ln, 2),
        F.lit("00"), be_hex(F.col("tcp"), 1), be_hex(F.col("proto"), 1), be_hex(pk % 64, 1),
        be_hex(64512 + sk % 1000, 2), be_hex(64512 + pk % 1000, 2), F.lit("18"), be_hex(ln, 1), F.lit("0000"))
    groups = gather_records(rows.withColumn("rec", record), PACKET_KEY,
                            ["ok", "ln", "pk"], "rec", RECORDS_PER_PACKET)
    number = packet_number(F.col("sk"), F.col("recv_time"), F.col("block"), F.col("slice_no"))
    header = F.concat(be_hex(5, 2), be_hex(F.size("records"), 2), be_hex(uptime, 4), be_hex(BASE, 4),
                      be_hex(0, 4), be_hex(number % (1 << 32), 4), be_hex(0, 2), be_hex(100, 2))
    return groups.select(
        number.alias("packet_id"), F.lit(NETFLOW5).alias("channel"), exporter(F.col("sk")).alias("src"),
        F.lit(2055).alias("src_port"), from_hex(header, F.array_join("records", "")).alias("payload"),
        F.col("recv_time"))


# --- NetFlow v9 and IPFIX ---------------------------------------------------------------------------------------

FIRST_RATE, SECOND_RATE = 1000, 2000
START, CHANGE = "1990-01-01 00:00:00", "2000-01-01 00:00:00"
DATA_TEMPLATE, OPTIONS_TEMPLATE, UNKNOWN_TEMPLATE = 300, 400, 999
SAMPLING_INTERVAL_FIELD = 34


def flow_fields(version: int, wide: bool) -> list[tuple[int, int, Column]]:
    """(field id, length, value) of a record; the wide layout has other lengths and another order."""
    sk, pk, ln, ok = F.col("sk"), F.col("pk"), F.col("ln"), F.col("ok")
    count = 8 if wide else 4
    if version == 9:
        times = [(22, 4, F.lit(UPTIME) - (ok % 1000) * 1000), (21, 4, F.lit(UPTIME) - (ok % 100) * 1000)]
    elif wide:
        times = [(152, 8, (F.lit(BASE) - ok % 1000) * 1000), (153, 8, (F.lit(BASE) - ok % 100) * 1000)]
    else:
        times = [(150, 4, F.lit(BASE) - ok % 1000), (151, 4, F.lit(BASE) - ok % 100)]
    fields = [
        (8, 4, 167772160 + sk), (12, 4, 3232235520 + pk % 65536), (1, count, F.col("octets")),
        (2, count, F.col("pkts")), (7, 2, 1024 + ok % 60000), (11, 2, 1000 + ln), (4, 1, F.col("proto")),
        (6, 1, F.col("tcp")), (5, 1, pk % 64), (10, 2, ln), (14, count, sk % 48), (16, 4, 64512 + sk % 1000),
        (17, 4, 64512 + pk % 1000), (9, 1, F.lit(24)), (13, 1, ln), (15, 4, 184483840 + ln), (58, 2, sk % 4096),
        (56, 6, ok), *times,
    ]
    return fields[::-1] if wide else fields


def _record(fields) -> Column:
    return F.concat(*[be_hex(value, size) for _, size, value in fields])


def _template_set(version: int, template_id: int, fields) -> Column:
    pairs = [(i, n) for i, n, _ in fields]
    return set_hex(0 if version == 9 else 2, F.concat(be_hex(template_id, 2), be_hex(len(pairs), 2), fields_hex(pairs)))


def _options_set(version: int) -> Column:
    head = [(OPTIONS_TEMPLATE, 2), (4, 2), (4, 2)] if version == 9 else [(OPTIONS_TEMPLATE, 2), (2, 2), (1, 2)]
    return set_hex(1 if version == 9 else 3, F.concat(
        *[be_hex(v, n) for v, n in head], fields_hex([(1, 4), (SAMPLING_INTERVAL_FIELD, 4)])))


def _message(version: int, number: Column, sets: Column, count: Column) -> Column:
    if version == 9:
        return from_hex(be_hex(9, 2), be_hex(count, 2), be_hex(UPTIME, 4), be_hex(BASE, 4),
                        be_hex(number % (1 << 32), 4), be_hex(7, 4), sets)
    return from_hex(be_hex(10, 2), be_hex(F.length(sets) / 2 + 16, 2), be_hex(BASE, 4), be_hex(number % (1 << 32), 4),
                    be_hex(7, 4), sets)


def _packet_rows(rows: DataFrame, version: int, channel: str = NETFLOW) -> DataFrame:
    """Rows with number, sk, recv_time, sets (hex) and set_count as packets."""
    return rows.select(F.col("number").alias("packet_id"), F.lit(channel).alias("channel"),
                       exporter(F.col("sk")).alias("src"), F.lit(2055).alias("src_port"),
                       _message(version, F.abs("number"), F.col("sets"), F.col("set_count")).alias("payload"),
                       F.col("recv_time"))


def _hiding(template: Column, hidden: bool) -> tuple[Column, Column]:
    """A template set, behind a set without a template for exporters divisible by five; and how many sets that is."""
    if not hidden:
        return template, F.lit(1)
    fifth = F.col("sk") % 5 == 0
    lost = set_hex(UNKNOWN_TEMPLATE, F.lit("00000000"))
    return F.concat(F.when(fifth, lost).otherwise(""), template), 1 + fifth.cast("int")


def _setup_packets(spark: SparkSession, sf_dir: str, version: int, narrow, wide, hidden: bool = False) -> DataFrame:
    """Two packets per exporter: template, options template and rate at the start, both changed once later."""
    exporters = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sk"))

    def at(time, rate, template, *sets):
        announced, count = _hiding(template, hidden)
        told = set_hex(OPTIONS_TEMPLATE, F.concat(be_hex(1, 4), be_hex(rate, 4)))
        return exporters.select(
            (-1 - F.col("sk")).alias("number"), "sk", F.lit(time).cast("timestamp").alias("recv_time"),
            F.concat(announced, *sets, told).alias("sets"), (count + len(sets) + 1).alias("set_count"))

    return _packet_rows(at(START, FIRST_RATE, _template_set(version, DATA_TEMPLATE, narrow), _options_set(version))
                        .unionByName(at(CHANGE, SECOND_RATE, _template_set(version, DATA_TEMPLATE, wide))), version)


def netflow_packets(spark: SparkSession, sf_dir: str, version: int, fields=None, missing: bool = False,
                    hidden: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """v9 / IPFIX packets of ``lineitem``: one template that changes its layout once, repeated every January.

    ``fields`` replaces the record by one fixed layout. ``missing`` adds a set without a template to every
    packet of an exporter whose number is divisible by five. ``hidden`` puts such a set before their templates only.
    ``rows`` are settled rows where they are at hand.
    """
    narrow = fields or flow_fields(version, False)
    wide = fields or flow_fields(version, True)
    changed = F.col("recv_time") >= F.lit(CHANGE).cast("timestamp")
    # the packets are read several times (templates, rates, records), as a captured table would be
    rows = (settled_rows(spark, sf_dir) if rows is None else rows).withColumn(
        "rec", _record(narrow) if fields else F.when(changed, _record(wide)).otherwise(_record(narrow)))
    groups = gather_records(rows, PACKET_KEY, ["ok", "ln", "pk"], "rec", RECORDS_PER_PACKET)
    template = F.when(changed, _template_set(version, DATA_TEMPLATE, wide)).otherwise(
        _template_set(version, DATA_TEMPLATE, narrow))
    template, template_sets = _hiding(template, hidden)
    repeat = F.month("recv_time") == 1
    lost = (F.col("sk") % 5 == 0) if missing else F.lit(False)
    sets = F.concat(F.when(repeat, template).otherwise(""), set_hex(DATA_TEMPLATE, F.array_join("records", "")),
                    F.when(lost, set_hex(UNKNOWN_TEMPLATE, F.lit("00000000"))).otherwise(""))
    number = packet_number(F.col("sk"), F.col("recv_time"), F.col("block"), F.col("slice_no"))
    data = _packet_rows(groups.select(number.alias("number"), "sk", "recv_time", sets.alias("sets"), (
        1 + F.when(repeat, template_sets).otherwise(0) + lost.cast("int")).alias("set_count")), version)
    return _setup_packets(spark, sf_dir, version, narrow, wide, hidden).unionByName(data)


# --- sFlow ------------------------------------------------------------------------------------------------------

SAMPLES_PER_PACKET = 8
MACS = "00ff1234351b" + "ffabcdefab64"


def ethernet_hex(etype: int, *rest: Column) -> Column:
    return F.concat(F.lit(f"{MACS}{etype:04x}"), *rest)


def ipv4_hex(proto: Column | int, src: Column, dst: Column, tos=0, ttl=64, ident=0, frag=0) -> Column:
    return F.concat(F.lit("45"), be_hex(tos, 1), be_hex(60, 2), be_hex(ident, 2), be_hex(frag, 2), be_hex(ttl, 1),
                    be_hex(proto, 1), F.lit("0000"), be_hex(src, 4), be_hex(dst, 4))


def ipv6_hex(proto: Column | int, src: Column, dst: Column, tos=0, label=0, hop=64) -> Column:
    first = F.lit(6 << 28) + (tos if isinstance(tos, Column) else F.lit(tos)) * (1 << 20) + label
    return F.concat(be_hex(first, 4), be_hex(60, 2), be_hex(proto, 1), be_hex(hop, 1),
                    F.lit("20010db8" + "0" * 16), be_hex(src, 4), F.lit("20010db8" + "0" * 16), be_hex(dst, 4))


def l4_hex() -> Column:
    """TCP, UDP or ICMP header of a row, by its protocol."""
    ports = F.concat(be_hex(1024 + F.col("ok") % 60000, 2), be_hex(1000 + F.col("ln"), 2))
    tcp = F.concat(ports, F.lit("00" * 8 + "50"), be_hex(F.col("tcp"), 1), F.lit("00" * 6))
    icmp = F.concat(be_hex(F.col("ln"), 1), be_hex(F.col("sk") % 16, 1), F.lit("00" * 6))
    return F.when(F.col("proto") == 6, tcp).when(F.col("proto") == 17, F.concat(ports, F.lit("00" * 4))).otherwise(icmp)


def src_number() -> Column:
    return 167772160 + F.col("sk")


def dst_number() -> Column:
    return 3232235520 + F.col("pk") % 65536


def raw_hex(frame: Column) -> Column:
    return tlv_hex(1, F.concat(be_hex(1, 4), be_hex(F.col("octets"), 4), be_hex(4, 4), be_hex(78, 4), frame))


def switch_hex() -> Column:
    return tlv_hex(1001, F.concat(be_hex(F.col("sk") % 4096, 4), be_hex(1, 4), be_hex(F.col("ln"), 4), be_hex(2, 4)))


def router_hex() -> Column:
    return tlv_hex(1002, F.concat(be_hex(1, 4), be_hex(184483840 + F.col("ln"), 4), be_hex(24, 4), be_hex(F.col("ln"), 4)))


def gateway_hex() -> Column:
    """AS path with ``ln - 1`` hops; lines of number 1 have no path."""
    ln, pk = F.col("ln"), F.col("pk")
    hops = F.array_join(F.transform(F.sequence(F.lit(1).cast("bigint"), ln - 1), lambda i: be_hex(64512 + pk % 1000 + i, 4)), "")
    path = F.when(ln > 1, F.concat(be_hex(1, 4), be_hex(2, 4), be_hex(ln - 1, 4), hops)).otherwise(be_hex(0, 4))
    return tlv_hex(1003, F.concat(
        be_hex(1, 4), be_hex(184483840 + ln, 4), be_hex(64512 + F.col("sk") % 1000, 4), be_hex(65000, 4), be_hex(7, 4),
        path, be_hex(2, 4), be_hex(ln, 4), be_hex(pk % 1000, 4), be_hex(100, 4)))


def ip_record_hex(v6: bool) -> Column:
    pad = F.lit("20010db8" + "0" * 16 if v6 else "")
    return tlv_hex(4 if v6 else 3, F.concat(
        be_hex(F.col("octets"), 4), be_hex(F.col("proto"), 4), pad, be_hex(src_number(), 4), pad, be_hex(dst_number(), 4),
        be_hex(1024 + F.col("ok") % 60000, 4), be_hex(1000 + F.col("ln"), 4), be_hex(F.col("tcp"), 4),
        be_hex(F.col("pk") % 64, 4)))


def _flow_sample_hex(records: list[Column]) -> Column:
    """Lines of odd number as plain flow samples, the others as expanded ones."""
    ln, sk = F.col("ln"), F.col("sk")
    rate = 512 * (1 + ln)
    body = F.concat(*records)
    count = be_hex(len(records), 4)
    plain = tlv_hex(1, F.concat(be_hex(1, 4), be_hex(2, 4), be_hex(rate, 4), be_hex(0, 4), be_hex(0, 4), be_hex(ln, 4),
                                be_hex(sk % 48, 4), count, body))
    expanded = tlv_hex(3, F.concat(be_hex(1, 4), be_hex(0, 4), be_hex(2, 4), be_hex(rate, 4), be_hex(0, 4), be_hex(0, 4),
                                   be_hex(0, 4), be_hex(ln, 4), be_hex(0, 4), be_hex(sk % 48, 4), count, body))
    return F.when(ln % 2 == 1, plain).otherwise(expanded)


def sflow_packets(spark: SparkSession, sf_dir: str, records: list[Column], sample: Column | None = None,
                  rows: DataFrame | None = None) -> DataFrame:
    """sFlow packets of ``lineitem``: one sample per row with the given records (or a whole ``sample``)."""
    rows = (packet_rows(spark, sf_dir) if rows is None else rows).withColumn("rec", sample if sample is not None else _flow_sample_hex(records))
    groups = gather_records(rows, PACKET_KEY, ["ok", "ln", "pk"], "rec", SAMPLES_PER_PACKET)
    number = packet_number(F.col("sk"), F.col("recv_time"), F.col("block"), F.col("slice_no"))
    head = F.concat(be_hex(5, 4), be_hex(1, 4), be_hex(F.lit((10 << 24) + (1 << 16)) + F.col("sk"), 4),
                    be_hex(0, 4), be_hex(number % (1 << 32), 4), be_hex(1000, 4), be_hex(F.size("records"), 4))
    return groups.select(
        number.alias("packet_id"), F.lit(SFLOW).alias("channel"), exporter(F.col("sk")).alias("src"),
        F.lit(6343).alias("src_port"), from_hex(head, F.array_join("records", "")).alias("payload"), F.col("recv_time"))


def counter_sample_hex(fmt: int) -> Column:
    """Counter samples of a row: interface counters (1) or Ethernet counters (2)."""
    ln, ok = F.col("ln"), F.col("ok")
    if fmt == 1:
        values = [(ln, 4), (F.lit(6), 4), (F.lit(10**10), 8), (F.lit(1), 4), (F.lit(3), 4), (F.col("octets"), 8),
                  (F.col("pkts"), 4), *[(ln + i, 4) for i in range(5)], (F.col("octets") * 2, 8), (ok, 4),
                  *[(ln * i, 4) for i in range(5)], (F.lit(0), 4)]
    else:
        values = [(ln * 100 + i, 4) for i in range(13)]
    record = tlv_hex(fmt, F.concat(*[be_hex(v, n) for v, n in values]))
    return tlv_hex(2, F.concat(be_hex(ok, 4), be_hex(ln, 4), be_hex(1, 4), record))
