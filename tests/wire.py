"""Packet builders for tests, byte by byte."""

import datetime as dt
import struct

from packetloom.schema import PACKET_SCHEMA

T0 = dt.datetime(2024, 5, 1, 12, 0, 0, tzinfo=dt.timezone.utc)


def packets(spark, payloads, channel="NetFlow", src=bytes([192, 0, 2, 1]), start=0):
    """Packets one second apart; an item may be bytes or (bytes, src)."""
    rows = []
    for i, p in enumerate(payloads):
        body, source = p if isinstance(p, tuple) else (p, src)
        rows.append((start + i, channel, bytearray(source), 4000, bytearray(body), T0 + dt.timedelta(seconds=start + i)))
    return spark.createDataFrame(rows, PACKET_SCHEMA)


def fset(set_id, body, length=None):
    return struct.pack(">HH", set_id, len(body) + 4 if length is None else length) + body


def template(tid, fields):
    return struct.pack(">HH", tid, len(fields)) + b"".join(struct.pack(">HH", *f) for f in fields)


def v9_options(tid, scopes, options):
    return struct.pack(">HHH", tid, 4 * len(scopes), 4 * len(options)) + b"".join(
        struct.pack(">HH", *f) for f in scopes + options)


def ipfix_options(tid, scopes, options):
    return struct.pack(">HHH", tid, len(scopes) + len(options), len(scopes)) + b"".join(
        struct.pack(">HH", *f) for f in scopes + options)


def v9(*sets, count=None, uptime=10_000, secs=1_700_000_000, seq=7, source=1):
    n = len(sets) if count is None else count
    return struct.pack(">HHIIII", 9, n, uptime, secs, seq, source) + b"".join(sets)


def ipfix(*sets, secs=1_700_000_000, seq=7, domain=1):
    body = b"".join(sets)
    return struct.pack(">HHIII", 10, 16 + len(body), secs, seq, domain) + body


def netflow5(records, count=None, uptime=8_569_672, secs=1_540_209_179, seq=25_661, sampling=0, version=5):
    n = len(records) if count is None else count
    return struct.pack(">HHIIIIBBH", version, n, uptime, secs, 93_810_119, seq, 8, 8, sampling) + b"".join(records)


def record5(src, dst, in_if=0, out_if=0, pkts=0, octets=0, first=0, last=0, sport=0, dport=0, flags=0, proto=6, tos=0,
            src_as=0, dst_as=0, src_mask=0, dst_mask=0, next_hop="0.0.0.0"):
    return struct.pack(">4s4s4sHHIIIIHHBBBBHHBBH", v4(src), v4(dst), v4(next_hop), in_if, out_if, pkts, octets, first,
                       last, sport, dport, 0, flags, proto, tos, src_as, dst_as, src_mask, dst_mask, 0)


def v4(text):
    return bytes(int(p) for p in text.split("."))


def sflow(*samples, agent=bytes([172, 16, 0, 17]), seq=426, count=None, version=5, ip_version=None):
    kind = ip_version if ip_version is not None else (1 if len(agent) == 4 else 2)
    return struct.pack(">II", version, kind) + agent + struct.pack(
        ">IIII", 1, seq, 1_743_432_193, len(samples) if count is None else count) + b"".join(samples)


def tlv(fmt, body, length=None):
    return struct.pack(">II", fmt, len(body) if length is None else length) + body


def flow_sample(*records, rate=2048, in_if=1194, out_if=1043, count=None):
    n = len(records) if count is None else count
    return tlv(1, struct.pack(">IIIIIIII", 6, 1043, rate, 12_288, 0, in_if, out_if, n) + b"".join(records))


def expanded_flow_sample(*records, rate=16_383, in_if=1_000_100, out_if=1_000_018, count=None):
    n = len(records) if count is None else count
    return tlv(3, struct.pack(">IIIIIIIIIII", 6, 0, 1043, rate, 12_288, 0, 0, in_if, 0, out_if, n) + b"".join(records))


def raw(header, protocol=1, frame=82):
    return tlv(1, struct.pack(">IIII", protocol, frame, 4, 78) + header)


def switch(src_vlan, dst_vlan):
    return tlv(1001, struct.pack(">IIII", src_vlan, 0, dst_vlan, 0))


def router(next_hop, src_mask, dst_mask):
    return tlv(1002, struct.pack(">I", 1 if len(next_hop) == 4 else 2) + next_hop + struct.pack(">II", src_mask, dst_mask))


def gateway(next_hop, own, src_as, path, communities=(), pref=100, destinations=None, path_length=None):
    segments = (1 if path else 0) if destinations is None else destinations
    body = struct.pack(">I", 1 if len(next_hop) == 4 else 2) + next_hop + struct.pack(">IIII", own, src_as, 7, segments)
    if segments:
        body += struct.pack(">II", 2, len(path) if path_length is None else path_length)
        body += b"".join(struct.pack(">I", a) for a in path)
    body += struct.pack(">I", len(communities)) + b"".join(struct.pack(">I", c) for c in communities)
    return tlv(1003, body + struct.pack(">I", pref))


MACS = bytes.fromhex("00ff1234351b") + bytes.fromhex("ffabcdefab64")


def ethernet(etype, *rest):
    return MACS + struct.pack(">H", etype) + b"".join(rest)


def ipv4(proto, src="172.16.32.254", dst="172.16.32.241", tos=0, ttl=124, ident=23_559, frag=0):
    return struct.pack(">BBHHHBBH4s4s", 0x45, tos, 60, ident, frag, ttl, proto, 0, v4(src), v4(dst))


def ipv6(proto, src=bytes(15) + b"\1", dst=bytes(15) + b"\2", tos=2, label=967_916, hop=64):
    return struct.pack(">IHBB", (6 << 28) | (tos << 20) | label, 460, proto, hop) + src + dst


def tcp(sport, dport, flags=24):
    return struct.pack(">HHIIBBHHH", sport, dport, 1, 2, 0x50, flags, 100, 0, 0)
