"""Text forms of addresses, MACs and flow types, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from packetloom.functions.binary import span, uint
from packetloom.schema import FLOW_TYPES

V4_MAPPED = bytes(10) + b"\xff\xff"


def _dotted(raw: Column) -> Column:
    return F.concat_ws(".", *[uint(raw, i, 1).cast("string") for i in range(4)])


# Runs of zero groups in a colon-fenced address, longest first.
ZERO_RUNS = [":0" * run + ":" for run in range(8, 1, -1)]


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, see ``sql_let``."""
    return F.aggregate(F.array(), value, lambda same, _: same, use)


def _colon_groups(raw: Column) -> Column:
    """RFC 5952 text: lower-case groups, the first longest run of two or more zero groups as ``::``."""
    # a colon before every four digits, then up to three zeros behind each colon go
    parted = F.regexp_replace(F.lower(F.hex(raw)), "(.{4})", ":$1")
    groups = F.regexp_replace(parted, ":0{1,3}", ":")

    def shorten(fenced):
        def cut(run):
            at = F.instr(fenced, run)
            head = F.ltrim(F.substring(fenced, F.lit(1), at - 1), F.lit(":"))
            tail = F.rtrim(F.substring(fenced, at + F.length(run), F.length(fenced)), F.lit(":"))
            return F.coalesce(F.concat(head, F.lit("::"), tail), F.btrim(fenced, F.lit(":")))
        runs = F.array(*[F.lit(z) for z in ZERO_RUNS])
        return _let(F.get(F.filter(runs, lambda z: F.instr(fenced, z) > 0), 0), cut)

    return _let(F.concat(groups, F.lit(":")), shorten)


def ip_text(raw: Column) -> Column:
    """Address bytes as text: dotted for 4 bytes and v4-mapped, RFC 5952 for 16, ``<nil>`` for none.

    The long form sits in lambdas, which keeps the generated code of the common 4-byte form small.
    """
    n = F.octet_length(raw)
    wide = _let(raw, lambda b: F.when(span(b, 0, 12) == F.lit(V4_MAPPED), _dotted(span(b, 12, 4))).otherwise(
        _colon_groups(b)))
    return (F.when(n == 4, _dotted(raw)).when(n == 16, wide).when(n == 0, F.lit("<nil>"))
            .otherwise(F.concat(F.lit("?"), F.lower(F.hex(raw)))))


def mac_text(mac: Column) -> Column:
    """Low 48 bits of a number as six colon-separated hex pairs."""
    digits = F.lower(F.lpad(F.hex(mac.bitwiseAND(F.lit((1 << 48) - 1))), 12, "0"))
    return F.concat_ws(":", *[F.substring(digits, 1 + 2 * i, 2) for i in range(6)])


def flow_type_name(type_no: Column) -> Column:
    name = type_no.cast("string")
    for number, label in FLOW_TYPES.items():
        name = F.when(type_no == number, F.lit(label)).otherwise(name)
    return name


def byte_list_text(raw: Column) -> Column:
    """Bytes as ``[10 0 0 1]``; no bytes as ``[]``."""
    n = F.octet_length(raw)
    items = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
                        lambda i: uint(raw, i, 1).cast("string"))
    return F.when(n == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), F.array_join(items, " "), F.lit("]")))
