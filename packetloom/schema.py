"""Table schemas: captured packets in, normalised flows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PACKET_SCHEMA = T.StructType([
    T.StructField("packet_id", T.LongType(), False),
    T.StructField("channel", T.StringType(), False),
    T.StructField("src", T.BinaryType(), False),
    T.StructField("src_port", T.IntegerType(), True),
    T.StructField("payload", T.BinaryType(), False),
    T.StructField("recv_time", T.TimestampType(), True),
])

# The 63 flow fields with their protobuf tag, in listing order.
# Kind: e = enum, n = unsigned up to 32 bits, q = unsigned 64 bits, a = address, b = boolean.
FLOW_FIELDS = [
    ("Type", 1, "e"), ("TimeReceived", 2, "q"), ("SequenceNum", 4, "n"), ("SamplingRate", 3, "q"),
    ("FlowDirection", 42, "n"), ("SamplerAddress", 11, "a"), ("TimeFlowStart", 38, "q"),
    ("TimeFlowEnd", 5, "q"), ("Bytes", 9, "q"), ("Packets", 10, "q"), ("SrcAddr", 6, "a"),
    ("DstAddr", 7, "a"), ("Etype", 30, "n"), ("Proto", 20, "n"), ("SrcPort", 21, "n"),
    ("DstPort", 22, "n"), ("InIf", 18, "n"), ("OutIf", 19, "n"), ("SrcMac", 27, "q"),
    ("DstMac", 28, "q"), ("SrcVlan", 33, "n"), ("DstVlan", 34, "n"), ("VlanId", 29, "n"),
    ("IngressVrfID", 39, "n"), ("EgressVrfID", 40, "n"), ("IPTos", 23, "n"),
    ("ForwardingStatus", 24, "n"), ("IPTTL", 25, "n"), ("TCPFlags", 26, "n"), ("IcmpType", 31, "n"),
    ("IcmpCode", 32, "n"), ("IPv6FlowLabel", 37, "n"), ("FragmentId", 35, "n"),
    ("FragmentOffset", 36, "n"), ("BiFlowDirection", 41, "n"), ("SrcAS", 14, "n"), ("DstAS", 15, "n"),
    ("NextHop", 12, "a"), ("NextHopAS", 13, "n"), ("SrcNet", 16, "n"), ("DstNet", 17, "n"),
    ("HasEncap", 43, "b"), ("SrcAddrEncap", 44, "a"), ("DstAddrEncap", 45, "a"), ("ProtoEncap", 46, "n"),
    ("EtypeEncap", 47, "n"), ("IPTosEncap", 48, "n"), ("IPTTLEncap", 49, "n"),
    ("IPv6FlowLabelEncap", 50, "n"), ("FragmentIdEncap", 51, "n"), ("FragmentOffsetEncap", 52, "n"),
    ("HasMPLS", 53, "b"), ("MPLSCount", 54, "n"), ("MPLS1TTL", 55, "n"), ("MPLS1Label", 56, "n"),
    ("MPLS2TTL", 57, "n"), ("MPLS2Label", 58, "n"), ("MPLS3TTL", 59, "n"), ("MPLS3Label", 60, "n"),
    ("MPLSLastTTL", 61, "n"), ("MPLSLastLabel", 62, "n"), ("HasPPP", 63, "b"),
    ("PPPAddressControl", 64, "n"),
]
FLOW_COLUMNS = [name for name, _, _ in FLOW_FIELDS]
FLOW_KIND = {name: kind for name, _, kind in FLOW_FIELDS}

# Columns the engine adds to a flow to say which packet it came from; never null.
PROVENANCE = ["packet_id", "is_padding"]

# Numbers and names of the flow types.
FLOW_TYPES = {0: "FLOWUNKNOWN", 1: "SFLOW_5", 2: "NETFLOW_V5", 3: "NETFLOW_V9", 4: "IPFIX"}
SFLOW_5, NETFLOW_V5, NETFLOW_V9, IPFIX = 1, 2, 3, 4

_SPARK_TYPE = {"e": T.IntegerType(), "n": T.LongType(), "q": T.LongType(), "a": T.BinaryType(),
               "b": T.BooleanType()}
_EMPTY = {"e": 0, "n": 0, "q": 0, "a": b"", "b": False}

FLOW_SCHEMA = T.StructType([T.StructField(n, _SPARK_TYPE[k], False) for n, _, k in FLOW_FIELDS])


def zero_of(name: str) -> Column:
    """The value an unset flow field has: 0, empty bytes or false, never null."""
    kind = FLOW_KIND[name]
    return F.lit(_EMPTY[kind]).cast(_SPARK_TYPE[kind])


def to_flow_columns(df: DataFrame, values: dict[str, Column], extra: list[str] | None = None) -> DataFrame:
    """Project ``values`` onto the 63 flow columns, filling fields the protocol does not carry.

    ``extra`` names columns of ``df`` that ride along behind the flow (provenance, user columns).
    """
    unknown = set(values) - set(FLOW_COLUMNS)
    if unknown:
        raise ValueError(f"not flow fields: {sorted(unknown)}")
    out = []
    for name, _, kind in FLOW_FIELDS:
        if name in values:
            out.append(F.coalesce(values[name].cast(_SPARK_TYPE[kind]), zero_of(name)).alias(name))
        else:
            out.append(zero_of(name).alias(name))
    return df.select(*out, *(extra or []))
