"""From a template to byte slots: where in a record each flow field lies.

A template is turned into slots once, when it is announced. Decoding a record is then a handful of
``substring`` reads per row and never a search through its fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from packetloom.operators.netflow_sets import sql_let

# Flow field -> field ids that fill it, and the bytes its value keeps.
NUMBER_SLOTS = {
    "Bytes": ([1, 23], 8), "Packets": ([2, 24], 8), "Proto": ([4], 4), "IPTos": ([5], 4), "TCPFlags": ([6], 4),
    "SrcPort": ([7], 4), "DstPort": ([11], 4), "InIf": ([10], 4), "OutIf": ([14], 4), "SrcNet": ([9, 29], 4),
    "DstNet": ([13, 30], 4), "SrcAS": ([16], 4), "DstAS": ([17], 4), "IPv6FlowLabel": ([31], 4),
    "IPTTL": ([52], 4), "FragmentId": ([54], 4), "SrcMac": ([56], 8), "DstMac": ([57], 8), "VlanId": ([58], 4),
    "SrcVlan": ([58], 4), "DstVlan": ([59], 4), "FlowDirection": ([61], 4), "ForwardingStatus": ([89], 4),
    "IngressVrfID": ([234], 4), "EgressVrfID": ([235], 4), "BiFlowDirection": ([239], 4),
}
ADDRESS_SLOTS = {"SrcAddr": [8, 27], "DstAddr": [12, 28], "NextHop": [15, 18, 62, 63]}
V4_FIELDS, V6_FIELDS = [8, 12], [27, 28]
ICMP_PAIR, ICMP_TYPE, ICMP_CODE = [32, 139], [176, 178], [177, 179]
FRAGMENT_FIELDS = [88, 197]
UPTIME_START, UPTIME_END = 22, 21
# Absolute times: field id of start, of end, and the units per second.
ABSOLUTE_TIMES = [(150, 151, 1), (152, 153, 1_000), (154, 155, 1_000_000), (156, 157, 1_000_000_000)]
# Option fields that tell a sampling rate, the first one found counts.
RATE_FIELDS = [305, 50, 34]

MAX_NUMBER_BYTES = 8
TIME_SLOTS = ["TimeFlowStart", "TimeFlowEnd"]
ICMP_SLOTS = ["IcmpType", "IcmpCode"]
SLOT_NAMES = [*NUMBER_SLOTS, *ADDRESS_SLOTS, *ICMP_SLOTS, *TIME_SLOTS]
SLOT_INDEX = {name: i for i, name in enumerate(SLOT_NAMES)}

_PLACED = "struct<type:int,length:int,at:bigint>"
LAYOUT_TYPE = ("struct<kind:string,size:bigint,slots:array<bigint>,fragments:array<bigint>,etype:int,"
               "start_unit:bigint,end_unit:bigint,rate_slot:bigint>")


def slot_at(packed: Column) -> Column:
    return F.shiftright(packed, 16)


def slot_length(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(65535).cast("bigint"))


def total_length(fields: Column) -> Column:
    """Template size: the sum of the field lengths."""
    return F.aggregate(fields, F.lit(0).cast("bigint"), lambda acc, f: acc + f["length"])


def place_fields(fields: str, start: str) -> Column:
    """Fields with the offset each one has in a record, from SQL names of the array and its first offset."""
    return F.expr(_placed_sql(fields, start))


def _placed_sql(fields: str, start: str) -> str:
    return f"""
        aggregate({fields}, named_struct('at', cast({start} as bigint), 'out', cast(array() as array<{_PLACED}>)),
            (acc, f) -> named_struct('at', acc.at + f.length, 'out', array_append(
                acc.out, named_struct('type', f.type, 'length', f.length, 'at', acc.at))),
            acc -> acc.out)"""


# How a slot is picked: the ids that fill it, the bytes of the value it keeps, the widest field it accepts.
_ANY_WIDTH = 1 << 20
_PICKS = ([(ids, width, MAX_NUMBER_BYTES) for ids, width in NUMBER_SLOTS.values()]
          + [(ids, _ANY_WIDTH, _ANY_WIDTH) for ids in ADDRESS_SLOTS.values()])


def _ids(ids: list[int]) -> str:
    return "(" + ", ".join(map(str, ids)) + ")"


def _last(condition: str) -> str:
    return f"try_element_at(filter(placed, f -> {condition}), -1)"


def _tail_slot(f: str, width: str) -> str:
    """The last ``width`` bytes of a field, or the whole of a narrower one."""
    keep = f"least({f}.length, {width})"
    return f"(({f}.at + {f}.length - {keep}) * 65536 + {keep})"


def _icmp_slot(direct: list[int], from_end: int) -> str:
    """Type or code byte: of a u16 pair field, or a number of its own; the later field counts."""
    pick = _last(f"f.type IN {_ids(ICMP_PAIR)} OR (f.type IN {_ids(direct)} AND f.length <= {MAX_NUMBER_BYTES})")
    return sql_let("p", pick, f"""
        CASE WHEN p.type NOT IN {_ids(ICMP_PAIR)} THEN {_tail_slot("p", "4")}
             WHEN p.length BETWEEN {from_end} AND {MAX_NUMBER_BYTES} THEN (p.at + p.length - {from_end}) * 65536 + 1
             ELSE p.at * 65536 END""")


def _time_slot(side: int, uptime_field: int) -> str:
    absolute = _last(f"f.type IN {_ids([t[side] for t in ABSOLUTE_TIMES])} AND f.length <= {MAX_NUMBER_BYTES}")
    ticks = sql_let("p", _last(f"f.type = {uptime_field}"),
                    f"IF(p.length > {MAX_NUMBER_BYTES}, p.at * 65536, {_tail_slot('p', '4')})")
    return f"IF(version = 9, {ticks}, {sql_let('p', absolute, _tail_slot('p', '8'))})"


def _time_unit(side: int) -> str:
    units = " ".join(f"WHEN {t[side]} THEN {t[2]}L" for t in ABSOLUTE_TIMES)
    types = _ids([t[side] for t in ABSOLUTE_TIMES])
    return f"CASE {_last(f'f.type IN {types} AND f.length <= {MAX_NUMBER_BYTES}')}.type {units} END"


def _rate_slot() -> str:
    """First field that tells a rate. Four leading bytes make a rate; a narrower field is found with rate 0."""
    found = ", ".join(f"get(filter(placed, f -> f.type = {i}), 0)" for i in RATE_FIELDS)
    return sql_let("p", f"coalesce({found})", "p.at * 65536 + IF(p.length >= 4, 4, 0)")


def _layout_sql() -> str:
    """A layout from the names ``version``, ``kind``, ``fields``, ``placed`` (fields with offsets) and ``_scope_size``."""
    picks = ", ".join(f"named_struct('ids', array({', '.join(map(str, ids))}), 'width', {width}, 'widest', {widest})"
                      for ids, width, widest in _PICKS)
    picked = _last("array_contains(x.ids, f.type) AND f.length <= x.widest")
    others = ", ".join([_icmp_slot(ICMP_TYPE, 2), _icmp_slot(ICMP_CODE, 1), _time_slot(0, UPTIME_START),
                        _time_slot(1, UPTIME_END)])
    family = _last(f"f.type IN {_ids(V4_FIELDS + V6_FIELDS)}") + ".type"
    return f"""cast(named_struct(
        'kind', kind, 'size', _scope_size + aggregate(fields, 0L, (acc, f) -> acc + f.length),
        'slots', concat(
            transform(array({picks}), x -> {sql_let("p", picked, _tail_slot("p", "x.width"))}), array({others})),
        'fragments', transform(
            filter(placed, f -> f.type IN {_ids(FRAGMENT_FIELDS)} AND f.length <= {MAX_NUMBER_BYTES}),
            f -> {_tail_slot("f", "4")}),
        'etype', CASE WHEN {family} IN {_ids(V4_FIELDS)} THEN {0x800} WHEN {family} IN {_ids(V6_FIELDS)} THEN {0x86DD}
                      ELSE 0 END,
        'start_unit', {_time_unit(0)}, 'end_unit', {_time_unit(1)},
        'rate_slot', IF(kind = 'options', {_rate_slot()}, null)) AS {LAYOUT_TYPE})"""


def with_layout(templates: DataFrame) -> DataFrame:
    """Add ``layout`` (``LAYOUT_TYPE``) to rows with ``version``, ``kind``, ``scopes`` and ``fields``."""
    placed = templates.withColumn("_scope_size", total_length(F.col("scopes"))).withColumn(
        "placed", place_fields("fields", "_scope_size"))
    return placed.withColumn("layout", F.expr(_layout_sql())).drop("placed", "_scope_size")


def announced_layouts() -> Column:
    """The templates a framed packet announces as (set_idx, template_id, layout), without leaving its row."""
    sizes = "aggregate(a.scopes, 0L, (acc, f) -> acc + f.length)"
    layout = sql_let("kind", "a.kind", sql_let("fields", "a.fields", sql_let("_scope_size", sizes, sql_let(
        "placed", _placed_sql("fields", "_scope_size"), _layout_sql()))))
    return F.expr(f"""transform(announced, a -> named_struct(
        'set_idx', a.set_idx, 'template_id', a.template_id, 'layout', {layout}))""")
