"""NetFlow v9 / IPFIX framing: headers, sets and the templates a packet announces.

Everything here is one narrow pass over the packet table. A packet stays one row: its sets and announced
templates are arrays, so deciding later that a packet is rejected needs no regrouping. The walks are SQL
``aggregate`` folds whose state is the read position and what has been read so far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from packetloom.functions.binary import span, uint
from packetloom.plans.tables import unnest
from packetloom.sources.packets import pinned, received_second, router_key, sampler_address

HEADER_BYTES = {9: 20, 10: 16}
SET_TYPE = "struct<idx:int,id:int,pos:int,len:int>"
FIELD_TYPE = "struct<type:int,length:int>"
TEMPLATE_TYPE = ("struct<set_idx:int,rec_idx:int,template_id:int,kind:string,field_count:int,"
                 f"scopes:array<{FIELD_TYPE}>,fields:array<{FIELD_TYPE}>>")
FIRST_STEPS = 6


def sql_uint(pos: str, size: int, buf: str = "payload") -> str:
    return f"coalesce(cast(conv(hex(substring({buf}, ({pos}) + 1, {size})), 16, 10) as bigint), 0L)"


def sql_let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, computed once per evaluation.

    A fold over nothing, as its finish binds the value. ``get(transform(array(value), ..), 0)`` would ask for its own type at
    every evaluation, and the type of a nested one asks twice for that of the next: time doubles with each level.
    """
    return f"aggregate(array(), {value}, (_same, _none) -> _same, {name} -> {body})"


def sql_empty(element_type: str) -> str:
    return f"cast(array() as array<{element_type}>)"


def read_headers(packets: DataFrame) -> DataFrame:
    """Header columns for both versions; a header cut short leaves the fields it lacks at zero."""
    buf, n = F.col("payload"), F.octet_length("payload")

    def field(pos, size):
        return F.when(n >= pos + size, uint(buf, pos, size)).otherwise(F.lit(0).cast("bigint"))

    head = packets.select(
        "*", router_key().alias("router"), received_second().alias("received"),
        sampler_address().alias("sampler"),
        F.unix_micros(F.coalesce("recv_time", F.current_timestamp())).alias("t"),
        field(0, 2).cast("int").alias("version"), field(2, 2).cast("int").alias("header_count"))
    v9 = F.col("version") == 9
    return head.select(
        "*",
        F.when(v9, field(16, 4)).otherwise(field(12, 4)).alias("domain"),
        F.when(v9, field(4, 4)).otherwise(F.lit(0).cast("bigint")).alias("uptime"),
        F.when(v9, field(8, 4)).otherwise(field(4, 4)).alias("base_time"),
        F.when(v9, field(12, 4)).otherwise(field(8, 4)).alias("sequence"),
    )


def _walk_sets(start: str, first: str, last: str) -> Column:
    """Advance the set walk; it stands still once it has failed or reached the end of the packet."""
    fail = "named_struct('pos', acc.pos, 'idx', acc.idx, 'bad', {}, 'sets', acc.sets)"
    left = "(octet_length(payload) - acc.pos)"
    take = f"""
        CASE WHEN {left} < 4 OR h.len < 4 THEN {fail.format("'error_decoding'")}
             WHEN NOT (h.id >= 256 OR IF(version = 9, h.id IN (0, 1), h.id IN (2, 3)))
                 THEN {fail.format("'error_flow_id'")}
             ELSE named_struct('pos', acc.pos + h.len, 'idx', acc.idx + 1, 'bad', acc.bad, 'sets',
                 array_append(acc.sets, named_struct('idx', acc.idx, 'id', h.id, 'pos', acc.pos + 4,
                                                     'len', least(h.len - 4, {left} - 4)))) END"""
    split = "named_struct('id', cast(shiftright(w, 16) as int), 'len', cast(w & 65535 as int))"
    return F.expr(f"""
        aggregate(sequence({first}, {last}), {start}, (acc, i) ->
            CASE WHEN acc.bad IS NULL AND acc.pos < octet_length(payload)
                      AND (version = 10 OR acc.idx < header_count)
                 THEN {sql_let("w", sql_uint("acc.pos", 4), sql_let("h", split, take))}
                 ELSE acc END)""")


def _read_fields(first: str, declared: str) -> str:
    """(type, length) pairs from a position on; pairs cut off have type and length 0 and are left out."""
    held = f"least({declared}, greatest((s.pos + s.len - ({first})) div 4, 0L))"
    pair = "named_struct('type', cast(shiftright(w, 16) as int), 'length', cast(w & 65535 as int))"
    words = f"transform(sequence(0L, held - 1), i -> {sql_uint(f'{first} + cast(i as int) * 4', 4)})"
    return sql_let("held", held, f"IF(held > 0, transform({words}, w -> {pair}), {sql_empty(FIELD_TYPE)})")


def _read_templates() -> Column:
    """Templates of the template sets of a packet: one ``struct<idx, bad, templates>`` per such set."""
    head = "IF(s.id IN (0, 2), 4, 6)"
    # three u16: id, then counts (or byte lengths in v9 options); a data template has no third one
    words = f"IF(s.id IN (0, 2), {sql_uint('acc.pos', 4)} * 65536, {sql_uint('acc.pos', 6)})"
    counts = """CASE
        WHEN s.id IN (0, 2) THEN named_struct('scopes', 0L, 'fields', shiftright(w, 16) & 65535L)
        WHEN s.id = 1 THEN named_struct('scopes', (shiftright(w, 16) & 65535L) div 4, 'fields', (w & 65535L) div 4)
        ELSE named_struct('scopes', w & 65535L, 'fields', (shiftright(w, 16) & 65535L) - (w & 65535L)) END"""
    at = f"acc.pos + {head}"
    template = f"""named_struct('set_idx', s.idx, 'rec_idx', size(acc.templates),
        'template_id', cast(shiftright(w, 32) as int), 'kind', IF(s.id IN (0, 2), 'data', 'options'),
        'field_count', cast(n.scopes + n.fields as int), 'scopes', {_read_fields(at, 'n.scopes')},
        'fields', {_read_fields(at + ' + cast(n.scopes as int) * 4', 'n.fields')})"""
    take = f"""IF(n.fields < 0 OR (s.id IN (0, 2) AND n.fields = 0),
        named_struct('pos', acc.pos, 'bad', true, 'templates', acc.templates),
        named_struct('pos', cast({at} + (n.scopes + n.fields) * 4 as int), 'bad', false,
                     'templates', array_append(acc.templates, {template})))"""
    return F.expr(f"""
        transform(filter(walk.sets, s -> s.id < 256), s ->
            aggregate(sequence(0, s.len div 4),
                named_struct('pos', s.pos, 'bad', false, 'templates', {sql_empty(TEMPLATE_TYPE)}),
                (acc, i) -> CASE WHEN NOT acc.bad AND s.pos + s.len - acc.pos >= {head}
                    THEN {sql_let("w", words, sql_let("n", counts, take))} ELSE acc END,
                acc -> named_struct('idx', s.idx, 'bad', acc.bad, 'templates', acc.templates)))""")


def frame(packets: DataFrame) -> DataFrame:
    """One row per packet with ``sets``, ``announced`` templates and the first failure its bytes alone show.

    ``bad`` / ``bad_idx`` name that failure and the position of the failing set; sets from there on are not
    listed, as nothing behind a failing set is read. ``announced`` holds the templates of the listed sets.
    """
    head = read_headers(packets if packets.isStreaming else pinned(packets))
    # a set takes at least four bytes; for v9 the walk also ends at the header's count
    most = f"""IF(version = 9, least(header_count, octet_length(payload) div 4),
                  cast(octet_length(payload) div 4 as int))"""
    start = f"""named_struct('pos', IF(version = 9, {HEADER_BYTES[9]}, {HEADER_BYTES[10]}), 'idx', 0,
                             'bad', cast(null as string), 'sets', {sql_empty(SET_TYPE)})"""
    few = head.withColumn("few", F.when(
        F.expr("version IN (9, 10)"), _walk_sets(start, "1", str(FIRST_STEPS))))
    more = F.expr(f"{most} > {FIRST_STEPS} AND few.bad IS NULL AND few.pos < octet_length(payload)")
    walked = few.withColumn("walk", F.when(more, _walk_sets("few", str(FIRST_STEPS), f"cast({most} as int)"))
                            .otherwise(F.col("few")))
    parsed = walked.withColumn("parsed", _read_templates())
    known = parsed.withColumn("failing", F.expr("array_min(transform(filter(parsed, p -> p.bad), p -> p.idx))"))
    judged = known.withColumn("bad_idx", F.expr("coalesce(failing, IF(walk.bad IS NOT NULL, walk.idx, null))"))
    return judged.select(
        *head.columns,
        F.expr("""CASE WHEN walk IS NULL THEN 'error_version' WHEN failing IS NOT NULL THEN 'error_decoding'
                       ELSE walk.bad END""").alias("bad"), "bad_idx",
        F.expr(f"""coalesce(IF(failing IS NULL, walk.sets, filter(walk.sets, s -> s.idx < failing)),
                            {sql_empty(SET_TYPE)})""").alias("sets"),
        F.expr(f"""coalesce(flatten(transform(filter(parsed, p -> failing IS NULL OR p.idx < failing),
                                              p -> p.templates)), {sql_empty(TEMPLATE_TYPE)})""").alias("announced"))


def template_sets(framed: DataFrame) -> DataFrame:
    return _sets_where(framed, F.col("set.id").isin(0, 2))


def options_template_sets(framed: DataFrame) -> DataFrame:
    return _sets_where(framed, F.col("set.id").isin(1, 3))


def data_sets(framed: DataFrame) -> DataFrame:
    return _sets_where(framed, F.col("set.id") >= 256)


def _sets_where(framed: DataFrame, keep: Column) -> DataFrame:
    rows = unnest(framed, ["packet_id", "router", "version", "domain", "t", "payload"], F.col("sets"), "set")
    return rows.where(keep).select(
        "packet_id", "router", "version", "domain", "t", "set.idx", "set.id",
        span(F.col("payload"), F.col("set.pos"), F.col("set.len")).alias("body"))
