"""Templates and sampling rates over time, and their lookup as of a packet.

Exporters repeat their templates and rates all the time but seldom change them. Only the changes are kept, in a small
dimension of one row per (router, version, domain) and slot of time: what is in force when the slot begins, and the changes
inside it. An exporter with few changes has a single slot; one with many has slots of its own width, some
``PER_SLOT`` changes each, so no row grows with its history. Packets join on key and slot where they lie, and the
payloads are not shuffled while the dimension can be broadcast.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from packetloom.functions.binary import uint
from packetloom.operators.layout import slot_at, slot_length, with_layout
from packetloom.plans.tables import BROADCAST_BYTES, join_small, settle, unnest, where_once

KEY = ["router", "version", "domain"]
SPOT = [*KEY, "t", "packet_id", "set_idx"]  # packet numbers are unique in an exporter's second at best
ORDER = ["t", "packet_id", "set_idx", "rec_idx"]
#: What a template's history is kept by, and what makes an announcement a change.
TEMPLATE_VALUE = ([*KEY, "template_id"], ["kind", "field_count", "scopes", "fields"])
RATE_VALUE = (KEY, ["rate"])
# Packets of one exporter are first compared within a slot of time, so no exporter is one sort group.
SLOT_MICROS = 3_600_000_000
#: An exporter with more changes than ``BUSY`` is cut into slots of about ``PER_SLOT`` changes.
BUSY, PER_SLOT = 32, 16


def announcements(framed: DataFrame) -> DataFrame:
    """Template history: one row per announced template, in the order (t, packet_id, set_idx, rec_idx)."""
    return unnest(framed, [*KEY, "t", "packet_id"], F.col("announced"), "a").select(*KEY, "t", "packet_id", "a.*")


def changes(history: DataFrame, keys: list[str], value: list[str], order: list[str]) -> DataFrame:
    """Rows whose ``value`` differs from the row before it under the same key.

    Done twice: inside time slots, where the repeats go, then over the few rows left per key.
    """
    def differs(rows, by):
        w = W.partitionBy(*by).orderBy(*order)
        same = F.lit(True)
        for v in value:
            same = same & F.lag(v).over(w).eqNullSafe(F.col(v))
        first = F.row_number().over(w) == 1
        return rows.withColumn("_new", first | ~same).where("_new").drop("_new")

    slotted = history.withColumn("_slot", F.floor(F.col("t") / SLOT_MICROS))
    return differs(differs(slotted, [*keys, "_slot"]), keys).drop("_slot")


def template_changes(framed: DataFrame, seed: DataFrame | None = None, drop: DataFrame | None = None) -> DataFrame:
    """Template changes with their compiled layout.

    ``seed`` adds templates known beforehand (columns of ``announcements``). ``drop`` lists announcements
    (SPOT) that were never learnt, see ``unlearnt_announcements``.
    """
    history = learnt(framed, drop)
    if seed is not None:
        history = history.unionByName(seed)
    return with_layout(changes(history, *TEMPLATE_VALUE, ORDER))


def learnt(framed: DataFrame, drop: DataFrame | None) -> DataFrame:
    """Announcements without those of ``drop``."""
    history = announcements(framed)
    return history if drop is None else history.join(drop, SPOT, "left_anti")


def compacted(history: DataFrame, keys: list[str], value: list[str], order: list[str], horizon: int) -> DataFrame:
    """All of the last ``horizon`` microseconds of a history, and only the changes before that.

    What repeats within the horizon is kept, as a packet that comes late may still say something else in between.
    """
    newest = history.agg(F.max("t")).first()[0]  # one number
    if newest is None:
        return history
    old = changes(history.where(F.col("t") < newest - horizon), keys, value, order)
    return old.unionByName(history.where(F.col("t") >= newest - horizon))


class Timeline(NamedTuple):
    """``rows``: KEY, slot and the array of entries. ``busy``: KEY, first change and slot width of exporters with several
    slots, None where no exporter has."""
    rows: DataFrame
    busy: DataFrame | None

    def unpersist(self) -> None:
        for kept in self:
            if kept is not None:
                kept.unpersist()


def timeline_of(changed: DataFrame, entity: list[str], entry: list[str], name: str, busy: int = BUSY) -> Timeline:
    """Slots of a history of changes. ``entity`` names what a change replaces the value of, ``entry`` what is kept of it.

    A change is listed in its own slot and at the start of the later ones, up to the slot of the next change of the same
    entity. Times before the first change fall into the first slot, times after the last one into the last slot.
    """
    changed = settle(changed)
    per_key = settle(changed.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("t").alias("first"), F.max("t").alias("last")).where(
        F.col("n") > busy).select(*KEY, "first", "last", F.greatest(F.lit(1).cast("bigint"), F.ceil(
            (F.col("last") - F.col("first") + 1) / F.ceil(F.col("n") / PER_SLOT))).alias("width")))
    entries = F.array_sort(F.collect_list(F.struct(*entry))).alias(name)
    if per_key.isEmpty():
        per_key.unpersist()
        rows = settle(changed.groupBy(*KEY).agg(entries).withColumn("slot", F.lit(0).cast("bigint")))
        changed.unpersist()
        return Timeline(rows, None)
    slot = F.coalesce(F.floor((F.col("t") - F.col("first")) / F.col("width")), F.lit(0)).cast("bigint")
    placed = join_small(changed, per_key, KEY).withColumn("own", slot).withColumn(
        "end", F.coalesce(F.floor((F.col("last") - F.col("first")) / F.col("width")), F.lit(0)).cast("bigint"))
    following = F.lead("own").over(W.partitionBy(*entity).orderBy(*[c for c in ORDER if c in changed.columns]))
    spread = placed.withColumn("until", F.coalesce(following, F.col("end"))).withColumn(
        "slot", F.explode(F.sequence("own", "until")))
    rows = settle(spread.groupBy(*KEY, "slot").agg(entries))
    changed.unpersist()
    return Timeline(rows, per_key)


def join_timeline(packets: DataFrame, timeline: Timeline, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Packets with the entries of their slot; beyond the size that is broadcast, exporters are split over ``SALTS`` tasks."""
    first = F.lit(0).cast("bigint")
    if timeline.busy is None:
        slotted = packets.withColumn("slot", first)
    else:
        last = F.floor((F.col("last") - F.col("first")) / F.col("width"))
        own = F.floor((F.col("t") - F.col("first")) / F.col("width"))
        slotted = join_small(packets, timeline.busy, KEY, limit=limit).withColumn(
            "slot", F.coalesce(F.greatest(F.least(own, last), first), first).cast("bigint")).drop("first", "last", "width")
    return join_small(slotted, timeline.rows, [*KEY, "slot"], limit=limit, salt=F.xxhash64("packet_id")).drop("slot")


def template_timeline(framed: DataFrame, seed: DataFrame | None = None, with_fields: bool = False,
                      drop: DataFrame | None = None) -> Timeline:
    return templates_of(template_changes(framed, seed, drop), with_fields)


def templates_of(changed: DataFrame, with_fields: bool = False) -> Timeline:
    entry = [*ORDER, "template_id", "layout"] + (["scopes", "fields"] if with_fields else [])
    return timeline_of(changed, TEMPLATE_VALUE[0], entry, "templates")


def _before(entry: Column, set_idx: Column) -> Column:
    """Whether a timeline entry comes before a set of the packet of the row at hand."""
    t, pid = F.col("t"), F.col("packet_id")
    return (entry["t"] < t) | ((entry["t"] == t) & (
        (entry["packet_id"] < pid) | ((entry["packet_id"] == pid) & (entry["set_idx"] < set_idx))))


def resolve_sets(framed: DataFrame, timeline: Timeline, with_fields: bool = False,
                 limit: int = BROADCAST_BYTES) -> DataFrame:
    """Packets with ``rsets`` (data sets and the layout each had on arrival) and their final ``error``.

    ``error_idx`` is the set that rejects the packet. A rejected packet keeps its ``rsets``; callers that
    want accepted data filter on ``error``.
    """
    joined = join_timeline(framed, timeline, limit)
    extra = ["scopes", "fields"] if with_fields else []

    def look_up(s):
        past = F.filter("templates", lambda e: (e["template_id"] == s["id"]) & _before(e, s["idx"]))
        last = F.try_element_at(past, F.lit(-1))
        return F.struct(s["idx"].alias("idx"), s["id"].alias("id"), s["pos"].alias("pos"), s["len"].alias("len"),
                        last["layout"].alias("layout"), *[last[c].alias(c) for c in extra])

    found = joined.withColumn("rsets", F.transform(F.filter("sets", lambda s: s["id"] >= 256), look_up))
    return judged(found.drop("templates"))


def judged(found: DataFrame) -> DataFrame:
    """Add ``error`` and ``error_idx``: the first failing set of the packet decides."""
    missing = F.array_min(F.transform(F.filter("rsets", lambda s: s["layout"].isNull()), lambda s: s["idx"]))
    empty = F.array_min(F.transform(F.filter("rsets", lambda s: s["layout"]["size"] == 0), lambda s: s["idx"]))
    seen = found.withColumns({"_missing": missing, "_empty": empty})
    first = F.least("_missing", "_empty")  # nulls are skipped
    error = (F.when(F.col("_missing") == first, "template_not_found")
             .when(F.col("_empty") == first, "empty_template").otherwise(F.col("bad")))
    return seen.withColumns({
        "error": error, "error_idx": F.coalesce(first, F.col("bad_idx")), "own_rate": own_sampling_rate(),
    }).drop("_missing", "_empty")


def record_count(s: Column) -> Column:
    """Records in a resolved set; bytes left over are padding."""
    size = s["layout"]["size"]
    return F.when(size > 0, F.floor(s["len"] / size)).otherwise(F.lit(0)).cast("int")


def own_sampling_rate() -> Column:
    """The rate told by the packet's own option data: of the first set that has one, its first record."""
    telling = F.get(F.filter("rsets", lambda s: (s["layout"]["rate_slot"].isNotNull()) & (record_count(s) > 0)), 0)
    packed = telling["layout"]["rate_slot"]
    return F.when(packed.isNotNull(), uint(F.col("payload"), telling["pos"] + slot_at(packed), slot_length(packed)))


def sampling_changes(resolved: DataFrame, seed: DataFrame | None = None) -> DataFrame:
    """Sampling-rate changes told by accepted packets: KEY, t, packet_id, rate."""
    told = told_rates(resolved)
    if seed is not None:
        told = told.unionByName(seed)
    return changes(told, *RATE_VALUE, ["t", "packet_id"])


def told_rates(resolved: DataFrame) -> DataFrame:
    """Every rate an accepted packet tells."""
    rate = F.when(F.col("error").isNull() & F.col("own_rate").isNotNull(), F.array("own_rate"))
    return unnest(resolved, [*KEY, "t", "packet_id"], rate, "rate")


def telling_packets(framed: DataFrame, timeline: Timeline) -> DataFrame:
    """The packets that can tell a rate: those with a set whose id an options template with a rate field had at some time.

    Ids are 16 bits wide, so they are few. Nothing is looked up for all other packets.
    """
    ids = timeline.rows.select(F.explode("templates").alias("e")).where("e.layout.rate_slot IS NOT NULL").agg(
        F.collect_set("e.template_id")).first()[0]
    return where_once(framed, F.exists("sets", lambda s: s["id"].isin(ids))) if ids else framed.where(F.lit(False))


def sampling_timeline(resolved: DataFrame, seed: DataFrame | None = None) -> Timeline:
    return rates_of(sampling_changes(resolved, seed))


def rates_of(changed: DataFrame) -> Timeline:
    return timeline_of(changed, KEY, ["t", "packet_id", "rate"], "rates")


def attach_sampling(resolved: DataFrame, timeline: Timeline, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Add ``sampling_rate``: the packet's own rate, else the last one told before it, else 0."""
    joined = join_timeline(resolved, timeline, limit)
    t, pid = F.col("t"), F.col("packet_id")
    past = F.filter("rates", lambda r: (r["t"] < t) | ((r["t"] == t) & (r["packet_id"] <= pid)))
    rate = F.coalesce("own_rate", F.try_element_at(past, F.lit(-1))["rate"], F.lit(0))
    return joined.withColumn("sampling_rate", rate).drop("rates")


def announcing(packets: DataFrame) -> DataFrame:
    """The announcing packets, framed: keys, time, sets and templates, without the payload. One pass over all packets gives
    this small settled table, and the history of templates follows from it alone."""
    return settle(where_once(packets.select(*KEY, "t", "packet_id", "sets", "announced"),
                             F.exists("sets", lambda s: s["id"] < 256)))


def unlearnt_announcements(framed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Announcements a collector never learns: those behind a set of the same packet whose template is missing.

    A set is missing its template when it comes before the first learnt announcement of its id. Dropping an
    announcement can only make more sets miss theirs, so the list grows until it stands still; only packets
    that announce a template behind a data set take part, and they are rare. ``known`` adds templates learnt before.
    """
    # by the sets alone first, so that templates are read of those few packets only
    first_data = F.array_min(F.transform(F.filter("sets", lambda s: s["id"] >= 256), lambda s: s["idx"]))
    behind = framed.where(F.exists("sets", lambda s: (s["id"] < 256) & (s["idx"] > first_data)))
    refs = behind.select(
        *KEY, "t", "packet_id", F.explode(F.filter("sets", lambda s: s["id"] >= 256)).alias("s"), "announced").where(
        F.exists("announced", lambda a: a["set_idx"] > F.col("s.idx"))).select(
        *KEY, "t", "packet_id", F.col("s.idx").alias("ref_idx"), F.col("s.id").alias("template_id"),
        F.array_distinct(F.transform("announced", lambda a: a["set_idx"])).alias("behind"))
    refs = settle(refs)
    nothing = framed.sparkSession.createDataFrame(
        [], "router string, version int, domain bigint, t bigint, packet_id bigint, set_idx int")
    if refs.isEmpty():
        return nothing
    told = announcements(framed).select(*KEY, "template_id", "t", "packet_id", "set_idx")
    if known is not None:
        told = told.union(known.select(*told.columns))
    rows = settle(told.join(
        settle(refs.select(*KEY, "template_id").distinct()), [*KEY, "template_id"], "left_semi").select(
        *KEY, "template_id", "t", "packet_id", "set_idx"))
    dropped, known = nothing, 0
    while True:
        first = rows.join(dropped, SPOT, "left_anti").groupBy(*KEY, "template_id").agg(
            F.min(F.struct("t", "packet_id", "set_idx")).alias("first"))
        here = F.struct("t", "packet_id", F.col("ref_idx").alias("set_idx"))
        missing = refs.join(first, [*KEY, "template_id"], "left").where(
            F.col("first").isNull() | (here < F.col("first")))
        dropped = settle(missing.select(*KEY, "t", "packet_id", F.explode(F.filter(
            "behind", lambda b: b > F.col("ref_idx"))).alias("set_idx")).distinct())
        count = dropped.count()
        if count == known:
            return dropped
        known = count
