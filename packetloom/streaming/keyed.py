"""NetFlow v9 / IPFIX streams with templates and rates as keyed state.

State lives per (router, version, domain): the templates in force, the last rate, and a buffer of packets that have come but
not had their turn. A packet waits until the watermark has passed its receive time; then an event-time timer takes the
buffered packets in the order of a table, (receive time, packet number). So a packet that is late by less than the watermark's
delay is resolved as if it had come in time, and what it announces is learnt at its place. Nothing else is kept: a
template's history is not needed, since no packet is looked at out of order. Templates that have not been announced for
``EXPIRY_SECONDS`` go. State is written by change, as the state store does, and recovered from the checkpoint.

A hot exporter's packets pass one task here; where that matters, ``streaming.netflow`` resolves packets where they lie.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from packetloom.operators.layout import LAYOUT_TYPE, announced_layouts
from packetloom.operators.netflow_flows import PACKET_COLUMNS, explode_records, project_flows
from packetloom.operators.netflow_sets import frame
from packetloom.operators.netflow_state import KEY, judged
from packetloom.sources.packets import NETFLOW, of_channel

LATENESS = "2 minutes"
#: Templates that no packet has announced for so long are forgotten; exporters repeat theirs every few minutes.
EXPIRY_SECONDS = 24 * 3600
#: A buffered packet: its order, whether its bytes alone reject it, its sets, the templates it announces, and its row.
WAITING = ("t long, packet_id long, bad boolean, sets array<struct<idx:int,id:int,pos:int,len:int>>,"
           " told array<struct<set_idx:int,template_id:int,layout:string>>, packet string, payload binary")
IN_FORCE = "layout string, announced long"


class Exporter(StatefulProcessor):
    """One exporter's templates, rate and waiting packets."""

    def __init__(self, expiry_seconds: int = EXPIRY_SECONDS):
        self.expiry_micros = expiry_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.templates = handle.getMapState("templates", "template_id int", IN_FORCE)
        self.rate = handle.getValueState("rate", "rate long")
        self.waiting = handle.getListState("waiting", WAITING)
        self.turn = handle.getValueState("turn", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ("t", "packet_id", "bad", "sets", "told", "packet", "payload")]
        first = None
        for frame_ in rows:
            new = [self._plain(r) for r in frame_[names].itertuples(index=False)]
            if new:
                self.waiting.appendList(new)
                first = min([first or new[0][0], *(r[0] for r in new)])
        if first is not None:
            self._wake(first)
        return iter(())

    @staticmethod
    def _plain(row) -> tuple:
        return (int(row.t), int(row.packet_id), bool(row.bad), [(int(s["idx"]), int(s["id"]), int(s["pos"]), int(s["len"])) for s in row.sets],
                [(int(a["set_idx"]), int(a["template_id"]), a["layout"]) for a in row.told], row.packet, bytes(row.payload))

    def _wake(self, t: int) -> None:
        """One timer, for the packet whose turn is next. A packet's microsecond has passed with the millisecond after it."""
        at = t // 1000 + 1
        if self.turn.exists():
            known = self.turn.get()[0]
            if known <= at:
                return
            self.handle.deleteTimer(known)
        self.handle.registerTimer(at)
        self.turn.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self.turn.clear()
        due, later = [], []
        for t, packet_id, bad, sets, told, *rest in self.waiting.get():
            row = (t, packet_id, bad, [tuple(x) for x in sets], [tuple(x) for x in told], *rest)
            (due if t // 1000 < now else later).append(row)
        if later:
            self.waiting.put(later)
            self._wake(min(r[0] for r in later))
        else:
            self.waiting.clear()
        known = {k[0]: tuple(v) for k, v in self.templates.iterator()}
        before = dict(known)
        rate = before_rate = self.rate.get()[0] if self.rate.exists() else None
        out = []
        for t, packet_id, bad, sets, told, packet, payload in sorted(due, key=lambda r: (r[0], r[1])):
            for gone in [k for k, (_, at) in known.items() if at < t - self.expiry_micros]:
                del known[gone]
            found, own, rejected = self._resolved(known, t, sets, told, payload)
            if own is not None and not rejected and not bad:
                rate = own
            out.append((packet, payload, [tuple(s) for s in sets], found, rate or 0))
        for template_id, value in known.items():
            if before.get(template_id) != value:
                self.templates.updateValue((template_id,), value)
        for template_id in before.keys() - known.keys():
            self.templates.removeKey((template_id,))
        if rate != before_rate:
            self.rate.update((rate,))
        if out:
            frame_ = pd.DataFrame(out, columns=["packet", "payload", "sets", "layouts", "sampling_rate"])
            frame_["sets"] = [[dict(zip(("idx", "id", "pos", "len"), s, strict=True)) for s in x] for x in frame_["sets"]]
            yield frame_

    @staticmethod
    def _resolved(known: dict, t: int, sets: list, told: list, payload: bytes):
        """The layout of each data set (None from a missing one on), the packet's own rate, and whether a set rejects it.
        Templates are learnt as they come, up to a set whose template is missing."""
        found, own, rejected = [], None, False
        for idx, set_id, pos, length in sets:
            if set_id < 256:
                for _, template_id, layout in (a for a in told if a[0] == idx):
                    known[template_id] = (layout, t)
                continue
            layout = known.get(set_id, (None,))[0]
            found.append(layout)
            if layout is None:
                return found, None, True
            about = json.loads(layout)
            size, slot = about["size"], about.get("rate_slot")
            rejected |= size == 0
            if own is None and slot is not None and size and length >= size:
                own = int.from_bytes(payload[pos + (slot >> 16):pos + (slot >> 16) + (slot & 65535)], "big")
        return found, own, rejected

    def close(self) -> None:
        pass


def resolved_stream(packets: DataFrame, lateness: str = LATENESS, expiry_seconds: int = EXPIRY_SECONDS) -> DataFrame:
    """A packet stream with resolved sets, error and ``sampling_rate``, as ``resolve_rated`` gives for a table.

    Packets come out once the watermark has passed them. They need a receive time; later than ``lateness`` they are dropped
    (``streaming.windows`` can keep them aside).
    """
    framed = frame(of_channel(packets, NETFLOW)).withWatermark("recv_time", lateness)
    head = [c for c in framed.columns if c not in ("payload", "sets", "announced")]
    rows = framed.select(
        *KEY, "recv_time", "t", "packet_id", F.col("bad").isNotNull().alias("bad"), "sets",
        F.transform(announced_layouts(), lambda a: F.struct(a["set_idx"].alias("set_idx"), a["template_id"].alias("template_id"),
                                                            F.to_json(a["layout"]).alias("layout"))).alias("told"),
        F.to_json(F.struct(*head)).alias("packet"), "payload")
    told = rows.groupBy(*KEY).transformWithStateInPandas(
        Exporter(expiry_seconds), "packet string, payload binary, sets array<struct<idx:int,id:int,pos:int,len:int>>,"
        " layouts array<string>, sampling_rate long", "Append", "EventTime")
    head_type = framed.select(*head).schema
    back = told.select(F.from_json("packet", head_type).alias("p"), "payload", "sets", "layouts", "sampling_rate").select(
        "p.*", "payload", "sets", "layouts", "sampling_rate")
    data = F.filter("sets", lambda s: s["id"] >= 256)
    layouts = F.transform("layouts", lambda x: F.from_json(x, LAYOUT_TYPE))
    found = back.withColumn("_layouts", layouts).withColumn("rsets", F.transform(data, lambda s, i: F.struct(
        s["idx"].alias("idx"), s["id"].alias("id"), s["pos"].alias("pos"), s["len"].alias("len"),
        F.get("_layouts", i).alias("layout"))))
    return judged(found.drop("_layouts", "layouts"))


def flows_from_netflow_stream(packets: DataFrame, lateness: str = LATENESS, expiry_seconds: int = EXPIRY_SECONDS) -> DataFrame:
    """A stream of packets to a stream of flows, for any sink."""
    resolved = resolved_stream(packets, lateness, expiry_seconds)
    return project_flows(explode_records(resolved, "data", [*PACKET_COLUMNS, "sampling_rate"]))
