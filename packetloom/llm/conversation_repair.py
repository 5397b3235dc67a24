"""Conversations put back into the order (system) user assistant user assistant ..., at the least cost.

Repair is a weighted deduction. An item says "so many rows are read, and what was kept so far ends in this state"; a
deduction joins an item with one edit: keep (cost 0), another role (1), delete (2), or an inserted empty turn (5); a
truncated row that stays costs 5 more. Weights are (cost, audit), audit being the initials of the edits; joining adds
costs and appends initials. Both are superior: a conclusion never weighs less than what it follows from, since an
appended audit is greater than its beginning. Both are monotone: two audits of one item and one cost hold one letter per
row and equally many inserted ones, so none is the beginning of the other. So Knuth's agenda pops items by weight, and the
first weight of an item is its final one.

Rows are sorted over all tasks by range of (conversation, turn, role, text), so a conversation that holds a third of all rows
lies in many tasks. What lies within one task is repaired there. Of a conversation cut by task borders each part is solved
for every state it may start in; a part then is at most eleven (from, to, cost, rank) rows, these are joined in
order, and each part takes the audit of the states chosen for it. A part's audits are compared by rank, which is the
order of whole audits, as inserted turns belong to the part of the row that follows them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from packetloom.llm.components import settled

INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
#: States by what the kept rows end in. Nothing, a system turn, a user turn, an assistant turn; the goal is the first or last.
START, SYSTEM, USER, ASSISTANT = range(4)
GOAL = (START, ASSISTANT)
STATES = {"": START, "s": SYSTEM, "u": USER, "a": ASSISTANT}
AFTER = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = {"su", "ua", "au"}
#: Rows of a block that one agenda solves, and bytes of text of a part that is handed on as one row.
BLOCK, PART_BYTES, ROW_BYTES = 64, 8 << 20, 64
#: First fault of a row.
SOUND, BLANK, DUPLICATE, CUT_SHORT = range(4)

GAP = r"\x20\x09-\x0D"
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def lightest(first, deductions: Callable, goal: Callable) -> dict:
    """Knuth's agenda: item -> least (cost, audit), in the order in which items became final, up to the goal.

    ``deductions(item)`` gives (cost, audit, conclusion); its second antecedent, the edit, is an axiom.
    """
    agenda, final = [(0, "", first)], {}
    while agenda:
        cost, audit, item = heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if goal(item):
            break
        for more, letters, conclusion in deductions(item):
            if conclusion not in final:
                heappush(agenda, (cost + more, audit + letters, conclusion))
    return final


def _edits(row, state: int) -> Iterator[tuple[int, str, int]]:
    """(cost, letters, state after it) of every edit of a row; a row is (role, text, times, first fault)."""
    role, _, times, fault = row
    if fault in (BLANK, DUPLICATE):
        yield DELETE * times, "D" * times, state
        return
    rest, copies = DELETE * (times - 1), "D" * (times - 1)
    yield DELETE + rest, "D" + copies, state
    stays = rest + (TRUNCATED if fault == CUT_SHORT else 0)
    if role[:1] and role[:1] in AFTER[state]:
        yield stays, "K" + copies, STATES[role[0]]
    turn = AFTER[state][-1]
    yield stays + REROLE, "R" + copies, STATES[turn]


def _deductions(rows: list, item: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """What follows from an item (rows read, state) and one edit; inserted turns stand before a row."""
    at, state = item
    if at < len(rows):
        yield INSERT, "I", (at, STATES[AFTER[state][-1]])
        for cost, letters, after in _edits(rows[at], state):
            yield cost, letters, (at + 1, after)


def solved(rows: list) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation: the agenda ends when the goal item is final."""
    goal = (len(rows) + 1, START)

    def deductions(item):
        yield from _deductions(rows, item)
        at, state = item
        if at == len(rows):
            yield (0, "", goal) if state in GOAL else (INSERT, "I", (at, STATES[AFTER[state][-1]]))

    return lightest((0, START), deductions, lambda item: item == goal)[goal]


def block_items(rows: list, start: int) -> dict[int, tuple[int, str]]:
    """State after the rows -> (cost, audit), from one state before them."""
    final = lightest((0, start), lambda item: _deductions(rows, item), lambda item: False)
    return {state: weight for (at, state), weight in final.items() if at == len(rows)}


def joined(parts: list[dict], start: int) -> dict[int, tuple[int, list]]:
    """State after all parts -> (cost, (from, to) of each part); a part is (from, to) -> (cost, rank).

    Part by part is an order in which every antecedent is final before its conclusion. Paths are compared by the ranks of
    their parts, from the first on; of the few paths kept at a border only their order is.
    """
    best, steps = {start: (0, 0)}, []
    for part in parts:
        found: dict = {}
        for (before, after), (cost, rank) in part.items():
            if before in best:
                weight = (best[before][0] + cost, best[before][1], rank, before)
                if after not in found or weight < found[after]:
                    found[after] = weight
        order = {w[1:3]: i for i, w in enumerate(sorted(found.values(), key=lambda w: w[1:3]))}
        best = {after: (w[0], order[w[1:3]]) for after, w in found.items()}
        steps.append({after: w[3] for after, w in found.items()})
    out = {}
    for state, (cost, _) in best.items():
        path, after = [], state
        for step in reversed(steps):
            path.append((step[after], after))
            after = step[after]
        out[state] = cost, path[::-1]
    return out


def _ranked(items: dict[tuple[int, int], tuple[int, str]]) -> dict[tuple[int, int], tuple[int, int]]:
    order = {audit: i for i, audit in enumerate(sorted({audit for _, audit in items.values()}))}
    return {key: (cost, order[audit]) for key, (cost, audit) in items.items()}


def part_items(rows: list, starts=tuple(AFTER)) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, state after) -> least (cost, audit) over rows of any number, solved block by block."""
    if len(rows) <= BLOCK:
        return {(s, t): w for s in starts for t, w in block_items(rows, s).items()}
    blocks = [{(s, t): w for s in AFTER for t, w in block_items(rows[at:at + BLOCK], s).items()}
              for at in range(0, len(rows), BLOCK)]
    ranked = [_ranked(b) for b in blocks]
    return {(s, t): (cost, "".join([b[step][1] for b, step in zip(blocks, path, strict=True)]))
            for s in starts for t, (cost, path) in joined(ranked, s).items()}


def ended(items: dict[int, tuple]) -> tuple[int, int, str]:
    """(state, cost, inserted turns) of the cheapest end; ``items``: state -> (cost, audit or its rank)."""
    ways = []
    for state, (cost, audit) in items.items():
        tail = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}[state]
        ways.append((cost + INSERT * len(tail), audit, state, tail))
    cost, _, state, tail = min(ways)
    return state, cost, tail


def rebuilt(rows: list, state: int, audit: str) -> list[tuple[str, str]]:
    """The (role, text) rows that an audit leaves."""
    out, letters = [], iter(audit)

    def put(role, text, initial):
        nonlocal state
        out.append((role, text))
        state = STATES[initial]

    def inserted():
        for letter in letters:
            if letter != "I":
                return letter
            put(ROLE[AFTER[state][-1]], "", AFTER[state][-1])
        return None

    for role, text, times, _ in rows:
        letter = inserted()
        if letter == "K":
            put(role, text, role[0])
        elif letter == "R":
            put(ROLE[AFTER[state][-1]], text, AFTER[state][-1])
        for _ in range(times - 1):
            next(letters)
    inserted()
    return out


# --- rows -------------------------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times): every row by crc32("conv_id:turn") % 20 dropped (0), emptied (1), without [.!?]
    (2), twice (3), made a user turn (4) or as it is. Nulls are read as one space in all four, turn stays null as order."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    kind = F.col("_kind")
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.pmod(F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")), F.lit(20)).alias("_kind"))
    return rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("times"))


def _ordered(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Equal rows once with their number; marks ahead of a text's first row, and one row ahead of every conversation.

    A text's first turn is found by an aggregate over (conversation, role, text) and not by looking back, so no task
    needs a conversation's earlier texts. A mark sorts next to the row it is for and has the same range key.
    """
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    equal = equal.select("conv_id", "turn", "role", digest, F.lit(2).alias("kind"), "text", "times")
    first = rows.select("conv_id", "turn", "role", digest).groupBy("conv_id", "role", "digest").agg(
        F.min(F.struct("turn")).alias("at"))
    first = first.select("conv_id", "at.turn", "role", "digest", F.lit(1).alias("kind"))
    heads = ids.select("conv_id").distinct().withColumn("kind", F.lit(0))
    table = equal.unionByName(first, allowMissingColumns=True).unionByName(heads, allowMissingColumns=True)
    key = ["conv_id", "turn", "role", "digest"]
    return table.repartitionByRange(*key).sortWithinPartitions(*key, "kind")


class _Part:
    """Adjacent rows of one conversation within one task."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number, self.rows, self.bytes = conv_id, number, [], 0
        self.count = dict.fromkeys(COUNTS, 0)
        self.turns: list = []  # first, last, least, greatest, distinct
        self.initials = None  # of the first and the last row

    def add(self, turn, role: str, text: str, times: int, fault: int) -> None:
        sound = fault in (SOUND, CUT_SHORT)
        self.count["blank"] += times * (fault == BLANK)
        self.count["duplicate"] += times * (fault == DUPLICATE) + (times - 1) * sound
        self.count["truncated"] += fault == CUT_SHORT
        initial = role[:1]
        pair = initial + initial
        self.count["illegal"] += times - 1 if pair not in LEGAL_PAIRS else 0
        if self.initials is None:
            self.initials = [initial, initial]
        else:
            self.count["illegal"] += self.initials[1] + initial not in LEGAL_PAIRS
            self.initials[1] = initial
        if turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 0]
            self.turns[2] += self.turns[1] != turn or not self.turns[2]
            self.turns[1] = turn
        self.rows.append((role, text, times, fault))
        self.bytes += len(text) + ROW_BYTES


ROWS = "array<struct<role:string,text:string,times:bigint,fault:int>>"
ITEMS = "array<struct<before:int,after:int,cost:bigint,rank:int,audit:string>>"
REPAIRED = "array<struct<role:string,text:string>>"


def _parts_schema(conv_type: str, turn_type: str) -> str:
    return (f"conv_id {conv_type}, part long, whole boolean, first_initial string, last_initial string, first_turn {turn_type},"
            f" last_turn {turn_type}, n_turns long, {', '.join(c + ' long' for c in COUNTS)}, cost long, audit string,"
            f" repaired {REPAIRED}, items {ITEMS}, source {ROWS}")


def _emitted(part: _Part, whole: bool) -> dict:
    first_turn, last_turn, n_turns = part.turns or (None, None, 0)
    out = {"conv_id": part.conv_id, "part": part.number, "whole": whole, "first_turn": first_turn, "last_turn": last_turn,
           "n_turns": n_turns, "first_initial": part.initials and part.initials[0],
           "last_initial": part.initials and part.initials[1], **part.count}
    if whole:
        if len(part.rows) <= BLOCK:
            cost, audit = solved(part.rows)
        else:
            items = {after: w for (_, after), w in part_items(part.rows, (START,)).items()}
            state, cost, tail = ended(items)
            audit = items[state][1] + tail
        repaired = [{"role": r, "text": t} for r, t in rebuilt(part.rows, START, audit)]
        return {**out, "cost": cost, "audit": audit, "repaired": repaired, "items": None, "source": None}
    items = part_items(part.rows)
    ranked = _ranked(items)
    return {**out, "cost": None, "audit": None, "repaired": None,
            "items": [{"before": s, "after": t, "cost": w[0], "rank": ranked[s, t][1], "audit": w[1]}
                      for (s, t), w in items.items()],
            "source": [dict(zip(("role", "text", "times", "fault"), r, strict=True)) for r in part.rows]}


def _cut(frames: Iterator[pa.RecordBatch], part_bytes: int) -> Iterator[_Part]:
    """Parts in order, with the number of their place; ``number`` is unique over tasks and ascends with the order."""
    number, part, mark = TaskContext.get().partitionId() << 32, None, None
    for frame in frames:
        for row in frame.to_pylist():
            conv_id = row["conv_id"]
            if part is None or part.conv_id != conv_id or part.bytes > part_bytes:
                if part is not None:
                    yield part
                number, part = number + 1, _Part(conv_id, number)
            spot = (conv_id, row["turn"], row["role"], row["digest"])
            if row["kind"] == 1:
                mark = spot
            elif row["kind"] == 2:
                fault = row["fault"]
                if fault != BLANK and spot != mark:
                    fault = DUPLICATE
                part.add(row["turn"], row["role"], row["text"], row["times"], fault)
    if part is not None:
        yield part


def _parts(table: DataFrame, part_bytes: int) -> DataFrame:
    """Parts of conversations: whole ones repaired, others as the items their repair may take."""
    types = dict(table.dtypes)
    text = F.col("text")
    fault = F.when(~text.rlike(f"[^{GAP}]"), BLANK).when(text.rlike(rf"[.!?][{GAP}]*\z"), SOUND).otherwise(CUT_SHORT)
    schema = _parts_schema(types["conv_id"], types["turn"])
    rows = table.select(*table.columns, fault.alias("fault"))
    arrow = _arrow_schema(schema)

    def run(frames):
        held: list[_Part] = []  # parts of the conversation at hand
        edge, out, size = True, [], 0  # whether the conversation may have begun in the task before

        def flush(last: bool):
            whole = not edge and not last and len(held) == 1
            return [_emitted(p, whole) for p in held]

        def batches(final: bool):
            nonlocal out, size
            if out and (final or size > part_bytes or len(out) >= 2000):
                yield pa.RecordBatch.from_pylist(out, arrow)
                out, size = [], 0

        for part in _cut(frames, part_bytes):
            if held and held[-1].conv_id != part.conv_id:
                out += flush(False)
                held, edge = [], False
                yield from batches(False)
            elif held:  # one more part of the same conversation: the one before is certainly open
                out += [_emitted(p, False) for p in held]
                held, edge = [], True
                yield from batches(False)
            held.append(part)
            size += part.bytes
        out += flush(True)
        yield from batches(True)

    return rows.mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _chosen(parts: DataFrame) -> DataFrame:
    """For each part of a cut conversation: its states, what is inserted at the end, and the conversation's figures."""
    types = dict(parts.dtypes)
    narrow = parts.select(
        "conv_id", "part", "first_initial", "last_initial", "first_turn", "last_turn", "n_turns", *COUNTS,
        *(F.col(f"items.{c}").alias(f"_{c}") for c in ("before", "after", "cost", "rank")))
    schema = (f"conv_id {types['conv_id']}, part long, n_parts long, before int, after int, tail string, cost long,"
              f" gaps long, {', '.join(c + ' long' for c in COUNTS)}")

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        items = [{(int(b), int(a)): (int(c), int(r)) for b, a, c, r in zip(*x, strict=True)}
                 for x in zip(rows._before, rows._after, rows._cost, rows["_rank"], strict=True)]
        ends = joined(items, START)
        order = {s: i for i, s in enumerate(sorted(ends, key=lambda s: [items[k][p][1] for k, p in enumerate(ends[s][1])]))}
        state, cost, tail = ended({s: (ends[s][0], order[s]) for s in ends})
        out = pd.DataFrame({"conv_id": rows.conv_id, "part": rows.part, "n_parts": len(rows), "cost": cost})
        out["before"], out["after"] = zip(*ends[state][1], strict=True)
        out["tail"] = [""] * (len(rows) - 1) + [tail]
        seen = rows[rows.n_turns > 0]
        distinct = int(seen.n_turns.sum()) - int((seen.first_turn.values[1:] == seen.last_turn.values[:-1]).sum())
        out["gaps"] = int(seen.last_turn.iloc[-1]) - int(seen.first_turn.iloc[0]) + 1 - distinct if len(seen) else 0
        held = rows[rows.first_initial.notna()]
        between = sum(a + b not in LEGAL_PAIRS for a, b in zip(held.last_initial.iloc[:-1], held.first_initial.iloc[1:], strict=True))
        for c in COUNTS:
            out[c] = int(rows[c].sum()) + (between if c == "illegal" else 0)
        return out

    return narrow.groupBy("conv_id").applyInPandas(choose, schema)


def _restored(cut: DataFrame, chosen: DataFrame) -> DataFrame:
    """Cut conversations with the audit and the rows of the states chosen for each part."""
    pick = F.filter("items", lambda x: (x.before == F.col("before")) & (x.after == F.col("after")))[0].audit
    rows = cut.select("part", "items", "source").join(chosen, "part").withColumn(
        "audit", F.concat(pick, "tail")).drop("items", "after", "tail")
    schema = ", ".join(f"{n} {t}" for n, t in rows.drop("before", "source").dtypes) + f", repaired {REPAIRED}"
    arrow = _arrow_schema(schema)

    def run(frames):
        for frame in frames:
            for at in range(frame.num_rows):  # a part may be some megabytes
                row = frame.slice(at, 1).to_pylist()[0]
                source = [(r["role"], r["text"], r["times"], r["fault"]) for r in row.pop("source")]
                row["repaired"] = [{"role": r, "text": t} for r, t in rebuilt(source, row.pop("before"), row["audit"])]
                yield pa.RecordBatch.from_pylist([row], arrow)

    return rows.mapInArrow(run, schema)


def repaired(rows: DataFrame, ids: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The repaired conversations, a row per part: conv_id, part, n_parts, gaps, blank, duplicate, truncated, illegal, cost (all
    of the whole conversation), audit and repaired (array of role, text) of the part.

    ``rows`` has conv_id, turn, role, text (not null) and times (how often the row is there); ``ids`` every conv_id to report,
    with or without rows. Almost all conversations are one part; one cut by task borders has several, in the order of
    ``part``. Rows are taken by (turn, role, digest of the text), null turns first; a null conv_id is a conversation
    of its own. A role whose initial is not s, u or a (an empty one too) can only be changed or deleted.
    """
    parts = settled(_parts(_ordered(rows, ids), part_bytes))
    figures = ["conv_id", "part", "n_parts", "gaps", *COUNTS, "cost", "audit", "repaired"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    whole = parts.where("whole").select("*", gaps.alias("gaps"), F.lit(1).cast("long").alias("n_parts")).select(*figures)
    cut = parts.where("not whole")
    return whole.unionByName(_restored(cut, settled(_chosen(cut))).select(*figures))


def digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``repaired``: its figures, the whole audit, and the SHA-256 of its "role:text" lines.

    A digest is sequential by definition, so parts of a cut conversation pass one task in order, a part at a time.
    """
    lines = F.transform("repaired", lambda x: F.concat(x.role, F.lit(":"), x.text))
    rows = conversations.withColumn("lines", F.array_join(lines, "\n")).withColumn("n_lines", F.size("repaired")).drop("repaired")
    single = rows.where("n_parts = 1").select(
        "*", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256")).drop("part", "n_parts", "lines", "n_lines")
    schema = ", ".join(f"{n} {t}" for n, t in single.dtypes)
    arrow = _arrow_schema(schema)

    def run(frames):
        head, audit, sha, any_line = None, [], None, False

        def done():
            return pa.RecordBatch.from_pylist([{**head, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], arrow)

        for frame in frames:
            for at in range(frame.num_rows):
                row = frame.slice(at, 1).to_pylist()[0]
                if head is None or head["conv_id"] != row["conv_id"]:
                    if head is not None:
                        yield done()
                    head = {n: row[n] for n in arrow.names if n in row}
                    audit, sha, any_line = [], hashlib.sha256(), False
                audit.append(row["audit"])
                if row["n_lines"]:
                    sha.update(("\n" if any_line else "").encode() + row["lines"].encode())
                    any_line = True
        if head is not None:
            yield done()

    several = rows.where("n_parts > 1").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(run, schema)
    return single.unionByName(several)
