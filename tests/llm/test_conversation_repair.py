"""Repair of conversations against a dynamic program from the right, and over parts cut at any place."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from packetloom.llm import conversation_repair as cr
from packetloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, fault), each row for itself, from the last row back."""
    after = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}
    name = {"u": "user", "a": "assistant"}
    best = {}
    for i in range(len(rows), -1, -1):
        for _ in range(5):  # as many inserted turns as can ever help
            for state in after:
                ways = [best[i, state]] if (i, state) in best else []
                if i == len(rows) and state in ("", "a"):
                    ways.append((0, "", ()))
                turn = after[state][-1]
                if (i, turn) in best:
                    cost, audit, out = best[i, turn]
                    ways.append((cost + 5, "I" + audit, ((name[turn], ""), *out)))
                if i < len(rows):
                    role, text, fault = rows[i]
                    if (i + 1, state) in best:
                        cost, audit, out = best[i + 1, state]
                        ways.append((cost + 2, "D" + audit, out))
                    more = 5 * (fault == "truncated")
                    if fault not in ("blank", "duplicate"):
                        if role[:1] in after[state] and role and (i + 1, role[0]) in best:
                            cost, audit, out = best[i + 1, role[0]]
                            ways.append((cost + more, "K" + audit, ((role, text), *out)))
                        if (i + 1, turn) in best:
                            cost, audit, out = best[i + 1, turn]
                            ways.append((cost + more + 1, "R" + audit, ((name[turn], text), *out)))
                if ways:
                    best[i, state] = min(ways)
    return best[0, ""]


def brute(table, damage=True):
    groups = defaultdict(list)
    for conv_id, turn, role, text in table:
        groups[conv_id]
        conv, at, role, text = (" " if x is None else x for x in (conv_id, turn, role, text))
        kind = zlib.crc32(f"{conv}:{at}".encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        groups[conv_id] += [row, row] if kind == 3 else [row]
    out = {}
    for conv_id, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            solid = SOLID.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in rows if t is not None}
        cost, audit, lines = cheapest([(r, t, f) for (_, r, t), f in zip(rows, faults, strict=True)])
        out[conv_id] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"),
                        faults.count("duplicate"), faults.count("truncated"),
                        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
                        cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[f] for f in FIELDS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_equals_the_dynamic_program(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(QUERIES["op13_conversation_repair"](spark, SMALL)) == brute(table)


def random_rows(seed, n, conversations):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    texts = ["One.", "Two!", "three", "", " \n", "Four?", "é .", None, "five. \t", *(f"Text {i}." for i in range(12))]
    return [(pick.choice(conversations), pick.choice([None, *range(-3, 40)]), pick.choice(roles), pick.choice(texts))
            for _ in range(n)]


@pytest.mark.parametrize("part_bytes", [150, 1 << 20])
def test_odd_rows_and_a_conversation_over_many_tasks(spark, part_bytes):
    # one conversation holds more rows than all others; nulls, ties, repeated rows, unknown and empty roles
    rows = random_rows(1, 300, [1, 2, 3, 4, None]) + random_rows(2, 400, [7]) + [(9, 5, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS part", "1 AS times", "0 AS kind").repartition(5)
    got = cr.digests(cr.repaired(cr.damaged(df), df, part_bytes))
    assert found(got) == brute(rows)


def test_repaired_rows_are_a_conversation(spark):
    rows = random_rows(3, 200, [1, 2, 3])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = defaultdict(str)
    for r in cr.repaired(cr.damaged(df), df, 200).orderBy("conv_id", "part").collect():
        out[r.conv_id] += "".join(x.role[0] for x in r.repaired)
    assert set(out) == {1, 2, 3} and all(re.fullmatch("(s?(ua)+)?", x) for x in out.values())


def test_conversations_without_rows_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    nothing = spark.createDataFrame([], schema)
    assert found(cr.digests(cr.repaired(cr.damaged(nothing), nothing))) == {}
    turn = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    dropped = spark.createDataFrame([(5, turn, "user", "x.")], schema)
    assert found(cr.digests(cr.repaired(cr.damaged(dropped), dropped))) == {
        5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_agenda_equals_the_dynamic_program_on_all_short_conversations():
    kinds = [("system", "s."), ("user", "u."), ("assistant", "a."), ("user", "cut"), ("tool", "t.")]
    faults = {"cut": cr.CUT_SHORT}
    names = {cr.CUT_SHORT: "truncated", cr.SOUND: ""}
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            own = [(r, t, 1, faults.get(t, cr.SOUND)) for r, t in rows]
            items = {t: w for (_, t), w in cr.part_items(own, (cr.START,)).items()}
            state, cost, tail = cr.ended(items)
            audit = items[state][1] + tail
            assert (cost, audit) == cr.solved(own)
            assert (cost, audit, tuple(cr.rebuilt(own, cr.START, audit))) == cheapest(
                [(r, t, names[f]) for r, t, _, f in own])
