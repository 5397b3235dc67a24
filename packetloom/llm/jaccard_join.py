"""Exact Jaccard join of documents by word shingles, as components.

Sets are distinct shingles (hashes of 64 bits) of lower-cased words. The order of the prefix filter is by document
frequency, rarest first, counted over the whole corpus (``exchange``). Shingles of one document only come first and
start no index list, so most documents have nothing left to look up and leave here.

What remains uses the relations of sets. *Equal sets* become one. *Index lists* (a shingle and the sets with it in
their prefix) keep each entry's size and position; an entry is skipped where sizes differ too much, where its position
leaves too few shingles to reach the overlap, or where 512-bit parity sketches prove too large a difference. All three
never skip a link. *Answers are derived*: each list first computes the answers of one set of its own; the sets that link
to it take over its component, and only pairs that are not yet in one component are looked at further, so a
large group of near copies is linked through few sets instead of through all pairs. Lists in which several components
remain are cut into blocks and searched block against block; nothing is capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from packetloom.llm import exchange
from packetloom.llm.components import components, fresh, settled
from packetloom.llm.memory import tidy
from packetloom.llm.words import Texts, slices, window_hashes

PERCENT, SHINGLE = 85, 4
SKETCH_WORDS = 8
#: Shingles travel with all their 64 bits (see ``exchange.BITS``).
KEY_BYTES = 6
BLOCK = 512
#: Sets in lists of several are sent to every executor while their number is at most this; beyond it they are joined.
FEW_SETS = 1_000_000
FOUND = ("doc_id long, n long, same long, lead int, prefix array<long>, shared binary, "
         + ", ".join(f"s{i} long" for i in range(SKETCH_WORDS)))


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (64 bits) of every text; shorter texts are one shingle, texts without words none."""
    words = texts.word_hashes(lower=True)
    at = texts.windows(size)
    hashes = window_hashes(words, at, size)
    cut = np.searchsorted(at, texts.first)
    out = []
    for i in range(len(texts)):
        own = hashes[cut[i]:cut[i + 1]]
        if not len(own) and texts.first[i + 1] > texts.first[i]:
            n = texts.first[i + 1] - texts.first[i]
            own = window_hashes(words, texts.first[i:i + 1], n)
        if len(own) > 1:
            own = np.sort(own)
            own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        out.append(own)
    return out


def _keys(size: int):
    def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sets = [x for _, texts in slices(column) for x in shingle_sets(texts, size)]
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
        return keys, np.minimum(counts, 255).astype(np.uint8)

    return keys_of


def _sketch(own: np.ndarray) -> np.ndarray:
    """Parity of how many shingles fall on each of 512 bits: bits that differ never outnumber differing shingles."""
    bits = (own % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    parity = np.bincount(bits, minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.int64)


def _sets(parts: int, size: int, percent: int):
    def back(batch: pa.RecordBatch, answers) -> pa.Table:
        sets = [x for _, texts in slices(batch.column("text")) for x in shingle_sets(texts, size)]
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]))
        shared, often = exchange.shared(keys, answers, parts, KEY_BYTES)
        rows = {k: [] for k in ("n", "same", "lead", "prefix", "shared")}
        sketches = np.zeros((len(sets), SKETCH_WORDS), np.int64)
        for i, own in enumerate(sets):
            n, row = len(own), (len(own), None, None, None, None)
            at = np.searchsorted(shared, own)
            common = np.flatnonzero(shared[np.minimum(at, max(len(shared) - 1, 0))] == own) if len(shared) else at[:0]
            prefix = n - -(-percent * n // 100) + 1
            lead = n - len(common)
            if len(common) and lead < prefix:
                tokens = own[common]
                order = np.lexsort((tokens, often[at[common]]))[:prefix - lead]
                same = int.from_bytes(hashlib.sha256(own.tobytes()).digest()[:8], "little", signed=True)
                row = (n, same, lead, tokens[order].view(np.int64), tokens.tobytes())
                sketches[i] = _sketch(own)
            for k, v in zip(rows, row, strict=True):
                rows[k].append(v)
        longs = pa.list_(pa.int64())
        return pa.table({"doc_id": batch.column("doc_id").cast(pa.int64()), "n": pa.array(rows["n"], pa.int64()),
                         "same": pa.array(rows["same"], pa.int64()), "lead": pa.array(rows["lead"], pa.int32()),
                         "prefix": pa.array(rows["prefix"], longs), "shared": pa.array(rows["shared"], pa.binary()),
                         **{f"s{i}": pa.array(sketches[:, i]) for i in range(SKETCH_WORDS)}})

    return back


def _possible(percent: int) -> Column:
    """Whether two index entries (columns ``a`` and ``b``) can still link; see the module text."""
    a, b = F.col("a"), F.col("b")
    most, least = F.greatest(a.n, b.n), F.least(a.n, b.n)
    need = F.ceil(percent * (a.n + b.n) / F.lit(100.0 + percent) - 1e-6)
    left = 1 + F.least(a.n - a.pos - 1, b.n - b.pos - 1)
    apart = sum((F.bit_count(a[f"s{i}"].bitwiseXOR(b[f"s{i}"])) for i in range(1, SKETCH_WORDS)),
                F.bit_count(a["s0"].bitwiseXOR(b["s0"])))
    return (100 * least >= percent * most) & (left >= need) & (apart <= a.n + b.n - 2 * need)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that link, by the sets themselves."""
    def check(frames):
        for f in frames:
            keep = np.zeros(f.num_rows, bool)
            columns = [f.column(c).to_pylist() for c in ("nx", "ny", "sx", "sy")]
            for i, (nx, ny, sx, sy) in enumerate(zip(*columns, strict=True)):
                both = np.sort(np.frombuffer(sx + sy, np.uint64))
                same = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * same >= percent * (nx + ny - same)
            yield f.select(["x", "y"]).filter(pa.array(keep))

    one = sets.select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("shared").alias("sx"))
    two = sets.select(F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("shared").alias("sy"))
    return pairs.join(one, "x").join(two, "y").select("x", "y", "nx", "ny", "sx", "sy").mapInArrow(
        tidy(check), "x long, y long")


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("a.rep", "b.rep").alias("x"), F.greatest("a.rep", "b.rep").alias("y")).distinct()


def jaccard_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text; more columns are not read).

    Documents link when 100 * intersection >= percent * union of their shingle sets; ``component_id`` is the smallest
    doc_id reachable by links, null for a null doc_id. Null texts and texts without words have an empty set and link with nothing. Every row
    is a document: rows without a doc_id link others through them, and rows that repeat a doc_id with another text are
    linked by their own text. Repeated rows give repeated rows of the result. An empty table gives an empty one.
    """
    docs = docs.select("doc_id", "text")
    how = exchange.plan(docs, "text")
    answers = exchange.answer(exchange.ask(docs, "text", _keys(shingle), how, KEY_BYTES), KEY_BYTES, signatures=False)
    found = settled(exchange.meet(docs, "text", answers, _sets(how.parts, shingle, percent), how, FOUND))
    sketch = [f"s{i}" for i in range(SKETCH_WORDS)]
    # a set is named by its hash, as a doc_id may be null or stand for several texts; equal sets have equal rows
    reps = settled(found.where("same is not null").groupBy(F.col("same").alias("rep")).agg(
        F.min("doc_id").alias("id"), F.first(F.struct("n", "lead", "prefix", *sketch)).alias("s")).select("rep", "id", "s.*"))
    listed = reps.select("rep", "n", *sketch, "lead", F.posexplode("prefix").alias("k", "token")).select(
        "token", F.struct("rep", "n", (F.col("lead") + F.col("k")).alias("pos"), *sketch).alias("a"))
    # one set of each list, another one in each list, is answered first
    first = listed.groupBy("token").agg(F.count("*").alias("m"), F.min_by("a", F.xxhash64("token", "a.rep")).alias("b"))
    listed = settled(listed.join(first.where("m > 1"), "token"))
    stars = settled(_pairs(listed.where((F.col("a.rep") != F.col("b.rep")) & _possible(percent))))
    # sets in lists of several, once each
    ids = settled(listed.select("a.rep").distinct())
    wanted = F.broadcast(ids) if ids.count() <= FEW_SETS else ids
    sets = settled(found.where("same is not null").select(F.col("same").alias("rep"), "n", "shared").join(
        wanted, "rep", "left_semi").dropDuplicates(["rep"]))
    links = settled(_verified(stars, sets, percent))
    known = components(links)
    # lists in which sets of several components remain
    labelled = listed.select("token", "a").join(known.select(F.col("node").alias("_node"), "component"),
                           F.col("a.rep") == F.col("_node"), "left").select(
        "token", "a", F.coalesce("component", "a.rep").alias("c"))
    open_lists = labelled.groupBy("token").agg(F.count("*").alias("m"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    open_lists = open_lists.where("c0 < c1").select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    rows = settled(labelled.join(open_lists, "token").join(reps.select(F.col("rep").alias("_rep"), "prefix"),
                                                           F.col("a.rep") == F.col("_rep")).drop("_rep"))
    own = F.pmod(F.xxhash64("a.rep"), F.col("blocks")).cast("int")
    spread = rows.withColumn("_own", own).withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("token", "a", "c", "prefix", "_own", F.least("_own", "_t").alias("i"), F.greatest("_own", "_t").alias("j"))
    left = spread.where("_own = i").select("token", "i", "j", "a", "c", "prefix")
    right = spread.where("_own = j").select("token", "i", "j", F.col("a").alias("b"), F.col("c").alias("d"),
                                            F.col("prefix").alias("other"))
    # a pair is looked at in the first list that holds both
    first_of_both = F.get(F.array_intersect("prefix", "other"), F.lit(0)) == F.col("token")
    across = left.join(right, ["token", "i", "j"]).where((F.col("c") != F.col("d")) & _possible(percent) & (
        (F.col("i") < F.col("j")) | (F.col("a.rep") < F.col("b.rep"))) & first_of_both)
    more = _verified(_pairs(across), sets, percent)
    for end in ("x", "y"):  # links between components, once each
        more = more.join(known.withColumnRenamed("node", end), end, "left").withColumn(
            end, F.coalesce("component", end)).drop("component")
    above = components(more.distinct())
    # singles of the first round that found a partner only now are components of their own until here
    final = known.join(above.select(F.col("node").alias("component"), F.col("component").alias("_top")),
                       "component", "left").select("node", F.coalesce("_top", "component").alias("component")).union(
        above.join(known.select("node"), "node", "left_anti").select("node", "component"))
    linked = final.join(reps.select(F.col("rep").alias("node"), "id"), "node")
    lowest = linked.groupBy("component").agg(F.min("id").alias("low"))
    low = linked.join(lowest, "component").select(F.col("node").alias("rep"), "low")
    group = reps.select("rep", "id").join(low, "rep", "left").select(
        F.col("rep").alias("same"), F.coalesce("low", "id").alias("component"))
    # sets without anything in common with others are not dealt out, all of them under one null
    rows = found.select("doc_id", "n", "same")
    named = rows.where("same is not null").join(group, "same", "left").drop("same").union(
        rows.where("same is null").select("doc_id", "n", F.lit(None).cast("long")))
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row of every component of ``docs``, the one with the smallest doc_id; all columns stay, whatever their names.

    Every row takes part under a 64-bit key of its doc_id and text. So rows that repeat both are one row, which of
    their other columns stay is open; a null doc_id is a document like any other and comes after all others; unlike texts
    under one doc_id all stay.
    """
    name = fresh(docs, "_row_key")
    keyed = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    rows = keyed.groupBy(F.col(name).alias("k")).agg(F.min("doc_id").alias("id"), F.count("*").alias("times"))
    found = jaccard_components(keyed.select(F.col(name).alias("doc_id"), "text"), percent, shingle)
    rows = rows.join(found.groupBy(F.col("doc_id").alias("k")).agg(F.min("component_id").alias("c")), "k")
    first = rows.groupBy("c").agg(F.min(F.struct(F.isnull("id"), "id", "k")).alias("s"), F.count("*").alias("n"))
    # keys that do not simply stay: those of other rows of a component, and those of repeated rows
    marked = settled(rows.join(first.where("n > 1").select("c", F.col("s.k").alias("kept")), "c", "left").where(
        "times > 1 or k <> kept").select(F.col("k").alias(name), F.expr("coalesce(k = kept, true)").alias("stays")))

    def few(keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if keys.count() <= FEW_SETS else keys

    out = keyed.join(few(marked.select(name)), name, "left_anti")
    repeated = marked.where("stays").select(name)
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(few(repeated), name, "left_semi").dropDuplicates([name]))
    return out.drop(name)
