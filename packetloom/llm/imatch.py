"""I-Match fingerprints: hashes of the terms that are neither too common nor too rare.

A term is a lower-cased word. The lexicon holds the terms whose inverse document frequency log2(N / df) over the whole corpus
lies in a band. Its upper end bounds the lexicon: a term in it is in at least N / 2**HIGH documents, so there are at
most 2**HIGH times as many as a document has terms on average, however large the corpus is. A document's distinct terms
in the lexicon are sorted and hashed, once for the whole lexicon and once for each of several random subsets of
it. The subsets come in levels of 1/8, 1/64 and 1/512 of the lexicon, so that documents of any length have subsets that hold
a term or two of theirs, which survive a change elsewhere.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from packetloom.llm.components import fresh, settled
from packetloom.llm.memory import tidy
from packetloom.llm.words import mix, slices, window_hashes

LOW, HIGH = 2.0, 10.0
#: A document with fewer terms in the lexicon is taken with all its terms.
LEAST_TERMS = 3
#: (lexicon terms to one of a subset, subsets) of each level. Subsets of a level are disjoint.
LEVELS = [(8, 8), (64, 24), (512, 32)]
#: Likeness is read at the sparsest level of which so many subsets hold a term of either text.
LEAST_SUBSETS = 6
SUBSETS = sum(n for _, n in LEVELS)
HELD_TERMS = 1_000_000
SLICE_BYTES, SLICE_ROWS = 1 << 20, 10_000


# --- lexicon ----------------------------------------------------------------------------------------------------------

def _terms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(number of the first text, number of texts, text, term) of distinct terms in the order of both, slice by slice."""
    for first, part in slices(texts, SLICE_BYTES):
        row, term = part.words_of(), part.word_hashes(lower=True)
        order = np.lexsort((term, row))
        row, term = row[order], term[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        yield first, len(part), row[new], term[new]


def document_frequencies(docs: DataFrame) -> DataFrame:
    """term (64-bit hash), df. Every task adds its documents up first, within a bound of terms held."""
    def run(frames):
        held, size = [], 0

        def summed():
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([n for _, n in held])).astype(np.int64)

        def batch(keys, counts):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["term", "df"])

        for frame in frames:
            for _, _, _, term in _terms(frame.column("text")):
                held.append(np.unique(term, return_counts=True))
                size += len(held[-1][0])
                if size > HELD_TERMS:
                    held = [summed()]
                    size = len(held[0][0])
                    if size > HELD_TERMS // 2:
                        yield batch(*held[0])
                        held, size = [], 0
        if size:
            yield batch(*summed())

    return docs.select("text").mapInArrow(tidy(run), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the band. At most 2**high times the mean number of terms of a document."""
    n = docs.count()
    df = F.col("df")
    rows = document_frequencies(docs).where((df * float(2 ** low) <= n) & (df * float(2 ** high) >= n)).select("term")
    return np.sort(rows.toPandas().term.to_numpy(np.int64).view(np.uint64))


# --- fingerprints -----------------------------------------------------------------------------------------------------

def signatures(texts: pa.Array, known: np.ndarray) -> np.ndarray:
    """(text, 1 + SUBSETS) 32-bit hashes: of the whole lexicon's terms, then of each subset's; 0 where there is no term.

    A text with too few terms in the lexicon is taken with all its terms; one without any word has the hash of its bytes.
    """
    out = np.zeros((len(texts), 1 + SUBSETS), np.uint32)
    for first, n, row, term in _terms(texts):
        at = np.minimum(np.searchsorted(known, term), max(len(known) - 1, 0))
        inside = known[at] == term if len(known) else np.zeros(len(term), bool)
        few = np.bincount(row[inside], minlength=n) < LEAST_TERMS
        keep = inside | few[row]
        row, term = row[keep], term[keep]
        base, column = 0, [np.zeros(len(row), np.int64)]
        for level, (share, subsets) in enumerate(LEVELS):
            deal = (mix(term + np.uint64(level + 1)) % np.uint64(share)).astype(np.int64)
            column.append(np.where(deal < subsets, 1 + base + deal, -1))
            base += subsets
        for c in column:  # each level is a partition of the terms: one sort, one hash per run of sorted terms
            mine = np.flatnonzero(c >= 0)
            if not len(mine):
                continue
            spot = row[mine] * (1 + SUBSETS) + c[mine]
            order = np.argsort(spot, kind="stable")  # the terms of a text are sorted already
            spot, sorted_terms = spot[order], term[mine][order]
            start = np.flatnonzero(np.diff(spot, prepend=-1))
            size = np.diff(np.append(start, len(spot)))
            found = (window_hashes(sorted_terms, start, size) >> np.uint64(32)).astype(np.uint32)
            out[first + spot[start] // (1 + SUBSETS), spot[start] % (1 + SUBSETS)] = np.maximum(found, 1)
    for i in np.flatnonzero(out[:, 0] == 0).tolist():  # no word
        text = texts[i].as_py() if texts[i].is_valid else ""
        out[i, 0] = max(1, int.from_bytes(hashlib.blake2b((text or "").encode(), digest_size=4).digest(), "big"))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, 0 to 1: the share of equal subset hashes, among the subsets that hold a term of either text, at the sparsest
    level that has enough of those; 1 where the hash of the whole lexicon is equal."""
    out, done = np.zeros(len(a)), np.zeros(len(a), bool)
    base = 1 + SUBSETS
    for level in reversed(range(len(LEVELS))):
        base, end = base - LEVELS[level][1], base
        x, y = a[:, base:end], b[:, base:end]
        held = ((x > 0) | (y > 0)).sum(axis=1)
        equal = ((x == y) & (x > 0)).sum(axis=1)
        now = ~done & ((held >= LEAST_SUBSETS) | (level == 0))
        out[now] = equal[now] / np.maximum(held[now], 1)
        done |= now
    out[a[:, 0] == b[:, 0]] = 1.0
    return out


def shown(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u4").tobytes()).decode()


def fingerprinted(docs: DataFrame, known: np.ndarray, column: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every text in a column of that name (numbered where the name is taken).

    Equal texts have equal fingerprints, a null text that of an empty one.
    """
    schema = StructType(list(docs.schema)).add(fresh(docs, column), "string")
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(frames):
        for frame in frames:
            prints = pa.array([shown(s) for s in signatures(frame.column("text"), shared.value)], pa.string())
            yield pa.RecordBatch.from_arrays([*(frame.column(n) for n in schema.names[:-1]), prints], schema.names)

    return docs.mapInArrow(run, schema)


# --- a document, its edited form and the next one ---------------------------------------------------------------------

EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
          " near_edited double, near_next double")
#: kind 0: a result. 1: the last row of a task, whose next one is elsewhere. 2: the first row of a task.
STEP = f"kind int, task int, text string, {EDITED}"


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many first ones of the following text, or all it has."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _rows(ids: list, texts: list[str], prints: np.ndarray, following: list[str], next_prints: np.ndarray,
          known: np.ndarray) -> pd.DataFrame:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    changed_prints = signatures(pa.array(changed, pa.large_string()), known)
    return pd.DataFrame({
        "doc_id": pd.array(ids, "Int64"), "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [shown(s) for s in prints], "edited_fingerprint": [shown(s) for s in changed_prints],
        "near_edited": likeness(prints, changed_prints), "near_next": likeness(prints, next_prints)})


def edited_neighbours(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; nothing else is read): its fingerprint, that of its edited text, and likenesses.

    The next document is the next row by (doc_id, digest of the text), nulls first, after the last one the first; a null text is
    empty; repeated rows follow each other; a single row follows itself. Rows are sorted over all tasks by range, the hash
    of a row's place breaking up repeated rows, and pass a task in order; the last row of a task waits for the first row of
    the next task that has any. Texts travel compressed.
    """
    order = ["doc_id", "_digest", "_place"]
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("_place"))
    rows = rows.withColumn("_digest", F.xxhash64("text")).mapInArrow(
        _squeezed, "doc_id long, packed binary, _place long, _digest long").repartitionByRange(*order).sortWithinPartitions(*order)
    shared = docs.sparkSession.sparkContext.broadcast(known)
    schema = to_arrow_schema(StructType.fromDDL(STEP))

    def run(frames):
        known, task = shared.value, TaskContext.get().partitionId()
        ids, texts, prints = [], [], np.zeros((0, 1 + SUBSETS), np.uint32)  # rows whose next one is not yet seen: one at most
        first = True

        def single(kind, doc_id, text):
            return pa.RecordBatch.from_pylist([{"kind": kind, "task": task, "text": text, "doc_id": doc_id}], schema)

        for new_ids, new_texts in _spread(frames):
            if first:
                yield single(2, new_ids[0], new_texts[0])
                first = False
            ids += new_ids
            texts += new_texts
            prints = np.concatenate([prints, signatures(pa.array(new_texts, pa.large_string()), known)])
            if len(texts) > 1:
                out = _rows(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], known)
                out = out.assign(kind=0, task=task, text=None)
                yield pa.RecordBatch.from_pandas(out[schema.names], schema, preserve_index=False)
            ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]
        if texts:
            yield single(1, ids[0], texts[0])

    steps = settled(rows.select("doc_id", "packed").mapInArrow(tidy(run), STEP))
    # one row per task, without texts: which task's first row follows which task's last
    before = F.coalesce(F.lag("task").over(W.orderBy("task")), F.max("task").over(W.partitionBy()))
    around = steps.where("kind = 2").select("task", before.alias("before"))
    heads = steps.where("kind = 2").select("task", F.col("text").alias("following")).join(around, "task")
    ends = steps.where("kind = 1").select(F.col("task").alias("before"), "doc_id", "text").join(
        heads.drop("task"), "before")

    edited_schema = to_arrow_schema(StructType.fromDDL(EDITED))

    def meet(frames):
        known = shared.value
        for frame in frames:
            for i in range(frame.num_rows):
                row = frame.slice(i, 1)
                (text,), (following,) = row.column("text").to_pylist(), row.column("following").to_pylist()
                out = _rows(row.column("doc_id").to_pylist(), [text], signatures(row.column("text"), known), [following],
                            signatures(row.column("following"), known), known)
                yield pa.RecordBatch.from_pandas(out, edited_schema, preserve_index=False)

    return steps.where("kind = 0").select(*edited_schema.names).unionByName(ends.mapInArrow(meet, EDITED))


def _squeezed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows with ``text`` as a compressed ``packed``."""
    squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
    for frame in frames:
        packed = pa.array([squeeze(t.as_buffer()) for t in frame.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([frame.column("doc_id"), packed, frame.column("_place"), frame.column("_digest")],
                                         ["doc_id", "packed", "_place", "_digest"])


def _spread(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(doc_ids, texts), about ``SLICE_BYTES`` of text at a time."""
    spread = zstandard.ZstdDecompressor().decompress
    ids, texts, size = [], [], 0
    for frame in frames:
        for doc_id, packed in zip(frame.column("doc_id").to_pylist(), frame.column("packed"), strict=True):
            raw = spread(packed.as_buffer())
            ids.append(doc_id)
            texts.append(raw.decode())
            size += len(raw)
            if size > SLICE_BYTES or len(texts) >= SLICE_ROWS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if texts:
        yield ids, texts
