"""Counting hashed keys of a corpus across tasks, a batch of documents at a time.

Batches of documents (a few megabytes of text) send their distinct keys, packed and split by key range, to the task of
each range; that task answers every batch for its own keys; the answers meet the documents again by batch. So a key
costs four to six bytes once per batch instead of a row per occurrence, a key that is everywhere arrives once per
batch, and no task holds more than its range, whose width follows the size of the corpus.

The documents are read twice, for the questions and to meet the answers. Batches are numbered by input partition and
place, so the input must come in the same order each time, as a table in storage does. A checksum of every batch's texts
travels with its answers; a batch that does not match fails the job.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from packetloom.llm.memory import tidy, tidy_group, tidy_pair
from packetloom.llm.words import mix

#: Text bytes of a batch, and text bytes for each key range. Both grow with a very large corpus, so that what a batch sends
#: to a range does not become a few bytes; the upper ends are what a task can hold.
BATCH_BYTES, BATCH_MOST, CORPUS_BATCHES = 4 << 20, 64 << 20, 1 << 16
RANGE_BYTES, RANGE_MOST, CORPUS_RANGES = 10 << 20, 256 << 20, 1 << 12
#: Bits of a key by the bytes it takes on the way: with some 10**5 keys in a batch, the rest follows from their order.
BITS = {4: 48, 6: 64}
ASKED = "b long, p int, crc long, n int, blob binary"
KEPT = "b long, crc long, docs binary"


class Plan(NamedTuple):
    """Into how many key ranges a corpus is dealt, and how many bytes of text a batch has."""
    parts: int
    batch: int


def plan(docs: DataFrame, column: str) -> Plan:
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    a_range = min(RANGE_MOST, max(RANGE_BYTES, total // CORPUS_RANGES))
    return Plan(max(8, -(-total // a_range)), min(BATCH_MOST, max(BATCH_BYTES, total // CORPUS_BATCHES)))


def _sizes(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)


def in_batches(frames: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text.

    A row's batch follows from the bytes of text before it in the partition, not from the frames it comes in: Spark cuts
    frames by the size of all columns that are sent, which differ from pass to pass.
    """
    before, held, number = 0, [], None
    for frame in frames:
        if not frame.num_rows:
            continue
        ends = before + np.cumsum(_sizes(frame.column(column)))
        of_row = np.concatenate([[before], ends[:-1]]) // size
        before = int(ends[-1])
        cut = np.flatnonzero(np.diff(of_row, prepend=-1))
        for at, to in zip(cut.tolist(), [*cut[1:].tolist(), frame.num_rows], strict=True):
            if held and of_row[at] != number:
                yield _one(held)
                held = []
            number = of_row[at]
            held.append(frame.slice(at, to - at))
    if held:
        yield _one(held)


def _one(frames: list[pa.RecordBatch]) -> pa.RecordBatch:
    return frames[0] if len(frames) == 1 else pa.Table.from_batches(frames).combine_chunks().to_batches()[0]


def _checksum(column: pa.Array) -> int:
    """Of the texts and where each ends; a null counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    crc = zlib.crc32(_sizes(column).tobytes())
    if column.buffers()[2] is None:
        return crc
    bounds = np.frombuffer(column.buffers()[1], np.int64 if column.type == pa.large_string() else np.int32)
    at, to = int(bounds[column.offset]), int(bounds[column.offset + len(column)])
    return zlib.crc32(memoryview(column.buffers()[2])[at:to], crc)


def _numbered(frames, column, size) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    base = TaskContext.get().partitionId() << 24
    for k, batch in enumerate(in_batches(frames, column, size)):
        yield base + k, _checksum(batch.column(column)), batch


def cuts(keys: np.ndarray, parts: int, bits: int) -> np.ndarray:
    """Where sorted keys of so many bits are cut into ``parts`` ranges."""
    edges = np.array([(i << bits) // parts for i in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _packed(keys: np.ndarray, width: int) -> bytes:
    """Sorted keys as differences of ``width`` low bytes (4 or 6), and what does not fit: (place, high part) pairs.

    A batch's keys are many, so their differences leave the upper bytes empty but for a few.
    """
    steps = np.diff(keys, prepend=np.uint64(0))
    high = steps >> np.uint64(8 * width)
    far = np.flatnonzero(high)
    low = steps.astype(np.uint32).tobytes()
    if width == 6:
        low += (steps >> np.uint64(32)).astype(np.uint16).tobytes()
    return low + far.astype(np.uint32).tobytes() + high[far].astype(np.uint32).tobytes()


def _unpacked(blob: bytes, n: int, width: int) -> np.ndarray:
    steps = np.frombuffer(blob, np.uint32, n).astype(np.uint64)
    if width == 6:
        steps += np.frombuffer(blob, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32)
    far, high = np.frombuffer(blob, np.uint32, offset=width * n).reshape(2, -1)
    steps[far] += high.astype(np.uint64) << np.uint64(8 * width)
    return np.cumsum(steps, dtype=np.uint64)


def ask(docs: DataFrame, column: str, keys_of: Callable, how: Plan, width: int) -> DataFrame:
    """Questions: ``keys_of(text array)`` gives sorted distinct keys and how often (up to 255) each is in the batch.

    ``width`` is the number of bytes a key takes on the way: 4 for keys of 48 bits, 6 for keys of 64.
    """
    parts = how.parts

    def run(frames):
        for b, crc, batch in _numbered(frames, column, how.batch):
            keys, counts = keys_of(batch.column(column))
            at = cuts(keys, parts, BITS[width])
            rows = [(p, at[p], at[p + 1]) for p in range(parts) if at[p + 1] > at[p]]
            yield pa.RecordBatch.from_pydict({
                "b": pa.array([b] * len(rows), pa.int64()), "p": pa.array([p for p, _, _ in rows], pa.int32()),
                "crc": pa.array([crc] * len(rows), pa.int64()), "n": pa.array([t - s for _, s, t in rows], pa.int32()),
                "blob": pa.array([counts[s:t].tobytes() + _packed(keys[s:t], width) for _, s, t in rows], pa.binary())})

    return docs.select(column).mapInArrow(tidy(run), ASKED)


def answer(asked: DataFrame, width: int, signatures: bool) -> DataFrame:
    """For every batch and range: which keys occur twice or more, and how often, or a signature of where.

    A key's signature is a sum over the batches it is in, so it stays the same along text that always occurs as a whole.
    """
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([_unpacked(x[n:], n, width) for x, n in zip(rows.blob, rows.n, strict=True)])
        counts = np.concatenate([np.frombuffer(x, np.uint8, n) for x, n in zip(rows.blob, rows.n, strict=True)])
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        of_key = np.empty(len(keys), np.uint32)
        of_key[order] = np.repeat(np.arange(len(new), dtype=np.uint32), np.diff(np.append(new, len(keys))))
        del keys
        total = value = np.add.reduceat(counts[order], new, dtype=np.uint32)  # as wide as it is read
        if signatures:
            mark = np.repeat(mix(rows.b.to_numpy(np.uint64)), rows.n)
            value = np.add.reduceat(mark[order] * counts[order], new).astype(np.uint32)
        blobs, at = [], 0
        for n in rows.n:
            own = of_key[at:at + n]
            twice = total[own] > 1
            blobs.append(np.packbits(twice).tobytes() + value[own[twice]].tobytes())
            at += n
        return pd.DataFrame({"b": rows.b, "p": rows.p, "crc": rows.crc, "n": rows.n, "blob": blobs})

    return asked.groupBy("p").applyInPandas(tidy_group(run), ASKED)


def shared(keys: np.ndarray, answers: pd.DataFrame, parts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys that occur twice or more, what was told of each) of a batch's sorted distinct keys."""
    at, found = cuts(keys, parts, BITS[width]), [(np.zeros(0, np.uint64), np.zeros(0, np.uint32))]
    for p, n, blob in zip(answers.p, answers.n, answers.blob, strict=True):
        if at[p + 1] - at[p] != n:
            raise RuntimeError("a batch is not what its answers are for; read the documents from stored tables")
        own = keys[at[p]:at[p + 1]][np.unpackbits(np.frombuffer(blob, np.uint8, -(-n // 8)), count=n).astype(bool)]
        found.append((own, np.frombuffer(blob, np.uint32, offset=-(-n // 8))))
        if len(found[-1][1]) != len(own):
            raise RuntimeError("answers of another width than four bytes")
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def meet(docs: DataFrame, column: str, answers: DataFrame, back: Callable, how: Plan, schema: str) -> DataFrame:
    """``back(record batch of documents, answers of the batch)`` for every batch; it returns a table of ``schema``."""
    def pack(frames):
        for b, crc, batch in _numbered(frames, column, how.batch):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_pydict({"b": pa.array([b], pa.int64()), "crc": pa.array([crc], pa.int64()),
                                              "docs": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    def run(kept: pa.Table, told: pa.Table) -> pa.Table:
        told = told.to_pandas().sort_values("p")
        if kept.num_rows != 1 or (told.crc != kept.column("crc")[0].as_py()).any():
            raise RuntimeError("a batch is not what its answers are for; read the documents from stored tables")
        batch = pa.ipc.open_stream(kept.column("docs")[0].as_buffer()).read_all().combine_chunks()
        return back(batch.to_batches()[0], told)

    kept = docs.mapInArrow(tidy(pack), KEPT)
    return kept.groupBy("b").cogroup(answers.groupBy("b")).applyInArrow(tidy_pair(run), schema)
