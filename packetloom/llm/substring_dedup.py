"""Removal of word passages that occur more than once in a corpus.

Windows of ``width`` words are the edges of a de Bruijn graph over the corpus (its nodes are the windows one word
shorter that two edges share). Only edges that occur twice or more matter; their multiplicities are counted over all
documents by ``exchange``, together with a signature of the batches they occur in. Along a path that does not branch,
both stay the same, so a document's run of repeated edges is compacted into paths wherever they do. The paths of all
documents then meet in Spark under their first edge and length, and their source coordinates verify them: the words
themselves are compared by a strong digest at every place the path is found. A path whose words differ there (two
texts with one 64-bit hash) is taken back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from packetloom.llm import exchange
from packetloom.llm.components import fresh, settled
from packetloom.llm.memory import tidy
from packetloom.llm.words import SPACE, Texts, slices, window_hashes

WIDTH = 35
PATH = "struct<first:long,n:int,at:int,digest:binary>"
FOUND = ("doc_id long, row_key long, n_words long, n_removed long, kept_sha256 string, "
         f"removed array<struct<at:int,n:int>>, paths array<{PATH}>")


def _keys(width: int):
    def keys_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        hashes = [window_hashes(t.word_hashes(), t.windows(width), width) for _, t in slices(column)]
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]), return_counts=True)
        return keys, np.minimum(counts, 255).astype(np.uint8)

    return keys_of


class Joined:
    """The words of some texts, each followed by one space, and where each word starts and ends in those bytes."""

    def __init__(self, texts: Texts):
        length = texts.end - texts.start
        self.start = np.cumsum(length + 1) - length - 1
        self.end = self.start + length
        keep = ~SPACE[texts.data]
        self.bytes = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
        place = np.ones(len(self.bytes), bool)
        place[self.end] = False
        self.bytes[place] = texts.data[keep]

    def words(self, at: int, to: int) -> bytes:
        return self.bytes[self.start[at]:self.end[to - 1]].tobytes() if to > at else b""

    def kept(self, at: int, to: int, gone: list[tuple[int, int]]) -> bytes:
        """Words at:to without the spans ``gone`` (start, end), joined by one space."""
        parts, here = [], at
        for s, e in [*gone, (to, to)]:
            if s > here:
                parts.append(self.words(here, s))
            here = e
        return b" ".join(parts)


def _merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in zip(starts, ends, strict=True):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _passages(parts: int, width: int):
    def back(batch: pa.RecordBatch, answers: pd.DataFrame) -> pa.Table:
        column = batch.column("text")
        prepared = [(at, t, t.windows(width)) for at, t in slices(column)]
        hashes = [window_hashes(t.word_hashes(), w, width) for _, t, w in prepared]
        edges, sign = exchange.shared(np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes])), answers, parts, 6)
        words, gone, sha, spans, paths = [], [], [], [], []
        for (_, texts, windows), own in zip(prepared, hashes, strict=True):
            joined = Joined(texts)
            at = np.minimum(np.searchsorted(edges, own), max(len(edges) - 1, 0))
            repeated = np.flatnonzero(edges[at] == own) if len(edges) else np.zeros(0, np.int64)
            place, mark = windows[repeated], sign[at[repeated]]
            text_of = np.searchsorted(texts.first, place, "right") - 1
            new = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(text_of) != 0)
                                                 | (mark[1:] != mark[:-1])])) if len(place) else place
            size = np.diff(np.append(new, len(place)))
            start, owner, first = place[new], text_of[new], own[repeated[new]].view(np.int64)
            cut = np.searchsorted(owner, np.arange(len(texts) + 1))
            for i in range(len(texts)):
                base, end = int(texts.first[i]), int(texts.first[i + 1])
                s, n = start[cut[i]:cut[i + 1]].tolist(), size[cut[i]:cut[i + 1]].tolist()
                covered = _merged(s, [a + k + width - 1 for a, k in zip(s, n, strict=True)])
                words.append(end - base)
                gone.append(sum(e - a for a, e in covered))
                sha.append(hashlib.sha256(joined.kept(base, end, covered)).hexdigest())
                spans.append([{"at": a - base, "n": e - a} for a, e in covered])
                paths.append([{"first": f, "n": k, "at": a - base, "digest": hashlib.blake2b(
                    joined.words(a, a + k + width - 1), digest_size=16).digest()} for f, k, a in zip(
                        first[cut[i]:cut[i + 1]].tolist(), n, s, strict=True)])
        span = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        path = pa.list_(pa.struct([("first", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("digest", pa.binary())]))
        return pa.table({"doc_id": batch.column("doc_id").cast(pa.int64()), "row_key": batch.column("row_key"),
                         "n_words": pa.array(words, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                         "kept_sha256": pa.array(sha), "removed": pa.array(spans, span), "paths": pa.array(paths, path)})

    return back


def _taken_back(docs: DataFrame, found: DataFrame, wrong: DataFrame, width: int) -> DataFrame:
    """Rows of ``found`` that hold a wrong path, judged anew without it."""
    wrong = wrong.withColumn("wrong", F.lit(True))
    paths = found.select("row_key", F.explode("paths").alias("p")).select("row_key", "p.*")
    right = paths.join(wrong, ["first", "n"], "left").groupBy("row_key").agg(
        F.max("wrong").alias("wrong"), F.array_sort(F.collect_list(F.when(F.col("wrong").isNull(), F.struct(
            "at", (F.col("n") + width - 1).alias("n"))))).alias("spans")).where("wrong").drop("wrong")

    def judge(frames):
        for f in frames:
            out = []
            for doc_id, key, text, spans in zip(f.doc_id, f.row_key, f.text, f.spans, strict=True):
                _, texts = next(slices(pa.array([text], pa.string())))
                gone = _merged([s["at"] for s in spans], [s["at"] + s["n"] for s in spans])
                out.append((doc_id, key, len(texts.start), sum(e - s for s, e in gone), hashlib.sha256(
                    Joined(texts).kept(0, len(texts.start), gone)).hexdigest(), [(s, e - s) for s, e in gone], []))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")][:7])

    anew = docs.join(right, "row_key").select("doc_id", "row_key", "text", "spans").mapInPandas(judge, FOUND)
    return found.join(right.select("row_key"), "row_key", "left_anti").select(*anew.columns).union(anew)


def repeated_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; more columns are not read): doc_id, n_words, n_removed, kept_sha256, the
    ``removed`` word spans, and ``row_key``, a hash of (doc_id, text).

    A word goes when a window of ``width`` words that covers it starts anywhere else too, in another document or the
    same. Null and empty texts have no words; texts shorter than a window lose none. Repeated rows repeat
    each other's windows. An empty table gives an empty one.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    how = exchange.plan(keyed, "text")
    answers = exchange.answer(exchange.ask(keyed, "text", _keys(width), how, 6), 6, signatures=True)
    found = settled(exchange.meet(keyed, "text", answers, _passages(how.parts, width), how, FOUND))
    wrong = settled(found.select(F.explode("paths").alias("p")).groupBy("p.first", "p.n").agg(
        F.min("p.digest").alias("a"), F.max("p.digest").alias("b")).where("a <> b").select("first", "n"))
    if not wrong.isEmpty():
        found = _taken_back(keyed, found, wrong, width)
    return found.drop("paths")


def without_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text`` (the kept words joined by one space); the other columns,
    whatever their names, stay. Texts that lose nothing stay as they are, and so do null texts."""
    key, gone = fresh(docs, "row_key"), fresh(docs, "removed")
    spans = repeated_passages(docs, width).where("n_removed > 0").select(
        F.col("row_key").alias(key), F.col("removed").alias(gone)).dropDuplicates([key])
    joined = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(spans, key, "left")
    names, columns = joined.columns, docs.columns

    def cut(frames):
        for frame in frames:
            texts = frame.column(names.index("text")).to_pylist()
            for i, spans_of in enumerate(frame.column(names.index(gone)).to_pylist()):
                if spans_of:
                    _, one = next(slices(pa.array([texts[i]], pa.string())))
                    texts[i] = Joined(one).kept(0, len(one.start), [(g["at"], g["at"] + g["n"]) for g in spans_of]).decode()
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if c == "text" else frame.column(names.index(c)) for c in columns], columns)

    return joined.mapInArrow(tidy(cut), docs.schema)
