"""Token sequences of a fixed length, packed by the sum-of-squares rule.

Each text is tokenised once, where it lies. A piece then is five numbers; pieces are dealt over groups of a fixed
expected size by a hash, and each group is packed by one task: a piece goes where the sum of squares of N(g), the number of
open sequences with a gap of g tokens, becomes smallest. That keeps gaps of all kinds in stock and leaves almost none
at the end. Groups grow in number with the corpus and not in size, at the cost of a few half-filled sequences each.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from packetloom.llm.memory import tidy, tidy_group

CAPACITY, END_ID = 4096, 1
GROUP_DOCS = 60_000
#: Bytes that a worker's remembered words may take, and what one takes besides its letters and ids.
CACHE_BYTES, ENTRY_BYTES = 192 << 20, 190
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECE + ", sequence_id long, offset long"


class WordIds:
    """Token ids of white-space-separated words, as packed 32-bit numbers, for a tokenizer that never joins words.

    Words of ASCII and Latin-1 letters go to the model directly, lower-cased and cut as the tokenizer's own pattern does;
    all others take the tokenizer's whole way. Words and their parts are remembered within ``CACHE_BYTES``: a third for the parts, and
    one for each of two generations of words, of which the older one goes when the younger is full.
    """
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            kinds = [n["type"] for n in json.load(f)["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("this tokenizer's normaliser is not the one whose words are independent")
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        # bytes stand for themselves where printable, else for the characters from 256 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        shown = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.shown = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.bytes = self.part_bytes = 0

    def _part(self, part: str) -> bytes:
        known = self.parts.get(part)
        if known is None:
            ids = [t.id for t in self.model.tokenize(part.translate(self.shown))]
            known = struct.pack(f"<{len(ids)}I", *ids)
            if self.part_bytes > CACHE_BYTES // 3:
                self.parts, self.part_bytes = {}, 0
            self.parts[part] = known
            self.part_bytes += len(part) + len(known) + ENTRY_BYTES
        return known

    def _new(self, raw: bytes) -> bytes:
        word = raw.decode()
        if self.PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join([self._part(p) for p in self.PART.findall(word.lower())])
        ids = self.whole.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes) -> bytes:
        words = text.split()
        found = list(map(self.words.get, words))
        if None in found:
            for i, (word, ids) in enumerate(zip(words, found, strict=True)):
                if ids is None:
                    ids = self.words.get(word) or self.old.get(word) or self._new(word)
                    self.words[word] = found[i] = ids
                    self.bytes += len(word) + len(ids) + ENTRY_BYTES
                    if self.bytes > CACHE_BYTES // 3:
                        self.old, self.words, self.bytes = self.words, {}, 0
        return b"".join(found)


_LOADED: dict[str, WordIds] = {}


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length and the checksum of its ids."""
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _LOADED:
            _LOADED[vocabulary] = WordIds(vocabulary)
        encode = _LOADED[vocabulary].encode
        end = struct.pack("<I", END_ID)
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame.column("doc_id").to_pylist(), frame.column("text"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                ids = encode(raw) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(run), PIECE)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for each size, in the given order; every size is 1 to ``capacity``."""
    open_bins = np.zeros(capacity + 1, np.int64)  # by gap
    stock: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i, size in enumerate(sizes.tolist()):
        here = open_bins[size:]
        # change of the sum of squares, halved and without its constant; a gap of 0 is not counted
        change = open_bins[:capacity + 1 - size] - here
        change[0] = -here[0]
        change[here == 0] = capacity * len(sizes)
        gap = int(change.argmin()) + size
        if open_bins[gap] and change[gap - size] <= open_bins[capacity - size]:
            bin_id = stock[gap].pop()
            open_bins[gap] -= 1
        else:
            bin_id, gap, made = made, capacity, made + 1
        bins[i], offsets[i] = bin_id, capacity - gap
        if gap > size:
            stock[gap - size].append(bin_id)
            open_bins[gap - size] += 1
    return bins, offsets


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Every document's pieces with their sequence and place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and one end id; only longer ones than ``capacity`` are cut, so null and empty
    texts are one piece of length 1. Pieces are placed longest first, ties by (doc_id, piece, checksum); repeated rows
    are placed one by one; null doc_ids come last. ``docs`` needs doc_id and text, other columns are not read.
    """
    groups = max(1, -(-docs.count() // group_docs))
    rows = pieces(docs, vocabulary, capacity).withColumn("_group", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("int"))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = sum_of_squares(frame.length.to_numpy(), capacity)
        return frame.assign(sequence_id=(int(frame._group.iloc[0]) << 32) + bins, offset=offsets).drop(columns="_group")

    return rows.groupBy("_group").applyInPandas(tidy_group(place), PACKED)
