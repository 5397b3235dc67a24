"""Tokens of two vocabularies aligned by byte offsets, and how many documents hold each aligned pair of ids.

A text is cut where neither vocabulary can join what lies on both sides, before white space that starts with a space or a
line end; a worker aligns each such chunk once and remembers it within a bound of bytes. Counting takes two passes:

1. Every task aligns its documents and adds up, for each distinct pair of ids, how many of its documents link it.
   Pairs are dealt by A id over fixed ranges. The distinct pairs of a range get a minimal perfect hash (a cascade
   of bit arrays: a pair alone at its place on a level has its bit there, all others go on to the next level; the rank of
   the bit is the hash) and a key vector by which a hash is verified. Counts become dense vectors indexed by the hash,
   which are summed as a tree: within some tasks, then over them.
2. The documents are aligned again and look their pairs up. The table of hashes, keys and counts is broadcast when its
   measured size is within a limit. Its length has a bound besides, one entry for each pair of ids of the
   vocabularies. Beyond the limit links and counts are joined instead.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from packetloom.llm.components import settled
from packetloom.llm.exchange import in_batches
from packetloom.llm.memory import tidy
from packetloom.llm.words import mix

SLICE_BYTES, BATCH_CHUNKS = 2 << 20, 100_000
#: What a worker remembers of chunks, and sums up of pairs before it hands them on.
CACHE_BYTES, ENTRY_BYTES, HELD_PAIRS = 96 << 20, 240, 1_000_000
#: Chunks that are encoded in one call.
LEARNT = 4096
RANGES, TABLE_BYTES = 64, 64 << 20
#: Bits a level of the hash has for each pair that reaches it.
ROOM = 2

#: U+180E counts as white space in some versions of the character tables.
GAP, SOLID = r"[\s᠎]", r"[^\s᠎]"
#: The same where no white space but spaces and line ends occurs.
PLAIN_CHUNK, ODD_GAP = re.compile(r"\s*\S+|\s+"), re.compile(r"[^\S \n]|\u180e")
CHUNK = re.compile(rf"{GAP}*{SOLID}+(?:(?![ \n]){GAP}+{SOLID}+)*(?:(?![ \n]){GAP}+\Z)?|{GAP}+")
#: How byte-level vocabularies of this kind cut a text, the default of the tokenizers library.
CUTS_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OPEN_ENDS = "\u180e"
MARK = "▁"
SUMS = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = "doc_id long, " + "".join(f"{c} long, " for c in [*SUMS, "n_best", "count_sum"]) + "groups string"


# --- minimal perfect hash ---------------------------------------------------------------------------------------------

def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(keys.astype(np.uint64) + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)


class PerfectHash:
    """Numbers 0 to n-1 for n distinct keys; other keys get any of them, or -1."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, level = [], [np.zeros(0, np.uint64)], 0
        while len(keys):
            size = -(-ROOM * len(keys) // 64) * 64
            at = _place(keys, level, size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at]]
            level += 1
        return cls(sizes, np.concatenate(words))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        base = 0
        for level, size in enumerate(self.sizes):
            bit = _place(keys[open_], level, size) + np.uint64(base)
            word = (bit >> np.uint64(6)).astype(np.int64)
            below = np.uint64(1) << (bit & np.uint64(63))
            hit = (self.words[word] & below) != 0
            rank = self.before[word] + np.bitwise_count(self.words[word] & (below - np.uint64(1)))
            out[open_[hit]] = rank[hit]
            open_ = open_[~hit]
            base += size
        return out

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], np.int64).tobytes() + self.words.tobytes()

    @classmethod
    def from_bytes(cls, blob: bytes) -> PerfectHash:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        return cls(np.frombuffer(blob, np.int64, n, 8).tolist(), np.frombuffer(blob, np.uint64, offset=8 * (n + 1)))


class PairTable:
    """Pairs of one range: hash, keys in the order of the hash, counts, and whether a count is its A id's highest."""

    def __init__(self, row):
        self.hash = PerfectHash.from_bytes(row["hash"])
        self.keys = np.frombuffer(row["keys"], np.uint32)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.best = np.frombuffer(row["best"], np.bool_)

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether the pair is there)."""
        at = self.hash(pairs)
        there = (at >= 0) & (self.keys[at] == pairs)
        return np.where(there, at, 0), there


# --- alignment ----------------------------------------------------------------------------------------------------------

class Aligner:
    """Chunks aligned once. Entry i: sums[i] (n_a, n_b, n_groups, n_links, and 1 where the bytes of the tokens are not those of
    the chunk), shown[i] (its groups), and its distinct pairs, with how many links each has there."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        with open(path_a, encoding="utf-8") as f:
            about = json.load(f)
        pre = about["pre_tokenizer"]
        if about["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("A is not a byte-level vocabulary that cuts texts before white space")
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocab, special = about["model"]["vocab"], {t["content"]: t["id"] for t in about["added_tokens"]}
        size = max([*vocab.values(), *special.values()]) + 1
        self.bytes_a = [b""] * size
        for token, i in (vocab | special).items():
            self.bytes_a[i] = bytes([byte[c] for c in token]) if all(c in byte for c in token) else token.encode()
        # where ids are in the order of the merges, they are the ranks that the faster library works by
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in about["model"]["merges"]]
        ordinary = [t for t in sorted(vocab, key=vocab.get) if t not in special]
        if ordinary[256:] != merges or sorted(ordinary[:256]) != sorted(byte):
            raise ValueError("the ids of A are not in the order of its merges")
        self.a = tiktoken.Encoding("a", pat_str=CUTS_A, mergeable_ranks={self.bytes_a[vocab[t]]: vocab[t] for t in ordinary},
                                   special_tokens={})
        self.path_a, self.unchecked, self.texts = path_a, True, True
        self.b = lib = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_b = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(self.size_b)]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if lib.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # an id and what follows it, by 2 * id + kind, B's ids by 3 * id + kind after all of A's
        self.spelt = [f"{i}{end}" for n, ends in ((size, ",|"), (self.size_b, ",;\n")) for i in range(n) for end in ends]
        line_end = lib.encode("\n")
        if (any("\n" in p or re.search(f"[^{MARK}]{MARK}", p) for p in pieces) or len(line_end) != 2
                or self.bytes_b[line_end[0]] != b" " or self.bytes_b[line_end[1]] != b"\n" or size * self.size_b >= 1 << 32):
            raise ValueError("B joins pieces over spaces or line ends, or the pairs of ids do not fit 32 bits")
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = defaultdict(count().__next__)  # an unknown chunk gets the next number
        self.shown: list[str] = []
        self.sums = np.zeros((1024, 5), np.int64)
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)  # an entry's place among the pairs
        self.pairs, self.links, self.used = np.zeros(4096, np.uint32), np.zeros(4096, np.int32), 0
        self.bytes = 0

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text, some at a time. A text with a character that B's library writes for a space, or that ends
        strings, is one chunk."""
        if MARK in text or "\0" in text:
            yield [" " + text]
        elif len(text) < SLICE_BYTES:
            yield (CHUNK if ODD_GAP.search(text) else PLAIN_CHUNK).findall(" " + text)
        else:
            found = CHUNK.finditer(" " + text)
            while some := [m[0] for m in islice(found, BATCH_CHUNKS)]:
                yield some

    def known(self, chunks: list[str]) -> np.ndarray:
        before = len(self.index)
        found = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        if len(self.index) > before:
            self._learn(before, list(islice(reversed(self.index), len(self.index) - before))[::-1])
        return found

    def _learn(self, number: int, new: list[str]) -> None:
        """Align new chunks, which have the numbers from ``number`` on."""
        end = number + len(new)
        while end > len(self.sums):
            self.sums, self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sums, self.start, self.size))
        self.shown += [""] * len(new)
        odd = [i for i, c in enumerate(new, number) if c[0] not in " \n" or c[-1] in OPEN_ENDS or c[-1].isspace()]
        self._add_each(odd, [new[i - number] for i in odd])
        ids = np.setdiff1d(np.arange(number, end), odd, assume_unique=True)
        for at in range(0, len(ids), LEARNT):
            mine = ids[at:at + LEARNT]
            some = [new[i - number] for i in mine.tolist()]
            # chunks may follow each other in any order, so that one call encodes them all
            whole = " x" + "".join(some)
            a = np.array(self.a.encode_ordinary(whole), np.int64)
            if self.unchecked:
                self._check(whole, a.tolist())
            b = np.array(self.b.encode(whole[1:]), np.int64)
            raw = whole.encode()
            if b"".join([self.bytes_a[i] for i in a.tolist()]) == raw == b"".join([self.bytes_b[i] for i in b.tolist()]):
                self._add_all(mine, some, a, b)
            else:
                self._add_each(mine.tolist(), some)

    def _check(self, text: str, ids: list[int]) -> None:
        """What a worker encodes first is compared with the tokenizers library."""
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        library = Tokenizer.from_file(self.path_a)
        library.encode_special_tokens = True
        if library.encode(text, add_special_tokens=False).ids != ids:
            raise RuntimeError("the two libraries for A encode differently")
        self.unchecked = False

    def _add_all(self, ids: np.ndarray, chunks: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Entries of chunks whose tokens lie side by side, after those of two bytes that stand in front."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        ends = np.cumsum([2, *(len(c.encode()) for c in chunks)])
        shared = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]  # no token is empty
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        chunk_of = np.searchsorted(ends, shared)  # of a group; 0 is what stands in front
        many_a, many_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        first_b = np.cumsum(many_b) - many_b
        times = many_b[group_a]  # every A token meets the B tokens of its group
        pair_a = np.repeat(np.arange(len(a)), times)
        pair_b = first_b[group_a[pair_a]] + np.arange(len(pair_a)) - np.repeat(np.cumsum(times) - times, times)
        pairs = a[pair_a] * self.size_b + b[pair_b]
        keys, links = np.unique(chunk_of[group_a[pair_a]] << 32 | pairs, return_counts=True)
        mine = keys >> 32 > 0
        keys, links = keys[mine], links[mine]
        n = len(chunks)
        sums = np.zeros((n + 1, 5), np.int64)
        for i, (of, weight) in enumerate(((chunk_of[group_a], None), (chunk_of[group_b], None), (chunk_of, None),
                                          (chunk_of, many_a * many_b))):
            sums[:, i] = np.bincount(of, weight, n + 1)
        if self.texts:
            # groups in order, A before B; what follows an id is a comma, or a bar or semicolon at the end of its group
            last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
            chunk_ends = last_b & (np.diff(chunk_of[group_b], append=-1) != 0)
            code = np.concatenate([a * 2 + last_a, 2 * len(self.bytes_a) + b * 3 + last_b + chunk_ends])
            order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
            shown = "".join(map(self.spelt.__getitem__, code[order].tolist())).split("\n")[1:n + 1]
            for i, text in zip(ids.tolist(), shown, strict=True):
                self.shown[i] = text
            self.bytes += sum(map(len, shown))
        size = np.bincount((keys >> 32) - 1, minlength=n)
        at = self._room(len(keys))
        self.pairs[at:at + len(keys)] = keys & 0xFFFFFFFF
        self.links[at:at + len(keys)] = links
        self.start[ids], self.size[ids], self.sums[ids] = at + np.cumsum(size) - size, size, sums[1:]
        self.bytes += ENTRY_BYTES * n + int(ends[-1]) + 8 * len(keys)

    def _room(self, pairs: int) -> int:
        """Make room for more pairs; the place of the first."""
        at = self.used
        self.used += pairs
        while self.used > len(self.pairs):
            self.pairs, self.links = (np.concatenate([x, np.zeros_like(x)]) for x in (self.pairs, self.links))
        return at

    def _add_each(self, ids: list[int], chunks: list[str]) -> None:
        for i, chunk in zip(ids, chunks, strict=True):
            # B's library puts a space in front of all but nothing; else a line end keeps the chunk apart from it
            plain = chunk[0] == " " and chunk != " "
            b = self.b.encode(chunk[1:]) if plain else self.b.encode("\n" + chunk)[2:]
            self._add(i, chunk, self.a.encode_ordinary(chunk), b)

    def _add(self, i: int, chunk: str, a: list[int], b: list[int]) -> None:
        part_a, part_b = [self.bytes_a[x] for x in a], [self.bytes_b[x] for x in b]
        raw, text, links, sums = chunk.encode(), "", {}, (0, 0, 0, 0, 1)
        if b"".join(part_a) == raw == b"".join(part_b):
            groups = [(a, b)] if len(a) == 1 or len(b) == 1 else _groups(a, b, part_a, part_b)
            text = ";".join([f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups])
            n_links = 0
            for x, y in groups:
                n_links += len(x) * len(y)
                times_y = Counter(y).items()
                for id_a, times in Counter(x).items():
                    for id_b, more in times_y:
                        pair = id_a * self.size_b + id_b
                        links[pair] = links.get(pair, 0) + times * more
            sums = (len(a), len(b), len(groups), n_links, 0)
        at = self._room(len(links))
        self.pairs[at:at + len(links)] = list(links)
        self.links[at:at + len(links)] = list(links.values())
        self.start[i], self.size[i], self.sums[i], self.shown[i] = at, len(links), sums, text
        self.bytes += ENTRY_BYTES + len(raw) + len(text) + 8 * len(links)

    def pairs_of(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``entries``, place) of all their pairs."""
        size = self.size[entries]
        which = np.repeat(np.arange(len(entries)), size)
        within = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        return which, np.repeat(self.start[entries], size) + within


def _groups(a: list[int], b: list[int], part_a: list[bytes], part_b: list[bytes]) -> list[tuple[list[int], list[int]]]:
    out, i, j, from_i, from_j, end_a, end_b = [], 0, 0, 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if end_a <= end_b:
            end_a += len(part_a[i])
            i += 1
        else:
            end_b += len(part_b[j])
            j += 1
        if end_a == end_b:
            out.append((a[from_i:i], b[from_j:j]))
            from_i, from_j = i, j
    return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str, texts: bool) -> Aligner:
    """The worker's aligner; without ``texts`` its entries have no groups to show."""
    if (path_a, path_b) not in _LOADED:
        _LOADED.clear()
        _LOADED[path_a, path_b] = Aligner(path_a, path_b)
    model = _LOADED[path_a, path_b]
    if model.texts != texts:
        model.clear()
        model.texts = texts
    return model


def _runs(model: Aligner, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, entry) of every chunk in order, some at a time; what is remembered is cut down in between."""
    rows: list[tuple[int, int]] = []
    held: list[str] = []

    def out():
        if model.bytes > CACHE_BYTES:
            model.clear()
        entries = model.known(held)
        return np.repeat([r for r, _ in rows], [n for _, n in rows]).astype(np.int64), entries

    for i, text in enumerate(texts):
        for some in model.chunks(text) if text else ():
            held += some
            rows.append((i, len(some)))
            if len(held) >= BATCH_CHUNKS:
                yield out()
                rows, held = [], []
    if held:
        yield out()


# --- first pass -----------------------------------------------------------------------------------------------------------

COUNTED = "r int, pairs binary, counts binary"


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(pairs, return_inverse=True)
    return keys, np.bincount(at, weights=counts, minlength=len(keys)).astype(np.int64)


def counted_pairs(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per task and range of A ids: distinct pairs and the number of the task's documents that link them."""
    def run(frames):
        model = _aligner(path_a, path_b, False)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def batch():
            pairs, counts = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            r = (pairs // model.size_b) % RANGES
            order = np.argsort(r, kind="stable")
            pairs, counts, cut = pairs[order], counts[order], np.searchsorted(r[order], np.arange(RANGES + 1))
            some = [i for i in range(RANGES) if cut[i + 1] > cut[i]]
            return pa.RecordBatch.from_pydict({
                "r": pa.array(some, pa.int32()),
                "pairs": pa.array([pairs[cut[i]:cut[i + 1]].astype(np.uint32).tobytes() for i in some], pa.binary()),
                "counts": pa.array([counts[cut[i]:cut[i + 1]].tobytes() for i in some], pa.binary())})

        for frame in in_batches(frames, "text", SLICE_BYTES):
            texts = frame.column("text").to_pylist()
            seen = [np.zeros(0, np.uint64)]
            bad = np.zeros(len(texts), bool)
            for row, entry in _runs(model, texts):
                bad[row[model.sums[entry, 4] > 0]] = True
                n = len(model.shown)
                at = np.unique(row * n + entry)
                which, place = model.pairs_of(at % n)
                seen.append(np.unique((at // n)[which].astype(np.uint64) << np.uint64(32) | model.pairs[place]))
            # (text, pair), once for each text however long it is
            every = seen[-1] if len(seen) <= 2 else np.unique(np.concatenate(seen))
            every = every[~bad[(every >> np.uint64(32)).astype(np.int64)]]
            pairs, counts = np.unique(every & np.uint64(0xFFFFFFFF), return_counts=True)
            held.append((pairs.astype(np.int64), counts))
            size += len(pairs)
            if size > HELD_PAIRS:
                held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield batch()
                    held, size = [], 0
        if size:
            yield batch()

    return docs.select("text").mapInArrow(tidy(run), COUNTED)


TABLE = "r int, hash binary, keys binary, counts binary, best binary"


def pair_tables(counted: DataFrame, size_b: int) -> DataFrame:
    """One row per range of A ids: hash, keys, counts and best marks of its pairs."""
    fan = max(1, round(counted.count() ** 0.5 / RANGES ** 0.5))
    dealt = counted.withColumn("salt", F.pmod(F.xxhash64("r", "pairs"), F.lit(fan)).cast("int"))

    def distinct(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in rows.pairs]))
        return pd.DataFrame({"r": rows.r.iloc[:1], "pairs": [keys.tobytes()]})

    def hashed(rows: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in rows.pairs]))
        function = PerfectHash.of(keys)
        placed = np.empty_like(keys)
        placed[function(keys)] = keys
        return pd.DataFrame({"r": rows.r.iloc[:1], "hash": [function.to_bytes()], "keys": [placed.tobytes()]})

    def vectors(rows: pd.DataFrame, hashes: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"r": [], "hash": [], "keys": [], "counts": []})
        blob, keys = hashes.iloc[0][["hash", "keys"]]
        function, total = PerfectHash.from_bytes(blob), np.zeros(len(keys) // 4, np.int64)
        for pairs, counts in zip(rows.pairs, rows.counts, strict=True):
            total[function(np.frombuffer(pairs, np.uint32))] += np.frombuffer(counts, np.int64)
        return pd.DataFrame({"r": rows.r.iloc[:1], "hash": [blob], "keys": [keys], "counts": [total.tobytes()]})

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.int64) for x in rows.counts], axis=0)
        keys = rows["keys"].iloc[0]
        id_a = np.frombuffer(keys, np.uint32) // size_b
        most = np.zeros(int(id_a.max()) + 1, np.int64)
        np.maximum.at(most, id_a, total)
        return pd.DataFrame({"r": rows.r.iloc[:1], "hash": [rows.hash.iloc[0]], "keys": [keys],
                             "counts": [total.tobytes()], "best": [(total == most[id_a]).tobytes()]})

    hashes = dealt.groupBy("r", "salt").applyInPandas(distinct, "r int, pairs binary").groupBy("r").applyInPandas(
        hashed, "r int, hash binary, keys binary")
    each = hashes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    summed = dealt.groupBy("r", "salt").cogroup(each.groupBy("r", "salt")).applyInPandas(
        vectors, "r int, hash binary, keys binary, counts binary")
    return summed.groupBy("r").applyInPandas(whole, TABLE)


def pair_counts(tables: DataFrame, size_b: int) -> DataFrame:
    """a, b, n_docs, best: the counts as a table."""
    def run(frames):
        for frame in frames:
            for row in frame.to_pylist():
                table = PairTable(row)
                keys = table.keys.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys // size_b), pa.array(keys % size_b), pa.array(table.counts), pa.array(table.best)],
                    ["a", "b", "n_docs", "best"])

    return tables.mapInArrow(run, "a long, b long, n_docs long, best boolean")


# --- second pass ------------------------------------------------------------------------------------------------------------

class Worth:
    """What an entry's links add to n_best and count_sum, and how many are not in the tables; looked up once per entry."""

    def __init__(self, tables: dict[int, PairTable], size_b: int):
        self.tables, self.size_b, self.of, self.n, self.sums = tables, size_b, None, 0, np.zeros((1024, 3), np.int64)

    def __call__(self, model: Aligner) -> np.ndarray:
        if self.of is not model.index:  # the worker has forgotten its entries
            self.of, self.n = model.index, 0
        new = np.arange(self.n, len(model.shown))
        if len(new):
            while len(self.sums) < len(model.shown):
                self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            which, place = model.pairs_of(new)
            pairs, links, value = model.pairs[place], model.links[place], np.zeros((len(place), 3), np.int64)
            r = (pairs // np.uint32(self.size_b)) % np.uint32(RANGES)
            order = np.argsort(r, kind="stable")
            cut = np.searchsorted(r[order], np.arange(RANGES + 1))
            for i in np.flatnonzero(np.diff(cut)).tolist():
                mine = order[cut[i]:cut[i + 1]]
                if i not in self.tables:
                    value[mine, 2] = 1
                    continue
                at, there = self.tables[i].find(pairs[mine])
                value[mine] = np.stack([self.tables[i].best[at] & there, self.tables[i].counts[at] * there, ~there], axis=1)
            value[:, :2] *= links[:, None]
            self.sums[self.n:len(model.shown)] = 0
            np.add.at(self.sums, new[which], value)
            self.n = len(model.shown)
        return self.sums


def _figures(model: Aligner, texts: list, worth: Worth | None) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Per text n_a, n_b, n_groups, n_links, n_best, count_sum; its groups; and whether it has tokens."""
    out, shown = np.zeros((len(texts), 8), np.int64), [[] for _ in texts]
    for row, entry in _runs(model, texts):
        cut = np.flatnonzero(np.diff(row, prepend=-1))
        out[row[cut], :5] += np.add.reduceat(model.sums[entry], cut)
        if worth:
            out[row[cut], 5:] += np.add.reduceat(worth(model)[entry], cut)
        for start, end in zip(cut, [*cut[1:], len(row)], strict=True):
            shown[row[start]].append(";".join([model.shown[i] for i in entry[start:end].tolist()]))
    bad = out[:, 4] > 0
    out[bad] = 0
    if out[:, 7].any():
        raise RuntimeError("a pair of the second pass was not in the first; read the documents from a stored table")
    return out[:, [0, 1, 2, 3, 5, 6]], ["" if b else ";".join(x) for x, b in zip(shown, bad, strict=True)], ~bad


def _batch(ids, figures: np.ndarray, groups: list[str], **more) -> pa.RecordBatch:
    columns = {"doc_id": ids} | {c: pa.array(figures[:, i]) for i, c in enumerate([*SUMS, "n_best", "count_sum"])}
    return pa.RecordBatch.from_pydict(columns | {"groups": pa.array(groups, pa.string())} | more)


def aligned(docs: DataFrame, path_a: str, path_b: str, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Every document's alignment: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups ("a1,a2|b1;a3|b2").

    ``docs`` (doc_id, text; nothing else is read) is taken in two passes and must be a stored table. A pair counts once for
    each row that links it, so repeated rows count each. n_best: links whose pair has the highest count of its A id;
    count_sum: the sum of counts over links. Null and empty texts, and texts that either vocabulary does not spell byte by
    byte, have zeros and no groups, and count for nothing.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    size_b = Aligner(path_a, path_b).size_b
    tables = settled(pair_tables(settled(counted_pairs(docs, path_a, path_b)), size_b))
    size = tables.agg(F.sum(sum((F.length(c) for c in ("hash", "keys", "counts", "best")), F.lit(0)))).first()[0] or 0
    if size > table_bytes:
        return _joined(docs, path_a, path_b, pair_counts(tables, size_b), size_b)
    shared = docs.sparkSession.sparkContext.broadcast([r.asDict() for r in tables.collect()])

    def run(frames):
        model = _aligner(path_a, path_b, True)
        worth = Worth({row["r"]: PairTable(row) for row in shared.value}, size_b)
        for frame in in_batches(frames, "text", SLICE_BYTES):
            figures, groups, _ = _figures(model, frame.column("text").to_pylist(), worth)
            yield _batch(frame.column("doc_id"), figures, groups)

    return docs.mapInArrow(tidy(run), ALIGNED)


def _joined(docs: DataFrame, path_a: str, path_b: str, counts: DataFrame, size_b: int) -> DataFrame:
    """The second pass for a table of pairs beyond what is broadcast: links of each document meet the counts by pair."""
    def run(frames):
        model = _aligner(path_a, path_b, True)
        number = TaskContext.get().partitionId() << 40
        for frame in in_batches(frames, "text", SLICE_BYTES):
            texts = frame.column("text").to_pylist()
            found = [[(np.zeros(0, np.uint32), np.zeros(0, np.int64))] for _ in texts]
            out, groups, good = _figures(model, texts, None)
            for row, entry in _runs(model, texts):
                for i in np.unique(row).tolist():
                    _, place = model.pairs_of(entry[row == i])
                    found[i].append(_summed(model.pairs[place], model.links[place]))
            links = [_summed(*(np.concatenate(x) for x in zip(*f, strict=True))) if g else f[0]
                     for f, g in zip(found, good, strict=True)]
            ids = pa.array(np.arange(number, number + len(texts)))
            number += len(texts)
            sizes = np.cumsum([0, *(len(k) for k, _ in links)]).astype(np.int32)
            pairs, times = (pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*links, strict=True))
            yield _batch(frame.column("doc_id"), out, groups, row_id=ids, pairs=pa.ListArray.from_arrays(sizes, pairs),
                         times=pa.ListArray.from_arrays(sizes, times))

    rows = docs.mapInArrow(tidy(run), ALIGNED + ", row_id long, pairs array<long>, times array<long>")
    links = rows.select("row_id", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row_id", F.floor(F.col("x.pairs") / size_b).alias("a"), (F.col("x.pairs") % size_b).alias("b"), "x.times")
    worth = links.join(counts, ["a", "b"]).groupBy("row_id").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("_count"))
    return rows.drop("pairs", "times").join(worth, "row_id", "left").select(
        "doc_id", *SUMS, F.coalesce("_best", F.lit(0)).alias("n_best"), F.coalesce("_count", F.lit(0)).alias("count_sum"),
        "groups")
