"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding starts from single characters and keeps an agenda of adjacent pairs that form a piece, ordered by score and
then by place; the best pair is merged until none is left, and what is no piece falls back to bytes. No piece of such a
vocabulary goes on into a new word (checked on loading), so a text is cut into words, and each worker remembers the
words it has seen. Every Arrow batch is checked against the sentencepiece library: all words that are new in the
batch are encoded and decoded by both; a difference fails the job. Texts that hold a character the library treats in a
special way, or that is not valid in its input, are compared whole.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CACHED_WORDS = 500_000
MARK = "▁"
#: Up to so many characters the best pair is found by a scan, beyond it by a heap.
SHORT, INFINITE = 48, float("inf")
CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: A word: the spaces before it and what follows up to the next space.
WORD = re.compile(rb" +[^ ]*|[^ ]+")


class Agenda:
    """A merge vocabulary: ``encode`` one word (spaces already as marks) to ids, ``decode`` ids to bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        self.end, self.unknown = lib.eos_id(), lib.unk_id()
        self.bytes = {int(self.pieces[i][1:-1], 16): i for i in range(size) if lib.is_byte(i)}
        special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)}
        self.rank = {p: (-lib.get_score(i), i) for i, p in enumerate(self.pieces) if i not in special}
        self.score = {p: r for p, (r, _) in self.rank.items()}
        joins = [p for p in self.rank if re.search(f"[^{MARK}]{MARK}", p)]
        if joins or len(self.bytes) != 256 or lib.encode("a  b") == lib.encode("a b"):
            raise ValueError("not a merge vocabulary with byte fallback whose pieces end at spaces")
        self.raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        self.words: dict[bytes, tuple[bytes, int, bytes]] = {}
        self.old: dict[bytes, tuple[bytes, int, bytes]] = {}
        self.plain = lib.encode("x") == self.encode(MARK + "x")

    def encode(self, word: str) -> list[int]:
        return self._short(word) if len(word) <= SHORT else self._long(word)

    def _short(self, word: str) -> list[int]:
        """The agenda of a short word is a list of scores, one for each pair in its place."""
        score, symbols = self.score, list(word)
        agenda = [score.get(pair, INFINITE) for pair in map(add, symbols, word[1:])]
        while agenda:
            best = min(agenda)
            if best is INFINITE:
                break
            at = agenda.index(best)
            symbols[at:at + 2] = [pair] = [symbols[at] + symbols[at + 1]]
            del agenda[at]
            if at < len(agenda):
                agenda[at] = score.get(pair + symbols[at + 1], INFINITE)
            if at:
                agenda[at - 1] = score.get(symbols[at - 1] + pair, INFINITE)
        return self._ids(symbols)

    def _ids(self, symbols: list[str]) -> list[int]:
        ids = []
        for s in symbols:
            own = self.rank.get(s)
            if own is None:
                ids.extend([self.bytes[b] for b in s.encode()])
            else:
                ids.append(own[1])
        return ids

    def _long(self, word: str) -> list[int]:
        symbols: list[str | None] = list(word)
        rank = self.rank
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                agenda.append((rank[pair][0], i, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, pair = heapq.heappop(agenda)
            right = after[left]
            # a symbol that has merged since then is not what this entry was about
            if symbols[left] is None or right >= n or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, None
            after[left] = nxt = after[right]
            if nxt < n:
                before[nxt] = left
                longer = pair + symbols[nxt]
                if longer in rank:
                    heapq.heappush(agenda, (rank[longer][0], left, longer))
            prev = before[left]
            if prev >= 0:
                longer = symbols[prev] + pair
                if longer in rank:
                    heapq.heappush(agenda, (rank[longer][0], prev, longer))
        return self._ids([s for s in symbols if s is not None])

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids, with the space in front that encoding puts there; control ids give nothing."""
        return b"".join([self.raw[i] for i in ids if i != self.end])

    def learn(self, new: list[bytes]) -> None:
        """Encode words, check them against the library, remember them."""
        words = [w.decode() for w in new]
        own = [self.encode(w.replace(" ", MARK)) for w in words]
        # the library puts one space in front of what it is given, so a word goes in without its first
        theirs = self.library.encode([w[1:] for w in words], num_threads=1)
        decoded = [self.decode(ids) for ids in own]
        for w, ids, lib in zip(words, own, theirs, strict=True):
            if ids != lib and w != " ":  # of a lone space nothing would be left
                raise RuntimeError(f"the library encodes {w!r} differently")
        # one call: ids one after the other decode to the words one after the other, but for the first space
        if (self.library.decode([i for ids in own for i in ids]).encode() != b"".join(decoded)[1:]):
            raise RuntimeError("the library decodes these words differently")
        for raw, ids, text in zip(new, own, decoded, strict=True):
            self.words[raw] = (" ".join(map(str, ids)).encode(), len(ids), text)
        if len(self.words) > CACHED_WORDS:
            self.old, self.words = self.words, {}


_LOADED: dict[str, Agenda] = {}


def agenda(path: str) -> Agenda:
    if path not in _LOADED:
        _LOADED[path] = Agenda(path)
    return _LOADED[path]


def code(model: Agenda, text: bytes) -> tuple[bytes, int, bytes]:
    """Decimal ids joined by spaces (end id included), their number, and the decoded text."""
    if MARK.encode() in text or b"\0" in text:
        return _whole(model, text)
    words = WORD.findall(b" " + text) if text else []
    found = list(map(model.words.get, words))
    if None in found:
        for i, w in enumerate(words):
            if found[i] is None and w in model.old:
                model.words[w] = found[i] = model.old[w]
        new = list({w for w, f in zip(words, found, strict=True) if f is None})
        if new:
            known = {}
            for at in range(0, len(new), 4096):
                part = new[at:at + 4096]
                model.learn(part)
                known.update((w, model.words.get(w) or model.old[w]) for w in part)
            found = [f or known[w] for w, f in zip(words, found, strict=True)]
    ids = [f[0] for f in found]
    decoded = b"".join([f[2] for f in found])
    return b" ".join([*ids, str(model.end).encode()]), sum([f[1] for f in found]) + 1, decoded[1:]


def _whole(model: Agenda, text: bytes) -> tuple[bytes, int, bytes]:
    """A text with characters that stand for something else inside the library: encoded whole and compared whole."""
    string = text.decode()
    ids = model.encode((" " + string).replace(" ", MARK)) if string else []
    theirs = model.library.encode(string, num_threads=1)
    if ids != theirs:
        raise RuntimeError("the library encodes a text differently")
    back = model.library.decode(ids)
    return " ".join(map(str, [*ids, model.end])).encode(), len(ids) + 1, back.encode()


def coded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; others are not read): number of ids, and digests of ids and decoded text.

    Ids are those of the library's ``encode(text, add_eos=True)``. Null and empty texts are the end id alone. Repeated
    rows give repeated rows.
    """
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = agenda(vocabulary)
        for frame in frames:
            n, sha, back = [], [], []
            for text in frame.column("text"):
                ids, count, decoded = code(model, text.as_buffer().to_pybytes() if text.is_valid else b"")
                n.append(count)
                sha.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, CODED)
