"""Alignment of two vocabularies against whole-text encoding by their libraries, and the perfect hash."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from packetloom.llm import token_alignment as ta
from packetloom.llm.queries import QUERIES, vocabulary

SMALL = "/root/testdata/sf0.001"
A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
ODD = [None, "", " ", "  \n ", "one", " one", "one two", "a  b   c", "x\ty", "tab\t end\t", "line\nline\n\n  next\r\nz ", "日本語 テスト",
       "é ü ß x", "🙂 smile 👩‍👩‍👧", "<0x41> <unk> <s> </s> <|endoftext|> end", "a▁b", "a\0b c", "a b\0", "\x1c x!\x1cy",
       "don't I'll we've 12345 3.14", "a　b   c", "word " * 3000, "x" * 5000, "᠎  z", "same text", "same text", "\n", "﻿bom"]


def brute(rows):
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(
        [x for x in range(256) if x not in printable])}
    docs, count = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                 for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            docs.append((doc_id, 0, 0, []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in raw]).tolist() for raw in (raw_a, raw_b))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((ids_a[i:p], ids_b[j:q]))
            i, j = p, q
        docs.append((doc_id, len(ids_a), len(ids_b), groups))
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, n_a, n_b, groups in docs:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        shown = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == most[p[0]] for p in links),
                    sum(count[p] for p in links), shown))
    return Counter(out)


def rows_of(df):
    return Counter(tuple(r[f] for f in FIELDS) for r in df.select(FIELDS).collect())


def test_whole_table_equals_whole_text_encoding(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = QUERIES["op12_token_alignment"](spark, SMALL).collect()
    names = [f for f in FIELDS if f != "groups"]
    assert Counter((*(r[f] for f in names), r.groups_sha256) for r in got) == Counter(
        (*w[:-1], w[-1] and hashlib.sha256(w[-1].encode()).hexdigest()) for w in want.elements())


@pytest.mark.parametrize("limit", [0, ta.TABLE_BYTES])
def test_odd_texts_on_both_sides_of_the_broadcast_limit(spark, tmp_path, limit):
    pick = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "é", "!", "...", "12", " ", "　", "'s", "日", "🙂", "\r", "\x1c", "​"]
    rows = list(enumerate(ODD)) + [(100 + i, "".join(pick.choices(parts, k=pick.randint(1, 30)))) for i in range(400)]
    rows += [(None, "no id"), (7, "a  b   c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS groups", "1 AS row_id", "2 AS r")
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    assert rows_of(ta.aligned(spark.read.parquet(str(tmp_path / "docs")), A, B, limit)) == brute(rows)


def test_empty_table(spark):
    assert ta.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_texts_and_tasks_beyond_every_bound(monkeypatch):
    # in one process: long texts in slices, forgetful workers
    monkeypatch.setattr(ta, "SLICE_BYTES", 50)
    monkeypatch.setattr(ta, "BATCH_CHUNKS", 7)
    monkeypatch.setattr(ta, "CACHE_BYTES", 3000)
    monkeypatch.setattr(ta, "LEARNT", 5)
    pick = random.Random(6)
    texts = [" ".join("".join(pick.choices("abcdé\n", k=pick.randint(1, 9))) for _ in range(pick.randint(0, 120))) for _ in range(40)]
    model = ta.Aligner(A, B)
    figures, groups, good = ta._figures(model, texts, None)
    want = brute(list(enumerate(texts)))
    assert Counter((i, *figures[i, :4].tolist(), groups[i]) for i in range(len(texts))) == Counter(
        (*w[:5], w[7]) for w in want)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32))
    function = ta.PerfectHash.from_bytes(ta.PerfectHash.of(keys).to_bytes())
    assert sorted(function(keys).tolist()) == list(range(len(keys)))
    others = np.setdiff1d(np.arange(1000, dtype=np.uint32), keys)
    assert ((function(others) >= -1) & (function(others) < max(len(keys), 1))).all()
