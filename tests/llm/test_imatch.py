"""I-Match fingerprints against a version of one text at a time, over sets of words."""

import base64
import hashlib
import re
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from packetloom.llm import imatch
from packetloom.llm.queries import QUERIES
from packetloom.llm.words import BYTE_BASE, BYTE_VALUE, LOWER, WORD_BASE

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FULL = (1 << 64) - 1
FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def mixed(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & FULL
    return x ^ x >> 31


def span(values, base):
    return mixed((sum(v * pow(base, k, 1 << 64) for k, v in enumerate(values)) + len(values)) & FULL)


def terms(text):
    return {span([int(BYTE_VALUE[LOWER[b]]) for b in w], BYTE_BASE) for w in set(WORD.findall(text.encode()))}


def band(texts, low=imatch.LOW, high=imatch.HIGH):
    df = Counter(t for text in texts for t in terms(text))
    return {t for t, n in df.items() if n * 2 ** low <= len(texts) <= n * 2 ** high}


def hashes(text, known):
    own = terms(text)
    own = own & known if len(own & known) >= imatch.LEAST_TERMS else own
    out = []
    groups = [own]
    for level, (share, subsets) in enumerate(imatch.LEVELS):
        groups += [{t for t in own if mixed((t + level + 1) & FULL) % share == j} for j in range(subsets)]
    for g in groups:
        out.append(max(1, span(sorted(g), WORD_BASE) >> 32) if g else 0)
    out[0] = out[0] or max(1, int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "big"))
    return out


def like(a, b):
    if a[0] == b[0]:
        return 1.0
    end = 1 + imatch.SUBSETS
    for level, (_, subsets) in reversed(list(enumerate(imatch.LEVELS))):
        pairs = [(x, y) for x, y in zip(a[end - subsets:end], b[end - subsets:end], strict=True) if x or y]
        if len(pairs) >= imatch.LEAST_SUBSETS or level == 0:
            return sum(x == y for x, y in pairs) / max(len(pairs), 1)
        end -= subsets


def brute(rows, order):
    rows = sorted(rows, key=order)
    known = band([t or "" for _, t in rows])
    shown = lambda h: base64.b64encode(struct.pack(f"<{len(h)}I", *h)).decode()
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + following[:n]
        a, b, c = (hashes(t, known) for t in (text, changed, following))
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), shown(a), shown(b), like(a, b), like(a, c)))
    return Counter(out)


def found(df):
    return Counter(tuple(r[f] for f in FIELDS) for r in df.select(FIELDS).collect())


def test_whole_table_equals_one_text_at_a_time(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert found(QUERIES["op11_imatch"](spark, SMALL)) == brute(docs, lambda r: r[0])


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows(spark, parts):
    long = " ".join(f"w{i * 7919 % 997}" for i in range(300))
    rows = [(3, None), (1, ""), (2, " \n"), (5, "é" * 11), (9, long), (9, long), (9, long), (8, long + " tail"), (None, "x y z"),
            (4, "One one ONE two"), (7, "🙂🙂🙂 a"), (6, "a\0b"), *((20 + i, f"common w{i} words here {i % 3}") for i in range(40))]
    rows += [(30, "tie")] * 12  # equal ids and texts
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS kind", "1 AS task", "'' AS fingerprint")
    digests = {r.text: r.d for r in docs.selectExpr("text", "xxhash64(coalesce(text, '')) AS d").distinct().collect()}
    key = lambda r: (r[0] is not None, r[0] or 0, digests[r[1]])
    docs = docs.repartition(parts)
    assert found(imatch.edited_neighbours(docs, imatch.lexicon(docs))) == brute(rows, key)


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcd efgh ijkl")], "doc_id long, text string")
    assert found(imatch.edited_neighbours(one, imatch.lexicon(one))) == brute([(1, "abcd efgh ijkl")], lambda r: r[0])
    none = one.where("false")
    assert imatch.edited_neighbours(none, imatch.lexicon(none)).collect() == []


def test_fingerprints_stay_with_their_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d", "own"), (2, "a b c d", "x"), (3, None, "y"), (4, "", "z")],
                                 "doc_id long, text string, fingerprint string")
    out = {r.doc_id: (r.fingerprint, r.fingerprint_0) for r in imatch.fingerprinted(docs, imatch.lexicon(docs)).collect()}
    assert out[1][0] == "own" and out[1][1] == out[2][1] != out[3][1] == out[4][1]


def test_edited_texts_are_nearer_than_next_ones(spark):
    rows = QUERIES["op11_imatch"](spark, "/root/testdata/sf0.01").collect()
    assert np.mean([r.near_edited > r.near_next for r in rows if r.n_chars >= 200]) > 0.95
    assert np.mean([r.near_next for r in rows]) < 0.1


def test_a_worker_sums_terms_within_its_bound(spark, monkeypatch):
    monkeypatch.setattr(imatch, "HELD_TERMS", 50)
    docs = spark.createDataFrame([(i, f"w{i} w{i % 7} same") for i in range(300)], "doc_id long, text string")
    got = {r.term & FULL: r.df for r in imatch.document_frequencies(docs).collect()}
    assert got == Counter(t for i in range(300) for t in terms(f"w{i} w{i % 7} same"))
