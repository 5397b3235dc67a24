"""Operators over documents against brute force, and the odd rows each of them must take."""

import hashlib
import re
import textwrap
from collections import Counter

import pytest

import corpus_pipeline
from packetloom.llm import decision_list, jaccard_join, license_scan, packing, pieces, pseudonyms, substring_dedup
from packetloom.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i * 7919 % 9973}" for i in range(40_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE two  three\nfour five"), (6, "one two three four five"),
       (7, LONG), (8, LONG + " tail"), (8, LONG + " tail"), (9, "same words here for all " * 30), (None, "one two three four five"),
       (10, "é ü ß   日本語 🙂 x²"), (11, "a\0b"), (12, " lead and trail ")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").repartition(2).cache()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_row(rows):
    return Counter(map(tuple, rows))


def brute_passages(rows, width=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return by_row(out)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_repeated_passages_equal_brute_force(table, request):
    docs = request.getfixturevalue(table)
    got = substring_dedup.repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert by_row(got) == brute_passages(texts_of(docs))


def test_passages_are_cut_and_other_columns_stay(spark, odd):
    docs = odd.selectExpr("text", "doc_id", "'x' AS row_key", "1 AS removed", "array(doc_id) AS Score")
    out = substring_dedup.without_passages(docs)
    assert out.schema == docs.schema and out.count() == len(ODD)
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[1] is None and kept[2] == "" and kept[9] == "" and kept[8] == "" and kept[12] == " lead and trail "


def test_a_path_whose_words_differ_is_taken_back(spark):
    same = " ".join(f"k{i}" for i in range(40))
    docs = spark.createDataFrame([(1, same + " a"), (2, same + " b")], "doc_id long, text string")
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS row_key")
    found = keyed.selectExpr("doc_id", "row_key", "41L AS n_words", "40L AS n_removed", "'' AS kept_sha256",
                             "array(struct(0 AS at, 40 AS n)) AS removed",
                             "array(struct(5L AS first, 6 AS n, 0 AS at, cast('x' AS binary) AS digest)) AS paths")
    wrong = spark.createDataFrame([(5, 6)], "first long, n int")
    rows = substring_dedup._taken_back(keyed, found, wrong, 35).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept_sha256) for r in rows] == [
        (41, 0, hashlib.sha256((same + end).encode()).hexdigest()) for end in (" a", " b")]


def brute_components(rows):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets, own = {}, []
    for doc_id, text in rows:
        w = WORD.findall((text or "").translate(lower))
        s = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set())
        own.append((doc_id, len(s)))
        if doc_id is not None:
            sets[doc_id] = s
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return by_row((i, n, None if i is None else find(i)) for i, n in own)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_jaccard_components_equal_brute_force(table, request):
    docs = request.getfixturevalue(table)
    assert by_row(jaccard_join.jaccard_components(docs).collect()) == brute_components(texts_of(docs))


def test_near_copies_that_link_only_in_chains(spark, monkeypatch):
    # each text differs from the next by a few words, far ones do not link; all lists are cut into small blocks
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "FEW_SETS", 0)
    words = [f"t{i}" for i in range(120)]
    rows = []
    for k in range(40):
        words = [*words]
        words[(k * 3) % 120] = f"new{k}"
        rows.append((100 - k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_row(jaccard_join.jaccard_components(docs).collect())
    assert got == brute_components(rows)
    assert jaccard_join.keep_one(docs.selectExpr("*", "1 AS n", "2 AS component_id")).columns == [
        "doc_id", "text", "n", "component_id"]


def test_near_copies_stage_equals_brute_force(spark):
    rows = []
    for base, edits in enumerate((9, 7, 10)):  # five-word Jaccard 0.813, 0.853 and 0.794
        words = [f"b{base}w{i}" for i in range(440)]
        rows.append((2 * base, " ".join(words)))
        for k in range(edits):
            words[20 + k * 44 if edits < 10 else 20 + k * 40] = f"b{base}x{k}"
        rows.append((2 * base + 1, " ".join(words)))
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    want = [r for j, r in enumerate(rows) if not any(
        100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for i in range(j))]
    assert [i for i, _ in want] == [0, 2, 4, 5]
    docs = jaccard_join.settled(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_row(texts_of(corpus_pipeline.near_copies(spark, docs, SMALL))) == by_row(want)


def test_repeated_rows_and_null_ids_leave_one_row_of_each_text(spark):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"]
    near = texts[4].replace("e7 ", "e7x ")
    rows = [(1, texts[0]), (1, texts[0]), (2, texts[1]), (None, texts[1]), (None, texts[2]), (None, texts[2]),
            (3, texts[3]), (3, texts[5]), (None, texts[4]), (4, near), (5, texts[4]), (6, None), (7, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS _row_key")
    docs = jaccard_join.settled(docs)
    kept = jaccard_join.keep_one(docs, percent=80, shingle=5)
    assert kept.columns == docs.columns
    kept = jaccard_join.settled(kept)
    want = [(1, texts[0]), (2, texts[1]), (None, texts[2]), (3, texts[3]), (3, texts[5]), (4, near), (6, None), (7, "")]
    assert by_row(texts_of(kept)) == by_row(want)
    assert by_row(texts_of(substring_dedup.without_passages(kept))) == by_row(want)


def brute_statistics(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    many, gone = Counter(windows), set()
    for i, k in enumerate(windows):
        if many[k] > 1:
            gone.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(gone))


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_statistics_equal_brute_force(table, request):
    docs = request.getfixturevalue(table)
    got = decision_list.with_statistics(docs).select("doc_id", *decision_list.COUNTS[:5], "base_failed").collect()
    want = []
    for doc_id, text in texts_of(docs):
        s = brute_statistics(text)
        want.append((doc_id, *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
    assert by_row(got) == by_row(want)


def brute_tokens(rows, capacity=4096):
    from tokenizers import Tokenizer
    import numpy as np
    import zlib
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    out = []
    for doc_id, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4").tobytes()
            out.append((doc_id, k, at, len(part) // 4, zlib.crc32(part)))
    return by_row(out)


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_packing_is_whole_and_tight(table, request):
    docs = request.getfixturevalue(table)
    rows = packing.pack(docs, vocabulary("word_bpe_49k.json")).collect()
    assert by_row(tuple(r)[:5] for r in rows) == brute_tokens(texts_of(docs))
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in bins.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + 2


def test_special_words_take_the_tokenizers_way():
    own = packing.WordIds(vocabulary("word_bpe_49k.json"))
    for text in ("don't we'LL it's", "x<|endoftext|>y <|startoftext|>", "İstanbul ΣΑΣ ﬁ é ́a", "a b　c",
                 "1a2b3 $$$a!!é12", "ÀÉß×÷ naïve", " x"):
        import numpy as np
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == own.whole.encode(
            text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_pieces_equal_the_library(table, request):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    docs = request.getfixturevalue(table)
    want = []
    for doc_id, text in texts_of(docs):
        ids = lib.encode(text or "", add_eos=True)
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    assert by_row(pieces.coded(docs, vocabulary("piece_bpe_32k.model")).collect()) == by_row(want)


def test_both_agendas_agree():
    own = pieces.Agenda(vocabulary("piece_bpe_32k.model"))
    for word in ("▁hello", "▁▁▁▁x", "aaaaaaaaaaaaaaaaaaa", "日本語の", "▁" * 40, "é🙂é", "▁" + "thnt" * 30):
        assert own._short(word) == own._long(word), word


def test_pseudonyms_keep_formats_and_links():
    f = pseudonyms.Feistel(b"key")
    text = ("und.34@mail7.example.com +1 (017) 555-7713 4111 1111 1111 1111 97.51.17.173 2024-02-29 31.12.1999 "
            "DE89370400440532013000 token = \"b44e15e09fd311c3cf3163b66d5a9875b883d8ce\" 123-45-6789")
    new, n = pseudonyms.replace(f, text)
    assert n == 9 and not set(text.split()) & set(new.split()) - {"+1", "token", "="}
    assert pseudonyms.replace(f, new, back=True) == (text, 9)
    card = re.search(r"(?:\d{4} ){3}\d{4}", new)[0].replace(" ", "")
    assert pseudonyms.luhn_digit(card[:-1]) == int(card[-1])
    assert pseudonyms.replace(f, "x " + text)[0] == "x " + new  # linked wherever it stands
    clean = "Version 2.0, CC BY-NC 4.0; 999.1.1.1 and 2023-02-30 and chapter 12."
    assert pseudonyms.replace(f, clean) == (clean, 0)
    assert pseudonyms.replace(pseudonyms.Feistel(b"other"), text)[0] != new


def test_numbers_that_fail_the_luhn_sum_are_left_alone():
    f = pseudonyms.Feistel(b"key")
    # order id, milliseconds, ISBN-13, and cards with a wrong check digit
    clean = "9807915762804490 1700000000000 9783161484100 4111 1111 1111 1112 4111-1111-1111-1112 3782 822463 10006"
    assert pseudonyms.replace(f, clean) == (clean, 0)
    for text, left in (("4111 1111 1111 1111", ""), ("0000 4111 1111 1111 1111", "0000 "), ("378282246310005.", "")):
        new, n = pseudonyms.replace(f, text)
        assert n == 1 and new.startswith(left) and new != text
        assert pseudonyms.replace(f, new, back=True) == (text, 1)


@pytest.mark.parametrize("a, b", [(1, 1), (1, 7), (3, 5), (16, 16), (271, 271)])
def test_feistel_is_a_permutation(a, b):
    f = pseudonyms.Feistel(b"k")
    images = [f.permute("t", v, a, b) for v in range(a * b)]
    assert sorted(images) == list(range(a * b))
    assert [f.permute("t", v, a, b, back=True) for v in images] == list(range(a * b))


def test_pseudonymised_rows(spark, odd, documents):
    docs = odd.selectExpr("doc_id", "text", "doc_id AS n", "'k' AS count")
    out = pseudonymised = pseudonyms.pseudonymised(docs, b"k", counted="n")
    assert out.columns == ["doc_id", "text", "count", "n"]
    assert by_row((r.doc_id, r.text) for r in pseudonymised.where("n = 0").collect()) == by_row(ODD)
    own = pseudonyms.Feistel(b"k")
    got = pseudonyms.pseudonymised(documents, b"k").select("doc_id", "text").collect()
    assert by_row(got) == by_row((i, t and pseudonyms.replace(own, t)[0]) for i, t in texts_of(documents))


def test_rows_are_replaced_whatever_else_the_text_holds(spark):
    own = pseudonyms.Feistel(b"k")
    texts = ["password: correct-horse", "password: correct-horse 1", "abcdefab" * 4, "\u0661\u0662\u0663-\u0664\u0665-\u0666\u0667\u0668\u0669", "plain", ""]
    rows = [(t, *pseudonyms.replace(own, t)) for t in texts]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = docs.selectExpr("text AS old", "text").transform(pseudonyms.pseudonymised, b"k", counted="n").collect()
    assert by_row(got) == by_row(rows)
    new = {r.old: r.text for r in got}
    assert new[texts[1]] == new[texts[0]] + " 1" and new[texts[0]] != texts[0] and new[texts[2]] != texts[2]


def test_license_notices(spark, odd):
    lines = {1: ("Good words.\nReleased under the MIT License.\nMore.", "MIT", True),
             2: ("THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3.", "GPL-3.0", True),
             3: ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0", True),
             4: ("Licensed$$$ under### CC*** BY-NC%%% 4.0.", "CC-BY-NC-4.0", True),
             5: ("Text all in one line and licensed under the Apache License, Version 2.0. And on it goes.", "Apache-2.0", True),
             6: ("This work is licensed under the GNU General Public License, version 7.", "GPL-2.0", False)}
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in lines.items()], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.confirmed) for r in license_scan.scan(docs).collect()}
    assert got == {i: (name, sure) for i, (_, name, sure) in lines.items()}
    assert license_scan.scan(odd).count() == 0


def licenses_in(text):
    templates = license_scan.Templates(license_scan.NOTICES)
    found = [n for _, words in license_scan.blocks_of(text) for n in templates.notices(words)]
    return [n[0] for n in found if n[-1]]


def test_wrapped_notices_are_found_with_comment_marks():
    prose = "Several other words stand here before and behind what is looked for. "
    for name, notices in license_scan.NOTICES.items():
        for notice in notices:
            for width in (24, 40, 72):
                for mark in ("", "# ", " * ", "// ", "dnl "):
                    wrapped = "".join(f"{mark}{line}\n" for line in textwrap.wrap(notice, width, break_on_hyphens=False, break_long_words=False))
                    assert licenses_in(f"{prose}\n{wrapped}{prose}") == [name], (name, width, mark, wrapped)
    both = "Released under the MIT License.\nAll rights reserved.\n# SPDX-License-Identifier:\n# Apache-2.0\n"
    assert sorted(licenses_in(both)) == ["Apache-2.0", "MIT", "all-rights-reserved"]


def test_short_notices_in_long_lines_are_found():
    lot = [f"w{chr(97 + i * 7 % 26)}{chr(97 + i * 11 % 26)}{chr(97 + i * 5 % 23)}" for i in range(400)]
    for name, notices in license_scan.NOTICES.items():
        for notice in notices:
            assert licenses_in(" ".join([*lot[:200], notice, *lot[200:]])) == [name], notice
    for text in ("licensed under CC BY-NC-XY 5.0", "SPDX-License-Identifier: Zlib", "a license for a public domain of rights",
                 "Licensed under the GNU General Public License, version 7."):
        assert licenses_in(" ".join([*lot[:200], text, *lot[200:]])) == [], text


def test_empty_tables(spark, documents):
    none = documents.where("false")
    assert substring_dedup.repeated_passages(none).count() == 0
    assert jaccard_join.jaccard_components(none).count() == 0
    assert decision_list.judged(none, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    assert packing.pack(none, vocabulary("word_bpe_49k.json")).count() == 0
    assert pieces.coded(none, vocabulary("piece_bpe_32k.model")).count() == 0
    assert pseudonyms.pseudonymised(none, b"k", counted="n").count() == 0
    assert license_scan.scan(none).count() == 0


def test_values_of_any_length_are_permuted_and_restored():
    dump = "".join(f"{i * 2654435761 % 65536:04x}" for i in range(50_000))
    text = f"before {dump} between {dump} after {dump[:8000]}"
    hidden, n = pseudonyms.replace(pseudonyms.Feistel(b"k"), text)
    parts = hidden.split(" ")
    assert n == 3 and parts[1] == parts[3] != dump and len(hidden) == len(text)
    assert pseudonyms.replace(pseudonyms.Feistel(b"k"), hidden, back=True) == (text, 3)
