"""Batches that do not depend on how Spark cuts Arrow frames."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from packetloom.llm import components, exchange, jaccard_join, substring_dedup
from packetloom.llm.words import slices
from tests.llm.test_text_operators import brute_components, brute_passages, by_row


def frames(rows, cuts):
    table = pa.RecordBatch.from_pydict({"id": pa.array(range(len(rows))), "text": pa.array(rows, pa.string())})
    edges = [0, *sorted(cuts), len(rows)]
    return [table.slice(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def test_batches_and_checksums_follow_from_the_rows_alone():
    pick = random.Random(1)
    rows = [None if i % 11 == 0 else "x" * pick.randint(0, 400) for i in range(200)]
    want = None
    for _ in range(20):
        cuts = pick.sample(range(200), pick.randint(0, 30))
        got = [(b.column("id").to_pylist(), exchange._checksum(b.column("text")))
               for b in exchange.in_batches(iter(frames(rows, cuts)), "text", 1000)]
        want = want or got
        assert got == want
    assert [i for ids, _ in want for i in ids] == list(range(200)) and 20 < len(want) < 60


def test_a_checksum_sees_the_content():
    a, b = pa.array(["ab", "cd", None]), pa.array(["cd", "ab", ""])
    assert exchange._checksum(a) != exchange._checksum(b)
    assert exchange._checksum(a) == exchange._checksum(pa.array(["zz", "ab", "cd", ""]).slice(1))
    assert exchange._checksum(pa.array([], pa.string())) == exchange._checksum(pa.array([None], pa.string()).slice(1))


@pytest.mark.parametrize("limit", ["20000", "200000"])
def test_operators_on_frames_cut_by_bytes(spark, tmp_path, limit):
    pick = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(pick.choices(words, k=pick.randint(200, 900))) for _ in range(150)]
    rows = [(i, pick.choice(texts) if i % 3 else texts[i % 150] + " own") for i in range(240)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, limit)
    try:
        got = substring_dedup.repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert by_row(got) == brute_passages(rows)
        assert by_row(jaccard_join.jaccard_components(docs).collect()) == brute_components(rows)
    finally:
        spark.conf.unset(name)


def near_rows(pick, groups):
    rows = []
    for g in range(groups):
        words = [f"g{g}w{pick.randrange(200)}" for _ in range(pick.randint(5, 60))]
        for _ in range(pick.randint(2, 9)):
            words = [*words]
            for _ in range(pick.choice([0, 1, 1, 2])):
                words.insert(pick.randrange(len(words)), f"g{g}x{pick.randrange(200)}")
            rows.append(" ".join(words))
    pick.shuffle(rows)
    return list(enumerate(rows))


def test_frequencies_and_links_hold_across_batches(spark, monkeypatch):
    monkeypatch.setattr(exchange, "BATCH_BYTES", 4000)
    rows = near_rows(random.Random(5), 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    want = Counter()
    for _, text in rows:
        (own,) = jaccard_join.shingle_sets(next(slices(pa.array([text])))[1], 4)
        want.update(own.tolist())
    how = exchange.plan(docs, "text")
    keys_of = jaccard_join._keys(4)
    answers = exchange.answer(exchange.ask(docs, "text", keys_of, how, 6), 6, signatures=False)

    def told(batch, answers):
        keys, often = exchange.shared(keys_of(batch.column("text"))[0], answers, how.parts, 6)
        return pa.table({"key": keys.view("int64"), "often": pa.array(often.astype("int64"))})

    met = exchange.meet(docs, "text", answers, told, how, "key long, often long").collect()
    assert len({r.b for r in answers.select("b").collect()}) > 9
    assert {(r.key % 2**64, r.often) for r in met} == {(k, n) for k, n in want.items() if n > 1}
    assert by_row(jaccard_join.jaccard_components(docs).collect()) == brute_components(rows)


def test_rows_without_a_doc_id_or_with_a_repeated_one_are_documents(spark):
    def text(name, *edits):
        return " ".join(f"{name}{i}x" if i in edits else f"{name}{i}" for i in range(100))

    rows = [(3, text("a", 10)), (None, text("a", 10, 40)), (1, text("a", 10, 40, 70)), (2, text("a", 10, 40, 70, 90)),
            (6, text("b")), (7, text("b", 5)), (7, text("c")), (9, text("c", 5)), (8, text("d")), (None, text("d"))]
    docs = jaccard_join.settled(spark.createDataFrame(rows, "doc_id long, text string"))
    got = by_row(jaccard_join.jaccard_components(docs, percent=92).collect())
    assert got == by_row([(3, 97, 1), (None, 97, None), (1, 97, 1), (2, 97, 1), (6, 97, 6), (7, 97, 6), (7, 97, 7),
                          (9, 97, 7), (8, 97, 8), (None, 97, None)])


def test_shingles_keep_64_bits():
    (own,) = jaccard_join.shingle_sets(next(slices(pa.array([" ".join(map(str, range(500)))])))[1], 4)
    assert len(own) == 497 and (own >> 48).any()


def test_chains_in_any_order_take_few_rounds(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(components, "settled", lambda df: calls.append(1) or jaccard_join.settled(df))
    nodes = random.Random(3).sample(range(10**9), 600)
    links = spark.createDataFrame(list(zip(nodes, nodes[1:], strict=False)), "x long, y long")
    assert {tuple(r) for r in components.components(links).collect()} == {(n, min(nodes)) for n in nodes}
    assert len(calls) < 20
