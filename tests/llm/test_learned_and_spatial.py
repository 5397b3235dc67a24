"""Classifiers by held-out accuracy, search by recall, shards by their law, the pipeline stage by stage."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from packetloom.llm import byte_convnet, decision_list, hilbert, rp_forest
from packetloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def labels_of(spark):
    return {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_byte_network_on_the_held_out_fold(spark):
    rows = QUERIES["op10_byte_convnet"](spark, SF).collect()
    quality = labels_of(spark)
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([p == q for p, q in held]) >= 0.97


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    model = byte_convnet.train([b"good words here. And more of them.", b"%%% $$$ ### &&& %%%"] * 8, np.array([1.0, 0.0] * 8),
                               byte_convnet.Training(epochs=2, steps=1))
    import pyarrow as pa
    texts = [None, "", "a", "short text.", "word " * 9000, *["".join(chr(c) for c in rng.integers(32, 126, n)) for n in (31, 32, 33, 700)]]
    together = byte_convnet.scores(model, pa.array(texts, pa.string()))
    alone = [byte_convnet.scores(model, pa.array([t], pa.string()))[0] for t in texts]
    np.testing.assert_allclose(together, alone, atol=1e-5)
    assert together[0] == together[1]


def test_training_follows_the_gradient():
    texts, labels = [b"aaaa bbbb cccc dddd" * 4, b"#### $$$$ %%%% &&&&" * 4] * 6, np.array([1.0, 0.0] * 6)
    chunks = [byte_convnet._chunks_of(t, 4) for t in texts]
    model = byte_convnet.train(texts, labels, byte_convnet.Training(epochs=1, steps=1))
    model = {k: v.astype(np.float64) for k, v in model.items()}
    grads = byte_convnet._gradients(model, chunks, labels)

    def loss(m):
        import pyarrow as pa
        p = byte_convnet.scores({k: v.astype(np.float32) for k, v in m.items()}, pa.array([t.decode() for t in texts]))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, at in (("bias", (0,)), ("weights", (int(np.abs(grads["weights"]).argmax()),))):
        up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        up[name][at] += 1e-2
        down[name][at] -= 1e-2
        assert abs((loss(up) - loss(down)) / 2e-2 - grads[name][at]) < 0.05 * abs(grads[name][at]) + 1e-3


def test_labels_missing_or_of_one_kind(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c")], "doc_id long, text string")
    for rows in ([], [(1, 1), (2, None), (None, 0), (7, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert byte_convnet.keep_good(docs.withColumn("score", F.lit("x")), labels).count() == 3
        assert decision_list.judged(docs, labels).where("kept").count() == 0
    model = byte_convnet.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.score for r in byte_convnet.with_score(docs, model).collect()] == [0.5, 0.5, 0.5]
    assert byte_convnet.with_score(docs.where("false"), model).count() == 0


def test_decision_list_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rules = decision_list.fit(docs, labels)
    assert 1 <= len(rules) and all(rule for rule in rules)
    judged = decision_list.with_statistics(docs).withColumn("kept", decision_list.verdict(rules))
    rows = judged.where("NOT base_failed").join(labels, "doc_id").where(byte_convnet.held_out("doc_id")).select(
        "kept", "quality").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) >= 0.98


def test_rules_of_a_toy_table():
    rng = np.random.default_rng(1)
    x = {c: rng.integers(0, 100, 3000) for c in decision_list.FEATURES}
    bad = ((x["n_words"] <= 20) & (x["same_a_thousand"] >= 50)) | (x["symbols_a_thousand"] >= 90)
    rules = decision_list.learn(x, bad)
    hit = np.zeros(len(bad), bool)
    for rule in rules:
        hit |= decision_list._covers(rule, x)
    assert np.mean(hit == bad) >= 0.98
    assert decision_list.learn(x, np.zeros(3000, bool)) == []


def test_search_finds_what_brute_force_finds(spark):
    rows = QUERIES["op1_rp_forest"](spark, SF).collect()
    table = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    hit = 0
    queries = [i for i in table if i % 20 == 0]
    for q in queries:
        own = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        best = sorted(((-float((v * table[q]).sum()), i) for i, v in table.items() if i != q))[:20]
        assert [r.rank for r in own] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        assert all(abs(r.score - float((table[r.vec_id] * table[q]).sum())) < 1e-12 for r in own)
        hit += len({r.vec_id for r in own} & {i for _, i in best})
    assert hit >= 0.9 * 20 * len(queries)


def test_vectors_that_take_no_part_ties_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []),
            (None, [1.0, 1.0]), *[(i, [1.0, 0.0]) for i in range(7, 60)], (60, [2.0, 0.0]), (61, [1.0]), (7, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = rp_forest.nearest(vectors, F.col("vec_id") % 20 == 0).collect()
    own = [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: (r.query_id, r.rank)) if r.query_id == 0]
    assert own == [(1, 60, 2.0), *[(i - 5, i, 1.0) for i in range(7, 26)]]
    assert {r.query_id for r in got} == {0, 20, 40, 60}
    few = rp_forest.nearest(vectors.where("vec_id in (0, 7, 60)"), F.col("vec_id") == 0).collect()
    assert [(r.vec_id, r.score) for r in sorted(few, key=lambda r: r.rank)] == [(60, 2.0), (7, 1.0)]
    assert rp_forest.nearest(vectors.where("vec_id = 1"), F.lit(True)).count() == 0
    assert rp_forest.nearest(vectors.where("vec_id = 0"), F.lit(True)).count() == 0


@pytest.mark.parametrize("n, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(spark, n, bits):
    cells = spark.range(1 << n * bits).select(*[F.shiftright("id", bits * i).bitwiseAND((1 << bits) - 1).alias(f"x{i}")
                                                for i in range(n)])
    rows = cells.withColumn("h", hilbert.hilbert_index([F.col(f"x{i}") for i in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(1 << n * bits))
    assert all(sum(abs(a[i] - b[i]) for i in range(n)) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_shards_hold_equal_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    rows = QUERIES["op9_hilbert_sharding"](spark, SF).collect()
    assert {r.doc_id for r in rows} == set(text) and len(rows) == len(text)
    assert all(r.size == len(text[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id]) for r in rows)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append((r.slot, r.curve))
    counts = [len(s) for s in slots.values()]
    assert sorted(slots) == list(range(16)) and max(counts) - min(counts) <= 1
    ordered = [sorted(slots[s]) for s in range(16)]
    assert all([s for s, _ in o] == list(range(len(o))) for o in ordered)
    curve = [c for o in ordered for _, c in o]
    assert curve == sorted(curve)


def test_odd_rows_in_shards(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "", "a", float("nan")), (2, "é", "Z" * 20, 3.0), (3, "x", "a", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, slot double")
    got = hilbert.hilbert_shards(docs, ["lang", "slot"], shards=3).collect()
    assert sorted(r.size for r in got) == [1, 1, 1, 2, 3]
    assert sorted((r.shard, r.slot) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
    assert hilbert.hilbert_shards(docs.where("false"), ["lang", "slot"]).count() == 0


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "repeated_passages", "private_data", "packing"]
    kept, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(spark, stage(spark, kept, SF), name)
        assert kept.columns == docs.columns
        counts.append(kept.count())
    assert docs.count() > counts[0] > counts[1] == counts[2] == counts[3]
    quality = labels_of(spark)
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    clean = [i for i, q in quality.items() if q == 1]
    assert len(left & set(clean)) >= 0.85 * len(clean)
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left
