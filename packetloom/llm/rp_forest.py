"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are split by hyperplanes between two random centres; they are fitted on a bounded sample (``Forest.sample`` rows
chosen by a hash), one task per tree, and every row of the table is then put into its leaf of every tree. A query walks all
trees at once through one priority queue, the closest hyperplane first, until the leaves it has reached hold as many rows
as its budget allows. Leaves and the queries that reach them meet in blocks, where candidates are scored exactly on
the original vectors. The budget is calibrated: for a bounded sample of queries the true neighbours are found by
brute force, and the budget is what reaches a given share of them.

Largest inner product is nearness between unit-like vectors after one more dimension has made all rows equally long.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from packetloom.llm.components import settled


@dataclass(frozen=True)
class Forest:
    """``sample`` rows fit the trees; ``probes`` queries calibrate the budget to ``recall`` of true neighbours."""
    trees: int = 4
    sample: int = 20_000
    leaf: int = 256
    probes: int = 100
    recall: float = 0.96
    rows_a_block: int = 2048
    queries_a_block: int = 1024
    seed: int = 5


#: A found score is computed anew for all within this distance, so that equal vectors get equal scores.
NEAR = 1e-9
FOUND = "query_id long, vec_id long, score double"


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, by row, the same wherever a row stands in its block."""
    return (rows * query).sum(-1)


def _taller(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(longest * longest - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], 1)


def grow(x: np.ndarray, leaf: int, rng: np.random.Generator) -> list[tuple]:
    """A tree as a list of nodes (normal, offset, low child, high child); leaves have no normal."""
    nodes: list[tuple] = []
    todo = [(np.arange(len(x)), -1, 0)]
    while todo:
        own, parent, side = todo.pop()
        me = len(nodes)
        nodes.append((None, 0.0, -1, -1))
        if parent >= 0:
            n = nodes[parent]
            nodes[parent] = (n[0], n[1], me, n[3]) if side == 0 else (n[0], n[1], n[2], me)
        if len(own) <= leaf:
            continue
        some = x[rng.choice(own, min(len(own), 256), replace=False)]
        a, b = some[0], some[1]
        for _ in range(4):
            near_a = ((some - a) ** 2).sum(1) < ((some - b) ** 2).sum(1)
            if near_a.all() or not near_a.any():
                break
            a, b = some[near_a].mean(0), some[~near_a].mean(0)
        normal = a - b
        size = np.linalg.norm(normal)
        if not size:
            continue
        normal = normal / size
        offset = float(normal @ (a + b) / 2)
        high = x[own] @ normal > offset
        if high.all() or not high.any():
            continue
        nodes[me] = (normal, offset, -1, -1)
        todo += [(own[~high], me, 0), (own[high], me, 1)]
    return nodes


def leaves(nodes: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, own = todo.pop()
        normal, offset, low, high = nodes[node]
        if normal is None:
            out[own] = node
            continue
        up = x[own] @ normal > offset
        todo += [(low, own[~up]), (high, own[up])]
    return out


def walk(forest: list[list[tuple]], sizes: dict[tuple[int, int], int], q: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(tree, leaf, rows reached before it), the most promising leaf of all trees first."""
    queue = [(-np.inf, t, 0) for t in range(len(forest))]
    reached = 0
    while queue:
        far, t, node = heapq.heappop(queue)
        normal, offset, low, high = forest[t][node]
        if normal is None:
            if n := sizes.get((t, node), 0):
                yield t, node, reached
                reached += n
            continue
        side = float(q @ normal) - offset
        heapq.heappush(queue, (max(far, -side), t, high))
        heapq.heappush(queue, (max(far, side), t, low))


def usable(vectors: DataFrame, vector: str) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda c: c != 0)


def _best(ids: np.ndarray, rows: np.ndarray, own_id: int, query: np.ndarray, rough: np.ndarray, k: int, least: float):
    """The k best rows for a query, ties to the smaller id, of those that can reach ``least``."""
    keep = (rough >= least - NEAR) & (ids != own_id)
    if keep.sum() > k:
        keep &= rough >= np.partition(rough[keep], -k)[-k] - NEAR
    at = np.flatnonzero(keep)
    score = exact(rows[at], query)
    order = np.lexsort((ids[at], -score))[:k]
    return ids[at[order]], score[order]


def nearest(vectors: DataFrame, queries: Column, k: int = 20, how: Forest = Forest(), id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row that ``queries`` holds for, its ``k`` nearest other rows found.

    Nearness is the inner product of the original vectors; ties go to the smaller id. Vectors that are null, zero, of
    another length than most, or hold null or non-finite components take no part, and neither do rows with a null id; of rows
    that repeat an id and vector one is returned; an id stands for one vector. With at most ``k`` others all are returned; with none, nothing.
    """
    rows = vectors.select(F.col(id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                          queries.alias("is_query")).where("vec_id is not null").where(usable(vectors, "v"))
    found = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(
        F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)).alias("longest")).orderBy(F.desc("n"), "d").first()
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == found.d).dropDuplicates(["vec_id", "v"])
    longest = float(np.sqrt(found.longest))
    spark = vectors.sparkSession
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(how.seed)), "vec_id").limit(how.sample).toPandas()
    sample_rows = _matrix(sample.v)
    tall = spark.sparkContext.broadcast(_taller(sample_rows, longest))

    def fit(frames):
        for f in frames:
            for t in f.id:
                tree = grow(tall.value, how.leaf, np.random.default_rng(how.seed + 1000 * int(t)))
                yield pd.DataFrame({"tree": [t], "nodes": [pickle.dumps(tree)]})

    grown = spark.range(how.trees, numPartitions=how.trees).mapInPandas(fit, "tree long, nodes binary").collect()
    trees = [pickle.loads(r.nodes) for r in sorted(grown, key=lambda r: r.tree)]
    forest = spark.sparkContext.broadcast(trees)

    def place(frames):
        for f in frames:
            if not len(f):
                continue
            x = _matrix(f.v)
            up = _taller(x, longest)
            raw = [r.tobytes() for r in x]
            for t, nodes in enumerate(forest.value):
                yield pd.DataFrame({"tree": t, "leaf": leaves(nodes, up), "vec_id": f.vec_id, "raw": raw})

    index = settled(rows.select("vec_id", "v").mapInPandas(place, "tree int, leaf int, vec_id long, raw binary"))
    # as many rows as the trees have leaves
    size = {(r.tree, r.leaf): r["count"] for r in index.groupBy("tree", "leaf").count().collect()}
    sample_leaf = np.stack([leaves(nodes, tall.value) for nodes in trees])
    known = spark.sparkContext.broadcast((size, sample.vec_id.to_numpy(), sample_rows, sample_leaf))
    budget = _calibrated(rows, trees, size, longest, k, how)
    asked = rows.where(F.coalesce("is_query", F.lit(False))).select("vec_id", "v")

    def search(frames):
        sizes, sample_ids, some, sample_leaf = known.value
        for f in frames:
            for own, v in zip(f.vec_id, f.v, strict=True):
                q = np.asarray(v, np.float64)
                seen = [(t, leaf) for t, leaf, _ in _within(walk(forest.value, sizes, np.append(q, 0.0)), budget)]
                # the k best sample rows in these leaves bound the k best rows in them from below
                reached = np.zeros(len(some), bool)
                for t, nodes in enumerate(forest.value):
                    visited = np.zeros(len(nodes), bool)
                    visited[[leaf for tree, leaf in seen if tree == t]] = True
                    reached |= visited[sample_leaf[t]]
                reached &= sample_ids != own
                rough = some[reached] @ q
                least = np.partition(rough, -k)[-k] if len(rough) >= k else -np.inf
                yield pd.DataFrame({"tree": [t for t, _ in seen], "leaf": [x for _, x in seen], "query_id": own,
                                    "q": q.tobytes(), "least": least})

    visits = settled(asked.mapInPandas(search, "tree int, leaf int, query_id long, q binary, least double"))
    blocks = visits.groupBy("tree", "leaf").agg(F.count("*").alias("nq")).join(
        F.broadcast(index.groupBy("tree", "leaf").agg(F.count("*").alias("nr"))), ["tree", "leaf"]).select(
        "tree", "leaf", F.ceil(F.col("nr") / how.rows_a_block).cast("int").alias("rb"),
        F.ceil(F.col("nq") / how.queries_a_block).cast("int").alias("qb"))
    blocks = F.broadcast(settled(blocks))  # a row for each leaf of the fitted trees at most

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = index.join(blocks, ["tree", "leaf"]).withColumn("r", F.pmod(F.xxhash64("vec_id"), F.col("rb")).cast("int"))
    left = left.select("tree", "leaf", "r", every("qb").alias("s"), "vec_id", "raw")
    right = visits.join(blocks, ["tree", "leaf"]).withColumn("s", F.pmod(F.xxhash64("query_id"), F.col("qb")).cast("int"))
    right = right.select("tree", "leaf", every("rb").alias("r"), "s", "query_id", "q", "least")

    def score(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        if not len(have) or not len(want):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids = have.vec_id.to_numpy()
        x, q = (np.frombuffer(b"".join(c), np.float64).reshape(len(c), -1) for c in (have.raw, want.q))
        rough = q @ x.T
        out = [_best(ids, x, own, q[i], rough[i], k, least) for i, (own, least) in enumerate(
            zip(want.query_id, want.least, strict=True))]
        return pd.DataFrame({"query_id": np.repeat(want.query_id.to_numpy(), [len(a) for a, _ in out]),
                             "vec_id": np.concatenate([a for a, _ in out]), "score": np.concatenate([s for _, s in out])})

    keys = ["tree", "leaf", "r", "s"]
    scored = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, FOUND)
    best = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))), 1, k).alias("b"))
    return best.select("query_id", F.posexplode("b").alias("rank", "b")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "b.vec_id", "b.score")


def _within(steps, budget: int):
    for t, leaf, before in steps:
        if before >= budget:
            return
        yield t, leaf, before


def _calibrated(rows: DataFrame, trees, size, longest: float, k: int, how: Forest) -> int:
    """The budget that reaches ``how.recall`` of the true neighbours of the probe queries."""
    probes = rows.where(F.coalesce("is_query", F.lit(False))).orderBy(
        F.xxhash64("vec_id", F.lit(how.seed + 1)), "vec_id").limit(how.probes).select("vec_id", "v").toPandas()
    least = 2 * how.trees * (k + 1)
    if not len(probes):
        return least
    ids, q = probes.vec_id.to_numpy(), _matrix(probes.v)

    def brute(frames):
        for f in frames:
            if not len(f):
                continue
            x, own = _matrix(f.v), f.vec_id.to_numpy()
            rough = q @ x.T
            for i in range(len(ids)):
                found, score = _best(own, x, ids[i], q[i], rough[i], k, -np.inf)
                keep = np.searchsorted(np.sort(own), found)
                place = np.argsort(own, kind="stable")[keep]
                yield pd.DataFrame({"probe": i, "vec_id": found, "score": score, "raw": [r.tobytes() for r in x[place]]})

    near = rows.select("vec_id", "v").mapInPandas(brute, "probe int, vec_id long, score double, raw binary")
    near = near.groupBy("probe").agg(F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("s"), "vec_id", "raw"))), 1, k).alias("b")).collect()  # probes * k rows
    needed = []
    for r in near:
        true = _taller(np.stack([np.frombuffer(b.raw, np.float64) for b in r.b]), longest)
        at = {(t, int(leaf)): before for t, leaf, before in walk(trees, size, np.append(q[r.probe], 0.0))}
        own = np.stack([leaves(nodes, true) for nodes in trees], 1)
        needed += [min(at[(t, int(leaf))] for t, leaf in enumerate(o)) for o in own]
    return max(least, int(np.quantile(needed, how.recall, method="higher")) + 1) if needed else least
