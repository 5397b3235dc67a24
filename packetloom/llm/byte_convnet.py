"""Quality classifier: a convolutional network over the bytes of a text, in numpy.

Filters of eight bytes are learned over byte embeddings and one channel that marks bytes repeating what stood a few
bytes before. A text is covered by overlapping chunks; in each chunk every
filter is max-pooled; the mean and the maximum over all chunks of the text go into one logistic unit. Any
length is scored whole, in slices of bounded memory. The network is trained in one task on a bounded sample of labelled
texts (``Training.sample``), chosen by a hash; only its weights, some kilobytes, pass through the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from packetloom.llm.components import fresh
from packetloom.llm.memory import tidy
from packetloom.llm.words import slices

DIM, WIDTH, STRIDE, FILTERS = 4, 8, 2, 24
BLOCK = 16  # positions pooled first; a position is STRIDE bytes
CHUNK, HOP = 8, 7  # blocks of a chunk, and from one chunk to the next
PAD = 256
ECHO_GRAM, ECHO_LAGS = 4, range(3, 20)
WINDOW = WIDTH * (DIM + 1)
SLICE = 1 << 18


@dataclass(frozen=True)
class Training:
    """``sample``: labelled texts at most. ``chunks``: chunks of a text in training, evenly spread over it. ``epochs`` over
    the sample, more where it is so small that they are fewer than ``steps`` steps."""
    sample: int = 5000
    chunks: int = 24
    epochs: int = 6
    steps: int = 900
    texts_a_step: int = 32
    rate: float = 0.004
    seed: int = 11


def _padded(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes with every text filled up to whole blocks, and the number of blocks of each text."""
    size = np.diff(bounds)
    unit = BLOCK * STRIDE
    # filled up by more than the farthest lag, so no text echoes another
    blocks = np.where(size > 0, -(-(size + max(ECHO_LAGS) + ECHO_GRAM) // unit), 0)
    at = np.concatenate([[0], np.cumsum(blocks)])
    codes = np.full(int(at[-1]) * unit + WIDTH, PAD, np.int16)
    codes[np.repeat(at[:-1] * unit - bounds[:-1], size) + np.arange(len(data))] = data
    return codes, blocks


def _echo(codes: np.ndarray) -> np.ndarray:
    """1 where the last ECHO_GRAM bytes also stand a few bytes before."""
    code = np.where(codes == PAD, 0, codes).astype(np.uint32)
    gram = code.copy()
    for k in range(1, ECHO_GRAM):
        gram[k:] |= code[:-k] << np.uint32(8 * k)
    out = np.zeros(len(codes), bool)
    for lag in ECHO_LAGS:
        out[lag:] |= gram[lag:] == gram[:-lag]
    return out & (codes != PAD)


def _inputs(model: dict, codes: np.ndarray, echo: np.ndarray) -> np.ndarray:
    return np.concatenate([model["table"][codes], echo[..., None].astype(np.float32)], -1)


def _windows(values: np.ndarray) -> np.ndarray:
    """Byte windows at every position of (bytes, channels): rows of WINDOW values."""
    step, deep = values.strides[0], values.strides[1]
    return np.lib.stride_tricks.as_strided(values, ((len(values) - WIDTH) // STRIDE, WINDOW), (step * STRIDE, deep))


def pooled(model: dict, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean and maximum over the chunks of each text of the max-pooled filters; zeros for empty texts."""
    codes, blocks = _padded(data, bounds)
    texts = len(blocks)
    out = np.zeros((texts, 2 * FILTERS), np.float32)
    total = int(blocks.sum())
    if not total:
        return out
    echo = _echo(codes)
    best = np.empty((total + 1, FILTERS), np.float32)
    best[-1] = 0
    last = np.cumsum(blocks)[blocks > 0] - 1
    step = 512
    for s in range(0, total, step):
        e = min(total, s + step)
        span = slice(s * BLOCK * STRIDE, e * BLOCK * STRIDE + WIDTH)
        values = _inputs(model, codes[span], echo[span])
        seen = (np.ascontiguousarray(_windows(values)) @ model["filters"]).reshape(e - s, BLOCK, FILTERS)
        # windows that start in the padding and reach into the next text are all padding
        ending = last[np.searchsorted(last, s):np.searchsorted(last, e)] - s
        seen[ending, BLOCK + 1 - WIDTH // STRIDE:] = 0
        best[s:e] = seen.max(1)
    best[:-1] = np.maximum(best[:-1] + model["shift"], 0)
    # chunks of a text start every HOP blocks; what a chunk lacks at the end of its text is row -1, zeros
    full = blocks > 0
    chunks = np.where(full, 1 + -(-np.maximum(blocks - CHUNK, 0) // HOP), 0)
    base = np.cumsum(blocks) - blocks
    first = np.cumsum(chunks) - chunks
    number = np.arange(int(chunks.sum())) - np.repeat(first, chunks)
    start, limit = number * HOP, np.repeat(blocks, chunks)
    top = None
    for k in range(CHUNK):
        row = best[np.where(start + k < limit, np.repeat(base, chunks) + start + k, -1)]
        top = row if top is None else np.maximum(top, row, out=top)
    out[full, :FILTERS] = np.add.reduceat(top, first[full]) / chunks[full][:, None]
    out[full, FILTERS:] = np.maximum.reduceat(top, first[full])
    return out


def scores(model: dict, column: pa.Array) -> np.ndarray:
    """Probability of good quality for every text of an Arrow column."""
    parts = [pooled(model, t.data, t.bounds) @ model["weights"] + model["bias"] for _, t in slices(column, SLICE)]
    return 1 / (1 + np.exp(-np.concatenate([np.zeros(0), *parts]).astype(np.float64)))


def _chunks_of(text: bytes, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes and echo marks of a text's chunks, one per row."""
    codes, _ = _padded(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    unit = BLOCK * STRIDE
    blocks = (len(codes) - WIDTH) // unit
    n = 1 + -(-max(blocks - CHUNK, 0) // HOP)
    codes = np.concatenate([codes, np.full(unit * CHUNK, PAD, np.int16)])
    picked = np.unique(np.linspace(0, n - 1, min(n, most)).round().astype(int))
    echo = _echo(codes)
    return tuple(np.stack([x[k * HOP * unit:k * HOP * unit + CHUNK * unit + WIDTH] for k in picked]) for x in (codes, echo))


def train(texts: list[bytes], labels: np.ndarray, how: Training = Training()) -> dict:
    """Fit by Adam on the logistic loss; with labels of one kind or none at all, the share of ones is learned."""
    rng = np.random.default_rng(how.seed)
    model = {"table": rng.normal(0, 0.5, (PAD + 1, DIM)), "filters": rng.normal(0, WINDOW ** -0.5, (WINDOW, FILTERS)),
             "shift": np.zeros(FILTERS), "weights": rng.normal(0, 0.1, 2 * FILTERS), "bias": np.zeros(1)}
    share = (labels.sum() + 1) / (len(labels) + 2)
    model["bias"][0] = np.log(share / (1 - share))
    model = {k: v.astype(np.float32) for k, v in model.items()}
    model["table"][PAD] = 0
    if not 0 < labels.sum() < len(labels):
        model["weights"][:] = 0
        return model
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    chunks = [_chunks_of(t, how.chunks) for t in texts]
    steps = 0
    a_round = -(-len(texts) // how.texts_a_step)
    epochs = max(how.epochs, -(-how.steps // a_round))
    rounds = epochs * a_round
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), how.texts_a_step):
            picked = order[at:at + how.texts_a_step]
            grads = _gradients(model, [chunks[i] for i in picked], labels[picked])
            steps += 1
            rate = how.rate * (1 - 0.9 * steps / rounds)
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model[k] -= (rate * (first[k] / (1 - 0.9 ** steps)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** steps)) + 1e-8)).astype(np.float32)
    return model


def _gradients(model: dict, chunks: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> dict:
    codes, echo = (np.concatenate([c[i] for c in chunks]) for i in range(2))
    n = np.array([len(c) for c, _ in chunks])
    owner, first = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    positions = CHUNK * BLOCK
    values = _inputs(model, codes, echo)
    far, step, deep = values.strides
    view = np.lib.stride_tricks.as_strided(values, (len(codes), positions, WINDOW), (far, step * STRIDE, deep))
    seen = (np.ascontiguousarray(view).reshape(-1, WINDOW) @ model["filters"]).reshape(len(codes), positions, FILTERS)
    where = seen.argmax(1)
    top = np.maximum(np.take_along_axis(seen, where[:, None], 1)[:, 0] + model["shift"], 0)
    mean = np.add.reduceat(top, first) / n[:, None]
    most = np.maximum.reduceat(top, first)
    features = np.concatenate([mean, most], 1)
    p = 1 / (1 + np.exp(-(features @ model["weights"] + model["bias"])))
    out = ((p - labels) / len(labels)).astype(np.float32)
    d_feature = out[:, None] * model["weights"]
    d_top = (d_feature[:, :FILTERS] / n[:, None])[owner] + d_feature[:, FILTERS:][owner] * (top == most[owner])
    d_top *= top > 0
    # only the winning window of a filter in a chunk learns
    place = where[:, :, None] * STRIDE + np.arange(WIDTH)
    row = np.arange(len(codes))[:, None, None]
    bytes_at = codes[row, place]
    windows = values[row, place].reshape(len(codes), FILTERS, -1)
    d_filters = np.einsum("ckw,ck->wk", windows, d_top)
    d_windows = (d_top[:, :, None] * model["filters"].T[None]).reshape(-1, DIM + 1)
    codes_at = bytes_at.reshape(-1)
    d_table = np.stack([np.bincount(codes_at, d_windows[:, j], PAD + 1) for j in range(DIM)], 1)
    d_table[PAD] = 0
    return {"table": d_table, "filters": d_filters, "shift": d_top.sum(0),
            "weights": features.T @ out + 1e-4 * model["weights"], "bias": out.sum(keepdims=True)}


def held_out(doc_id: str) -> Column:
    """The fold of a document that no label is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", how: Training = Training()) -> dict:
    """Train on documents with a label outside the held-out fold. Rows with a null id, label or text are no examples;
    repeated rows count as often as they come. Without any example every text gets one half."""
    known = labels.where(~held_out("doc_id")).select("doc_id", F.col(target).alias("label")).where(
        "doc_id is not null and label is not null")
    rows = known.orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label").limit(how.sample)
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(rows), "doc_id")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *frames])
        rows = rows.sort_values(["doc_id", "label", "text"], ignore_index=True)[:how.sample]
        model = train([t.encode() for t in rows.text], rows.label.to_numpy(np.float64), how)
        yield pd.DataFrame({"model": [pickle.dumps(model)]})

    # one task: at most ``sample`` rows reach it
    model = sample.repartition(1).mapInPandas(learn, "model binary").first()
    return pickle.loads(model[0]) if model else train([], np.zeros(0), how)


def with_score(docs: DataFrame, model: dict, name: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality in a column ``name`` (replaced where it exists). Null and empty
    texts get the score of a text without any feature."""
    columns = [c for c in docs.columns if c != name]

    def run(frames):
        for f in frames:
            yield pa.RecordBatch.from_arrays(
                [*[f.column(columns.index(c)) for c in columns], pa.array(scores(model, f.column(columns.index("text"))))],
                [*columns, name])

    kept = docs.select(*columns)
    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """``docs`` (all columns as they are) without those that the classifier scores below one half."""
    name = fresh(docs, "score")
    return with_score(docs, fit(docs, labels, "quality", how), name).where(F.col(name) >= 0.5).drop(name)
