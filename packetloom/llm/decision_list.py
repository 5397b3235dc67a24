"""Quality rules learned as a decision list over text statistics.

Sequential covering: a rule is a conjunction of thresholds that grows by the condition with the best information gain on
two thirds of the examples, loses its last conditions again while that helps on the other third, and is kept while it
is right there often enough; the examples it covers go, and the next rule is sought. The list comes out as one
ordered Spark ``CASE`` expression and as text. Statistics are computed over whole texts of all documents; rules are learned
from a bounded sample of labelled rows (``Learning.sample``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from packetloom.llm.byte_convnet import held_out
from packetloom.llm.words import SPACE, Texts, mix, slices, window_hashes

SYMBOLS = b"#*$%&|<>"
REPEAT_WIDTH = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_marks", "n_same_words"]
SHARES = {"symbols_a_thousand": ("n_symbols", "word_chars"), "capitals_a_thousand": ("n_capitals", "word_chars"),
          "marks_a_thousand": ("n_marks", "word_chars"), "repeats_a_thousand": ("n_repeat_words", "n_words"),
          "same_a_thousand": ("n_same_words", "n_words"), "chars_a_thousand": ("word_chars", "n_words")}
FEATURES = ["n_words", "n_dup_lines", *SHARES]

Condition = tuple[str, str, int]  # statistic, "<=" or ">=", threshold


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _CAPITAL, _MARK = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(b"!?")
_CHAR = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between bounds."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _again(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: whether the same item is in its text more than once, and whether it is the first such one."""
    key = mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, bool)
    size = np.diff(np.append(np.flatnonzero(new), len(key)))
    many, first = np.zeros(len(key), bool), np.zeros(len(key), bool)
    many[order] = np.repeat(size > 1, size)
    first[order] = new
    return many, first


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of every text."""
    data, bounds = texts.data, texts.bounds
    owner, hashes = texts.words_of(), texts.word_hashes()
    at = texts.windows(REPEAT_WIDTH)
    many, _ = _again(window_hashes(hashes, at, REPEAT_WIDTH), owner[at])
    step = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(step, at[many], 1)
    np.add.at(step, at[many] + REPEAT_WIDTH, -1)
    same = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    # lines: cut at every \n and at the ends of texts
    breaks = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    of = np.searchsorted(bounds, breaks, "right") - 1
    end = np.sort(np.concatenate([bounds[1:], breaks]), kind="stable")
    line_of = np.sort(np.concatenate([np.arange(len(texts)), of]), kind="stable")
    with_word = np.searchsorted(texts.start, end) > np.searchsorted(texts.start, start)
    start, end, line_of = start[with_word], end[with_word], line_of[with_word]
    _, first = _again(texts.span_hashes(start, end), line_of)
    return {"n_words": np.diff(texts.first), "word_chars": _sums(_CHAR[data], bounds),
            "n_symbols": _sums(_SYMBOL[data], bounds), "n_dup_lines": np.bincount(line_of[~first], minlength=len(texts)),
            "n_repeat_words": _sums(np.cumsum(step)[:-1] > 0, texts.first),
            "n_capitals": _sums(_CAPITAL[data], bounds), "n_marks": _sums(_MARK[data], bounds),
            "n_same_words": _sums(same, texts.first)}


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, the COUNTS and SHARES, base_failed) for every row of ``docs`` (doc_id, text; others are not read).

    Null and empty texts count 0 everywhere and fail the base rules (fewer than 20 words, or over 30 % of the words in
    repeated windows). Shares are whole thousandths, 0 where there is nothing to divide by.
    """
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            parts = [statistics(t) for _, t in slices(frame.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [frame.column("doc_id"), *[pa.array(np.concatenate([np.zeros(0, np.int64), *[p[c] for p in parts]]),
                                                    pa.int64()) for c in COUNTS]], ["doc_id", *COUNTS])

    counted = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))
    shares = {k: F.expr(f"IF({b} > 0, 1000 * {a} DIV {b}, 0)") for k, (a, b) in SHARES.items()}
    return counted.withColumns({**shares, "base_failed": F.expr(
        "n_words < 20 OR 100 * n_repeat_words > 30 * n_words")})


@dataclass(frozen=True)
class Learning:
    """``sample``: labelled rows at most. ``precision``: share of covered prune examples that must be of the class."""
    sample: int = 20_000
    cuts: int = 48
    most_conditions: int = 4
    most_rules: int = 24
    least_covered: int = 3
    precision: float = 0.9
    seed: int = 3


def _covers(rule: list[Condition], x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for name, sign, value in rule:
        out &= x[name] <= value if sign == "<=" else x[name] >= value
    return out


def _grown(x: dict[str, np.ndarray], bad: np.ndarray, how: Learning) -> list[Condition]:
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < how.most_conditions and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, choice = 1e-9, None
        for name in FEATURES:
            values = x[name][inside]
            of_class = bad[inside]
            # thresholds at quantiles of the covered examples of the class
            for cut in np.unique(np.quantile(values[of_class], np.linspace(0, 1, how.cuts), method="nearest")):
                for sign, hit in (("<=", values <= cut), (">=", values >= cut)):
                    p = (hit & of_class).sum()
                    n = hit.sum() - p
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0
                    if gain > best:
                        best, choice = gain, (name, sign, int(cut))
        if choice is None:
            break
        rule.append(choice)
        inside &= _covers([choice], x)
    return rule


def _pruned(rule: list[Condition], x: dict[str, np.ndarray], bad: np.ndarray) -> list[Condition]:
    def worth(r):
        hit = _covers(r, x)
        p = (hit & bad).sum()
        return (2 * p - hit.sum()) / max(hit.sum(), 1)

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=[])


def learn(x: dict[str, np.ndarray], bad: np.ndarray, how: Learning = Learning()) -> list[list[Condition]]:
    """Rules for the examples marked ``bad``, in order. Without examples of both kinds there is none."""
    rng = np.random.default_rng(how.seed)
    grow = rng.random(len(bad)) < 2 / 3
    rules: list[list[Condition]] = []
    left = np.ones(len(bad), bool)
    while len(rules) < how.most_rules and (left & grow & bad).any() and (left & ~bad).any():
        a, b = left & grow, left & ~grow
        rule = _grown({k: v[a] for k, v in x.items()}, bad[a], how)
        held = {k: v[b] for k, v in x.items()}
        rule = _pruned(rule, held, bad[b])
        hit = _covers(rule, held)
        if not rule or (hit & bad[b]).sum() < how.least_covered or (hit & bad[b]).sum() < how.precision * hit.sum():
            break
        rules.append(rule)
        left &= ~_covers(rule, x)
    return rules


def as_text(rules: list[list[Condition]]) -> list[str]:
    return [" AND ".join(f"{n} {s} {v}" for n, s, v in rule) for rule in rules]


def verdict(rules: list[list[Condition]]) -> Column:
    """True for documents that no rule turns away: CASE WHEN rule THEN false ... ELSE true END."""
    out = None
    for text in as_text(rules):
        out = F.when(F.expr(text), False) if out is None else out.when(F.expr(text), False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", how: Learning = Learning()) -> list[list[Condition]]:
    """Rules that turn away label 0, from rows outside the held-out fold that pass the base rules.

    Null ids and labels are no examples; a document with two labels counts once with each.
    """
    known = labels.where(~held_out("doc_id")).select("doc_id", F.col(target).cast("int").alias("label")).where(
        "doc_id is not null and label is not null")
    picked = known.orderBy(F.xxhash64("doc_id", "label"), "doc_id", "label").limit(how.sample)
    counted = with_statistics(docs.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_semi"))
    rows = counted.where(~F.col("base_failed")).join(F.broadcast(picked), "doc_id").select(
        "doc_id", "label", *FEATURES).toPandas().sort_values(["doc_id", "label", *FEATURES])
    return learn({c: rows[c].to_numpy() for c in FEATURES}, (rows.label == 0).to_numpy(), how)


def judged(docs: DataFrame, labels: DataFrame, how: Learning = Learning()) -> DataFrame:
    """``with_statistics`` and ``kept``: false where the base rules fail, else the learned list's verdict."""
    return with_statistics(docs).withColumn("kept", ~F.col("base_failed") & verdict(fit(docs, labels, "quality", how)))
