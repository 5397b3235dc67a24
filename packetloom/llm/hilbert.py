"""Sharding along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``2**bits`` steps of about equal row counts, a row's cell gets its index on the Hilbert
curve, and the rows in curve order are cut into runs. Rows of a run are close in every dimension, so the
minimum and maximum of a file prune on each of them. Built-in functions only, and no task ever sees the whole order: rows
are counted by (cell, sub-cell), the counts are summed up along the curve (there are at most 2**(dimensions * bits)
cells), and a row's place is the sum before its sub-cell plus its number inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SHARDS, BITS = 16, 4
#: Sub-cells of a cell: a cell that holds a third of all rows is numbered by this many tasks.
SUB_CELLS = 1024
STEP_ACCURACY = 10_000


def _gray_tables(n: int) -> tuple[list[int], list[int], list[int]]:
    """For n dimensions: rank of a Gray code, entry corner and direction of each sub-cube (Hamilton's formulas)."""
    size = 1 << n

    def gray(i):
        return i ^ (i >> 1)

    def ones_at_end(i):
        return (~i & (i + 1)).bit_length() - 1

    rank = [0] * size
    for i in range(size):
        rank[gray(i)] = i
    entry = [0 if w == 0 else gray(2 * ((w - 1) // 2)) for w in range(size)]
    turn = [0 if w == 0 else (ones_at_end(w - 1) if w % 2 == 0 else ones_at_end(w)) % n for w in range(size)]
    return rank, entry, turn


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of the cell with these coordinates (0 to 2**bits - 1), as BIGINT."""
    n = len(axes)
    ring = (1 << n) - 1
    rank, entry, turn = (F.array(*[F.lit(v) for v in t]) for t in _gray_tables(n))

    def rotated_left(x, by):
        return (F.call_function("shiftleft", x, by).bitwiseOR(F.call_function("shiftright", x, F.lit(n) - by))).bitwiseAND(ring)

    def rotated_right(x, by):
        return rotated_left(x, F.lit(n) - by)

    def step(state, level):
        corner = F.lit(0)
        for k, axis in enumerate(axes):
            bit = F.call_function("shiftright", axis.cast("int"), level).bitwiseAND(1)
            corner = corner.bitwiseOR(F.shiftleft(bit, k))
        seen = rotated_right(corner.bitwiseXOR(state["e"]), state["d"] + 1)
        w = F.get(rank, seen)
        return F.struct(
            (state["h"] * (1 << n) + w).cast("bigint").alias("h"),
            state["e"].bitwiseXOR(rotated_left(F.get(entry, w), state["d"] + 1)).cast("int").alias("e"),
            ((state["d"] + F.get(turn, w) + 1) % n).cast("int").alias("d"))

    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda s: s["h"])


def as_number(df: DataFrame, column: str) -> Column:
    """A dimension as a number in its own order: text by its first seven bytes; nulls are the smallest."""
    if dict(df.dtypes)[column] == "string":
        head = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 7)), 14, "0")
        return F.coalesce(F.conv(head, 16, 10).cast("double"), F.lit(-1.0))
    value = F.col(column).cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(float("-inf")))


def with_curve(df: DataFrame, dimensions: list[str], bits: int = BITS, name: str = "curve") -> DataFrame:
    """Add a row's Hilbert index over ``dimensions``, quantised at approximate quantiles of the whole table."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    row = df.agg(*[F.percentile_approx(as_number(df, c), steps, STEP_ACCURACY).alias(str(i))
                   for i, c in enumerate(dimensions)]).first()
    axes = []
    for i, c in enumerate(dimensions):
        # distinct steps only, so that no step is empty by construction
        marks = F.array(*[F.lit(m) for m in sorted(set(row[i] or [0.0]))])
        axes.append(_let(as_number(df, c), _marks_below(marks)))
    place = _let(F.array(*axes), lambda x: hilbert_index([F.get(x, F.lit(i)) for i in range(len(dimensions))], bits))
    return df.withColumn(name, F.coalesce(place, F.lit(0).cast("bigint")))


def _marks_below(marks: Column):
    return lambda v: F.size(F.filter(marks, lambda m: m < v))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hilbert_shards(docs: DataFrame, dimensions: list[str], shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, shard and slot for every row of ``docs`` (doc_id, text and the dimensions).

    Rows in curve order are cut into ``shards`` runs of equal counts, at most one apart. ``slot`` numbers the rows of a
    shard without a gap. Inside a cell rows are ordered by a hash, then doc_id, size and checksum; repeated rows
    get slots of their own. A null dimension is smaller than any value; a null text has size 1 and checksum 0.
    """
    placed = with_curve(docs.select("doc_id", "text", *[F.col(c).alias(f"dim{i}") for i, c in enumerate(dimensions)]),
                        [f"dim{i}" for i in range(len(dimensions))], bits)
    placed = placed.withColumn("sub", F.pmod(F.xxhash64("doc_id"), F.lit(SUB_CELLS)).cast("int"))
    counts = placed.groupBy("curve", "sub").agg(F.count("*").alias("n"))
    inside = W.partitionBy("curve").orderBy("sub").rowsBetween(W.unboundedPreceding, -1)
    along = W.partitionBy(F.lit(0)).orderBy("curve").rowsBetween(W.unboundedPreceding, -1)
    cells = counts.groupBy("curve").agg(F.sum("n").alias("n"))
    cells = cells.select("curve", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("cell_start"))
    before = counts.withColumn("start", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(cells, "curve").select(
        "curve", "sub", (F.col("cell_start") + F.col("start")).alias("start"))
    rows = placed.select("doc_id", "curve", "sub", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast(
        "bigint").alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    order = W.partitionBy("curve", "sub").orderBy("doc_id", "size", "text_crc32")
    ranked = rows.withColumn("k", F.row_number().over(order) - 1).join(before, ["curve", "sub"]).withColumn(
        "rank", F.col("start") + F.col("k"))
    total = docs.count()
    # run s holds the ranks from ceil(s * total / shards) on
    return ranked.withColumn("shard", F.expr(f"(rank * {shards}L) div {max(total, 1)}L").cast("int")).select(
        "doc_id", "size", "text_crc32", "curve", "shard",
        F.expr(f"rank - (shard * {total}L + {shards - 1}L) div {shards}L").alias("slot"))
