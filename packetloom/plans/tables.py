"""Small derived tables: computing them once and joining them by their true size."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 64 << 20


def unnest(df: DataFrame, keep: list, items, name: str) -> DataFrame:
    """One row per array item. Unlike a plain ``explode`` this lets no size test on the array be derived and
    pushed below the projection that computes it, where it would compute the array a second time."""
    return df.select(*keep, F.explode_outer(items).alias(name)).where(F.col(name).isNotNull())


def where_once(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that fulfil a condition on computed arrays. A plain filter would be pushed below the projections that compute
    them, which then run once more inside it, for each time a column is used."""
    return df.select("*", F.explode_outer(F.when(condition, F.array(F.lit(True)))).alias("_kept")).where(
        F.col("_kept").isNotNull()).drop("_kept")


def settle(df: DataFrame) -> DataFrame:
    """Compute a small table once and keep it in the executors' memory and disks.

    No folder is needed and nothing stays behind in one. A part lost with an executor is computed again, which
    gives the same rows, as nothing here depends on the time of day. Long-running callers ``unpersist`` it.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def table_bytes(df: DataFrame) -> int:
    """Size by the statistics of the plan; exact for a settled table."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Tasks that the rows of one key are dealt to when a join by a hot key is shuffled.
SALTS = 16


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "left", limit: int = BROADCAST_BYTES,
               salt: Column | None = None) -> DataFrame:
    """Join a settled table to a big one: broadcast while its size is within ``limit``, else by shuffle.

    Beyond the limit a hot key's rows are dealt by ``salt`` (a hash over the big side) to ``SALTS`` tasks, to each of which the
    small side is sent; without one, adaptive execution splits hot partitions.
    """
    if table_bytes(small) <= limit:
        return big.join(F.broadcast(small), keys, how)
    if salt is None:
        return big.join(small, keys, how)
    dealt = big.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    each = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(each, [*keys, "_salt"], how).drop("_salt")


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="packetloom-")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new place under the folder that ``spark.checkpoint.dir`` names; on one machine without the setting, one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{folder or _own_folder()}/{name}-{uuid.uuid4().hex}"
