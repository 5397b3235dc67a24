"""NetFlow v9 / IPFIX streams: the table code run per micro-batch, with template and rate history as tables.

A stream remembers what exporters announced: everything of the last ``HORIZON_MICROS`` of receive time, and the changes
before that. So a packet that arrives late, by up to the horizon, still finds and leaves the history a table would have;
a later one is resolved by the changes kept, and what it announces between two equal announcements may be lost. The history
is a small parquet snapshot under a state folder, written anew only by a micro-batch that announces something, in a folder
named by the batch: a batch that is run again after a failure starts from the snapshot before it and replaces its
own. The last two snapshots are kept. Packets are not grouped by exporter: a busy exporter's packets are spread like all
others and look their templates up in the same timeline as on a table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from packetloom.operators.netflow_flows import PACKET_COLUMNS, explode_records, project_flows
from packetloom.operators.netflow_sets import FIELD_TYPE, frame
from packetloom.operators.layout import with_layout
from packetloom.operators.netflow_state import (ORDER, RATE_VALUE, TEMPLATE_VALUE, attach_sampling, changes, compacted, learnt,
                                                rates_of, resolve_sets, templates_of, told_rates,
                                                unlearnt_announcements)
from packetloom.sources.packets import NETFLOW, of_channel

TEMPLATE_HISTORY = (f"router string, version int, domain bigint, t bigint, packet_id bigint, set_idx int, rec_idx int, "
                    f"template_id int, kind string, field_count int, scopes array<{FIELD_TYPE}>, fields array<{FIELD_TYPE}>")
RATE_HISTORY = "router string, version int, domain bigint, t bigint, packet_id bigint, rate bigint"
HORIZON_MICROS = 3_600_000_000


def read_history(spark: SparkSession, path: str, schema: str, before_batch: int | None = None) -> DataFrame:
    """History rows of the batches before one; empty where nothing has been written yet."""
    fields = T.StructType.fromDDL(schema)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], fields)
    rows = spark.read.schema(T.StructType([*fields, T.StructField("batch", T.LongType())])).parquet(path)
    if before_batch is not None:
        rows = rows.where(F.col("batch") < before_batch)
    return rows.drop("batch")


class Snapshots:
    """Versions of a small table, one folder each; a reader takes the latest one before its own batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema
        self.folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.files = self.folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions that were written to the end."""
        if not self.files.exists(self.folder):
            return []
        found = [f.getPath() for f in self.files.listStatus(self.folder)]
        done = [p.getName() for p in found if self.files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n.removeprefix("version=")) for n in done if n.startswith("version="))

    def before(self, batch_id: int) -> DataFrame:
        earlier = [v for v in self.versions() if v < batch_id]
        if not earlier:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={earlier[-1]}")

    def write(self, rows: DataFrame, batch_id: int) -> DataFrame:
        own = f"{self.path}/version={batch_id}"
        rows.coalesce(8).write.mode("overwrite").parquet(own)
        for old in [v for v in self.versions() if v < batch_id][:-1]:
            self.files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/version={old}"), True)
        return self.spark.read.schema(self.schema).parquet(own)


def netflow_batch(state_path: str, publish: Callable[[DataFrame, int], None],
                  reject: Callable[[DataFrame, int], None] | None = None,
                  horizon_micros: int = HORIZON_MICROS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: packets in, flows to ``publish``, rejected packets to ``reject``.

    Both get the batch id, to write idempotently. Packets are ordered by receive time and number.
    """
    def remembered(store: Snapshots, known: DataFrame, told: DataFrame, value, order, batch_id: int) -> DataFrame:
        if told.isEmpty():
            return known
        return store.write(compacted(known.unionByName(told.select(*known.columns)), *value, order, horizon_micros), batch_id)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        templates = Snapshots(spark, f"{state_path}/templates", TEMPLATE_HISTORY)
        rates = Snapshots(spark, f"{state_path}/rates", RATE_HISTORY)
        framed = frame(of_channel(batch, NETFLOW)).persist(StorageLevel.MEMORY_AND_DISK)
        small = []
        try:
            known = templates.before(batch_id)
            told = learnt(framed, unlearnt_announcements(framed, known))
            history = remembered(templates, known, told, TEMPLATE_VALUE, ORDER, batch_id)
            small.append(templates_of(with_layout(changes(history, *TEMPLATE_VALUE, ORDER))))
            resolved = resolve_sets(framed, small[-1])
            order = ["t", "packet_id"]
            rate_history = remembered(rates, rates.before(batch_id), told_rates(resolved), RATE_VALUE, order, batch_id)
            small.append(rates_of(changes(rate_history, *RATE_VALUE, order)))
            rated = attach_sampling(resolved, small[-1])
            publish(project_flows(explode_records(rated, "data", [*PACKET_COLUMNS, "sampling_rate"])), batch_id)
            if reject is not None:
                reject(resolved.where(F.col("error").isNotNull()).select(
                    "packet_id", "channel", "router", "error", "recv_time", "payload"), batch_id)
        finally:
            for kept in (framed, *small):
                kept.unpersist()

    return run


def to_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """Publish function writing a batch to its own partition, so that a repeated batch replaces itself."""
    return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def start_netflow(packets: DataFrame, state_path: str, checkpoint: str, publish, reject=None, **trigger):
    """Start the stream; ``trigger`` as for ``DataStreamWriter.trigger``."""
    writer = packets.writeStream.foreachBatch(netflow_batch(state_path, publish, reject)).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
