"""Run a load spec continuously with Structured Streaming.

New extract files landing in the form's folder are the micro-batches; each
batch runs the spec (latest rule, parents, rules, lookups, delta against the
*current* target, digests) in ``foreachBatch`` and appends the new rows.

Limits.  The latest rule sees the rows of one micro-batch, so a batch load over
all files can pick another row where versions of a key arrive in different
batches.  The append of a batch is committed by Spark's file committer, which
moves the files of a finished job one by one: if the driver dies while it moves
them, the retry takes the keys already moved for loaded, and their other rows
in the batch are not appended.  With ``versions=True`` the target is a table with
versions: a batch is committed whole under its number, and its retry adds nothing.  The stream's
checkpoint lives in the shared checkpoint folder, never on a machine-local path.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardflow.plans.run import FrameIO, build_load, read_if_present
from wardflow.plans.spec import LoadSpec
from wardflow.session import scratch_path
from wardflow.sources.versions import VersionedTable


def stream_load(spark: SparkSession, spec: LoadSpec, source_path: str, target_path: str,
                as_of: dt.date, static_tables: dict[str, DataFrame] | None = None,
                checkpoint: str | None = None, available_now: bool = True,
                max_files_per_trigger: int | None = None,
                target_reader: Callable[[], DataFrame | None] | None = None,
                partition_by: tuple = (), versions: bool = False):
    """Start the stream; with ``available_now`` it processes what is there and stops.

    ``partition_by`` lays the target out by delta-key columns (e.g. SiteCode);
    each micro-batch then reads only the target partitions of the values it
    carries (dynamic partition pruning through a semi join), not the whole
    target.
    """
    schema = spark.read.parquet(source_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_path)

    table = VersionedTable(spark, target_path)

    def read_target():
        if target_reader is not None:
            return target_reader()
        return table.read() if versions else read_if_present(spark, target_path)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        tables = dict(static_tables or {})
        tables[spec.source] = batch
        tgt = read_target()
        io = FrameIO(tables, {spec.target: tgt} if tgt is not None else {})
        # a micro-batch is small next to the target: split NULL keys off so the
        # plain-key anti join can use the target's layout
        out = build_load(spec, io, as_of, split_nulls=True, prune_on=partition_by)
        if versions:
            table.append(out, f"{spec.name}-{epoch_id}", partition_by)
            return
        w = out.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target_path)

    ckpt = checkpoint or scratch_path(spark, f"stream-{spec.name}")
    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
