"""Business keys of a versioned target, kept beside it in a bucketed table.

The delta asks of every source row whether its key is in the target.  The index holds nothing but
those keys, bucketed on them, so the anti join reads neither the target's wide rows nor shuffles the
target side: only the source is dealt out, to the index's buckets.

The keys of a row are kept as one text that tells NULL from every value and where each key ends, so
``<=>`` on all of them is plain equality on one column, which a bucketed table serves.  Index rows name
the data folder they were written for and count only while the target's log lists that folder, so the
index needs no commit of its own: rows of a batch that failed half-way, or from before a rebuild, are
never seen.

All batches of the target must go through the index.  A replacement of partitions must keep their keys, as a
correction does (its folder has no index rows, and those of the replaced rows still count).  Its folder is ``keys-<buckets>`` in the target's.
Buckets are fixed when the target is made; take about the key bytes at full size over 200 MB, and at
least the session's shuffle partitions (with fewer, the planner may shuffle both sides instead).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.sources.versions import VersionedTable


def _text(value: Column, kind: T.DataType) -> Column:
    """The value as text, different for different values of its type."""
    if isinstance(kind, (T.StringType, T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampNTZType)):
        return value.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    raise ValueError(f"keys of type {kind.simpleString()} cannot be indexed")


class KeyIndex:
    def __init__(self, spark: SparkSession, target: VersionedTable, keys: dict[str, str], buckets: int, plain_keys=()):
        """``keys``: key columns with their types; ``plain_keys``: those compared with ``=`` (NULL never matches)."""
        self.spark, self.target, self.plain = spark, target, set(plain_keys)
        self.keys = {k: T.StructType.fromDDL(f"`{k}` {t}")[0].dataType for k, t in keys.items()}
        path = f"{target.path}/keys-{buckets}"
        self.buckets, self.name = buckets, "keys_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (k string, folder string) USING parquet PARTITIONED BY (folder) "
                  f"CLUSTERED BY (k) INTO {buckets} BUCKETS LOCATION '{where}'")
        if live := self._live():  # those written by other sessions
            parts = " ".join(f"PARTITION (folder = '{f}')" for f in live)
            spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {parts}")

    def _live(self) -> list[str]:
        return [f.rsplit("/", 1)[-1] for f in self.target.folders()]

    def _key(self, df: DataFrame) -> Column:
        parts = []
        for k, kind in self.keys.items():
            text = _text(df[k].cast(kind), kind)
            parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
        return F.concat(*parts)

    def append(self, df: DataFrame, batch: str, partition_by=()) -> int:
        """Add a batch to the target and its keys to the index; a batch committed before adds nothing."""
        return self._commit(df, batch, "append", partition_by)

    def rebuild(self, df: DataFrame, batch: str, partition_by=()) -> int:
        """Replace the target's rows; the keys of the earlier ones count no more."""
        return self._commit(df, batch, "rebuild", partition_by)

    def _commit(self, df: DataFrame, batch: str, kind: str, partition_by) -> int:
        done = self.target.version_of(batch)
        if done is not None:
            return done
        folder = self.target.stage(df, partition_by)
        staged = self.target.staged(folder, df.schema)
        keys = staged.select(self._key(staged).alias("k")).dropDuplicates().repartition(self.buckets, "k")
        keys.withColumn("folder", F.lit(folder.rsplit("/", 1)[-1])).write.insertInto(self.name)
        return self.target.publish(folder, batch, kind, df.schema, {"columns": list(partition_by)} if partition_by else None)

    def known(self) -> DataFrame:
        """The encoded keys of the target's newest version; a key that several batches hold is there as often."""
        live = self._live()
        return self.spark.table(self.name).where(F.col("folder").isin(live) if live else F.lit(False)).select("k")

    def new_records(self, source: DataFrame) -> DataFrame:
        """Rows of ``source`` whose key the target does not hold; repeated rows stay.

        The result is that of ``operators.delta.new_records`` against the target.
        """
        known = self.known()
        same = self._key(source) == known["k"]
        for k in self.plain:
            same = same & source[k].isNotNull()
        return source.join(known, same, "left_anti")
