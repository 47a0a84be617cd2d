"""A stored listing that newer listings are merged into; of a key listed twice the last one wins.

Rows live in slots by a hash of their key.  A merge reads and rewrites the slots
that the newer rows fall in and leaves the others alone.  It is made in two
steps: the merged slots are written to a staging folder and marked as complete;
then they replace the stored ones (dynamic partition overwrite), and the staging
folder goes.  A run that dies before the mark has changed nothing; one that dies
after it is finished by the next call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

SLOT = "slot"
_READY = "_READY"


class Listing:
    """The listing under ``path``: ``schema`` holds the key, the values and ``seq``, a listing's place in time.

    A NULL key is a key like any other.  Rows of equal key and ``seq`` are
    ordered by their values, so a merge gives the same rows in any order.
    One writer at a time; readers see each slot before or after a merge.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, seq: str, slots: int = 64):
        self.spark, self.path, self.schema, self.key, self.seq, self.slots = spark, path.rstrip("/"), schema, key, seq, slots
        self._slotted = StructType([*schema.fields, StructField(SLOT, IntegerType())])
        self.values = [f.name for f in schema.fields if f.name not in (key, seq)]
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = jvm.Path
        self._files = jvm.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def rows(self) -> DataFrame:
        """The listing as stored; without a merge yet, no rows."""
        self.recover()
        return self._stored().select(*[f.name for f in self.schema.fields])

    def merge(self, newer: DataFrame) -> None:
        """Merge a newer listing; an older row than the stored one changes nothing."""
        self.recover()
        newer = newer.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        newer = newer.withColumn(SLOT, F.pmod(F.xxhash64(self.key), F.lit(self.slots)).cast("int"))
        touched = [r[SLOT] for r in newer.select(SLOT).distinct().collect()]  # at most as many as there are slots
        if not touched:
            return
        both = self._stored().where(F.col(SLOT).isin(touched)).unionByName(newer)
        order = F.struct(self.seq, *self.values)
        last = both.groupBy(SLOT, self.key).agg(F.max(order).alias("last"))
        merged = last.select(self.key, "last.*", SLOT).repartition(len(touched), SLOT)
        staging = f"{self.path}/staging/{uuid.uuid4().hex}"
        self.stage(merged, staging)
        self.apply(staging)

    def stage(self, merged: DataFrame, staging: str) -> None:
        """Write the merged slots and mark them as complete."""
        merged.write.partitionBy(SLOT).parquet(f"{staging}/slots")
        self._files.create(self._path(f"{staging}/{_READY}")).close()

    def apply(self, staging: str) -> None:
        """Put staged slots in the place of the stored ones; again, if a run died in the middle."""
        staged = self._read(f"{staging}/slots")
        writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SLOT)
        writer.parquet(f"{self.path}/slots")
        self._files.delete(self._path(staging), True)

    def recover(self) -> None:
        """Finish a merge that died after its mark; leave no trace of one that died before."""
        root = self._path(f"{self.path}/staging")
        if not self._files.exists(root):
            return
        for status in self._files.listStatus(root):
            staging = str(status.getPath().toString())
            if self._files.exists(self._path(f"{staging}/{_READY}")):
                self.apply(staging)
            else:
                self._files.delete(self._path(staging), True)

    def _read(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self._slotted).parquet(folder)

    def _stored(self) -> DataFrame:
        if not self._files.exists(self._path(f"{self.path}/slots")):
            return self.spark.createDataFrame([], self._slotted)
        return self._read(f"{self.path}/slots")
