"""A keyed table on plain Parquet that takes upserts from a stream.

Rows are hashed by key into buckets. A batch rewrites only the buckets it has keys for,
into a folder of its own, and then publishes a manifest that names each bucket's current
folder. A bucket that outgrows `SLICE_BYTES` is rewritten in slices, by other bits of the
same hash, each in a task and a file of its own: so a task's share of the work does not
grow with the table, whatever the number of buckets. Before that the batch, stored as it came, is cut into parts
of some `PART_BYTES` that keep one row per key. Until that rename nobody sees the batch. A batch that runs again after a failure
is found published, or overwrites its own unfinished folder; and applying a change twice
leaves the table as it is.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from siltstone import fs
from siltstone.operators.cdc import latest_per_key
from siltstone.operators.unify import empty
from siltstone.streaming.runner import run_batches, stream_id

BUCKET = "_bucket"
PLACE = "_place"
SPLIT = "_split"
#: Stored bytes, old and new, that one task takes on at most when a bucket is rewritten. Fresh rows in
#: a shuffle and in a sort's memory take several times what they take stored.
SLICE_BYTES = 16 << 20
#: Stored bytes of a batch that one task reduces to one row per key.
PART_BYTES = 4 << 20


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    sequence_by: str
    tie: tuple[str, ...] = ()
    buckets: int = 64
    sort_by: tuple[str, ...] = ()  # order within each file of a bucket, so that readers can skip row groups

    def _manifests(self) -> list[str]:
        return sorted(p for p, _ in fs.glob(self.spark, f"{self.path}/manifest/*.json"))

    def _manifest(self) -> dict:
        """The last published state: its number, schema, last batches and folder per bucket."""
        published = self._manifests()
        if not published:
            return {"version": 0, "schema": None, "buckets": self.buckets, "batches": {}, "folders": {}}
        state = json.loads(fs.read_text(self.spark, published[-1]))
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {state['buckets']} buckets, not {self.buckets}")
        return state

    def _read(self, state: dict, buckets: Sequence[str]) -> DataFrame:
        folders = [state["folders"][b] for b in buckets if b in state["folders"]]
        schema = StructType.fromJson(state["schema"])
        if not folders:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def current(self) -> DataFrame:
        """The table as of the last published batch."""
        state = self._manifest()
        if state["schema"] is None:
            raise FileNotFoundError(f"nothing published in {self.path}")
        return self._read(state, list(state["folders"]))

    def version(self) -> int:
        """How many batches have been published."""
        return self._manifest()["version"]

    def size_bytes(self) -> int:
        """Stored bytes of the last published state."""
        return sum(fs.size_bytes(self.spark, f) for f in self._manifest()["folders"].values())

    def _hash(self) -> Column:
        return F.xxhash64(*(F.col(f"`{k}`") for k in self.keys))

    def _bucket_of(self) -> Column:
        return F.pmod(self._hash(), F.lit(self.buckets)).cast("int")

    def _slices(self, staged: str, touched: Sequence[str], held: Sequence[str]) -> int:
        """Into how many tasks the rewrite of one bucket is cut, by what is stored of the fullest."""
        fresh = fs.size_bytes(self.spark, staged) / max(1, len(touched))
        return max(1, math.ceil((fresh + max((fs.size_bytes(self.spark, f) for f in held), default=0)) / SLICE_BYTES))

    def _dealt(self, rows: DataFrame, touched: Sequence[str], slices: int) -> DataFrame:
        """The rows with their PLACE: a partition for each slice of each touched bucket, none for the others."""
        bucket = F.array_position(F.array(*(F.lit(int(b)) for b in touched)), F.col(BUCKET)).cast("int") - 1
        slice_ = F.pmod(F.shiftrightunsigned(self._hash(), 32), F.lit(slices)).cast("int")
        placed = rows.withColumn(PLACE, bucket * F.lit(slices) + slice_)
        return placed.repartitionById(len(touched) * slices, F.col(PLACE))

    def _reduced(self, rows: DataFrame, staged: str) -> DataFrame:
        """The staged rows, those of a key in one split of the input reduced to the latest.

        A hot key is spread by the splits and ends here, as one row for each. The number of tasks
        follows what is stored, so neither a split nor the session's shuffle partitions bound the work of one.
        """
        parts = max(1, math.ceil(fs.size_bytes(self.spark, staged) / PART_BYTES))
        split = rows.withColumn(SPLIT, F.spark_partition_id())
        parted = split.repartition(parts, *(F.col(f"`{k}`") for k in self.keys), F.col(SPLIT))
        return latest_per_key(parted, self.keys, self.sequence_by, self.tie, [SPLIT, BUCKET]).drop(SPLIT)

    def apply(self, changes: DataFrame, batch: int, stream: str = "") -> bool:
        """Upsert one batch of a stream: any number of rows per key, in any order. False if it was applied before."""
        state = self._manifest()
        if batch <= state["batches"].get(stream, -1):
            return False
        version = state["version"] + 1
        staged = f"{self.path}/staged/{version:012d}"
        target = f"{self.path}/data/{version:012d}"
        # The rows are stored as they come, so the stream's own plan runs once, and they tell their size.
        arrived = changes.withColumn(BUCKET, self._bucket_of())
        arrived.write.mode("overwrite").parquet(staged)
        rows = self.spark.read.schema(arrived.schema).parquet(staged)
        touched = sorted(str(r[BUCKET]) for r in rows.select(BUCKET).distinct().collect())
        if state["schema"] is not None and not touched:
            fs.delete(self.spark, staged)
            return True
        holding = [state["folders"][b] for b in touched if b in state["folders"]]
        slices = self._slices(staged, touched, holding)
        if touched:
            rows = self._reduced(rows, staged)
            if holding:
                held = self._read(state, touched).withColumn(BUCKET, self._bucket_of())
                rows = rows.unionByName(held, allowMissingColumns=True)
            rows = latest_per_key(self._dealt(rows, touched, slices), self.keys, self.sequence_by, self.tie, [BUCKET, PLACE])
        if self.sort_by:
            rows = rows.sortWithinPartitions(BUCKET, *(F.col(f"`{c}`") for c in self.sort_by))
        rows = rows.drop(PLACE)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        written = [p for p, is_folder in fs.glob(self.spark, f"{target}/{BUCKET}=*") if is_folder]
        manifest = {
            "version": version,
            "schema": rows.drop(BUCKET).schema.jsonValue(),
            "buckets": self.buckets,
            "batches": {**state["batches"], stream: batch},
            "folders": {**state["folders"], **{p.rsplit("=", 1)[1]: p for p in written}},
        }
        fs.write_text(self.spark, f"{self.path}/manifest/{version:012d}.json", json.dumps(manifest))
        fs.delete(self.spark, staged)
        return True

    def expire(self, retain_hours: float = 168) -> int:
        """Delete superseded states published more than `retain_hours` ago; returns how many.

        Bucket folders that no remaining state names go with them.
        """
        limit = (time.time() - retain_hours * 3600) * 1000
        published = self._manifests()
        old = [m for m in published[:-1] if fs.modified_ms(self.spark, m) < limit]
        kept = [m for m in published if m not in old]

        def folders(manifests: list[str]) -> set[str]:
            states = (json.loads(fs.read_text(self.spark, m)) for m in manifests)
            return {f for state in states for f in state["folders"].values()}

        unused = folders(old) - folders(kept)
        for path in [*old, *unused]:
            fs.delete(self.spark, path)
        return len(old)


def scd1_stream(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    sequence_by: str,
    checkpoint: str,
    columns: Sequence[str] | None = None,
    tie: Sequence[str] = (),
    buckets: int = 64,
    sort_by: Sequence[str] = (),
    wait: bool = True,
) -> tuple[KeyedTable, StreamingQuery]:
    """Upsert everything new on the stream into the keyed table at `path`."""
    spark = stream.sparkSession
    if columns is not None:
        wanted = dict.fromkeys([*columns, *keys, sequence_by, *tie])
        stream = stream.select(*(F.col(f"`{c}`") for c in wanted))
    table = KeyedTable(spark, path, tuple(keys), sequence_by, tuple(tie), buckets, tuple(sort_by))

    def apply(changes: DataFrame, batch: int) -> None:
        table.apply(changes, batch, stream_id(spark, checkpoint))

    return table, run_batches(stream, apply, checkpoint, wait=wait)
