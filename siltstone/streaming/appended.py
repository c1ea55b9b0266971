"""A table that batches are appended to, each exactly once, in a schema that may grow and widen.

    {path}/schema.json                          the schemas it has had, the last one counts
    {path}/rows/{schema number}/{source}/{stream}-{batch}/

A batch has a folder of its own, named by its stream and number. Spark marks a finished write with
`_SUCCESS`; a batch that runs again finds the mark and writes nothing, or replaces what it had begun.
Files are read with the schema they were written in, known by their folder, and cast to the last
one, so an older bigint stands beside a newer double, and no footer is opened to find a schema.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from siltstone import fs
from siltstone.operators.unify import empty
from siltstone.sources.arrivals import new_files
from siltstone.sources.widening import as_type, conformed, widen_schemas
from siltstone.streaming.runner import run_batches, stream_id


@dataclass(frozen=True)
class AppendTable:
    spark: SparkSession
    path: str

    def _schemas(self) -> list[StructType]:
        store = f"{self.path}/schema.json"
        if not fs.exists(self.spark, store):
            return []
        return [StructType.fromJson(s) for s in json.loads(fs.read_text(self.spark, store))["schemas"]]

    def exists(self) -> bool:
        return fs.exists(self.spark, f"{self.path}/schema.json")

    def schema(self) -> StructType | None:
        held = self._schemas()
        return held[-1] if held else None

    def _grown(self, found: StructType) -> tuple[int, StructType]:
        """The number and the schema that holds the table's and the found one, stored if it is new."""
        held = self._schemas()
        wide = widen_schemas(held[-1] if held else None, found)
        if not held or wide != held[-1]:
            held.append(wide)
            text = json.dumps({"schemas": [s.jsonValue() for s in held]})
            fs.write_text(self.spark, f"{self.path}/schema.json", text, overwrite=True)
        return len(held) - 1, wide

    def _done(self, name: str, source: str) -> bool:
        """Whether the batch has been written, in whichever schema."""
        return bool(fs.glob(self.spark, f"{self.path}/rows/*/{_folder(source)}/{name}/_SUCCESS"))

    def append(
        self, rows: DataFrame, source: str, stream: str, batch: int,
        arrange: Callable[[DataFrame], DataFrame] | None = None,
    ) -> bool:
        """Write a batch; False if it had been written before."""
        name = f"{stream}-{batch:012d}"
        if self._done(name, source):
            return False
        number, wide = self._grown(rows.schema)
        have = {f.name: f.dataType for f in rows.schema.fields}
        aligned = rows.select(*(
            as_type(f.name, have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in wide.fields
        ))
        aligned = arrange(aligned) if arrange else aligned
        aligned.write.mode("overwrite").parquet(f"{self.path}/rows/{number:06d}/{_folder(source)}/{name}")
        return True

    def version(self) -> int:
        """How many batches have been appended."""
        return len(fs.glob(self.spark, f"{self.path}/rows/*/*/*/_SUCCESS"))

    def size_bytes(self) -> int:
        """Stored bytes of all batches."""
        return fs.size_bytes(self.spark, f"{self.path}/rows") if fs.exists(self.spark, f"{self.path}/rows") else 0

    def _read(self, held: list[StructType], number: int, paths: Sequence[str]) -> DataFrame:
        """Files of one schema as the last one."""
        wide, own = held[-1], {f.name: f.dataType for f in held[number].fields}
        asked = StructType([
            StructField(f.name, conformed(own[f.name], f.dataType) if f.name in own else f.dataType) for f in wide.fields
        ])
        rows = self.spark.read.schema(asked).option("recursiveFileLookup", "true").parquet(*paths)
        return rows.select(*(as_type(f.name, asked[f.name].dataType, f.dataType) for f in wide.fields))

    def _united(self, parts: dict[int, list[str]]) -> DataFrame:
        """Schemas that only lack columns of the last one share its scan."""
        held = self._schemas()
        last, grouped = len(held) - 1, {}
        for number, paths in parts.items():
            only_fewer = all(held[last][f.name].dataType == f.dataType for f in held[number].fields)
            grouped.setdefault(last if only_fewer else number, []).extend(paths)
        if not grouped:
            return empty(self.spark, held[last])
        return reduce(DataFrame.unionByName, (self._read(held, n, p) for n, p in sorted(grouped.items())))

    def read(self, source: str | None = None) -> DataFrame:
        """All rows, or those of one source."""
        if not self.exists():
            raise FileNotFoundError(f"nothing has been appended to {self.path}")
        inside = "" if source is None else f"/{_folder(source)}"
        folders = {n: f"{self.path}/rows/{n:06d}{inside}" for n in range(len(self._schemas()))}
        return self._united({n: [f] for n, f in folders.items() if fs.exists(self.spark, f)})

    def read_files(self, paths: Sequence[str]) -> DataFrame:
        """The rows of some of its files."""
        parts: dict[int, list[str]] = {}
        for p in paths:
            parts.setdefault(int(p.rsplit("/rows/", 1)[1].split("/", 1)[0]), []).append(p)
        return self._united(parts)

    def follow(
        self, apply: Callable[[DataFrame, str, int], None], checkpoint: str, batch_bytes: int | None = None
    ) -> StreamingQuery:
        """Hand what is new to `apply(rows, stream, batch)`, as a batch of the schema it has by then.

        New sources, columns and types need neither a new stream nor a new checkpoint.
        """

        def take(files: DataFrame, batch: int) -> None:
            paths = [r["path"] for r in files.select("path").collect() if r["path"].endswith(".parquet")]
            apply(self.read_files(paths), stream_id(self.spark, checkpoint), batch)

        return run_batches(new_files(self.spark, f"{self.path}/rows", batch_bytes), take, checkpoint)

    def as_stream(self, batch_bytes: int | None = None) -> DataFrame:
        """The table as a stream of one schema, for plans that go beyond a batch, such as windows."""
        held = self._schemas()
        if any(held[-1][f.name].dataType != f.dataType for s in held for f in s.fields):
            raise ValueError(f"{self.path} has had columns of other types; follow it batch by batch")
        limit = {"maxBytesPerTrigger": batch_bytes} if batch_bytes else {}
        reader = self.spark.readStream.schema(held[-1]).options(recursiveFileLookup="true", maxFileAge="36500d", **limit)
        return reader.parquet(f"{self.path}/rows")


def _folder(source: str) -> str:
    """A source's id as the name of a folder, without characters that paths or patterns give a meaning."""
    return "s-" + quote(source, safe="").replace("%", "~").replace("*", "~2A")
