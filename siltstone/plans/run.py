"""Run a flow layer by layer. Each run takes in what is new and recomputes the views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone import fs, versions
from siltstone.operators.layout import files_to_sort, replace_table
from siltstone.operators.ledger import RuleLedger
from siltstone.operators.unify import SOURCE, empty
from siltstone.plans.bronze import FILE_RULE, ingest
from siltstone.plans.colocate import bucketed, bucketed_name, refresh_bucketed
from siltstone.plans.gold import build_view
from siltstone.plans.publish import publish
from siltstone.plans.silver import follow_silver, keyed_table, read_silver
from siltstone.sources.widening import as_type, wider
from siltstone.specs import FlowSpec, GoldSpec, SourceSpec
from siltstone.streaming.appended import AppendTable
from siltstone.streaming.keyed import KeyedTable


def _moved(rows: DataFrame, mine: Column, old: str, new: str) -> DataFrame:
    """The column under its new name where `mine` holds, and under the old one elsewhere."""
    value, kind = F.col(f"`{old}`"), rows.schema[old].dataType
    if new not in rows.columns:
        return rows.withColumns({new: F.when(mine, value), old: F.when(~mine, value)})
    held = rows.schema[new].dataType
    both = wider(held, kind)
    moved = F.when(mine, as_type(old, kind, both)).otherwise(as_type(new, held, both))
    return rows.withColumns({new: moved, old: F.when(~mine, value)})


class FlowRun:
    """One flow in one root folder, its tables at `{root}/{layer}_{flow}/{table}`.

    `sources` lists where the feeds come from; by default each feed is one folder of that
    name under `landing`. A feed may have any number of sources. Each has a checkpoint of its
    own and a folder in the feed's raw table, so sources can come and go between runs while one
    stream per typed table follows them all. `batch_bytes` caps the input of one batch; a run
    still takes in everything new, in as many batches as it needs.
    """

    def __init__(
        self,
        spark: SparkSession,
        flow: FlowSpec,
        root: str,
        landing: str | None = None,
        sources: Sequence[SourceSpec] | None = None,
        batch_bytes: int | None = None,
    ):
        self.spark, self.flow, self.root = spark, flow, root.rstrip("/")
        self.batch_bytes = batch_bytes
        self.ledger = RuleLedger(spark, f"{self.root}/state_{flow.name}/rules", datetime.now(timezone.utc))
        self.sources = list(sources) if sources is not None else [
            SourceSpec(
                source_id=feed, entity=feed, format=flow.format, base_path=f"{landing}/{feed}",
                batch_bytes=batch_bytes,
            )
            for feed in flow.feeds
        ]

    def path(self, layer: str, *names: str) -> str:
        return "/".join([self.root, f"{layer}_{self.flow.name}", *names])

    def state(self, *names: str) -> str:
        return self.path("state", *names)

    def sources_of(self, feed: str) -> list[SourceSpec]:
        return [s for s in self.sources if s.entity == feed]

    def bronze(self) -> None:
        """Take in the new files of every source."""
        rules = self.flow.feed_rules or (FILE_RULE,)
        for s in self.sources:
            state = self.state("bronze", s.entity, s.source_id)
            ingest(self.spark, s, self.path("bronze", s.entity), state, rules, tag=True, ledger=self.ledger)

    def rule_results(self) -> DataFrame:
        """One row per run, table, source and rule: rows seen and rows failed.

        Typed tables read all sources as one stream; their source is `all`.
        """
        return self.ledger.results()

    def raw_table(self, feed: str) -> AppendTable:
        """The feed's raw rows, from all sources it has had."""
        return AppendTable(self.spark, self.path("bronze", feed))

    def _prepared(self, feed: str, rows: DataFrame) -> DataFrame:
        """Raw rows with the names their sources give the columns, tagged if the flow is."""
        sources = self.sources_of(feed)
        for old in {old for s in sources for old in s.rename if old in rows.columns}:
            renaming = [s for s in sources if old in s.rename]
            for s in renaming:
                rows = _moved(rows, F.col(SOURCE) == s.source_id, old, s.rename[old])
            if len(renaming) == len(sources):
                rows = rows.drop(old)
        return rows if self.flow.tagged else rows.drop(SOURCE)

    def bronze_table(self, feed: str) -> DataFrame:
        """The raw rows of all sources of a feed."""
        return self._prepared(feed, self.raw_table(feed).read())

    def silver(self) -> None:
        """Bring every typed table up to date, each as one stream over all sources of its feed."""
        for spec in self.flow.silver:
            raw = self.raw_table(spec.source)
            if raw.exists():
                follow_silver(
                    raw, spec, self.path("silver", spec.name), self.state("silver", spec.name), self.ledger,
                    lambda rows, feed=spec.source: self._prepared(feed, rows), self.batch_bytes,
                )

    def silver_table(self, name: str) -> DataFrame:
        spec = self.flow.table(name)
        if not self.raw_table(spec.source).exists():
            return empty(self.spark, StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in spec.columns.items())))
        return read_silver(self.spark, spec, self.path("silver", name))

    def _stored(self, name: str) -> KeyedTable | AppendTable:
        spec, path = self.flow.table(name), self.path("silver", name)
        return keyed_table(self.spark, spec, path) if spec.cdc else AppendTable(self.spark, path)

    def _version(self, name: str) -> str:
        """Stands for the state of a typed table."""
        return str(self._stored(name).version())

    def colocate(self) -> list[str]:
        """Bring the bucketed copies that views join up to date; returns those that were rewritten."""
        rewritten = []
        for name, key in self.flow.colocate.items():
            if self.raw_table(self.flow.table(name).source).exists():
                copy = bucketed_name(self.flow.name, self.root, name)
                folder = self.path("colocated", name)
                if refresh_bucketed(self.silver_table(name), copy, folder, self._version(name), key, self.flow.buckets):
                    rewritten.append(name)
        return rewritten

    def _joined(self, name: str, key: str | None) -> DataFrame:
        """A typed table as a view on this key reads it: the bucketed copy if there is one."""
        copy = None
        if key is not None and self.flow.colocate.get(name) == key:
            copy = bucketed(self.spark, bucketed_name(self.flow.name, self.root, name))
        return self.silver_table(name) if copy is None else copy

    def view(self, spec: GoldSpec) -> DataFrame:
        secondary = self._joined(spec.secondary, spec.key) if spec.secondary else None
        options = dict(spec.options)
        if spec.view == "daily_revenue_summary" and spec.secondary:
            upserted_by = self.flow.table(spec.secondary).cdc
            options["unique_secondary"] = bool(upserted_by and upserted_by.keys == (spec.key,)) or None
        return build_view(spec.view, self._joined(spec.primary, spec.key), secondary, spec.key, **options)

    def gold(self) -> None:
        for spec in self.flow.gold:
            replace_table(self.view(spec), self.path("gold", spec.name), spec.layout)

    def gold_table(self, name: str) -> DataFrame:
        return versions.read(self.spark, self.path("gold", name))

    def arrange(self) -> list[str]:
        """Rewrite the listed typed tables whole in their declared layout, if they changed.

        The tables the streams keep need no compaction: they have one file per bucket, or slice of a large one. This
        makes the copy that is partitioned, clustered or z-ordered for readers.
        """
        rewritten = []
        for name in self.flow.compact:
            spec, target = self.flow.table(name), self.path("arranged", name)
            if not self.raw_table(spec.source).exists():
                continue
            mark, now = f"{target}/arranged_from", self._version(name)
            if fs.exists(self.spark, mark) and fs.read_text(self.spark, mark) == now:
                continue
            files = files_to_sort(self.spark, self._stored(name).size_bytes())
            replace_table(self.silver_table(name), target, spec.layout, files)
            fs.write_text(self.spark, mark, now, overwrite=True)
            rewritten.append(name)
        return rewritten

    def expire(self, retain_hours: float = 168) -> None:
        """Delete versions that were superseded longer ago than that."""
        for spec in self.flow.silver:
            if spec.cdc:
                keyed_table(self.spark, spec, self.path("silver", spec.name)).expire(retain_hours)
        stored = [("gold", s.name) for s in self.flow.gold] + [("arranged", n) for n in self.flow.compact]
        for layer, name in stored:
            versions.expire(self.spark, self.path(layer, name), retain_hours)

    def publish(self, catalog: str | None = None) -> list[str]:
        """Name the views `gold_{flow}.{view}` and the arranged tables `silver_{flow}.{table}`."""
        prefix = f"{catalog}." if catalog else ""
        stored = [("gold", "gold", s.name) for s in self.flow.gold]
        stored += [("silver", "arranged", name) for name in self.flow.compact]
        names = []
        for layer, place, table in stored:
            path = self.path(place, table)
            number = versions.latest(self.spark, path)
            if number is None:
                continue
            names.append(f"{prefix}{layer}_{self.flow.name}.{table}")
            publish(
                self.spark, names[-1], versions.folder(path, number),
                f"{layer} table {table} of {self.flow.name}", {"quality": layer},
            )
        return names

    def arranged_table(self, name: str) -> DataFrame:
        return versions.read(self.spark, self.path("arranged", name))


def run_flow(run: FlowRun) -> FlowRun:
    """All layers in order. Names move on to the new versions before old ones are deleted."""
    for step in (run.bronze, run.silver, run.colocate, run.gold, run.arrange, run.publish, run.expire):
        step()
    return run

