"""Declarative metadata: sources, tables, rules and views, read from YAML."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql.types import StructType

ACTIONS = ("warn", "drop")


@dataclass(frozen=True)
class Expectation:
    """A named SQL condition. A condition that evaluates to NULL counts as failed."""

    name: str
    constraint: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"{self.name}: action must be one of {ACTIONS}, not {self.action!r}")


@dataclass(frozen=True)
class Cdc:
    """Keyed upsert: the row with the greatest `sequence_by` per key stays.

    `buckets` is how many folders the stored table is hashed into; a batch rewrites those it has
    keys for. A large bucket is rewritten by several tasks, each with a file of its own.
    """

    keys: tuple[str, ...]
    sequence_by: str
    tie: tuple[str, ...] = ()
    buckets: int = 64


@dataclass(frozen=True)
class Layout:
    partition_by: str | None = None
    cluster_by: tuple[str, ...] = ()
    zorder_by: tuple[str, ...] = ()
    files: int | None = None

    def __post_init__(self):
        if sum(map(bool, (self.partition_by, self.cluster_by, self.zorder_by))) > 1:
            raise ValueError("partition_by, cluster_by and zorder_by exclude each other")


@dataclass(frozen=True)
class SourceSpec:
    """Where one entity of one source lies and how to read it."""

    source_id: str
    entity: str
    source_type: str = "volume"
    format: str = "json"
    base_path: str | None = None
    table: str | None = None
    response_key: str | None = None
    lines: bool = False  # landed documents lie one per line instead of one per file
    row_tag: str = "record"
    sheet_name: str | int = 0
    delimiter: str = ","
    has_header: bool = True
    encoding: str = "UTF-8"
    schema: StructType | None = None
    batch_bytes: int | None = None  # cap of one batch of a stream
    rescue: str | None = None  # JSON and CSV: column for the text of records that do not fit the schema
    rename: dict[str, str] = field(default_factory=dict)
    on_type_change: str = "widen"  # or "fail": a column whose type changes stops the feed

    def __post_init__(self):
        if self.on_type_change not in ("widen", "fail"):
            raise ValueError(f"{self.source_id}: on_type_change must be 'widen' or 'fail'")


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str
    columns: dict[str, str]
    expectations: tuple[Expectation, ...] = ()
    cdc: Cdc | None = None
    layout: Layout = Layout()
    on_cast_error: str = "fail"
    stamp: str | None = None  # name of a column for the time of ingestion


@dataclass(frozen=True)
class GoldSpec:
    name: str
    primary: str
    view: str | None = None
    secondary: str | None = None
    key: str | None = None
    layout: Layout = Layout()
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class FlowSpec:
    """One system: its feeds, typed tables, views and the tables to compact."""

    name: str
    feeds: tuple[str, ...]
    silver: tuple[TableSpec, ...]
    gold: tuple[GoldSpec, ...]
    format: str = "json"
    tagged: bool = False  # rows carry the id of their source
    compact: tuple[str, ...] = ()
    feed_rules: tuple[Expectation, ...] = ()
    colocate: dict[str, str] = field(default_factory=dict)  # typed table: key its copy for joins is bucketed by
    buckets: int = 64  # of those copies

    def table(self, name: str) -> TableSpec:
        return next(t for t in self.silver if t.name == name)


def _rules(raw: dict) -> tuple[Expectation, ...]:
    return tuple(
        Expectation(name, constraint, action)
        for action in ACTIONS
        for name, constraint in (raw.get(action) or {}).items()
    )


def _layout(raw: dict) -> Layout:
    return Layout(
        partition_by=raw.get("partition_by"),
        cluster_by=tuple(raw.get("cluster_by") or ()),
        zorder_by=tuple(raw.get("zorder_by") or ()),
        files=raw.get("files"),
    )


def _table(name: str, raw: dict) -> TableSpec:
    upsert = raw.get("upsert")
    return TableSpec(
        name=name,
        source=raw["from"],
        columns=dict(raw.get("columns") or {}),
        expectations=_rules(raw.get("rules") or {}),
        cdc=Cdc(
            tuple(upsert["keys"]),
            upsert["latest"],
            tuple(upsert.get("tie") or ()),
            upsert.get("buckets", 64),
        )
        if upsert
        else None,
        layout=_layout(raw),
        on_cast_error=raw.get("on_cast_error", "fail"),
        stamp=raw.get("stamp"),
    )


def _view(name: str, raw: dict) -> GoldSpec:
    return GoldSpec(
        name=name,
        view=raw.get("view", name),
        primary=raw["primary"],
        secondary=raw.get("secondary"),
        key=raw.get("key"),
        layout=_layout(raw),
        options=dict(raw.get("options") or {}),
    )


def parse_flow(raw: dict) -> FlowSpec:
    """Build a FlowSpec from a parsed YAML mapping; anything missing raises."""
    return FlowSpec(
        name=raw["flow"],
        feeds=tuple(raw["feeds"]),
        silver=tuple(_table(n, t) for n, t in raw["silver"].items()),
        gold=tuple(_view(n, v) for n, v in raw["gold"].items()),
        format=raw.get("format", "json"),
        tagged=raw.get("tagged", False),
        compact=tuple(raw.get("compact") or ()),
        feed_rules=_rules(raw.get("feed_rules") or {}),
        colocate=dict(raw.get("colocate") or {}),
        buckets=raw.get("buckets", 64),
    )


def load_flow(path: str | Path) -> FlowSpec:
    import yaml

    return parse_flow(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


def bundled_flow(name: str) -> FlowSpec:
    """One of the flows that ship with the library: orders, carts, kpi, telemetry."""
    return load_flow(Path(__file__).parent / "conf" / f"{name}.yml")


def with_buckets(flow: FlowSpec, buckets: int) -> FlowSpec:
    """The flow with its keyed tables in so many buckets; choose by the size of the tables."""
    tables = (replace(t, cdc=replace(t.cdc, buckets=buckets)) if t.cdc else t for t in flow.silver)
    return replace(flow, silver=tuple(tables))


def load_specs(path: str | Path) -> list[TableSpec]:
    """The typed tables of a flow file."""
    return list(load_flow(path).silver)
