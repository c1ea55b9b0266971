from siltstone.sources.discovery import discover_sources
from siltstone.sources.readers import read_source, read_table, source_schema
from siltstone.sources.records import read_records
from siltstone.sources.registry import (
    REGISTRY_SCHEMA,
    active_sources,
    create_registry,
    list_registry,
    register,
    specs_of,
    with_defaults,
    with_table_names,
)
from siltstone.sources.schemas import merge_schemas
from siltstone.sources.xlsx import read_xlsx

__all__ = [
    "REGISTRY_SCHEMA", "active_sources", "create_registry", "discover_sources", "merge_schemas",
    "list_registry", "read_records", "read_source", "read_table", "read_xlsx", "register",
    "source_schema", "specs_of", "with_defaults", "with_table_names",
]
