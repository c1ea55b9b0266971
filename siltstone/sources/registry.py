"""The control table of sources: which feeds exist and how to read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from siltstone import versions
from siltstone.operators.cdc import latest_per_key
from siltstone.operators.merge import upsert
from siltstone.operators.unify import empty
from siltstone.session import scratch_dir
from siltstone.specs import SourceSpec

# The registry's columns, types and NOT NULL marks.
REGISTRY_SCHEMA = StructType(
    [
        StructField("source_id", StringType(), False),
        StructField("source_type", StringType(), False),
        StructField("entity", StringType(), False),
        StructField("format", StringType()),
        StructField("base_path", StringType()),
        StructField("lakeflow_table", StringType()),
        StructField("api_endpoint", StringType()),
        StructField("api_response_key", StringType()),
        StructField("row_tag", StringType()),
        StructField("sheet_name", StringType()),
        StructField("delimiter", StringType()),
        StructField("has_header", BooleanType()),
        StructField("encoding", StringType()),
        StructField("active", BooleanType(), False),
        StructField("registered_at", TimestampType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
)
KEYS = ("source_id", "entity")
KEPT = (*KEYS, "source_type", "registered_at")  # a re-registration leaves these alone
UPDATED = tuple(n for n in REGISTRY_SCHEMA.names if n not in KEPT)

# What an unset or empty setting means.
DEFAULTS = {
    "format": "json",
    "row_tag": "record",
    "sheet_name": "0",
    "delimiter": ",",
    "encoding": "UTF-8",
}


def create_registry(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Create the schema and the empty registry table unless they are there."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in REGISTRY_SCHEMA
    )
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{place} COMMENT 'Registered sources'"
    )


def conform(df: DataFrame) -> DataFrame:
    """The registry's columns and types; missing ones are NULL, a NULL in a NOT NULL column fails."""

    def column(f: StructField):
        value = (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType)
        if not f.nullable:
            failure = F.raise_error(F.lit(f"registry column {f.name} must not be NULL"))
            value = F.when(value.isNull(), failure.cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    return df.select(*map(column, REGISTRY_SCHEMA.fields))


def registrations(df: DataFrame) -> DataFrame:
    """New registrations with the defaults of a call: active, UTF-8, stamped now."""
    defaults = {
        "encoding": F.lit("UTF-8"),
        "active": F.lit(True),
        "registered_at": F.current_timestamp(),
        "updated_at": F.current_timestamp(),
    }
    for name, value in defaults.items():
        held = F.col(name) if name in df.columns else F.lit(None)
        df = df.withColumn(name, F.coalesce(held.cast(REGISTRY_SCHEMA[name].dataType), value))
    return conform(df)


def register(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry after registering all of `new` in one merge.

    A known (source, entity) takes every setting of the new row, unset ones too, and keeps
    its type and first registration. Of several new rows for one key the latest counts.
    """
    return upsert(registry, latest_per_key(registrations(new), KEYS, "updated_at"), KEYS, UPDATED)


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    if versions.latest(spark, path) is None:
        return empty(spark, REGISTRY_SCHEMA)
    return versions.read(spark, path)


def register_sources(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """Merge `new` into the stored registry and return what is stored now."""
    versions.write(register(load_registry(spark, path), new), path)
    return load_registry(spark, path)


def fill_registry(spark: SparkSession, table: str, new: DataFrame) -> None:
    """Register `new` in the named table that `create_registry` made; a NULL key or mark fails and changes nothing.

    The merged rows are written beside the table first, as a table cannot be overwritten from itself.
    """
    merged = register(conform(spark.table(table)), new).select(*REGISTRY_SCHEMA.names)
    staged = scratch_dir(spark, "registry")
    merged.write.parquet(staged)
    spark.read.schema(REGISTRY_SCHEMA).parquet(staged).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def active_sources(registry: DataFrame) -> DataFrame:
    return registry.filter("active")


def list_registry(registry: DataFrame) -> DataFrame:
    return registry.orderBy("entity", "source_type", "source_id")


def with_defaults(registry: DataFrame) -> DataFrame:
    """Unset and empty settings replaced by their defaults."""
    filled = {n: F.coalesce(F.nullif(F.col(n), F.lit("")), F.lit(d)) for n, d in DEFAULTS.items()}
    return registry.withColumns({**filled, "has_header": F.coalesce("has_header", F.lit(True))})


def with_table_names(registry: DataFrame) -> DataFrame:
    """The table name of each source, and its path with and without the `dbfs:` scheme."""
    name = F.replace(F.concat_ws("_", "entity", "source_type", "source_id"), F.lit("-"), F.lit("_"))
    scheme = F.lit("dbfs:")
    path = F.col("base_path")
    return registry.withColumns(
        {
            "table_name": name,
            "local_path": F.replace(path, scheme, F.lit("")),
            "cloud_path": F.when(path.startswith(scheme), path).otherwise(F.concat(scheme, path)),
        }
    )


def specs_of(registry: DataFrame, entity: str | None = None) -> list[SourceSpec]:
    """The active sources as specs; the registry is the one table the driver reads whole."""
    rows = active_sources(with_defaults(registry))
    if entity is not None:
        rows = rows.filter(F.col("entity") == entity)
    return [
        SourceSpec(
            source_id=r.source_id,
            entity=r.entity,
            source_type=r.source_type,
            format=r.format,
            base_path=r.base_path or r.api_endpoint,
            table=r.lakeflow_table,
            response_key=r.api_response_key,
            row_tag=r.row_tag,
            sheet_name=r.sheet_name,
            delimiter=r.delimiter,
            has_header=r.has_header,
            encoding=r.encoding,
        )
        for r in rows.orderBy("source_id", "entity").collect()
    ]
