"""Ingestion: a table is landed in a format and taken in through the reader of that format."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries import fixtures as fx
from driver_queries.fixtures import as_columns, table
from driver_queries.silver import EVENT_DROP, UNIFY_SQL
from driver_queries.workbooks import write_workbooks
from siltstone import fs
from siltstone.operators import tag_source, unify
from siltstone.operators.ledger import RuleLedger
from siltstone.plans.bronze import ingest, unified_entity
from siltstone.plans.silver import run_silver
from siltstone.session import scratch_dir
from siltstone.sources import read_records, read_source, read_table
from siltstone.sources.registry import registrations
from siltstone.specs import SourceSpec, TableSpec
from siltstone.streaming.runner import run_available_now


def _ingested(spark: SparkSession, spec: SourceSpec, work: str) -> DataFrame:
    ingest(spark, spec, f"{work}/bronze", f"{work}/state", tag=True)
    return read_table(spark, f"{work}/bronze")


def _through(spark: SparkSession, sf: str, fmt: str, name: str = "orders", **options: str) -> DataFrame:
    """The table written in a format, streamed in, and given its types back."""
    work = scratch_dir(spark, f"bronze-{fmt}")
    source = table(spark, sf, name)
    source.write.format(fmt).options(**options).save(f"{work}/landing")
    raw = _ingested(spark, SourceSpec("landed", name, format=fmt, base_path=f"{work}/landing"), work)
    return as_columns(raw, source)


def bronze_stream_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """The table's own files, streamed as they are."""
    work = scratch_dir(spark, "bronze-parquet")
    path = fx.landing(spark, sf, "lineitem")
    raw = _ingested(spark, SourceSpec("landed", "lineitem", format="parquet", base_path=path), work)
    return raw.drop("_source")


def bronze_stream_json(spark: SparkSession, sf: str) -> DataFrame:
    return _through(spark, sf, "json")


def bronze_stream_csv(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "bronze-csv")
    source = table(spark, sf, "orders")
    source.write.options(header="true", sep=";", encoding="UTF-8").csv(f"{work}/landing")
    spec = SourceSpec("landed", "orders", format="csv", base_path=f"{work}/landing", delimiter=";")
    return as_columns(_ingested(spark, spec, work), source)


def bronze_stream_orc(spark: SparkSession, sf: str) -> DataFrame:
    return _through(spark, sf, "orc")


def bronze_stream_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as elements, the order key as an attribute that shadows a child of the same name."""
    work = scratch_dir(spark, "bronze-xml")
    source = table(spark, sf, "orders")
    source.select(F.col("o_orderkey").alias("@o_orderkey"), F.lit("shadowed").alias("o_orderkey"), *source.columns[1:]) \
        .write.format("xml").options(rowTag="order", rootTag="orders", attributePrefix="@").save(f"{work}/landing")
    spec = SourceSpec("landed", "orders", format="xml", base_path=f"{work}/landing", row_tag="order")
    return as_columns(_ingested(spark, spec, work), source)


def _latin_customers(spark: SparkSession, sf: str, label: str) -> tuple[SourceSpec, str]:
    """Elements in ISO-8859-1 without a prolog; every seventh does not close."""
    work = scratch_dir(spark, label)
    name = F.concat(F.lit("<name>é "), "c_name", F.lit("</name>"))
    closing = F.when(F.col("c_custkey") % 7 == 0, "").otherwise("</customer>")
    record = F.concat(F.lit('<customer key="'), "c_custkey", F.lit('">'), name, F.lit("<bal>"), "c_acctbal", F.lit("</bal>"), closing)
    # As text of these bytes, which the writer leaves as they are.
    table(spark, sf, "customer").select(F.encode(record, "ISO-8859-1").cast("string")).write.text(f"{work}/landing")
    spec = SourceSpec("landed", "customer", format="xml", base_path=f"{work}/landing", row_tag="customer", encoding="ISO-8859-1")
    return spec, work


def bronze_xml_encoded(spark: SparkSession, sf: str) -> DataFrame:
    spec, work = _latin_customers(spark, sf, "bronze-latin")
    return _ingested(spark, spec, work).select(F.col("key").cast("long").alias("c_custkey"), "name", F.col("bal").cast("double").alias("bal"))


def bronze_xml_rules(spark: SparkSession, sf: str) -> DataFrame:
    """What the ledger holds of the same files: rows seen and rows failed by rule."""
    spec, work = _latin_customers(spark, sf, "bronze-latin-rules")
    ledger = RuleLedger(spark, f"{work}/rules", datetime(2026, 1, 1))
    ingest(spark, spec, f"{work}/bronze", f"{work}/state", ledger=ledger)
    return ledger.results().select("rule", "total", "failed")


def bronze_xlsx(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "bronze-xlsx")
    source = table(spark, sf, "customer")
    write_workbooks(source, f"{work}/landing")
    spec = SourceSpec("landed", "customer", format="xlsx", base_path=f"{work}/landing", sheet_name="data")
    return as_columns(read_source(spark, spec), source)


def bronze_stream_xlsx(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "bronze-stream-xlsx")
    source = table(spark, sf, "part")
    write_workbooks(source, f"{work}/landing")
    spec = SourceSpec("landed", "part", format="xlsx", base_path=f"{work}/landing")
    return as_columns(_ingested(spark, spec, work), source)


def bronze_rest_records(spark: SparkSession, sf: str) -> DataFrame:
    """A response document per customer, with the customer as buyer and as payer."""
    work = scratch_dir(spark, "bronze-rest")
    source = table(spark, sf, "customer")
    records = F.array(
        *(
            F.struct(
                F.col("c_custkey").alias("id"),
                F.lit(role).alias("role"),
                F.struct("c_nationkey", "c_mktsegment").alias("address"),
                F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
            )
            for role in ("buyer", "payer")
        )
    )
    document = F.struct(records.alias("users"), F.lit(2).alias("total"))
    source.select(F.to_json(document)).write.text(f"{work}/landing")
    return read_records(spark, f"{work}/landing", "users", lines=True)


def bronze_rest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Response documents in three runs; later ones bring fields, other types and a page without records."""
    work = scratch_dir(spark, "bronze-rest-runs")
    customers = table(spark, sf, "customer")
    spec = SourceSpec("api", "users", "rest_api", base_path=f"{work}/landing", response_key="users", lines=True)
    fields = [
        [F.col("c_custkey").alias("id"), F.col("c_name").alias("name")],
        [F.col("c_custkey").alias("id"), F.struct("c_nationkey", "c_mktsegment").alias("address")],
        [F.concat(F.lit("c"), "c_custkey").alias("id"), F.col("c_acctbal").alias("name")],
    ]
    for part, columns in enumerate(fields):
        page = F.to_json(F.struct(F.array(F.struct(*columns)).alias("users")))
        pages = customers.where(F.col("c_custkey") % 3 == part).select(page.alias("value"))
        pages.union(spark.range(1).select(F.lit('{"total": 0}'))).write.mode("append").text(f"{work}/landing")
        raw = _ingested(spark, spec, work)
    return raw.select("id", "name", "address", "_source")


def bronze_connector_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table as the source of a stream."""
    work = scratch_dir(spark, "bronze-connector")
    name = "connector_" + work.rsplit("-", 1)[1].lower().replace("_", "")
    table(spark, sf, "orders").write.option("path", f"{work}/landing").saveAsTable(name)
    try:
        return _ingested(spark, SourceSpec("lakeflow_s3", "orders", "lakeflow_connect", table=name), work)
    finally:
        spark.sql(f"DROP TABLE {name}")


def bronze_schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery brings a column; the raw table takes it up at the next run."""
    work = scratch_dir(spark, "bronze-evolution")
    events = table(spark, sf, "events")
    spec = SourceSpec("landed", "events", format="json", base_path=f"{work}/landing")
    first = events.filter("event_id % 2 = 0").select("event_id", "user_id")
    second = events.filter("event_id % 2 = 1").select("event_id", "user_id", "value", "event_type")
    for delivery in (first, second):
        delivery.write.mode("append").json(f"{work}/landing")
        raw = _ingested(spark, spec, work)
    return raw.select("event_id", "user_id", "value", "event_type", "_source")


def bronze_evolution_old_file(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery has a new column and a time stamp weeks before the first."""
    work = scratch_dir(spark, "bronze-old-file")
    events = table(spark, sf, "events")
    spec = SourceSpec("landed", "events", format="json", base_path=f"{work}/landing")
    events.filter("event_id % 2 = 0").select("event_id", "user_id").write.json(f"{work}/landing")
    _ingested(spark, spec, work)
    known = {path for path, _ in fs.glob(spark, f"{work}/landing/part-*")}
    late = events.filter("event_id % 2 = 1").select("event_id", "user_id", "value")
    late.write.mode("append").json(f"{work}/landing")
    for path in {path for path, _ in fs.glob(spark, f"{work}/landing/part-*")} - known:
        fs.set_modified_ms(spark, path, fs.modified_ms(spark, path) - 30 * 86_400_000)
    return _ingested(spark, spec, work).select("event_id", "user_id", "value")


def bronze_evolution_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers, then only NULLs and a struct with one field more, then fractions, which are rescued."""
    work = scratch_dir(spark, "bronze-sparse")
    events = table(spark, sf, "events")
    spec = SourceSpec("landed", "events", format="json", base_path=f"{work}/landing", rescue="_rescued")
    whole, one = F.floor("value").alias("value"), F.struct("user_id").alias("who")
    two = F.struct("user_id", "event_type").alias("who")
    deliveries = [(whole, one), (F.lit(None).cast("double").alias("value"), two), (F.col("value"), two)]
    for part, (value, who) in enumerate(deliveries):
        rows = events.filter(F.col("event_id") % 3 == part).select("event_id", value, who)
        rows.write.mode("append").option("ignoreNullFields", "false").json(f"{work}/landing")
        raw = _ingested(spark, spec, work)
    rescued = F.get_json_object("_rescued", "$.value").cast("double")
    return raw.select(
        "event_id", "who.user_id", "who.event_type", F.coalesce(F.col("value").cast("double"), rescued).alias("value")
    )


def bronze_evolution_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers, then fractions under a header in another order and with a column more, then fewer columns.

    The last two come as one delivery, so that one batch holds files of both headers.
    """
    work = scratch_dir(spark, "bronze-evolution-csv")
    events = table(spark, sf, "events")
    spec = SourceSpec("landed", "events", format="csv", base_path=f"{work}/landing")
    deliveries = [
        [(0, ["event_id", "user_id", F.floor("value").alias("value")])],
        [(1, ["value", "event_type", "event_id", "user_id"]), (2, ["user_id", "event_id"])],
    ]
    for delivery in deliveries:
        for part, columns in delivery:
            rows = events.filter(F.col("event_id") % 3 == part).select(*columns)
            rows.write.mode("append").option("header", "true").csv(f"{work}/landing")
        raw = _ingested(spark, spec, work)
    return raw.select("event_id", "user_id", "value", "event_type")


def bronze_evolution_parquet(spark: SparkSession, sf: str) -> DataFrame:
    """int keys, then int and bigint beside each other, floats beside doubles, and at last text beside numbers."""
    work = scratch_dir(spark, "bronze-evolution-parquet")
    events = table(spark, sf, "events")
    spec = SourceSpec("landed", "events", format="parquet", base_path=f"{work}/landing")
    narrow, whole = F.col("event_id").cast("int").alias("event_id"), F.floor("value").cast("int").alias("value")
    deliveries = [
        [(0, [narrow, whole, F.col("user_id").cast("int").alias("user_id")])],
        [(1, ["event_id", "value", "user_id", "event_type"]), (2, [narrow, "value", "user_id"])],
        [(3, ["event_id", "value", F.concat(F.lit("u"), "user_id").alias("user_id")])],
    ]
    for delivery in deliveries:
        for part, columns in delivery:
            rows = events.filter(F.col("event_id") % 4 == part).select(*columns)
            rows.write.mode("append").parquet(f"{work}/landing")
        raw = _ingested(spark, spec, work)
    return raw.select("event_id", "user_id", "value", "event_type")


def bronze_evolution_race(spark: SparkSession, sf: str) -> DataFrame:
    """Files with a new column land after a run has looked at its folder and before it reads on."""
    work = scratch_dir(spark, "bronze-evolution-race")
    events = table(spark, sf, "events")
    spec = SourceSpec("landed", "events", format="json", base_path=f"{work}/landing", batch_bytes=1)
    first = events.filter("event_id % 2 = 0").select("event_id", "user_id")
    first.repartition(2).write.json(f"{work}/landing")
    query = ingest(spark, spec, f"{work}/bronze", f"{work}/state", tag=True, wait=False)
    second = events.filter("event_id % 2 = 1").select("event_id", "user_id", "value")
    second.write.mode("append").json(f"{work}/landing")
    query.awaitTermination()
    return _ingested(spark, spec, work).select("event_id", "user_id", "value")


def unify_sources_stream(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "unify")
    path, schema = fx.landing(spark, sf, "events"), table(spark, sf, "events").schema

    def half(rest: int, source: str, *columns: str) -> DataFrame:
        stream = spark.readStream.schema(schema).parquet(path).filter(F.col("event_id") % 2 == rest)
        return tag_source(stream.select(*columns), source)

    both = unify(
        [half(0, "lakeflow_s3", "event_id", "user_id", "value"), half(1, "volume_c1", "event_id", "user_id", "props")]
    )
    run_available_now(both, f"{work}/out", f"{work}/checkpoint")
    return spark.read.schema(both.schema).parquet(f"{work}/out").select(
        "event_id", "user_id", "value", "props", "_source"
    )


def silver_events_clean_stream(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_dir(spark, "events-clean")
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(fx.landing(spark, sf, "events"))
    spec = TableSpec("events_clean", "events", {"user_id": "bigint"}, (EVENT_DROP,))
    run_silver(stream.select("event_id", "user_id", "event_type", "ts"), spec, f"{work}/out", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/out")


def bronze_from_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Three active sources of one entity in three formats, read and united by the registry."""
    work = scratch_dir(spark, "bronze-registry")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag"
    )
    lines.filter("l_returnflag = 'A'").write.parquet(f"{work}/a")
    lines.filter("l_returnflag = 'N'").withColumnRenamed("l_partkey", "part").write.json(f"{work}/n")
    lines.filter("l_returnflag = 'R'").drop("l_linenumber").write.option("header", "true").csv(f"{work}/r")
    rows = [
        ("volume-a", "parquet", f"{work}/a", True),
        ("volume-n", "json", f"{work}/n", True),
        ("volume-r", "csv", f"{work}/r", True),
        ("volume-x", "json", f"{work}/nowhere", False),
    ]
    registry = registrations(
        spark.createDataFrame(rows, "source_id string, format string, base_path string, active boolean")
        .withColumns({"source_type": F.lit("volume"), "entity": F.lit("carts_raw")})
    )
    united = unified_entity(spark, registry, "carts_raw")
    types = {"l_orderkey": "bigint", "l_partkey": "bigint", "part": "bigint", "l_linenumber": "int",
             "l_extendedprice": "double", "l_returnflag": "string", "_source": "string"}
    return united.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))


QUERIES = {
    f.__name__: f
    for f in (
        bronze_stream_parquet, bronze_stream_json, bronze_stream_csv, bronze_stream_orc, bronze_stream_xml,
        bronze_xml_encoded, bronze_xml_rules, bronze_xlsx, bronze_stream_xlsx, bronze_rest_records, bronze_rest_incremental, bronze_connector_stream,
        bronze_schema_evolution, bronze_evolution_old_file, bronze_evolution_sparse, bronze_evolution_csv, bronze_evolution_parquet,
        bronze_evolution_race, unify_sources_stream, silver_events_clean_stream, bronze_from_registry,
    )
}

SQL = {
    "bronze_stream_parquet": "select * from lineitem",
    **dict.fromkeys(
        ("bronze_stream_json", "bronze_stream_csv", "bronze_stream_orc", "bronze_stream_xml"),
        "select * from orders",
    ),
    "bronze_xml_encoded": """select c_custkey, 'é ' || c_name as name, c_acctbal bal from customer where c_custkey % 7 <> 0""",
    "bronze_xml_rules": """select 'well_formed' as rule, count(*) total, count(*) filter (c_custkey % 7 = 0) failed from customer
      union all select 'non_null_input_file', count(*), 0 from customer""",
    "bronze_xlsx": "select * from customer",
    "bronze_stream_xlsx": "select * from part",
    "bronze_rest_records": """select cast(c_custkey as varchar) id, role,
      '{"c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' address,
      case when c_acctbal > 0 then cast(c_acctbal as varchar) end balance
      from customer, (values ('buyer'), ('payer')) r(role)""",
    "bronze_rest_incremental": """select case when c_custkey % 3 = 2 then 'c' else '' end || c_custkey id,
      case c_custkey % 3 when 0 then c_name when 2 then cast(c_acctbal as varchar) end as name,
      case when c_custkey % 3 = 1 then '{"c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}' end address,
      'api' _source from customer""",
    "bronze_connector_stream": "select *, 'lakeflow_s3' _source from orders",
    "bronze_schema_evolution": """select event_id, user_id, case when event_id % 2 = 1 then value end as value,
      case when event_id % 2 = 1 then event_type end event_type, 'landed' _source from events""",
    "bronze_evolution_old_file": """select event_id, user_id, case when event_id % 2 = 1 then value end as value
      from events""",
    "bronze_evolution_sparse": """select event_id, user_id, case when event_id % 3 > 0 then event_type end event_type,
      case event_id % 3 when 0 then floor(value) when 2 then value end as value from events""",
    "bronze_evolution_csv": """select event_id, user_id, case event_id % 3 when 0 then floor(value) when 1 then value end as value,
      case when event_id % 3 = 1 then event_type end event_type from events""",
    "bronze_evolution_parquet": """select event_id, case when event_id % 4 = 3 then 'u' else '' end || user_id user_id,
      case when event_id % 4 = 0 then floor(value) else value end as value,
      case when event_id % 4 = 1 then event_type end event_type from events""",
    "bronze_evolution_race": """select event_id, user_id, case when event_id % 2 = 1 then value end as value from events""",
    "unify_sources_stream": UNIFY_SQL,
    "silver_events_clean_stream": "select event_id, user_id, event_type, ts from events",
    "bronze_from_registry": """select l_orderkey,
      case when l_returnflag <> 'N' then l_partkey end l_partkey,
      case when l_returnflag = 'N' then l_partkey end part,
      case when l_returnflag <> 'R' then l_linenumber end l_linenumber, l_extendedprice, l_returnflag,
      'volume-' || lower(l_returnflag) _source from lineitem""",
}
