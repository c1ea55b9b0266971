"""Streams with state: keyed upserts and event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driver_queries import fixtures as fx
from driver_queries.fixtures import table
from driver_queries.gold import HOURLY_SQL, rounded
from driver_queries.silver import AMOUNT_WARN, BUSY_DROP, EVENT_DROP, METRICS_SQL, SCD1_SQL
from siltstone import fs
from siltstone.plans.run import FlowRun
from siltstone.session import scratch_dir
from siltstone.specs import parse_flow
from siltstone.streaming.keyed import scd1_stream as upsert_stream
from siltstone.streaming.runner import run_available_now, stream_id
from siltstone.streaming.windows import pump_hourly
from siltstone.streaming.windowtable import keep_windows


def _deliver(events: DataFrame, folder: str, part: int) -> None:
    """One of three deliveries; together they hold every event."""
    events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(folder)


def scd1_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Three triggered runs, each over a third of the events from the whole time range."""
    work = scratch_dir(spark, "scd1")
    events = table(spark, sf, "events")
    columns = ["user_id", "event_id", "ts", "event_type", "value"]
    for part in range(3):
        _deliver(events, f"{work}/landing", part)
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/landing")
        kept, _ = upsert_stream(
            stream, f"{work}/table", ["user_id"], "ts", f"{work}/checkpoint", columns, ["event_id"], buckets=8
        )
    return kept.current().select(*columns)


WINDOW_KEYS = ["pump_id", "window_start", "window_end"]


def _windows(stream: DataFrame) -> DataFrame:
    return pump_hourly(fx.telemetry(stream), "pump_id", "ts", "sensor_001", "sensor_002")


def _zoneless(windows: DataFrame) -> DataFrame:
    plain = windows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    )
    return rounded(plain, averages=("avg_sensor_01_val",))


def pump_hourly_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The windows as a stored table that follows the stream's updates, a partition per day."""
    work = scratch_dir(spark, "pump-hourly")
    events = table(spark, sf, "events")
    stream = spark.readStream.schema(events.schema).parquet(fx.landing(spark, sf, "events"))
    kept, _ = keep_windows(_windows(stream), f"{work}/table", WINDOW_KEYS, f"{work}/checkpoint")
    return _zoneless(kept.current())


def pump_hourly_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Wrong values first; a new checkpoint then replays the corrected ones over them."""
    work = scratch_dir(spark, "pump-replay")
    events = table(spark, sf, "events")
    wrong = events.withColumn("value", F.col("value") * 7)
    for attempt, rows in enumerate((wrong, events)):
        rows.write.parquet(f"{work}/landing-{attempt}")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/landing-{attempt}")
        kept, _ = keep_windows(_windows(stream), f"{work}/table", WINDOW_KEYS, f"{work}/checkpoint-{attempt}")
    return _zoneless(kept.current())


RULES = {
    action: {r.name: r.constraint for r in (AMOUNT_WARN, EVENT_DROP, BUSY_DROP) if r.action == action}
    for action in ("warn", "drop")
}


def expect_metrics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """What the rules counted over two runs of several batches each."""
    work = scratch_dir(spark, "rules-stream")
    events = table(spark, sf, "events")
    feed = parse_flow({"flow": "rules", "feeds": ["events"], "format": "parquet", "silver": {}, "gold": {}, "feed_rules": RULES})
    for part in range(2):
        half = events.filter(F.col("event_id") % 2 == part)
        half.repartition(3).write.mode("append").parquet(f"{work}/landing/events")
        run = FlowRun(spark, feed, f"{work}/root", f"{work}/landing", batch_bytes=1)
        run.bronze()
    counted = run.rule_results().groupBy(F.col("rule").alias("name"), "action")
    return counted.agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))


def expect_metrics_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a typed table's rules although its last batch is run again, twice.

    First the stream forgets that it committed the batch, as after a crash behind the counts; then
    the batch's counts are gone too, as after a crash between rows and counts.
    """
    work = scratch_dir(spark, "rules-replay")
    events = table(spark, sf, "events")
    flow = parse_flow({"flow": "rules", "feeds": ["events"], "format": "parquet", "gold": {}, "silver": {
        "checked": {"from": "events", "rules": RULES, "columns": {"event_id": "bigint", "user_id": "bigint"}}
    }})
    for part in range(2):
        half = events.filter(F.col("event_id") % 2 == part)
        half.repartition(3).write.mode("append").parquet(f"{work}/landing/events")
        run = FlowRun(spark, flow, f"{work}/root", f"{work}/landing", batch_bytes=1)
        run.bronze()
        run.silver()
    for lost in ("commits", "counts"):
        commits = sorted(fs.glob(spark, f"{run.state('silver', 'checked')}/commits/[0-9]*"), key=lambda c: int(c[0].rsplit("/", 1)[1]))
        fs.delete(spark, commits[-1][0])
        if lost == "counts":
            fs.delete(spark, sorted(fs.glob(spark, f"{run.ledger.path}/{stream_id(spark, run.state('silver', 'checked'))}/*"))[-1][0])
        run.silver()
    counted = run.rule_results().where("layer = 'silver'").groupBy(F.col("rule").alias("name"), "action")
    held = run.silver_table("checked").agg(F.count(F.lit(1)).alias("held"), F.countDistinct("event_id").alias("ids"))
    return counted.agg(F.sum("total").alias("total"), F.sum("failed").alias("failed")).join(held)


def pump_late_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries over the same time range: the watermark drops what comes behind it.

    Only windows that the watermark has closed are written. Rows of a later delivery count
    if their window is still open then.
    """
    work = scratch_dir(spark, "late")
    events = table(spark, sf, "events")
    for part in range(3):
        _deliver(events, f"{work}/landing", part)
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/landing")
        run_available_now(_windows(stream), f"{work}/out", f"{work}/checkpoint")
    return _zoneless(spark.read.parquet(f"{work}/out"))


QUERIES = {f.__name__: f for f in (scd1_stream, pump_hourly_stream, pump_hourly_replay, expect_metrics_stream, expect_metrics_replay, pump_late_drop)}

SQL = {
    "scd1_stream": SCD1_SQL,
    "pump_hourly_stream": HOURLY_SQL,
    "pump_hourly_replay": HOURLY_SQL,
    "expect_metrics_stream": METRICS_SQL,
    "expect_metrics_replay": f"""select m.*, held, held ids from ({METRICS_SQL}) m, (select count(*) held from events
      where user_id is not null and event_type is not null and event_type <> 'error') h""",
    # The watermark after a delivery is ten minutes behind its newest event. A row of a later
    # delivery is dropped if its window ended by then; a window is written once it has ended
    # by the last watermark.
    "pump_late_drop": """
      with marks as (select p, max(m) over (order by p) - interval 10 minutes mark from
          (select event_id % 3 p, max(ts) m from events group by 1) x),
        kept as (select e.*, date_trunc('hour', ts) w from events e
          left join marks b on b.p = event_id % 3 - 1
          where b.mark is null or date_trunc('hour', ts) + interval 1 hour > b.mark)
      select user_id pump_id, w window_start, w + interval 1 hour window_end,
        round(avg(value), 7) avg_sensor_01_val,
        max(cast(json_extract_string(props, '$.k') as int)) max_sensor_02_val
      from kept where w + interval 1 hour <= (select max(mark) from marks) group by 1, 2, 3""",
}
