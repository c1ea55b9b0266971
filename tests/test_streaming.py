import json

from conftest import rows
from pyspark.sql import functions as F

from siltstone.plans.silver import cleanse_telemetry
from siltstone.streaming.windows import pump_hourly
from siltstone.streaming.windowtable import keep_windows

SCHEMA = "pump_id string, timestamp timestamp, sensor_001 double, sensor_002 double"


def reading(pump, at, a, b):
    return json.dumps(dict(pump_id=pump, timestamp=at, sensor_001=a, sensor_002=b))


def windows(df):
    return pump_hourly(df, "pump_id", "timestamp", "sensor_001", "sensor_002")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    (tmp_path / "in").mkdir()
    batches = [
        [reading("p", "2026-01-01T00:10:00", 1, 1), reading("p", "2026-01-01T05:00:00", 2, 2)],
        [reading("p", "2026-01-01T05:01:00", 4, 1)],
        [reading("p", "2026-01-01T00:20:00", 99, 99), reading("p", "2026-01-01T05:02:00", 6, 3)],
    ]
    dropped = 0
    for number, batch in enumerate(batches):
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(batch))
        stream = spark.readStream.schema(SCHEMA).json(str(tmp_path / "in"))
        table, query = keep_windows(
            windows(stream), str(tmp_path / "t"), ["pump_id", "window_start", "window_end"], str(tmp_path / "cp")
        )
        dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    got = table.current().select(F.hour("window_start"), "avg_sensor_01_val", "max_sensor_02_val")
    assert rows(got) == [(0, 1.0, 1.0), (5, 4.0, 3.0)]
    assert dropped == 1


def test_batch_counts_late_rows(spark):
    data = [("p", "2026-01-01 05:00:00", 2.0, 2.0), ("p", "2026-01-01 00:20:00", 9.0, 8.0)]
    df = spark.createDataFrame(data, "pump_id string, t string, sensor_001 double, sensor_002 double")
    got = windows(df.withColumn("timestamp", F.col("t").cast("timestamp")))
    assert rows(got.select("avg_sensor_01_val", "max_sensor_02_val")) == [(2.0, 2.0), (9.0, 8.0)]


def test_wide_telemetry_passes_through_and_is_pruned(spark, work):
    sensors = [F.lit(float(i)).alias(f"sensor_{i:03d}") for i in range(1, 1001)]
    wide = spark.range(3).select(
        F.when(F.col("id") > 0, F.concat(F.lit("PUMP_"), "id")).alias("pump_id"),
        F.lit("2026-01-01").cast("timestamp").alias("timestamp"),
        F.lit("Idle").alias("operational_status"),
        *sensors,
    )
    wide.write.parquet(f"{work}/wide")
    clean = cleanse_telemetry(spark.read.parquet(f"{work}/wide"))
    assert len(clean.columns) == 1004 and clean.count() == 2
    plan = windows(clean)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "sensor_002" in scan and "sensor_003" not in scan.split("ReadSchema")[1]
    assert "IsNotNull(pump_id)" in scan
