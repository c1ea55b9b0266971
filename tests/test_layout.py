import glob

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from siltstone.operators.layout import cluster, compact, files_for, write_table, zorder_key
from siltstone.specs import Layout


def ranges(path, column):
    """(min, max) of a column per file."""
    tables = (pq.read_table(f).column(column).to_pylist() for f in glob.glob(f"{path}/*.parquet"))
    return [(min(v), max(v)) for v in tables if v]


def test_cluster_makes_disjoint_sorted_files(spark, work):
    df = spark.range(1000).selectExpr("id", "(id * 37) % 1000 as k")
    write_table(df, f"{work}/t", Layout(cluster_by=("k",), files=4))
    found = sorted(ranges(f"{work}/t", "k"))
    assert len(found) == 4 and all(a[1] < b[0] for a, b in zip(found, found[1:]))
    assert rows(spark.read.parquet(f"{work}/t")) == rows(df)


def test_cluster_splits_a_hot_value(spark):
    df = spark.range(9000).selectExpr("id", "if(id % 3 = 0, -1, id) as k")
    sizes = [r["count"] for r in cluster(df, ["k"], 9).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2000


def test_partitioned(spark, work):
    df = spark.range(100).selectExpr("id", "cast(id % 3 as string) as c")
    write_table(df, f"{work}/t", Layout(partition_by="c"))
    assert len(glob.glob(f"{work}/t/c=*")) == 3
    assert rows(spark.read.parquet(f"{work}/t").select("id", F.col("c").cast("string"))) == rows(df)


def test_zorder_narrows_both_columns(spark, work):
    df = spark.range(4096).selectExpr("id % 64 as a", "cast(lpad(cast(id div 64 as string), 3, '0') as string) as b")
    write_table(df, f"{work}/t", Layout(zorder_by=("a", "b"), files=16))
    assert max(high - low for low, high in ranges(f"{work}/t", "a")) < 40
    assert max(int(high) - int(low) for low, high in ranges(f"{work}/t", "b")) < 40
    assert rows(spark.read.parquet(f"{work}/t")) == rows(df)


def test_zorder_key_of_nulls_and_few_values(spark):
    df = spark.createDataFrame([(None, 1), ("x", None), ("x", 1)], "a string, b int")
    got = df.select("a", "b", zorder_key(df, ["a", "b"]).alias("z")).collect()
    assert len({r.z for r in got}) == 3
    with pytest.raises(ValueError):
        zorder_key(df, ["a", "b"], bits=40)


@pytest.mark.parametrize("columns", [None, ["k"]])
def test_compact_keeps_the_rows(spark, work, columns):
    df = spark.range(500).selectExpr("id % 50 as k", "if(id < 200, 0, id) as v")
    df.repartition(20).write.parquet(f"{work}/small")
    out = compact(spark, f"{work}/small", f"{work}/packed", files=3, columns=columns)
    assert rows(out) == rows(df)
    assert len(glob.glob(f"{work}/packed/*.parquet")) == 3
    assert files_for(spark, f"{work}/small") == 1


def test_overwrite_replaces(spark, work):
    write_table(spark.range(5), f"{work}/t")
    write_table(spark.range(3), f"{work}/t")
    assert spark.read.parquet(f"{work}/t").count() == 3


def test_compact_keeps_partitions(spark, work):
    df = spark.range(200).selectExpr("id", "id % 3 as p", "id % 2 as q")
    df.repartition(6).write.partitionBy("p", "q").parquet(f"{work}/many")
    for columns in (None, ["id"]):
        out = compact(spark, f"{work}/many", f"{work}/few{bool(columns)}", columns=columns)
        assert out.count() == 200 and all("/p=" in f and "/q=" in f for f in out.inputFiles())
        assert len(out.inputFiles()) < len(spark.read.parquet(f"{work}/many").inputFiles())
