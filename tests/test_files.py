"""Sources and sinks on real folders."""

import os

import pytest
from pyspark.sql import functions as F

from fleetlens.sinks import files as sinks
from fleetlens.sources import files as sources
from fleetlens.operators import freshness


def names(path):
    return sorted(n for n in os.listdir(path) if not n.startswith(("_", ".")))


@pytest.fixture
def hourly(spark, tmp_path):
    df = spark.createDataFrame([(1, "20250101", "05"), (2, "20250101", "06"), (3, "20250102", "05")], "v int, date string, hour string")
    sinks.overwrite_partitions(df, f"{tmp_path}/t")
    return f"{tmp_path}/t"


def test_partition_read(spark, hourly):
    one = sources.read_partition(spark, hourly, "20250101", 5)
    assert [tuple(r) for r in one.collect()] == [(1, "20250101", "05")]
    assert sources.read_partition(spark, hourly, "20250101").count() == 2
    declared = sources.read_partition(spark, hourly, "20250101", "05", one.schema)
    assert declared.schema == one.schema and declared.count() == 1


def test_partition_read_lists_only_its_folder(spark, hourly):
    assert len(sources.read_partition(spark, hourly, "20250101", 5).inputFiles()) == 1


def test_overwriting_a_partition_keeps_the_others(spark, hourly):
    sinks.overwrite_partitions(spark.createDataFrame([(9, "20250101", "05")], "v int, date string, hour string"), hourly)
    assert sorted(r["v"] for r in spark.read.parquet(hourly).collect()) == [2, 3, 9]


def test_each_partition_is_written_by_few_tasks(spark, tmp_path):
    df = spark.range(0, 4000, 1, 16).select("id", F.concat(F.lit("d"), F.col("id") % 2).alias("date"), F.lit("00").alias("hour"))
    sinks.overwrite_partitions(df, f"{tmp_path}/t")
    assert len(spark.read.parquet(f"{tmp_path}/t").inputFiles()) == 2


def test_overwrite_replaces_everything(spark, tmp_path):
    for n in (5, 2):
        sinks.overwrite(spark.range(n), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_tolerant_read(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/d1")
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(f"{tmp_path}/d2")
    os.makedirs(f"{tmp_path}/d3")
    with open(f"{tmp_path}/d3/bad.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="bad.parquet"):
        sources.read_tolerant(spark, f"{tmp_path}/{{}}", ["d1", "d3"])
    skipped = []
    out = sources.read_tolerant(spark, f"{tmp_path}/{{}}", ["d1", "d2", "d3", "gone"], on_error="skip", skipped=skipped)
    assert [path.rsplit("/", 1)[1] for path, _ in skipped] == ["d3", "gone"]
    assert sorted(out.columns) == ["id", "x"] and out.count() == 4
    only_id = sources.read_tolerant(spark, f"{tmp_path}/{{}}", ["d1", "d2", "gone"], lambda s, p: s.read.parquet(p).select("id"))
    assert only_id.columns == ["id"] and only_id.count() == 4
    assert sources.read_tolerant(spark, f"{tmp_path}/{{}}", ["gone"]) is None


def test_equal_schemas_become_one_scan(spark, tmp_path):
    for d in ("d1", "d2"):
        spark.range(2).write.parquet(f"{tmp_path}/{d}")
    out = sources.read_tolerant(spark, f"{tmp_path}/{{}}", ["d1", "d2"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and out.count() == 4


def test_single_csv(spark, tmp_path):
    df = spark.range(0, 100, 1, 7).withColumn("t", F.concat(F.lit("a,"), F.col("id")))
    path = sinks.single_csv(df, f"{tmp_path}/out", "final.csv")
    assert names(f"{tmp_path}/out") == ["final.csv"]
    assert sources.load_csv(spark, path).count() == 100
    sinks.single_csv(df.limit(3), f"{tmp_path}/out", "final.csv", header=False)
    assert len(open(path).readlines()) == 3
    sinks.single_csv(df, f"{tmp_path}/out", "final.csv", mode="ignore")
    assert len(open(path).readlines()) == 3
    with pytest.raises(FileExistsError):
        sinks.single_csv(df, f"{tmp_path}/out", "final.csv", mode="error")


def test_single_csv_keeps_a_sort_order(spark, tmp_path):
    df = spark.range(0, 500, 1, 5).orderBy(F.col("id").desc())
    path = sinks.single_csv(df, f"{tmp_path}/o", "s.csv", header=False, ordered=True)
    assert [int(x) for x in open(path)] == list(range(499, -1, -1))


def test_export_models(spark, tmp_path):
    spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "model_name string, v int").write.parquet(f"{tmp_path}/kpi")
    path = sinks.export_models(spark, f"{tmp_path}/kpi", f"{tmp_path}/one", ["A", "B"], "wifiscore.csv")
    assert open(path).readlines()[0] == "model_name,v\n"
    sinks.export_models(spark, f"{tmp_path}/kpi", f"{tmp_path}/many", ["A", "B"])
    assert sources.load_csv(spark, f"{tmp_path}/many").count() == 2


def test_publish(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sinks.publish_if_absent(spark, f"{tmp_path}/gone", f"{tmp_path}/target")
    spark.range(3).write.csv(f"{tmp_path}/source", header=True)
    assert sinks.publish_if_absent(spark, f"{tmp_path}/source", f"{tmp_path}/target", "csv", header=True)
    assert not sinks.publish_if_absent(spark, f"{tmp_path}/source", f"{tmp_path}/target", "csv", header=True)
    assert sources.load_csv(spark, f"{tmp_path}/target").count() == 3


def test_publishing_keeps_folders_and_text_and_finishes_half_copies(spark, tmp_path):
    rows = [(1, "20250101", "05"), (2, "20250101", "06"), (3, "20250102", "05"), (4, None, "05")]
    sinks.overwrite_partitions(spark.createDataFrame(rows, "v int, date string, hour string"), f"{tmp_path}/source")
    os.makedirs(f"{tmp_path}/out/_publishing_t/_temporary")  # a copy that failed
    assert sinks.publish_if_absent(spark, f"{tmp_path}/source", f"{tmp_path}/out/t")
    assert names(f"{tmp_path}/out") == ["t"] and names(f"{tmp_path}/out/t") == names(f"{tmp_path}/source")
    assert names(f"{tmp_path}/out/t/date=20250101") == ["hour=05", "hour=06"]
    one = sources.read_partition(spark, f"{tmp_path}/out/t", "20250101", 5)
    assert [tuple(r) for r in one.collect()] == [(1, "20250101", "05")]
    assert spark.read.parquet(f"{tmp_path}/out/t").where("date is null").count() == 1


def test_an_unknown_mode_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.single_csv(spark.range(1), f"{tmp_path}/o", "a.csv", mode="replace")


def test_listing(spark, tmp_path):
    for n in ("2025-01-01", "2025-01-02", "notes"):
        os.makedirs(f"{tmp_path}/a/{n}")
    listed = sources.list_names(spark, {"a": f"{tmp_path}/a", "gone": f"{tmp_path}/gone"})
    days = freshness.days_in_names(listed)
    assert sorted(str(r["observed_date"]) for r in days.collect()) == ["2025-01-01", "2025-01-02"]
    os.makedirs(f"{tmp_path}/empty")
    assert sources.list_names(spark, {"e": f"{tmp_path}/empty"}).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        sources.list_names(spark, {"a": "nowhere://x/y"})
    assert sources.list_names(spark, {"a": "nowhere://x/y"}, on_error="skip").count() == 0


def test_observed_dates_of_a_table(spark, hourly):
    table = sources.read_table(spark, "parquet", path=hourly)
    parts = sources.observed_partitions(table, "t")
    assert sorted(str(r["observed_date"]) for r in parts.collect()) == ["2025-01-01", "2025-01-02"]
    text = spark.createDataFrame([("2025-01-01T05:00:00",), ("2025-01-01 06:00:00",)], "ts string")
    assert [str(r["observed_date"]) for r in sources.observed_in_table(text, "t", "ts").collect()] == ["2025-01-01"]
