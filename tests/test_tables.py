"""Metadata of tables, bucketed days, redelivered messages, verified copies, files of parts."""

import csv
import datetime as dt
import re
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetlens import adapters as A
from fleetlens.operators import features
from fleetlens.session import scratch_path, stage
from fleetlens.sinks import published
from fleetlens.sources import metadata
from fleetlens.streaming import messages, redelivery

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


# --- listings ------------------------------------------------------------------


def test_many_names_are_listed_by_tasks(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(100_000):
        (folder / f"f,{k}.csv").touch()
    (tmp_path / "few" / "day=2024-01-01").mkdir(parents=True)
    folders = {"many": f"file:{folder}", "few": str(tmp_path / "few"), "absent": str(tmp_path / "none"), "null": None}
    found = metadata.list_folders(metadata.folders_of(spark, folders))
    assert found.groupBy("name").agg(F.countDistinct("entry")).collect().__len__() == 2
    assert found.where("name = 'many'").count() == 100_000 and not re.search("LocalTableScan.*entry", plan(found))
    assert [tuple(r) for r in found.where("name = 'few'").select("entry", "is_folder").collect()] == [("day=2024-01-01", True)]
    days = metadata.folder_days(metadata.folders_of(spark, folders), "day", "yyyy-MM-dd")
    assert [tuple(r) for r in days.collect()] == [("few", dt.date(2024, 1, 1))]


def test_a_file_is_no_folder(spark, tmp_path):
    (tmp_path / "file").touch()
    folders = metadata.folders_of(spark, {"x": str(tmp_path / "file")})
    with pytest.raises(Exception, match="file"):
        metadata.list_folders(folders).collect()
    assert metadata.list_folders(folders, on_error="skip").collect() == []


def test_data_files_below(spark, tmp_path):
    for name in ("a=1/b=1/x.parquet", "a=1/b=2/y.parquet", "a=2/_temp/z.parquet", ".crc", "top.parquet"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).touch()
    found = metadata.data_files(metadata.folders_of(spark, {"t": str(tmp_path)}))
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found.collect()) == ["top.parquet", "x.parquet", "y.parquet"]


# --- footers -------------------------------------------------------------------


def written(spark, tmp_path, rows, parts, kind="timestamp", stored="TIMESTAMP_MICROS"):
    df = spark.createDataFrame([(x,) for x in rows], "t string").select(F.col("t").cast(kind).alias("t"), F.lit(1).alias("v"))
    path = f"{tmp_path}/t{len(list(tmp_path.iterdir()))}"
    spark.conf.set("spark.sql.parquet.outputTimestampType", stored)
    df.repartitionByRange(parts, "t").sortWithinPartitions("t").write.parquet(path)
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    return metadata.data_files(metadata.folders_of(spark, {"t": path}))


DAYS = [f"2024-01-{d:02d} {h:02d}:30:00" for d in range(1, 29) for h in range(0, 24, 3) if d % 4]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_newest_day_reads_no_rows(spark, tmp_path, monkeypatch, kind):
    files = written(spark, tmp_path, [*DAYS, None], 6, kind)
    groups = metadata.row_groups(files, "t")
    assert metadata.open_groups(groups, 1).count() == 0
    assert "FileScan parquet [t" not in plan(metadata.newest_days(files, "t", 1))
    assert [r["observed_date"] for r in metadata.newest_days(files, "t", 1).collect()] == [dt.date(2024, 1, 27)]
    want = sorted({dt.date.fromisoformat(x[:10]) for x in DAYS}, reverse=True)
    for n in (2, 9, 40):
        assert sorted((r["observed_date"] for r in metadata.newest_days(files, "t", n).collect()), reverse=True) == want[:n]
    assert metadata.open_groups(groups, 2).count() < groups.count()  # groups of old days stay closed
    assert [tuple(r) for r in metadata.newest_day_rows(files, "t").collect()] == [("t", dt.date(2024, 1, 27), 8)]


def test_without_statistics_the_result_is_the_same(spark, tmp_path):
    texts = written(spark, tmp_path, DAYS, 4, "string")  # no order of days can be taken from text
    assert metadata.row_groups(texts, "t").where("low is not null").count() == 0
    loose = written(spark, tmp_path, [*DAYS, None], 4, stored="INT96")
    assert metadata.row_groups(loose, "t").where("low is not null").count() == 0
    for files in (texts, loose):
        assert [r["observed_date"].day for r in metadata.newest_days(files, "t", 3).orderBy(F.desc("observed_date")).collect()] == [27, 26, 25]
        assert [tuple(r) for r in metadata.newest_day_rows(files, "t").collect()] == [("t", dt.date(2024, 1, 27), 8)]


@pytest.mark.parametrize("stored", ["TIMESTAMP_MICROS", "INT96"])
def test_days_are_those_of_the_zone(spark, tmp_path, stored):
    files = written(spark, tmp_path, ["2024-01-01 23:30:00", "2024-01-02 01:00:00"], 1, stored=stored)
    assert [r["observed_date"].day for r in metadata.newest_days(files, "t", 1, "America/New_York").collect()] == [1]
    empty = written(spark, tmp_path, [None], 1)
    assert metadata.newest_days(empty, "t", 2).collect() == [] and metadata.newest_day_rows(empty, "t").collect() == []


def test_unreadable_files_are_left_out(spark, tmp_path):
    for d in (1, 2, 3):
        spark.range(d).write.parquet(f"{tmp_path}/day={d}")
    bad = next(Path(f"{tmp_path}/day=2").glob("part-*.parquet"))
    Path(f"{bad.parent}/.{bad.name}.crc").unlink()
    bad.write_bytes(b"PAR1 no such thing")
    folders = metadata.folders_of(spark, {str(d): f"{tmp_path}/day={d}" for d in range(1, 6)})
    rows, lost = metadata.read_sound(spark, folders, "id long")
    assert [r["name"] for r in lost.collect()] == ["2"] and len(re.findall("FileScan", plan(rows))) == 1
    assert rows.count() >= 4  # the sound files' rows
    assert metadata.read_sound(spark, folders.where("name > '3'"), "id long")[0].collect() == []


# --- bucketed days -------------------------------------------------------------


def test_bucketed_days_join_without_an_exchange(spark):
    base = scratch_path(spark, "bucketed")
    daily = A.daily_features(spark, SF)
    days = {}
    for d in ("2024-01-03", "2024-01-04", "2024-01-05", "2024-01-06"):
        own = daily.where(F.col("day") == F.lit(d).cast("date")).drop("day")
        days[d] = features.store_bucketed(own.union(own), f"t_{base[-8:]}_{d[-2:]}", f"{base}/{d}", "serial_num", 4)
    names = ["num_station", "poor_rssi", "poor_phyrate", "home_score"]
    wide = features.bucketed_wide_join(days, "serial_num", names)
    assert "Exchange" not in plan(wide) and "Bucketed: true" in plan(wide)
    want = features.daily_wide(daily, "serial_num", "day", list(days), names)
    assert sorted(map(str, wide.select(want.columns).collect())) == sorted(map(str, want.collect())) and wide.count() > 0


# --- redelivery ----------------------------------------------------------------


def test_a_message_succeeds_on_its_second_attempt(spark, tmp_path):
    inbox, known = tmp_path / "in", tmp_path / "known"
    inbox.mkdir()
    table, state, checkpoint = (str(tmp_path / x) for x in ("out", "state", "checkpoint"))

    def registry(*ids):
        spark.createDataFrame([(i,) for i in ids], "id int").write.mode("overwrite").parquet(str(known))

    def handle(due):
        rows = messages.decode(due.withColumn("text", F.col("value")), SCHEMA, "text")
        have = spark.read.schema("id int").parquet(str(known)).withColumn("ok", F.lit(True))
        return rows.join(have, "id", "left").select("value", "attempts", "id", "ok")

    def run():
        q = redelivery.receive_with_retries(messages.message_folder(spark, str(inbox)), handle, table, state, checkpoint, 3)
        q.awaitTermination()
        return str(q.id)

    def found(status):
        rows = redelivery.handled(spark, table, "value string, attempts int, id int", status)
        return sorted((r["value"], r["attempts"]) for r in rows.collect())

    SCHEMA = spark.createDataFrame([], "id int").schema
    registry(1)
    (inbox / "a").write_text('{"id": 1}\n{"id": 2}\n{"id": 2}\nbroken\n')
    stream = run()
    assert found("ok") == [('{"id": 1}', 1)] and found("dead") == []
    assert redelivery.waiting(spark, state, stream).count() == 3
    registry(1, 2)
    (inbox / "b").write_text('{"id": 3}\n')
    assert run() == stream
    assert found("ok") == [('{"id": 1}', 1), ('{"id": 2}', 2), ('{"id": 2}', 2)]
    assert redelivery.redeliver(spark, handle, table, state, stream) == 1  # 3 waits, the broken one is dead
    assert found("dead") == [("broken", 3)]
    assert redelivery.redeliver(spark, handle, table, state, stream) == 0
    assert found("dead") == [("broken", 3), ('{"id": 3}', 3)] and len(found("ok")) == 3


def test_a_batch_that_is_run_again_leaves_no_copies(spark, tmp_path):
    table, state = str(tmp_path / "out"), str(tmp_path / "state")
    due = spark.createDataFrame([("a", 0), ("b", 0)], redelivery.WAITING)
    handle = lambda rows: rows.withColumn("ok", F.col("value") == "a")
    for _ in range(2):
        redelivery._try(due, handle, 3, table, state, "s", redelivery._pass_name(0))
    for _ in range(2):  # the next batch reads what the last one left, not its own
        redelivery._try(redelivery.waiting(spark, state, "s", redelivery._pass_name(1)), handle, 3, table, state, "s", redelivery._pass_name(1))
    assert [tuple(r) for r in redelivery.waiting(spark, state, "s").collect()] == [("b", 2)]
    assert redelivery.handled(spark, table, redelivery.WAITING).count() == 1


# --- verified copies, files of parts ---------------------------------------------


def test_of_two_publishers_one_wins(spark, tmp_path):
    rows, target, won = stage(spark.range(5000).withColumn("x", F.col("id") % 7), "rows"), str(tmp_path / "t"), []
    threads = [threading.Thread(target=lambda: won.append(published.publish_verified(spark, rows, target))) for _ in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(won) == [False, True]
    assert published.read_published(spark, target, verify=True).count() == 5000
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("data-")]) == 1


def test_a_damaged_copy_is_noticed(spark, tmp_path, monkeypatch):
    rows, target = spark.range(100), str(tmp_path / "t")
    assert published.publish_verified(spark, rows, target)
    data = next((tmp_path / "t").glob("data-*"))
    next(data.glob("part-*.parquet")).unlink()
    with pytest.raises(published.Damaged):
        published.read_published(spark, target, verify=True)
    whole = published.fingerprint
    monkeypatch.setattr(published, "fingerprint", lambda df: whole(df if "Range" in plan(df) else df.limit(99)))
    other = str(tmp_path / "u")
    with pytest.raises(published.Damaged):
        published.publish_verified(spark, rows, other)
    assert published.manifest(spark, other) is None and not list((tmp_path / "u").glob("data-*"))


def test_fingerprints_ignore_order_only(spark):
    rows = spark.createDataFrame([(1, None, {"a": 1}), (None, 1, {"a": 2}), (1, 2, None)], "a int, b int, m map<string,int>")
    one = published.fingerprint(rows)
    assert one == published.fingerprint(rows.orderBy(F.desc("b")).repartition(3)) and one["rows"] == 3
    assert one != published.fingerprint(rows.union(rows))
    assert one != published.fingerprint(rows.select(F.col("b").alias("a"), F.col("a").alias("b"), "m"))
    assert published.fingerprint(rows.where("false"))["rows"] == 0


def test_one_file_of_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(published, "CHUNK", 64)
    df = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit('a "b", '), "id")).alias('na"me'))
    path = published.csv_from_parts(df.orderBy(F.desc("id")), str(tmp_path), "all.csv")
    with open(path, newline="") as file:
        found = list(csv.reader(file, escapechar="\\"))
    assert found[0] == ["id", 'na"me'] and [int(r[0]) for r in found[1:]] == list(range(999, -1, -1))
    assert published.csv_from_parts(df.where("false"), str(tmp_path), "all.csv", header=False) == path
    assert Path(path).read_bytes() == b"" and not [p for p in tmp_path.iterdir() if p.name.startswith("_")]
