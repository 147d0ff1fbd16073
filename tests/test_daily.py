import datetime as dt
import os

from fleetlens.plans.daily import availability, wide_features


def test_availability(spark, tmp_path):
    for name, entries in {"a": ["2025-01-20", "2025-01-22"], "b": ["20250121", "2025-01-22"]}.items():
        for e in entries:
            os.makedirs(f"{tmp_path}/{name}/{e}")
    registry = spark.createDataFrame(
        [("a", 0, "daily", "dashed"), ("b", 1, "daily", "compact"), ("lost", 0, "daily", "dashed")],
        "name string, expect_delay int, calendar string, date_pattern string",
    )
    table = spark.sql("select timestamp'2025-01-21 10:00' as ts")
    paired, single = availability(
        spark, registry, {n: f"{tmp_path}/{n}" for n in ("a", "b", "lost")}, {"a": (table, "ts")}, "2025-01-22", lookback=2
    )
    row = paired.first()
    assert (row["name"], row["table_delayed_days"], row["folder_delayed_days"]) == ("a", 1, 0)
    assert [str(d) for d in row["table_miss_days"]] == ["2025-01-22"]
    assert [str(d) for d in row["folder_miss_days"]] == ["2025-01-21", "2025-01-19"]
    out = {r["name"]: (r["delayed_days"], len(r["miss_days"])) for r in single.collect()}
    assert out == {"b": (0, 3), "lost": (None, 3)}
    today, _ = availability(spark, registry, {"a": f"{tmp_path}/a"}, {"a": (table, "ts")})
    assert today.first()["table_delayed_days"] > 0


def test_wide_features(spark, tmp_path):
    for d, keys in {"2025-01-09": "ab", "2025-01-08": "abc"}.items():
        rows = [(k, 1, "X") for k in keys] + [("z", 1, "other")]
        spark.createDataFrame(rows, "serial_num string, home_score int, dg_model_indiv string").write.parquet(f"{tmp_path}/{d}")
    main = spark.createDataFrame([("a", 5.0), ("c", 6.0), ("z", 7.0)], "serial_num string, before double")
    make = lambda pattern: wide_features(
        spark, main, pattern, dt.date(2025, 1, 10), "serial_num", ["home_score"], ["dg_model_indiv"], ["X"], days=3
    )
    out = make(f"{tmp_path}/{{}}")
    assert out.columns == ["serial_num", "before", "home_score_2025-01-09", "home_score_2025-01-08"]
    assert [tuple(r) for r in out.collect()] == [("a", 5.0, 1, 1)]
    assert make(f"{tmp_path}/none/{{}}") is None
