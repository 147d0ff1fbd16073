"""Freshness rules on hand-made datasets."""

import datetime as dt

import pytest

from fleetlens.operators import freshness as R

AS_OF = "2025-01-22"  # a Wednesday


def day(text):
    return dt.date.fromisoformat(text)


def registry(spark, *rows_):
    return spark.createDataFrame(rows_, "name string, expect_delay int, calendar string")


def observed(spark, **days):
    return spark.createDataFrame([(n, day(d)) for n, ds in days.items() for d in ds], "name string, observed_date date")


def missing(spark, reg, obs, span, **options):
    return sorted(str(r["missing_day"]) for r in R.missing_days(reg, obs, AS_OF, span, **options).collect())


def test_windows():
    assert [R.window(v) for v in ("file_drop", "folder", "folder_short", "table")] == [(0, 20), (1, 21), (1, 20), (0, 19)]


def test_span_is_counted_from_the_expected_day(spark):
    reg = registry(spark, ("a", 2, "daily"))
    obs = observed(spark, a=["2025-01-19"])
    assert missing(spark, reg, obs, (0, 2)) == ["2025-01-18", "2025-01-20"]
    assert missing(spark, reg, obs, (1, 3)) == ["2025-01-17", "2025-01-18"]


@pytest.mark.parametrize("delay", [30, 0, -5])
def test_days_of_any_delay_are_found(spark, delay):
    reg = registry(spark, ("a", delay, "daily"), ("b", 3, "daily"))
    day_ = lambda n: str(dt.date(2025, 1, 22) - dt.timedelta(days=delay + n))
    obs = observed(spark, a=[day_(0), day_(2)], b=[f"2025-01-{d}" for d in (17, 18, 19)])
    assert missing(spark, reg, obs, (0, 2)) == [day_(1)]


def test_nothing_registered(spark):
    reg, obs = registry(spark, ("a", 1, "daily")).where("false"), observed(spark, a=["2025-01-20"])
    assert missing(spark, reg, obs, (0, 2)) == [] and R.report(reg, obs, AS_OF, (0, 2)).collect() == []


def test_report_finds_the_latest_day_outside_the_span(spark):
    reg = registry(spark, ("old", 0, "daily"), ("ahead", 0, "daily"), ("a", 0, "daily"))
    obs = observed(spark, old=["2024-03-01", "2024-02-01"], ahead=["2025-02-01", "2025-01-21"], a=["2025-01-22"])
    out = {r["name"]: r for r in R.report(reg, obs, AS_OF, (0, 2)).collect()}
    assert (out["old"]["latest_date"], len(out["old"]["miss_days"])) == (day("2024-03-01"), 3)
    assert (out["ahead"]["delayed_days"], len(out["ahead"]["miss_days"])) == (-10, 2)


def test_a_calendar_for_each_side(spark):
    reg = registry(spark, ("a", 0, "daily")).selectExpr("*", "'business' as folder_calendar")
    seen = observed(spark, a=["2025-01-22"])
    row = R.paired_report(reg, seen, seen, AS_OF, (0, 6), (0, 6), folder_calendar="folder_calendar").first()
    assert (len(row["table_miss_days"]), len(row["folder_miss_days"])) == (6, 4)


def test_drops_that_share_a_folder(spark):
    drops = spark.createDataFrame([("s", "in", "sales_{}.csv"), ("t", "in", "{}"), ("u", "in", "fixed.csv")], "name string, folder string, template string")
    names = ["sales_2025-01-05.csv", "sales_20250106.csv", "sales_20250106.csv.bak", "presales_20250107.csv", "sales_20250231.csv", "20250108", "fixed.csv"]
    entries = spark.createDataFrame([("in", n) for n in names] + [("other", "20250101")], "folder string, entry string")
    found = {(r["name"], str(r["observed_date"])) for r in R.days_of_drops(entries, drops).collect()}
    assert found == {("s", "2025-01-05"), ("s", "2025-01-06"), ("t", "2025-01-08")}


def test_days_among_other_numbers(spark):
    names = {"12345678_2024-01-06.csv": "2024-01-06", "20250230_20250105": "2025-01-05", "x202501051": None, "1-2025-01-05": "2025-01-05", "20250105": "2025-01-05", "none": None}
    entries = spark.createDataFrame([("a", n) for n in names], "name string, entry string")
    found = {r["entry"]: str(r["observed_date"]) for r in R.days_in_names(entries).collect()}
    assert found == {n: d for n, d in names.items() if d}


def test_business_calendar(spark):
    reg = registry(spark, ("a", 1, "business"), ("b", 1, "daily"))
    obs = observed(spark, b=[f"2025-01-{d}" for d in range(14, 22)])
    # 18 and 19 January are a weekend, the 15th is excluded.
    assert missing(spark, reg, obs, (0, 6), excluded=["2025-01-15"]) == [f"2025-01-{d}" for d in (16, 17, 20, 21)]


def test_delay(spark):
    reg = registry(spark, ("late", 1, "daily"), ("early", 3, "daily"), ("never", 0, "daily"))
    obs = observed(spark, late=["2025-01-10", "2025-01-18"], early=["2025-01-21"])
    out = {r["name"]: (r["latest_date"], r["delayed_days"]) for r in R.delay(reg, R.latest(obs), AS_OF).collect()}
    assert out == {"late": (day("2025-01-18"), 3), "early": (day("2025-01-21"), -2), "never": (None, None)}


def test_latest_in_a_file_drop_looks_back_from_today(spark):
    obs = observed(spark, a=["2025-01-23", "2025-01-03"], old=["2025-01-01"])
    out = {r["name"]: r["latest_date"] for r in R.latest(obs, AS_OF, 20).collect()}
    assert out == {"a": day("2025-01-03")}


def test_report_keeps_datasets_never_seen(spark):
    reg = registry(spark, ("a", 0, "daily"), ("never", 0, "daily"), ("full", 0, "daily"))
    obs = observed(spark, a=["2025-01-20"], full=["2025-01-20", "2025-01-21", "2025-01-22"])
    out = {r["name"]: r for r in R.report(reg, obs, AS_OF, (0, 2)).collect()}
    assert out["a"]["miss_days"] == [day("2025-01-22"), day("2025-01-21")]
    assert out["full"]["miss_days"] == []
    assert (out["never"]["latest_date"], out["never"]["delayed_days"], len(out["never"]["miss_days"])) == (None, None, 3)


def test_paired_report(spark):
    reg = registry(spark, ("a", 0, "daily"))
    out = R.paired_report(reg, observed(spark, a=["2025-01-22"]), observed(spark, a=["2025-01-20"]), AS_OF)
    row = out.first()
    assert out.columns == [
        "name", "table_latest_date", "table_delayed_days", "table_miss_days",
        "folder_latest_date", "folder_delayed_days", "folder_miss_days",
    ]
    assert (row["table_delayed_days"], row["folder_delayed_days"]) == (0, 2)
    assert (len(row["table_miss_days"]), len(row["folder_miss_days"])) == (19, 20)


def test_days_in_names_with_a_pattern_per_dataset(spark):
    entries = spark.createDataFrame(
        [("a", "x-2025-01-05", "dashed"), ("a", "x-20250106", "dashed"), ("b", "20250107", "compact"), ("b", "readme", "compact")],
        "name string, entry string, date_pattern string",
    )
    assert {(r["name"], str(r["observed_date"])) for r in R.days_in_names(entries).collect()} == {("a", "2025-01-05"), ("b", "2025-01-07")}


def test_latest_file_breaks_ties_by_name(spark):
    entries = spark.createDataFrame([("a", "y-20250105"), ("a", "x-2025-01-05"), ("a", "a-2025-01-04")], "name string, entry string")
    assert [tuple(r) for r in R.latest_file(entries).collect()] == [("a", day("2025-01-05"), "x-2025-01-05")]


@pytest.mark.parametrize("n, days", [(1, ["2025-01-03"]), (5, ["2025-01-03", "2025-01-01"])])
def test_one_table(spark, n, days):
    df = spark.sql("select explode(array(timestamp'2025-01-01 05:00', timestamp'2025-01-03 23:59:59', timestamp'2025-01-03')) as ts")
    assert [r["day"] for r in R.distinct_days(df, "ts", n).collect()] == days
    assert [tuple(r) for r in R.latest_day_rowcount(df, "ts").collect()] == [("2025-01-03", 2)]
