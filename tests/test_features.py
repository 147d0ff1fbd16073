import math

import pandas as pd
import pytest

from fleetlens.operators import features


def test_union(spark):
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, 4)], "y int, x int")
    assert sorted(map(tuple, features.union_frames([a, b]).collect())) == [(1, 2), (4, 3)]
    assert sorted(map(tuple, features.union_frames([a, b], positional=True).collect())) == [(1, 2), (3, 4)]
    assert features.union_frames([]) is None


def test_one_day(spark):
    df = spark.createDataFrame([("s", 1, "A", "x"), ("s", 1, "A", "y"), ("t", 2, "B", "x")], "serial_num string, home_score int, dg_model_indiv string, mdn string")
    out = features.one_day(df, "2025-01-01", ["home_score"], drop=["mdn", "dg_model_indiv"], models=["A"])
    assert out.columns == ["serial_num", "home_score_2025-01-01"] and [tuple(r) for r in out.collect()] == [("s", 1)]


DAYS = ["2025-01-01", "2025-01-02", "2025-01-03"]


def _frame(spark, rows_):
    return spark.createDataFrame(rows_, "k string, day string, v int").selectExpr("k", "cast(day as date) as day", "v")


def test_wide_forms_agree(spark):
    rows_ = [(f"k{k}", d, k * 10 + i if k % 5 else None) for k in range(40) for i, d in enumerate(DAYS) if (k * 7 + i * 3) % 4]
    df = _frame(spark, rows_)
    per_day = {d: df.where(f"day = date'{d}'") for d in DAYS}
    joined = features.daily_wide_join(per_day, "k", ["v"], drop=["day"])
    wide = features.daily_wide(df, "k", "day", DAYS, ["v"])
    assert wide.columns == joined.columns
    assert sorted(map(str, wide.collect())) == sorted(map(str, joined.collect())) and wide.count() > 0


def test_wide_join_fans_out_on_repeated_keys(spark):
    df = _frame(spark, [("a", d, v) for d in DAYS for v in (1, 2)] + [("a", DAYS[0], 1)])
    per_day = {d: df.where(f"day = date'{d}'") for d in DAYS}
    assert features.daily_wide_join(per_day, "k", ["v"], drop=["day"]).count() == 8


def test_correlation_matches_pandas(spark):
    pdf = pd.DataFrame(
        {"a": [1.0, 2.0, None, 4.0, 8.0], "b": [2.0, 1.0, 5.0, None, 3.0], "c": [7.0] * 5, "d": [None] * 4 + [1.0]}
    )
    wanted = pdf.corr()
    rows_ = [tuple(None if x is None or math.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows_, "a double, b double, c double, d double")
    long = features.correlation_matrix(df, list(pdf.columns))
    got = {(r["col_a"], r["col_b"]): r["r"] for r in long.collect()}
    assert len(got) == 16
    for (a, b), r in got.items():
        expected = wanted.loc[a, b]
        assert r is None if math.isnan(expected) else r == pytest.approx(expected)
    wide = features.correlation_wide(long, list(pdf.columns))
    assert wide.columns == ["column", "a", "b", "c", "d"] and wide.count() == 4
