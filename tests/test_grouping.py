"""Group operators against the plain window form, on skewed and tied data."""

import pytest
from compare import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.operators import grouping as G


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert rows([tuple(r) for r in a.collect()], a.columns) == rows([tuple(r) for r in b.collect()], b.columns)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one home, many equal values, null keys and null values."""
    r = lambda seed: F.rand(seed)
    return (
        spark.range(6000)
        .select(
            "id",
            F.when(r(1) < 0.33, "hot").when(r(2) < 0.02, None).otherwise(F.concat(F.lit("h"), (r(3) * 600).cast("int"))).alias("home"),
            F.when(r(4) < 0.2, None).when(r(5) < 0.3, 0).otherwise((r(6) * 1000).cast("int")).cast("decimal(38,0)").alias("bytes"),
            F.when(r(7) < 0.9, (r(8) * 7).cast("int") / 2).alias("score"),
            (r(9) < 0.7).alias("fast"),
        )
        .cache()
    )


def test_record_count(skewed):
    w = Window.partitionBy("home")
    same(G.group_record_count(skewed, ["home"]), skewed.withColumn("record_count", F.count(F.lit(1)).over(w)))


@pytest.mark.parametrize("width", [0.5, 50, 10_000])
def test_rank_within(skewed, width):
    w = Window.partitionBy("home").orderBy(F.desc_nulls_last("bytes"))
    same(G.rank_within(skewed, ["home"], "bytes", width, "place"), skewed.withColumn("place", F.rank().over(w)))


@pytest.mark.parametrize("k", [1, 5])
def test_top_rest_averages(skewed, k):
    def naive(df, name):
        ranked = df.withColumn("place", F.rank().over(Window.partitionBy("home").orderBy(F.desc_nulls_last("bytes"))))
        return ranked.groupBy("home").agg(
            F.avg(F.when(F.col("place") <= k, F.col("score"))).alias(f"{name}_top"),
            F.avg(F.when(F.col("place") > k, F.col("score"))).alias(f"{name}_rest"),
        )

    got = G.top_rest_averages(
        skewed, ["home"], "bytes", {"all": (F.lit(True), F.col("score")), "fast": (F.col("fast"), F.col("score"))}, ["id"], k
    )
    wanted = G.attach(naive(skewed, "all"), naive(skewed.where("fast"), "fast"), ["home"])
    same(got, wanted)


def test_ties_at_the_border_all_count_as_top(spark):
    values = [90, 80, 70, 60, 50, 50, 50, 10]
    df = spark.createDataFrame([("h", i, v, float(i)) for i, v in enumerate(values)], "home string, id int, bytes int, score double")
    row = G.top_rest_averages(df, ["home"], "bytes", {"s": (F.lit(True), F.col("score"))}, ["id"]).first()
    assert (row["s_top"], row["s_rest"]) == (3.0, 7.0)


def test_unknown_bytes_share_the_last_rank(spark):
    df = spark.createDataFrame([("h", i, None, float(i)) for i in range(9)], "home string, id int, bytes int, score double")
    row = G.top_rest_averages(df, ["home"], "bytes", {"s": (F.lit(True), F.col("score"))}, ["id"]).first()
    assert (row["s_top"], row["s_rest"]) == (4.0, None)


@pytest.mark.parametrize("n, kept", [(8, 0), (9, 1), (10, 1)])
def test_gate(spark, n, kept):
    df = spark.range(n).select(F.lit("a").alias("k"), "id")
    assert G.gated(df, ["k"], F.max("id").alias("m")).count() == kept


def test_percentiles_match_exact_on_small_groups(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.rand(3).alias("x"))
    exact = "percentile_disc({}) within group (order by x)"
    row = df.groupBy("k").agg(
        G.percentiles("x", 0.03, 0.5, 0.9).alias("p"), F.array(*[F.expr(exact.format(p)) for p in (0.03, 0.5, 0.9)]).alias("q")
    )
    assert row.where("p <> q").count() == 0
