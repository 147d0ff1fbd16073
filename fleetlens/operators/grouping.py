"""Group statistics, ranks and top-k averages that hold up when one group is huge.

A window over ``partitionBy(key)`` sends every row of a key to one task.  The
functions here first shrink each group by a map-side aggregate and only then
bring its (bounded) remains together; per-group results go back to the rows by
an equi-join, which adaptive execution may broadcast or split by skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: groups with fewer records than this are not scored.
MIN_RECORDS = 9

# Sub-groups a group is cut into before its parts are brought together, unless told otherwise.
CUTS = 64

# Rows of a group that one task may hold, unless told otherwise.
LARGE = 1_000_000

# Ranges that the values of a group are ranked in, unless told otherwise.
RANGES = 64

# Accuracy of percentiles, unless told otherwise: groups of up to half as many values are exact.
ACCURACY = 10_000


def in_band(band: str, value: Column | str, col: str = "band") -> Column:
    """``value`` on rows whose band starts with ``band``, null elsewhere."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(col).startswith(band), value)


def percentiles(value: Column | str, *fractions: float, accuracy: int = ACCURACY) -> Column:
    """Approximate percentiles of a group as one array, from one sketch.

    The sketch is built map-side and bounded by ``accuracy``; groups smaller
    than ``accuracy / 2`` are exact.
    """
    return F.percentile_approx(value, [float(f) for f in fractions], accuracy)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Add the columns of a one-row-per-key table to the rows of ``df``; null keys match."""
    right = stats.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(right[f"__{k}"]) for k in keys])
    return df.join(right, on, how).drop(*[f"__{k}" for k in keys])


def large_groups(df: DataFrame, group: Column, large: int) -> dict[int, int]:
    """Groups (by the hash ``group``) that may have more than ``large`` rows, and in how many cuts they fall apart.

    From one frequent-items sketch of at most 4,096 groups, which may overestimate a
    group; one of more than ``large`` rows is missed only in a table of over 2,000 such groups, where no
    single one weighs much.  A table of no more than ``large`` rows is not looked at.
    """
    if df.limit(large + 1).count() <= large:
        return {}
    found = df.select(group.alias("g")).agg(F.expr("approx_top_k(g, 2048, 4096)").alias("top")).first()["top"]
    return {x["item"]: -(-x["count"] // large) for x in found if x["count"] > large}


def group_record_count(df: DataFrame, keys: Sequence[str], name: str = "record_count") -> DataFrame:
    """Every row with the size of its group, by a join; ``df`` is computed twice, a stage or a scan say."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return attach(df, sizes, keys, "inner")


def record_count_by_cuts(df: DataFrame, keys: Sequence[str], name: str = "record_count", large: int = LARGE) -> DataFrame:
    """The same for rows that are costly to compute, which are moved once.

  Groups of more than ``large`` rows, found by a sketch of the keys, are cut into
    several tasks and get their size from a count of their own.
    """
    group = F.xxhash64(*keys)
    cuts = large_groups(df, group, large)
    rows = df.withColumn("__group", group)
    if not cuts:
        sizes = F.count(F.lit(1)).over(Window.partitionBy("__group", *keys))
        return rows.repartition("__group").withColumn(name, sizes).drop("__group")
    many = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    cut = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.try_element_at(many, F.col("__group"))), F.lit(0))
    rows = rows.withColumn("__cut", cut).repartition("__group", "__cut")
    rows = rows.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy("__group", "__cut", *keys)))
    is_large = F.col("__group").isin(list(cuts))
    own = df.withColumn("__group", group).where(is_large).groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    whole = attach(rows, F.broadcast(own), keys)  # no more rows than the sketch has groups, or hashes that meet
    return whole.withColumn(name, F.coalesce("__size", name)).drop("__group", "__cut", "__size")


def gated(df: DataFrame, keys: Sequence[str], *aggs: Column, min_records: int = MIN_RECORDS) -> DataFrame:
    """Aggregate the groups that have at least ``min_records`` rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), *aggs)
        .where(F.col("__n") >= min_records)
        .drop("__n")
    )


def range_bounds(values: DataFrame, keys: Sequence[str], order: str, ranges: int, accuracy: int = ACCURACY) -> DataFrame:
    """``keys`` and ``__bounds``: the values that cut the rows of each group into ``ranges`` of about equal size."""
    cuts = [k / ranges for k in range(1, ranges)]
    return values.groupBy(*keys).agg(F.array_distinct(percentiles(order, *cuts, accuracy=accuracy)).alias("__bounds"))


def rank_within(
    df: DataFrame, keys: Sequence[str], order: str, width: float | None, name: str, ranges: int = RANGES, accuracy: int = ACCURACY
) -> DataFrame:
    """``rank()`` by ``order`` descending within ``keys``: ties share a rank, nulls come last.

    Equal values are counted map-side, the distinct values are ranked inside value ranges, and the sizes of
    the higher ranges are added.  Ranges have the given ``width``, or without one hold about equally many
    distinct values: their bounds come from a quantile sketch of the group, so however values are
    spread, no task sees more of a group than about one ``ranges``-th (and 1 / ``accuracy`` more).
    """
    values = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("__n"))
    if width is not None:
        values = values.withColumn("__bucket", F.floor(F.col(order) / F.lit(width)))
    else:
        values = attach(values, range_bounds(values, keys, order, ranges, accuracy), keys, "inner")
        above = F.size(F.filter("__bounds", lambda b: b <= F.col(order)))
        values = values.withColumn("__bucket", F.when(F.col(order).isNotNull(), above)).drop("__bounds")

    above_in_bucket = (
        Window.partitionBy(*keys, "__bucket").orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
    )
    above_buckets = (
        Window.partitionBy(*keys)
        .orderBy(F.col("__bucket").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        values.groupBy(*keys, "__bucket")
        .agg(F.sum("__n").alias("__size"))
        .select(*keys, "__bucket", F.coalesce(F.sum("__size").over(above_buckets), F.lit(0)).alias("__above"))
    )
    local = values.select(
        *keys, order, "__bucket", F.coalesce(F.sum("__n").over(above_in_bucket), F.lit(0)).alias("__local")
    )
    ranks = attach(local, offsets, [*keys, "__bucket"], "inner").select(
        *keys, order, (F.col("__above") + F.col("__local") + 1).cast("int").alias(name)
    )
    return attach(df, ranks, [*keys, order], "inner")


def top_rest_averages(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    scores: dict[str, tuple[Column, Column]],
    spread: Sequence[str],
    k: int = 5,
    cuts: int = CUTS,
) -> DataFrame:
    """Per group and score: average of the rows ranked 1..k by ``order`` and of all others.

    ``scores`` maps an output prefix to ``(member, score)``; rows that are no
    member neither count nor rank for that score.  Ranks are those of ``rank()``
    descending, nulls last.  Output columns are ``<prefix>_top`` and
    ``<prefix>_rest``, null where no row has a score.

    Each group is cut by a hash of ``spread``.  A value among the k best of its
    group is among the k best distinct values of its cut, so every cut folds
    what lies below into one row; at most ``cuts * (k + 1)`` short rows of a
    group and score then meet in one task.  More ``cuts`` spread a huge group over more tasks.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(cuts)).cast("int").alias("__salt")
    kinds = F.array(
        *[
            F.struct(F.lit(prefix).alias("__kind"), member.alias("__member"), score.cast("double").alias("__score"))
            for prefix, (member, score) in scores.items()
        ]
    )
    rows = df.select(*keys, F.col(order).alias("__value"), salt, F.inline(kinds)).where("__member")

    in_cut = Window.partitionBy("__kind", *keys, "__salt").orderBy(F.col("__value").desc_nulls_last())
    folded = (
        rows.withColumn("__place", F.least(F.dense_rank().over(in_cut), F.lit(k + 1)))
        .groupBy("__kind", *keys, "__salt", "__place")
        .agg(
            F.max("__value").alias("__value"),
            F.sum("__score").alias("__sum"),
            F.count("__score").alias("__scored"),
            F.count(F.lit(1)).alias("__n"),
        )
    )
    # One exchange on the group key serves the merge, the ranking and the averages.
    tail = (F.col("__place") > k).alias("__tail")
    merged = (
        folded.repartition(*keys)
        .groupBy("__kind", *keys, tail, F.when(~tail, F.col("__value")).alias("__value"))
        .agg(F.sum("__sum").alias("__sum"), F.sum("__scored").alias("__scored"), F.sum("__n").alias("__n"))
    )
    above = (
        Window.partitionBy("__kind", *keys)
        .orderBy("__tail", F.col("__value").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = merged.withColumn("__above", F.coalesce(F.sum("__n").over(above), F.lit(0)))
    top = ~F.col("__tail") & (F.col("__above") < k)

    def average(part: Column, prefix: str) -> Column:
        mine = part & (F.col("__kind") == prefix)
        total, scored = (F.sum(F.when(mine, F.col(c))) for c in ("__sum", "__scored"))
        return total / F.nullif(scored, F.lit(0))

    return ranked.groupBy(*keys).agg(
        *[average(top, p).alias(f"{p}_top") for p in scores],
        *[average(~top, p).alias(f"{p}_rest") for p in scores],
    )
