"""Assembly of several days and exploration of numeric columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.session import stage

# Columns up to which a correlation matrix is one row of built-in aggregates.
FEW_COLUMNS = 8


def union_frames(frames: Sequence[DataFrame], positional: bool = False) -> DataFrame | None:
    """All rows of all frames; by column name unless ``positional``, None for no frame."""
    if not frames:
        return None
    if positional:
        return reduce(DataFrame.union, frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_rows(df: DataFrame) -> DataFrame:
    """Each distinct row once."""
    return df.dropDuplicates()


def keep_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose ``column`` is one of ``values``."""
    return df.where(F.col(column).isin(list(values)))


def one_day(
    df: DataFrame, label: str, columns: Sequence[str], drop: Sequence[str] = (), models: Sequence[str] | None = None,
    model_column: str = "dg_model_indiv", key: str | None = None,
) -> DataFrame:
    """A day's feature table: model filter, unneeded columns out, exact copies out, features suffixed.

    With ``key``, rows are dealt out by it first: removing copies and joining on it then move nothing more.
    """
    if models is not None:
        df = keep_values(df, model_column, models)
    df = df.drop(*drop)
    return dedup_rows(df.repartition(key) if key else df).withColumnsRenamed({c: f"{c}_{label}" for c in columns})


def daily_wide_join(days: dict[str, DataFrame], key: str, columns: Sequence[str], **options) -> DataFrame:
    """Days side by side for keys present on all of them; a key repeated on a day fans out."""
    frames = [one_day(df, label, columns, key=key, **options) for label, df in days.items()]
    return reduce(lambda a, b: a.join(b, key), frames)


def store_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key``, a file per bucket, and read it as such.

    Joins of such tables on the key, with equally many buckets, move nothing.  Distinct rows are stored: a row of
    several copies counts once.
    """
    dealt = dedup_rows(df.repartition(buckets, key))
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def bucketed_wide_join(days: dict[str, DataFrame], key: str, columns: Sequence[str]) -> DataFrame:
    """``daily_wide_join`` of tables that ``store_bucketed`` wrote: no rows are moved, whatever the number of days."""
    frames = [df.withColumnsRenamed({c: f"{c}_{label}" for c in columns}) for label, df in days.items()]
    return reduce(lambda a, b: a.join(b.hint("merge"), key), frames)


def daily_wide(df: DataFrame, key: str, day: str, days: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The same from one long table with one row per key and day, in a single aggregate."""
    on = {d: F.col(day) == F.lit(d).cast("date") for d in days}
    wide = (
        # The range is what the scan can use; the list says which days of it count.
        df.where(F.col(day).between(F.lit(min(days)).cast("date"), F.lit(max(days)).cast("date")))
        .where(F.col(day).isin([F.lit(d).cast("date") for d in days]))
        .groupBy(key)
        .agg(
            F.count_if(reduce(lambda a, b: a | b, on.values())).alias("__days"),
            *[F.max(F.when(cond, F.col(c))).alias(f"{c}_{d}") for d, cond in on.items() for c in columns],
        )
    )
    return wide.where(F.col("__days") == len(days)).drop("__days")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are set.

    Long form ``(col_a, col_b, r, n)`` with both halves and the diagonal, from
    one pass; ``r`` is null where a column does not vary.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    half = (few_comoments if len(columns) <= FEW_COLUMNS else comoments)(rows, columns)
    same = F.col("col_a") == F.col("col_b")
    spread = F.sqrt("m2_a") * F.sqrt("m2_b")
    r = F.when(spread > 0, F.when(same, F.lit(1.0)).otherwise(F.col("c") / spread)).alias("r")
    half = half.select("col_a", "col_b", r, "n")
    swapped = F.struct(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r", "n")
    cells = F.array(F.struct("col_a", "col_b", "r", "n"), swapped)
    return half.select(F.inline(F.when(same, F.slice(cells, 1, 1)).otherwise(cells)))


def few_comoments(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``comoments`` as one row of built-in aggregates; their number grows with the square of the columns."""
    cells = []
    for a, b in combinations_with_replacement(columns, 2):
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        n = F.count(F.when(both, F.lit(1)))
        m2_a, m2_b = (F.var_pop(F.when(both, F.col(x))) * n for x in (a, b))
        c = F.covar_pop(a, b) * n
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), n.alias("n"), m2_a.alias("m2_a"), m2_b.alias("m2_b"), c.alias("c")))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.array(*cells).alias("cells")).where("rows > 0").select(F.inline("cells"))


def comoments(rows: DataFrame, columns: Sequence[str], stripe: int = 64, cuts: int = 64) -> DataFrame:
    """``col_a, col_b, n, m2_a, m2_b, c`` of pairs of double columns: rows with both, squared deviations of each, co-moment.

    A batch of rows gives matrix products of its values and of the masks of values
    that are there; tasks add up batches, and their matrices are added up in a tree, ``cuts`` at a
    time.  What is moved (and written, level by level) is a matrix per task, in stripes of columns, not pairs per row.
    Values are taken relative to one of their batch, and matrices are put together by their means, so large
    offsets do no harm.  Pairs with a value that is not finite have co-moments that are not a number.
    """
    names, width = list(columns), len(columns)

    def of_batch(values, here):
        """n, mean of a, mean of b, squared deviations of a, of b, co-moment: each a matrix a by b."""
        finite = here & np.isfinite(values)
        first = finite.argmax(0)
        pivot = np.where(finite.any(0), values[first, np.arange(width)], 0.0)
        x, m = np.where(finite, values - pivot, 0.0), here.astype(np.float64)
        good = finite.astype(np.float64)
        n, s, q, p = m.T @ m, x.T @ good, (x * x).T @ good, x.T @ x
        some = np.maximum(good.T @ good, 1)
        m2, c = q - s * s / some, p - s * s.T / some
        for a, b in zip(*np.nonzero((m2 <= 1e-12 * q) & (q > 0))):  # it hardly varies: once more, exactly
            own = x[finite[:, a] & finite[:, b], a]
            m2[a, b] = ((own - own[0]) ** 2).sum() - (own - own[0]).sum() ** 2 / len(own)
        c[(m2 == 0) | (m2.T == 0)] = 0
        mean = pivot[:, None] + s / some
        bad = (here & ~finite).astype(np.float64)
        bad = (bad.T @ m + m.T @ bad) > 0
        m2[bad], c[bad] = np.nan, np.nan
        return np.stack([n, mean, mean.T, m2, m2.T, c])

    def plus(one, other):
        n = one[0] + other[0]
        share = other[0] / np.maximum(n, 1)
        da, db = (np.where(one[0] * other[0] > 0, other[k] - one[k], 0.0) for k in (1, 2))
        weight = one[0] * share
        means = [np.where(one[0] > 0, one[k] + d * share, other[k]) for k, d in ((1, da), (2, db))]
        return np.stack([n, *means, one[3] + other[3] + da * da * weight, one[4] + other[4] + db * db * weight, one[5] + other[5] + da * db * weight])

    schema = pa.schema([("stripe", pa.int32()), ("cut", pa.int32()), ("cells", pa.binary())])
    fields = "stripe int, cut int, cells binary"

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                here = np.stack([~batch.column(k).is_null().to_numpy(zero_copy_only=False) for k in range(width)], 1)
                values = np.stack([batch.column(k).fill_null(0.0).to_numpy(zero_copy_only=False) for k in range(width)], 1)
                made = of_batch(values, here)
                total = made if total is None else plus(total, made)
        if total is not None:
            cut = TaskContext.get().partitionId()
            parts = [total[:, k : k + stripe].tobytes() for k in range(0, width, stripe)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([cut] * len(parts), pa.int32()), pa.array(parts, pa.binary())], schema=schema
            )

    def added(table):
        total = None
        for cell in table.column("cells"):
            made = np.frombuffer(cell.as_buffer(), np.float64).reshape(6, -1, width)
            total = made if total is None else plus(total, made)
        return total

    def merge(key, table):
        cells = added(table).tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([cells], pa.binary())], schema=schema)

    half = pa.schema([("col_a", pa.string()), ("col_b", pa.string()), ("n", pa.int64()), *[(x, pa.float64()) for x in ("m2_a", "m2_b", "c")]])

    def finish(key, table):
        total, first = added(table), key[0].as_py() * stripe
        a, b = np.nonzero(np.arange(first, first + total.shape[1])[:, None] <= np.arange(width))
        n, _, _, m2_a, m2_b, c = (x[a, b] for x in total)
        label = lambda at: pa.array([names[k] for k in at.tolist()], pa.string())
        return pa.table([label(a + first), label(b), pa.array(n.astype(np.int64)), pa.array(m2_a), pa.array(m2_b), pa.array(c)], schema=half)

    partials = stage(rows.mapInArrow(partial, fields), "comoments")
    while (partials.agg(F.max("cut")).first()[0] or 0) >= cuts:
        partials = partials.withColumn("cut", F.floor(F.col("cut") / cuts).cast("int"))
        partials = stage(partials.groupBy("stripe", "cut").applyInArrow(merge, fields), "comoments")
    return partials.groupBy("stripe").applyInArrow(finish, "col_a string, col_b string, n long, m2_a double, m2_b double, c double")


def correlation_wide(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The long correlation matrix with one column per variable."""
    return matrix.groupBy(F.col("col_a").alias("column")).pivot("col_b", list(columns)).agg(F.first("r"))
