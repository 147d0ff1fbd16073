"""Daily jobs: the availability report and the wide feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators import features, freshness
from fleetlens.sources import files


def availability(
    spark: SparkSession,
    registry: DataFrame,
    folders: Mapping[str, str],
    tables: Mapping[str, tuple[DataFrame, str]],
    as_of: str | Column | None = None,
    excluded: Sequence[str] = (),
    lookback: int = freshness.LOOKBACK,
) -> tuple[DataFrame, DataFrame]:
    """Reports on the datasets that have a table (beside its folder) and on those that have a folder only.

    ``folders`` maps dataset names to folders with a day in the names of their
    entries, ``tables`` to a table (see ``sources.files.read_table``) and its
    time column.  A registry column ``date_pattern`` names the format of a
    dataset's folder entries.  ``as_of`` defaults to today.
    """
    today = F.current_date() if as_of is None else as_of
    entries = files.list_names(spark, folders)
    if "date_pattern" in registry.columns:
        entries = entries.join(registry.select("name", "date_pattern"), "name")
    in_folders = freshness.days_in_names(entries).select("name", "observed_date")
    in_tables = [files.observed_in_table(df, name, ts) for name, (df, ts) in tables.items()]
    in_tables = reduce(DataFrame.union, in_tables, spark.createDataFrame([], "name string, observed_date date"))

    with_table = F.col("name").isin(list(tables))
    folder_only = registry.where(F.col("name").isin([n for n in folders if n not in tables]))
    spans = {kind: freshness.window(kind, lookback) for kind in ("table", "folder")}
    return (
        freshness.paired_report(
            registry.where(with_table), in_tables, in_folders, today, spans["table"], spans["folder"], excluded
        ),
        freshness.report(folder_only, in_folders, today, spans["folder"], excluded),
    )


def wide_features(
    spark: SparkSession,
    main: DataFrame,
    pattern: str,
    day: date,
    key: str,
    columns: Sequence[str],
    drop: Sequence[str] = (),
    models: Sequence[str] | None = None,
    days: int = 7,
) -> DataFrame | None:
    """``main`` joined with the features of each of the ``days`` days before ``day``.

    ``pattern`` gives the folder of an ISO day.  Days without a folder are
    skipped; None if there is none.
    """
    labels = [(day - timedelta(days=i)).isoformat() for i in range(1, days + 1)]
    found = {label: files.read_tolerant(spark, pattern, [label]) for label in labels}
    found = {label: df for label, df in found.items() if df is not None}
    if not found:
        return None
    return main.join(features.daily_wide_join(found, key, columns, drop=drop, models=models), key)
