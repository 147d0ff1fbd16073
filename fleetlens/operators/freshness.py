"""Freshness of datasets: latest day, delay and missing days.

All checks take observed days as a DataFrame ``(name, observed_date)``, whatever
they were read from, and a registry ``(name, expect_delay, calendar)``.  The
expected day of a dataset is ``as_of - expect_delay``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import clean

# Fixed value: days that a check looks back.
LOOKBACK = 20


def window(variant: str, lookback: int = LOOKBACK) -> tuple[int, int]:
    """Days probed, as (first, last) days before the expected day."""
    return {
        "file_drop": (0, lookback),
        "folder": (1, lookback + 1),
        "folder_short": (1, lookback),
        "table": (0, lookback - 1),
    }[variant]


def _as_day(day: Column | str) -> Column:
    return F.lit(day).cast("date") if isinstance(day, str) else day


def days_in_names(entries: DataFrame, pattern: str | None = None) -> DataFrame:
    """``(name, entry, observed_date)`` of the entries with a day in their name.

    ``pattern`` is one of ``clean.DAY_PATTERNS``; without it the pattern is read
    from the column ``date_pattern``, or any format is accepted.
    """
    if pattern is None and "date_pattern" in entries.columns:
        day = F.coalesce(
            *[F.when(F.col("date_pattern") == p, clean.day_in_name("entry", p)) for p in clean.DAY_PATTERNS]
        )
    else:
        day = clean.day_in_name("entry", pattern or "either")
    return entries.select("name", "entry", day.alias("observed_date")).where(F.col("observed_date").isNotNull())


def days_of_drops(entries: DataFrame, drops: DataFrame) -> DataFrame:
    """``(name, entry, observed_date)`` of the files of each drop.

    ``entries`` are ``(folder, entry)``, ``drops`` ``(name, folder, template)`` with ``{}`` for
    the day, so that several drops may share a folder.
    """
    found = entries.join(drops.select("name", "folder", "template"), "folder")
    day = clean.day_by_template("entry", "template")
    return found.select("name", "entry", day.alias("observed_date")).where(F.col("observed_date").isNotNull())


def observed_days(observed: DataFrame) -> DataFrame:
    """Distinct days per dataset."""
    return observed.select("name", "observed_date").distinct()


def latest(observed: DataFrame, as_of: str | None = None, lookback: int | None = None) -> DataFrame:
    """Latest day per dataset; with ``as_of`` and ``lookback`` only days in that span count."""
    if as_of is not None:
        day = _as_day(as_of)
        observed = observed.where(F.col("observed_date") <= day)
        if lookback is not None:
            observed = observed.where(F.col("observed_date") >= F.date_sub(day, lookback))
    return observed.groupBy("name").agg(F.max("observed_date").alias("latest_date"))


def latest_file(entries: DataFrame, pattern: str | None = None) -> DataFrame:
    """Latest day per dataset and the first entry, by name, that carries it."""
    return (
        days_in_names(entries, pattern)
        .groupBy("name", "observed_date")
        .agg(F.min("entry").alias("entry"))
        .groupBy("name")
        .agg(
            F.max("observed_date").alias("latest_date"),
            F.max_by("entry", "observed_date").alias("latest_file"),
        )
    )


def _expected(as_of: Column | str) -> Column:
    return F.date_sub(_as_day(as_of), F.col("expect_delay"))


def delay(registry: DataFrame, latest_days: DataFrame, as_of: Column | str) -> DataFrame:
    """Days between the expected and the latest day: negative if early, null if nothing was ever seen."""
    return registry.join(latest_days, "name", "left").select(
        "name",
        _expected(as_of).alias("expect_date"),
        "latest_date",
        F.datediff(_expected(as_of), "latest_date").alias("delayed_days"),
    )


def _open_day(day: Column, excluded: Sequence[str]) -> Column:
    workday = F.weekday(day) < 5
    return workday & ~day.isin([F.lit(d).cast("date") for d in excluded]) if excluded else workday


def _calendar(column: str) -> Column:
    """A dataset without a calendar is expected daily."""
    return F.coalesce(F.col(column), F.lit("daily"))


def probed_days(as_of: Column | str, span: tuple[int, int], calendar_column: str, excluded: Sequence[str] = ()) -> Column:
    """The days to probe of a dataset, newest first."""
    first, last = span
    days = F.reverse(F.sequence(F.date_sub(_expected(as_of), last), F.date_sub(_expected(as_of), first)))
    workdays = F.filter(days, lambda d: _open_day(d, excluded))
    return F.when(_calendar(calendar_column) == "business", workdays).otherwise(days)


def delayed_days(as_of: Column | str) -> Column:
    return F.datediff(_expected(as_of), "latest_date")


def calendar(registry: DataFrame, as_of: Column | str, span: tuple[int, int], excluded: Sequence[str] = ()) -> DataFrame:
    """``(name, day)`` to probe; business calendars leave out weekends and ``excluded`` days."""
    first, last = span
    days = registry.select(
        "name",
        "calendar",
        F.explode(F.sequence(F.date_sub(_expected(as_of), last), F.date_sub(_expected(as_of), first))).alias("day"),
    )
    probed = (_calendar("calendar") != "business") | _open_day(F.col("day"), excluded)
    return days.where(probed).select("name", "day")


def probed_span(registry: DataFrame, as_of: Column | str, span: tuple[int, int]) -> tuple[date, date] | None:
    """First and last day that any dataset is probed on, from one small aggregate of the registry."""
    first, last = span
    row = registry.agg(
        F.min(F.date_sub(_expected(as_of), last)).alias("oldest"), F.max(F.date_sub(_expected(as_of), first)).alias("newest")
    ).first()
    return (row["oldest"], row["newest"]) if row["oldest"] else None


def missing_days(
    registry: DataFrame, observed: DataFrame, as_of: Column | str, span: tuple[int, int], excluded: Sequence[str] = ()
) -> DataFrame:
    """``(name, missing_day)``: probed days on which the dataset was not seen.

    Only days that some dataset is probed on are read of the observations.
    """
    bounds = probed_span(registry, as_of, span)
    observed = observed.where(F.col("observed_date").between(*bounds)) if bounds else observed.limit(0)
    seen = observed_days(observed).withColumnRenamed("observed_date", "day")
    return (
        calendar(registry, as_of, span, excluded)
        .join(seen, ["name", "day"], "left_anti")
        .select("name", F.col("day").alias("missing_day"))
    )


def report(
    registry: DataFrame,
    observed: DataFrame,
    as_of: Column | str,
    span: tuple[int, int],
    excluded: Sequence[str] = (),
    calendar_column: str = "calendar",
) -> DataFrame:
    """One row per registered dataset: latest day, delay, missing days (newest first).

    Observations are read from the first probed day on, and of a dataset only days in
    the probed span are kept.  Older ones are read only if some dataset was not seen since.
    A dataset never seen stays in the report, with null latest day and delay and
    every probed day missing.
    """
    bounds = probed_span(registry, as_of, span)
    day = F.col("observed_date")
    recent = observed.where(day >= bounds[0]) if bounds else observed.limit(0)
    seen = recent.groupBy("name").agg(
        F.max("observed_date").alias("latest_date"),
        F.collect_set(F.when(day <= bounds[1], day) if bounds else day).alias("days"),
    )
    unseen = registry.select("name").join(seen, "name", "left_anti")
    if bounds and not unseen.isEmpty():
        older = observed.where(day < bounds[0]).join(unseen, "name", "left_semi")
        older = older.groupBy("name").agg(F.max("observed_date").alias("latest_date"))
        seen = seen.unionByName(older, allowMissingColumns=True)
    probed = probed_days(as_of, span, calendar_column, excluded)
    return registry.join(seen, "name", "left").select(
        "name",
        "latest_date",
        delayed_days(as_of).alias("delayed_days"),
        F.array_except(probed, F.coalesce("days", F.array().cast("array<date>"))).alias("miss_days"),
    )


def paired_report(
    registry: DataFrame,
    table_days: DataFrame,
    folder_days: DataFrame,
    as_of: Column | str,
    table_span: tuple[int, int] = window("table"),
    folder_span: tuple[int, int] = window("folder"),
    excluded: Sequence[str] = (),
    table_calendar: str = "calendar",
    folder_calendar: str = "calendar",
    one: Callable[..., DataFrame] = report,
) -> DataFrame:
    """The reports on a dataset's table and on its folder side by side.

    ``table_calendar`` and ``folder_calendar`` name the registry column that holds the calendar of that side;
    ``one`` makes the report of a side from its observations (``daymaps.report`` from its maps).
    """
    sides = {"table": (table_days, table_span, table_calendar), "folder": (folder_days, folder_span, folder_calendar)}
    table, folder = (
        one(registry, days, as_of, span, excluded, column).withColumnsRenamed(
            {c: f"{side}_{c}" for c in ("latest_date", "delayed_days", "miss_days")}
        )
        for side, (days, span, column) in sides.items()
    )
    return table.join(folder, "name")


# --- one table ---------------------------------------------------------------


def _day(ts: str) -> Column:
    return F.to_date(F.col(ts))


def rows_per_day(df: DataFrame, ts: str) -> DataFrame:
    """``(day 'yyyy-MM-dd', row_count)``."""
    return (
        df.groupBy(_day(ts).alias("day"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.date_format("day", "yyyy-MM-dd").alias("day"), "row_count")
    )


def latest_day_rowcount(df: DataFrame, ts: str) -> DataFrame:
    """The newest day and its number of rows."""
    return rows_per_day(df, ts).orderBy(F.col("day").desc()).limit(1)


def distinct_days(df: DataFrame, ts: str, n: int) -> DataFrame:
    """The ``n`` newest days, newest first."""
    days = df.select(_day(ts).alias("day")).distinct().orderBy(F.col("day").desc()).limit(n)
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"))
