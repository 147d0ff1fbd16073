"""Column functions that turn raw text and epoch fields into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The serial formats found in row keys.
SERIAL_PATTERNS = {
    "upper": r"-([A-Z0-9]+)_",
    "bounded": r"-([^-_]+)_",
    "open": r"-([^-_]+)",
}

# The day formats found in file and folder names.  Eight digits inside a longer number are no day.
DAY_PATTERNS = {
    "dashed": [(r"(?<!\d)\d{4}-\d{2}-\d{2}(?!\d)", "yyyy-MM-dd")],
    "compact": [(r"(?<!\d)\d{8}(?!\d)", "yyyyMMdd")],
}
DAY_PATTERNS["either"] = DAY_PATTERNS["dashed"] + DAY_PATTERNS["compact"]


def serial(rowkey: Column | str, pattern: str = "upper") -> Column:
    """Serial number inside a row key; empty text when the key does not match."""
    return F.regexp_extract(rowkey, SERIAL_PATTERNS[pattern], 1)


def rate(text: Column | str, unit: str = "Mbps") -> Column:
    """``'866.7Mbps'`` -> 866; text that is no number gives null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.trim(F.replace(col, F.lit(unit), F.lit(""))).try_cast("double").try_cast("int")


def epoch_hour(ts: Column | str) -> Column:
    """Two-digit hour of an epoch in milliseconds (session time zone)."""
    return F.date_format(F.timestamp_millis(ts), "HH")


def epoch_day(ts: Column | str) -> Column:
    """``yyyyMMdd`` day of an epoch in milliseconds (session time zone)."""
    return F.date_format(F.timestamp_millis(ts), "yyyyMMdd")


def day_in_name(name: Column | str, pattern: str = "either") -> Column:
    """First real day found in a file or folder name, dashed ones before others; null if there is none."""

    def days(regex: str, fmt: str) -> Column:
        return F.transform(F.regexp_extract_all(name, F.lit(regex), F.lit(0)), lambda d: F.try_to_date(d, fmt))

    found = [days(*x) for x in DAY_PATTERNS[pattern]]
    return F.get(F.filter(F.concat(*found), lambda d: d.isNotNull()), F.lit(0))


def day_by_template(name: Column | str, template: Column | str) -> Column:
    """The day that stands for ``{}`` in a file name of a template, in either spelling; null if the name is another."""
    name, template = (F.col(c) if isinstance(c, str) else c for c in (name, template))
    before, after = F.substring_index(template, "{}", 1), F.substring_index(template, "{}", -1)
    middle = name.substr(F.length(before) + 1, F.length(name) - F.length(before) - F.length(after))
    fits = name.startswith(before) & name.endswith(after) & template.contains("{}")
    spelled = [F.when(middle.rlike(f"^(?:{regex})$"), F.try_to_date(middle, fmt)) for regex, fmt in DAY_PATTERNS["either"]]
    return F.when(fits, F.coalesce(*spelled))


def report_label(day: Column | str, title: str) -> Column:
    """``'<title> Q<quarter> <year>'``."""
    return F.concat(F.lit(title + " Q"), F.quarter(day).cast("string"), F.lit(" "), F.year(day).cast("string"))
