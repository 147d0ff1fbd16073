"""Threshold ladders and the small formulas shared by all scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score ladders.  Each step is (score, test); the first step that
# holds wins, a value that meets none has no score.  Between-steps are closed on
# both ends, so fractional values can fall into the gaps between two steps.
STATION_RSSI_2_4G = [(4, (">=", -65)), (3, ("between", -75, -66)), (2, ("between", -85, -76)), (1, ("<", -85))]
STATION_RSSI_5G = [(4, (">=", -68)), (3, ("between", -78, -69)), (2, ("between", -88, -79)), (1, ("<", -88))]
STATION_PHY_2_4G = [(4, (">=", 50)), (3, ("between", 20, 49)), (2, ("between", 10, 19)), (1, ("<", 10))]
STATION_PHY_5G = [(4, (">=", 200)), (3, ("between", 100, 199)), (2, ("between", 50, 99)), (1, ("<", 50))]
SPEED_TX_2_4G = [(4, (">", 120)), (3, ("between", 101, 120)), (2, ("between", 80, 100)), (1, ("<", 80))]
SPEED_TX_5G = [(4, (">", 400)), (3, ("between", 301, 400)), (2, ("between", 200, 300)), (1, ("<", 200))]
COVERAGE_RSSI_2_4G = [(4, (">=", -55)), (3, ("between", -70, -56)), (2, ("between", -79, -71)), (1, ("<", -79))]
COVERAGE_RSSI_5G = [(4, (">=", -55)), (3, ("between", -70, -56)), (2, ("between", -77, -71)), (1, ("<", -77))]
AIRTIME_2_4G = [(4, ("<", 40)), (3, ("between", 40, 50)), (2, ("between", 50, 70)), (1, ("else",))]

# Class names of the scores 4 to 1.
CLASS_NAMES = {4: "Excellent", 3: "Good", 2: "Fair", 1: "Poor"}


def _test(value: Column, test: tuple) -> Column:
    op, *bounds = test
    if op == "else":
        return F.lit(True)
    if op == "between":
        return value.between(*bounds)
    (bound,) = bounds
    return {">=": value >= bound, ">": value > bound, "<": value < bound}[op]


def ladder(value: Column | str, steps: list[tuple]) -> Column:
    """Score of a value on a ladder, null where no step holds."""
    col = F.col(value) if isinstance(value, str) else value
    chain = F
    for score, test in steps:
        chain = chain.when(_test(col, test), F.lit(score))
    return chain


def mean_present(*scores: Column | str) -> Column:
    """Mean of the scores that are not null; null if all are."""
    cols = [F.col(s) if isinstance(s, str) else s for s in scores]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])
    present = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return total / F.nullif(present, F.lit(0))


def class_number(mean: Column | str) -> Column:
    """Composite mean -> 4, 3, 2 or 1."""
    col = F.col(mean) if isinstance(mean, str) else mean
    return F.when(col > 3.5, 4).when(col > 2.5, 3).when(col > 1.5, 2).otherwise(1)


def class_name(number: Column | str) -> Column:
    """4, 3, 2, 1 -> Excellent, Good, Fair, Poor."""
    col = F.col(number) if isinstance(number, str) else number
    chain = F
    for score, name in CLASS_NAMES.items():
        chain = chain.when(col == score, F.lit(name))
    return chain
