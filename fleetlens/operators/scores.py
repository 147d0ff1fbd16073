"""Station and home quality scores over the hourly fact table.

Each score needs one aggregate per station-hour.  Measures over a subset of the
rows (a band, a valid range) are conditional aggregates inside it, and the
minimum-sample gate is a condition on its row count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions import clean
from fleetlens.functions.scoring import (
    AIRTIME_2_4G,
    COVERAGE_RSSI_2_4G,
    COVERAGE_RSSI_5G,
    SPEED_TX_2_4G,
    SPEED_TX_5G,
    STATION_PHY_2_4G,
    STATION_PHY_5G,
    STATION_RSSI_2_4G,
    STATION_RSSI_5G,
    class_name,
    class_number,
    ladder,
    mean_present,
)
from fleetlens.operators.grouping import (
    ACCURACY,
    CUTS,
    attach,
    gated,
    in_band,
    percentiles,
    rank_within,
    top_rest_averages,
)
from fleetlens.operators.profile import fields_of

STATION = ["sn", "station_mac", "date", "hour"]
HOME = ["sn", "date", "hour"]
ATTRIBUTES = ["model", "mobility_status", "station_name"]

# Fixed values of the scoring rules.
MAX_TOTAL_BYTES = 1_875_000_000
SNR_RANGE_LIMIT = 13
SON_COUNT_LIMIT = 6
PHY_RANGE_LIMIT_2_4G = 30
PHY_RANGE_LIMIT_5G = 300
SLOWEST_TX = 24
VALID_SNR = (0, 50)
VALID_AIRTIME = (0, 100)
TOP_STATIONS = 5
TOP_WEIGHT = 0.8
REST_WEIGHT = 0.2


# score column -> (measure, ladder)
STATION_SCORES = {
    "rssi_score_2_4g": ("p90_rssi_2_4g", STATION_RSSI_2_4G),
    "rssi_score_5g": ("p90_rssi_5g", STATION_RSSI_5G),
    "phy_rate_score_2_4g": ("p90_phy_rate_2_4g", STATION_PHY_2_4G),
    "phy_rate_score_5g": ("p90_phy_rate_5g", STATION_PHY_5G),
}
SPEED_SCORES = {
    "phy_rate_score_2_4g_speed": ("p90_phy_rate_2_4g_speed", SPEED_TX_2_4G),
    "phy_rate_score_5g_speed": ("p90_phy_rate_5g_speed", SPEED_TX_5G),
}
COVERAGE_SCORES = {
    "rssi_score_2_4g": ("p90_rssi_2_4g", COVERAGE_RSSI_2_4G),
    "rssi_score_5g": ("p90_rssi_5g", COVERAGE_RSSI_5G),
}


def with_scores(df: DataFrame, ladders: dict[str, tuple[str, list]]) -> DataFrame:
    """Add a ladder score per measure."""
    return df.withColumns({score: ladder(measure, steps) for score, (measure, steps) in ladders.items()})


Stage = Callable[[DataFrame, str], DataFrame]


def _as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def _spread(value: Column) -> Column:
    return F.max(value) - F.min(value)


def _double(name: str) -> Column:
    return F.col(name).cast("double")


def _with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all set; one condition per key, so that the scan can skip by it."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def attribute_aggregates(condition: Column | None = None, suffix: str = "", names: Sequence[str] = ATTRIBUTES) -> list[Column]:
    pick = (lambda c: F.when(condition, F.col(c))) if condition is not None else F.col
    return [F.max(pick(c)).alias(c + suffix) for c in names]


# --- station score -----------------------------------------------------------


BANDS = {"2_4g": "2.4G", "5g": "5G"}


def banded_percentiles(
    hourly: DataFrame, signal: DataFrame | None = None, mobility: DataFrame | None = None, accuracy: int = ACCURACY
) -> DataFrame:
    """Gated station-hours with their signal and rate percentiles per band.

    The percentiles of a device's signal (``profile.device_signal``) and its label belong to
    the device, so they can be given as tables, ``hourly`` being plain records: they
    are attached to the station-hours then, and no record is moved for them.
    """
    attached = signal is not None
    names = [a for a in ATTRIBUTES if not attached or a != "mobility_status"]
    if attached:
        bands = [F.max(in_band(b, F.lit(True))).alias(f"rssi_{n}") for n, b in BANDS.items()]
    else:
        rssi = [in_band(b, _double("p90_rssi")) for b in BANDS.values()]
        bands = [percentiles(v, 0.9, 0.5, 0.95, accuracy=accuracy).alias(f"rssi_{n}") for n, v in zip(BANDS, rssi)]
    sketches = gated(
        hourly,
        STATION,
        *attribute_aggregates(names=names),
        *bands,
        *[
            percentiles(in_band(b, _double("phy_rate")), 0.9, accuracy=accuracy).alias(f"phy_{n}")
            for n, b in BANDS.items()
        ],
        *variation_aggregates(),
    )
    if attached:
        sketches = attach(sketches, signal, ["station_mac"]).join(mobility, ["sn", "station_mac"], "left")
    # Any percentile of a device's one signal is that signal, in the bands it was seen in.
    rssi = lambda n, i: F.when(F.col(f"rssi_{n}"), _double("p90_rssi")) if attached else F.col(f"rssi_{n}")[i]
    return sketches.select(
        *STATION,
        *ATTRIBUTES,
        *[rssi(n, i).alias(f"{p}_rssi_{n}") for i, p in enumerate(["p90", "p50", "p95"]) for n in BANDS],
        *[F.col(f"phy_{n}")[0].alias(f"p90_phy_rate_{n}") for n in BANDS],
        *VARIATION_PARTS,
    )


VARIATION_PARTS = ["snr_range", "son_count", "phy_rate_range_2_4g", "phy_rate_range_5g"]


def variation_aggregates() -> list[Column]:
    """Ranges and counts that show how unsteady a connection was."""
    return [
        _spread(_double("snr")).alias("snr_range"),
        F.count_if(F.col("son") >= 1).alias("son_count"),
        _spread(in_band("2.4G", _double("phy_rate"))).alias("phy_rate_range_2_4g"),
        _spread(in_band("5G", _double("phy_rate"))).alias("phy_rate_range_5g"),
    ]


def variation_score() -> Column:
    """1 if any part is over its limit, else 0; missing parts are not over it."""
    over = (
        (F.col("snr_range") > SNR_RANGE_LIMIT)
        | (F.col("son_count") > SON_COUNT_LIMIT)
        | (F.col("phy_rate_range_2_4g") > PHY_RANGE_LIMIT_2_4G)
        | (F.col("phy_rate_range_5g") > PHY_RANGE_LIMIT_5G)
    )
    return F.when(over, 1).otherwise(0)


def variation_components(hourly: DataFrame) -> DataFrame:
    """Gated station-hours with the variation parts and their score."""
    return gated(hourly, STATION, *variation_aggregates()).withColumn("variation_score", variation_score())


def station_score(
    hourly: DataFrame, signal: DataFrame | None = None, mobility: DataFrame | None = None, accuracy: int = ACCURACY
) -> DataFrame:
    """Class of each station-hour: worst band and measure, less one for variation.

    Station-hours with a null key are left out.  ``signal`` and ``mobility`` as for ``banded_percentiles``.
    """
    scored = (
        with_scores(banded_percentiles(_with_keys(hourly, STATION), signal, mobility, accuracy), STATION_SCORES)
        .withColumn("variation_score", variation_score())
        .withColumn("base_score", F.least(*STATION_SCORES))
        # At most 4, at least 1; without any base score the class is the lowest.
        .withColumn(
            "station_score_num",
            F.greatest(F.coalesce(F.col("base_score") - F.col("variation_score"), F.lit(1)), F.lit(1)),
        )
    )
    base = [f"{p}_rssi_{n}" for p in ("p90", "p50", "p95") for n in ("2_4g", "5g")]
    base += [f"{m}_{n}" for m in ("p90_phy_rate", "rssi_score", "phy_rate_score") for n in ("2_4g", "5g")]
    return scored.select(
        "sn",
        "station_mac",
        "station_name",
        "model",
        "mobility_status",
        "date",
        "hour",
        *[F.col(c).alias(c + "_base") for c in base],
        *[F.col(c).alias(c + "_variation") for c in VARIATION_PARTS],
        "base_score",
        "variation_score",
        class_name("station_score_num").alias("station_score"),
        "station_score_num",
    )


# --- data consumption --------------------------------------------------------


def data_consumption(history: DataFrame, max_bytes: int = MAX_TOTAL_BYTES) -> DataFrame:
    """Bytes sent and received per station-hour; totals of ``max_bytes`` and more are left out."""
    if "station_data_connect_data" in history.columns:
        history = history.where(F.col("station_data_connect_data").isNotNull())
    counters = F.col("bs").cast("decimal(38,0)") + F.col("br").cast("decimal(38,0)")
    return (
        fields_of(history, "station_mac", "bs", "br")
        .groupBy(clean.serial("rowkey", "bounded").alias("sn"), "station_mac", "date", "hour")
        .agg(F.sum(counters).cast("decimal(38,0)").alias("total_bytes"))
        .where(F.col("total_bytes") < max_bytes)
    )


def consumption_rank(
    stations: DataFrame, consumption: DataFrame, max_bytes: int = MAX_TOTAL_BYTES, stage: Stage = _as_is
) -> DataFrame:
    """Stations with their bytes and their rank in the home, heaviest first, unknown last."""
    joined = stage(stations.join(consumption, STATION, "left"), "ranked_stations")
    return rank_within(joined, HOME, "total_bytes", None, "rank_per_sn")


# --- speed and coverage ------------------------------------------------------

N_FAST = "n_fast"
SPEED_MEAN = "individual_station_avg_base_score_speed"
COVERAGE_MEAN = "individual_station_avg_base_score_coverage"


def _speed_aggregates(attributes: Sequence[str], accuracy: int) -> list[Column]:
    rate = F.when(_double("tx_phy_rate") > SLOWEST_TX, _double("tx_phy_rate"))
    snr = F.when(_double("snr").between(*VALID_SNR), _double("snr"))
    return [
        *attribute_aggregates(rate.isNotNull(), "_speed", attributes),
        F.count(rate).alias(N_FAST),
        percentiles(in_band("2.4G", rate), 0.9, accuracy=accuracy)[0].alias("p90_phy_rate_2_4g_speed"),
        percentiles(in_band("5G", rate), 0.9, accuracy=accuracy)[0].alias("p90_phy_rate_5g_speed"),
        _spread(snr).alias("snr_range_variation"),
    ]


def _coverage_aggregates(attributes: Sequence[str], accuracy: int) -> list[Column]:
    return [
        *attribute_aggregates(names=attributes),
        percentiles(in_band("2.4G", _double("rssi")), 0.9, accuracy=accuracy)[0].alias("p90_rssi_2_4g"),
        percentiles(in_band("5G", _double("rssi")), 0.9, accuracy=accuracy)[0].alias("p90_rssi_5g"),
    ]


def station_quality(
    hourly: DataFrame, speed: bool = True, coverage: bool = True, labelled: bool = True, accuracy: int = ACCURACY
) -> DataFrame:
    """Gated station-hours with the speed and/or coverage measures and scores, in one aggregate.

    ``labelled`` says whether ``hourly`` has the mobility label.
    """
    attributes = [a for a in ATTRIBUTES if labelled or a != "mobility_status"]
    aggs = _speed_aggregates(attributes, accuracy) if speed else []
    aggs += _coverage_aggregates(attributes, accuracy) if coverage else []
    stations = gated(_with_keys(hourly, HOME), STATION, *aggs)
    if speed:
        stations = with_scores(stations, SPEED_SCORES).withColumn(SPEED_MEAN, mean_present(*SPEED_SCORES))
    if coverage:
        stations = with_scores(stations, COVERAGE_SCORES).withColumn(COVERAGE_MEAN, mean_present(*COVERAGE_SCORES))
    return stations


def _scored_stations(
    hourly: DataFrame,
    consumption: DataFrame,
    mobility: DataFrame | None,
    speed: bool = True,
    coverage: bool = True,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Station-hours with scores, consumption (same distribution, joined first) and mobility label."""
    stations = station_quality(hourly, speed, coverage, mobility is None, accuracy)
    if not coverage:
        stations = stations.where(F.col(N_FAST) > 0)
    stations = stations.join(consumption, STATION, "left")
    if mobility is None:
        return stations
    stations = stations.join(mobility, ["sn", "station_mac"], "left")
    if speed:
        label = F.when(F.col(N_FAST) > 0, F.col("mobility_status"))
        stations = stations.withColumn("mobility_status_speed", label)
    return stations if coverage else stations.drop("mobility_status")


def weighted_home_score(top: str, rest: str, renormalize: bool = False) -> Column:
    """0.8 * average of the top stations + 0.2 * average of the others, to two digits.

    A missing average counts as 0; with ``renormalize`` the weights of the
    averages that exist are scaled to 1 instead.
    """
    weighted = F.coalesce(top, F.lit(0.0)) * TOP_WEIGHT + F.coalesce(rest, F.lit(0.0)) * REST_WEIGHT
    if renormalize:
        weights = F.col(top).isNotNull().cast("int") * TOP_WEIGHT + F.col(rest).isNotNull().cast("int") * REST_WEIGHT
        weighted = F.coalesce(weighted / F.nullif(weights, F.lit(0.0)), F.lit(0.0))
    return F.round(weighted, 2)


def home_scores(
    stations: DataFrame, speed: bool = True, coverage: bool = True, renormalize: bool = False, cuts: int = CUTS
) -> DataFrame:
    """Weighted scores per home-hour from its stations, ranked by ``total_bytes``."""
    scores = {}
    if speed:
        scores["speed"] = (F.col(N_FAST) > 0, F.col(SPEED_MEAN))
    if coverage:
        scores["coverage"] = (F.lit(True), F.col(COVERAGE_MEAN))
    averages = top_rest_averages(stations, HOME, "total_bytes", scores, ["station_mac"], TOP_STATIONS, cuts)
    return averages.select(
        *HOME,
        *[
            weighted_home_score(f"{s}_top", f"{s}_rest", renormalize).alias(f"home_weighted_avg_base_score_{s}")
            for s in scores
        ],
    )


def speed_output() -> list[Column]:
    variation = F.when(F.col("snr_range_variation") > SNR_RANGE_LIMIT, 1).otherwise(0)
    return [
        variation.alias("speed_variation_score"),
        (F.col("home_weighted_avg_base_score_speed") - variation).alias("speed_score_num"),
    ]


def coverage_output() -> list[Column]:
    return [
        F.lit(0).alias("rssi_range_variation"),
        F.lit(0).alias("coverage_variation_score"),
        F.col("home_weighted_avg_base_score_coverage").alias("coverage_score_num"),
    ]


SPEED_COLUMNS = [
    "p90_phy_rate_2_4g_speed",
    "p90_phy_rate_5g_speed",
    "phy_rate_score_2_4g_speed",
    "phy_rate_score_5g_speed",
    "snr_range_variation",
    "home_weighted_avg_base_score_speed",
    "speed_variation_score",
    "speed_score_num",
]
COVERAGE_COLUMNS = [
    "p90_rssi_2_4g",
    "p90_rssi_5g",
    "rssi_score_2_4g",
    "rssi_score_5g",
    "rssi_range_variation",
    "home_weighted_avg_base_score_coverage",
    "coverage_variation_score",
    "coverage_score_num",
]
SCORE_KEYS = ["sn", "station_mac", "station_name", "model", "mobility_status", "date", "hour"]

def speed_score(
    hourly: DataFrame,
    consumption: DataFrame,
    renormalize: bool = False,
    mobility: DataFrame | None = None,
    stage: Stage = _as_is,
    accuracy: int = ACCURACY,
    cuts: int = CUTS,
) -> DataFrame:
    """Speed of each station's home; stations without a valid snr record are left out.

    The mobility label belongs to the station, so it can be given as the table
    ``mobility``: it is then attached to the station-hours and not to every
    record, and ``hourly`` may be plain hourly records.  ``stage`` may write the
    station table (see ``session.stage``), which feeds both the home averages
    and the result, so that ``hourly`` is read once.
    """
    stations = stage(_scored_stations(hourly, consumption, mobility, coverage=False, accuracy=accuracy), "speed_stations")
    homes = home_scores(stations, coverage=False, renormalize=renormalize, cuts=cuts)
    kept = stations.where(F.col("station_mac").isNotNull() & F.col("snr_range_variation").isNotNull())
    return (
        kept.withColumnsRenamed({f"{c}_speed": c for c in ATTRIBUTES})
        .join(homes, HOME)
        .select("*", *speed_output())
        .select(*SCORE_KEYS, *SPEED_COLUMNS[:5], SPEED_MEAN, *SPEED_COLUMNS[5:])
    )


def coverage_score(
    hourly: DataFrame,
    consumption: DataFrame,
    renormalize: bool = False,
    mobility: DataFrame | None = None,
    stage: Stage = _as_is,
    accuracy: int = ACCURACY,
    cuts: int = CUTS,
) -> DataFrame:
    """Coverage of each station's home; parameters as for ``speed_score``."""
    stations = stage(_scored_stations(hourly, consumption, mobility, speed=False, accuracy=accuracy), "coverage_stations")
    homes = home_scores(stations, speed=False, renormalize=renormalize, cuts=cuts)
    return (
        stations.where(F.col("station_mac").isNotNull())
        .join(homes, HOME)
        .select("*", *coverage_output())
        .select(*SCORE_KEYS, *COVERAGE_COLUMNS[:5], COVERAGE_MEAN, *COVERAGE_COLUMNS[5:])
    )


# --- reliability -------------------------------------------------------------


def reliability_score(device_groups: DataFrame, accuracy: int = ACCURACY) -> DataFrame:
    """Airtime score of each home-hour over its enabled 2.4G radios; fractions of airtime are cut off."""
    airtime = F.col("radio._2_4g.airtime_util").try_cast("double").try_cast("int")
    return (
        device_groups.select(
            clean.serial("rowkey", "open").alias("sn"),
            "date",
            "hour",
            F.explode("group_diag_history_radio_wifi_info").alias("radio"),
        )
        .where((F.col("radio._2_4g.enable") == "1") & airtime.between(*VALID_AIRTIME))
        .groupBy(*HOME)
        .agg(percentiles(airtime, 0.9, accuracy=accuracy)[0].alias("p90_airtime_util_2_4g"))
        .withColumn("reliability_score_num", ladder("p90_airtime_util_2_4g", AIRTIME_2_4G))
    )


# --- composite ---------------------------------------------------------------


def _finish_composite(joined: DataFrame) -> DataFrame:
    parts = [F.col(c) for c in ("speed_score_num", "coverage_score_num", "reliability_score_num")]
    speed, coverage, reliability = parts
    present = sum((p.isNotNull().cast("int") for p in parts), F.lit(0))
    mean = (speed + coverage + F.coalesce(reliability, F.lit(0))) / F.nullif(present, F.lit(0))
    return (
        joined.withColumn("__mean", mean)
        .withColumn("wifi_score_num", class_number("__mean"))
        .select(
            *SCORE_KEYS,
            *SPEED_COLUMNS,
            *COVERAGE_COLUMNS,
            "p90_airtime_util_2_4g",
            "reliability_score_num",
            F.round("__mean", 2).alias("wifi_score_num_unrounded"),
            "wifi_score_num",
            class_name("wifi_score_num").alias("wifi_score_category"),
        )
    )


def composite_score(
    speed: DataFrame, coverage: DataFrame, reliability: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Composite of three finished score tables.

    Speed and coverage must agree on all seven keys; by default a null attribute
    agrees with nothing, with ``null_safe`` it agrees with null.
    """
    s = speed.select(*SCORE_KEYS, *SPEED_COLUMNS)
    c = coverage.select(*SCORE_KEYS, *COVERAGE_COLUMNS)
    if null_safe:
        joined = s.join(c.withColumnsRenamed({a: f"__{a}" for a in ATTRIBUTES}), STATION)
        for a in ATTRIBUTES:
            joined = joined.where(F.col(a).eqNullSafe(F.col(f"__{a}")))
    else:
        joined = s.join(c, SCORE_KEYS)
    return _finish_composite(joined.join(reliability, HOME, "left"))


def wifi_score(
    hourly: DataFrame,
    consumption: DataFrame,
    reliability: DataFrame,
    null_safe: bool = False,
    attributes: str = "agree",
    renormalize: bool = False,
    mobility: DataFrame | None = None,
    stage: Stage = _as_is,
    accuracy: int = ACCURACY,
    cuts: int = CUTS,
) -> DataFrame:
    """``composite_score`` straight from the hourly fact.

    Speed and coverage come from the same aggregate, so their join is a filter:
    ``attributes="agree"`` keeps stations whose attributes are the same over
    their fast rows and over all rows, ``"coverage"`` keeps all and takes those
    over all rows.  ``mobility`` and ``stage`` as for ``speed_score``.
    """
    stations = stage(_scored_stations(hourly, consumption, mobility, accuracy=accuracy), "stations")
    homes = home_scores(stations, renormalize=renormalize, cuts=cuts).join(reliability, HOME, "left")
    kept = stations.where(
        F.col("station_mac").isNotNull() & (F.col(N_FAST) > 0) & F.col("snr_range_variation").isNotNull()
    )
    if attributes == "agree":
        for a in ATTRIBUTES:
            same = F.col(a).eqNullSafe(F.col(f"{a}_speed")) if null_safe else F.col(a) == F.col(f"{a}_speed")
            kept = kept.where(same)
    return _finish_composite(kept.join(homes, HOME).select("*", *speed_output(), *coverage_output()))
