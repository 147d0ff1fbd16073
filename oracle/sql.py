"""One SQL statement per query, for DuckDB, over the same sample tables.

Made from the rules in another shape than the plans it checks: a station-hour
is a set of sorted lists, places are numbers of heavier stations, classes are a table of bounds.
"""

from __future__ import annotations

# --- shared table expressions ------------------------------------------------

_RATE = """cast(floor(l_extendedprice / 200.0 / case (case when l_suppkey % 4 = 1 then 0 else (l_suppkey + 2 * l_linenumber) % 4 end)
        when 0 then 1 when 1 then 4 when 2 then 12 else 30 end) as integer)"""

_YEAR = "(1996 + year(l_shipdate) % 3)"

HIST = f"""hist as (
    select 'R-S' || l_suppkey || '_' || l_orderkey as rowkey,
        'Model#' || (l_partkey % 25) as model,
        'm' || l_suppkey || 'x' || l_linenumber as station_mac,
        case when l_linenumber <> 7 then 'n' || l_linenumber end as station_name,
        case when l_returnflag = 'A' then '2.4GHz' when l_returnflag = 'R' then '5GHz' else '6GHz' end as connect_type,
        cast(floor(-40 - l_quantity * (case when l_suppkey % 4 = 1 then 0.3::double else 1.0::double end)
            - (case when l_suppkey % 4 = 1 then 0 else 12 * ((l_suppkey + l_linenumber) % 4) end)) as double) as signal_strength,
        case when l_suppkey % 10 = 0 then -60.0::double
            else -40 - round(l_quantity * l_linenumber / 14.0::double, 1) end as day_signal,
        l_quantity * 0.2::double * (1 + l_suppkey % 3) - case when l_linenumber = 6 then 40 else 0 end as snr,
        {_RATE} || 'Mbps' as link_rate,
        {_RATE} || 'Mbps' as tx_link_rate,
        epoch_ms(make_timestamp({_YEAR}, 1, 1, 0, 0, 0)) + (l_orderkey % 3600) * 1000
            + (l_partkey % 2 + case when l_orderkey % 97 = 0 then 1 else 0 end) * 3600000 as ts,
        cast(floor(l_extendedprice) as bigint) as bs,
        cast(floor(l_extendedprice * l_tax) as bigint) as br,
        {_YEAR} || '0101' as date,
        '0' || (l_partkey % 2) as hour
    from lineitem)"""

RECORDS = """rec as (
    select regexp_extract(rowkey, '-([A-Z0-9]+)_', 1) as sn, station_mac, station_name, connect_type as band,
        signal_strength as rssi, snr,
        try_cast(replace(link_rate, 'Mbps', '') as integer) as phy_rate,
        try_cast(replace(tx_link_rate, 'Mbps', '') as integer) as tx_phy_rate,
        model, strftime(make_timestamp(ts * 1000), '%H') as hour, strftime(make_timestamp(ts * 1000), '%Y%m%d') as date,
        0 as son
    from hist)"""


def _at(sorted_list: str, percent: int) -> str:
    """The value of a sorted list below which, itself included, lie so many percent of it."""
    return f"{sorted_list}[greatest(1, (len({sorted_list}) * {percent} + 99) // 100)]"


# The label follows from the sorted signals of a device: their percentiles, and whether the strongest is within the fence.
MOBILITY = f"""heard as (
    select regexp_extract(rowkey, '-([A-Z0-9]+)_', 1) as sn, station_mac, list(day_signal order by day_signal) as s
    from hist where day_signal is not null group by all),
mob as (
    select sn, station_mac, if({_at("s", 90)} - {_at("s", 50)} > 5, 'Non-stationary', 'Stationary') as mobility_status
    from heard where s[-1] > least({_at("s", 3)}, 3 * {_at("s", 10)} - 2 * {_at("s", 90)}))"""

DEVICES = f"""dev as (
    select station_mac, cast({_at("s", 50)} as integer) as p50_rssi, cast({_at("s", 90)} as integer) as p90_rssi
    from (select station_mac, list(rssi order by rssi) as s from rec group by station_mac))"""

FACT = f"""{HIST}, {RECORDS}, {MOBILITY}, {DEVICES}, fact as (
    select rec.*, p50_rssi, p90_rssi, mobility_status
    from rec left join dev using (station_mac) left join mob using (sn, station_mac))"""

_KEY = "sn, station_mac, date, hour"


def _sorted(value: str, *conditions: str) -> str:
    return f"list({value} order by {value}) filter ({' and '.join([*conditions, f'{value} is not null'])})"


_LOW, _HIGH, _FAST = "starts_with(band, '2.4G')", "starts_with(band, '5G')", "tx_phy_rate > 24"

# Everything that is ever said of a station-hour of nine records or more: sorted lists of its values.
HOURS = f"""hours as (
    select {_KEY}, count(*) as records, avg(rssi) as avg_rssi, max(rssi) as max_rssi,
        max(model) as model, max(station_name) as station_name,
        max(model) filter ({_FAST}) as fast_model, max(station_name) filter ({_FAST}) as fast_name,
        {_sorted("snr")} as snrs, {_sorted("snr", "snr >= 0", "snr <= 50")} as good_snrs,
        count(*) filter (son > 0) as son_count,
        {_sorted("rssi", _LOW)} as rssi_low, {_sorted("rssi", _HIGH)} as rssi_high,
        {_sorted("phy_rate", _LOW)} as phy_low, {_sorted("phy_rate", _HIGH)} as phy_high,
        {_sorted("tx_phy_rate", _LOW, _FAST)} as tx_low, {_sorted("tx_phy_rate", _HIGH, _FAST)} as tx_high,
        count(*) filter ({_LOW}) > 0 as has_low, count(*) filter ({_HIGH}) > 0 as has_high,
        count(*) filter ({_FAST}) > 0 as has_fast
    from rec group by {_KEY} having count(*) > 8)"""

CONSUMED = """consumed as (
    select * from (
        select regexp_extract(rowkey, '-([^-_]+)_', 1) as sn, station_mac, date, hour,
            cast(sum(cast(bs as decimal(38, 0)) + cast(br as decimal(38, 0))) as decimal(38, 0)) as total_bytes
        from hist group by all)
    where total_bytes < 900000)"""

# Rounding a double by its shortest decimal text, half up.
_ROUND2 = "cast(round(cast(cast({0} as varchar) as decimal(30, 17)), 2) as double)"


def _steps(x: str, *steps: tuple) -> str:
    return "case " + " ".join(f"when {x} {test} then {score}" for score, test in steps) + " end"


# The score ladders.
_LADDERS = {
    "station_rssi_2_4g": ((4, ">= -65"), (3, "between -75 and -66"), (2, "between -85 and -76"), (1, "< -85")),
    "station_rssi_5g": ((4, ">= -68"), (3, "between -78 and -69"), (2, "between -88 and -79"), (1, "< -88")),
    "station_phy_2_4g": ((4, ">= 50"), (3, "between 20 and 49"), (2, "between 10 and 19"), (1, "< 10")),
    "station_phy_5g": ((4, ">= 200"), (3, "between 100 and 199"), (2, "between 50 and 99"), (1, "< 50")),
    "speed_tx_2_4g": ((4, "> 120"), (3, "between 101 and 120"), (2, "between 80 and 100"), (1, "< 80")),
    "speed_tx_5g": ((4, "> 400"), (3, "between 301 and 400"), (2, "between 200 and 300"), (1, "< 200")),
    "coverage_rssi_2_4g": ((4, ">= -55"), (3, "between -70 and -56"), (2, "between -79 and -71"), (1, "< -79")),
    "coverage_rssi_5g": ((4, ">= -55"), (3, "between -70 and -56"), (2, "between -77 and -71"), (1, "< -77")),
    "airtime_2_4g": ((4, "< 40"), (3, "between 40 and 50"), (2, "between 50 and 70"), (1, "is not null or true")),
}


def _ladder(name: str, x: str) -> str:
    return _steps(x, *_LADDERS[name])


def _mean(*scores: str) -> str:
    return f"cast(list_avg([{', '.join(f'cast({s} as double)' for s in scores)}]) as double)"


def _range(values: str) -> str:
    return f"cast({values}[-1] - {values}[1] as double)"


# The four limits, as a table that a station-hour is held against.
VARIATION = f"""parts as (
    select {_KEY}, {_range("snrs")} as snr_range, son_count,
        {_range("phy_low")} as phy_rate_range_2_4g, {_range("phy_high")} as phy_rate_range_5g
    from hours),
variation as (
    select *, cast(len(list_filter([snr_range - 13, son_count - 6, phy_rate_range_2_4g - 30, phy_rate_range_5g - 300],
        lambda over: over > 0)) > 0 as integer) as variation_score
    from parts)"""

# All percentiles of a device's signal are the same in one station-hour.
STATIONS = f"""pct as (
    select {_KEY}, model, mobility_status, station_name,
        {", ".join(f"if(has_{b}, cast(p90_rssi as double), null) as {p}_rssi_{n}"
                   for p in ("p90", "p50", "p95") for b, n in (("low", "2_4g"), ("high", "5g")))},
        cast({_at("phy_low", 90)} as double) as p90_phy_rate_2_4g, cast({_at("phy_high", 90)} as double) as p90_phy_rate_5g
    from hours left join dev using (station_mac) left join mob using (sn, station_mac))"""

# Classes by the bounds above which they begin.
CLASSES = """classes as (
    select * from (values (1, 'Poor', -1e9::double), (2, 'Fair', 1.5::double), (3, 'Good', 2.5::double),
        (4, 'Excellent', 3.5::double)) t(number, category, above))"""

_SAME_HOME = "a.sn = b.sn and a.date = b.date and a.hour = b.hour"


def _home(prefix: str, base: str) -> str:
    """Stations of ``base`` with the weighted mean of ``score`` over their home.

    The heaviest five are those with fewer than five heavier ones; unknown weights are the lightest.
    """
    return f"""{prefix}_weight as (
    select {base}.*, coalesce(total_bytes, -1) as weight from {base} left join consumed using (sn, station_mac, date, hour)),
{prefix}_heavier as (
    select a.sn, a.station_mac, a.date, a.hour, any_value(a.score) as score, count(b.weight) as heavier
    from {prefix}_weight a left join {prefix}_weight b on {_SAME_HOME} and b.weight > a.weight
    group by a.sn, a.station_mac, a.date, a.hour),
{prefix}_home as (
    select *, coalesce(avg_top, 0.0::double) * 0.8::double + coalesce(avg_rest, 0.0::double) * 0.2::double as raw
    from (select sn, date, hour, avg(if(heavier < 5, score, null)) as avg_top, avg(if(heavier < 5, null, score)) as avg_rest
        from {prefix}_heavier group by sn, date, hour))"""


SPEED = f"""sp_base as (
    select {_KEY}, fast_model as model, mobility_status, fast_name as station_name, {_range("good_snrs")} as snr_range_variation,
        cast({_at("tx_low", 90)} as double) as p90_phy_rate_2_4g_speed, cast({_at("tx_high", 90)} as double) as p90_phy_rate_5g_speed,
        cast({_ladder("speed_tx_2_4g", "p90_phy_rate_2_4g_speed")} as integer) as phy_rate_score_2_4g_speed,
        cast({_ladder("speed_tx_5g", "p90_phy_rate_5g_speed")} as integer) as phy_rate_score_5g_speed,
        {_mean("phy_rate_score_2_4g_speed", "phy_rate_score_5g_speed")} as score
    from hours left join mob using (sn, station_mac) where has_fast),
{_home("sp", "sp_base")},
speed as (
    select sp_base.* exclude (score), score as individual_station_avg_base_score_speed,
        {_ROUND2.format("raw")} as home_weighted_avg_base_score_speed,
        cast(snr_range_variation > 13 as integer) as speed_variation_score,
        home_weighted_avg_base_score_speed - speed_variation_score as speed_score_num
    from sp_base join sp_home using (sn, date, hour) where snr_range_variation is not null)"""

COVERAGE = f"""cv_base as (
    select {_KEY}, model, mobility_status, station_name,
        {_at("rssi_low", 90)} as p90_rssi_2_4g, {_at("rssi_high", 90)} as p90_rssi_5g,
        cast({_ladder("coverage_rssi_2_4g", "p90_rssi_2_4g")} as integer) as rssi_score_2_4g,
        cast({_ladder("coverage_rssi_5g", "p90_rssi_5g")} as integer) as rssi_score_5g,
        {_mean("rssi_score_2_4g", "rssi_score_5g")} as score
    from hours left join mob using (sn, station_mac)),
{_home("cv", "cv_base")},
coverage as (
    select cv_base.* exclude (score), score as individual_station_avg_base_score_coverage,
        cast(0 as integer) as rssi_range_variation, cast(0 as integer) as coverage_variation_score,
        {_ROUND2.format("raw")} as home_weighted_avg_base_score_coverage, home_weighted_avg_base_score_coverage as coverage_score_num
    from cv_base join cv_home using (sn, date, hour))"""

RELIABILITY = f"""radios as (
    select 'G-S' || user_id as rowkey, (1996 + event_id % 3) || '0101' as date, '0' || (event_id // 3 % 2) as hour,
        unnest([
            {{'on': event_type <> 'error', 'air': if(event_type = 'signup', '',
                cast(floor(value / (1 + user_id % 3)) as integer) || if(user_id % 2 = 0, '.5', ''))}},
            {{'on': event_type = 'view', 'air': cast(cast(floor(value) as integer) as varchar)}}]) as radio
    from events),
air as (
    select regexp_extract(rowkey, '-([^-_]+)', 1) as sn, date, hour, list(a order by a) as airs
    from (select *, cast(trunc(try_cast(radio.air as double)) as integer) as a from radios where radio['on'])
    where a >= 0 and a <= 100 group by all),
reliability as (
    select sn, date, hour, {_at("airs", 90)} as p90_airtime_util_2_4g,
        cast({_ladder("airtime_2_4g", "p90_airtime_util_2_4g")} as integer) as reliability_score_num
    from air)"""

_COMPOSITE = f"""with {FACT}, {HOURS}, {CONSUMED}, {SPEED}, {COVERAGE}, {RELIABILITY}, {CLASSES},
joined as (
    select s.* exclude (individual_station_avg_base_score_speed),
        c.* exclude (sn, station_mac, station_name, model, mobility_status, date, hour, individual_station_avg_base_score_coverage),
        p90_airtime_util_2_4g, reliability_score_num,
        (speed_score_num + coverage_score_num + coalesce(reliability_score_num, 0))
            / (2 + cast(reliability_score_num is not null as integer)) as mean
    from speed s join coverage c using (sn, station_mac, date, hour, model, mobility_status, station_name)
        left join reliability r using (sn, date, hour))
select joined.* exclude (mean), {_ROUND2.format("mean")} as wifi_score_num_unrounded,
    number as wifi_score_num, category as wifi_score_category
from joined asof join classes on mean > above"""

# --- freshness ---------------------------------------------------------------

_DS = "case when user_id % 3 = 0 then 'biz_' else 'ds_' end || user_id"

OBSERVED = f"obs as (select {_DS} as name, cast(ts as date) as observed_date from events)"

FILES = f"""files as (
    select {_DS} as name, case when event_type = 'signup' then 'part-signup.csv'
        when event_id % 2 = 0 then 'part-' || strftime(ts, '%Y-%m-%d') || '.csv'
        when event_id % 5 = 1 then '99999999_' || strftime(ts, '%Y%m%d') || '.csv'
        when event_id % 5 = 3 then '12345678_' || strftime(ts, '%Y-%m-%d') || '.csv'
        else 'part-' || strftime(ts, '%Y%m%d') || '.csv' end as entry
    from events),
dated as (
    select * from (
        select name, entry, coalesce(
            try_strptime(regexp_extract(entry, '\\d{{4}}-\\d{{2}}-\\d{{2}}', 0), '%Y-%m-%d'),
            list_filter(list_transform(list_filter(regexp_split_to_array(entry, '\\D+'), lambda d: len(d) = 8),
                lambda d: try_strptime(d, '%Y%m%d')), lambda d: d is not null)[1])::date as observed_date
        from files)
    where observed_date is not null)"""

REGISTRY = f"""reg as (
    select distinct {_DS} as name,
        date '2024-01-31' - cast(case user_id % 8 when 7 then 30 when 6 then -2 else user_id % 8 end as integer) as expect_date,
        user_id % 3 = 0 as business, user_id % 3 = 0 or user_id % 5 = 0 as folder_business
    from events)"""


def _gaps(alias: str, seen: str, first: int, last: int, business: str | None) -> str:
    """Days of a range that a dataset was not seen on; workdays only where ``business`` holds."""
    closed = f"({business} and (isodow(day) > 5 or day in (date '2024-01-15', date '2024-01-16')))" if business else "false"
    return f"""{alias} as (
    select name, day from (
        select *, unnest(range(expect_date - {last}, expect_date - {first} + 1, interval 1 day))::date as day from reg)
    where not {closed}
    except select name, observed_date from {seen})"""


def _missing(first: int, last: int, business: str | None = None) -> str:
    return f"""with {OBSERVED}, {REGISTRY}, {_gaps("gaps", "obs", first, last, business)}
select name, day as missing_day from gaps"""


def _report(prefix: str, seen: str, gaps: str) -> str:
    return f"""select r.name, l.latest_date as {prefix}latest_date,
        cast(r.expect_date - l.latest_date as integer) as {prefix}delayed_days,
        coalesce(g.days, '') as {prefix}miss_days
    from reg r left join (select name, max(observed_date) as latest_date from {seen} group by name) l using (name)
        left join (select name, string_agg(strftime(day, '%Y-%m-%d'), ',' order by day desc) as days
            from {gaps} group by name) g using (name)"""


# --- several days ------------------------------------------------------------

_DAILY = """daily as (
    select cast(user_id as varchar) as serial_num, cast(ts as date) as day, count(*) as num_station,
        cast(count(*) filter (event_type = 'error') as bigint) as poor_rssi,
        cast(count(*) filter (event_type = 'view') as bigint) as poor_phyrate, max(value) as home_score
    from events group by all)"""
_DAYS = [f"2024-01-{d:02d}" for d in range(3, 10)]
_WIDE = (
    f"with {_DAILY} select cast(c_custkey as varchar) as serial_num, c_mktsegment as date_string, c_acctbal as before_home_score, "
    + ", ".join(
        f'd{i}.{c} as "{c}_{d}"'
        for i, d in enumerate(_DAYS)
        for c in ("num_station", "poor_rssi", "poor_phyrate", "home_score")
    )
    + " from customer "
    + " ".join(
        f"join (select * from daily where day = date '{d}') d{i} on d{i}.serial_num = cast(c_custkey as varchar)"
        for i, d in enumerate(_DAYS)
    )
)

_MODEL = "where d0.serial_num::integer % 4 < 3"
_JOB = _WIDE.replace("c_acctbal as before_home_score", "c_acctbal as before_home_score, c_acctbal + 1 as after_home_score") + f" {_MODEL}"

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr(a: str, b: str) -> str:
    return "1.0::double" if a == b else f"round(corr({a}, {b}), 6)"


_CORR_LONG = " union all ".join(
    f"select '{a}' as col_a, '{b}' as col_b, {_corr(a, b)} as r, "
    f"count(*) filter ({a} is not null and {b} is not null) as n from lineitem"
    for a in _MEASURES
    for b in _MEASURES
)
_CORR_WIDE = " union all ".join(
    f'select \'{a}\' as "column", ' + ", ".join(f"{_corr(a, b)} as {b}" for b in _MEASURES) + " from lineitem"
    for a in _MEASURES
)

_HALF_DAYS = """half as (
    select event_id, user_id, value, strftime(ts, '%Y%m%d') as date,
        case when hour(ts) < 12 then '00' else '12' end as hour
    from events)"""

_BROKEN = "(event_type in ('error', 'signup') or event_id % 11 < 3)"
_DECODED = f"""with msg as (
    select event_id, {_BROKEN} as broken, props, case when event_type = 'error' then substr(props, 1, length(props) - 1)
        when event_type = 'signup' then '{{"k": "' || user_id || 'x"}}' when event_id % 11 = 0 then props || ' x'
        when event_id % 11 = 1 then props || props when event_id % 11 = 2 then '[' || props || ']' else props end as value
    from events)
select event_id, if(broken, null, cast(json_extract_string(props, '$.k') as integer)) as k,
    if(broken, value, null) as _corrupt_record
from msg"""

# --- one statement per query -------------------------------------------------

ORACLE: dict[str, str] = {
    "flatten_struct": f"""with {HIST} select rowkey, model as "Tplg_Data_model_name", station_mac, station_name,
        connect_type, signal_strength, snr, link_rate, tx_link_rate, ts, bs, br from hist""",
    "serial_extract": """select *, regexp_extract(rowkey, '-([A-Z0-9]+)_', 1) as sn_upper,
        regexp_extract(rowkey, '-([^-_]+)_', 1) as sn_bounded, regexp_extract(rowkey, '-([^-_]+)', 1) as sn_open
        from (select l_orderkey, l_linenumber, 'R-' || case when l_returnflag = 'R' then 's' else 'S' end || l_suppkey ||
            case when l_returnflag = 'N' then '' else '_' || l_orderkey end as rowkey from lineitem)""",
    "rate_parse": """select *, cast(trunc(try_cast(trim(replace(link_rate, 'Mbps', '')) as double)) as integer) as phy_rate
        from (select l_orderkey, l_linenumber, case when l_returnflag = 'A' then cast(l_extendedprice as decimal(12, 2)) || 'Mbps'
            when l_returnflag = 'R' then ' ' || l_linenumber || ' Mbps'
            when l_linestatus = 'F' then 'n/a' else '' end as link_rate from lineitem)""",
    "epoch_parts": """select *, strftime(make_timestamp(ts * 1000), '%H') as hour,
            strftime(make_timestamp(ts * 1000), '%Y%m%d') as date
        from (select l_orderkey, l_linenumber, epoch_ms(l_shipdate) + (l_orderkey * 97777) % 86400000 as ts from lineitem)""",
    "score_ladders": "select l_orderkey, l_linenumber, "
    + ", ".join(
        f"cast({_ladder(n, 'rate' if 'phy' in n or 'tx' in n or 'air' in n else 'signal')} as integer) as {n}"
        for n in _LADDERS
    )
    + """ from (select l_orderkey, l_linenumber, -40 - l_quantity * l_linenumber / 4 as signal,
            l_extendedprice / 200 as rate from lineitem)""",
    "null_math": f"""with {FACT}, {HOURS}, {STATIONS}, {VARIATION}
        select {_KEY}, least(p90_rssi_2_4g, p90_rssi_5g) as worst_rssi, coalesce(p90_rssi_2_4g, 0.0::double) as rssi_or_zero,
            nullif(son_count, 0) as son_or_null, round(snr_range, 2) as snr_range
        from pct join variation using (sn, station_mac, date, hour)""",
    "mean_present": f"""with {FACT}, {HOURS}, {CONSUMED}, {SPEED}, {COVERAGE},
        scored as (
            select {_KEY}, [phy_rate_score_2_4g_speed, phy_rate_score_5g_speed] as s, [rssi_score_2_4g, rssi_score_5g] as c
            from hours left join sp_base using (sn, station_mac, date, hour) join cv_base using (sn, station_mac, date, hour))
        select {_KEY}, cast(list_avg(s) as double) as speed_mean, cast(list_avg(c) as double) as coverage_mean,
            cast(list_avg(list_concat(s, c)) as double) as overall_mean
        from scored""",
    "group_record_count": f"""with {HIST}, {RECORDS}
        select {_KEY}, band, rssi, phy_rate, count(*) over (partition by {_KEY}) as record_count from rec""",
    "min_sample_gate": f"""with {HIST}, {RECORDS}, {HOURS}
        select {_KEY}, records as record_count, avg_rssi from hours""",
    "stationarity": f"with {HIST}, {MOBILITY} select * from mob",
    "hourly_fact": f"""with {FACT} select sn, station_mac, station_name, band, rssi, snr, phy_rate, tx_phy_rate, model,
        hour, date, cast(son as integer) as son, p50_rssi, p90_rssi, mobility_status from fact""",
    "banded_percentiles": f"with {FACT}, {HOURS}, {STATIONS} select * from pct",
    "variation_components": f"""with {HIST}, {RECORDS.replace("0 as son", "cast(abs(signal_strength) as bigint) % 2 as son")},
        {HOURS}, {VARIATION} select * from variation""",
    "station_score": f"""with {FACT}, {HOURS}, {STATIONS}, {VARIATION}, {CLASSES},
        laddered as (
            select *, [cast({_ladder("station_rssi_2_4g", "p90_rssi_2_4g")} as integer), cast({_ladder("station_rssi_5g", "p90_rssi_5g")} as integer),
                cast({_ladder("station_phy_2_4g", "p90_phy_rate_2_4g")} as integer), cast({_ladder("station_phy_5g", "p90_phy_rate_5g")} as integer)] as steps
            from pct join variation using (sn, station_mac, date, hour))
        select sn, station_mac, station_name, model, mobility_status, date, hour,
            {", ".join(f"p{p}_rssi_{n} as p{p}_rssi_{n}_base" for p in (90, 50, 95) for n in ("2_4g", "5g"))},
            p90_phy_rate_2_4g as p90_phy_rate_2_4g_base, p90_phy_rate_5g as p90_phy_rate_5g_base,
            steps[1] as rssi_score_2_4g_base, steps[2] as rssi_score_5g_base,
            steps[3] as phy_rate_score_2_4g_base, steps[4] as phy_rate_score_5g_base,
            {", ".join(f"{c} as {c}_variation" for c in ("snr_range", "son_count", "phy_rate_range_2_4g", "phy_rate_range_5g"))},
            list_min(steps) as base_score, variation_score, category as station_score, number as station_score_num
        from laddered asof join classes on cast(coalesce(list_min(steps) - variation_score, 1) as double) > above""",
    "data_consumption": f"with {HIST}, {CONSUMED} select * from consumed",
    "consumption_rank": f"""with {HIST}, {RECORDS}, {HOURS}, {CONSUMED},
        st as (select {_KEY}, max_rssi, total_bytes, coalesce(total_bytes, -1) as weight
            from hours left join consumed using (sn, station_mac, date, hour))
        select a.sn, a.station_mac, a.date, a.hour, any_value(a.max_rssi) as max_rssi, any_value(a.total_bytes) as total_bytes,
            cast(1 + count(b.weight) as integer) as rank_per_sn
        from st a left join st b on {_SAME_HOME} and b.weight > a.weight group by a.sn, a.station_mac, a.date, a.hour""",
    "top_rest_weighted": f"""with {FACT}, {HOURS}, {CONSUMED}, {COVERAGE}
        select sn, date, hour, avg_top, avg_rest, {_ROUND2.format("raw")} as weighted from cv_home""",
    "speed_score": f"with {FACT}, {HOURS}, {CONSUMED}, {SPEED} select * from speed",
    "coverage_score": f"with {FACT}, {HOURS}, {CONSUMED}, {COVERAGE} select * from coverage",
    "reliability_score": f"with {RELIABILITY} select * from reliability",
    "composite_score": _COMPOSITE,
    "composite_join": _COMPOSITE,
    "missing_days_inclusive": _missing(0, 20),
    "missing_days_shifted": _missing(1, 21),
    "missing_days_shifted_short": _missing(1, 20),
    "missing_days_table": _missing(0, 19),
    "missing_days_business": _missing(1, 21, "business"),
    "rows_per_day": "select substr(cast(o_orderdate as varchar), 1, 10) as day, count(*) as row_count from orders group by 1",
    "latest_day_rowcount": """select substr(cast(o_orderdate as varchar), 1, 10) as day, count(*) as row_count
        from orders group by 1 order by 1 desc limit 1""",
    "distinct_days_topn": """select distinct substr(cast(o_orderdate as varchar), 1, 10) as day
        from orders order by 1 desc limit 20""",
    "listing_dates": f"with {FILES} select distinct name, entry, observed_date from dated",
    "file_drop_dates": """select distinct 'in' || (user_id % 5) || '_' || kind as name,
            kind || '_' || if(event_id % 2 = 0, strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y%m%d')) || '.csv' as entry, cast(ts as date) as observed_date
        from (select *, if(event_type = 'error', 'returns', 'sales') as kind from events) where event_id % 7 <> 0""",
    "table_days": """select distinct 'orders' as name, cast(o_orderdate as date) as observed_date from orders
        union select 'events', cast(ts as date) from events""",
    "folder_listing": """select distinct 'events' as name, 'day=' || strftime(ts, '%Y-%m-%d') as entry, cast(ts as date) as observed_date
        from events""",
    "latest_per_dataset": f"with {OBSERVED} select name, max(observed_date) as latest_date from obs group by name",
    "latest_file_drop": f"""with {FILES} select name, max(observed_date) as latest_date from dated
        where observed_date between date '2024-01-31' - 20 and date '2024-01-31' group by name""",
    "latest_file": f"""with {FILES} select name, observed_date as latest_date, min(entry) as latest_file from dated d
        where observed_date = (select max(observed_date) from dated e where e.name = d.name) group by all""",
    "delay_days": f"""with {OBSERVED}, {REGISTRY} select name, expect_date, latest_date,
        cast(expect_date - latest_date as integer) as delayed_days
        from reg left join (select name, max(observed_date) as latest_date from obs group by name) using (name)""",
    "freshness_report": f"""with {OBSERVED}, {REGISTRY}, {_gaps("gaps", "obs", 1, 21, "business")}
        {_report("", "obs", "gaps")}""",
    "freshness_report_paired": f"""with {OBSERVED}, {FILES}, {REGISTRY}, {_gaps("tgaps", "obs", 0, 19, "business")},
        {_gaps("fgaps", "dated", 1, 21, "folder_business")}
        select * from ({_report("table_", "obs", "tgaps")}) join ({_report("folder_", "dated", "fgaps")}) using (name)""",
    "report_label": """select distinct cast(o_orderdate as date) as day,
        'Data availability Q' || ((month(o_orderdate) - 1) // 3 + 1) || ' ' || year(o_orderdate) as label from orders""",
    "multi_day_union": "select event_id, user_id, event_type, value from events",
    "loader_union": """select c_custkey as k, c_name as name, null::integer as size, 'a' as source from customer
        union all select p_partkey, null, p_size, 'b' from part""",
    "positional_union": "select c_custkey as key, c_name as name from customer union all select p_partkey, p_name from part",
    "full_overwrite": "select * from part",
    "daily_feature_job": _JOB,
    "publish_partitioned": f"with {_HALF_DAYS} select * from half",
    "message_archive": f"select k, _corrupt_record from ({_DECODED})",
    "whole_file_messages": "select cast(count(*) as integer) as k, null::varchar as _corrupt_record from customer group by c_nationkey",
    "dedup_rows": "select distinct user_id, event_type, cast(ts as date) as day from events",
    "wide_daily_features": _WIDE,
    "wide_daily_join": _WIDE,
    "correlation_matrix": _CORR_LONG,
    "correlation_wide": _CORR_WIDE,
    "partition_read": f"with {_HALF_DAYS} select * from half where date = '20240107' and hour = '12'",
    "partition_overwrite": f"""with {_HALF_DAYS} select * from half where not (date = '20240107' and hour = '12')
        union all
        select max(event_id), user_id, max(value), date, hour from half where date = '20240107' and hour = '12'
        group by user_id, date, hour""",
    "csv_roundtrip": "select * from part",
    "export_filtered": "select * from part where p_brand in ('Brand#1', 'Brand#2', 'Brand#3')",
    "single_csv_report": "select p_brand, count(*) as n, max(p_size) as max_size from part group by p_brand",
    "publish_if_absent": "select * from customer",
    "message_encode": """select '{"event_id":' || event_id || ',"user_id":' || user_id || ',"kind":"' || event_type ||
        '","value":' || cast(value as decimal(10, 2)) || '}' as value from events""",
    "message_decode": _DECODED,
    "message_stream": _DECODED,
}

# The same results by other means.
ORACLE |= {
    "stationarity_merged": ORACLE["stationarity"],
    "hourly_fact_merged": ORACLE["hourly_fact"],
    "freshness_report_maps": ORACLE["freshness_report"],
    "freshness_report_paired_maps": ORACLE["freshness_report_paired"],
    "missing_days_maps": ORACLE["missing_days_business"],
    "newest_days_footers": """select name, observed_date from (select distinct cast(o_orderdate as date) as observed_date from orders
        order by 1 desc limit 20), (select unnest(['ordered', 'dealt']) as name)""",
    "latest_day_footers": """select name, day, row_count from (select cast(o_orderdate as date) as day, count(*) as row_count from orders
        group by 1 order by 1 desc limit 1), (select unnest(['ordered', 'dealt']) as name)""",
    "folder_days": "select distinct 'events' as name, cast(ts as date) as observed_date from events",
    "wide_daily_bucketed": ORACLE["wide_daily_join"],
    "message_redelivery": _DECODED.split("select event_id, if(")[0] + """select value, k, attempts, if(broken, 'dead', 'ok') as status
        from (select value, broken, if(broken, null, cast(json_extract_string(props, '$.k') as integer)) as k from msg),
        lateral (select cast(if(broken, 3, if(k % 4 = 0, 2, 1)) as integer) as attempts)""",
    "single_csv_parts": "select * from part",
    "publish_verified": "select * from customer",
}
