"""The registered queries in SQL, written from their definitions and not from the Spark plans."""

from __future__ import annotations

from statistics import NormalDist

from cellpulse.operators.features import ADVANCED, base_names
from cellpulse.queries.catalog import CONFIG, CORRELATED, DESKTOP_INPUTS, ROLLING, SIX

HISTORY = CONFIG.history
K = "cast(json_extract_string(props, '$.k') as int)"


def dbl(value: float) -> str:
    return f"cast({value!r} as double)"


TAU = "(2 * pi())"


def wave(fn: str, value: str, period: int, harmonic: int = 1) -> str:
    return f"{fn}({TAU} * {harmonic} * {value} / {period})"


def _history_columns() -> str:
    lines = []
    for n in HISTORY:
        frame = f"(partition by cell_id order by time_window rows between {n} preceding and 1 preceding)"
        lines += [
            f"coalesce(cast(lag(incident_count, {n}) over w as double), 0) as lag_{n}",
            f"coalesce(avg(incident_count) over {frame}, 0) as rolling_mean_{n}",
            f"coalesce(cast(max(incident_count) over {frame} as double), 0) as rolling_max_{n}",
            f"coalesce(stddev_samp(incident_count) over {frame}, 0) as rolling_std_{n}",
        ]
    return ",\n".join(lines)


POSITION = """case when k = 0 then null when k = 1 then cast(0 as double)
 else cast({start} as double) + cast(({steps}) % 5000 as double) / cast(10000 as double) end"""

# name -> (views it reads, body). A body that refers to itself is recursive.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), f"select *, {K} as k from events"),
    "incidents": (
        ("ev",),
        f"""select event_id, ts, event_type as category,
 {POSITION.format(start=41.6, steps="user_id * 7919")} as lat,
 {POSITION.format(start=-88.0, steps="cast(floor(value * cast(100 as double)) as bigint)")} as lon,
 cast(user_id % 10 as int) as district, cast(k % 4 = 0 as int) as resolved from ev""",
    ),
    "clean": (
        ("incidents",),
        f"""select * from incidents where ts is not null and category is not null
 and lat between {dbl(41.6)} and {dbl(42.1)} and lon between {dbl(-88.0)} and {dbl(-87.5)}""",
    ),
    "corner": (("clean",), "select min(lat) as lat0, min(lon) as lon0 from clean"),
    "cells": (
        ("clean", "corner"),
        f"""select *, grid_lat_idx || '_' || grid_lon_idx as cell_id,
 lat0 + (grid_lat_idx + {dbl(0.5)}) * {dbl(0.05)} as cell_center_lat,
 lon0 + (grid_lon_idx + {dbl(0.5)}) * {dbl(0.05)} as cell_center_lon
 from (select *, cast(floor((lat - lat0) / {dbl(0.05)}) as int) as grid_lat_idx,
  cast(floor((lon - lon0) / {dbl(0.05)}) as int) as grid_lon_idx from clean, corner)""",
    ),
    "gridded": (
        ("cells",),
        """select *, case when hour <= 6 then 0 when hour <= 12 then 1 when hour <= 18 then 2 else 3 end as slot,
 cast(day_of_week >= 5 as int) as is_weekend
 from (select *, time_bucket(interval 6 hour, ts, timestamp '1970-01-01') as time_window,
  cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as day_of_week,
  cast(day(ts) as int) as day_of_month, cast(month(ts) as int) as month from cells)""",
    ),
    "slot_mode": (
        ("gridded",),
        """select cell_id, time_window, slot from (select cell_id, time_window, slot,
 row_number() over (partition by cell_id, time_window order by n desc, slot) as r
 from (select cell_id, time_window, slot, count(*) as n from gridded group by 1, 2, 3)) where r = 1""",
    ),
    "panel": (
        ("gridded", "slot_mode"),
        """select g.cell_id, g.time_window, min(grid_lat_idx) as grid_lat_idx, min(grid_lon_idx) as grid_lon_idx,
 min(cell_center_lat) as cell_center_lat, min(cell_center_lon) as cell_center_lon,
 count(category) as incident_count, avg(hour) as hour, min(day_of_week) as day_of_week,
 min(is_weekend) as is_weekend, ['Night', 'Morning', 'Afternoon', 'Evening'][min(m.slot) + 1] as time_slot
 from gridded g join slot_mode m on g.cell_id = m.cell_id and g.time_window = m.time_window
 group by g.cell_id, g.time_window""",
    ),
    "near": (
        ("panel",),
        """select a.cell_id, a.time_window, coalesce(cast(sum(b.incident_count) as bigint), 0) as neighbor_sum,
 coalesce(avg(b.incident_count), 0) as neighbor_mean, coalesce(max(b.incident_count), 0) as neighbor_max
 from panel a left join panel b on a.time_window = b.time_window and a.cell_id <> b.cell_id
 and abs(a.grid_lat_idx - b.grid_lat_idx) <= 1 and abs(a.grid_lon_idx - b.grid_lon_idx) <= 1
 group by a.cell_id, a.time_window""",
    ),
    "by_dow": (("panel",), "select day_of_week, avg(incident_count) as dow_avg_incidents from panel group by 1"),
    "by_hour": (("panel",), "select hour, avg(incident_count) as hour_avg_incidents from panel group by 1"),
    "by_weekend": (("panel",), "select is_weekend, avg(incident_count) as weekend_avg_incidents from panel group by 1"),
    "by_cell": (
        ("panel",),
        """select cell_id, avg(incident_count) as cell_avg_incidents,
 coalesce(stddev_samp(incident_count), 0) as cell_std_incidents, max(incident_count) as cell_max_incidents,
 cast(sum(incident_count) as bigint) as cell_total_incidents from panel group by cell_id""",
    ),
    "hist": (
        ("panel",),
        f"""select cell_id, time_window, {_history_columns()},
 row_number() over w as seq, coalesce(cast(incident_count - lag(incident_count) over w as double), 0) as momentum,
 cast(lead(incident_count) over w as double) as target,
 coalesce(cast(lead(incident_count) over w > 0 as int), 0) as target_binary
 from panel window w as (partition by cell_id order by time_window)""",
    ),
    "calendar": (
        ("panel",),
        f"""select cell_id, time_window, cast(month(time_window) as int) as month,
 cast(day(time_window) as int) as day_of_month, cast(week(time_window) as int) as week_of_year,
 {wave("sin", "hour", 24)} as hour_sin, {wave("cos", "hour", 24)} as hour_cos,
 {wave("sin", "day_of_week", 7)} as day_sin, {wave("cos", "day_of_week", 7)} as day_cos,
 {wave("sin", "month(time_window)", 12)} as month_sin, {wave("cos", "month(time_window)", 12)} as month_cos
 from panel""",
    ),
    "joined": (
        ("panel", "calendar", "hist", "near", "by_cell", "by_dow", "by_hour", "by_weekend"),
        """select *, rolling_mean_3 - rolling_mean_7 as trend_short, rolling_mean_7 - rolling_mean_14 as trend_long
 from panel join calendar using (cell_id, time_window) join hist using (cell_id, time_window)
 join near using (cell_id, time_window) join by_cell using (cell_id) join by_dow using (day_of_week)
 join by_hour using (hour) join by_weekend using (is_weekend)""",
    ),
    "base": (("joined",), f"select {', '.join(base_names(CONFIG))}, seq from joined where target is not null"),
    # The recursion as defined: the first level is the first count, each later one mixes in the next count.
    "levels": (
        ("panel", "numbered"),
        f"""select cell_id, seq, cast(incident_count as double) as l3, cast(incident_count as double) as l7
 from numbered where seq = 1
 union all
 select n.cell_id, n.seq, l.l3 * {dbl(0.5)} + n.incident_count * {dbl(0.5)},
  l.l7 * {dbl(0.75)} + n.incident_count * {dbl(0.25)}
 from levels l join numbered n on n.cell_id = l.cell_id and n.seq = l.seq + 1""",
    ),
    "numbered": (
        ("panel",),
        "select *, row_number() over (partition by cell_id order by time_window) as seq from panel",
    ),
    "ewma": (
        ("numbered", "levels"),
        """select n.cell_id, n.time_window, coalesce(l.l3, 0) as ewma_3, coalesce(l.l7, 0) as ewma_7
 from numbered n left join levels l on n.cell_id = l.cell_id and n.seq = l.seq + 1""",
    ),
    "ranks": (
        ("base",),
        """select a.cell_id, a.time_window,
 (count(*) filter (where b.lag_1 < a.lag_1) + (count(*) filter (where b.lag_1 = a.lag_1) + 1) / 2) / count(*)
 as lag1_percentile
 from base a join base b on a.cell_id = b.cell_id group by a.cell_id, a.time_window""",
    ),
    "adv": (
        ("base", "ewma", "ranks"),
        f"""select *, lag_1 * ewma_3 as lag1_x_ewma3, trend_short * volatility_3 as trend_x_volatility,
 neighbor_mean * hour as neighbor_x_hour, cell_avg_incidents * is_weekend as cellavg_x_weekend,
 dist_to_center * is_night as dist_x_night from (select b.*, e.ewma_3, e.ewma_7, r.lag1_percentile,
 sqrt((cell_center_lat - {dbl(41.8781)}) ** 2 + (cell_center_lon - {dbl(-87.6298)}) ** 2) as dist_to_center,
 {wave("sin", "hour", 24)} as hour_fourier_1, {wave("cos", "hour", 24)} as hour_fourier_2,
 {wave("sin", "hour", 24, 2)} as hour_fourier_3, {wave("cos", "hour", 24, 2)} as hour_fourier_4,
 {wave("sin", "week_of_year", 52)} as week_fourier_1, {wave("cos", "week_of_year", 52)} as week_fourier_2,
 cast((hour >= 7 and hour <= 9) or (hour >= 16 and hour <= 18) as int) as is_rush_hour,
 cast(hour >= 22 or hour <= 5 as int) as is_night, cast(hour >= 18 and hour <= 23 as int) as is_prime_crime_time,
 rolling_std_3 as volatility_3, rolling_std_7 as volatility_7,
 momentum - coalesce(lag(momentum) over (partition by b.cell_id order by b.time_window), momentum) as acceleration
 from base b join ewma e using (cell_id, time_window) join ranks r using (cell_id, time_window))""",
    ),
    "preds": (
        ("base",),
        """select cell_id, time_window, cell_center_lat, cell_center_lon, grid_lat_idx, grid_lon_idx, target, hour,
 day_of_week, is_weekend, cell_avg_incidents, rolling_mean_14, lag_1, momentum, neighbor_mean, hour_avg_incidents,
 month, day_of_month, rolling_mean_7 as ultra_predicted, abs(target - rolling_mean_7) as ultra_error,
 case when rolling_mean_7 <= 0 then null when rolling_mean_7 <= 1 then 'Low' when rolling_mean_7 <= 3 then 'Medium'
  when rolling_mean_7 <= 100 then 'High' end as risk_level from base""",
    ),
    "open": (
        ("preds",),
        """select * replace (case when ultra_predicted <= 1 then 'Low' when ultra_predicted <= 3 then 'Medium'
 else 'High' end as risk_level) from preds""",
    ),
    "latest": (("open",), "select * from open where time_window = (select max(time_window) from open)"),
    "placed": (
        ("preds",),
        """select *, row_number() over (order by time_window, grid_lat_idx, grid_lon_idx) - 1 as place,
 count(*) over () as rows_all from preds""",
    ),
    "parts": (
        ("placed",),
        f"""select *, case when place < cast(floor(rows_all * {dbl(0.70)}) as bigint) then 'train'
 when place < cast(floor(rows_all * {dbl(0.85)}) as bigint) then 'val' else 'test' end as split from placed""",
    ),
    "scored": (
        ("ev",),
        """select event_id, cast(k % 4 = 0 as int) as y_true, cast(value >= 50 as int) as y_pred,
 cast(value >= 20 as int) as y_low, cast(user_id % 2 as int) as y_user, cast(user_id % 10 as int) as sensitive,
 value as score from ev""",
    ),
    "rates": (
        ("scored",),
        """select sensitive, count(*) as n, avg(y_pred) as selection_rate,
 coalesce(sum(y_true * y_pred) / nullif(sum(y_true), 0), 0) as true_positive_rate from scored group by sensitive""",
    ),
    "desktop": (
        ("clean",),
        """select *, cast(day_of_week >= 5 as int) as is_weekend, cast(hour >= 20 or hour <= 6 as int) as is_night,
 sqrt((lat - avg(lat) over ()) ** 2 + (lon - avg(lon) over ()) ** 2) as dist_from_center
 from (select *, cast(hour(ts) as int) as hour, cast(isodow(ts) - 1 as int) as day_of_week,
 cast(month(ts) as int) as month from clean)""",
    ),
    "residual_rows": (("preds",), "select *, target - ultra_predicted as residual from preds"),
}

ERRORS = """sqrt(avg((target - {p}) ** 2)) as rmse, avg(abs(target - {p})) as mae,
 1 - sum((target - {p}) ** 2) / (var_pop(target) * count(target)) as r2,
 avg(abs((target - {p}) / (target + 1))) * 100 as mape"""


def _histogram(source: str, column: str, bins: int) -> str:
    return f"""with ext as (select min({column}) as lo, max({column}) as hi from {source}),
 hit as (select cast(least(floor(({column} - lo) / (hi - lo) * {bins}), {bins - 1}) as int) as bin, count(*) as n
  from {source}, ext group by 1)
 select cast(b.range as int) as bin, lo + b.range * ((hi - lo) / {bins}) as low,
 lo + (b.range + 1) * ((hi - lo) / {bins}) as high, coalesce(n, 0) as n
 from range({bins}) b cross join ext left join hit on hit.bin = b.range"""


def _correlations() -> str:
    cells = [
        f"select '{a}' as column_a, '{b}' as column_b, "
        + ("cast(min(1) as double)" if a == b else f"corr({a}, {b})")
        + " as r from x"
        for a in CORRELATED for b in CORRELATED
    ]
    return "with x as (select *, hour(ts) as hour from incidents) " + " union all ".join(cells)


HOUR_RISK = "select hour as k, avg(ultra_predicted) as risk from preds group by 1"
DAY_RISK = "select day_of_week as k, avg(ultra_predicted) as risk from preds group by 1"
DAY_NAMES = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"
TIERS = {
    "within_05": "avg(cast(ultra_error < 0.5 as int)) * 100",
    "within_10": "avg(cast(ultra_error < 1 as int)) * 100",
    "within_20": "avg(cast(ultra_error < 2 as int)) * 100",
    "perfect": "count(*) filter (where ultra_error = 0)",
    "perfect_pct": "avg(cast(ultra_error = 0 as int)) * 100",
}
BASELINE = {
    "baseline_rmse": "stddev_pop(target)",
    "rmse": "sqrt(avg((target - ultra_predicted) ** 2))",
    "improvement_pct": "(stddev_pop(target) - sqrt(avg((target - ultra_predicted) ** 2))) / stddev_pop(target) * 100",
}


def _picked(metrics: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f"{e} as {n}" for n, e in metrics.items()) + f" from {source}"


def _day_pick(order: str) -> str:
    return f"{DAY_NAMES}[(select k from ({DAY_RISK}) order by risk {order}, k limit 1) + 1]"


DAYS = {"highest_risk_day": _day_pick("desc"), "lowest_risk_day": _day_pick("asc")}

CONFUSED = """select {by} c.cls, count(*) filter (where y_true = cls) as support,
 count(*) filter (where guess = cls) as claimed, count(*) filter (where y_true = cls and guess = cls) as hits
 from {source} cross join (select unnest([0, 1]) as cls) c group by all having support + claimed > 0"""
WEIGHTED = """sum(hits) / sum(support) as accuracy,
 sum(support * coalesce(hits / nullif(claimed, 0), 0)) / sum(support) as precision,
 sum(support * coalesce(hits / nullif(support, 0), 0)) / sum(support) as recall,
 sum(support * coalesce(2 * hits / nullif(claimed + support, 0), 0)) / sum(support) as f1"""


def _roc(score: str) -> str:
    return f"""select t.threshold, count(*) filter (where y_true = 0 and s.{score} >= t.threshold)
  / (select count(*) from scored where y_true = 0) as fpr,
 count(*) filter (where y_true = 1 and s.{score} >= t.threshold)
  / (select count(*) from scored where y_true = 1) as tpr
 from (select distinct cast({score} as double) as threshold from scored) t cross join scored s group by t.threshold
 union all select null, 0, 0"""


ROC = """with g as (select score, count(*) filter (where y_true = 1) as pos, count(*) filter (where y_true = 0) as neg
  from scored group by score)
 select score as threshold, sum(neg) over w / sum(neg) over () as fpr, sum(pos) over w / sum(pos) over () as tpr
 from g window w as (order by score desc) union all select null, 0, 0"""

AUC = """with r as (select y_true, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 as rk
  from scored)
 select (sum(rk) filter (where y_true = 1) - sum(y_true) * (sum(y_true) + 1) / 2)
  / (sum(y_true) * (count(*) - sum(y_true))) as auc from r"""

HEX = """with e as (select min(target) as x0, max(target) as x1, min(ultra_predicted) as y0, max(ultra_predicted) as y1
  from preds), s as (select *, (x1 - x0) / 35 as sx, (y1 - y0) / 20 as sy from e),
 p as (select *, (target - x0) / sx as u, (ultra_predicted - y0) / sy as v from preds, s),
 q as (select *, round_even(u, 0) as i, round_even(v, 0) as j, floor(u) + 0.5 as k, floor(v) + 0.5 as l from p),
 h as (select *, (u - i) ** 2 + 3 * (v - j) ** 2 < (u - k) ** 2 + 3 * (v - l) ** 2 as even from q)
 select x0 + case when even then i else k end * sx as x, y0 + case when even then j else l end * sy as y,
 count(*) as n from h group by 1, 2"""


def _weights() -> str:
    errors = " + ".join(f"w{i} * (target - {m})" for i, m in enumerate(ROLLING))
    sums = ", ".join(
        f"avg((target - {a}) * (target - {b})) as m_{i}_{j}"
        for i, a in enumerate(ROLLING) for j, b in enumerate(ROLLING) if i <= j
    )
    square = " + ".join(
        f"{1 if i == j else 2} * w{i} * w{j} * m_{i}_{j}"
        for i in range(len(ROLLING)) for j in range(len(ROLLING)) if i <= j
    )
    del errors
    return f"""with m as (select {sums} from base),
 g as (select a.range / 20 as w0, b.range / 20 as w1, c.range / 20 as w2, d.range / 20 as w3,
  a.range as ia, b.range as ib, c.range as ic from range(21) a, range(21) b, range(21) c, range(21) d
  where a.range + b.range + c.range + d.range = 20)
 select w0, w1, w2, w3, sqrt({square}) as rmse from g, m order by rmse, ia, ib, ic limit 1"""


FEATURES = [n for n in base_names(CONFIG)[:-2] if n not in (
    "cell_id", "time_window", "grid_lat_idx", "grid_lon_idx", "cell_center_lat", "cell_center_lon",
    "incident_count", "time_slot")] + list(ADVANCED)


def _robust() -> str:
    fit = ", ".join(
        f"median({c}) as m{i}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as s{i}"
        for i, c in enumerate(FEATURES)
    )
    scaled = ", ".join(
        f"(a.{c} - m{i}) / (case when abs(s{i}) < 2.220446049250313e-15 then 1 else s{i} end) as {c}"
        for i, c in enumerate(FEATURES)
    )
    return f"""with f as (select {fit} from adv join
  (select cell_id, time_window, split from parts) using (cell_id, time_window) where split = 'train')
 select cell_id, time_window, {scaled} from adv a, f"""


def _standard() -> str:
    return "select event_id, " + ", ".join(
        f"({c} - avg({c}) over ()) / (case when stddev_pop({c}) over () < 2.220446049250313e-15 then 1 "
        f"else stddev_pop({c}) over () end) as {c}"
        for c in DESKTOP_INPUTS
    ) + " from desktop"


RANKED = " union all ".join(
    f"select '{m}' as model, {ERRORS.format(p=p)}, (1 - sqrt(avg((target - {p}) ** 2)) / stddev_pop(target)) * 100 as improvement_pct from (select *, avg(target) over () as all_mean from base)"
    for m, p in [*((m, m) for m in ROLLING), ("mean", "all_mean")]
)

SHARES = [i / 100 for i in range(1, 100)]
NORMAL = [NormalDist().inv_cdf(p) for p in SHARES]

BASE_DOUBLES = [c for c in base_names(CONFIG) if c not in (
    "cell_id", "time_window", "grid_lat_idx", "grid_lon_idx", "incident_count", "day_of_week", "is_weekend",
    "time_slot", "month", "day_of_month", "week_of_year", "neighbor_sum", "neighbor_max", "cell_max_incidents",
    "cell_total_incidents", "target_binary")]
ADV_DOUBLES = [c for c in ADVANCED if c not in ("is_rush_hour", "is_night", "is_prime_crime_time")]
LAGS = [f"{kind}_{n}" for n in HISTORY for kind in ("lag", "rolling_mean", "rolling_max", "rolling_std")]
CYCLES = ["hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos"]
PRED_DOUBLES = ["cell_center_lat", "cell_center_lon", "target", "hour", "cell_avg_incidents", "rolling_mean_14", "lag_1",
                "momentum", "neighbor_mean", "hour_avg_incidents", "ultra_predicted", "ultra_error"]
KEY = "cell_id, time_window"
TEST = "from parts where split = 'test'"

# name -> (views, select, columns of type double)
QUERIES: dict[str, tuple[str, str, str | list[str]]] = {
    "scan_csv": ("incidents", "select event_id, date_trunc('second', ts) as ts, category, lat, lon, district as District from incidents", "lat lon"),
    "project_optional": ("incidents", "select event_id, ts, lat, lon, category, district as District from incidents", "lat lon"),
    "load_predictions": ("open", f"select {KEY}, target, ultra_predicted, ultra_error, risk_level from open", "target ultra_predicted ultra_error"),
    "recent_rows": ("preds", f"select {KEY}, target, ultra_predicted from preds", "target ultra_predicted"),
    "recent_rows_100": ("preds", f"select {KEY}, target, ultra_predicted from preds order by time_window desc, cell_id desc limit 100", "target ultra_predicted"),
    "sink_roundtrip": ("panel", "select *, strftime(time_window, '%Y-%m') as window_month from panel", "cell_center_lat cell_center_lon hour"),
    "parse_ts": (
        "ev",
        """select event_id, coalesce(try_strptime(t, ['%m/%d/%Y %I:%M:%S %p', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])) as parsed_ts,
 try_cast(trim(v) as double) as parsed_number from (select event_id,
 case k % 4 when 0 then strftime(ts, '%m/%d/%Y %I:%M:%S %p') when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S')
  when 2 then strftime(ts, '%Y-%m-%d') else 'not a date' end as t,
 case k % 3 when 0 then cast(value as varchar) when 1 then ' ' || cast(value as varchar) || ' ' else 'n/a' end as v from ev)""",
        "parsed_number",
    ),
    "clean_incidents": ("clean", "select * from clean", "lat lon"),
    "cleaning_counts": (
        "incidents clean",
        """select count(*) as loaded, count(*) filter (where not ok) as incomplete,
 count(*) filter (where ok) - (select count(*) from clean) as out_of_range, (select count(*) from clean) as kept
 from (select ts is not null and lat is not null and lon is not null and category is not null as ok from incidents)""",
        "",
    ),
    "missing_profile": (
        "incidents",
        " union all ".join(
            f"select '{c}' as \"column\", count(*) - count({c}) as missing, (count(*) - count({c})) * 100 / count(*) as percentage from incidents"
            for c in ("event_id", "ts", "category", "lat", "lon", "district", "resolved")
        ),
        "percentage",
    ),
    "column_profile": (
        "incidents",
        " union all ".join(
            f"select {i} as position, '{c}' as \"column\", '{t}' as type, substr(coalesce(cast(min({c}) as varchar), 'N/A'), 1, 30) as sample from incidents"
            for i, (c, t) in enumerate(
                (("event_id", "bigint"), ("ts", "timestamp_ntz"), ("category", "string"), ("lat", "double"), ("lon", "double"),
                 ("district", "int"), ("resolved", "int")), 1)
        ),
        "",
    ),
    "first_rows": ("incidents", "select * from incidents order by event_id limit 10", "lat lon"),
    "detect_roles": (
        "incidents",
        """select 'date' as role, 'Date' as "column" union all
 select 'latitude', case when avg(district) between 41 and 42 then 'Plate Number' when avg(lat) between 41 and 42 then 'Latitude' end from incidents union all
 select 'longitude', case when avg(lon) between -88 and -87 then 'Longitude' end from incidents union all
 select 'category', 'Primary Type'""",
        "",
    ),
    "date_coverage": (
        "incidents",
        """select count(ts) as valid, count(ts) * 100 / count(*) as valid_pct, min(ts) as earliest, max(ts) as latest,
 cast(date_sub('second', min(ts), max(ts)) // 86400 as int) as span_days,
 (date_sub('second', min(ts), max(ts)) // 86400) / 365.25 as span_years,
 count(distinct cast(ts as date)) as distinct_dates,
 (select string_agg(y, ',' order by y) from (select distinct cast(year(ts) as varchar) as y from incidents)) as years
 from incidents""",
        "valid_pct span_years",
    ),
    "coord_coverage": (
        "incidents",
        """select count(*) filter (where lat is not null and lon is not null) as valid,
 count(*) filter (where lat is not null and lon is not null) * 100 / count(*) as valid_pct,
 min(lat) as lat_min, max(lat) as lat_max, min(lon) as lon_min, max(lon) as lon_max,
 (max(lat) - min(lat)) * 111 * (max(lon) - min(lon)) * 85 as area_km2 from incidents""",
        "valid_pct lat_min lat_max lon_min lon_max area_km2",
    ),
    "top_categories": (
        "incidents",
        """select category, count(*) as n, count(*) * 100 / (select count(*) from incidents) as share_pct,
 (select count(distinct category) from incidents) as distinct_categories
 from incidents group by category order by n desc, category limit 3""",
        "share_pct",
    ),
    "category_counts": ("incidents", "select category, count(*) as n from incidents where category is not null group by 1", ""),
    "calendar_hist": (
        "incidents",
        " union all ".join(
            f"select '{p}' as part, cast({e} as int) as value, count(*) as n from incidents group by 2"
            for p, e in (("year", "year(ts)"), ("month", "month(ts)"), ("hour", "hour(ts)"), ("weekday", "isodow(ts) - 1"))
        ),
        "",
    ),
    "calendar_hist_filled": (
        "incidents",
        "with h as (" + " union all ".join(
            f"select '{p}' as part, cast(r.range as int) as value, count(ts) as n from range({lo}, {hi}) r left join incidents on {e} = r.range group by 2"
            for p, e, lo, hi in (("hour", "hour(ts)", 0, 24), ("weekday", "isodow(ts) - 1", 0, 7), ("month", "month(ts)", 1, 13))
        ) + ") select *, cast(floor(n / max(n) over (partition by part) * 40) as int) as bar from h",
        "",
    ),
    "weekend_counts": ("incidents", "select cast(isodow(ts) >= 6 as int) as is_weekend, count(*) as n from incidents group by 1", ""),
    "incident_summary": (
        "gridded",
        """select count(*) as incidents, count(distinct cell_id) as cells, count(distinct time_window) as windows,
 cast(date_sub('second', min(ts), max(ts)) // 86400 as int) as span_days from gridded""",
        "",
    ),
    "panel_summary": (
        "panel",
        """select count(*) as observations, count(distinct cell_id) as cells, count(distinct time_window) as windows,
 cast(sum(incident_count) as bigint) as incidents, avg(incident_count) as mean_count, max(incident_count) as max_count from panel""",
        "mean_count",
    ),
    "grid_meta": (
        "clean",
        f"""select *, n_lat_cells * n_lon_cells as total_cells from (select min(lat) as lat_min, max(lat) as lat_max,
 min(lon) as lon_min, max(lon) as lon_max, {dbl(0.05)} as cell_size_degrees, {dbl(5550.0)} as cell_size_meters,
 cast(ceil((max(lat) - min(lat)) / {dbl(0.05)}) as bigint) as n_lat_cells,
 cast(ceil((max(lon) - min(lon)) / {dbl(0.05)}) as bigint) as n_lon_cells from clean)""",
        "lat_min lat_max lon_min lon_max cell_size_degrees cell_size_meters",
    ),
    "assign_cells": (
        "cells",
        "select event_id, lat, lon, grid_lat_idx, grid_lon_idx, cell_id, cell_center_lat, cell_center_lon from cells",
        "lat lon cell_center_lat cell_center_lon",
    ),
    "time_windows": (
        "gridded",
        """select event_id, ts, time_window, hour, day_of_week, day_of_month, month, is_weekend,
 ['Night', 'Morning', 'Afternoon', 'Evening'][slot + 1] as time_slot from gridded""",
        "",
    ),
    "grid_time_panel": ("panel", "select * from panel", "cell_center_lat cell_center_lon hour"),
    "cell_totals": ("gridded", "select grid_lat_idx, grid_lon_idx, count(*) as n from gridded group by 1, 2", ""),
    "density_matrix": ("gridded", "select grid_lat_idx, grid_lon_idx, count(*) as n from gridded group by 1, 2", ""),
    "density_matrix_dense": (
        "gridded",
        """select a.grid_lat_idx, b.grid_lon_idx, count(g.event_id) as n from (select distinct grid_lat_idx from gridded) a
 cross join (select distinct grid_lon_idx from gridded) b
 left join gridded g on g.grid_lat_idx = a.grid_lat_idx and g.grid_lon_idx = b.grid_lon_idx group by 1, 2""",
        "",
    ),
    "density_tiers": (
        "gridded",
        """select count(*) as unique_cells, cast(sum(n) as bigint) as total_incidents, avg(n) as avg_per_cell,
 max(n) as max_in_cell, count(*) filter (where n <= 10) as low_density,
 count(*) filter (where n > 10 and n <= 50) as medium_density, count(*) filter (where n > 50) as high_density
 from (select cell_id, count(*) as n from gridded group by 1)""",
        "avg_per_cell",
    ),
    "top_cells": ("gridded", "select grid_lat_idx, grid_lon_idx, count(*) as n from gridded group by 1, 2 order by n desc, 1, 2 limit 10", ""),
    "daily_counts": ("clean", "select cast(ts as date) as day, count(*) as n from clean group by 1", ""),
    "peak_hour": ("gridded", "select hour as peak_hour, count(*) as n from gridded group by 1 order by n desc, 1 limit 1", ""),
    "count_of_counts": ("panel", "select incident_count, count(*) as n from panel group by 1", ""),
    "district_summary": (
        "clean",
        "select district, avg(lat) as lat, avg(lon) as lon, count(*) as n, count(*) / 10 as radius from clean group by 1",
        "lat lon radius",
    ),
    "corr_matrix": ("incidents", _correlations(), "r"),
    "temporal_trends": (
        "preds",
        "select time_window, sum(ultra_predicted) as predicted, sum(target) as actual, avg(ultra_error) as mean_error from preds group by 1",
        "predicted actual mean_error",
    ),
    "target_summary": (
        "base",
        """select avg(target) as mean_target, max(target) as max_target, avg(cast(target > 0 as int)) * 100 as pct_positive,
 median(target) as median_target from base""",
        "mean_target max_target pct_positive median_target",
    ),
    "cell_risk": (
        "preds",
        """select cell_id, sum(ultra_predicted) as total_risk, avg(ultra_predicted) as mean_risk,
 max(ultra_predicted) as max_risk, count(*) as n from preds group by 1""",
        "total_risk mean_risk max_risk",
    ),
    "feat_temporal": (
        "panel calendar",
        f"select {KEY}, hour, day_of_week, is_weekend, month, day_of_month, week_of_year, {', '.join(CYCLES)} from panel join calendar using ({KEY})",
        ["hour", *CYCLES],
    ),
    "feat_lags": ("hist", f"select {KEY}, {', '.join(LAGS)} from hist", LAGS),
    "feat_neighbors": ("near", f"select {KEY}, neighbor_sum, neighbor_mean, neighbor_max from near", "neighbor_mean"),
    "feat_cell_stats": (
        "panel by_cell",
        f"select {KEY}, cell_avg_incidents, cell_std_incidents, cell_max_incidents, cell_total_incidents from panel join by_cell using (cell_id)",
        "cell_avg_incidents cell_std_incidents",
    ),
    "feat_slot_avgs": (
        "panel by_dow by_hour by_weekend",
        f"""select {KEY}, dow_avg_incidents, hour_avg_incidents, weekend_avg_incidents from panel
 join by_dow using (day_of_week) join by_hour using (hour) join by_weekend using (is_weekend)""",
        "dow_avg_incidents hour_avg_incidents weekend_avg_incidents",
    ),
    "feat_trend": (
        "hist",
        f"select {KEY}, rolling_mean_3 - rolling_mean_7 as trend_short, rolling_mean_7 - rolling_mean_14 as trend_long, momentum from hist",
        "trend_short trend_long momentum",
    ),
    "feat_target": ("hist", f"select {KEY}, target, target_binary from hist", "target"),
    "feature_matrix": ("base", "select * exclude (seq) from base", BASE_DOUBLES),
    "feat_advanced": ("adv", f"select {KEY}, {', '.join(ADVANCED)} from adv", ADV_DOUBLES),
    "feat_ewma": ("ewma", f"select {KEY}, ewma_3, ewma_7 from ewma", "ewma_3 ewma_7"),
    "feat_rank_pct": ("ranks", f"select {KEY}, lag1_percentile from ranks", "lag1_percentile"),
    "feat_dist_mean": ("desktop", "select event_id, lat, lon, dist_from_center from desktop", "lat lon dist_from_center"),
    "feat_desktop": ("desktop", "select event_id, ts, hour, day_of_week, month, is_weekend, is_night from desktop", ""),
    "feat_interactions_v1": (
        "base",
        f"""select {KEY}, cell_avg_incidents * hour as cell_avg_x_hour,
 rolling_mean_3 / (rolling_mean_14 + 1) as recent_to_longterm, lag_1 * hour as lag1_x_hour,
 lag_1 / (rolling_mean_7 + 1) as lag1_to_rolling_mean7, neighbor_mean * lag_3 as neighbor_mean_x_lag3,
 rolling_mean_3 * day_of_week as rolling_mean_3_x_dow, trend_short * is_weekend as trend_short_x_weekend,
 lag_1 * is_weekend as lag1_x_weekend, rolling_mean_3 ** 2 as rolling_mean_3_squared, lag_1 ** 2 as lag_1_squared from base""",
        "cell_avg_x_hour recent_to_longterm lag1_x_hour lag1_to_rolling_mean7 neighbor_mean_x_lag3 rolling_mean_3_x_dow "
        "trend_short_x_weekend lag1_x_weekend rolling_mean_3_squared lag_1_squared",
    ),
    "align_features": (
        "base",
        f"select {KEY}, momentum, hour, cast(0 as double) as absent_feature, lag_1 from base",
        "momentum hour absent_feature lag_1",
    ),
    "predictions": ("preds", "select * from preds", PRED_DOUBLES),
    "risk_levels": (
        "preds open",
        f"""select p.cell_id, p.time_window, p.ultra_predicted, p.risk_level as bounded_level, o.risk_level as open_level
 from preds p join open o using ({KEY})""",
        "ultra_predicted",
    ),
    "error_by_decile": (
        "preds",
        """with q as (select quantile_cont(ultra_predicted, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) as e from preds),
 d as (select row_number() over (order by edge) - 1 as i, edge from (select distinct unnest(e) as edge from q)),
 b as (select p.ultra_error, greatest((select count(*) from d where d.edge < p.ultra_predicted), 1) - 1 as bin from preds p)
 select cast(bin as int) as bin, count(*) as n, avg(ultra_error) as mean_error, stddev_samp(ultra_error) as std_error from b group by 1""",
        "mean_error std_error",
    ),
    "error_hist": ("preds", _histogram("preds", "ultra_error", 50), "low high"),
    "hex_density": ("preds", HEX, "x y"),
    "time_split": ("parts", f"select {KEY}, split from parts", ""),
    "split_summary": (
        "parts",
        """select split, count(*) as n, cast(min(time_window) as date) as first_date,
 cast(max(time_window) as date) as last_date from parts group by 1""",
        "",
    ),
    "top_test_hotspots": (
        "parts",
        f"select {KEY}, ultra_predicted, target, ultra_error {TEST} order by ultra_predicted desc, cell_id, time_window limit 5",
        "ultra_predicted target ultra_error",
    ),
    "test_metrics": ("parts", f"select count(*) as n, {ERRORS.format(p='ultra_predicted')} {TEST}", "rmse mae r2 mape"),
    "random_split": (
        "incidents",
        """select event_id, case when substr(md5('42:' || event_id), 1, 8) < '33333333' then 'test' else 'train' end as split
 from incidents""",
        "",
    ),
    "dash_filter": (
        "latest",
        f"select {KEY}, ultra_predicted, risk_level from latest where risk_level in ('Medium', 'High') and ultra_predicted >= 1.2",
        "ultra_predicted",
    ),
    "dash_metrics": (
        "latest",
        """select sum(ultra_predicted) as total_predicted, sum(target) as total_actual,
 count(*) filter (where ultra_predicted >= 2) as high_risk_count, avg(ultra_error) as avg_error,
 avg(cast(ultra_error < 0.5 as int)) * 100 as accuracy, count(*) as n_cells,
 count(*) filter (where risk_level = 'Low') as low_count, count(*) filter (where risk_level = 'Medium') as medium_count,
 count(*) filter (where risk_level = 'High') as high_count from latest where ultra_predicted >= 0""",
        "total_predicted total_actual avg_error accuracy",
    ),
    "map_layer": (
        "latest",
        """select cell_id, cell_center_lat, cell_center_lon, ultra_predicted, sqrt(ultra_predicted) * 5 + 3 as marker_size,
 target, risk_level,
 ultra_predicted >= 2 as high_risk, avg(cell_center_lat) over () as map_center_lat,
 avg(cell_center_lon) over () as map_center_lon from latest where ultra_predicted >= 0""",
        "cell_center_lat cell_center_lon ultra_predicted marker_size map_center_lat map_center_lon",
    ),
    "map_points": (
        "latest",
        """with shown as (select * from latest where ultra_predicted >= 0)
 select cell_id, cell_center_lat, cell_center_lon, ultra_predicted, sqrt(ultra_predicted) * 5 + 3 as marker_size,
 target, risk_level,
 ultra_predicted >= 5 as high_risk, avg(cell_center_lat) over () as map_center_lat,
 avg(cell_center_lon) over () as map_center_lon from shown""",
        "cell_center_lat cell_center_lon ultra_predicted marker_size map_center_lat map_center_lon",
    ),
    "map_points_10": (
        "latest",
        """with shown as (select * from latest where ultra_predicted >= 0
  order by md5(cell_id || ':' || strftime(time_window, '%Y-%m-%d %H:%M:%S')), cell_id limit 10)
 select cell_id, cell_center_lat, cell_center_lon, ultra_predicted, sqrt(ultra_predicted) * 5 + 3 as marker_size,
 target, risk_level,
 ultra_predicted >= 5 as high_risk, avg(cell_center_lat) over () as map_center_lat,
 avg(cell_center_lon) over () as map_center_lon from shown""",
        "cell_center_lat cell_center_lon ultra_predicted marker_size map_center_lat map_center_lon",
    ),
    "dash_performance": (
        "latest",
        """select cell_id, target, ultra_predicted, ultra_error, risk_level,
 greatest(max(target) over (), max(ultra_predicted) over ()) as axis_max from latest""",
        "target ultra_predicted ultra_error axis_max",
    ),
    "dash_risk_counts": (
        "open",
        "select risk_level, count(*) as n from open where time_window = timestamp '2024-01-15 12:00:00' group by 1",
        "",
    ),
    "dash_error_hist": ("latest", _histogram("latest", "ultra_error", 50), "low high"),
    "hotspots": (
        "latest",
        """select cast(row_number() over (order by ultra_predicted desc, cell_id) as int) as position, cell_id, ultra_predicted,
 target, ultra_error, risk_level from latest order by position limit 10""",
        "ultra_predicted target ultra_error",
    ),
    "window_list": ("preds", "select distinct time_window from preds", ""),
    "dash_overview": (
        "preds",
        """select count(*) as total_records, cast(min(time_window) as date) as first_date,
 cast(max(time_window) as date) as last_date, count(distinct time_window) as n_windows from preds""",
        "",
    ),
    "heat_points": ("incidents", "select lat, lon from incidents where lat is not null and lon is not null", "lat lon"),
    "map_center": ("incidents", "select avg(lat) as center_lat, avg(lon) as center_lon from incidents", "center_lat center_lon"),
    "cluster_points": ("clean", "select event_id, lat, lon, 'Category: ' || category as popup from clean", "lat lon"),
    "cluster_points_100": ("clean", "select event_id, lat, lon, 'Category: ' || category as popup from clean order by event_id limit 100", "lat lon"),
    "report_dataset": (
        "preds",
        """select count(*) as total_predictions, count(distinct cell_id) as unique_locations,
 cast(min(time_window) as date) as date_range_start, cast(max(time_window) as date) as date_range_end,
 cast(date_sub('second', min(time_window), max(time_window)) // 86400 as int) as total_days,
 count(distinct time_window) as unique_time_windows from preds""",
        "",
    ),
    "report_accuracy": (
        "preds",
        f"select {ERRORS.format(p='ultra_predicted')}, median(ultra_error) as median_error from preds",
        "rmse mae r2 mape median_error",
    ),
    "report_tiers": ("preds", _picked(TIERS, "preds"), "within_05 within_10 within_20 perfect_pct"),
    "report_predictions": (
        "preds",
        """select avg(ultra_predicted) as avg_prediction, max(ultra_predicted) as max_prediction, min(ultra_predicted) as min_prediction,
 stddev_samp(ultra_predicted) as std_prediction, avg(target) as avg_actual, cast(trunc(sum(target)) as bigint) as total_actual,
 cast(trunc(sum(ultra_predicted)) as bigint) as total_predicted, median(ultra_predicted) as median_prediction from preds""",
        "avg_prediction max_prediction min_prediction std_prediction avg_actual median_prediction",
    ),
    "report_risk": (
        "preds",
        """select l as risk_level, count(*) filter (where risk_level = l) as n,
 count(*) filter (where risk_level = l) * 100 / count(*) as pct from preds cross join (select unnest(['Low', 'Medium', 'High']) as l) group by l""",
        "pct",
    ),
    "report_hours": (
        "preds",
        f"""select cast(trunc((select k from ({HOUR_RISK}) order by risk desc, k limit 1)) as int) as peak_hour,
 (select max(risk) from ({HOUR_RISK})) as peak_risk,
 cast(trunc((select k from ({HOUR_RISK}) order by risk, k limit 1)) as int) as lowest_hour,
 (select min(risk) from ({HOUR_RISK})) as lowest_risk""",
        "peak_risk lowest_risk",
    ),
    "report_days": ("preds", _picked(DAYS, "(select 1)"), ""),
    "report_weekend": (
        "preds",
        """select *, weekend_avg_risk > weekday_avg_risk as weekend_higher from (select
 avg(ultra_predicted) filter (where is_weekend = 1) as weekend_avg_risk,
 avg(ultra_predicted) filter (where is_weekend = 0) as weekday_avg_risk from preds)""",
        "weekend_avg_risk weekday_avg_risk",
    ),
    "report_concentration": (
        "preds",
        """with c as (select cell_id, sum(ultra_predicted) as total, avg(ultra_predicted) as mean from preds group by 1),
 r as (select *, row_number() over (order by total desc, cell_id) as rk from c)
 select max(cell_id) filter (where rk = 1) as top_hotspot_id, max(total) filter (where rk = 1) as top_hotspot_total_risk,
 max(mean) filter (where rk = 1) as top_hotspot_avg_risk, sum(total) filter (where rk <= 10) / sum(total) * 100 as top_10_share,
 sum(total) filter (where rk <= 20) / sum(total) * 100 as top_20_share from r""",
        "top_hotspot_total_risk top_hotspot_avg_risk top_10_share top_20_share",
    ),
    "report_operations": (
        "preds",
        """select *, 100 - over_prediction_rate - under_prediction_rate as accurate_prediction_rate from (select
 count(*) filter (where ultra_predicted >= 5) as cells_needing_attention,
 avg(cast(ultra_predicted >= 5 as int)) * 100 as cells_needing_attention_pct,
 avg(cast((ultra_predicted >= 3 and target > 0) or (ultra_predicted < 3 and target = 0) as int)) * 100 as correct_detection_rate,
 avg(cast(ultra_predicted > target + 1 as int)) * 100 as over_prediction_rate,
 avg(cast(ultra_predicted < target - 1 as int)) * 100 as under_prediction_rate from preds)""",
        "cells_needing_attention_pct correct_detection_rate over_prediction_rate under_prediction_rate accurate_prediction_rate",
    ),
    "report_preventable": (
        "preds",
        f"select cast(trunc(sum(target) / count(*) * count(distinct time_window) * {dbl(0.15)}) as bigint) as preventable_incidents from preds",
        "",
    ),
    "report_baseline": ("preds", _picked(BASELINE, "preds"), "baseline_rmse rmse improvement_pct"),
    "error_percentiles": (
        "preds",
        "select median(ultra_error) as median_error, quantile_cont(ultra_error, 0.95) as p95_error, avg(ultra_error) as mean_error from preds",
        "median_error p95_error mean_error",
    ),
    "residuals": ("residual_rows", f"select {KEY}, ultra_predicted as predicted, residual from residual_rows", "predicted residual"),
    "qq_points": (
        "residual_rows",
        f"""select p as probability, z as theoretical, (select quantile_cont(residual, {SHARES}) from residual_rows)[i] as observed
 from (select unnest({SHARES}) as p, unnest({NORMAL}) as z, unnest(range(1, {len(SHARES) + 1})) as i)""",
        "probability theoretical observed",
    ),
    "model_ranking": (
        "base",
        f"select *, cast(row_number() over (order by rmse, model) as int) as position from ({RANKED})",
        "rmse mae r2 mape improvement_pct",
    ),
    "robust_scale": ("adv parts", _robust(), FEATURES),
    "standard_scale": ("desktop", _standard(), DESKTOP_INPUTS),
    "label_encode": (
        "gridded",
        """select event_id, cast(dense_rank() over (order by category) - 1 as int) as category_code,
 cast(dense_rank() over (order by cell_id) - 1 as int) as cell_id_code from gridded""",
        "",
    ),
    "ensemble_weights": ("base", _weights(), "w0 w1 w2 w3 rmse"),
    "weighted_ensemble": (
        "base",
        f"""select {KEY}, target, rolling_mean_1 * w0 + rolling_mean_3 * w1 + rolling_mean_7 * w2 + rolling_mean_14 * w3 as mixed
 from base, ({_weights()})""",
        "target mixed",
    ),
    "class_metrics": (
        "scored",
        f"with c as ({CONFUSED.format(by='', source='(select y_true, y_pred as guess from scored)')}) select {WEIGHTED} from c",
        "accuracy precision recall f1",
    ),
    "confusion": ("scored", "select y_true as actual, y_pred as predicted, count(*) as n from scored group by 1, 2", ""),
    "confusion_dense": (
        "scored",
        """select a.y as actual, b.y as predicted, count(s.event_id) as n from (select unnest([0, 1]) as y) a
 cross join (select unnest([0, 1]) as y) b left join scored s on s.y_true = a.y and s.y_pred = b.y group by 1, 2""",
        "",
    ),
    "roc_curve": ("scored", ROC, "threshold fpr tpr"),
    "roc_hard_labels": ("scored", _roc("y_pred"), "threshold fpr tpr"),
    "roc_auc": ("scored", AUC, "auc"),
    "model_comparison": (
        "scored",
        "with u as (" + " union all ".join(
            f"select '{m}' as model, y_true, {m} as guess from scored" for m in ("y_pred", "y_low", "y_user")
        ) + f"), c as ({CONFUSED.format(by='model,', source='u')}) select model, {WEIGHTED} from c group by model",
        "accuracy precision recall f1",
    ),
    "class_distribution": (
        "scored",
        "select y_pred as predicted, count(*) as n, count(*) * 100 / (select count(*) from scored) as share_pct from scored group by 1",
        "share_pct",
    ),
    "disparate_impact": (
        "rates",
        """select count(*) as n_groups, case when count(*) >= 2 then case when max(selection_rate) > 0
 then min(selection_rate) / max(selection_rate) else 0 end end as disparate_impact from rates""",
        "disparate_impact",
    ),
    "demographic_parity": ("rates", "select max(selection_rate) - min(selection_rate) as demographic_parity from rates", "demographic_parity"),
    "equal_opportunity": ("rates", "select max(true_positive_rate) - min(true_positive_rate) as equal_opportunity from rates", "equal_opportunity"),
    "fairness_groups": (
        "rates",
        'select sensitive as "group", n, selection_rate, true_positive_rate from rates',
        "selection_rate true_positive_rate",
    ),
    "fairness_report": (
        "rates",
        """select *, disparate_impact >= 0.8 as impact_passes, demographic_parity <= 0.1 as parity_passes,
 equal_opportunity <= 0.1 as opportunity_passes from (select count(*) as n_groups, avg(selection_rate) as avg_selection_rate,
 min(selection_rate) / max(selection_rate) as disparate_impact, max(selection_rate) - min(selection_rate) as demographic_parity,
 max(true_positive_rate) - min(true_positive_rate) as equal_opportunity from rates)""",
        "avg_selection_rate disparate_impact demographic_parity equal_opportunity",
    ),
}


def _needed(names: list[str]) -> list[str]:
    """The views to declare, each after those it reads."""
    found: list[str] = []

    def visit(name: str) -> None:
        for read in VIEWS[name][0]:
            visit(read)
        if name not in found:
            found.append(name)

    for name in names:
        visit(name)
    return found


def statement(name: str) -> str:
    wanted, select, doubles = QUERIES[name]
    columns = doubles.split() if isinstance(doubles, str) else doubles
    views = ",\n".join(f"{v} as ({VIEWS[v][1]})" for v in _needed(wanted.split()))
    digits = ", ".join(f'round(cast("{c}" as double) + 1e-9, 6) as "{c}"' for c in columns)
    shown = f"* replace ({digits})" if digits else "*"
    return f"with recursive {views}\nselect {shown} from (\n{select}\n)"


def _section(section: str, numbers: str, texts: str = "", source: str | None = None) -> str:
    """A one-row query of the report as tall rows."""
    inner = source or QUERIES[f"report_{section}"][1]
    rows = [(c, f"cast({c} as double)", "cast(null as varchar)") for c in numbers.split()]
    rows += [(c, "cast(null as double)", f"cast({c} as varchar)") for c in texts.split()]
    return " union all ".join(
        f"select '{section}' as section, '{c}' as metric, {n} as number, {t} as text from ({inner})" for c, n, t in rows
    )


SLOT_OF_HOUR = """case when hour(time_window) <= 6 then 'Night' when hour(time_window) <= 12 then 'Morning'
 when hour(time_window) <= 18 then 'Afternoon' else 'Evening' end"""
VIEWS["dense"] = (
    ("panel",),
    f"""select cell_id, time_window, g.grid_lat_idx, g.grid_lon_idx, g.cell_center_lat, g.cell_center_lon,
 coalesce(p.incident_count, 0) as incident_count, coalesce(p.hour, hour(time_window)) as hour,
 coalesce(p.day_of_week, cast(isodow(time_window) - 1 as int)) as day_of_week,
 coalesce(p.is_weekend, cast(isodow(time_window) >= 6 as int)) as is_weekend,
 coalesce(p.time_slot, {SLOT_OF_HOUR}) as time_slot
 from (select cell_id, min(grid_lat_idx) as grid_lat_idx, min(grid_lon_idx) as grid_lon_idx,
  min(cell_center_lat) as cell_center_lat, min(cell_center_lon) as cell_center_lon,
  unnest(generate_series(min(time_window), max(time_window), interval 6 hour)) as time_window
  from panel group by cell_id) g left join panel p using (cell_id, time_window)""",
)
ROLES = {
    "ID": ("null", "null"), "noted": ("1", "null"), "Date": ("0", "null"), "a": ("null", "lat"), "b": ("null", "lon"),
    "Latitude": ("null", "district"), "sent": ("1", "null"),
}
LAYOUTS = {"noted": "'MM/dd/yyyy hh:mm:ss a'", "sent": "'yyyy-MM-dd HH:mm:ss'"}


def _share(column: str, low: float, high: float) -> str:
    return "cast(null as double)" if column == "null" else f"count(*) filter ({column} between {low} and {high}) / count({column})"


def _evidence() -> str:
    rows = []
    for i, (name, (dated, number)) in enumerate(ROLES.items()):
        number = "event_id" if name == "ID" else number
        filled = number if number != "null" else "category" if name == "Date" else "ts"
        rows.append(
            f"""select {i} as position, '{name}' as "column", count({filled}) as filled, cast({dated} as double) as date_share,
 {LAYOUTS.get(name, "cast(null as varchar)")} as layout, {_share(number, 41.6, 42.1)} as lat_share, {_share(number, -88.0, -87.5)} as lon_share from incidents"""
        )
    return " union all ".join(rows)


def _before(by: str, name: str) -> str:
    """The mean over all rows of earlier windows with the same key."""
    return f"""(select sum(b.incident_count) / count(*) from panel b
 where b.time_window < a.time_window and {by.format("b")} = {by.format("a")}) as {name}"""


def _six() -> str:
    sums = ", ".join(
        f"avg((target - {a}) * (target - {b})) as m_{i}_{j}" for i, a in enumerate(SIX) for j, b in enumerate(SIX) if i <= j
    )
    square = " + ".join(f"{1 if i == j else 2} * (w{i} / 20) * (w{j} / 20) * m_{i}_{j}" for i in range(6) for j in range(6) if i <= j)
    grid = "select a.range as w0, b.range as w1 from range(21) a, range(21) b where a.range + b.range <= 20"
    for n in range(2, 5):
        have = ", ".join(f"w{i}" for i in range(n))
        total = " + ".join(f"w{i}" for i in range(n))
        grid = f"select {have}, r.range as w{n} from ({grid}), range(21) r where {total} + r.range <= 20"
    total = " + ".join(f"w{i}" for i in range(5))
    grid = f"select *, 20 - ({total}) as w5 from ({grid})"
    shown = ", ".join(f"w{i} / 20 as w{i}" for i in range(6))
    return f"""with m as (select {sums} from base), g as ({grid}),
 tried as (select g.*, sqrt({square}) as rmse from g, m),
 best as (select * from tried order by rmse, w0, w1, w2, w3, w4 limit 1)
 select {shown}, rmse from best"""


QUERIES |= {
    "stored_extent": (
        "preds",
        """select cast(count(*) as bigint) as rows, min(time_window) as first, max(time_window) as last,
 count(distinct cast(time_window as date)) as folders from preds""",
        "",
    ),
    "stored_days": (
        "preds",
        """select cast(time_window as date) as window_date, cast(count(*) as bigint) as rows, min(time_window) as first,
 max(time_window) as last from preds group by 1""",
        "",
    ),
    "windows_between": (
        "preds",
        f"""select {KEY}, target, ultra_predicted from preds
 where time_window between timestamp '2024-01-09 18:00:00' and timestamp '2024-01-12 06:00:00'""",
        "target ultra_predicted",
    ),
    "grid_meta_stored": QUERIES["grid_meta"],
    "panel_incremental": QUERIES["grid_time_panel"],
    "panel_dense": ("dense", "select * from dense", "cell_center_lat cell_center_lon hour"),
    "feat_target_dense": (
        "dense",
        f"""select {KEY}, incident_count, cast(lead(incident_count) over w as double) as target,
 coalesce(cast(lead(incident_count) over w > 0 as int), 0) as target_binary from dense
 window w as (partition by cell_id order by time_window)""",
        "target",
    ),
    "feat_cell_before": (
        "panel",
        f"""select {KEY}, coalesce(avg(incident_count) over w, 0) as cell_avg_before,
 coalesce(stddev_samp(incident_count) over w, 0) as cell_std_before,
 coalesce(cast(max(incident_count) over w as double), 0) as cell_max_before,
 coalesce(cast(sum(incident_count) over w as double), 0) as cell_total_before from panel
 window w as (partition by cell_id order by time_window rows between unbounded preceding and 1 preceding)""",
        "cell_avg_before cell_std_before cell_max_before cell_total_before",
    ),
    "feat_slots_before": (
        "panel",
        f"""select a.cell_id, a.time_window, {_before("{}.day_of_week", "dow_avg_before")},
 {_before("hour({}.time_window)", "hour_avg_before")}, {_before("{}.is_weekend", "weekend_avg_before")} from panel a""",
        "dow_avg_before hour_avg_before weekend_avg_before",
    ),
    "feat_rank_before": (
        "base",
        """select a.cell_id, a.time_window,
 (count(*) filter (b.lag_1 < a.lag_1) + (count(*) filter (b.lag_1 = a.lag_1) + 1) / 2) / count(*) as lag1_percentile_before
 from base a join base b on a.cell_id = b.cell_id and b.time_window <= a.time_window group by 1, 2""",
        "lag1_percentile_before",
    ),
    "role_evidence": ("incidents", _evidence(), "date_share lat_share lon_share"),
    "detect_roles_evidence": (
        "incidents",
        """select * from (values ('date', 'noted'), ('latitude', 'a'), ('longitude', 'b'), ('category', 'Date')) as t(role, "column")""",
        "",
    ),
    "detect_roles_by_name": (
        "incidents",
        """select * from (values ('date', 'Date'), ('latitude', 'Latitude'), ('longitude', null), ('category', null)) as t(role, "column")""",
        "",
    ),
    "encode_unseen": (
        "gridded",
        """select event_id, c.code as category_code, d.code as cell_id_code from gridded
 left join (select category, cast(row_number() over (order by category) - 1 as int) as code from
  (select distinct category from gridded where day_of_month <= 3)) c using (category)
 left join (select cell_id, cast(row_number() over (order by cell_id) - 1 as int) as code from
  (select distinct cell_id from gridded where day_of_month <= 3)) d using (cell_id)""",
        "",
    ),
    "importance_stored": (
        "base",
        "select * from (" + " union all ".join(f"select '{c}' as feature, abs(corr({c}, target)) as importance from base" for c in SIX)
        + ") order by importance desc, feature limit 4",
        "importance",
    ),
    "bundle_roundtrip": ("parts", f"select {KEY}, target, true as same from parts where split = 'test'", "target"),
    "ensemble_weights_six": ("base", _six(), [*(f"w{i}" for i in range(6)), "rmse"]),
}

LEVELS = ("Low", "Medium", "High")
QUERIES["report_tall"] = (
    "preds",
    " union all ".join(
        [
            _section("dataset", "total_predictions unique_locations total_days unique_time_windows", "date_range_start date_range_end"),
            _section("accuracy", "rmse mae r2 mape median_error"),
            _section("tiers", " ".join(TIERS)),
            _section("predictions", "avg_prediction max_prediction min_prediction std_prediction avg_actual total_actual total_predicted median_prediction"),
            _section(
                "risk", " ".join(f"{x.lower()}_{y}" for y in ("n", "pct") for x in LEVELS), "",
                "select " + ", ".join(
                    f"count(*) filter (where risk_level = '{x}') as {x.lower()}_n, count(*) filter (where risk_level = '{x}') * 100 / count(*) as {x.lower()}_pct"
                    for x in LEVELS
                ) + " from preds",
            ),
            _section("hours", "peak_hour peak_risk lowest_hour lowest_risk"),
            _section("days", "", " ".join(DAYS)),
            _section("weekend", "weekend_avg_risk weekday_avg_risk", "weekend_higher"),
            _section("concentration", "top_hotspot_total_risk top_hotspot_avg_risk top_10_share top_20_share", "top_hotspot_id"),
            _section("operations", "cells_needing_attention cells_needing_attention_pct correct_detection_rate over_prediction_rate under_prediction_rate accurate_prediction_rate"),
            _section("preventable", "preventable_incidents"),
            _section("baseline", " ".join(BASELINE)),
        ]
    ),
    "number",
)


def oracle() -> dict[str, str]:
    return {name: statement(name) for name in QUERIES}
