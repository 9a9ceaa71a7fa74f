"""The registered queries as standard SQL over the test tables."""

from __future__ import annotations

import re


def local(instant: str) -> str:
    return f"(({instant}) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Denver'"


def instant(wall: str) -> str:
    return f"(({wall}) AT TIME ZONE 'America/Denver') AT TIME ZONE 'UTC'"


def r(expression: str, name: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0 AS {name}"


def errors(actual: str, predicted: str, prefix: str) -> str:
    e = f"({actual} - {predicted})"
    f = f"({e} / nullif({actual}, 0))"
    return ", ".join(
        [
            r(e, f"{prefix}_error"),
            r(f"abs({e})", f"{prefix}_error_abs"),
            r(f, f"{prefix}_error_pct"),
            r(f"abs({f})", f"{prefix}_error_abs_pct"),
        ]
    )


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
ISO = "'%Y-%m-%dT%H:%M:%S'"
SIX = "lat, lon, temp_C, temp_F, observation_time_UTC, observation_time_MTN"
QUALITY = "temperature_QC IN ('1', '5', '9') AND temperature_degC IS NOT NULL"
FAHRENHEIT = "round({c} * (9.0::DOUBLE / 5) + 32, 1)"

# Named parts; each may use the ones before it.
PARTS = {
    "ev": f"SELECT *, {K} AS k FROM events",
    "demand": "SELECT event_type AS series_id, ts AS timestamp, value FROM events",
    "hourly": """SELECT event_type AS series_id, date_trunc('hour', ts)::TIMESTAMP AS timestamp,
        round(sum(value), 4) AS value FROM events GROUP BY 1, 2""",
    "metadata": f"""SELECT event_type AS series_id, 'megawatthours' AS units, upper(event_type) AS name,
        strftime(max(ts), {ISO}) AS updated FROM events GROUP BY 1""",
    "shipments": """SELECT l_shipdate + CAST(l_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS ts,
        l_extendedprice AS value, l_quantity AS temp_F FROM lineitem""",
    "daily": """SELECT o_orderdate AS ds, round(sum(o_totalprice) / 1000, 3) AS y, count(*)::DOUBLE AS temp_F
        FROM orders GROUP BY 1""",
    "station_obs": f"""SELECT lpad(user_id::VARCHAR, 6, '0') || lpad((user_id % 100)::VARCHAR, 5, '0') AS STATION,
        'STATION ' || user_id AS NAME, strftime(ts, {ISO}) AS DATE,
        CASE WHEN k <> 50 THEN k - 20.0::DOUBLE END AS temperature_degC, (k - 25)::DOUBLE AS dew_point_degC,
        ((event_id // 2) % 10)::VARCHAR AS temperature_QC, ((event_id // 2) % 10)::VARCHAR AS dew_point_QC
        FROM ev""",
    "yearly": f"""SELECT lpad(o_custkey::VARCHAR, 11, '0') AS STATION, o_orderpriority AS NAME,
        strftime(o_orderdate, {ISO}) AS DATE, (o_orderkey % 60 - 20)::DOUBLE AS temperature_degC,
        (o_orderkey % 50 - 25)::DOUBLE AS dew_point_degC, (o_orderkey % 10)::VARCHAR AS temperature_QC,
        (o_orderkey % 10)::VARCHAR AS dew_point_QC, year(o_orderdate)::INTEGER AS year FROM orders""",
    "stations": """SELECT lpad(s_suppkey::VARCHAR, 6, '0') AS USAF, lpad((s_suppkey % 100)::VARCHAR, 5, '0') AS WBAN,
        s_name || CASE WHEN s_suppkey % 3 = 0 THEN ' AIRPORT' ELSE ' FIELD' END AS "STATION NAME",
        CASE WHEN s_nationkey % 2 = 0 THEN 'CO' ELSE 'WY' END AS STATE,
        (s_suppkey % 40) / 10.0::DOUBLE + 37 AS LAT, (s_suppkey % 70) / 10.0::DOUBLE - 109 AS LON,
        CAST(DATE '1990-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS "BEGIN",
        CAST(DATE '2021-06-01' + CAST(s_suppkey * 7 % 600 AS INTEGER) AS DATE) AS "END" FROM supplier""",
    "live_obs": """SELECT k - 20.0::DOUBLE AS temp, k - 22.0::DOUBLE AS feels_like, k - 24.0::DOUBLE AS temp_min,
        k - 18.0::DOUBLE AS temp_max, k + 1000.0::DOUBLE AS pressure, k::DOUBLE AS humidity,
        date_trunc('second', ts)::TIMESTAMP AS timestamp, -104.0::DOUBLE - (user_id % 10) / 10.0::DOUBLE AS lon,
        39.0::DOUBLE + (user_id % 10) / 10.0::DOUBLE AS lat FROM ev""",
    "forecasts": """SELECT date_trunc('day', ts)::TIMESTAMP + (hour(ts) // 3) * 3 * INTERVAL 1 HOUR AS forecast_time,
        -104.0::DOUBLE - (user_id % 4) AS lon, 39.0::DOUBLE + (user_id % 4) AS lat, k::BIGINT AS temp_F,
        ts - CAST(event_id % 72 AS INTEGER) * INTERVAL 1 HOUR AS creation_time FROM ev""",
    "newest": """SELECT lat, lon, forecast_time, temp_F::DOUBLE AS temp_F FROM forecasts
        QUALIFY row_number() OVER (PARTITION BY lat, lon, forecast_time ORDER BY creation_time DESC, temp_F DESC) = 1""",
    "predictions": """SELECT timestamp + INTERVAL 5 HOUR AS energy_timestamp_mtn,
        round(value * 0.9::DOUBLE + hour(timestamp), 4) AS predicted_energy_demand,
        hour(timestamp) + 20.0::DOUBLE AS temp_f_forecast, 'v' || (day(timestamp) % 2) AS model_version,
        date_trunc('day', timestamp)::TIMESTAMP - (day(timestamp) % 2) * INTERVAL 1 DAY AS prediction_start_date,
        date_trunc('day', timestamp)::TIMESTAMP - (day(timestamp) % 2) * INTERVAL 1 DAY + INTERVAL 6 HOUR
            AS prediction_creation_date
        FROM hourly""",
    "fact": f"""SELECT series_id, timestamp AS timestamp_UTC, {local('timestamp')} AS timestamp_MTN, value, units, name, updated
        FROM hourly JOIN metadata USING (series_id) WHERE series_id = 'view'""",
    "raw_fact": f"""SELECT series_id, timestamp AS timestamp_UTC, {local('timestamp')} AS timestamp_MTN, value, units, name,
        updated FROM demand JOIN metadata USING (series_id)""",
    "isd": f"""SELECT LAT AS lat, LON AS lon, temperature_degC AS temp_C,
        {FAHRENHEIT.format(c='temperature_degC')} AS temp_F, DATE::TIMESTAMP AS observation_time_UTC,
        {local('DATE::TIMESTAMP')} AS observation_time_MTN
        FROM station_obs JOIN stations ON STATION = USAF || WBAN WHERE {QUALITY}""",
    "owm": f"""SELECT lat, lon, temp AS temp_C, {FAHRENHEIT.format(c='temp')} AS temp_F,
        timestamp AS observation_time_UTC, {local('timestamp')} AS observation_time_MTN FROM live_obs""",
    "temps": f"SELECT {SIX}, 'isd' AS source FROM isd UNION ALL SELECT {SIX}, 'owm' AS source FROM owm",
    "joined": """SELECT observation_time_MTN AS temp_timestamp_mtn, timestamp_MTN AS energy_timestamp_mtn,
        value AS energy_demand, units AS demand_units, name AS series_name, temp_F, temp_C, lat AS temp_location_lat,
        lon AS temp_location_lon, source AS temp_source, updated AS date_energy_updated
        FROM fact LEFT JOIN temps
        ON date_trunc('hour', observation_time_MTN) = date_trunc('hour', timestamp_MTN)""",
    "localized": f"""SELECT {local('energy_timestamp_mtn')} AS forecast_timestamp_mtn, predicted_energy_demand,
        temp_f_forecast, model_version, {local('prediction_start_date')} AS prediction_start_date,
        prediction_creation_date,
        date_diff('hour', {local('prediction_start_date')}, {local('energy_timestamp_mtn')}) AS hours_from_pred_start
        FROM predictions""",
    "metrics": f"""SELECT a.energy_timestamp_mtn, predicted_energy_demand, temp_f_forecast, model_version,
        prediction_start_date, prediction_creation_date, hours_from_pred_start, temp_timestamp_mtn, energy_demand,
        demand_units, series_name, temp_F, date_energy_updated,
        {errors('energy_demand', 'predicted_energy_demand', 'energy')}, {errors('temp_F', 'temp_f_forecast', 'temp_f')},
        forecast_timestamp_mtn
        FROM localized LEFT JOIN (SELECT * FROM joined WHERE energy_timestamp_mtn >=
            (SELECT min(forecast_timestamp_mtn) FROM localized)) a
        ON forecast_timestamp_mtn = a.energy_timestamp_mtn""",
    "cuts": """SELECT hi - INTERVAL 10 DAY - k * INTERVAL 55 DAY AS cutoff
        FROM (SELECT min(ds) AS lo, max(ds) AS hi FROM daily), range(0, 10000) steps(k)
        WHERE hi - INTERVAL 10 DAY - k * INTERVAL 55 DAY >= lo + INTERVAL 1460 DAY""",
    "fits": """SELECT cutoff, regr_slope(y, temp_F) AS slope, regr_intercept(y, temp_F) AS base
        FROM cuts JOIN daily ON ds <= cutoff GROUP BY cutoff""",
    "cv": """SELECT temp_F, ds, y, round(base + slope * temp_F, 4) AS yhat, cutoff
        FROM fits JOIN daily ON ds > cutoff AND ds <= cutoff + INTERVAL 10 DAY""",
    "run_fits": """SELECT 'with-intercept' AS run_id, cutoff, slope, base FROM fits UNION ALL
        SELECT 'through-origin', cutoff, sum(temp_F * y) / sum(temp_F * temp_F), 0.0::DOUBLE
        FROM cuts JOIN daily ON ds <= cutoff GROUP BY cutoff""",
    "run_points": """SELECT run_id, y, base + slope * temp_F AS yhat
        FROM run_fits JOIN daily ON ds > cutoff AND ds <= cutoff + INTERVAL 10 DAY""",
    "runs": """SELECT run_id, avg(pow(y - yhat, 2)) AS mse, sqrt(avg(pow(y - yhat, 2))) AS rmse, avg(abs(y - yhat)) AS mae,
        avg(abs((y - yhat) / y)) AS mape, quantile_cont(abs((y - yhat) / y), 0.5) AS mdape,
        avg(abs(y - yhat) / ((abs(y) + abs(yhat)) / 2)) AS smape FROM run_points GROUP BY run_id""",
    "points": """SELECT epoch(ds - cutoff)::DOUBLE AS horizon, ds, cutoff, y, yhat, (y - yhat) * (y - yhat) AS se, abs(y - yhat) AS ae,
        abs((y - yhat) / nullif(y, 0)) AS ape, abs(y - yhat) / nullif((abs(y) + abs(yhat)) / 2, 0) AS sape,
        CASE WHEN y BETWEEN yhat * 0.9::DOUBLE AND yhat * 1.1::DOUBLE THEN 1.0 ELSE 0.0 END::DOUBLE AS hit FROM cv""",
    "spans": """SELECT horizon, count(*) AS n, sum(count(*)) OVER (ORDER BY horizon) AS upto, avg(y) AS y, avg(se) AS se,
        avg(ae) AS ae, avg(ape) AS ape, avg(sape) AS sape, avg(hit) AS hit FROM points GROUP BY horizon""",
    "ranked": "SELECT *, row_number() OVER (ORDER BY horizon, ds, cutoff) AS place FROM points",
    "grid_cells": """SELECT TIMESTAMP '2024-01-01' + CAST(p_partkey // 100 AS INTEGER) * INTERVAL 1 HOUR AS valid_time,
        CAST((p_partkey % 100) // 10 AS INTEGER) AS iy, CAST(p_partkey % 10 AS INTEGER) AS ix, p_size::DOUBLE AS value FROM part""",
}


def sql(body: str) -> str:
    """``body`` with the parts it uses, directly or through others, in front."""
    needed, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name, part in PARTS.items():
            if name not in needed and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(part)
    if not needed:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in PARTS if n in needed) + "\n" + body


def window_mean(measures: dict[str, str], w: str) -> str:
    """Rolling means by horizon: every earlier horizon weighted by its overlap with the window."""
    overlap = f"greatest(0, least(e.upto, t.upto) - greatest(e.upto - e.n, t.upto - {w}))"
    columns = ", ".join(r(f"{e}(sum({overlap} * e.{m}) / {w})" if e else f"sum({overlap} * e.{m}) / {w}", name)
                        for name, (m, e) in measures.items())
    return f"""SELECT t.horizon, {columns} FROM spans t JOIN spans e ON e.horizon <= t.horizon
        WHERE t.upto >= {w} GROUP BY t.horizon"""


def window_median(measure: str, name: str, w: str) -> str:
    return f"""SELECT t.horizon, {r(f'quantile_cont(p.{measure}, 0.5)', name)} FROM spans t JOIN ranked p
        ON p.place <= t.upto AND p.place > least(t.upto - t.n, t.upto - {w}) WHERE t.upto >= {w} GROUP BY t.horizon"""


MEANS = {
    "mse": ("se", ""), "rmse": ("se", "sqrt"), "mae": ("ae", ""), "mape": ("ape", ""),
    "smape": ("sape", ""), "coverage": ("hit", ""),
}


def all_metrics(w: str, names: list[str], digits: dict[str, int] | None = None) -> str:
    means = {m: MEANS[m] for m in names if m != "mdape"}
    return f"""SELECT * FROM ({window_mean(means, w)}) JOIN ({window_median('ape', 'mdape', w)}) USING (horizon)"""


def profile(keys: dict[str, str]) -> str:
    names = ", ".join(f"{e} AS {k}" for k, e in keys.items())
    return sql(
        f"""SELECT {names}, {r('avg(value)', 'mean')}, {r('quantile_cont(value, 0.1)', 'p10')},
        {r('quantile_cont(value, 0.9)', 'p90')} FROM shipments GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))}"""
    )


YEAR, MONTH, HOUR = "year(ts)::INTEGER", "month(ts)::INTEGER", "hour(ts)::INTEGER"
WEEKDAY = "(isodow(ts) - 1)::INTEGER"
CALENDAR = f"""{YEAR} AS year, dayofyear(ts)::INTEGER AS day_of_year, {HOUR} AS hour, {MONTH} AS month,
    isodow(ts) >= 6 AS is_weekend, month(ts) BETWEEN 5 AND 9 AS is_summer"""
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
KPI = ", ".join(
    f"round(avg({w}_{e}) * {s}, 2) + 0.0 AS {w}_{n}"
    for w in ("energy", "temp_f")
    for n, e, s in (("me", "error", 1), ("mae", "error_abs", 1), ("mape", "error_abs_pct", 100))
)
RANGE = "TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"
DAY_RANGE = "{c} >= TIMESTAMP '2024-01-10' AND {c} < TIMESTAMP '2024-01-21'"
AS_OF = instant("TIMESTAMP '2024-01-15'")
W = "25"
ALL = ["mse", "rmse", "mae", "mape", "mdape", "smape", "coverage"]
TENTH = "(SELECT least(greatest(CAST(floor(0.1::DOUBLE * count(*)) AS BIGINT), 1), count(*)) FROM cv)"
WHOLE = "(SELECT count(*) FROM cv)"
POINT = ", ".join(
    r(e, n)
    for n, e in (("mse", "se"), ("rmse", "sqrt(se)"), ("mae", "ae"), ("mape", "ape"), ("mdape", "ape"), ("smape", "sape"), ("coverage", "hit"))
)


def lambert(lon: str, lat: str) -> tuple[str, str]:
    """Spherical Lambert conformal projection of the test grid, as SQL."""
    t = lambda lat: f"tan(pi() / 4 + radians({lat}) / 2)"
    n = f"(ln(cos(radians(25.0::DOUBLE)) / cos(radians(40.0::DOUBLE))) / ln({t('40.0::DOUBLE')} / {t('25.0::DOUBLE')}))"
    scale = f"(6371200.0::DOUBLE * cos(radians(25.0::DOUBLE)) * pow({t('25.0::DOUBLE')}, {n}) / {n})"
    rho, rho0 = f"({scale} / pow({t(lat)}, {n}))", f"({scale} / pow({t('25.0::DOUBLE')}, {n}))"
    theta = f"({n} * radians({lon} + 95.0::DOUBLE))"
    return f"({rho} * sin({theta}))", f"({rho0} - {rho} * cos({theta}))"


X0, Y0 = lambert("(-120.0::DOUBLE)", "25.0::DOUBLE")
PX, PY = lambert("lon", "lat")
NATIONS = "SELECT n_nationkey AS point, n_nationkey * 1.7::DOUBLE - 125 AS lon, n_nationkey * 0.9::DOUBLE + 22 AS lat FROM nation"
CUSTOMERS = """SELECT c_custkey AS point, (c_custkey % 600) / 10.0::DOUBLE - 125 AS lon,
    (c_custkey % 250) / 10.0::DOUBLE + 24 AS lat FROM customer"""

def spline(p: str, source: str) -> dict[str, str]:
    """Parts for the hourly not-a-knot spline of each place of ``source``, by a sweep down and up its knots."""
    place = "PARTITION BY lat, lon ORDER BY forecast_time"
    on = "b.lat = a.lat AND b.lon = a.lon AND b.i ="
    return {
        f"{p}_knots": f"""SELECT lat, lon, forecast_time, epoch(forecast_time) / 3600.0::DOUBLE AS x, temp_F::DOUBLE AS y,
            row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY lat, lon) AS n FROM {source} WINDOW w AS ({place})""",
        f"{p}_steps": f"""SELECT *, lag(h) OVER w AS hp, lag(h, 2) OVER w AS hpp, lead(h) OVER w AS hn, lag(s) OVER w AS sp FROM (
            SELECT *, lead(x) OVER w - x AS h, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS s FROM {p}_knots WINDOW w AS ({place}))
            WINDOW w AS ({place})""",
        f"{p}_rows": f"""SELECT lat, lon, i, n, 6 * (s - sp) AS rhs,
            2 * (hp + h) + CASE WHEN i = 1 THEN hp + hp * hp / h ELSE 0 END + CASE WHEN i = n - 2 THEN h + h * h / hp ELSE 0 END AS diag,
            h - CASE WHEN i = 1 THEN hp * hp / h ELSE 0 END AS upper, hp - CASE WHEN i = n - 2 THEN h * h / hp ELSE 0 END AS lower
            FROM {p}_steps WHERE i BETWEEN 1 AND n - 2""",
        f"{p}_down": f"""SELECT lat, lon, i, n, diag AS d, rhs AS r, upper FROM {p}_rows WHERE i = 1 UNION ALL
            SELECT b.lat, b.lon, b.i, b.n, b.diag - b.lower / a.d * a.upper, b.rhs - b.lower / a.d * a.r, b.upper
            FROM {p}_down a JOIN {p}_rows b ON {on} a.i + 1""",
        f"{p}_up": f"""SELECT lat, lon, i, r / d AS m FROM {p}_down WHERE i = n - 2 UNION ALL
            SELECT b.lat, b.lon, b.i, (b.r - b.upper * a.m) / b.d FROM {p}_up a JOIN {p}_down b ON {on} a.i - 1""",
        f"{p}_curve": f"""SELECT *, coalesce(m, CASE WHEN i = 0 THEN lead(m) OVER w - h / hn * (lead(m, 2) OVER w - lead(m) OVER w)
            ELSE lag(m) OVER w + hp / hpp * (lag(m) OVER w - lag(m, 2) OVER w) END) AS bend
            FROM {p}_steps LEFT JOIN {p}_up USING (lat, lon, i) WINDOW w AS ({place})""",
        f"{p}_hourly": f"""SELECT lat, lon, moment AS forecast_time, CASE WHEN d = 0 THEN y ELSE
            y + d * ((y1 - y) / h - h * (2 * bend + bend1) / 6 + d * (bend / 2 + d * (bend1 - bend) / (6 * h))) END AS temp_F
            FROM (SELECT *, (epoch(moment) - epoch(forecast_time)) / 3600.0::DOUBLE AS d FROM (SELECT *,
            unnest(generate_series(forecast_time, coalesce(until - INTERVAL 1 HOUR, forecast_time), INTERVAL 1 HOUR)) AS moment
            FROM (SELECT *, lead(forecast_time) OVER w AS until, lead(y) OVER w AS y1, lead(bend) OVER w AS bend1
            FROM {p}_curve WINDOW w AS ({place}))))""",
    }


# The features of daily data that vary; those of the hour are 0 there and get no weight.
VARYING = {
    "temp_F": "temp_F", "year": "year(ds)::DOUBLE", "day_of_year": "dayofyear(ds)::DOUBLE", "is_weekend": "(isodow(ds) >= 6)::INTEGER::DOUBLE",
    "is_summer": "(month(ds) BETWEEN 5 AND 9)::INTEGER::DOUBLE", "month": "month(ds)::DOUBLE", "temp_F_squared": "temp_F * temp_F",
}


def least_squares() -> dict[str, str]:
    """Parts for the weights of each training set, by elimination on the products of scaled features."""
    names, p = list(VARYING), len(VARYING)
    spread = ", ".join(f"avg({f}) AS a{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(VARYING.values(), 1))
    scaled = ", ".join(f"({f} - a{i}) / s{i} AS z{i}" for i, f in enumerate(VARYING.values(), 1)) + f", y - ay AS z{p + 1}"
    products = ", ".join("[" + ", ".join(f"sum(z{i} * z{j})" for j in range(1, p + 2)) + "]" for i in range(1, p + 1))
    weights = ", ".join(f"m[{i}][{p + 1}] / s{i} AS w_{f}" for i, f in enumerate(names, 1))
    base = " - ".join(["ay", *(f"m[{i}][{p + 1}] / s{i} * a{i}" for i in range(1, p + 1))])
    return {
        "fit_ends": "SELECT cutoff FROM cuts UNION ALL SELECT TIMESTAMP '9999-01-01'",
        "fit_spread": f"SELECT cutoff, avg(y) AS ay, {spread} FROM fit_ends JOIN daily ON ds <= cutoff GROUP BY cutoff",
        "fit_products": f"""SELECT cutoff, 1 AS k, [{products}] AS m
            FROM (SELECT cutoff, {scaled} FROM fit_spread JOIN daily ON ds <= cutoff) GROUP BY cutoff""",
        "fit_steps": f"""SELECT cutoff, k, m FROM fit_products UNION ALL
            SELECT cutoff, k + 1, list_transform(range(1, {p + 1}), lambda i: CASE WHEN i = k THEN list_transform(m[k], lambda v: v / m[k][k])
            ELSE list_transform(range(1, {p + 2}), lambda j: m[i][j] - m[i][k] * m[k][j] / m[k][k]) END) FROM fit_steps WHERE k <= {p}""",
        "weights": f"SELECT cutoff, {weights}, {base} AS base FROM fit_steps JOIN fit_spread USING (cutoff) WHERE k = {p + 1}",
    }


def predicted(ts: str, temp: str) -> str:
    """The fitted function at a time and a temperature."""
    at = {f: re.sub(r"\bds\b", ts, re.sub(r"\btemp_F\b", temp, e)) for f, e in VARYING.items()}
    return " + ".join(["base", *(f"w_{f} * ({e})" for f, e in at.items())])


PARTS |= {
    "known": f"""SELECT lat, lon, forecast_time, temp_F FROM forecasts WHERE creation_time <= {AS_OF} AND forecast_time >= {AS_OF}
        QUALIFY row_number() OVER (PARTITION BY lat, lon, forecast_time ORDER BY creation_time DESC, temp_F DESC) = 1""",
    **spline("cubic", "newest"),
    **spline("ahead", "known"),
    **least_squares(),
}

ORACLES = {
    # sources
    "parse_eia_values": """SELECT date_trunc('hour', ts)::TIMESTAMP AS timestamp, value, 'EBA_' || upper(event_type) || '_D_H' AS series_id
        FROM events UNION ALL SELECT date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR, NULL,
        'EBA_' || upper(event_type) || '_D_H' FROM events""",
    "parse_eia_metadata": f"""SELECT 'EBA_' || upper(event_type) || '_D_H' AS series_id, event_type AS name,
        'megawatthours' AS units, strftime(ts, {ISO}) AS updated, '{{"description":"user ' || user_id || '"}}' AS others FROM events""",
    "parse_isd_obs": sql("SELECT * REPLACE (NAME || ', CO US' AS NAME, CASE WHEN temperature_degC IS NULL THEN '9' ELSE temperature_QC END AS temperature_QC) FROM station_obs"),
    "parse_live_weather": sql("SELECT * FROM live_obs"),
    "parse_forecast_xml": sql("""SELECT forecast_time + INTERVAL 6 HOUR AS forecast_time, lon, lat, temp_F,
        date_trunc('second', creation_time)::TIMESTAMP AS creation_time FROM forecasts UNION ALL
        SELECT forecast_time + INTERVAL 9 HOUR, lon, lat, temp_F + 1, date_trunc('second', creation_time)::TIMESTAMP FROM forecasts"""),
    "station_seed": sql("""SELECT USAF, WBAN, "STATION NAME", STATE, LAT, LON, "BEGIN", "END", USAF || WBAN AS station_id FROM stations"""),
    "scan_partition_pruned": sql("SELECT * FROM yearly WHERE year = 1998"),
    "reprocess_live_weather": sql("""SELECT * REPLACE (CASE WHEN timestamp >= TIMESTAMP '2024-01-10' AND timestamp < TIMESTAMP '2024-01-21'
        THEN feels_like END AS feels_like), strftime(timestamp, '%Y-%m-%d') || CASE WHEN hour(timestamp) < 12 THEN '-00' ELSE '-12' END AS landed
        FROM live_obs"""),
    # sinks
    "typed_write_roundtrip": sql("SELECT timestamp, value, series_id FROM demand"),
    "overwrite_twice": sql("SELECT * FROM demand"),
    "append_twice": sql("SELECT * FROM demand UNION ALL SELECT * FROM demand"),
    "materialize_models": sql("SELECT source, lat, lon, max(temp_F) AS hottest, count(*) AS n FROM temps GROUP BY ALL"),
    # scalar functions
    "local_time": f"""SELECT o_orderkey, {local('o_orderdate + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR')} AS local FROM orders""",
    "local_to_utc": f"SELECT event_id, {instant('ts')} AS instant FROM events",
    "split_scaled_field": sql("""SELECT CASE WHEN temperature_degC IS NULL THEN '+9999,9' ELSE
        CASE WHEN temperature_degC < 0 THEN '-' ELSE '+' END || lpad(abs(CAST(temperature_degC * 10 AS INTEGER))::VARCHAR, 4, '0')
        || ',' || temperature_QC END AS field, temperature_degC AS value,
        CASE WHEN temperature_degC IS NULL THEN '9' ELSE temperature_QC END AS flag FROM station_obs"""),
    "temp_f": sql(f"SELECT temp, {FAHRENHEIT.format(c='temp')} + 0.0 AS temp_F FROM live_obs"),
    "normalize_series_id": "SELECT event_id, 'EBA_' || upper(event_type) || '_D_H' AS series_id FROM events",
    "parse_timestamps": """SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS compact,
        date_trunc('second', ts)::TIMESTAMP + INTERVAL 6 HOUR AS iso, date_trunc('second', ts)::TIMESTAMP AS epoch FROM events""",
    "calendar_features": sql(f"SELECT *, {CALENDAR} FROM shipments"),
    "poly_features": sql("""SELECT ts, temp_F, temp_F * temp_F AS temp_F_squared, pow(hour(ts), 2)::DOUBLE AS hour_squared,
        pow(hour(ts), 3)::DOUBLE AS hour_cubed FROM shipments"""),
    "month_dummies": sql(f"""SELECT ts, {MONTH} AS month, {', '.join(f'month(ts) = {i} AS {m}' for i, m in enumerate(MONTHS, 1))}
        FROM shipments"""),
    "error_columns": sql(f"SELECT event_id, {errors('k::DOUBLE', 'value', 'energy')} FROM ev"),
    "hour_diff": """SELECT event_id, date_diff('hour', ts - CAST(user_id % 500 AS INTEGER) * INTERVAL 1 MINUTE, ts) AS hours
        FROM events""",
    # filters
    "quality_filter": sql(f"SELECT * FROM station_obs WHERE {QUALITY}"),
    "trim_range": sql("SELECT * FROM shipments WHERE value BETWEEN 2000 AND 11000"),
    "drop_null_subset": sql("SELECT * FROM joined WHERE energy_demand IS NOT NULL AND temp_F IS NOT NULL"),
    "train_val_split": sql("""SELECT *, 'train' AS part FROM shipments WHERE ts > TIMESTAMP '1995-08-01' AND ts < TIMESTAMP '2000-01-01'
        UNION ALL SELECT *, 'validate' AS part FROM shipments WHERE ts > TIMESTAMP '2000-01-01' AND ts < TIMESTAMP '2000-06-01'"""),
    "date_range_two_ways": sql(f"""SELECT *, 'day' AS ends FROM hourly WHERE {DAY_RANGE.format(c='timestamp')}
        UNION ALL SELECT *, 'midnight' AS ends FROM hourly WHERE timestamp BETWEEN {RANGE}"""),
    # point in time
    "forecast_as_of": sql(f"""SELECT lat, lon, forecast_time, creation_time, temp_F FROM forecasts
        WHERE creation_time <= {AS_OF} AND forecast_time >= {AS_OF} QUALIFY row_number() OVER
        (PARTITION BY lat, lon, forecast_time ORDER BY creation_time DESC, temp_F DESC) = 1"""),
    "forecast_as_of_many": sql("""SELECT as_of, lat, lon, forecast_time, creation_time, temp_F
        FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS as_of FROM events)
        JOIN forecasts ON creation_time <= as_of AND forecast_time >= as_of QUALIFY row_number() OVER
        (PARTITION BY as_of, lat, lon, forecast_time ORDER BY creation_time DESC, temp_F DESC) = 1"""),
    # aggregations
    "profile_year": profile({"year": YEAR}),
    "profile_month": profile({"month": MONTH}),
    "profile_weekday": profile({"weekday": WEEKDAY}),
    "profile_hour": profile({"hour": HOUR}),
    "profile_month_hour": profile({"month": MONTH, "hour": HOUR}),
    "profile_by_value": profile({"temp_F": "temp_F"}),
    "profile_month_value": profile({"month": MONTH, "temp_F": "temp_F"}),
    "mean_by_weekday": sql(f"SELECT {WEEKDAY} AS weekday, {r('avg(value)', 'mean')} FROM shipments GROUP BY 1"),
    "pivot_hour_month": sql(f"""SELECT {HOUR} AS hour, {', '.join(r(f'avg(value) FILTER (month(ts) = {m})', f'm{m:02d}') for m in range(1, 13))}
        FROM shipments WHERE isodow(ts) <= 5 GROUP BY 1"""),
    "daily_sum_dense": """SELECT day::DATE AS day, round(coalesce(total, 0), 3) + 0.0 AS total FROM (
        SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders)
        LEFT JOIN (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS day, sum(o_totalprice) AS total FROM orders GROUP BY 1) USING (day)""",
    "distinct_versions": sql("SELECT DISTINCT model_version FROM metrics"),
    "monitor_kpis": sql(f"SELECT {KPI} FROM metrics"),
    "monitor_kpis_by_version": sql(f"SELECT model_version, {KPI} FROM metrics GROUP BY 1"),
    "describe_numeric": " UNION ALL ".join(
        sql(f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, min({c}) AS min,
        {r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')}, {r(f'quantile_cont({c}, 0.75)', 'p75')},
        max({c}) AS max FROM shipments""").join(("(", ")"))
        for c in ("value", "temp_F")
    ),
    "null_counts": sql("SELECT " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}"
        for c in ("temp_timestamp_mtn", "energy_timestamp_mtn", "energy_demand", "demand_units", "series_name", "temp_F",
                  "temp_C", "temp_location_lat", "temp_location_lon", "temp_source", "date_energy_updated")) + " FROM joined"),
    "rows_with_null": sql("SELECT * FROM joined WHERE temp_F IS NULL"),
    "null_observations": sql("SELECT * FROM station_obs WHERE temperature_degC IS NULL"),
    "error_histogram": sql(f"""SELECT bin::INTEGER AS bin, {r('lo + (hi - lo) / 20 * (bin - 1)', 'bin_low')}, {r('lo + (hi - lo) / 20 * bin', 'bin_high')},
        coalesce(n, 0) AS n FROM (SELECT min(energy_error) AS lo, max(energy_error) AS hi FROM metrics), range(1, 21) bins(bin)
        LEFT JOIN (SELECT least(CAST(floor((energy_error - lo) / (hi - lo) * 20) AS BIGINT) + 1, 20) AS bin, count(*) AS n FROM metrics,
        (SELECT min(energy_error) AS lo, max(energy_error) AS hi FROM metrics) WHERE energy_error IS NOT NULL GROUP BY 1) USING (bin)"""),
    # windows
    "median_filter": f"""SELECT event_id, event_type, ts, CASE WHEN seen = 24 AND v BETWEEN med - 2.5 * sd AND med + 2.5 * sd THEN v END AS value
        FROM (SELECT *, quantile_cont(v, 0.5) OVER f AS med, stddev_samp(v) OVER f AS sd, count(v) OVER f AS seen
        FROM (SELECT event_id, event_type, ts, CASE WHEN value > 0 THEN value END AS v FROM events)
        WINDOW f AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING))""",
    "rolling_mean_by_horizon": sql(window_mean({"mean": ("y", "")}, W)),
    "rolling_median_by_horizon": sql(window_median("y", "median", W)),
    # sorts and unions
    "station_topk": sql("""SELECT * FROM stations WHERE STATE = 'CO' AND "END" > DATE '2022-01-01' AND contains("STATION NAME", 'AIRPORT')
        ORDER BY "END" DESC, "STATION NAME", USAF, WBAN LIMIT 100"""),
    "union_years": sql("SELECT * EXCLUDE (year) FROM yearly WHERE year BETWEEN 1995 AND 2002"),
    # time series
    "upsample_linear": sql(f"""SELECT lat, lon, moment AS forecast_time, {r('coalesce(temp_F + (following - temp_F) * (epoch(moment) - epoch(forecast_time)) / (epoch(until) - epoch(forecast_time)), temp_F)', 'temp_F')}
        FROM (SELECT *, unnest(generate_series(forecast_time, coalesce(until - INTERVAL 1 HOUR, forecast_time), INTERVAL 1 HOUR)) AS moment
        FROM (SELECT *, lead(forecast_time) OVER o AS until, lead(temp_F) OVER o AS following FROM newest
        WINDOW o AS (PARTITION BY lat, lon ORDER BY forecast_time)))"""),
    "upsample_cubic": sql(f"SELECT lat, lon, forecast_time, {r('temp_F', 'temp_F')} FROM cubic_hourly"),
    "future_frame": sql("""SELECT DISTINCT series_id, timestamp FROM demand UNION ALL
        SELECT series_id, last + CAST(n AS INTEGER) * INTERVAL 1 HOUR FROM (SELECT series_id, max(timestamp) AS last FROM demand GROUP BY 1), range(1, 37) steps(n)"""),
    # models
    "fact_demand_actual": sql("SELECT * FROM raw_fact WHERE series_id = 'view'"),
    "fact_demand_forecast": sql("SELECT * FROM raw_fact WHERE series_id = 'click'"),
    "cast_station_weather": sql("SELECT * FROM isd"),
    "cast_live_weather": sql("SELECT * FROM owm"),
    "recorded_temperature": sql("SELECT * FROM temps"),
    "joined_temp_demand": sql("SELECT * FROM joined"),
    "joined_temp_demand_latest": sql("""SELECT observation_time_MTN AS temp_timestamp_mtn, timestamp_MTN AS energy_timestamp_mtn,
        value AS energy_demand, units AS demand_units, name AS series_name, temp_F, temp_C, lat AS temp_location_lat,
        lon AS temp_location_lon, source AS temp_source, updated AS date_energy_updated
        FROM fact LEFT JOIN (SELECT * FROM temps QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', observation_time_UTC)
        ORDER BY observation_time_UTC DESC, observation_time_MTN DESC, temp_F DESC, temp_C DESC, lat DESC, lon DESC, source DESC) = 1)
        ON date_trunc('hour', observation_time_UTC) = date_trunc('hour', timestamp_UTC)"""),
    "model_metrics": sql("SELECT * FROM metrics"),
    # forecast model
    "ols_univariate": sql(f"SELECT {r('regr_slope(value, temp_F)', 'slope', 4)}, {r('regr_intercept(value, temp_F)', 'intercept', 4)} FROM shipments"),
    "ols_full": sql("SELECT * FROM (" + " UNION ALL ".join([
        f"SELECT 'intercept' AS feature, {r('base', 'coefficient', 3)} FROM weights WHERE cutoff > TIMESTAMP '9000-01-01'",
        *(f"SELECT '{f}', {r(f'w_{f}', 'coefficient', 3)} FROM weights WHERE cutoff > TIMESTAMP '9000-01-01'" for f in VARYING),
        *(f"SELECT '{f}', 0.0::DOUBLE" for f in ("hour", "hour_squared", "hour_cubed")),
    ]) + ")"),
    "cv_full": sql(f"""SELECT temp_F, {CALENDAR.replace('ts', 'ds')}, temp_F * temp_F AS temp_F_squared, pow(hour(ds), 2)::DOUBLE AS hour_squared,
        pow(hour(ds), 3)::DOUBLE AS hour_cubed, ds, y, {r(predicted('ds', 'temp_F'), 'yhat', 4)}, cutoff
        FROM weights JOIN daily ON ds > cutoff AND ds <= cutoff + INTERVAL 10 DAY"""),
    "batch_predict": sql(f"""SELECT lat, lon, forecast_time AS energy_timestamp_mtn, {r(predicted(local('forecast_time'), 'temp_F'), 'predicted_energy_demand', 4)},
        {r('temp_F', 'temp_f_forecast')}, 'run-1' AS model_version, {AS_OF} AS prediction_start_date,
        TIMESTAMP '2024-01-15 06:00:00' AS prediction_creation_date FROM ahead_hourly, weights WHERE cutoff > TIMESTAMP '9000-01-01'"""),
    "ols_predict": sql(f"""SELECT ts, temp_F, value, {r('base + slope * temp_F', 'predicted', 4)} FROM shipments,
        (SELECT regr_slope(value, temp_F) AS slope, regr_intercept(value, temp_F) AS base FROM shipments)"""),
    "cv_cutoffs": sql("SELECT cutoff FROM cuts"),
    "cv_univariate": sql(f"SELECT temp_F, ds, y, {r('yhat', 'yhat')}, cutoff FROM cv"),
    "run_log": sql(f"SELECT run_id, {', '.join(r(m, m, 4) for m in ALL[:-1])} FROM runs"),
    "best_run": sql(f"SELECT run_id, {r('rmse', 'rmse', 4)} FROM runs ORDER BY runs.rmse, run_id LIMIT 1"),
    "model_roundtrip": sql(f"""SELECT ds, y, {r('base + slope * temp_F', 'predicted', 4)} FROM daily,
        (SELECT regr_slope(y, temp_F) AS slope, regr_intercept(y, temp_F) AS base FROM daily)"""),
    "prediction_frame": sql(f"""SELECT lat, lon, forecast_time AS energy_timestamp_mtn, {r('base + slope * temp_F', 'predicted_energy_demand', 4)},
        temp_F AS temp_f_forecast, 'run-1' AS model_version, {AS_OF} AS prediction_start_date,
        TIMESTAMP '2024-01-15 06:00:00' AS prediction_creation_date FROM newest,
        (SELECT regr_slope(value, temp_F) AS slope, regr_intercept(value, temp_F) AS base FROM shipments)"""),
    # evaluation
    **{f"metric_{m}": sql(window_mean({m: MEANS[m]}, W)) for m in ALL if m != "mdape"},
    "metric_mdape": sql(window_median("ape", "mdape", W)),
    "performance_metrics": sql(all_metrics(TENTH, ALL)),
    "performance_overall": sql(all_metrics(WHOLE, ALL[:-1])),
    "performance_monthly": sql(f"""SELECT ((year(ds) * 12 + month(ds)) - (year(cutoff) * 12 + month(cutoff)))::INTEGER AS horizon,
        {r('avg(se)', 'mse')}, {r('sqrt(avg(se))', 'rmse')}, {r('avg(ae)', 'mae')}, {r('avg(ape)', 'mape')},
        {r('quantile_cont(ape, 0.5)', 'mdape')}, {r('avg(sape)', 'smape')}, {r('avg(hit)', 'coverage')} FROM points GROUP BY 1"""),
    "performance_pointwise": sql(f"SELECT horizon, {POINT} FROM points"),
    # serving
    "serve_actual": sql(f"SELECT * FROM raw_fact WHERE series_id = 'view' AND {DAY_RANGE.format(c='timestamp_MTN')}"),
    "serve_utility_forecast": sql(f"SELECT * FROM raw_fact WHERE series_id = 'click' AND {DAY_RANGE.format(c='timestamp_MTN')}"),
    "serve_model_forecast": sql(f"""SELECT forecast_timestamp_mtn AS timestamp_MTN, predicted_energy_demand, temp_f_forecast, model_version
        FROM localized WHERE hours_from_pred_start < 24 AND model_version = 'v0' AND forecast_timestamp_mtn BETWEEN {RANGE}"""),
    "serve_temperature": sql(f"SELECT * FROM temps WHERE observation_time_MTN BETWEEN {RANGE}"),
    "serve_monitoring": sql(f"SELECT * FROM metrics WHERE hours_from_pred_start <= 24 AND {DAY_RANGE.format(c='energy_timestamp_mtn')}"),
    # grids
    "grid_project": f"SELECT point, {r(PX, 'x', 3)}, {r(PY, 'y', 3)} FROM ({CUSTOMERS})",
    "grid_cube": sql(f"SELECT valid_time, iy, ix, {r(f'{Y0} + iy * 200000.0::DOUBLE', 'y', 3)}, {r(f'{X0} + ix * 200000.0::DOUBLE', 'x', 3)}, value FROM grid_cells"),
    "grid_nearest": sql(f"""SELECT point, valid_time, p.iy, p.ix, value FROM grid_cells c JOIN (SELECT point,
        least(greatest(CAST(floor(({PY} - {Y0}) / 200000.0::DOUBLE + 0.5) AS INTEGER), 0), 9) AS iy,
        least(greatest(CAST(floor(({PX} - {X0}) / 200000.0::DOUBLE + 0.5) AS INTEGER), 0), 9) AS ix FROM ({NATIONS})) p
        ON p.iy = c.iy AND p.ix = c.ix"""),
    # streaming
    "stream_live_weather": sql("""SELECT temp, feels_like, temp_min, temp_max, pressure, humidity, timestamp, lon, lat FROM live_obs
        QUALIFY row_number() OVER (PARTITION BY lat, lon, timestamp
        ORDER BY temp DESC, feels_like DESC, temp_min DESC, temp_max DESC, pressure DESC, humidity DESC) = 1"""),
}
