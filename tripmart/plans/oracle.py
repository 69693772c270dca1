"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written against the raw supplied tables only: the trip fixture, Silver rules,
dimensions and fact are re-derived here in plain SQL, never by calling the
Spark code. Conventions that make values bit-identical across engines:
money/miles sums through DECIMAL(18,4); averages as double(sum)/count;
seconds as floor(epoch); Spark's HALF_UP rounding of doubles emulated by
rounding the shortest decimal text of the value.
"""

from __future__ import annotations

# Fixture, Silver, dimensions and fact as CTEs (see FIXTURES.md section 3).
BASE = r"""
WITH base AS (
  SELECT l.*, o.*,
         CAST(l.l_quantity * 60 - 90 AS BIGINT) AS d,
         o.o_orderdate + to_seconds(CAST(l.l_orderkey * 37 % 86400 AS BIGINT)) AS req,
         CAST(l.l_partkey % 900 + (l.l_suppkey % 7) * 30 - 15 AS BIGINT) AS pu_off
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
), trips AS (
  SELECT
    'HV000' || CAST(2 + l_suppkey % 5 AS VARCHAR) AS hvfhs_license_num,
    'B' || lpad(CAST(l_suppkey % 40 AS VARCHAR), 5, '0') AS dispatching_base_num,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'B' || lpad(CAST(o_custkey % 60 AS VARCHAR), 5, '0') END AS originating_base_num,
    req AS request_datetime,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE req + to_seconds(CAST(l_partkey % 900 - 20 AS BIGINT)) END AS on_scene_datetime,
    req + to_seconds(pu_off) AS pickup_datetime,
    req + to_seconds(pu_off + d) AS dropoff_datetime,
    CAST(o_custkey % 27 AS INTEGER) AS PULocationID,
    CAST(l_partkey % 25 AS INTEGER) AS DOLocationID,
    CAST(floor(l_discount * 100 + 0.5) * l_quantity * 1.25 AS DOUBLE) AS trip_miles,
    CAST(d + l_linenumber - 2 AS BIGINT) AS trip_time,
    CAST(CASE WHEN l_tax = 0.08 AND l_linenumber = 1 THEN -l_extendedprice ELSE l_extendedprice END AS DOUBLE) AS base_passenger_fare,
    CAST(CASE WHEN l_linestatus = 'O' THEN 0 ELSE floor(l_tax * 100 + 0.5) * 0.5 END AS DOUBLE) AS tolls,
    CAST(floor(l_discount * 100 + 0.5) * 0.25 AS DOUBLE) AS bcf,
    CAST(floor(l_tax * 100 + 0.5) * 0.75 AS DOUBLE) AS sales_tax,
    CAST(CASE WHEN o_custkey % 27 < 10 THEN 2.75 ELSE 0 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN l_partkey % 25 = 1 THEN 2.5 ELSE 0 END AS DOUBLE) AS airport_fee,
    CAST(floor(l_tax * 100 + 0.5) * 0.25 AS DOUBLE) AS tips,
    CAST(CASE WHEN l_suppkey % 50 = 7 THEN -l_extendedprice ELSE l_extendedprice END AS DOUBLE) AS driver_pay,
    CAST(CASE WHEN o_custkey % 27 < 5 THEN 1.5 ELSE 0 END AS DOUBLE) AS cbd_congestion_fee,
    CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'N' THEN 'N' END AS shared_request_flag,
    CASE WHEN l_returnflag = 'A' THEN NULL WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS shared_match_flag,
    CASE l_linenumber % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE ' ' END AS access_a_ride_flag,
    CASE WHEN l_linenumber = 7 THEN 'Y' ELSE 'N' END AS wav_request_flag,
    CASE WHEN l_linenumber >= 6 THEN 'Y' ELSE 'N' END AS wav_match_flag,
    strftime(o_orderdate, '%Y-%m') AS _source_month
  FROM base
), s1 AS (
  SELECT *,
    CASE WHEN coalesce(request_datetime > on_scene_datetime OR on_scene_datetime > pickup_datetime
                       OR pickup_datetime > dropoff_datetime, false) THEN 'ISSUE' ELSE 'OK' END AS timestamp_quality_flag,
    CASE WHEN coalesce(base_passenger_fare < 0 OR driver_pay < 0, false) THEN 'ISSUE' ELSE 'OK' END AS financial_quality_flag,
    CASE WHEN pickup_datetime >= request_datetime
         THEN CAST(floor(epoch(pickup_datetime)) AS BIGINT) - CAST(floor(epoch(request_datetime)) AS BIGINT) END AS customer_wait_seconds,
    CASE WHEN on_scene_datetime >= request_datetime
         THEN CAST(floor(epoch(on_scene_datetime)) AS BIGINT) - CAST(floor(epoch(request_datetime)) AS BIGINT) END AS driver_response_seconds,
    CASE WHEN dropoff_datetime >= pickup_datetime
         THEN CAST(floor(epoch(dropoff_datetime)) AS BIGINT) - CAST(floor(epoch(pickup_datetime)) AS BIGINT) END AS calculated_trip_time_seconds
  FROM trips
), s2 AS (
  SELECT *, coalesce(abs(trip_time - calculated_trip_time_seconds) <= 3, false) AS trip_time_consistent FROM s1
), silver AS (
  SELECT
    hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime,
    pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, base_passenger_fare,
    tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, cbd_congestion_fee,
    CASE shared_request_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS shared_request,
    CASE shared_match_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS shared_match,
    CASE access_a_ride_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS access_a_ride,
    CASE wav_request_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS wav_request,
    CASE wav_match_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS wav_match,
    customer_wait_seconds, driver_response_seconds, calculated_trip_time_seconds, trip_time_consistent,
    timestamp_quality_flag, financial_quality_flag,
    CASE WHEN timestamp_quality_flag = 'ISSUE' AND financial_quality_flag = 'ISSUE' THEN 'TIMESTAMP_AND_FINANCIAL_ISSUE'
         WHEN timestamp_quality_flag = 'ISSUE' THEN 'TIMESTAMP_ISSUE'
         WHEN financial_quality_flag = 'ISSUE' THEN 'FINANCIAL_ISSUE'
         WHEN NOT trip_time_consistent THEN 'TRIP_TIME_ISSUE'
         ELSE 'GOOD' END AS overall_quality_status,
    _source_month
  FROM s2
), lookup AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
         'SZ' || CAST(n_nationkey % 4 AS VARCHAR) AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
), dim_location AS (
  SELECT LocationID AS location_key, LocationID AS location_id, Borough AS borough, Zone AS zone, service_zone FROM lookup
), dim_provider AS (
  SELECT DISTINCT hvfhs_license_num AS provider_key, hvfhs_license_num AS provider_code,
    CASE hvfhs_license_num WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber' WHEN 'HV0004' THEN 'Via'
         WHEN 'HV0005' THEN 'Lyft' ELSE 'Unknown' END AS provider_name
  FROM silver
), members AS (
  SELECT _source_month, dispatching_base_num AS base_num FROM silver
  UNION ALL SELECT _source_month, originating_base_num FROM silver
), dim_dispatch AS (
  SELECT DISTINCT base_num AS dispatch_key, base_num FROM members WHERE base_num IS NOT NULL
), days AS (
  SELECT CAST(unnest(generate_series(min(CAST(pickup_datetime AS DATE)), max(CAST(pickup_datetime AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM silver
), dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM days
), fact AS (
  SELECT
    CAST(strftime(s.pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
    p.provider_key, pl.location_key AS pickup_location_key, dl.location_key AS dropoff_location_key,
    dd.dispatch_key AS dispatching_base_key, od.dispatch_key AS originating_base_key,
    s.*
  FROM silver s
  LEFT JOIN dim_provider p ON s.hvfhs_license_num = p.provider_code
  LEFT JOIN dim_location pl ON s.PULocationID = pl.location_id
  LEFT JOIN dim_location dl ON s.DOLocationID = dl.location_id
  LEFT JOIN dim_dispatch dd ON s.dispatching_base_num = dd.base_num
  LEFT JOIN dim_dispatch od ON s.originating_base_num = od.base_num
), copy_fact AS (
  SELECT CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
    hvfhs_license_num AS provider_key, PULocationID AS pickup_location_key, DOLocationID AS dropoff_location_key,
    dispatching_base_num AS dispatching_base_key, originating_base_num AS originating_base_key, *
  FROM silver
)
"""

SILVER_COLS = """hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime,
    pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, base_passenger_fare,
    tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, cbd_congestion_fee,
    shared_request, shared_match, access_a_ride, wav_request, wav_match, customer_wait_seconds,
    driver_response_seconds, calculated_trip_time_seconds, trip_time_consistent, timestamp_quality_flag,
    financial_quality_flag, overall_quality_status, _source_month"""

TRIP_COLS = """hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime,
    pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, base_passenger_fare,
    tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, cbd_congestion_fee,
    shared_request_flag, shared_match_flag, access_a_ride_flag, wav_request_flag, wav_match_flag"""

FACT_COLS = """date_key, provider_key, pickup_location_key, dropoff_location_key, dispatching_base_key,
    originating_base_key, request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, trip_miles,
    trip_time, calculated_trip_time_seconds, base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge,
    airport_fee, tips, driver_pay, cbd_congestion_fee, shared_request, shared_match, access_a_ride, wav_request,
    wav_match, customer_wait_seconds, driver_response_seconds, trip_time_consistent, timestamp_quality_flag,
    financial_quality_flag, overall_quality_status, _source_month"""


def _r2(x: str, digits: int = 2) -> str:
    """Spark's round(double, d): HALF_UP on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _dsum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,4))) AS DOUBLE)"


def _avg(c: str) -> str:
    return f"CAST(SUM({c}) AS DOUBLE) / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0)"


def _davg(c: str) -> str:
    return f"{_dsum(c)} / NULLIF(CAST(COUNT({c}) AS DOUBLE), 0)"


def _order_all(cols: str) -> str:
    return ", ".join(f"{c.strip()} ASC NULLS LAST" for c in cols.split(","))


def _mart_measures(duration: str, rounded: bool, kind: str) -> str:
    r = _r2 if rounded else (lambda x: x)
    dist = r(_davg("trip_miles")) if kind == "location" else _davg("trip_miles")
    parts = [
        "CAST(COUNT(*) AS BIGINT) AS total_trips",
        f"{_dsum('trip_miles')} AS total_trip_miles",
        f"{dist} AS avg_trip_distance",
        f"{r(f'({_avg(duration)}) / 60')} AS avg_trip_duration_minutes",
        f"{r(f'({_avg('customer_wait_seconds')}) / 60')} AS avg_customer_wait_minutes",
        f"{_dsum('base_passenger_fare')} AS total_passenger_fare",
        f"{_dsum('tips')} AS total_tips",
        f"{_dsum('driver_pay')} AS total_driver_pay",
    ]
    if kind == "daily":
        parts.append("CAST(count_if(overall_quality_status <> 'GOOD') AS BIGINT) AS quality_issue_trips")
    parts.append(f"{r(f'CASE WHEN {_dsum('trip_miles')} > 0 THEN {_dsum('base_passenger_fare')} / {_dsum('trip_miles')} END')} AS fare_per_mile")
    if kind == "daily":
        parts.append(f"{r(f'CASE WHEN {_dsum('trip_miles')} > 0 THEN {_dsum('driver_pay')} / {_dsum('trip_miles')} END')} AS driver_pay_per_mile")
    return ",\n  ".join(parts)


def _daily(duration: str = "trip_time", rounded: bool = False) -> str:
    return f"""SELECT f.date_key, dd.date, f.provider_key, p.provider_name,
  {_mart_measures(duration, rounded, 'daily')}
FROM fact f LEFT JOIN dim_provider p ON f.provider_key = p.provider_key LEFT JOIN dim_date dd ON f.date_key = dd.date_key
GROUP BY f.date_key, dd.date, f.provider_key, p.provider_name"""


def _location(role: str = "pickup", duration: str = "trip_time", rounded: bool = False) -> str:
    k = f"{role}_location_key"
    extra = "l.location_id, " if rounded else ""
    return f"""SELECT f.{k}, {extra}l.zone, l.borough, l.service_zone,
  {_mart_measures(duration, rounded, 'location')}
FROM fact f LEFT JOIN dim_location l ON f.{k} = l.location_key
GROUP BY f.{k}, {extra}l.zone, l.borough, l.service_zone"""


def _shared(rounded: bool = False) -> str:
    r = _r2 if rounded else (lambda x: x)
    return f"""SELECT provider_key, provider_name, total_trips, shared_requests, shared_matches,
  {r('CASE WHEN total_trips > 0 THEN CAST(shared_requests AS DOUBLE) / total_trips * CAST(100 AS DOUBLE) END')} AS shared_request_rate,
  {r('CASE WHEN total_trips > 0 THEN CAST(shared_matches AS DOUBLE) / total_trips * CAST(100 AS DOUBLE) END')} AS shared_match_rate
FROM (SELECT f.provider_key, p.provider_name, CAST(COUNT(*) AS BIGINT) AS total_trips,
        CAST(count_if(shared_request) AS BIGINT) AS shared_requests, CAST(count_if(shared_match) AS BIGINT) AS shared_matches
      FROM fact f LEFT JOIN dim_provider p ON f.provider_key = p.provider_key GROUP BY f.provider_key, p.provider_name) g"""


def _group_count(src: str, cols: str, name: str = "trip_count") -> str:
    return f"SELECT {cols}, CAST(COUNT(*) AS BIGINT) AS {name} FROM {src} GROUP BY {cols}"


def _checks(silver: str, fact: str, with_gold: bool, overall: bool, zones: str = "true", providers: str = "true") -> str:
    """Per-month verdict rows N1-N8 (+ N9-N11, N12); ``zones`` and ``providers`` say which mart rows are there."""
    gold = ""
    gold_rows = ""
    if with_gold:
        gold = f""", daily_m AS (
  SELECT strftime(dd.date, '%Y-%m') AS _source_month, CAST(COUNT(*) AS BIGINT) AS daily_gold_trips
  FROM {fact} f JOIN dim_date dd ON f.date_key = dd.date_key GROUP BY 1
), loc_m AS (SELECT pickup_location_key, COUNT(*) AS total_trips FROM {fact} GROUP BY 1
), shr_m AS (SELECT provider_key, COUNT(*) AS total_trips FROM {fact} GROUP BY 1
), tot AS (SELECT CAST(COUNT(*) AS BIGINT) AS t,
  (SELECT CAST(SUM(total_trips) AS BIGINT) FROM loc_m WHERE {zones}) AS lt,
  (SELECT CAST(SUM(total_trips) AS BIGINT) FROM shr_m WHERE {providers}) AS st FROM {fact})"""
        gold_rows = """
  UNION ALL SELECT m, 'N9', 'Daily Provider Gold reconciliation', CASE WHEN dg = fr THEN 'PASS' ELSE 'FAIL' END, dg, fr FROM mm
  UNION ALL SELECT m, 'N10', 'Location Gold reconciliation', CASE WHEN lt = t THEN 'PASS' ELSE 'FAIL' END, lt, t FROM mm
  UNION ALL SELECT m, 'N11', 'Shared Ride Gold reconciliation', CASE WHEN st = t THEN 'PASS' ELSE 'FAIL' END, st, t FROM mm"""
    sql = f"""
, sm AS (SELECT _source_month, CAST(COUNT(*) AS BIGINT) AS silver_rows FROM {silver} GROUP BY 1)
, fk AS (
  SELECT _source_month, COUNT(*) AS n,
    count_if(provider_key IS NULL) AS np, count_if(pickup_location_key IS NULL) AS npu,
    count_if(dropoff_location_key IS NULL) AS ndo, count_if(dispatching_base_key IS NULL) AS ndi,
    count_if(timestamp_quality_flag = 'ISSUE') AS ts, count_if(financial_quality_flag = 'ISSUE') AS fi
  FROM {fact}
  GROUP BY _source_month, hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, PULocationID,
           DOLocationID, trip_miles, trip_time, base_passenger_fare, driver_pay
)
, fm AS (
  SELECT _source_month, CAST(SUM(n) AS BIGINT) AS fact_rows, CAST(count_if(n > 1) AS BIGINT) AS dup,
    CAST(SUM(np) AS BIGINT) AS np, CAST(SUM(npu) AS BIGINT) AS npu, CAST(SUM(ndo) AS BIGINT) AS ndo,
    CAST(SUM(ndi) AS BIGINT) AS ndi, CAST(SUM(ts) AS BIGINT) AS ts, CAST(SUM(fi) AS BIGINT) AS fi
  FROM fk GROUP BY 1
){gold}
, mm AS (
  SELECT coalesce(sm._source_month, fm._source_month) AS m, coalesce(silver_rows, 0) AS sr, coalesce(fact_rows, 0) AS fr,
    coalesce(dup, 0) AS dup, coalesce(np, 0) AS np, coalesce(npu, 0) AS npu, coalesce(ndo, 0) AS ndo,
    coalesce(ndi, 0) AS ndi, coalesce(ts, 0) AS ts, coalesce(fi, 0) AS fi
    {", coalesce(daily_m.daily_gold_trips, 0) AS dg, tot.t AS t, tot.lt AS lt, tot.st AS st" if with_gold else ""}
  FROM sm FULL JOIN fm ON sm._source_month = fm._source_month
  {"LEFT JOIN daily_m ON daily_m._source_month = coalesce(sm._source_month, fm._source_month) CROSS JOIN tot" if with_gold else ""}
)
, rep AS (
  SELECT m AS source_month, 'N1' AS check_id, 'Silver row count' AS check_name,
         CASE WHEN sr > 0 THEN 'PASS' ELSE 'FAIL' END AS status, sr AS observed, CAST(1 AS BIGINT) AS expected FROM mm
  UNION ALL SELECT m, 'N2', 'Silver → Fact row reconciliation', CASE WHEN fr = sr THEN 'PASS' ELSE 'FAIL' END, fr, sr FROM mm
  UNION ALL SELECT m, 'N3', 'Duplicate trip key check', CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END, dup, 0 FROM mm
  UNION ALL SELECT m, 'N4', 'Provider key coverage', CASE WHEN np = 0 THEN 'PASS' ELSE 'FAIL' END, np, 0 FROM mm
  UNION ALL SELECT m, 'N5', 'Location key coverage', CASE WHEN npu = 0 AND ndo = 0 THEN 'PASS' ELSE 'FAIL' END, npu + ndo, 0 FROM mm
  UNION ALL SELECT m, 'N6', 'Dispatching key coverage', CASE WHEN ndi = 0 THEN 'PASS' ELSE 'FAIL' END, ndi, 0 FROM mm
  UNION ALL SELECT m, 'N7', 'Timestamp quality check', CASE WHEN ts = 0 THEN 'PASS' ELSE 'WARNING' END, ts, 0 FROM mm
  UNION ALL SELECT m, 'N8', 'Financial quality check', CASE WHEN fi = 0 THEN 'PASS' ELSE 'WARNING' END, fi, 0 FROM mm{gold_rows}
)
"""
    if overall:
        sql += """
SELECT * FROM rep
UNION ALL
SELECT source_month, 'N12', 'Data quality result',
       CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAILED' ELSE 'PASSED' END,
       CAST(count_if(status = 'FAIL') AS BIGINT),
       CASE WHEN count_if(status = 'FAIL') > 0 THEN NULL ELSE CAST(count_if(status = 'WARNING') AS BIGINT) END
FROM rep GROUP BY source_month"""
    else:
        sql += "SELECT * FROM rep"
    return sql


def _stats(src: str, cols: list[str]) -> str:
    """count, mean, stddev (exact moments), min, quartiles (quantile_cont), max as rows."""
    aggs = []
    for c in cols:
        aggs.append(
            f"CAST(COUNT({c}) AS DOUBLE) AS {c}__n, CAST(SUM({c}) AS DOUBLE) AS {c}__s, "
            f"CAST(SUM(CAST({c} AS DECIMAL(20,0)) * CAST({c} AS DECIMAL(20,0))) AS DOUBLE) AS {c}__q, "
            f"CAST(MIN({c}) AS DOUBLE) AS {c}__min, CAST(MAX({c}) AS DOUBLE) AS {c}__max, "
            f"quantile_cont({c}, 0.25) AS {c}__p25, quantile_cont({c}, 0.5) AS {c}__p50, quantile_cont({c}, 0.75) AS {c}__p75"
        )
    rows = []
    for st in ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]:
        vals = []
        for c in cols:
            v = {
                "count": f"{c}__n",
                "mean": f"CASE WHEN {c}__n > 0 THEN {c}__s / {c}__n END",
                "stddev": _r2(f"CASE WHEN {c}__n > 1 THEN sqrt(({c}__q - {c}__s * {c}__s / {c}__n) / ({c}__n - 1)) END", 6),
                "min": f"{c}__min",
                "25%": f"CAST({c}__p25 AS DOUBLE)",
                "50%": f"CAST({c}__p50 AS DOUBLE)",
                "75%": f"CAST({c}__p75 AS DOUBLE)",
                "max": f"{c}__max",
            }[st]
            vals.append(f"{v} AS {c}")
        rows.append(f"SELECT '{st}' AS statistic, {', '.join(vals)} FROM w")
    return f", w AS (SELECT {', '.join(aggs)} FROM {src})\n" + "\nUNION ALL ".join(rows)


TOP_COLS = """hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID,
    trip_miles, trip_time, calculated_trip_time_seconds, base_passenger_fare, driver_pay, overall_quality_status"""

KEY10 = ["hvfhs_license_num", "request_datetime", "pickup_datetime", "dropoff_datetime", "PULocationID",
         "DOLocationID", "trip_miles", "trip_time", "base_passenger_fare", "driver_pay"]


def _nulls_long(src: str, cols: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM {src}" for c in cols
    )


def _anti(src: str, col: str, members: str, mcol: str, out: str) -> str:
    return (f"SELECT DISTINCT x.{col} AS {out} FROM {src} x "
            f"WHERE NOT EXISTS (SELECT 1 FROM {members} m WHERE m.{mcol} = x.{col})")


def _corr() -> str:
    ms = ["trip_miles", "base_passenger_fare", "tips", "driver_pay"]
    pairs = [(a, b) for i, a in enumerate(ms) for b in ms[i + 1:]]
    dec = lambda c: f"CAST(CAST({c} AS DECIMAL(18,4)) AS DECIMAL(38,4))"
    aggs = ["CAST(COUNT(*) AS DOUBLE) AS n"]
    for m in ms:
        aggs.append(f"CAST(SUM({dec(m)}) AS DOUBLE) AS s_{m}")
        aggs.append(f"CAST(SUM({dec(m)} * {dec(m)}) AS DOUBLE) AS q_{m}")
    for a, b in pairs:
        aggs.append(f"CAST(SUM({dec(a)} * {dec(b)}) AS DOUBLE) AS x_{a}_{b}")
    var = lambda m: f"(n * q_{m} - s_{m} * s_{m})"
    rows = []
    for a, b in pairs:
        cov = f"(n * x_{a}_{b} - s_{a} * s_{b})"
        den = f"sqrt({var(a)} * {var(b)})"
        rows.append(f"SELECT '{a}' AS measure_x, '{b}' AS measure_y, "
                    f"{_r2(f'CASE WHEN {den} > 0 THEN {cov} / {den} END', 8)} AS correlation FROM mo")
    return f", mo AS (SELECT {', '.join(aggs)} FROM silver)\n" + "\nUNION ALL ".join(rows)


def _surrogate_incremental() -> str:
    return """
, mem AS (SELECT DISTINCT base_num, _source_month = (SELECT MIN(_source_month) FROM silver) AS first_month
          FROM members WHERE base_num IS NOT NULL)
, b1 AS (SELECT DISTINCT base_num FROM mem WHERE first_month)
, k1 AS (SELECT CAST(row_number() OVER (ORDER BY base_num) AS BIGINT) AS dispatch_key, base_num FROM b1)
, b2 AS (SELECT DISTINCT base_num FROM mem WHERE NOT first_month AND base_num NOT IN (SELECT base_num FROM b1))
SELECT * FROM k1
UNION ALL
SELECT CAST((SELECT coalesce(MAX(dispatch_key), 0) FROM k1) + row_number() OVER (ORDER BY base_num) AS BIGINT), base_num FROM b2
"""


def _spill(fact: str = "fact") -> str:
    """Dates of the file months' trips that lie in other calendar months, from both sides."""
    month = "strftime(dd.date, '%Y-%m')"
    return f"""SELECT f._source_month AS source_month, {month} AS calendar_month, dd.date AS date, 'out' AS direction, CAST(COUNT(*) AS BIGINT) AS trips
FROM {fact} f LEFT JOIN dim_date dd ON f.date_key = dd.date_key WHERE {month} IS DISTINCT FROM f._source_month GROUP BY 1, 2, 3
UNION ALL
SELECT {month}, {month}, dd.date, 'in', CAST(COUNT(*) AS BIGINT)
FROM {fact} f JOIN dim_date dd ON f.date_key = dd.date_key
WHERE {month} <> f._source_month AND {month} IN (SELECT _source_month FROM {fact}) GROUP BY 1, 2, 3"""


def queries() -> dict[str, str]:
    spill = _spill()
    daily = _daily()
    loc = _location()
    shared = _shared()
    trip_cols_plus = TRIP_COLS + ", _source_month"
    q = {
        "silver_trips": f"SELECT {SILVER_COLS} FROM silver",
        "quality_status_distribution": _group_count("silver", "overall_quality_status"),
        "quality_flag_by_month": _group_count("silver", "_source_month, timestamp_quality_flag, financial_quality_flag"),
        "anomaly_flag_matrix": _group_count(
            "(SELECT coalesce(trip_miles = 0, false) AS zero_distance_flag, coalesce(trip_miles > 500, false) AS extreme_distance_flag, "
            "coalesce(trip_time > 21600, false) AS extreme_duration_flag FROM silver) a",
            "zero_distance_flag, extreme_distance_flag, extreme_duration_flag"),
        "preview_silver": f"SELECT {SILVER_COLS} FROM silver ORDER BY {_order_all(SILVER_COLS)} LIMIT 20",
        "extract_negative_fare": (
            "SELECT hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, trip_miles, trip_time, "
            "base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay FROM trips "
            "WHERE base_passenger_fare < 0 ORDER BY " + _order_all(
                "hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, trip_miles, trip_time, "
                "base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay") + " LIMIT 20"),
        "extract_negative_pay": (
            "SELECT hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, trip_miles, trip_time, "
            "base_passenger_fare, tips, driver_pay FROM trips WHERE driver_pay < 0"),
        "extract_bad_timestamps": (
            "SELECT hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, "
            "pickup_datetime, dropoff_datetime, trip_miles, trip_time FROM trips WHERE request_datetime > on_scene_datetime ORDER BY "
            + _order_all("hvfhs_license_num, dispatching_base_num, originating_base_num, request_datetime, on_scene_datetime, "
                         "pickup_datetime, dropoff_datetime, trip_miles, trip_time") + " LIMIT 20"),
        "extract_zero_distance": (
            "SELECT hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, "
            "trip_miles, trip_time, base_passenger_fare, driver_pay, overall_quality_status FROM silver WHERE trip_miles = 0 ORDER BY "
            + _order_all("hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, "
                         "trip_miles, trip_time, base_passenger_fare, driver_pay, overall_quality_status") + " LIMIT 20"),
        "dispatch_bases_month": "SELECT DISTINCT _source_month, base_num FROM members WHERE base_num IS NOT NULL",
        "month_slice": f"SELECT {SILVER_COLS} FROM silver WHERE _source_month = '1995-01'",
        "month_slice_by_date": f"SELECT * FROM ({daily}) g WHERE date >= DATE '1995-03-01' AND date < DATE '1995-04-01'",
        "dim_location": "SELECT * FROM dim_location",
        "dim_provider": "SELECT * FROM dim_provider",
        "dim_date": "SELECT * FROM dim_date",
        "dim_date_weekend_counts": _group_count("dim_date", "is_weekend", "day_count"),
        "dim_dispatch": "SELECT * FROM dim_dispatch",
        "dim_surrogate_key": "SELECT CAST(row_number() OVER (ORDER BY base_num) AS BIGINT) AS dispatch_key, base_num FROM dim_dispatch",
        "dim_dispatch_incremental": "SELECT * FROM dim_dispatch",
        "dim_surrogate_key_incremental": _surrogate_incremental(),
        "dim_dispatch_union_rebuild": "SELECT * FROM dim_dispatch",
        "trip_key_uniqueness": (
            f"SELECT CAST(SUM(n) AS BIGINT) AS trip_rows, CAST(count_if(n > 1) AS BIGINT) AS duplicate_key_groups "
            f"FROM (SELECT COUNT(*) AS n FROM silver GROUP BY {', '.join(KEY10)}) g"),
        "fact_trip": f"SELECT {FACT_COLS} FROM fact",
        "fact_trip_copy_keys": f"SELECT {FACT_COLS} FROM copy_fact",
        "dim_key_uniqueness": "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(SUM(n) AS BIGINT) AS row_count, CAST(COUNT(k) AS BIGINT) AS distinct_keys, "
            f"CAST(count_if(k IS NOT NULL AND n > 1) AS BIGINT) AS repeated_keys, "
            f"CAST(coalesce(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys "
            f"FROM (SELECT {k} AS k, COUNT(*) AS n FROM {t} GROUP BY {k}) g"
            for t, k in [("dim_location", "location_key"), ("dim_provider", "provider_key"), ("dim_date", "date_key"),
                         ("dim_dispatch", "dispatch_key")]),
        "invalid_pickup_ids": _anti("silver", "PULocationID", "lookup", "LocationID", "LocationID"),
        "invalid_dropoff_ids": _anti("silver", "DOLocationID", "lookup", "LocationID", "LocationID"),
        "orphan_provider_keys": (
            "SELECT DISTINCT provider_key FROM copy_fact WHERE provider_key IS NULL "
            "OR provider_key NOT IN ('HV0002', 'HV0003', 'HV0004', 'HV0005')"),
        "orphan_pickup_keys": _anti("copy_fact", "pickup_location_key", "dim_location", "location_key", "pickup_location_key"),
        "orphan_dropoff_keys": _anti("copy_fact", "dropoff_location_key", "dim_location", "location_key", "dropoff_location_key"),
        "orphan_date_keys": _anti("fact", "date_key", "dim_date", "date_key", "date_key"),
        "bases_in_both_roles": (
            "SELECT DISTINCT dispatching_base_num AS base_num FROM silver WHERE dispatching_base_num IS NOT NULL "
            "INTERSECT SELECT DISTINCT originating_base_num FROM silver WHERE originating_base_num IS NOT NULL"),
        "trips_by_provider": _group_count("fact", "provider_key"),
        "trips_by_dispatching_base": _group_count("silver", "dispatching_base_num"),
        "trips_by_originating_base": _group_count("silver", "originating_base_num"),
        "trips_by_date_key": _group_count("fact", "date_key") + " ORDER BY date_key",
        "profile_ranges": (
            f"SELECT MIN(trip_miles) AS min_trip_miles, MAX(trip_miles) AS max_trip_miles, {_davg('trip_miles')} AS avg_trip_miles, "
            f"MIN(trip_time) AS min_trip_time, MAX(trip_time) AS max_trip_time, {_avg('trip_time')} AS avg_trip_time, "
            "MIN(base_passenger_fare) AS min_base_fare, MAX(base_passenger_fare) AS max_base_fare, "
            "MIN(driver_pay) AS min_driver_pay, MAX(driver_pay) AS max_driver_pay FROM silver"),
        "profile_time_range": (
            "SELECT _source_month, CAST(COUNT(*) AS BIGINT) AS trip_count, MIN(pickup_datetime) AS min_pickup_datetime, "
            "MAX(pickup_datetime) AS max_pickup_datetime FROM trips GROUP BY _source_month"),
        "profile_locations": (
            "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, CAST(count_if(PULocationID IS NULL) AS BIGINT) AS null_pickup_location, "
            "CAST(count_if(DOLocationID IS NULL) AS BIGINT) AS null_dropoff_location, MIN(PULocationID) AS min_pickup_location, "
            "MAX(PULocationID) AS max_pickup_location, MIN(DOLocationID) AS min_dropoff_location, "
            "MAX(DOLocationID) AS max_dropoff_location FROM trips"),
        "profile_nulls": "SELECT " + ", ".join(
            f"CAST(count_if({c.strip()} IS NULL) AS BIGINT) AS null_{c.strip()}" for c in TRIP_COLS.split(",")) + " FROM trips",
        "profile_nulls_long": _nulls_long("silver", KEY10),
        "duplicate_business_rows": (
            "SELECT CAST(COUNT(*) AS BIGINT) AS duplicate_groups, CAST(coalesce(SUM(n), 0) AS BIGINT) AS duplicated_rows FROM ("
            "SELECT COUNT(*) AS n FROM silver GROUP BY hvfhs_license_num, dispatching_base_num, originating_base_num, "
            "request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, "
            "trip_time, base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, "
            "cbd_congestion_fee, shared_request, shared_match, access_a_ride, wav_request, wav_match HAVING COUNT(*) > 1) g"),
        "summary_timestamp_gap": _stats(
            "(SELECT abs(CAST(floor(epoch(on_scene_datetime)) AS BIGINT) - CAST(floor(epoch(request_datetime)) AS BIGINT)) "
            "AS seconds_difference FROM trips WHERE request_datetime > on_scene_datetime) g", ["seconds_difference"]),
        "summary_trip_time_diff": _stats(
            "(SELECT trip_time, c AS calculated_trip_time_seconds, trip_time - c AS difference_seconds FROM ("
            "SELECT trip_time, CAST(floor(epoch(dropoff_datetime)) AS BIGINT) - CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS c "
            "FROM trips) x) g", ["trip_time", "calculated_trip_time_seconds", "difference_seconds"]),
        "flag_value_counts": "\nUNION ALL ".join(
            f"SELECT '{c}' AS flag_column, {c} AS flag_value, CAST(COUNT(*) AS BIGINT) AS trip_count FROM trips GROUP BY {c}"
            for c in ["shared_request_flag", "shared_match_flag", "access_a_ride_flag", "wav_request_flag", "wav_match_flag"]),
        "profile_timestamp_order": (
            "SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, "
            "CAST(count_if(request_datetime > on_scene_datetime) AS BIGINT) AS request_after_on_scene, "
            "CAST(count_if(on_scene_datetime > pickup_datetime) AS BIGINT) AS on_scene_after_pickup, "
            "CAST(count_if(pickup_datetime > dropoff_datetime) AS BIGINT) AS pickup_after_dropoff FROM trips"),
        "profile_negatives": "SELECT " + ", ".join(
            f"CAST(count_if({c} < 0) AS BIGINT) AS {a}" for a, c in [
                ("negative_trip_miles", "trip_miles"), ("negative_trip_time", "trip_time"),
                ("negative_base_fare", "base_passenger_fare"), ("negative_tolls", "tolls"), ("negative_bcf", "bcf"),
                ("negative_sales_tax", "sales_tax"), ("negative_tips", "tips"), ("negative_driver_pay", "driver_pay")]) + " FROM trips",
        "profile_fact_key_nulls": _nulls_long("fact", ["date_key", "provider_key", "pickup_location_key",
                                                       "dropoff_location_key", "originating_base_key", "dispatching_base_key"]),
        "gold_daily_provider": daily,
        "gold_daily_provider_rounded": _daily("calculated_trip_time_seconds", rounded=True),
        "gold_location": loc,
        "gold_location_rounded": _location(duration="calculated_trip_time_seconds", rounded=True),
        "gold_dropoff_location": _location(role="dropoff"),
        "gold_shared_ride": shared,
        "gold_shared_ride_rounded": _shared(rounded=True),
        "shared_request_match_share": (
            f"SELECT *, CASE WHEN shared_requests > 0 THEN CAST(shared_matches AS DOUBLE) / shared_requests * CAST(100 AS DOUBLE) END "
            f"AS shared_request_match_share FROM ({shared}) s"),
        "demand_by_day_hour": (
            "SELECT CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS day_of_week, dayname(pickup_datetime) AS day_name, "
            "CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, CAST(COUNT(*) AS BIGINT) AS total_trips FROM silver "
            "GROUP BY 1, 2, 3"),
        "measure_correlations": _corr(),
        "top_longest_trips": f"SELECT {TOP_COLS} FROM silver ORDER BY trip_time DESC NULLS LAST, {_order_all(TOP_COLS)} LIMIT 20",
        "top_farthest_trips": f"SELECT {TOP_COLS} FROM silver ORDER BY trip_miles DESC NULLS LAST, {_order_all(TOP_COLS)} LIMIT 20",
        "top_pickup_zones": f"SELECT * FROM ({loc}) g ORDER BY total_trips DESC, pickup_location_key ASC NULLS LAST LIMIT 20",
        "top_revenue_zones": f"SELECT * FROM ({loc}) g ORDER BY total_passenger_fare DESC, pickup_location_key ASC NULLS LAST LIMIT 20",
        "dq_report": _checks("silver", "fact", with_gold=True, overall=True),
        "dq_report_with_duplicates": (
            ", silver2 AS (SELECT * FROM silver UNION ALL SELECT * FROM silver), fact2 AS (SELECT * FROM fact UNION ALL SELECT * FROM fact)"
            + _checks("silver2", "fact2", with_gold=True, overall=True)),
        "dq_report_with_defects": (
            ", dim_known AS (SELECT * FROM dim_provider WHERE provider_name <> 'Unknown')"
            ", dim_short AS (SELECT * FROM dim_dispatch WHERE base_num <> (SELECT MIN(base_num) FROM dim_dispatch))"
            ", silver3 AS (SELECT * FROM silver WHERE _source_month <> (SELECT MIN(_source_month) FROM silver))"
            ", fact3 AS (SELECT f.* REPLACE (p.provider_key AS provider_key, d.dispatch_key AS dispatching_base_key)"
            " FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE _source_month = (SELECT MAX(_source_month) FROM fact)) f"
            " LEFT JOIN dim_known p ON f.hvfhs_license_num = p.provider_code LEFT JOIN dim_short d ON f.dispatching_base_num = d.base_num)"
            + _checks("silver3", "fact3", with_gold=True, overall=True, providers="provider_key IS NOT NULL",
                      zones="pickup_location_key IS DISTINCT FROM (SELECT MAX(location_key) FROM dim_location)")),
        "dq_fact_checks": _checks("silver", "fact", with_gold=False, overall=False),
        "dq_gold_reconciliation": ", full_rep AS (SELECT 1)" + _checks("silver", "fact", with_gold=True, overall=False).replace(
            "SELECT * FROM rep", "SELECT * FROM rep WHERE check_id IN ('N9', 'N10', 'N11')"),
        "rows_per_month": _group_count("silver", "_source_month", "row_count"),
        "bronze_ingest": f"SELECT {trip_cols_plus}, _source_month AS source_file_month FROM trips",
        "source_inventory": "SELECT _source_month AS month, CAST(COUNT(*) AS BIGINT) AS row_count, true AS files_filled FROM trips GROUP BY 1",
        "anomaly_flag_matrix_lowered": _group_count(
            "(SELECT coalesce(trip_miles = 0, false) AS zero_distance_flag, coalesce(trip_miles > 100, false) AS extreme_distance_flag, "
            "coalesce(trip_time > 1800, false) AS extreme_duration_flag FROM silver) a",
            "zero_distance_flag, extreme_distance_flag, extreme_duration_flag"),
        "preview_trip_time_diff": (
            "SELECT hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, trip_time, c AS calculated_trip_time_seconds, "
            "trip_time - c AS difference_seconds FROM (SELECT *, CAST(floor(epoch(dropoff_datetime)) AS BIGINT) - "
            "CAST(floor(epoch(pickup_datetime)) AS BIGINT) AS c FROM trips) x ORDER BY " + _order_all(
                "hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, trip_time, c, difference_seconds") + " LIMIT 20"),
        "dim_key_uniqueness_with_defects": "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(SUM(n) AS BIGINT) AS row_count, CAST(COUNT(k) AS BIGINT) AS distinct_keys, "
            f"CAST(count_if(k IS NOT NULL AND n > 1) AS BIGINT) AS repeated_keys, "
            f"CAST(coalesce(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_keys "
            f"FROM (SELECT k, COUNT(*) AS n FROM (SELECT {k} AS k FROM {t} UNION ALL SELECT MIN({k}) FROM {t} UNION ALL SELECT NULL) u GROUP BY k) g"
            for t, k in [("dim_location", "location_key"), ("dim_provider", "provider_key"), ("dim_date", "date_key"),
                         ("dim_dispatch", "dispatch_key")]),
        "invalid_dropoff_ids_short_lookup": _anti("silver", "DOLocationID", "(SELECT * FROM lookup WHERE LocationID >= 3)", "LocationID", "LocationID"),
        "orphan_date_keys_workdays": _anti("fact", "date_key", "(SELECT * FROM dim_date WHERE NOT is_weekend)", "date_key", "date_key"),
        "duplicate_business_rows_seeded": (
            "SELECT CAST(COUNT(*) AS BIGINT) AS duplicate_groups, CAST(coalesce(SUM(n), 0) AS BIGINT) AS duplicated_rows FROM ("
            f"SELECT COUNT(*) AS n FROM (SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE _source_month = (SELECT MAX(_source_month) FROM silver)) u "
            "GROUP BY hvfhs_license_num, dispatching_base_num, originating_base_num, "
            "request_datetime, on_scene_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, "
            "trip_time, base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, airport_fee, tips, driver_pay, "
            "cbd_congestion_fee, shared_request, shared_match, access_a_ride, wav_request, wav_match HAVING COUNT(*) > 1) g"),
        "run_stage_results": "\nUNION ALL ".join(
            f"SELECT _source_month AS month, '{st}' AS stage, 'loaded' AS status, CAST(COUNT(*) AS BIGINT) AS rows FROM {src} GROUP BY 1"
            for st, src in [("bronze", "trips"), ("silver", "silver"), ("fact", "fact")]),
        "published_gold_location": loc,
        "scan_csv_lookup": "SELECT * FROM lookup",
        "schema_drift": (
            ", ends AS (SELECT MIN(_source_month) AS a, MAX(_source_month) AS b FROM trips), "
            "n AS (SELECT CAST(COUNT(*) AS BIGINT) AS landed_rows, CAST(count_if(trip_time > 600) AS BIGINT) AS long_trips "
            "FROM trips WHERE _source_month = (SELECT b FROM ends)) "
            "SELECT t.*, CASE WHEN change = 'missing' THEN 0 WHEN change = 'new' THEN long_trips ELSE landed_rows END AS filled_rows, b AS month "
            "FROM n, ends, (VALUES ('cbd_congestion_fee', 'missing', 'double', NULL), "
            "('surge_fee', 'new', NULL, 'double'), ('trip_time', 'retyped', 'bigint', 'double')) "
            "AS t(column_name, change, expected_type, actual_type)"),
        "schema_evolution": (
            ", m AS (SELECT _source_month AS source_month, row_number() OVER (ORDER BY _source_month) > (COUNT(*) OVER ()) // 2 AS changed "
            "FROM (SELECT DISTINCT _source_month FROM trips)) "
            "SELECT source_month, CAST(COUNT(*) AS BIGINT) AS fact_rows, CAST(count_if(changed AND trip_time > 600) AS BIGINT) AS surge_rows, "
            "SUM(CASE WHEN changed AND trip_time > 600 THEN floor(trip_time / 60) * 0.25 END) AS surge_total, "
            "CAST(COUNT(location_key) AS BIGINT) AS pickup_keys, "
            "CAST(COUNT(DISTINCT (hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, PULocationID, DOLocationID, trip_miles, trip_time, "
            "base_passenger_fare, driver_pay)) AS BIGINT) AS trip_keys, CAST(count_if(changed AND PULocationID = 26) AS BIGINT) AS wide_zones, 'bigint' AS zone_type "
            "FROM trips JOIN m ON source_month = _source_month LEFT JOIN dim_location ON location_id = PULocationID GROUP BY source_month"),
        "quarantine_report": (
            ", k AS (SELECT _source_month, ((trip_time % 50) + 50) % 50 AS k FROM trips) "
            "SELECT _source_month, reason, CAST(COUNT(*) AS BIGINT) AS row_count FROM k JOIN (VALUES (1, 'type:trip_time'), (2, 'type:pickup_datetime'), "
            "(3, 'type:PULocationID'), (3, 'type:tips'), (4, 'fields'), (5, 'fields')) AS r(k_at, reason) ON k = k_at GROUP BY 1, 2"),
        "quarantine_good_rows": f"SELECT {SILVER_COLS} FROM silver WHERE ((trip_time % 50) + 50) % 50 NOT BETWEEN 1 AND 5",
        "trip_identity": (
            ", ends AS (SELECT MIN(_source_month) AS a, MAX(_source_month) AS b FROM silver), k AS (SELECT hvfhs_license_num, request_datetime, pickup_datetime, "
            "dropoff_datetime, PULocationID AS pu, DOLocationID AS dz, trip_miles, trip_time, base_passenger_fare, driver_pay, _source_month FROM silver), "
            "seeded AS (SELECT * FROM k UNION ALL SELECT k.* FROM k, ends WHERE _source_month = b "
            "UNION ALL SELECT k.* REPLACE (NULL AS dz) FROM k, ends WHERE _source_month = a UNION ALL SELECT k.* REPLACE (NULL AS pu, pu AS dz) FROM k, ends WHERE _source_month = a), "
            # equal keys: the values without NULLs, types and order kept
            "per_trip AS (SELECT * EXCLUDE (_source_month), COUNT(*) AS n FROM seeded GROUP BY ALL), "
            "per_key AS (SELECT COUNT(*) AS trips, SUM(n) AS key_rows FROM per_trip GROUP BY hvfhs_license_num, request_datetime, pickup_datetime, dropoff_datetime, "
            "coalesce(pu, dz), CASE WHEN pu IS NOT NULL THEN dz END, trip_miles, trip_time, base_passenger_fare, driver_pay HAVING SUM(n) > 1) "
            "SELECT CASE WHEN trips = 1 THEN 'duplicate' WHEN trips = key_rows THEN 'collision' ELSE 'both' END AS verdict, CAST(COUNT(*) AS BIGINT) AS key_count, "
            "CAST(SUM(trips) AS BIGINT) AS trip_count, CAST(SUM(key_rows) AS BIGINT) AS row_count, CAST(SUM(key_rows - trips) AS BIGINT) AS surplus_rows FROM per_key GROUP BY 1"),
        "sketch_quantiles": "\nUNION ALL ".join(
            f"SELECT '{m}' AS measure, CAST(p AS DOUBLE) AS probability, CAST(n AS BIGINT) AS value_count, true AS within_bound "
            f"FROM (SELECT COUNT({m}) AS n FROM silver), (VALUES (0.05), (0.25), (0.5), (0.75), (0.95), (0.99)) AS ps(p) WHERE n > 0"
            for m in ("trip_miles", "trip_time", "base_passenger_fare", "driver_pay", "customer_wait_seconds")),
        "dq_spill_rows": spill,
        "dq_spill_months": (
            f", spilled AS ({spill}) SELECT source_month, CAST(coalesce(SUM(trips) FILTER (direction = 'in'), 0) - coalesce(SUM(trips) FILTER (direction = 'out'), 0) AS BIGINT) AS spill_rows, "
            "CAST(coalesce(SUM(trips) FILTER (direction = 'out'), 0) AS BIGINT) AS spill_out, CAST(coalesce(SUM(trips) FILTER (direction = 'in'), 0) AS BIGINT) AS spill_in "
            "FROM spilled GROUP BY source_month"),
        "landing_reissue": (
            ", m AS (SELECT _source_month AS month, row_number() OVER (ORDER BY _source_month) AS i FROM (SELECT DISTINCT _source_month FROM trips)) "
            "SELECT t._source_month AS month, CASE WHEN i <= 3 THEN 'loaded' ELSE 'skipped' END AS second_run, "
            "CAST(SUM(CASE WHEN i = 1 THEN CAST(PULocationID >= 5 AS INT) WHEN i = 2 THEN 1 + CAST(coalesce(shared_request_flag = 'Y', false) AS INT) "
            "WHEN i = 3 THEN CAST(PULocationID >= 13 AS INT) ELSE 1 END) AS BIGINT) AS silver_rows "
            "FROM trips t JOIN m ON m.month = t._source_month GROUP BY 1, 2"),
        "late_members": (
            ", lowest AS (SELECT MIN(base_num) AS b FROM dim_dispatch), o AS (SELECT s._source_month AS source_month, "
            "coalesce(PULocationID BETWEEN 20 AND 24, false)::INT + coalesce(DOLocationID BETWEEN 20 AND 24, false)::INT "
            "+ coalesce(dispatching_base_num = b, false)::INT + coalesce(originating_base_num = b, false)::INT AS late, "
            "coalesce(PULocationID >= 25, false)::INT + coalesce(DOLocationID >= 25, false)::INT AS never FROM silver s, lowest) "
            "SELECT source_month, SUM(late) > 0 AS rewritten, CAST(SUM(late + never) AS BIGINT) AS unresolved_before, "
            "CAST(SUM(never) AS BIGINT) AS unresolved_after, CAST(COUNT(*) AS BIGINT) AS fact_rows FROM o GROUP BY 1"),
        "run_month_report": _checks("silver", "fact", with_gold=True, overall=True),
        "incremental_two_months": daily,
        "idempotent_reload": "\nUNION ALL ".join([
            "SELECT 'bronze' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM trips",
            "SELECT 'silver', CAST(COUNT(*) AS BIGINT) FROM silver",
            "SELECT 'fact', CAST(COUNT(*) AS BIGINT) FROM fact",
            "SELECT 'dim_dispatch', CAST(COUNT(*) AS BIGINT) FROM dim_dispatch",
            "SELECT 'dim_provider', CAST(COUNT(*) AS BIGINT) FROM dim_provider",
            "SELECT 'dim_date', CAST(COUNT(*) AS BIGINT) FROM dim_date",
            "SELECT 'dim_location', CAST(COUNT(*) AS BIGINT) FROM dim_location",
            "SELECT 'gold_daily_provider', CAST(COUNT(*) AS BIGINT) FROM fact",
            "SELECT 'gold_location', CAST(COUNT(*) AS BIGINT) FROM fact",
            "SELECT 'gold_shared_ride', CAST(COUNT(*) AS BIGINT) FROM fact",
        ]),
    }
    out = {}
    for k, sql in q.items():
        body = sql.lstrip()
        out[k] = BASE + (body if body.startswith(",") else "\n" + body)
    return out
