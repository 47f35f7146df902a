"""The same queries as plain SQL over the given tables, for checking results.

Nothing here runs on Spark. The SQL follows the definitions with its own forms:
one window over the whole axis, joins instead of conditional counts, and so on.
"""

from __future__ import annotations

import re

from wayfact.functions.exact import PLACES
from wayfact.operators.basics import STOPWORDS

NUMERIC = (
    "temperature_c",
    "precipitation_mm",
    "relative_humidity_pct",
    "wind_speed_mps",
    "pickup_hour_of_day",
    "pickup_month",
    "is_weekday",
    "rush_hour_indicator",
    "snow_indicator",
    "heavy_rain_indicator",
    "precipitation_trace_indicator",
)
NUMBER = r"[-+]?(?:\d+(?:\.\d*)?|\.\d+)"


def num(text: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(trim({text}), '{NUMBER}'), '') AS DOUBLE)"


def units(value: str, places: int = PLACES) -> str:
    return f"CAST(floor({value} * CAST({10**places} AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"


def ratio(top: str, bottom: str, places: int) -> str:
    n, d = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    whole = f"(abs({n}) * {2 * 10**places} + {d}) // NULLIF(2 * {d}, 0)"
    return (
        f"CAST(CASE WHEN {n} < 0 THEN -1 ELSE 1 END * ({whole}) AS DOUBLE)"
        f" / CAST({10**places} AS DOUBLE)"
    )


def mean(value: str, places: int = 2) -> str:
    return ratio(f"sum({units(value)})", f"(count({value}) * {10**PLACES})", places)


def total(value: str, places: int = 2) -> str:
    return ratio(f"sum({units(value)})", str(10**PLACES), places)


def pct(part: str, whole: str) -> str:
    return ratio(f"(100 * ({part}))", whole, 2)


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def diff(left: str, right: str) -> str:
    return f"CAST({units(left, 2)} - {units(right, 2)} AS DOUBLE) / CAST(100 AS DOUBLE)"


def minutes(start: str, end: str) -> str:
    return (
        f"CAST(epoch_us({end}) // 1000000 - epoch_us({start}) // 1000000 AS DOUBLE)"
        " / CAST(60 AS DOUBLE)"
    )


def season(month: str) -> str:
    return (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring'"
        f" WHEN {month} IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
    )


def calendar(ts: str) -> str:
    return f"""
    date_trunc('hour', {ts}) AS pickup_hour, CAST({ts} AS DATE) AS pickup_date,
    CAST(year({ts}) AS INTEGER) AS pickup_year, CAST(month({ts}) AS INTEGER) AS pickup_month,
    CAST(day({ts}) AS INTEGER) AS pickup_day, dayname({ts}) AS pickup_day_of_week,
    {season(f'month({ts})')} AS season, CAST(hour({ts}) AS INTEGER) AS pickup_hour_of_day"""


CARD_TIP = """CASE WHEN payment_type = 1 AND fare_amount > 0 THEN
    CASE WHEN tip_amount / fare_amount * CAST(100 AS DOUBLE) BETWEEN 0 AND 200
    THEN tip_amount / fare_amount * CAST(100 AS DOUBLE) END END AS card_tip_percentage"""

LABEL = """CASE payment_type WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge'
    WHEN 4 THEN 'dispute' WHEN 5 THEN 'unknown' WHEN 6 THEN 'voided' ELSE 'other' END"""


def clean(source: str, first: str, last: str, limits: dict[str, tuple]) -> str:
    tests = " AND ".join(f"{c} BETWEEN {a} AND {b}" for c, (a, b) in limits.items())
    return f"""
    SELECT *, {calendar('pickup_timestamp')}, {CARD_TIP}
    FROM (SELECT *, {minutes('pickup_timestamp', 'dropoff_timestamp')} AS trip_duration_minutes
          FROM {source})
    WHERE pickup_timestamp >= TIMESTAMP '{first}' AND pickup_timestamp < TIMESTAMP '{last}'
      AND dropoff_timestamp IS NOT NULL AND pickup_location_id >= 0 AND {tests}"""


def neighbour(function: str, column: str, frame: str) -> str:
    return (
        f"{function}({column} IGNORE NULLS) OVER"
        f" (ORDER BY weather_hour ROWS BETWEEN {frame})"
    )


def previous(column: str) -> str:
    return neighbour("last_value", column, "UNBOUNDED PRECEDING AND 1 PRECEDING")


def following(column: str) -> str:
    return neighbour("first_value", column, "1 FOLLOWING AND UNBOUNDED FOLLOWING")


MEASURES = ("temperature_c", "precipitation_mm", "relative_humidity_pct", "wind_speed_mps")
DAILY = ("avg_temp_f", "max_temp_f", "min_temp_f", "precip_inches", "snow_inches", "wind_mph")

VIEWS = {
    "trips_c": """
    SELECT o_orderdate AS pickup_timestamp, l_shipdate AS dropoff_timestamp,
      l_suppkey AS pickup_location_id, CAST(l_linenumber AS DOUBLE) AS passenger_count,
      l_quantity AS trip_distance_miles,
      TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
      l_extendedprice AS fare_amount, l_extendedprice * l_discount AS tip_amount,
      l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "numbered": f"SELECT *, {num('props')} AS n FROM events",
    "rides_c": """
    SELECT ts AS pickup_timestamp, ts + to_minutes(CAST(n AS INTEGER)) AS dropoff_timestamp,
      user_id AS pickup_location_id, floor(n / CAST(25 AS DOUBLE)) AS passenger_count,
      n * CAST(0.5 AS DOUBLE) AS trip_distance_miles,
      CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
        WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS payment_type,
      value AS fare_amount, n / CAST(20 AS DOUBLE) AS tip_amount,
      value + n / CAST(20 AS DOUBLE) AS total_amount
    FROM numbered""",
    "trips": clean(
        "trips_c",
        "1995-01-01",
        "2002-01-01",
        {
            "trip_duration_minutes": (1440, 259200),
            "trip_distance_miles": (0.1, 100),
            "fare_amount": (0, 200000),
            "tip_amount": (0, 20000),
            "total_amount": (0, 250000),
        },
    ),
    "rides": clean(
        "rides_c",
        "2024-01-01",
        "2024-01-31",
        {
            "trip_duration_minutes": (1, 180),
            "trip_distance_miles": (0.1, 100),
            "fare_amount": (0, 1000),
            "tip_amount": (0, 1000),
            "total_amount": (0, 2000),
        },
    ),
    "trip_zones": """
    SELECT s_suppkey AS pickup_location_id, r_name AS pickup_borough, n_name AS pickup_zone,
      s_name AS pickup_service_zone
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
    "ride_zones": """
    SELECT c_custkey AS pickup_location_id, r_name AS pickup_borough, n_name AS pickup_zone,
      c_mktsegment AS pickup_service_zone
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
    "obs": """
    SELECT 'STATION-1' AS station,
      CASE WHEN n = 13 THEN strftime(ts, '%Y-%m-%d')
        ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS date_text,
      CASE event_type WHEN 'error' THEN ' FM-15' WHEN 'signup' THEN 'FM-16 ' ELSE 'FM-12' END
        AS report_text,
      CASE WHEN n BETWEEN 5 AND 9 THEN '' WHEN n >= 50 THEN CAST(value AS VARCHAR) || 's'
        ELSE CAST(value AS VARCHAR) END AS temperature_text,
      CASE WHEN n BETWEEN 20 AND 29 THEN 't ' WHEN n BETWEEN 30 AND 34 THEN ' '
        ELSE CAST(greatest(n - 60, CAST(0 AS DOUBLE)) / CAST(10 AS DOUBLE) AS VARCHAR) END
        AS amount_text,
      CASE WHEN n BETWEEN 40 AND 44 THEN NULL ELSE CAST(CAST(n AS INTEGER) AS VARCHAR) END
        AS humidity_text,
      CASE WHEN n BETWEEN 45 AND 49 THEN ''
        ELSE CAST(CAST(floor(n / CAST(10 AS DOUBLE)) AS INTEGER) AS VARCHAR) END AS speed_text,
      CASE WHEN n >= 90 THEN 'VRB' ELSE CAST(CAST(n AS INTEGER) AS VARCHAR) END AS direction_text,
      CASE WHEN n >= 97 THEN '-SN:03' WHEN n > 60 THEN 'RA:61' END AS present_weather
    FROM numbered""",
    "candidates": f"""
    SELECT station, date_trunc('hour', t) AS weather_hour, t AS observation_timestamp,
      trim(report_text) AS report_type,
      CASE trim(report_text) WHEN 'FM-15' THEN 1 ELSE 2 END AS report_priority,
      CASE WHEN upper(trim(amount_text)) = 'T' THEN CAST(0 AS DOUBLE)
        ELSE {num('amount_text')} END AS precipitation_mm,
      upper(trim(amount_text)) = 'T' AS precipitation_trace,
      {num('temperature_text')} AS temperature_c, {num('humidity_text')} AS relative_humidity_pct,
      {num('speed_text')} AS wind_speed_mps, {num('direction_text')} AS wind_direction_degrees,
      present_weather
    FROM (SELECT *, try_strptime(date_text, '%Y-%m-%dT%H:%M:%S') AS t FROM obs)
    WHERE trim(report_text) IN ('FM-15', 'FM-16') AND t IS NOT NULL""",
    "best": """
    SELECT * EXCLUDE (report_priority) FROM candidates
    QUALIFY row_number() OVER (PARTITION BY weather_hour ORDER BY report_priority,
      observation_timestamp DESC, station NULLS LAST, report_type NULLS LAST,
      precipitation_mm NULLS LAST, precipitation_trace NULLS LAST, temperature_c NULLS LAST,
      relative_humidity_pct NULLS LAST, wind_speed_mps NULLS LAST,
      wind_direction_degrees NULLS LAST, present_weather NULLS LAST) = 1""",
    "spine": """
    SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00',
      TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS weather_hour""",
    "complete": """
    SELECT s.weather_hour, coalesce(station, 'STATION-1') AS station, observation_timestamp,
      coalesce(report_type, 'IMPUTED') AS report_type, precipitation_mm,
      coalesce(precipitation_trace, FALSE) AS precipitation_trace, temperature_c,
      relative_humidity_pct, wind_speed_mps, wind_direction_degrees, present_weather,
      station IS NULL AS hour_imputed
    FROM spine s LEFT JOIN best b ON s.weather_hour = b.weather_hour""",
    "filled": "SELECT weather_hour, precipitation_trace, present_weather, hour_imputed,"
    " wind_direction_degrees, "
    + ", ".join(
        f"coalesce({c}, ({previous(c)} + {following(c)}) / CAST(2 AS DOUBLE), {previous(c)},"
        f" {following(c)}) AS {c}, {c} IS NULL AS {c}_imputed"
        for c in MEASURES
    )
    + " FROM complete",
    "directed": f"""
    SELECT *, wind_direction_degrees IS NULL AND wind_speed_mps > 0 AS wind_direction_imputed,
      CASE WHEN wind_speed_mps = 0 THEN NULL ELSE coalesce(wind_direction_degrees,
        {previous('wind_direction_degrees')}, {following('wind_direction_degrees')}) END
        AS direction
    FROM filled""",
    "hours": """
    SELECT weather_hour, temperature_c, precipitation_mm, precipitation_trace,
      relative_humidity_pct, wind_speed_mps, present_weather, hour_imputed,
      CASE WHEN regexp_matches(lower(coalesce(present_weather, '')), 'snow|sn') THEN 'Snow'
        WHEN temperature_c <= 4.0 AND precipitation_mm > 0 THEN 'Snow'
        WHEN precipitation_mm >= 2.5 THEN 'Heavy Rain'
        WHEN precipitation_mm > 0 OR precipitation_trace THEN 'Rain'
        ELSE 'Dry' END AS weather_condition
    FROM filled""",
    "days": f"""
    SELECT CAST(weather_hour AS DATE) AS weather_date, {mean('temperature_c', 6)} AS temperature_c,
      {total('precipitation_mm', 6)} AS precipitation_mm,
      bool_or(precipitation_trace) AS precipitation_trace,
      {mean('relative_humidity_pct', 6)} AS relative_humidity_pct,
      {mean('wind_speed_mps', 6)} AS wind_speed_mps,
      coalesce(string_agg(DISTINCT present_weather, ' | ' ORDER BY present_weather), '')
        AS present_weather,
      bool_or(hour_imputed) AS hour_imputed,
      CASE WHEN bool_or(weather_condition = 'Snow') THEN 'Snow'
        WHEN bool_or(weather_condition = 'Heavy Rain') THEN 'Heavy Rain'
        WHEN bool_or(weather_condition = 'Rain') THEN 'Rain' ELSE 'Dry' END AS weather_condition
    FROM hours GROUP BY 1""",
    "day_counts": """
    SELECT CAST(o_orderdate AS DATE) AS weather_date, count(*) AS n,
      max(o_totalprice) / CAST(10000 AS DOUBLE) AS high,
      min(o_totalprice) / CAST(10000 AS DOUBLE) AS low
    FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2002-01-01'
    GROUP BY 1""",
    "day_parsed": """
    SELECT weather_date, CASE WHEN n % 3 <> 0 THEN (high + low) / CAST(2 AS DOUBLE) END AS avg_temp_f,
      CASE WHEN n % 7 <> 0 THEN high END AS max_temp_f, low AS min_temp_f,
      CAST(n % 8 AS DOUBLE) / CAST(10 AS DOUBLE) AS precip_inches,
      CASE WHEN n % 5 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS snow_inches,
      CAST(n AS DOUBLE) AS wind_mph
    FROM day_counts""",
    "day_estimated": """
    SELECT * REPLACE (coalesce(avg_temp_f, (max_temp_f + min_temp_f) / CAST(2 AS DOUBLE))
      AS avg_temp_f) FROM day_parsed""",
    "day_repaired": "SELECT weather_date, "
    + ", ".join(
        f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM day_estimated)) AS {c}" for c in DAILY
    )
    + " FROM day_estimated",
    "day_conditions": """
    SELECT *, CASE WHEN snow_inches > 0 THEN 'Snow' WHEN precip_inches >= 0.5 THEN 'Heavy Rain'
        WHEN precip_inches > 0 THEN 'Rain' ELSE 'Dry' END AS weather_condition,
      CASE WHEN avg_temp_f < 32 THEN 'Freezing' WHEN avg_temp_f < 45 THEN 'Cold'
        WHEN avg_temp_f < 60 THEN 'Mild' ELSE 'Warm' END AS temperature_bin
    FROM day_repaired""",
    "rides_z": "SELECT * FROM rides LEFT JOIN ride_zones USING (pickup_location_id)",
    "joined_rides": "SELECT r.*, h.* EXCLUDE (weather_hour) FROM rides_z r"
    " LEFT JOIN hours h ON r.pickup_hour = h.weather_hour",
    "joined_daily": "SELECT r.*, d.* EXCLUDE (weather_date) FROM rides_z r"
    " LEFT JOIN days d ON r.pickup_date = d.weather_date",
    "joined_trips": """
    SELECT t.*, z.* EXCLUDE (pickup_location_id), d.weather_condition,
      d.avg_temp_f AS temperature_c, d.precip_inches AS precipitation_mm
    FROM trips t LEFT JOIN trip_zones z USING (pickup_location_id)
    LEFT JOIN day_conditions d ON t.pickup_date = d.weather_date""",
    "daily_all": """
    SELECT *, CAST(pickup_timestamp AS DATE) AS pickup_date,
      CAST(date_diff('second', pickup_timestamp, dropoff_timestamp) AS DOUBLE) / CAST(60 AS DOUBLE)
        AS trip_duration_minutes,
      CASE WHEN payment_type = 1 AND fare_amount > 0
        THEN CAST(100 AS DOUBLE) * tip_amount / fare_amount END AS tip_percentage
    FROM trips_c""",
    "daily_trips": """
    SELECT * FROM daily_all
    WHERE pickup_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
      AND trip_distance_miles > 0 AND trip_distance_miles <= 45 AND fare_amount BETWEEN 0 AND 90000
      AND total_amount > 0 AND total_amount <= 95000
      AND trip_duration_minutes BETWEEN 1440 AND 259200""",
    "daily_joined": """
    SELECT t.*, d.* EXCLUDE (weather_date), z.pickup_borough, z.pickup_zone FROM daily_trips t
    LEFT JOIN day_conditions d ON t.pickup_date = d.weather_date
    LEFT JOIN trip_zones z USING (pickup_location_id)""",
    "ride_file": """
    SELECT CAST(event_id AS VARCHAR) AS ride_id, event_type AS rideable_type,
      date_trunc('second', ts) AS started_at,
      date_trunc('second', ts) + to_minutes(CAST(n AS INTEGER)) AS ended_at,
      CASE WHEN n >= 5 THEN pickup_zone END AS start_station_name,
      CAST(user_id AS VARCHAR) AS start_station_id, pickup_borough AS end_station_name,
      CAST(CAST(n AS INTEGER) AS VARCHAR) AS end_station_id, n / CAST(8 AS DOUBLE) AS start_lat,
      n / CAST(16 AS DOUBLE) AS start_lng, n / CAST(32 AS DOUBLE) AS end_lat, value AS end_lng,
      pickup_service_zone AS member_casual
    FROM numbered LEFT JOIN ride_zones ON user_id = pickup_location_id""",
    "words": """
    SELECT word, count(*) AS count FROM (
      SELECT unnest(string_split_regex(lower(text), '[^a-z'']+')) AS word FROM documents)
    WHERE length(word) > 0 GROUP BY 1""",
}


def _summary(source: str, keys: str, measures: str, known: str = "weather_condition") -> str:
    names = {
        "fare": mean("fare_amount") + " AS avg_fare_amount",
        "total": mean("total_amount") + " AS avg_total_amount",
        "duration": mean("trip_duration_minutes") + " AS avg_duration_minutes",
        "distance": mean("trip_distance_miles") + " AS avg_distance_miles",
        "tip": mean("card_tip_percentage") + " AS avg_card_tip_percentage",
        "temp": mean("temperature_c") + " AS avg_temperature_c",
        "rain": mean("precipitation_mm", 3) + " AS avg_precipitation_mm",
    }
    chosen = ", ".join(names[m] for m in measures.split())
    tests = " AND ".join(f"{c} IS NOT NULL" for c in known.split())
    return (
        f"SELECT {keys}, count(*) AS trip_count, {chosen} FROM {source} WHERE {tests}"
        f" GROUP BY {keys}"
    )


ALL = "fare total duration distance tip temp rain"
VIEWS |= {
    "s_condition": _summary("joined_rides", "weather_condition", ALL),
    "s_borough": _summary(
        "joined_rides",
        "pickup_borough, weather_condition",
        "fare duration tip",
        "pickup_borough weather_condition",
    ),
    "s_hourly": _summary(
        "joined_rides", "pickup_date, pickup_hour_of_day, weather_condition", "fare duration tip"
    ),
    "s_zone": _summary(
        "joined_rides",
        "pickup_borough, pickup_zone, weather_condition",
        "fare duration",
        "pickup_zone weather_condition",
    ),
    "s_monthly": _summary("joined_trips", "pickup_year, pickup_month, weather_condition", ALL),
    "s_seasonal": _summary("joined_trips", "season, weather_condition", ALL),
    "s_month_borough": _summary(
        "joined_trips",
        "pickup_year, pickup_month, pickup_borough, weather_condition",
        "fare distance duration tip",
        "pickup_borough weather_condition",
    ),
    "s_tipping": f"""
    SELECT pickup_year, pickup_month, weather_condition, count(*) AS credit_card_trip_count,
      {mean('tip_amount')} AS avg_tip_amount, {mean('card_tip_percentage')} AS avg_tip_percentage,
      {pct('count(*) FILTER (tip_amount <= 0)', 'count(*)')} AS no_tip_rate_pct
    FROM joined_trips WHERE payment_type = 1 AND weather_condition IS NOT NULL
    GROUP BY 1, 2, 3""",
    "s_week": _summary(
        "(SELECT * FROM joined_rides WHERE pickup_date < DATE '2024-01-08')",
        "weather_condition",
        ALL,
    ),
    "d_condition": _summary("joined_daily", "weather_condition", ALL),
    "d_borough": _summary(
        "joined_daily",
        "pickup_borough, weather_condition",
        "fare duration tip",
        "pickup_borough weather_condition",
    ),
    "d_hourly": _summary(
        "joined_daily", "pickup_date, pickup_hour_of_day, weather_condition", "fare duration tip"
    ),
    "d_zone": _summary(
        "joined_daily",
        "pickup_borough, pickup_zone, weather_condition",
        "fare duration",
        "pickup_zone weather_condition",
    ),
}

ATTRIBUTES = (
    "pickup_date, pickup_year, pickup_month, pickup_day_of_week, pickup_hour_of_day, temperature_c,"
    " precipitation_mm, precipitation_trace, relative_humidity_pct, wind_speed_mps,"
    " present_weather, weather_condition"
)
GROUPS = "('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"
WEEKDAYS = "('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday')"


def flag(test: str) -> str:
    return f"CASE WHEN {test} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


VIEWS |= {
    "demand_source": f"""
    SELECT pickup_hour, pickup_borough, {ATTRIBUTES} FROM joined_rides
    WHERE pickup_date >= DATE '2024-01-01' AND pickup_date < DATE '2024-01-31'
      AND pickup_borough IN {GROUPS}""",
    "demand_hours": "SELECT pickup_hour, "
    + ", ".join(
        {
            "weather_condition": "coalesce(max(weather_condition), 'Unknown') AS weather_condition",
            "present_weather": "coalesce(max(present_weather), '') AS present_weather",
            "precipitation_trace": "coalesce(bool_or(precipitation_trace), FALSE)"
            " AS precipitation_trace",
        }.get(c, f"max({c}) AS {c}")
        for c in ATTRIBUTES.split(", ")
    )
    + " FROM demand_source GROUP BY 1",
    "demand_counts": "SELECT pickup_hour, pickup_borough, count(*) AS trip_count"
    " FROM demand_source GROUP BY 1, 2",
    "demand": """
    SELECT h.*, g.pickup_borough, coalesce(c.trip_count, 0) AS trip_count
    FROM demand_hours h
    CROSS JOIN (SELECT unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE']) AS pickup_borough) g
    LEFT JOIN demand_counts c ON c.pickup_hour = h.pickup_hour
      AND c.pickup_borough = g.pickup_borough""",
    "demand_flags": f"""
    SELECT *, {flag(f'pickup_day_of_week IN {WEEKDAYS}')} AS is_weekday,
      {flag(f"pickup_day_of_week IN {WEEKDAYS} AND (pickup_hour_of_day BETWEEN 7 AND 9 OR pickup_hour_of_day BETWEEN 16 AND 19)")}
        AS rush_hour_indicator,
      {flag("weather_condition = 'Snow'")} AS snow_indicator,
      {flag("weather_condition = 'Heavy Rain'")} AS heavy_rain_indicator,
      {flag('precipitation_trace')} AS precipitation_trace_indicator
    FROM demand""",
    "demand_split": "SELECT *, CASE WHEN day(pickup_date) <= 22 THEN 'train' ELSE 'test' END"
    " AS dataset_split FROM demand_flags",
    "thresholds": """
    SELECT pickup_borough, CAST(quantile_disc(trip_count, 0.75) AS DOUBLE) AS high_demand_threshold
    FROM demand_split WHERE dataset_split = 'train' GROUP BY 1""",
    "labelled": f"""
    SELECT d.*, high_demand_threshold, {flag('trip_count > high_demand_threshold')} AS label,
      CASE WHEN trip_count > high_demand_threshold THEN 'High Demand' ELSE 'Normal Demand' END
        AS demand_level
    FROM demand_split d JOIN thresholds t ON d.pickup_borough = t.pickup_borough""",
    "gapped": """
    SELECT * REPLACE (CASE WHEN pickup_hour_of_day % 5 <> 0 THEN temperature_c END AS temperature_c,
      CASE WHEN pickup_hour_of_day % 7 <> 0 THEN wind_speed_mps END AS wind_speed_mps) FROM labelled""",
    "categories": """
    SELECT DISTINCT name, c FROM (
      SELECT unnest(['pickup_day_of_week', 'pickup_borough', 'weather_condition']) AS name,
        unnest([pickup_day_of_week, pickup_borough, weather_condition]) AS c
      FROM labelled WHERE dataset_split = 'train')
    UNION ALL SELECT unnest(['pickup_day_of_week', 'pickup_borough', 'weather_condition']), '__unknown'""",
    "feature_names": f"""
    SELECT unnest({[f"{n}_imputed" for n in NUMERIC]}) AS feature
    UNION ALL SELECT name || '_ohe_' || c FROM categories""",
    "measures_long": f"""
    SELECT pickup_hour, pickup_borough, dataset_split, unnest({list(NUMERIC)}) AS name,
      unnest([{", ".join(f"{n}::DOUBLE" for n in NUMERIC)}]) AS value FROM gapped""",
    "medians": """
    SELECT name, quantile_disc(value, 0.5) AS median FROM measures_long
    WHERE dataset_split = 'train' GROUP BY 1""",
    "labels_long": """
    SELECT pickup_hour, pickup_borough, dataset_split,
      unnest(['pickup_day_of_week', 'pickup_borough', 'weather_condition']) AS name,
      unnest([pickup_day_of_week, pickup_borough, weather_condition]) AS value FROM gapped""",
    "feature_values": """
    SELECT pickup_hour, pickup_borough, dataset_split, name || '_imputed' AS feature, coalesce(value, median) AS filled
    FROM measures_long JOIN medians USING (name)
    UNION ALL
    SELECT pickup_hour, pickup_borough, dataset_split, l.name || '_ohe_' || c.c,
      CASE WHEN l.value = c.c OR (c.c = '__unknown' AND l.value NOT IN
        (SELECT k.c FROM categories k WHERE k.name = l.name)) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
    FROM labels_long l JOIN categories c ON c.name = l.name""",
    "outcomes": """
    SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp,
      count(*) FILTER (quality <> 1 AND toxic <> 1) AS tn,
      count(*) FILTER (quality <> 1 AND toxic = 1) AS fp,
      count(*) FILTER (quality = 1 AND toxic <> 1) AS fn FROM labels""",
    "hour_rows": f"""
    SELECT *, CASE WHEN isodow(pickup_date) BETWEEN 1 AND 5 AND (pickup_hour_of_day BETWEEN 7 AND 9
      OR pickup_hour_of_day BETWEEN 16 AND 19) THEN 'Rush Hour' ELSE 'Non-Rush Hour' END
      AS time_period FROM s_hourly""",
}


def _hour_measures(rows: str) -> str:
    weighted = "CAST({u} AS HUGEINT) * trip_count"
    fare = f"sum({weighted.format(u=units('avg_fare_amount', 2))})"
    duration = f"sum({weighted.format(u=units('avg_duration_minutes', 2))})"
    tip = f"sum({units('avg_card_tip_percentage', 2)})"
    return f"""{big('sum(trip_count)')} AS total_trips, count(*) AS {rows},
      {ratio('sum(trip_count)', 'count(*)', 2)} AS avg_trips_per_observed_hour,
      {ratio(fare, '(sum(trip_count) * 100)', 2)} AS weighted_avg_fare_amount,
      {ratio(duration, '(sum(trip_count) * 100)', 2)} AS weighted_avg_duration_minutes,
      {ratio(tip, '(count(avg_card_tip_percentage) * 100)', 2)} AS avg_hourly_card_tip_percentage"""


AVERAGES = (
    "avg_fare_amount, avg_total_amount, avg_duration_minutes, avg_distance_miles,"
    " avg_card_tip_percentage, avg_temperature_c, avg_precipitation_mm"
)
VIEWS |= {
    "by_hour": f"SELECT pickup_hour_of_day, weather_condition, {_hour_measures('observed_date_hours')}"
    " FROM s_hourly GROUP BY 1, 2",
    "by_period": f"SELECT time_period, weather_condition, {_hour_measures('observed_hour_rows')}"
    " FROM hour_rows GROUP BY 1, 2",
}


def _share(source: str, keys: str, name: str, columns: str, count: str = "trip_count") -> str:
    return (
        f"SELECT {columns.replace('@', pct(count, f'sum({count}) OVER (PARTITION BY {keys})') + f' AS {name}')}"
        f" FROM {source}"
    )


def _check(source: str, column: str, distinct: str, rows: str) -> str:
    return (
        f"SELECT count(DISTINCT {column}) AS {distinct}, count(*) AS {rows},"
        f" {big('sum(trip_count)')} AS summarized_trip_rows FROM {source}"
    )


HOUR = "weather_condition, temperature_c, precipitation_mm"
ZONE = "pickup_borough, pickup_zone, pickup_service_zone"
TIP_PCT = "tip_amount / fare_amount * CAST(100 AS DOUBLE)"
JOINED = (
    "pickup_timestamp, dropoff_timestamp, pickup_hour, pickup_date, pickup_year, pickup_month,"
    " pickup_day, pickup_day_of_week, season, pickup_hour_of_day, pickup_location_id,"
    " pickup_borough, pickup_zone, pickup_service_zone, passenger_count, trip_distance_miles,"
    " trip_duration_minutes, payment_type, fare_amount, tip_amount, total_amount,"
    " card_tip_percentage, temperature_c, precipitation_mm, precipitation_trace,"
    " relative_humidity_pct, wind_speed_mps, present_weather, hour_imputed, weather_condition"
)
TIP_ROWS = """
    SELECT trip_distance_miles, fare_amount, passenger_count,
      CAST(hour(pickup_timestamp) AS INTEGER) AS hour, CAST(tip_amount > 0 AS INTEGER) AS tipped
    FROM trips_c WHERE payment_type = 1 AND fare_amount > 0 AND trip_distance_miles > 0
      AND passenger_count IS NOT NULL AND pickup_timestamp IS NOT NULL AND tip_amount IS NOT NULL"""
QUARTILE = "(SELECT quantile_disc({c}, {p}) FROM {s})"


def _quartile(column: str, p: float, source: str) -> str:
    return QUARTILE.format(c=column, p=p, s=source)


def _fence(side: str) -> str:
    low, high = (_quartile("fare_amount", p, "rides_c") for p in (0.25, 0.75))
    reach = f"CAST(1.5 AS DOUBLE) * ({high} - {low})"
    return f"({low} - {reach})" if side == "low" else f"({high} + {reach})"


def _mb(value: str) -> str:
    return ratio(value, "1048576", 3)


_LOG_SUMS = {
    "input_bytes_read": 4096,
    "output_bytes_written": 512,
    "shuffle_read_bytes": 11,
    "shuffle_write_bytes": 9,
    "memory_bytes_spilled": 7,
    "disk_bytes_spilled": 3,
}
_LOG = ", ".join(
    f"{big(f's * {k}')} AS {name}, {_mb(f's * {k}')} AS {name.replace('bytes', 'megabytes')}"
    for name, k in _LOG_SUMS.items()
)

SELECTS = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_pruned": "SELECT l_orderkey, l_quantity FROM lineitem",
    "scan_partition_pruned": "SELECT CAST(1997 AS INTEGER) AS order_year, o_orderkey, o_totalprice"
    " FROM orders WHERE year(o_orderdate) = 1997",
    "range_generate": "SELECT i AS id, i * 2 AS doubled FROM"
    " (SELECT unnest(range(0, (SELECT count(*) FROM orders))) AS i)",
    "hour_spine": "SELECT unnest(generate_series(date_trunc('hour', min(ts)),"
    " date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS weather_hour FROM events",
    "schema_report": "SELECT DISTINCT CAST(year(pickup_timestamp) AS VARCHAR) AS label,"
    " 'PASS' AS status, CAST(9 AS INTEGER) AS column_count, '' AS missing, '' AS incompatible,"
    " '' AS error FROM trips_c",
    "catalog_table": "SELECT event_type, count(*) AS row_count, max(value) AS max_value"
    " FROM events GROUP BY 1",
    "catalog_partitioned_table": "SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,"
    " count(*) AS row_count, max(o_totalprice) AS max_price FROM orders GROUP BY 1",
    "busiest_hours_sql": "SELECT CAST(hour(pickup_timestamp) AS INTEGER) AS hour, count(*) AS count"
    " FROM rides_c GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "roundtrip_parquet": "SELECT * FROM rides_c",
    "roundtrip_partitioned": "SELECT * FROM trips",
    "roundtrip_json": f"SELECT passenger_count, {mean('fare_amount')} AS avg_fare_usd,"
    " count(*) AS n_trips FROM trips_c GROUP BY 1",
    "csv_to_parquet": "SELECT * FROM ride_file",
    "canonical_trips": "SELECT * FROM trips_c",
    "derive_columns": "SELECT l_orderkey, l_linenumber, l_quantity, l_quantity * l_quantity AS"
    " squared, l_quantity * l_quantity * l_quantity AS cubed FROM lineitem",
    "filter_simple": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45",
    "date_range": "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >="
    " TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'",
    "clean_trips_hourly": "SELECT * FROM trips",
    "clean_trips_daily": "SELECT * FROM daily_trips",
    "quality_report": f"""
    SELECT a AS raw_rows, b AS clean_rows, a - b AS removed_rows,
      coalesce({pct('a - b', 'a')}, 0) AS removed_rate_pct
    FROM (SELECT (SELECT count(*) FROM trips_c) AS a, (SELECT count(*) FROM daily_trips) AS b)""",
    "in_list": "SELECT event_type IN ('click', 'view') AS listed, count(*) AS row_count"
    " FROM events GROUP BY 1",
    "not_null": "SELECT weather_hour, temperature_c FROM complete WHERE temperature_c IS NOT NULL",
    "payment_label": f"SELECT payment_type, {LABEL} AS payment_label, count(*) AS row_count"
    " FROM trips_c GROUP BY 1, 2",
    "refund_share": f"SELECT count(*) FILTER (c_acctbal < 0) AS negative_rows, count(*) AS"
    f" total_rows, {pct('count(*) FILTER (c_acctbal < 0)', 'count(*)')} AS negative_pct"
    " FROM customer",
    "drop_nulls": "SELECT observation_timestamp, temperature_c, precipitation_mm FROM candidates"
    " WHERE temperature_c IS NOT NULL AND precipitation_mm IS NOT NULL",
    "fill_constants": "SELECT observation_timestamp, coalesce(present_weather, 'none') AS"
    " present_weather, coalesce(wind_speed_mps, 0) AS wind_speed_mps FROM candidates",
    "calendar_fields": f"SELECT o_orderkey, {calendar('o_orderdate')} FROM orders",
    "duration_minutes": f"SELECT pickup_timestamp, dropoff_timestamp,"
    f" {minutes('pickup_timestamp', 'dropoff_timestamp')} AS trip_duration_minutes FROM trips_c",
    "season": f"SELECT CAST(month(o_orderdate) AS INTEGER) AS month,"
    f" {season('month(o_orderdate)')} AS season, count(*) AS row_count FROM orders GROUP BY 1, 2",
    "card_tip_pct": f"SELECT pickup_timestamp, payment_type, fare_amount, tip_amount, {CARD_TIP}"
    " FROM rides_c",
    "rush_hour": "SELECT isodow(ts) BETWEEN 1 AND 5 AND (hour(ts) BETWEEN 7 AND 9 OR hour(ts)"
    " BETWEEN 16 AND 19) AS is_rush_hour, count(*) AS row_count FROM events GROUP BY 1",
    "enrich_zones": f"SELECT pickup_timestamp, pickup_location_id, {ZONE} FROM rides_z",
    "enrich_zones_keys": """
    SELECT t.pickup_location_id, z.pickup_location_id AS LocationID, pickup_borough AS Borough,
      pickup_zone AS Zone, fare_amount
    FROM trips_c t LEFT JOIN trip_zones z ON t.pickup_location_id = z.pickup_location_id""",
    "enrich_hourly_condition": f"SELECT pickup_timestamp, pickup_hour, {HOUR} FROM joined_rides",
    "enrich_daily_condition": f"SELECT pickup_timestamp, pickup_date, {HOUR} FROM joined_daily",
    "enrich_sort_merge": f"SELECT pickup_timestamp, pickup_location_id, {ZONE}, {HOUR}"
    " FROM joined_rides",
    "dedupe_dimension": """
    SELECT pickup_location_id, pickup_borough, pickup_zone,
      least(pickup_service_zone, lower(pickup_service_zone)) AS pickup_service_zone
    FROM ride_zones""",
    "missing_hours": "SELECT weather_hour FROM spine WHERE weather_hour NOT IN"
    " (SELECT weather_hour FROM best)",
    "hour_group_grid": """
    SELECT weather_hour, pickup_borough FROM
      (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
        INTERVAL 1 HOUR)) AS weather_hour FROM events)
      CROSS JOIN (SELECT unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE']) AS pickup_borough)""",
    "join_quality": f"""
    SELECT count(*) AS joined_rows, count(pickup_zone) AS zone_matches,
      count(temperature_c) AS condition_matches,
      coalesce({pct('count(pickup_zone)', 'count(*)')}, 0) AS zone_match_rate_pct,
      coalesce({pct('count(temperature_c)', 'count(*)')}, 0) AS condition_match_rate_pct
    FROM joined_rides""",
    "trips_by_hour": "SELECT CAST(hour(pickup_timestamp) AS INTEGER) AS hour, count(*) AS count"
    " FROM rides_c GROUP BY 1",
    "busiest_hours": "SELECT CAST(hour(pickup_timestamp) AS INTEGER) AS hour, count(*) AS count"
    " FROM rides_c GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "fare_by_passengers": f"SELECT passenger_count, {mean('fare_amount')} AS avg_fare_usd,"
    " count(*) AS n_trips FROM trips_c GROUP BY 1",
    "longest_trips": "SELECT trip_distance_miles, fare_amount, total_amount FROM trips_c"
    " ORDER BY 1 DESC NULLS LAST, 2 NULLS LAST, 3 NULLS LAST LIMIT 10",
    "global_stats": f"SELECT count(*) AS row_count, {mean('l_extendedprice')} AS mean,"
    " min(l_extendedprice) AS minimum, max(l_extendedprice) AS maximum FROM lineitem",
    "no_tip_rate": f"SELECT payment_type,"
    f" {pct('count(*) FILTER (tip_amount <= 0)', 'count(*)')} AS no_tip_rate_pct"
    " FROM trips_c GROUP BY 1",
    "revenue_by_method": f"SELECT {LABEL} AS payment_label, count(*) AS n_trips,"
    f" {total('total_amount', 0)} AS revenue_usd, {mean('total_amount')} AS avg_total_usd,"
    f" {mean('fare_amount')} AS avg_fare_usd FROM trips_c GROUP BY 1",
    "pivot_method_by_hour": """
    SELECT CAST(hour(pickup_timestamp) AS INTEGER) AS hour,
      NULLIF(count(*) FILTER (payment_type = 1), 0) AS credit_card,
      NULLIF(count(*) FILTER (payment_type = 2), 0) AS cash
    FROM rides_c WHERE payment_type IN (1, 2) GROUP BY 1""",
    "tip_by_payment": f"SELECT payment_type, {mean(TIP_PCT)} AS avg_tip_pct,"
    f" {mean('tip_amount')} AS avg_tip_usd, count(*) AS n_trips FROM trips_c"
    " WHERE fare_amount > 0 GROUP BY 1",
    "card_tip_by_hour": f"SELECT CAST(hour(pickup_timestamp) AS INTEGER) AS hour,"
    f" {mean(TIP_PCT)} AS avg_tip_pct, count(*) AS n_trips FROM rides_c"
    " WHERE fare_amount > 0 AND payment_type = 1 GROUP BY 1",
    "top_zones": "SELECT pickup_borough, pickup_zone, count(*) AS count FROM trips_c"
    " LEFT JOIN trip_zones USING (pickup_location_id) GROUP BY 1, 2"
    " ORDER BY 3 DESC, 1 NULLS LAST, 2 NULLS LAST LIMIT 10",
    "fare_by_borough": f"SELECT pickup_borough, {mean('fare_amount')} AS avg_fare_usd,"
    " count(*) AS n_trips FROM trips_c LEFT JOIN trip_zones USING (pickup_location_id) GROUP BY 1",
    "top_stations": "SELECT start_station_name, count(*) AS count FROM ride_file"
    " WHERE start_station_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "rides_by_type": "SELECT rideable_type, member_casual, count(*) AS count FROM ride_file"
    " GROUP BY 1, 2",
    "null_counts": "SELECT "
    + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS {c}" for c in (*MEASURES, "wind_direction_degrees")
    )
    + " FROM candidates",
    "duplicate_hours": "SELECT weather_hour, count(*) AS row_count FROM candidates GROUP BY 1"
    " HAVING count(*) > 1",
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "word_count": "SELECT * FROM words",
    "word_top_no_stopwords": "SELECT word, count FROM words WHERE word NOT IN ("
    + ", ".join(f"'{w}'" for w in STOPWORDS)
    + ") ORDER BY 2 DESC, 1 LIMIT 20",
    "numeric_text": f"SELECT date_text AS DATE, temperature_text AS HourlyDryBulbTemperature,"
    f" {num('temperature_text')} AS temperature_c FROM obs",
    "trace_amount": f"SELECT date_text AS DATE, upper(trim(amount_text)) = 'T' AS"
    f" precipitation_trace, CASE WHEN upper(trim(amount_text)) = 'T' THEN CAST(0 AS DOUBLE)"
    f" ELSE {num('amount_text')} END AS precipitation_mm FROM obs",
    "hourly_candidates": "SELECT * FROM candidates",
    "best_record_per_hour": "SELECT * FROM best",
    "complete_hours": "SELECT * FROM complete",
    "fill_neighbors": "SELECT weather_hour, "
    + ", ".join(f"{c}, {c}_imputed" for c in MEASURES)
    + " FROM filled",
    "fill_direction": "SELECT weather_hour, wind_speed_mps, direction AS wind_direction_degrees,"
    " wind_direction_imputed FROM directed",
    "coverage_report": """
    SELECT (SELECT count(*) FROM spine) AS expected_hours,
      (SELECT count(*) FROM best) AS observed_rows,
      (SELECT count(*) FROM (SELECT 1 FROM best GROUP BY weather_hour HAVING count(*) > 1))
        AS duplicate_hours,
      (SELECT count(*) FROM spine WHERE weather_hour NOT IN (SELECT weather_hour FROM best))
        AS missing_hours,
      count(*) AS complete_rows, count(*) FILTER (hour_imputed) AS imputed_hours, """
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}_nulls" for c in MEASURES)
    + ", count(*) FILTER (direction IS NULL) AS wind_direction_degrees_nulls FROM directed",
    "hourly_condition": "SELECT * FROM hours",
    "daily_condition": "SELECT * FROM days",
    "repair_then_median": "SELECT * FROM day_repaired",
    "daily_condition_simple": "SELECT weather_date, snow_inches, precip_inches, weather_condition"
    " FROM day_conditions",
    "temperature_bin": "SELECT weather_date, avg_temp_f, temperature_bin FROM day_conditions",
    "median_impute": """
    SELECT coalesce(p, (SELECT quantile_disc(passenger_count, 0.5) FROM trips_c
      WHERE passenger_count <> 3)) AS passenger_count, fare_amount
    FROM (SELECT CASE WHEN passenger_count <> 3 THEN passenger_count END AS p, fare_amount
      FROM trips_c)""",
    "iqr_outliers": f"SELECT pickup_timestamp, fare_amount, fare_amount < {_fence('low')}"
    f" OR fare_amount > {_fence('high')} AS is_fare_outlier FROM rides_c",
    "zscore": """
    SELECT fare_amount, round((fare_amount - m) / sd, 6) AS fare_z
    FROM trips_c, (SELECT avg(fare_amount) AS m, stddev_samp(fare_amount) AS sd FROM trips_c)""",
    "quartile_bins": f"""
    SELECT trip_distance_miles,
      CASE WHEN trip_distance_miles < {_quartile('trip_distance_miles', 0.25, 'trips_c')}
          THEN 'Q1_short'
        WHEN trip_distance_miles < {_quartile('trip_distance_miles', 0.5, 'trips_c')}
          THEN 'Q2_medium'
        WHEN trip_distance_miles < {_quartile('trip_distance_miles', 0.75, 'trips_c')}
          THEN 'Q3_long' ELSE 'Q4_very_long' END AS distance_bin
    FROM trips_c""",
    "one_hot": "SELECT payment_type, fare_amount, "
    + ", ".join(
        f"CAST(payment_type = {code} AS INTEGER) AS pay_{name}"
        for code, name in ((2, "cash"), (3, "no_charge"), (4, "dispute"), (5, "unknown"), (6, "voided"))
    )
    + " FROM trips_c",
    "tip_quantiles": "SELECT "
    + ", ".join(
        f"quantile_disc({TIP_PCT}, {p}) AS {name}"
        for name, p in (("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p99", 0.99))
    )
    + " FROM rides_c WHERE fare_amount > 0 AND payment_type = 1",
    "condition_summary": "SELECT * FROM s_condition",
    "borough_condition_summary": "SELECT * FROM s_borough",
    "hourly_demand": "SELECT * FROM s_hourly",
    "zone_condition_summary": "SELECT * FROM s_zone",
    "monthly_condition_summary": "SELECT * FROM s_monthly",
    "seasonal_condition_summary": "SELECT * FROM s_seasonal",
    "monthly_borough_summary": "SELECT * FROM s_month_borough",
    "monthly_tipping_summary": "SELECT * FROM s_tipping",
    "joined_trips": f"SELECT {JOINED} FROM joined_rides",
    "condition_summary_daily": "SELECT * FROM d_condition",
    "borough_condition_summary_daily": "SELECT * FROM d_borough",
    "hourly_demand_daily": "SELECT * FROM d_hourly",
    "zone_condition_summary_daily": "SELECT * FROM d_zone",
    "demand_by_condition": f"SELECT weather_condition, count(*) AS trip_count,"
    f" {mean('avg_temp_f')} AS avg_temperature_f, {mean('trip_distance_miles')} AS"
    f" avg_distance_miles, {mean('fare_amount')} AS avg_fare_usd,"
    f" {mean('trip_duration_minutes')} AS avg_duration_minutes FROM daily_joined GROUP BY 1",
    "daily_demand": f"SELECT pickup_date, weather_condition, temperature_bin, avg_temp_f,"
    f" precip_inches, snow_inches, count(*) AS daily_trip_count, {mean('fare_amount')} AS"
    f" avg_fare_usd, {mean('trip_duration_minutes')} AS avg_duration_minutes FROM daily_joined"
    " GROUP BY 1, 2, 3, 4, 5, 6",
    "tipping_by_condition": f"SELECT weather_condition, count(*) AS credit_card_trips,"
    f" {mean('tip_amount')} AS avg_tip_usd, {mean('tip_percentage')} AS avg_tip_percentage,"
    f" {pct('count(*) FILTER (tip_amount <= 0)', 'count(*)')} AS no_tip_rate_pct"
    " FROM daily_joined WHERE payment_type = 1 GROUP BY 1",
    "borough_by_condition": f"SELECT pickup_borough, weather_condition, count(*) AS trip_count,"
    f" {mean('fare_amount')} AS avg_fare_usd, {mean('trip_duration_minutes')} AS"
    " avg_duration_minutes FROM daily_joined GROUP BY 1, 2",
    "report_period_compare": _share(
        "(SELECT 'First week' AS analysis_period, * FROM s_week UNION ALL"
        " SELECT 'All' AS analysis_period, * FROM s_condition)",
        "analysis_period",
        "trip_share_pct",
        f"analysis_period, weather_condition, trip_count, @, {AVERAGES}",
    ),
    "report_monthly": _share(
        "s_monthly",
        "pickup_year, pickup_month",
        "monthly_trip_share_pct",
        f"pickup_year, pickup_month, weather_condition, trip_count, @, {AVERAGES}",
    ),
    "report_seasonal": _share(
        "s_seasonal",
        "season",
        "seasonal_trip_share_pct",
        f"season, weather_condition, trip_count, @, {AVERAGES}",
    ),
    "report_hourly": _share(
        "by_hour",
        "pickup_hour_of_day",
        "hour_weather_share_pct",
        "pickup_hour_of_day, weather_condition, total_trips, observed_date_hours,"
        " avg_trips_per_observed_hour, @, weighted_avg_fare_amount,"
        " weighted_avg_duration_minutes, avg_hourly_card_tip_percentage",
        "total_trips",
    ),
    "report_borough_impact": f"""
    SELECT b.pickup_borough, b.weather_condition, b.trip_count,
      {pct('b.trip_count', 't.trips')} AS borough_trip_share_pct, b.avg_fare_amount,
      {diff('b.avg_fare_amount', 'd.avg_fare_amount')} AS fare_change_vs_dry,
      b.avg_duration_minutes,
      {diff('b.avg_duration_minutes', 'd.avg_duration_minutes')} AS duration_change_vs_dry,
      b.avg_card_tip_percentage,
      {diff('b.avg_card_tip_percentage', 'd.avg_card_tip_percentage')} AS tip_pct_change_vs_dry
    FROM s_borough b
    JOIN (SELECT pickup_borough, sum(trip_count) AS trips FROM s_borough GROUP BY 1) t
      ON b.pickup_borough = t.pickup_borough
    JOIN (SELECT * FROM s_borough WHERE weather_condition = 'Dry') d
      ON b.pickup_borough = d.pickup_borough
    WHERE b.pickup_borough IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')""",
    "report_daily_vs_hourly": f"""
    SELECT coalesce(h.weather_condition, d.weather_condition) AS weather_condition,
      coalesce(h.trip_count, 0) AS hourly_trip_count, coalesce(d.trip_count, 0) AS daily_trip_count,
      coalesce(d.trip_count, 0) - coalesce(h.trip_count, 0) AS trip_count_difference,
      {pct('coalesce(h.trip_count, 0)', 'ht.n')} AS hourly_trip_share_pct,
      {pct('coalesce(d.trip_count, 0)', 'dt.n')} AS daily_trip_share_pct,
      {ratio('(100 * (CAST(coalesce(d.trip_count, 0) AS HUGEINT) * ht.n - CAST(coalesce(h.trip_count, 0) AS HUGEINT) * dt.n))', '(ht.n * dt.n)', 2)}
        AS trip_share_change_pct_points,
      h.avg_fare_amount AS hourly_avg_fare, d.avg_fare_amount AS daily_avg_fare,
      {diff('d.avg_fare_amount', 'h.avg_fare_amount')} AS fare_difference,
      h.avg_duration_minutes AS hourly_avg_duration, d.avg_duration_minutes AS daily_avg_duration,
      {diff('d.avg_duration_minutes', 'h.avg_duration_minutes')} AS duration_difference,
      h.avg_card_tip_percentage AS hourly_avg_tip_pct,
      d.avg_card_tip_percentage AS daily_avg_tip_pct,
      {diff('d.avg_card_tip_percentage', 'h.avg_card_tip_percentage')} AS tip_pct_difference,
      h.avg_temperature_c AS hourly_avg_temperature_c,
      d.avg_temperature_c AS daily_avg_temperature_c,
      h.avg_precipitation_mm AS hourly_avg_precipitation_mm,
      d.avg_precipitation_mm AS daily_avg_precipitation_mm
    FROM s_condition h FULL OUTER JOIN d_condition d ON h.weather_condition = d.weather_condition
    CROSS JOIN (SELECT sum(trip_count) AS n FROM s_condition) ht
    CROSS JOIN (SELECT sum(trip_count) AS n FROM d_condition) dt""",
    "report_intraday_changes": f"""
    SELECT pickup_date, weather_condition_count, weather_conditions, total_trips,
      total_days, multi_weather_days, {pct('multi_weather_days', 'total_days')}
        AS multi_weather_day_pct
    FROM (SELECT *, count(*) OVER () AS total_days,
        count(*) FILTER (weather_condition_count > 1) OVER () AS multi_weather_days
      FROM (SELECT pickup_date, count(DISTINCT weather_condition) AS weather_condition_count,
          string_agg(DISTINCT weather_condition, ', ' ORDER BY weather_condition)
            AS weather_conditions,
          {big('sum(trip_count)')} AS total_trips FROM s_hourly GROUP BY 1))
    WHERE weather_condition_count > 1""",
    "report_rush_hour": f"""
    SELECT p.time_period, p.weather_condition, p.total_trips, p.observed_hour_rows,
      p.avg_trips_per_observed_hour,
      {diff('p.avg_trips_per_observed_hour', 'd.avg_trips_per_observed_hour')}
        AS trips_per_hour_change_vs_dry,
      p.weighted_avg_fare_amount,
      {diff('p.weighted_avg_fare_amount', 'd.weighted_avg_fare_amount')} AS fare_change_vs_dry,
      p.weighted_avg_duration_minutes,
      {diff('p.weighted_avg_duration_minutes', 'd.weighted_avg_duration_minutes')}
        AS duration_change_vs_dry,
      p.avg_hourly_card_tip_percentage,
      {diff('p.avg_hourly_card_tip_percentage', 'd.avg_hourly_card_tip_percentage')}
        AS tip_pct_change_vs_dry
    FROM by_period p JOIN by_period d
      ON p.time_period = d.time_period AND d.weather_condition = 'Dry'""",
    "report_monthly_tipping": f"""
    SELECT t.pickup_year, t.pickup_month, t.weather_condition, t.credit_card_trip_count,
      {pct('t.credit_card_trip_count', 'm.n')} AS monthly_credit_card_trip_share_pct,
      t.avg_tip_amount, {diff('t.avg_tip_amount', 'd.avg_tip_amount')} AS tip_amount_change_vs_dry,
      t.avg_tip_percentage,
      {diff('t.avg_tip_percentage', 'd.avg_tip_percentage')} AS tip_percentage_change_vs_dry,
      t.no_tip_rate_pct,
      {diff('t.no_tip_rate_pct', 'd.no_tip_rate_pct')} AS no_tip_rate_change_vs_dry
    FROM s_tipping t
    JOIN (SELECT pickup_year, pickup_month, sum(credit_card_trip_count) AS n FROM s_tipping
      GROUP BY 1, 2) m ON t.pickup_year = m.pickup_year AND t.pickup_month = m.pickup_month
    JOIN (SELECT * FROM s_tipping WHERE weather_condition = 'Dry') d
      ON t.pickup_year = d.pickup_year AND t.pickup_month = d.pickup_month""",
    "report_top_zones": f"""
    SELECT z.pickup_borough, z.pickup_zone, z.weather_condition, t.zone_total_trips, z.trip_count,
      {pct('z.trip_count', 't.zone_total_trips')} AS zone_weather_trip_share_pct,
      z.avg_fare_amount, {diff('z.avg_fare_amount', 'd.avg_fare_amount')} AS fare_change_vs_dry,
      z.avg_duration_minutes,
      {diff('z.avg_duration_minutes', 'd.avg_duration_minutes')} AS duration_change_vs_dry
    FROM s_zone z
    JOIN (SELECT pickup_borough, pickup_zone, {big('sum(trip_count)')} AS zone_total_trips
      FROM s_zone WHERE pickup_borough NOT IN ('Unknown', 'N/A', 'EWR')
        AND pickup_zone NOT IN ('Unknown', 'N/A')
      GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10) t
      ON z.pickup_borough = t.pickup_borough AND z.pickup_zone = t.pickup_zone
    JOIN (SELECT * FROM s_zone WHERE weather_condition = 'Dry') d
      ON z.pickup_borough = d.pickup_borough AND z.pickup_zone = d.pickup_zone""",
    "check_period_total": f"SELECT {big('sum(trip_count)')} AS summarized_trip_rows FROM s_week",
    "check_coverage": "SELECT min(pickup_date) AS first_date, max(pickup_date) AS last_date,"
    " count(DISTINCT pickup_month) AS month_count, count(*) AS joined_trip_rows FROM joined_rides",
    "check_condition": f"SELECT count(*) AS weather_categories, {big('sum(trip_count)')} AS"
    " summarized_trip_rows FROM s_condition",
    "check_monthly": _check(
        "s_monthly", "pickup_month", "month_count", "month_weather_combinations"
    ),
    "check_seasonal": _check("s_seasonal", "season", "season_count", "season_weather_combinations"),
    "check_hourly": f"SELECT min(pickup_date) AS first_date, max(pickup_date) AS last_date,"
    f" count(DISTINCT pickup_date) AS date_count, count(*) AS hourly_weather_rows,"
    f" {big('sum(trip_count)')} AS summarized_trip_rows FROM s_hourly",
    "check_borough": _check(
        "s_borough", "pickup_borough", "borough_count", "borough_weather_combinations"
    ),
    "check_zone": _check("s_zone", "pickup_zone", "zone_count", "zone_weather_combinations"),
    "check_tipping": f"SELECT count(DISTINCT pickup_month) AS month_count, count(*) AS"
    f" month_weather_combinations, {big('sum(credit_card_trip_count)')} AS"
    " summarized_credit_card_trips FROM s_tipping",
    "check_consistency": f"""
    SELECT (SELECT count(*) FROM joined_rides) AS joined_ride_rows,
      (SELECT count(*) FROM joined_trips) AS joined_trip_rows,
      (SELECT {big('sum(trip_count)')} FROM s_condition) AS weather_summary_rows,
      (SELECT {big('sum(trip_count)')} FROM s_hourly) AS hourly_summary_rows,
      (SELECT {big('sum(trip_count)')} FROM s_monthly) AS monthly_summary_rows,
      (SELECT {big('sum(trip_count)')} FROM s_seasonal) AS seasonal_summary_rows""",
    "hour_attributes": "SELECT * FROM demand_hours",
    "complete_demand": "SELECT * FROM demand",
    "demand_indicators": "SELECT * FROM demand_flags",
    "time_split": "SELECT pickup_hour, pickup_borough, dataset_split FROM demand_split",
    "demand_thresholds": "SELECT * FROM thresholds",
    "label_high_demand": "SELECT * FROM labelled",
    "label_distribution": f"SELECT dataset_split, pickup_borough, demand_level, label,"
    f" count(*) AS row_count, {ratio('sum(trip_count)', 'count(*)', 2)} AS avg_trip_count,"
    " min(trip_count) AS min_trip_count, max(trip_count) AS max_trip_count FROM labelled"
    " GROUP BY 1, 2, 3, 4",
    "dataset_summary": f"SELECT dataset_split, count(*) AS dataset_rows,"
    f" count(DISTINCT pickup_hour) AS distinct_hours, {big('sum(trip_count)')} AS"
    f" represented_trip_count, count(*) FILTER (label = 1) AS high_demand_rows,"
    f" {pct('count(*) FILTER (label = 1)', 'count(*)')} AS high_demand_row_pct"
    " FROM labelled GROUP BY 1",
    "tip_target": TIP_ROWS,
    "class_balance": f"SELECT tipped, count(*) AS count FROM ({TIP_ROWS}) GROUP BY 1",
    "dynamic_overwrite": f"""
    SELECT order_year, count(*) AS row_count, {big('sum(round(price * 100)::BIGINT)')} AS units,
      order_year NOT IN (1995, 1996, 2096) AS files_kept
    FROM (SELECT year(o_orderdate)::INTEGER AS order_year,
        CASE WHEN year(o_orderdate) IN (1995, 1996) THEN round(o_totalprice * 100) ELSE o_totalprice END AS price
      FROM orders
      UNION ALL SELECT 2096, o_totalprice FROM orders WHERE year(o_orderdate) = 1996)
    GROUP BY 1""",
    "csv_quoted_texts": "SELECT doc_id, sha256(text) AS text_sha256, lang, source, n_chars FROM documents",
    "csv_inferred_customers": """
    SELECT c_custkey, c_name, c_acctbal, 'double' AS balance_type, 'string' AS name_type FROM customer""",
    "csv_text_customers": """
    SELECT c_custkey, c_acctbal * 2 AS doubled, 'string,string' AS kinds FROM customer""",
    "csv_corrupt_lines": """
    SELECT l_orderkey, CASE WHEN l_linenumber <> 3 THEN l_quantity::INTEGER END AS l_quantity,
      CASE WHEN l_linenumber <> 5 THEN l_linenumber::INTEGER END AS l_linenumber,
      CASE l_linenumber WHEN 3 THEN l_orderkey || ',many,3' WHEN 5 THEN l_orderkey || ',' || l_quantity::INTEGER END
        AS corrupt
    FROM lineitem""",
    "text_lines_count": f"""
    SELECT substr(line, 1, 1) AS first, count(*) AS line_count, {big('sum(length(line))')} AS characters
    FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS line FROM documents) GROUP BY 1""",
    "tip_split": f"""
    SELECT CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(pickup_timestamp AS VARCHAR),
      CAST(dropoff_timestamp AS VARCHAR), CAST(pickup_location_id AS VARCHAR))), 1, 8))::BIGINT % 10000 < 8000
      THEN 'train' ELSE 'test' END AS dataset_split, tipped, count(*) AS count
    FROM ({TIP_ROWS.replace("SELECT trip", "SELECT pickup_timestamp, dropoff_timestamp, pickup_location_id, trip", 1)})
    GROUP BY 1, 2""",
    "areas_under_roc": f"""
    SELECT score, positives, negatives, (twice - 2 * positives * base)::DOUBLE / (2 * positives * negatives)::DOUBLE
      AS area
    FROM (SELECT score, {big('sum(pos)')} AS positives, {big('sum(neg)')} AS negatives,
        min(below) AS base, sum(pos::HUGEINT * (2 * below + neg)) AS twice
      FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY score ORDER BY value
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT score, value, count(*) FILTER (fare_amount > 40000) AS pos,
            count(*) FILTER (NOT fare_amount > 40000) AS neg
          FROM (SELECT fare_amount, unnest(['trip_distance_miles', 'fare_amount', 'passenger_count', 'hour']) AS score,
              unnest([trip_distance_miles, fare_amount, passenger_count::DOUBLE, hour::DOUBLE]) AS value
            FROM ({TIP_ROWS})) GROUP BY 1, 2)) GROUP BY 1)""",
    "ranked_feature_names": """
    SELECT model, feature, (n * (n + 1) // 2)::BIGINT AS rank_sum
    FROM (SELECT feature, count(*) OVER () AS n FROM feature_names)
      CROSS JOIN (SELECT unnest(['Logistic Regression', 'Random Forest']) AS model)""",
    "logistic_optimum": """
    SELECT count(*) AS row_count, (SELECT count(*) FROM feature_names) AS feature_count, TRUE AS optimal
    FROM labelled WHERE dataset_split = 'train'""",
    "stored_model_scores": """
    SELECT model, count(*) AS row_count, count(*) AS equal_rows FROM labelled
      CROSS JOIN (SELECT unnest(['Logistic Regression', 'Random Forest']) AS model) GROUP BY 1""",
    "prepared_features": """
    SELECT pickup_hour, pickup_borough, feature,
      CASE WHEN std > 0 THEN round(filled / std, 6) + 0 ELSE 0 END AS value
    FROM (SELECT *, stddev_samp(filled) FILTER (dataset_split = 'train') OVER (PARTITION BY feature) AS std
      FROM feature_values)""",
    "binary_metrics": f"""
    SELECT tp + tn + fp + fn AS test_rows, tp AS true_positive, tn AS true_negative,
      fp AS false_positive, fn AS false_negative,
      coalesce({ratio('(tp + tn)', '(tp + tn + fp + fn)', 6)}, 0) AS accuracy,
      coalesce({ratio('tp', '(tp + fp)', 6)}, 0) AS precision,
      coalesce({ratio('tp', '(tp + fn)', 6)}, 0) AS recall,
      coalesce({ratio('(2 * tp)', '(2 * tp + fp + fn)', 6)}, 0) AS f1_score
    FROM outcomes""",
    "confusion_long": " UNION ALL ".join(
        f"SELECT 'labels' AS model, '{a} Demand' AS actual, '{p} Demand' AS predicted,"
        f" {cell} AS count FROM outcomes"
        for a, p, cell in (
            ("High", "High", "tp"),
            ("High", "Normal", "fn"),
            ("Normal", "High", "fp"),
            ("Normal", "Normal", "tn"),
        )
    ),
}
SELECTS["event_log_metrics"] = f"""
    SELECT application, event_files, spark_jobs, completed_stage_attempts, scheduled_stage_tasks,
      successful_task_attempts, failed_task_attempts, sql_executions, {_LOG},
      {big('s * 2')} AS input_records_read, {big('s')} AS output_records_written,
      {big('s + successful_task_attempts')} AS shuffle_read_records,
      {big('s * 8')} AS shuffle_write_records,
      {big('peak * 1024')} AS peak_execution_memory_bytes,
      {_mb('peak * 1024')} AS peak_execution_memory_megabytes,
      {ratio('s', '1000', 3)} AS executor_run_time_seconds,
      {ratio('s', '1000', 3)} AS executor_cpu_time_seconds, malformed_event_lines
    FROM (SELECT 'app-' || CAST(user_id % 3 AS VARCHAR) AS application,
      count(DISTINCT event_type) FILTER (NOT (event_type = 'signup' AND n = 50)) AS event_files,
      count(DISTINCT user_id) FILTER (event_type = 'signup' AND n <> 50) AS spark_jobs,
      count(DISTINCT user_id) FILTER (event_type = 'purchase') AS completed_stage_attempts,
      4 * count(DISTINCT user_id) FILTER (event_type = 'purchase') AS scheduled_stage_tasks,
      count(*) FILTER (event_type = 'click') AS successful_task_attempts,
      count(*) FILTER (event_type = 'error') AS failed_task_attempts,
      count(*) FILTER (event_type = 'view' AND n < 90) AS sql_executions,
      count(*) FILTER (event_type = 'view' AND n >= 90) AS malformed_event_lines,
      coalesce(sum(CAST(n AS BIGINT)) FILTER (event_type = 'click'), 0) AS s,
      coalesce(max(CAST(n AS BIGINT)) FILTER (event_type = 'click'), 0) AS peak
      FROM numbered GROUP BY 1)"""


def _needed(sql: str, seen: list[str]) -> None:
    for name in VIEWS:
        if name not in seen and re.search(rf"\b{name}\b(?!\s*\()", sql):
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)


def oracle() -> dict[str, str]:
    """Each query as one statement with the views it needs."""
    statements = {}
    for key, select in SELECTS.items():
        order: list[str] = []
        _needed(select, order)
        views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in order)
        statements[key] = (f"WITH {views}\n" if views else "") + select.strip()
    return statements
