"""Raw domain tables derived from the driver's tables.

One SQL text per role, in the dialect that Spark and DuckDB share, so that the
Spark query and its check start from the same rows.  ``@name`` stands for a
driver table or another role, ``NTZ`` for the zone-less timestamp type.  Every
role reads its whole tables.  Measures are multiples of a quarter, so their sums
are exact in either engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from roadrisk.functions import fixed

AS_OF = "2024-02-01 00:00:00"
# The driver's tables that the roles read, declared, so that no scan has to look its schema up.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

_FLAGS = ",\n".join(
    f"CASE (o_orderkey + {i}) % 5 WHEN 0 THEN 'True' WHEN 1 THEN ' true ' WHEN 2 THEN 'False' WHEN 3 THEN '1' END"
    f" AS {name}" for i, name in enumerate(fixed.ROAD_FLAGS))


def _city(key: str) -> str:
    """A city of the dimension, or now and then one it does not know."""
    names = [row[0] for row in fixed.rows(fixed.CITIES)]
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {key} % {len(names) + 1} {cases} ELSE 'Elsewhere' END"


def _key(name: str, value: str, missing: str | None = None) -> str:
    """``, "name": value`` of a JSON text, left out where ``missing`` holds."""
    present = f"', \"{name}\": ' || {value}"
    return f"CASE WHEN {missing} THEN '' ELSE {present} END" if missing else present


def _quoted(value: str) -> str:
    return f"'\"' || {value} || '\"'"


def _int(value: str) -> str:
    return f"cast(cast(floor({value}) AS int) AS string)"


def _blank(expression: str, every: int, key: str = "o_orderkey") -> str:
    """The expression, with blanks and NULLs mixed in."""
    return (f"CASE WHEN {key} % {every} = 1 THEN NULL WHEN {key} % {every} = 2 THEN '  ' "
            f"ELSE ' ' || {expression} END")


ROLES = {
    # Orders as accidents: 100 days up to 2024-01-31, some far off, some unreadable.
    "accidents_raw": f"""
        SELECT 'A' || cast(o_orderkey AS string) AS accident_id,
               cast(substring(o_orderpriority, 1, 1) AS int) AS severity,
               CASE WHEN o_orderkey % 89 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'bad'
                    WHEN o_orderkey % 3 = 0 THEN day_text || 'T' || clock_text
                    ELSE day_text || ' ' || clock_text || '.000000' END AS start_time,
               CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE day_text || ' 23:59:59' END AS end_time,
               32e0 + (o_orderkey % 1000) / 1e2 AS start_lat,
               (o_custkey % 1150) / 1e2 - 125e0 AS start_lng,
               floor(o_totalprice / 1e4) / 4e0 AS distance_mi,
               {_blank("'order of ' || c_mktsegment", 11)} AS description,
               {_blank("'Street ' || cast(o_custkey % 20 AS string)", 23)} AS street,
               CASE WHEN o_orderkey % 101 = 1 THEN NULL WHEN o_orderkey % 101 = 2 THEN '  ' ELSE n_name END AS city,
               {_blank("c_mktsegment", 29)} AS county,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 = 0 THEN 'NV' ELSE 'CA' END AS state,
               {_blank("cast(90000 + o_custkey % 100 AS string)", 31)} AS zipcode,
               'US' AS country,
               {_blank("'America/Los_Angeles'", 37)} AS timezone,
               day_text || ' 12:00:00' AS weather_timestamp,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE floor(c_acctbal / 25e0) / 4e0 END AS temperature_f,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE floor(c_acctbal / 30e0) / 4e0 END AS wind_chill_f,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE (o_custkey % 400) / 4e0 END AS humidity_pct,
               CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 28e0 + (o_custkey % 12) / 4e0 END AS pressure_in,
               CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE (o_orderkey % 41) / 4e0 END AS visibility_mi,
               {_blank("'NW'", 41)} AS wind_direction,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE (o_orderkey % 160) / 4e0 END AS wind_speed_mph,
               CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE (o_orderkey % 8) / 4e0 END AS precipitation_in,
               {_blank("'Fair'", 43)} AS weather_condition,
               {_FLAGS},
               {_blank("CASE WHEN o_orderkey % 24 BETWEEN 6 AND 18 THEN 'Day' ELSE 'Night' END", 47)} AS sunrise_sunset,
               {_blank("CASE WHEN o_orderkey % 24 BETWEEN 5 AND 19 THEN 'Day' ELSE 'Night' END", 53)} AS civil_twilight,
               'Day' AS nautical_twilight, cast(NULL AS string) AS astronomical_twilight,
               cast('2024-01-31 20:00:00' AS NTZ) AS load_timestamp
        FROM (SELECT o.*, c_acctbal, c_mktsegment, n_name,
                     cast(CASE WHEN o_orderkey % 101 = 0 THEN date '2013-05-06'
                               WHEN o_orderkey % 103 = 0 THEN date '2024-02-03'
                               WHEN o_orderkey % 107 = 0 THEN date '2021-01-01'
                               ELSE date '2023-10-24' + cast(floor((o_orderkey % 2400) / 24e0) AS int) END
                          AS string) AS day_text,
                     lpad(cast(o_orderkey % 24 AS string), 2, '0') || ':15:00' AS clock_text
              FROM @orders o JOIN @customer ON o_custkey = c_custkey JOIN @nation ON c_nationkey = n_nationkey) placed
    """,
    # Events as hourly weather, one reading per city and hour.
    "weather_historical_raw": """
        SELECT city || '_' || cast(day AS string) || '_' || cast(hour_of_day AS string) AS record_id, city,
               CASE WHEN city = 'NATION_24' THEN 'NV' ELSE 'CA' END AS state,
               'Region ' || substring(city, 8, 1) AS region, 'County' AS county,
               35e0 AS latitude, -120e0 AS longitude,
               cast(cast(day AS string) || ' ' || lpad(cast(hour_of_day AS string), 2, '0') || ':00:00' AS NTZ)
                   AS timestamp_utc,
               CASE WHEN k_sum % 29 = 0 THEN NULL ELSE floor(top_value * 2) / 4e0 END AS temperature_f,
               CASE WHEN k_sum % 31 = 0 THEN NULL ELSE k_max * 1e0 END AS relative_humidity_pct,
               CASE WHEN k_sum % 7 = 0 THEN NULL WHEN k_sum % 2 = 0 THEN 0e0 ELSE (k_min % 40) / 4e0 END
                   AS precipitation_mm,
               CASE WHEN k_sum % 11 = 0 THEN NULL ELSE (k_min % 24) / 4e0 END AS rain_mm,
               CASE WHEN k_sum % 13 = 0 THEN NULL WHEN k_sum % 5 = 0 THEN (k_min % 12) / 4e0 ELSE 0e0 END
                   AS snowfall_mm,
               (k_sum % 101) * 1e0 AS cloud_cover_pct, 990e0 + (k_sum % 160) / 4e0 AS pressure_msl_hpa,
               CASE WHEN k_sum % 17 = 0 THEN NULL ELSE (k_sum % 160) / 4e0 END AS wind_speed_mph,
               CASE WHEN k_sum % 19 = 0 THEN NULL ELSE (k_sum * 45 % 1440) / 4e0 END AS wind_direction_deg,
               (k_sum % 240) / 4e0 AS wind_gusts_mph,
               CASE WHEN k_sum % 41 = 0 THEN NULL ELSE cast(k_sum % 100 AS int) END AS weather_code,
               cast('2024-01-31 21:30:00' AS NTZ) AS load_timestamp, 'hourly archive' AS data_source
        FROM (SELECT city, day, hour_of_day, max(value) AS top_value, sum(k) AS k_sum, min(k) AS k_min, max(k) AS k_max
              FROM (SELECT 'NATION_' || cast(user_id % 25 AS string) AS city, cast(ts AS date) AS day,
                           hour(ts) AS hour_of_day, value,
                           cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k
                    FROM @events) readings
              GROUP BY city, day, hour_of_day) hourly
    """,
    # Customers as current weather stations, polled during the last two days.
    "weather_realtime_raw": """
        SELECT 'S' || cast(c_custkey AS string) AS record_id, n_name AS city, 'CA' AS state, r_name AS region,
               c_mktsegment AS county,
               CASE WHEN c_custkey % 61 = 0 THEN 95e0 ELSE 30e0 + (c_custkey % 40) / 4e0 END AS latitude,
               -120e0 - (c_custkey % 16) / 4e0 AS longitude,
               cast(day AS string) || ' ' || lpad(cast(hour_of_day AS string), 2, '0') || ':'
                   || lpad(cast(minute_of_day % 60 AS string), 2, '0') || ':00' AS timestamp_str,
               cast(day AS string) AS date, hour_of_day AS hour,
               CASE WHEN c_custkey % 67 = 0 THEN NULL ELSE floor(c_acctbal / 25e0) / 4e0 END AS temperature_f,
               CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE floor(c_acctbal / 26e0) / 4e0 END AS feels_like_f,
               floor(c_acctbal / 25e0) / 4e0 AS temp_min_f, floor(c_acctbal / 25e0) / 4e0 AS temp_max_f,
               CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE 995e0 + (c_custkey % 120) / 4e0 END AS pressure_msl_hpa,
               990e0 + (c_custkey % 120) / 4e0 AS surface_pressure_hpa,
               CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE (c_custkey * 7 % 101) * 1e0 END AS humidity_pct,
               CASE WHEN c_custkey % 47 = 0 THEN NULL ELSE (c_custkey % 200) / 4e0 END AS wind_speed_mph,
               CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE (c_custkey * 45 % 1460) / 4e0 END AS wind_direction_deg,
               (c_custkey % 300) / 4e0 AS wind_gusts_mph, (c_custkey % 101) * 1e0 AS cloud_cover_pct,
               CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 0e0
                    ELSE (c_custkey % 16) / 32e0 END AS precipitation_in,
               CASE WHEN c_custkey % 3 = 0 THEN (c_custkey % 8) / 32e0 ELSE 0e0 END AS rain_in,
               CASE WHEN c_custkey % 31 = 0 THEN 0.5e0 WHEN c_custkey % 29 = 0 THEN NULL ELSE 0e0 END AS snowfall_in,
               cast(c_custkey % 100 AS int) AS weather_code,
               CASE c_custkey % 8 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Fog' WHEN 3 THEN 'Drizzle'
                    WHEN 4 THEN 'Rain' WHEN 5 THEN 'Snow' WHEN 6 THEN 'Thunderstorm' END AS weather_main,
               c_mktsegment AS weather_description, '01d' AS weather_icon, cast(NULL AS string) AS raw_json,
               cast('2024-01-31 17:00:00' AS NTZ) AS load_timestamp, 'stations' AS data_source
        FROM (SELECT c.*, n_name, r_name, (c_custkey * 19 + 1440) % 2880 AS minute_of_day,
                     date '2024-01-30' + cast(floor(((c_custkey * 19 + 1440) % 2880) / 1440e0) AS int) AS day,
                     cast(floor((c_custkey * 19 % 1440) / 60e0) AS int) AS hour_of_day
              FROM @customer c JOIN @nation ON c_nationkey = n_nationkey
                   JOIN @region ON n_regionkey = r_regionkey) polled
    """,
    # Line items as flow readings of the last two days.
    "traffic_flow_raw": """
        SELECT cast(l_orderkey AS string) || '_' || cast(l_linenumber AS string) AS flow_id,
               n_name AS city, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'CA' END AS state,
               cast(day AS string) || ' ' || lpad(cast(hour_of_day AS string), 2, '0') || ':00:00' AS timestamp,
               35e0 AS latitude, -120e0 AS longitude, floor(l_quantity / 3e0) * 4e0 AS current_speed,
               CASE l_linenumber WHEN 4 THEN 32e0 WHEN 5 THEN NULL WHEN 6 THEN 0e0 ELSE 64e0 END AS free_flow_speed,
               cast(l_quantity AS int) * 6 AS current_travel_time,
               CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 60 END AS free_flow_travel_time,
               0.75e0 AS confidence,
               CASE WHEN l_tax > 0.07 THEN NULL ELSE l_linestatus = 'F' END AS road_closure,
               'Road ' || l_returnflag AS road_name, cast(NULL AS string) AS raw_json,
               cast('2024-01-31 23:15:00' AS NTZ) AS load_timestamp
        FROM (SELECT l.*, n_name,
                     date '2024-01-30' + cast((l_orderkey + l_partkey) % 2 AS int) AS day,
                     cast((l_orderkey + l_linenumber) % 24 AS int) AS hour_of_day
              FROM @lineitem l JOIN @supplier ON l_suppkey = s_suppkey
                   JOIN @nation ON s_nationkey = n_nationkey) read
    """,
}

ROLES |= {
    # Line items as flow answers; some keys are missing, some answers are cut off.
    "landed_flow": f"""
        SELECT {_city("l_suppkey")} AS city,
               '2024-01-31 ' || lpad(cast(l_linenumber AS string), 2, '0') || ':30:00' AS fetched_at,
               CASE WHEN l_partkey % 97 = 0 THEN '{{"flowSegmentData": {{"currentSpeed": '
                    ELSE '{{"flowSegmentData": {{"version": 1'
                         || {_key("currentSpeed", _int("l_quantity"), "l_partkey % 5 = 0")}
                         || {_key("freeFlowSpeed", _int("40 + l_partkey % 3 * 20"), "l_partkey % 7 = 0")}
                         || {_key("currentTravelTime", _int("l_quantity * 6"), "l_partkey % 11 = 0")}
                         || {_key("freeFlowTravelTime", "'60'", "l_partkey % 13 = 0")}
                         || {_key("confidence", "'0.75'", "l_partkey % 3 = 0")}
                         || {_key("roadClosure", "CASE WHEN l_linestatus = 'F' THEN 'true' ELSE 'false' END",
                                  "l_partkey % 4 = 0")}
                         || {_key("frc", _quoted("'FRC' || cast(l_linenumber AS string)"), "l_partkey % 6 = 0")}
                         || '}}}}' END AS payload
        FROM @lineitem
    """,
    # Orders as incident answers: a line, a point, no geometry, and an odd one.
    "landed_incidents": f"""
        SELECT {_city("o_custkey")} AS city, '2024-01-31 08:00:00' AS fetched_at,
               '{{"incidents": [{{"geometry": {{"type": "LineString", "coordinates": [['
                   || cast(-120 - o_orderkey % 8 AS string) || '.25, ' || cast(33 + o_orderkey % 8 AS string)
                   || '.5], [-118.0, 34.0]]}}, "properties": {{"version": 1'
                   || {_key("id", _quoted("'i' || cast(o_orderkey AS string)"), "o_orderkey % 5 = 0")}
                   || {_key("iconCategory", _int("o_orderkey % 14"))}
                   || {_key("magnitudeOfDelay", _int("o_orderkey % 5"), "o_orderkey % 6 = 0")}
                   || {_key("delay", _int("o_orderkey % 50 * 30 + o_orderkey % 3"), "o_orderkey % 4 = 0")}
                   || {_key("events", "'[{\"description\": \"' || o_orderpriority || '\", \"code\": 101}]'",
                            "o_orderkey % 3 = 0")}
                   || {_key("startTime", _quoted("cast(cast(o_orderdate AS date) AS string) || 'T10:00:00Z'"),
                            "o_orderkey % 7 = 0")}
                   || '}}}}, {{"geometry": {{"type": "Point", "coordinates": [-119.5, '
                   || cast(33 + o_orderkey % 8 AS string) || '.75]}}, "properties": {{"events": []}}}}, '
                   || '{{"properties": {{"id": "n' || cast(o_orderkey AS string) || '"}}}}, '
                   || '{{"geometry": {{"type": "Polygon", "coordinates": [[-121.5, 37.25]]}}, "properties": {{}}}}]}}'
                   AS payload
        FROM @orders
    """,
    # Customers as hourly answers of three hours with short arrays and bad values.
    "landed_hourly": f"""
        SELECT {_city("c_custkey")} AS city, '2024-01-31 02:00:00' AS fetched_at,
               '{{"hourly": {{"time": ["2024-01-30T0' || cast(c_custkey % 8 AS string)
                   || ':00", "2024-01-30T1' || cast(c_custkey % 8 AS string) || ':00:00Z", "2024-01-31T00:00"]'
                   || {_key("temperature_2m", "'[' || " + _int("c_acctbal / 100e0") + " || '.5, 40.25]'")}
                   || {_key("relative_humidity_2m", "'[50, null, ' || " + _int("c_custkey % 100") + " || ']'",
                            "c_custkey % 4 = 0")}
                   || {_key("rain", "'[0.0, \"x\", 1.5]'", "c_custkey % 3 = 0")}
                   || {_key("weather_code", "'[' || " + _int("c_custkey % 100") + " || ', 61.0, \"?\"]'")}
                   || '}}}}' AS payload
        FROM @customer
    """,
    # Customers as current answers.
    "landed_current": f"""
        SELECT {_city("c_custkey")} AS city, '2024-01-31 02:00:00' AS fetched_at,
               '{{"current": {{"interval": 900'
                   || {_key("time", _quoted("'2024-01-31T1' || cast(c_custkey % 10 AS string) || ':15'"),
                            "c_custkey % 9 = 0")}
                   || {_key("temperature_2m", _int("c_acctbal / 100e0") + " || '.5'", "c_custkey % 17 = 0")}
                   || {_key("apparent_temperature", _int("c_acctbal / 110e0"))}
                   || {_key("relative_humidity_2m", _int("c_custkey % 101"), "c_custkey % 19 = 0")}
                   || {_key("precipitation", "'0.25'", "c_custkey % 2 = 0")}
                   || {_key("weather_code", _int("c_custkey % 100"), "c_custkey % 23 = 0")}
                   || {_key("wind_speed_10m", _int("c_custkey % 50") + " || '.75'")}
                   || '}}}}' AS payload
        FROM @customer
    """,
}

_NAME = re.compile(r"@(\w+)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, role: str, **instead: DataFrame) -> DataFrame:
    """The role over the parquet files of ``sf_dir``, or over the given frames where named."""
    text = ROLES[role].replace("NTZ", "timestamp_ntz")
    for name in set(_NAME.findall(text)):
        source = instead[name] if name in instead else table(spark, sf_dir, name)
        source.createOrReplaceTempView(f"role_{name}")
    return spark.sql(_NAME.sub(r"role_\1", text))


def duck_sql(role: str) -> str:
    """The role's text over the registered views, as a common table expression."""
    text = ROLES[role].replace("NTZ", "timestamp")
    return f"{role} AS ({_NAME.sub(lambda m: m.group(1), text)})"
