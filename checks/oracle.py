"""DuckDB statements that compute each query's result on their own way.

Bands are picked by counting passed bounds, codes by joining a VALUES table,
ranks and shares by plain windows.  Rounding goes through the text of the number
and DECIMAL, because Spark rounds the decimal text of a double half up.
"""

from __future__ import annotations

from roadrisk.functions import fixed

from . import roles

NOW = f"timestamp '{roles.AS_OF}'"
TODAY = f"date '{roles.AS_OF[:10]}'"


def rnd(value: str, digits: int) -> str:
    return f"cast(round(cast(cast({value} AS varchar) AS decimal(38, 17)), {digits}) AS double)"


def _pick(tests: list[str], labels: list) -> str:
    """Label number 1 + (count of true tests); the last one where a test is NULL."""
    texts = ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in labels)
    passed = " + ".join(f"cast({test} AS int)" for test in tests)
    return f"([{texts}])[coalesce(1 + {passed}, {len(labels)})]"


def below(value: str, bands) -> str:
    return _pick([f"({value} >= {bound})" for bound, _ in bands if bound is not None], [x for _, x in bands])


def reached(value: str, bands) -> str:
    return _pick([f"({value} < {bound})" for bound, _ in bands if bound is not None], [x for _, x in bands])


def yes(condition: str) -> str:
    return f"(({condition}) IS NOT DISTINCT FROM true)"


def one(condition: str) -> str:
    return f"cast({yes(condition)} AS int)"


def text_or(name: str, default: str) -> str:
    return f"CASE WHEN length(trim({name})) > 0 THEN trim({name}) ELSE '{default}' END AS {name}"


def _values(table: str) -> str:
    out = []
    for code, *rest in fixed.rows(table):
        out.append("(" + ", ".join([code] + [f"'{x}'" if x else "NULL" for x in rest]) + ")")
    return "VALUES " + ", ".join(out)


def _conditions() -> str:
    pairs = [(code, label) for label, codes in fixed.rows(fixed.CONDITION_GROUPS) for code in codes.split()]
    return "VALUES " + ", ".join(f"({code}, '{label}')" for code, label in pairs)


def _cities() -> str:
    out = [f"('{n}', {lat}e0, {lon}e0, '{r}', '{c}')" for n, lat, lon, r, c in fixed.rows(fixed.CITIES)]
    return "VALUES " + ", ".join(out)


def period(hour: str) -> str:
    labels = ["Night"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 6 + ["Evening"] * 4 + ["Night"] * 2
    return "([" + ", ".join(f"'{x}'" for x in labels) + f"])[{hour} + 1]"


def compass(degrees: str, closed_right: bool) -> str:
    """Distance to each sector's lower edge, as a count of passed edges."""
    op = ">" if closed_right else ">="
    edges = [22.5 + 45 * i for i in range(8)]
    names = [*fixed.COMPASS, "N"]
    passed = " + ".join(f"cast({degrees} {op} {e}e0 AS int)" for e in edges)
    return "([" + ", ".join(f"'{n}'" for n in names) + f"])[1 + {passed}]"


def heat(t: str, h: str) -> str:
    terms = []
    for weight, pt, ph in fixed.HEAT_INDEX_TERMS:
        terms.append(" * ".join([f"({weight:.8f}e0)"] + [t] * pt + [h] * ph))
    return f"CASE WHEN {t} > 80 AND {h} > 40 THEN {' + '.join(terms)} ELSE {t} END"


def chill(t: str, v: str) -> str:
    return (f"CASE WHEN {t} < 50 AND {v} > 3 THEN 35.74e0 + {t} * 0.6215e0 + ({v} ** 0.16e0) * (-35.75e0)"
            f" + {t} * ({v} ** 0.16e0) * 0.4275e0 ELSE {t} END")


_STAGING_TEXT = fixed.STAGING_TEXT_DEFAULTS
_FLAGS = ", ".join(f"(lower(trim({n})) IS NOT DISTINCT FROM 'true') AS has_{n}" for n in fixed.ROAD_FLAGS)
_ACCIDENT_FILTER = """state = 'CA' AND start_lat >= 32.5 AND start_lat <= 42 AND start_lng >= -124.5
    AND start_lng <= -114 AND severity IN (1, 2, 3, 4)"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "codes(code, main_history, description, icon, main_current)": ((), _values(fixed.WEATHER_CODES)),
    "conditions(code, label)": ((), _conditions()),
    "cities(name, lat, lon, region, county)": ((), _cities()),

    "stg_accidents": (("accidents_raw",), f"""
        SELECT accident_id, severity, (['Minor', 'Moderate', 'Serious', 'Severe'])[severity] AS severity_label,
               t AS start_time, try_cast(end_time AS timestamp) AS end_time, cast(t AS date) AS accident_date,
               cast(hour(t) AS int) AS accident_hour, cast(dayofweek(t) AS int) AS day_of_week,
               left(dayname(t), 3) AS day_name, (dayofweek(t) IN (0, 6)) AS is_weekend,
               start_lat AS latitude, start_lng AS longitude,
               {", ".join(text_or(n, d) for n, d in _STAGING_TEXT.items())},
               distance_mi AS distance_affected_mi, try_cast(weather_timestamp AS timestamp) AS weather_timestamp,
               temperature_f, wind_chill_f, humidity_pct, pressure_in, visibility_mi, wind_speed_mph,
               precipitation_in, {_FLAGS}, load_timestamp, {NOW} AS dbt_updated_at
        FROM (SELECT *, try_cast(start_time AS timestamp) AS t FROM accidents_raw)
        WHERE t IS NOT NULL AND {_ACCIDENT_FILTER}"""),

    "accidents_clean": (("accidents_raw",), f"""
        SELECT * REPLACE (
            {", ".join(f"date_trunc('second', try_cast({n} AS timestamp)) AS {n}"
                       for n in ("start_time", "end_time", "weather_timestamp"))},
            {", ".join(f"(lower(trim({n})) IS NOT DISTINCT FROM 'true') AS {n}" for n in fixed.ROAD_FLAGS)},
            {", ".join(f"ifnull({n}, {d}e0) AS {n}" for n, d in fixed.CLEANED_NUMBER_DEFAULTS.items())},
            {", ".join(f"ifnull({n}, '') AS {n}" for n in fixed.CLEANED_TEXT_COLUMNS)})
        FROM accidents_raw
        WHERE abs(start_lat) <= 90 AND abs(start_lng) <= 180 AND severity IN (1, 2, 3, 4)"""),

    "stg_weather": (("weather_historical_raw", "codes(code, main_history, description, icon, main_current)"), f"""
        SELECT record_id, city, state, region, county, 'US' AS country, latitude, longitude,
               timestamp_utc AS timestamp, cast(timestamp_utc AS date) AS date,
               cast(hour(timestamp_utc) AS int) AS hour, cast(dayofweek(timestamp_utc) AS int) AS day_of_week,
               dayname(timestamp_utc) AS day_name, dayofweek(timestamp_utc) IN (0, 6) AS is_weekend,
               temperature_f, temperature_f AS feels_like_f, temperature_f AS temp_min_f, temperature_f AS temp_max_f,
               {rnd("pressure_msl_hpa * 0.02953e0", 2)} AS pressure_in, relative_humidity_pct AS humidity_pct,
               cast(NULL AS double) AS visibility_mi, cloud_cover_pct AS clouds_pct, wind_speed_mph,
               wind_direction_deg AS wind_deg, wind_gusts_mph AS wind_gust_mph,
               {rnd("rain_mm * 0.0393701e0", 3)} AS rain_1h_in, cast(NULL AS double) AS rain_3h_in,
               {rnd("snowfall_mm * 0.0393701e0", 3)} AS snow_1h_in, cast(NULL AS double) AS snow_3h_in,
               {rnd("precipitation_mm * 0.0393701e0", 3)} AS total_precip_1h_in, weather_code,
               ifnull(main_history, 'Unknown') AS weather_main, ifnull(description, 'unknown') AS weather_description,
               ifnull(icon, '01d') AS weather_icon,
               {below("temperature_f", fixed.TEMPERATURE_HISTORY)} AS temperature_category,
               'Unknown' AS visibility_category, {below("wind_speed_mph", fixed.WIND_HISTORY)} AS wind_category,
               {_pick(["(p > 0e0)", "(p >= 0.1e0)", "(p >= 0.3e0)"], ["None", "Light", "Moderate", "Heavy"])}
                   AS precipitation_category,
               {yes("temperature_f < 32")} AS is_freezing, false AS is_poor_visibility,
               {yes("wind_speed_mph > 25")} AS is_high_wind, {yes("rain_mm * 0.0393701e0 > 0.1e0")} AS is_heavy_rain,
               {yes("snowfall_mm > 0")} AS has_snow, load_timestamp, data_source, {NOW} AS dbt_updated_at
        FROM (SELECT *, ifnull(precipitation_mm, 0e0) * 0.0393701e0 AS p FROM weather_historical_raw)
             LEFT JOIN codes ON code = weather_code
        WHERE record_id IS NOT NULL AND timestamp_utc IS NOT NULL AND state = 'CA'"""),

    "stg_current": (("weather_realtime_raw",), f"""
        SELECT * EXCLUDE (timestamp_str), cast(timestamp_str AS timestamp) AS timestamp_utc,
               {reached("temperature_f", fixed.TEMPERATURE_CURRENT)} AS temperature_category,
               {reached("wind_speed_mph", fixed.WIND_CURRENT)} AS wind_category,
               {reached("nullif(precipitation_in, 0e0)", ((0.3, "Heavy"), (0.1, "Moderate"), (1e-9, "Light"),
                                                       (None, "None")))} AS precipitation_category,
               temperature_f <= 32 AS is_freezing, {yes("wind_speed_mph >= 40")} AS is_high_wind,
               {yes("precipitation_in >= 0.3e0")} AS is_heavy_rain, {yes("snowfall_in > 0")} AS has_snow
        FROM weather_realtime_raw
        WHERE temperature_f IS NOT NULL AND abs(latitude) <= 90 AND abs(longitude) <= 180"""),

    "stg_flow": (("traffic_flow_raw",), f"""
        SELECT flow_id, city, state, cast(timestamp AS timestamp) AS timestamp, latitude, longitude,
               current_speed AS current_speed_mph, free_flow_speed AS free_flow_speed_mph,
               ifnull({rnd("loss * 100", 2)}, 0e0) AS speed_reduction_pct,
               CASE WHEN loss IS NULL THEN 'Unknown' ELSE {reached("loss", fixed.CONGESTION_LEVEL)} END
                   AS congestion_level,
               current_travel_time AS current_travel_time_sec, free_flow_travel_time AS free_flow_travel_time_sec,
               current_travel_time - free_flow_travel_time AS delay_sec, confidence AS confidence_level,
               ifnull(road_closure, false) AS road_closure, road_name, load_timestamp, raw_json
        FROM (SELECT *, (free_flow_speed - current_speed) / nullif(free_flow_speed, 0e0) AS loss FROM traffic_flow_raw)
        WHERE least(current_speed, free_flow_speed) >= 0 AND current_speed IS NOT NULL AND free_flow_speed IS NOT NULL
        """),
    "scored_flow": (("stg_flow",), f"""
        SELECT *, {reached("speed_reduction_pct", fixed.CONGESTION_SCORE)} AS congestion_score FROM stg_flow"""),
    "traffic_mart": (("scored_flow",), """
        SELECT *, congestion_score - city_avg_congestion AS congestion_vs_city_avg,
               CASE WHEN congestion_score - city_avg_congestion >= 20 THEN 'ABOVE_AVG'
                    WHEN city_avg_congestion - congestion_score >= 20 THEN 'BELOW_AVG' ELSE 'AVERAGE' END
                   AS relative_congestion_level
        FROM (SELECT * EXCLUDE (current_travel_time_sec, free_flow_travel_time_sec, load_timestamp, raw_json),
                     CASE WHEN state IS NOT NULL THEN avg(congestion_score) OVER c END AS city_avg_congestion,
                     CASE WHEN state IS NOT NULL THEN count(*) OVER c END AS city_total_segments,
                     CASE WHEN state IS NOT NULL THEN cast(sum(cast(road_closure AS int)) OVER c AS bigint) END
                         AS city_closed_roads
              FROM scored_flow WINDOW c AS (PARTITION BY city, state))"""),

    "correlation": (("stg_accidents", "stg_weather"), f"""
        SELECT *, {_pick(["(risk_score > 3)", "(risk_score > 6)"], list(fixed.RISK_LABELS))} AS risk_category
        FROM (SELECT m.*, least(severity, 3) + 2 * (cast(is_poor_visibility AS int) + cast(is_heavy_rain AS int)
                          + cast(has_snow AS int)) + cast(is_freezing AS int) + cast(is_high_wind AS int)
                          + cast(sunrise_sunset = 'Night' AS int) AS risk_score,
                     (is_poor_visibility OR is_heavy_rain OR has_snow OR is_freezing) AS has_weather_hazard,
                     (has_junction OR has_roundabout OR has_railway) AS has_infrastructure_risk
              FROM (SELECT a.accident_id, a.severity, severity_label, start_time, end_time, accident_date,
                           accident_hour, a.day_of_week, a.day_name, a.is_weekend, a.city, a.county, a.state,
                           a.latitude AS accident_lat, a.longitude AS accident_lng, street, zipcode,
                           distance_affected_mi, a.description, has_amenity, has_bump, has_junction,
                           has_traffic_signal, has_crossing, has_stop, has_roundabout, has_railway, has_give_way,
                           has_traffic_calming, sunrise_sunset, civil_twilight, {{matched}}
                    FROM stg_accidents a LEFT JOIN stg_weather w
                         ON w.city = a.city AND w.date = a.accident_date AND w.hour = a.accident_hour) m)"""),

    "current_metrics": (("stg_current",), f"""
        SELECT * EXCLUDE (timestamp_utc, date, raw_json), timestamp_utc AS weather_timestamp, date AS weather_date,
               {period("hour")} AS time_of_day, {rnd("feels_like_f - temperature_f", 1)} AS heat_index_difference,
               {below("temperature_f", fixed.TEMPERATURE_DETAILED)} AS temperature_category_detailed,
               {below("humidity_pct", fixed.HUMIDITY)} AS humidity_category,
               CASE WHEN wind_direction_deg > 22.5 THEN {compass("wind_direction_deg", True)} ELSE 'N' END
                   AS wind_direction_cardinal,
               {yes("greatest(precipitation_in, rain_in, snowfall_in) > 0")} AS has_precipitation,
               CASE WHEN {yes("abs(temperature_f - 70) <= 5 AND abs(humidity_pct - 45) <= 15 AND wind_speed_mph < 15 "
                              "AND precipitation_in = 0")} THEN 'Excellent'
                    WHEN {yes("abs(temperature_f - 70) <= 15 AND humidity_pct < 70 AND wind_speed_mph < 20 "
                              "AND precipitation_in < 0.1e0")} THEN 'Good'
                    WHEN {yes("abs(temperature_f - 67.5) <= 27.5 AND wind_speed_mph < 30 "
                              "AND precipitation_in < 0.3e0")} THEN 'Fair' ELSE 'Poor' END AS comfort_index
        FROM stg_current"""),

    "daily_accidents": (("accidents_clean",), f"""
        SELECT cast(start_time AS date) AS date, city, count(*) AS accident_count,
               sum(severity) / count(*) AS avg_severity,
               count(*) FILTER (severity IN (3, 4)) AS severe_accident_count
        FROM accidents_clean WHERE start_time >= {TODAY} - 1000 AND city IS NOT NULL GROUP BY ALL"""),
    "daily_weather": (("weather_historical_raw",), f"""
        SELECT cast(timestamp_utc AS date) AS date, city, avg(temperature_f) AS avg_temp_f,
               avg(relative_humidity_pct) AS avg_humidity_pct, avg(wind_speed_mph) AS avg_wind_speed_mph,
               avg(wind_gusts_mph) AS avg_wind_gusts_mph, sum(precipitation_mm) AS total_precipitation_mm,
               sum(rain_mm) AS total_rain_mm, sum(snowfall_mm) AS total_snowfall_mm,
               avg(cloud_cover_pct) AS avg_cloud_cover_pct, avg(pressure_msl_hpa) AS avg_pressure_hpa,
               max(wind_speed_mph) AS max_wind_speed_mph, min(temperature_f) AS min_temp_f,
               max(temperature_f) AS max_temp_f
        FROM weather_historical_raw WHERE timestamp_utc >= {TODAY} - 1000 GROUP BY ALL"""),
    "training": (("daily_accidents", "daily_weather"), f"""
        SELECT a.*, {", ".join(f"ifnull({n}, {d}e0) AS {n}" for n, d in fixed.DAILY_WEATHER_DEFAULTS.items())},
               cast(dayofweek(date) AS int) AS day_of_week, cast(dayofweek(date) = 1 AS int) AS is_weekend,
               cast(month(date) AS int) AS month, cast(quarter(date) AS int) AS quarter,
               {one("total_precipitation_mm > 10")} AS heavy_precipitation,
               {one("w.max_wind_speed_mph > 25")} AS high_wind, {one("w.avg_temp_f < 32")} AS freezing_temp,
               {one("total_snowfall_mm > 0")} AS snow_present
        FROM daily_accidents a LEFT JOIN daily_weather w USING (date, city) WHERE accident_count >= 3"""),
    "training_view": (("training",), f"""
        SELECT date, city, accident_count, {", ".join(fixed.TRAINING_FEATURES)} FROM training"""),
    "weather_6h": (("weather_realtime_raw",), f"""
        SELECT city, avg(temperature_f) AS current_temp_f, avg(humidity_pct) AS current_humidity_pct,
               avg(wind_speed_mph) AS current_wind_speed_mph, avg(cloud_cover_pct) AS current_cloud_cover_pct,
               {one("max(wind_speed_mph) > 25")} AS has_high_wind, {one("min(temperature_f) < 32")} AS has_freezing_temp,
               {one("max(precipitation_in) > 0.04e0")} AS has_precipitation,
               avg(precipitation_in) * 25.4e0 AS current_precipitation_mm
        FROM weather_realtime_raw WHERE cast(timestamp_str AS timestamp) >= {NOW} - to_hours(6) GROUP BY city"""),
    "weather_24h": (("weather_realtime_raw",), f"""
        SELECT city, avg(temperature_f) AS current_temp_f, avg(humidity_pct) AS current_humidity_pct,
               avg(wind_speed_mph) AS current_wind_speed_mph, avg(cloud_cover_pct) AS current_cloud_cover_pct,
               {one("max(wind_speed_mph) > 25")} AS has_high_wind, {one("min(temperature_f) < 32")} AS has_freezing_temp,
               {one("max(precipitation_in) > 0.1e0")} AS has_precipitation,
               sum(precipitation_in) AS current_precipitation_in
        FROM weather_realtime_raw WHERE cast(timestamp_str AS timestamp) >= {NOW} - to_hours(24) GROUP BY city"""),
    "traffic_24h": (("traffic_flow_raw",), f"""
        SELECT city, avg(current_speed) AS avg_current_speed, avg(free_flow_speed) AS avg_free_flow_speed,
               avg(ifnull((free_flow_speed - current_speed) / nullif(free_flow_speed, 0e0) * 100, 0e0))
                   AS avg_congestion_pct, count(*) AS traffic_data_points
        FROM traffic_flow_raw WHERE cast(timestamp AS timestamp) >= {NOW} - to_hours(24) GROUP BY city"""),
    "future": (("training_view", "weather_6h"), f"""
        SELECT cast(day AS date) AS date, city, ifnull(current_temp_f, 65e0) AS avg_temp_f,
               ifnull(current_humidity_pct, 50e0) AS avg_humidity_pct,
               ifnull(current_wind_speed_mph, 5e0) AS avg_wind_speed_mph,
               ifnull(current_precipitation_mm, 0e0) AS total_precipitation_mm,
               ifnull(current_precipitation_mm, 0e0) AS total_rain_mm, 0e0 AS total_snowfall_mm,
               cast(dayofweek(day) AS int) AS day_of_week, cast(dayofweek(day) = 1 AS int) AS is_weekend,
               cast(month(day) AS int) AS month, ifnull(has_precipitation, 0) AS heavy_precipitation,
               ifnull(has_high_wind, 0) AS high_wind, ifnull(has_freezing_temp, 0) AS freezing_temp,
               0 AS snow_present
        FROM (SELECT city, unnest(generate_series({TODAY}, {TODAY} + 6, INTERVAL 1 DAY)) AS day
              FROM (SELECT DISTINCT city FROM training_view)) LEFT JOIN weather_6h USING (city)"""),
    "points": (("training_view",), f"""
        SELECT city, date_diff('day', {TODAY}, date) AS x, accident_count AS y, dayofweek(date) AS dow
        FROM training_view"""),
    "trend": (("points",), """
        SELECT city, n, slope, (sy - slope * sx) / n AS intercept, syy, sy, sxy
        FROM (SELECT city, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(y * y) AS syy, sum(x * y) AS sxy,
                     cast(count(*) * sum(x * y) - sum(x) * sum(y) AS double)
                         / nullif(count(*) * sum(x * x) - sum(x) * sum(x), 0) AS slope
              FROM points GROUP BY city)
        WHERE n >= 14 AND slope IS NOT NULL"""),
    "effects": (("points", "trend"), """
        SELECT city, dow, count(*) AS n_dow,
               (sum(y) - any_value(intercept) * count(*) - any_value(slope) * sum(x)) / count(*) AS effect
        FROM points JOIN trend USING (city) GROUP BY city, dow"""),
    "spreads": (("trend", "effects"), """
        SELECT city, sqrt(greatest(any_value(syy - intercept * sy - slope * sxy) - sum(n_dow * effect * effect), 0e0)
                          / greatest(any_value(n) - 2, 1)) AS sigma
        FROM trend JOIN effects USING (city) GROUP BY city"""),
    "forecast": (("future", "trend", "effects", "spreads"), f"""
        SELECT city AS series, cast(date AS timestamp) AS ts, estimate AS forecast,
               estimate - sigma * 1.96e0 AS lower_bound, estimate + sigma * 1.96e0 AS upper_bound
        FROM (SELECT f.city, date, sigma,
                     intercept + slope * date_diff('day', {TODAY}, date) + ifnull(effect, 0e0) AS estimate
              FROM future f JOIN trend USING (city) JOIN spreads USING (city)
                   LEFT JOIN effects e ON e.city = f.city AND e.dow = dayofweek(f.date))"""),
    "final": (("training", "forecast", "weather_24h", "traffic_24h"), f"""
        SELECT city, date, accident_count AS actual_accident_count, cast(NULL AS double) AS forecasted_accident_count,
               cast(NULL AS double) AS lower_bound, cast(NULL AS double) AS upper_bound, 'ACTUAL' AS data_type,
               avg_temp_f, total_precipitation_mm, avg_wind_speed_mph, cast(NULL AS double) AS current_temp_f,
               cast(NULL AS double) AS current_congestion_pct, cast(NULL AS double) AS risk_multiplier
        FROM training WHERE date >= {TODAY} - 30
        UNION ALL
        SELECT series, cast(ts AS date), NULL, {rnd(rnd("forecast", 2) + " * m", 2)},
               {rnd(rnd("lower_bound", 2) + " * m", 2)}, {rnd(rnd("upper_bound", 2) + " * m", 2)}, 'FORECAST',
               NULL, NULL, NULL, current_temp_f, avg_congestion_pct, m
        FROM (SELECT f.*, current_temp_f, avg_congestion_pct,
                     1e0 + ifnull(has_precipitation, 0) * 0.15e0 + ifnull(has_high_wind, 0) * 0.1e0
                         + ifnull(has_freezing_temp, 0) * 0.2e0
                         + CASE WHEN {yes("avg_congestion_pct > 30")} THEN 0.12e0 ELSE 0e0 END AS m
              FROM forecast f LEFT JOIN weather_24h w ON w.city = series LEFT JOIN traffic_24h t ON t.city = series)
        """),
    "safety_city": (("correlation",), """
        SELECT city, county, state, severity, severity_label, count(*) AS accident_count,
               avg(temperature_f) AS avg_temperature_f, avg(visibility_mi) AS avg_visibility_mi,
               avg(wind_speed_mph) AS avg_wind_speed_mph, avg(humidity_pct) AS avg_humidity_pct,
               count(*) FILTER (has_weather_hazard) AS weather_related_count,
               count(*) FILTER (has_infrastructure_risk) AS infrastructure_related_count,
               avg(risk_score) AS avg_risk_score, min(accident_date) AS earliest_accident,
               max(accident_date) AS latest_accident
        FROM correlation GROUP BY ALL"""),
    "safety_conditions": (("correlation",), """
        SELECT weather_main, weather_description, count(*) AS accident_count, avg(severity) AS avg_severity,
               avg(risk_score) AS avg_risk_score, count(*) FILTER (severity > 2) AS severe_accident_count
        FROM correlation GROUP BY ALL"""),
    "safety_times": (("correlation",), """
        SELECT day_name, accident_hour, is_weekend, sunrise_sunset, count(*) AS accident_count,
               avg(severity) AS avg_severity, avg(risk_score) AS avg_risk_score,
               count(*) FILTER (has_weather_hazard) AS weather_related_count
        FROM correlation GROUP BY ALL"""),
    "safety_spots": (("correlation",), """
        SELECT city, county, state, street, count(*) AS accident_count, avg(severity) AS avg_severity,
               avg(risk_score) AS avg_risk_score, max(risk_category) AS max_risk_category,
               count(*) FILTER (has_junction) AS junction_accidents,
               count(*) FILTER (has_traffic_signal) AS traffic_signal_accidents,
               count(*) FILTER (has_weather_hazard) AS weather_related_accidents
        FROM correlation GROUP BY city, county, state, street HAVING count(*) > 4
        ORDER BY avg_risk_score DESC, city, county, state, street LIMIT 100"""),
}


def _matched() -> str:
    names = {"wind_direction_deg": "wind_deg"}
    out = []
    for name, default in fixed.WEATHER_MATCH_DEFAULTS.items():
        literal = f"'{default}'" if isinstance(default, str) else (
            str(default).lower() if isinstance(default, bool) else f"{default}e0")
        out.append(f"ifnull(w.{names.get(name, name)}, {literal}) AS {name}")
    return ", ".join(out)


CTES["correlation"] = (CTES["correlation"][0], CTES["correlation"][1].replace("{matched}", _matched()))


def sql(select: str, *needs: str) -> str:
    """A statement with the named tables, and what they are made of, in front."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        if name in roles.ROLES:
            done[name] = roles.duck_sql(name)
            return
        full = next(key for key in CTES if key == name or key.startswith(name + "("))
        if full in done:
            return
        parts, text = CTES[full]
        for part in parts:
            add(part)
        done[full] = f"{full} AS ({text})"

    for need in needs:
        add(need)
    # A statement that begins with a comma goes on with tables of its own.
    return f"WITH {', '.join(done.values())} {select}" if done else select
