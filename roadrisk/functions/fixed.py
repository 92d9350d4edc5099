"""Numbers, labels and tables that decide the results.

Everything here is data, stated once as plain text and read by the rule
functions next to it.  Nothing here is computed.
"""

from __future__ import annotations

# --- fixed values: monitored cities -----------------------------------------
CITIES = """
name;latitude;longitude;region;county
Los Angeles;34.0522;-118.2437;Southern California;Los Angeles
San Diego;32.7157;-117.1611;Southern California;San Diego
San Jose;37.3382;-121.8863;Bay Area;Santa Clara
San Francisco;37.7749;-122.4194;Bay Area;San Francisco
Fresno;36.7378;-119.7871;Central Valley;Fresno
Sacramento;38.5816;-121.4944;Central Valley;Sacramento
Long Beach;33.7701;-118.1937;Southern California;Los Angeles
Oakland;37.8044;-122.2712;Bay Area;Alameda
Bakersfield;35.3733;-119.0187;Central Valley;Kern
Anaheim;33.8366;-117.9143;Southern California;Orange
Santa Ana;33.7455;-117.8677;Southern California;Orange
Riverside;33.9806;-117.3755;Southern California;Riverside
Irvine;33.6846;-117.8265;Southern California;Orange
Chula Vista;32.6401;-117.0842;Southern California;San Diego
San Bernardino;34.1083;-117.2898;Southern California;San Bernardino
Fontana;34.0922;-117.4350;Southern California;San Bernardino
Oxnard;34.1975;-119.1771;Southern California;Ventura
Moreno Valley;33.9425;-117.2297;Southern California;Riverside
Huntington Beach;33.6603;-117.9992;Southern California;Orange
Glendale;34.1425;-118.2551;Southern California;Los Angeles
Santa Clarita;34.3917;-118.5426;Southern California;Los Angeles
Oceanside;33.1959;-117.3795;Southern California;San Diego
Corona;33.8753;-117.5664;Southern California;Riverside
Palmdale;34.5794;-118.1165;Southern California;Los Angeles
Pasadena;34.1478;-118.1445;Southern California;Los Angeles
Torrance;33.8358;-118.3406;Southern California;Los Angeles
Escondido;33.1192;-117.0864;Southern California;San Diego
Fremont;37.5485;-121.9886;Bay Area;Alameda
Hayward;37.6688;-122.0808;Bay Area;Alameda
Sunnyvale;37.3688;-122.0363;Bay Area;Santa Clara
Santa Clara;37.3541;-121.9552;Bay Area;Santa Clara
Berkeley;37.8715;-122.2730;Bay Area;Alameda
Concord;37.9780;-122.0311;Bay Area;Contra Costa
Vallejo;38.1041;-122.2566;Bay Area;Solano
Santa Rosa;38.4404;-122.7141;Bay Area;Sonoma
San Mateo;37.5630;-122.3255;Bay Area;San Mateo
Daly City;37.6879;-122.4702;Bay Area;San Mateo
Modesto;37.6391;-120.9969;Central Valley;Stanislaus
Stockton;37.9577;-121.2908;Central Valley;San Joaquin
Visalia;36.3302;-119.2921;Central Valley;Tulare
Clovis;36.8252;-119.7029;Central Valley;Fresno
Elk Grove;38.4088;-121.3716;Central Valley;Sacramento
Roseville;38.7521;-121.2880;Central Valley;Placer
Merced;37.3022;-120.4830;Central Valley;Merced
Turlock;37.4947;-120.8466;Central Valley;Stanislaus
Salinas;36.6777;-121.6555;Central Coast;Monterey
Santa Barbara;34.4208;-119.6982;Central Coast;Santa Barbara
Santa Cruz;36.9741;-122.0308;Central Coast;Santa Cruz
San Luis Obispo;35.2828;-120.6596;Central Coast;San Luis Obispo
Redding;40.5865;-122.3917;North Valley;Shasta
Chico;39.7285;-121.8375;North Valley;Butte
Eureka;40.8021;-124.1637;North Coast;Humboldt
Palm Springs;33.8303;-116.5453;Desert;Riverside
Indio;33.7206;-116.2156;Desert;Riverside
Victorville;34.5362;-117.2928;Desert;San Bernardino
"""

# Half the edge of the box around a city centre, in degrees.
CITY_BOX_DEG = 0.1

# --- fixed values: weather codes ---------------------------------------------
# A blank main_current means that the current-weather path does not know the
# code; a blank icon means that the default icon applies.
WEATHER_CODES = """
code;main_history;description;icon;main_current
0;Clear;clear sky;01d;Clear
1;Clouds;mainly clear;02d;Clouds
2;Clouds;partly cloudy;02d;Clouds
3;Clouds;overcast;03d;Clouds
45;Fog;fog;50d;Fog
48;Fog;depositing rime fog;50d;Fog
51;Rain;light drizzle;09d;Drizzle
53;Rain;moderate drizzle;09d;Drizzle
55;Rain;dense drizzle;09d;Drizzle
61;Rain;slight rain;10d;Rain
63;Rain;moderate rain;10d;Rain
65;Rain;heavy rain;10d;Rain
66;Freezing Rain;light freezing rain;;
67;Freezing Rain;heavy freezing rain;;
71;Snow;slight snow;13d;Snow
73;Snow;moderate snow;13d;Snow
75;Snow;heavy snow;13d;Snow
77;Snow;snow grains;13d;
80;Rain;slight rain showers;10d;
81;Rain;moderate rain showers;10d;
82;Rain;violent rain showers;10d;
85;Snow;slight snow showers;13d;
86;Snow;heavy snow showers;13d;
95;Thunderstorm;thunderstorm;11d;Thunderstorm
96;Thunderstorm;thunderstorm with slight hail;11d;
99;Thunderstorm;thunderstorm with heavy hail;11d;
"""
UNKNOWN_MAIN = "Unknown"
UNKNOWN_DESCRIPTION = "unknown"
DEFAULT_ICON = "01d"

# Condition groups of the cleaned hourly path.
CONDITION_GROUPS = """
label;codes
Clear;0
Partly Cloudy;1 2 3
Fog;45 48
Drizzle;51 53 55 56 57
Rain;61 63 65 66 67
Snow;71 73 75 77
Rain Showers;80 81 82
Snow Showers;85 86
Thunderstorm;95 96 99
"""
UNKNOWN_CONDITION = "Unknown"
OTHER_CONDITION = "Other"

# --- fixed values: bands ---------------------------------------------------------
# "below" bands: the first bound greater than the value wins; None is the rest.
TEMPERATURE_HISTORY = ((32, "Freezing"), (50, "Cold"), (70, "Moderate"), (85, "Warm"), (None, "Hot"))
TEMPERATURE_DETAILED = (
    (32, "Freezing"), (50, "Cold"), (65, "Cool"), (75, "Mild"), (85, "Warm"), (95, "Hot"), (None, "Very Hot"),
)
WIND_HISTORY = ((5, "Calm"), (15, "Light"), (25, "Moderate"), (35, "Strong"), (None, "Very Strong"))
HUMIDITY = ((30, "Dry"), (60, "Comfortable"), (80, "Humid"), (None, "Very Humid"))

# "from" bands: the first bound reached by the value wins; None is the rest.
TEMPERATURE_CURRENT = ((90, "Hot"), (70, "Warm"), (50, "Mild"), (32, "Cold"), (None, "Freezing"))
WIND_CURRENT = ((40, "High"), (25, "Moderate"), (10, "Light"), (None, "Calm"))
CONGESTION_LEVEL = ((0.75, "Severe"), (0.50, "Heavy"), (0.25, "Moderate"), (0.10, "Light"), (None, "Free Flow"))
CONGESTION_SCORE = ((75, 100), (50, 80), (25, 50), (10, 25), (None, 10))
FORECAST_RISK = ((50, "CRITICAL"), (30, "HIGH"), (15, "MEDIUM"), (None, "LOW"))

NO_FREE_FLOW_LEVEL = "Unknown"

# Precipitation classes, inches.
PRECIPITATION_DRY = "None"
PRECIPITATION_LIGHT = "Light"
PRECIPITATION_MODERATE = "Moderate"
PRECIPITATION_HEAVY = "Heavy"
PRECIPITATION_MODERATE_IN = 0.1
PRECIPITATION_HEAVY_IN = 0.3

# Compass sectors of 45 degrees; the first one is centred on north.
COMPASS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
COMPASS_HALF_SECTOR = 22.5

# Day periods: first hour, last hour, label; all other hours are Night.
DAY_PERIODS = ((6, 11, "Morning"), (12, 17, "Afternoon"), (18, 21, "Evening"))
NIGHT = "Night"

# --- fixed values: units -------------------------------------------------------------
HPA_TO_INHG = 0.02953
MM_TO_IN = 0.0393701
IN_TO_MM = 25.4

# Heat index: coefficient, power of temperature, power of humidity.
HEAT_INDEX_TERMS = (
    (-42.379, 0, 0), (2.04901523, 1, 0), (10.14333127, 0, 1), (-0.22475541, 1, 1), (-0.00683783, 2, 0),
    (-0.05481717, 0, 2), (0.00122874, 2, 1), (0.00085282, 1, 2), (-0.00000199, 2, 2),
)
HEAT_INDEX_ABOVE_F = 80
HEAT_INDEX_ABOVE_HUMIDITY = 40
# Wind chill: constant, temperature, wind power, temperature x wind power, exponent.
WIND_CHILL = (35.74, 0.6215, -35.75, 0.4275, 0.16)
WIND_CHILL_BELOW_F = 50
WIND_CHILL_ABOVE_MPH = 3

# --- fixed values: accidents ------------------------------------------------------------
TARGET_STATE = "CA"
LATITUDE_RANGE = (32.5, 42.0)
LONGITUDE_RANGE = (-124.5, -114.0)
SEVERITY_RANGE = (1, 4)
SEVERITY_LABELS = {1: "Minor", 2: "Moderate", 3: "Serious", 4: "Severe"}
UNKNOWN_SEVERITY = "Unknown"
SERIOUS_FROM = 3

ROAD_FLAGS = (
    "amenity", "bump", "crossing", "give_way", "junction", "no_exit", "railway", "roundabout", "station", "stop",
    "traffic_calming", "traffic_signal", "turning_loop",
)

# CSV header -> column name, in file order.
ACCIDENT_COLUMNS = """
ID;accident_id
Severity;severity
Start_Time;start_time
End_Time;end_time
Start_Lat;start_lat
Start_Lng;start_lng
Distance(mi);distance_mi
Description;description
Street;street
City;city
County;county
State;state
Zipcode;zipcode
Country;country
Timezone;timezone
Weather_Timestamp;weather_timestamp
Temperature(F);temperature_f
Wind_Chill(F);wind_chill_f
Humidity(%);humidity_pct
Pressure(in);pressure_in
Visibility(mi);visibility_mi
Wind_Direction;wind_direction
Wind_Speed(mph);wind_speed_mph
Precipitation(in);precipitation_in
Weather_Condition;weather_condition
Amenity;amenity
Bump;bump
Crossing;crossing
Give_Way;give_way
Junction;junction
No_Exit;no_exit
Railway;railway
Roundabout;roundabout
Station;station
Stop;stop
Traffic_Calming;traffic_calming
Traffic_Signal;traffic_signal
Turning_Loop;turning_loop
Sunrise_Sunset;sunrise_sunset
Civil_Twilight;civil_twilight
Nautical_Twilight;nautical_twilight
Astronomical_Twilight;astronomical_twilight
"""

# Text that a CSV reader of data frames takes as a missing value.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Text defaults of the staging model.
STAGING_TEXT_DEFAULTS = {
    "street": "Unknown", "city": "Unknown", "county": "Unknown", "state": "CA", "zipcode": "Unknown",
    "timezone": "America/Los_Angeles", "description": "No description", "wind_direction": "Unknown",
    "weather_condition": "Clear", "sunrise_sunset": "Day", "civil_twilight": "Day",
}
# Defaults of the cleaned table.
CLEANED_NUMBER_DEFAULTS = {
    "distance_mi": 0.0, "temperature_f": 70.0, "visibility_mi": 10.0, "wind_speed_mph": 0.0,
    "precipitation_in": 0.0, "humidity_pct": 50.0, "pressure_in": 29.92,
}
CLEANED_TEXT_COLUMNS = (
    "description", "street", "city", "county", "state", "zipcode", "country", "timezone", "wind_direction",
    "weather_condition", "sunrise_sunset", "civil_twilight", "nautical_twilight", "astronomical_twilight",
)

# --- fixed values: accident x weather ------------------------------------------------------
WEATHER_MATCH_DEFAULTS = {
    "temperature_f": 70.0, "temperature_category": "Moderate", "feels_like_f": 70.0, "humidity_pct": 50.0,
    "pressure_in": 29.92, "visibility_mi": 10.0, "visibility_category": "Good", "wind_speed_mph": 0.0,
    "wind_category": "Calm", "wind_direction_deg": 0.0, "weather_main": "Clear",
    "weather_description": "clear sky", "total_precip_1h_in": 0.0, "precipitation_category": "None",
    "clouds_pct": 0.0, "is_freezing": False, "is_poor_visibility": False, "is_high_wind": False,
    "is_heavy_rain": False, "has_snow": False,
}
RISK_WEIGHTS = {
    "is_poor_visibility": 2, "is_heavy_rain": 2, "has_snow": 2, "is_freezing": 1, "is_high_wind": 1,
}
RISK_NIGHT_WEIGHT = 1
RISK_SEVERITY_CAP = 3
LOW_RISK_UP_TO = 3
MEDIUM_RISK_UP_TO = 6
RISK_LABELS = ("Low Risk", "Medium Risk", "High Risk")
WEATHER_HAZARDS = ("is_poor_visibility", "is_heavy_rain", "has_snow", "is_freezing")
ROAD_RISKS = ("has_junction", "has_roundabout", "has_railway")
HOT_SPOT_MIN_ACCIDENTS = 5
HOT_SPOT_ROWS = 100

# --- fixed values: traffic ----------------------------------------------------------------------
INCIDENT_SEVERITY = {0: "MINOR", 1: "MODERATE", 2: "MAJOR"}
INCIDENT_SEVERITY_REST = "CRITICAL"
CITY_CONGESTION_MARGIN = 20

# --- fixed values: forecast ---------------------------------------------------------------------
HISTORY_DAYS = 1000
MIN_DAILY_ACCIDENTS = 3
HORIZON_DAYS = 7
ACTUAL_DAYS = 30
FORECAST_WEATHER_HOURS = 6
ADJUST_HOURS = 24
ML_WEEKEND_DOWS = (1, 7)
DAILY_WEATHER_DEFAULTS = {
    "avg_temp_f": 65.0, "avg_humidity_pct": 50.0, "avg_wind_speed_mph": 5.0, "avg_wind_gusts_mph": 10.0,
    "total_precipitation_mm": 0.0, "total_rain_mm": 0.0, "total_snowfall_mm": 0.0, "avg_cloud_cover_pct": 30.0,
    "avg_pressure_hpa": 1013.0, "max_wind_speed_mph": 10.0, "min_temp_f": 60.0, "max_temp_f": 75.0,
}
HEAVY_PRECIPITATION_DAY_MM = 10
FUTURE_PRECIPITATION_IN = 0.04
ADJUST_PRECIPITATION_IN = 0.1
HIGH_WIND_MPH = 25
FREEZING_F = 32
RISK_FACTORS = {"has_precipitation": 0.15, "has_high_wind": 0.10, "has_freezing_temp": 0.20}
CONGESTION_FACTOR = 0.12
CONGESTION_FACTOR_ABOVE_PCT = 30
EXTREME_HEAT_F = 95
SEVERE_CONGESTION_PCT = 40
MODERATE_CONGESTION_PCT = 20
REPORT_TOP_ROWS = 10
TRAINING_FEATURES = (
    "avg_temp_f", "avg_humidity_pct", "avg_wind_speed_mph", "total_precipitation_mm", "total_rain_mm",
    "total_snowfall_mm", "day_of_week", "is_weekend", "month", "heavy_precipitation", "high_wind",
    "freezing_temp", "snow_present",
)

# --- fixed values: quality --------------------------------------------------------------------------
MAX_AGE_YEARS = 10
MAX_DUPLICATE_RATE = 0.01
MIN_RECORDS = 1000
FRESH_WARN_HOURS = 2
FRESH_ERROR_HOURS = 6
EXTRACT_DAYS = 5

# Declared column checks: model, column, kind, accepted values.
COLUMN_CHECKS = """
stg_traffic_accidents;accident_id;unique;
stg_traffic_accidents;accident_id;not_null;
stg_traffic_accidents;severity;not_null;
stg_traffic_accidents;severity;accepted_values;1,2,3,4
stg_traffic_accidents;start_time;not_null;
stg_traffic_accidents;city;not_null;
stg_weather_historical;record_id;unique;
stg_weather_historical;record_id;not_null;
stg_weather_historical;temperature_f;not_null;
stg_traffic_flow_realtime;flow_id;unique;
stg_traffic_flow_realtime;flow_id;not_null;
stg_traffic_flow_realtime;city;not_null;
stg_traffic_flow_realtime;timestamp;not_null;
stg_traffic_flow_realtime;congestion_level;accepted_values;Free Flow,Light,Moderate,Heavy,Severe
accident_weather_correlation;accident_id;unique;
accident_weather_correlation;accident_id;not_null;
accident_weather_correlation;risk_category;accepted_values;Low Risk,Medium Risk,High Risk
fct_weather_current;record_id;unique;
fct_weather_current;record_id;not_null;
fct_weather_current;city;not_null;
fct_weather_current;region;not_null;
fct_weather_current;temperature_f;not_null;
"""


def rows(table: str, header: bool = True) -> list[list[str]]:
    """Rows of one of the text tables above, without its header line."""
    lines = [line.split(";") for line in table.strip().splitlines()]
    return lines[1:] if header else lines
