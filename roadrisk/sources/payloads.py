"""Landed service answers (A4–A11, A16): one line per polled city.

Input rows are ``schemas.LANDED``.  Answers of unknown cities are dropped, as
only listed cities are polled.  The city table is a literal relation of 55 rows,
so Spark knows its size and broadcasts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed
from ..functions.text import city_key
from ..functions.times import parse_time, time_text
from ..functions.traffic import delay_minutes, incident_severity, speed_reduction_pct
from ..functions.weather import current_labels

CORRUPT = "_corrupt_record"
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parsed(rows: DataFrame, schema: str, text: str = "payload", into: str = "parsed") -> DataFrame:
    """Parse a JSON column; a broken text sets ``_corrupt_record`` and leaves other rows alone."""
    return once(rows, F.from_json(text, f"{schema}, {CORRUPT} string", PERMISSIVE), into).withColumn(
        CORRUPT, F.col(into)[CORRUPT])


def once(rows: DataFrame, costly: Column, into: str) -> DataFrame:
    """Add a column that is computed once per row.

    A filter or field access on a plain projected column is merged with its
    expression, which would parse the text again for each; it is not merged
    with a generated one.
    """
    return rows.select("*", F.explode(F.array(costly)).alias(into))


def readable(rows: DataFrame, schema: str, text: str = "payload") -> DataFrame:
    return parsed(rows, schema, text).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable(rows: DataFrame, schema: str, text: str = "payload") -> DataFrame:
    """The rows to quarantine."""
    return parsed(rows, schema, text).where(F.col(CORRUPT).isNotNull()).drop("parsed")


def at_city(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Landed answers with the place of their city."""
    place = cities.select(
        F.col("name").alias("city"), "latitude", "longitude", "region", "county", F.lit(fixed.TARGET_STATE).alias("state"))
    return landed.join(place, "city")


def _flow_key() -> Column:
    fetched = F.replace(F.replace(F.col("fetched_at"), F.lit(" "), F.lit("_")), F.lit(":"), F.lit(""))
    return F.concat(F.col("city"), F.lit("_"), fetched)


def flow_raw(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Flow answers as raw rows: missing keys stay NULL."""
    flow = F.col("parsed.flowSegmentData")
    return readable(at_city(landed, cities), schemas.FLOW_PAYLOAD).select(
        _flow_key().alias("flow_id"), "city", "state", F.col("fetched_at").alias("timestamp"),
        "latitude", "longitude",
        flow.currentSpeed.alias("current_speed"), flow.freeFlowSpeed.alias("free_flow_speed"),
        flow.currentTravelTime.cast("int").alias("current_travel_time"),
        flow.freeFlowTravelTime.cast("int").alias("free_flow_travel_time"),
        flow.confidence.alias("confidence"),
        F.coalesce(flow.roadClosure, F.lit(False)).alias("road_closure"),
        F.coalesce(flow.frc, F.lit("Unknown")).alias("road_name"),
        F.get_json_object("payload", "$.flowSegmentData").alias("raw_json"),
    )


def flow_cleaned(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Flow answers as cleaned rows: missing keys take their defaults."""
    raw = flow_raw(landed, cities)
    current = F.coalesce("current_speed", F.lit(0.0))
    free = F.coalesce("free_flow_speed", F.lit(0.0))
    travel = F.coalesce("current_travel_time", F.lit(0))
    free_travel = F.coalesce("free_flow_travel_time", F.lit(0))
    return raw.select(
        "flow_id", "city", "state", "road_name", F.concat("city", F.lit("_segment")).alias("road_segment_id"),
        F.col("timestamp").try_cast("timestamp_ntz").alias("timestamp"), "latitude", "longitude",
        current.alias("current_speed_mph"), free.alias("free_flow_speed_mph"),
        speed_reduction_pct(free, current).alias("speed_reduction_pct"),
        travel.alias("current_travel_time_sec"), free_travel.alias("free_flow_travel_time_sec"),
        (travel - free_travel).alias("delay_sec"),
        F.coalesce("confidence", F.lit(0.5)).alias("confidence_level"), "road_closure",
    )


def _incidents(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """One row per element of the answer's incident array, with its text kept."""
    listed = readable(at_city(landed, cities), schemas.INCIDENTS_PAYLOAD)
    single = listed.select(
        "*", F.posexplode("parsed.incidents").alias("position", "raw_json")).drop("parsed", "payload")
    shaped = once(single, F.from_json("raw_json", schemas.INCIDENT), "incident")
    # The kind of coordinates is a matter of their text: [[x, y], ...] or [x, y].
    coordinates = F.col("incident.geometry.coordinates")
    return shaped.withColumns({
        "vertices": F.when(coordinates.rlike(r"^\s*\[\s*\["), F.from_json(coordinates, "array<array<double>>")),
        "point": F.when(coordinates.rlike(r"^\s*\[\s*[^\[\s\]]"), F.from_json(coordinates, "array<double>")),
    })


def _incident_key() -> Column:
    """The service's id; without one the city, the poll and the position name the incident."""
    fallback = F.concat_ws("_", F.lit("INC"), F.col("city"), F.col("position").cast("string"))
    return F.coalesce(F.col("incident.properties.id"), fallback)


def incidents_raw(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Incident answers as raw rows.  The declared geometry type decides which coordinates count."""
    kind = F.col("incident.geometry.type")
    first = F.get("vertices", F.lit(0))
    is_line = (kind == "LineString") & (F.size("vertices") > 0)
    is_point = (kind == "Point") & (F.size("point") >= 2)

    def place(axis: int, centre: str) -> Column:
        return F.coalesce(F.when(is_line, F.get(first, F.lit(axis))).when(is_point, F.get("point", F.lit(axis))),
                          F.col(centre))

    properties = F.col("incident.properties")
    return _incidents(landed, cities).select(
        _incident_key().alias("incident_id"), "city", "state", F.col("fetched_at").alias("timestamp"),
        place(1, "latitude").alias("latitude"), place(0, "longitude").alias("longitude"),
        properties.iconCategory.alias("icon_category"), properties.magnitudeOfDelay.alias("magnitude_of_delay"),
        F.get(properties.events, F.lit(0))["description"].alias("description"),
        properties.startTime.alias("start_time"), properties.endTime.alias("end_time"), "raw_json",
    )


def incidents_cleaned(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Incident answers as cleaned rows.  The shape of the coordinates decides, not their declared type."""
    first = F.get("vertices", F.lit(0))
    longitude = F.coalesce(F.when(F.size(first) >= 2, F.get(first, F.lit(0))), F.get("point", F.lit(0)),
                           F.col("longitude"))
    latitude = F.coalesce(F.when(F.size(first) >= 2, F.get(first, F.lit(1))), F.get("point", F.lit(1)),
                          F.col("latitude"))
    properties = F.col("incident.properties")
    described = F.get(properties.events, F.lit(0))["description"]
    return _incidents(landed, cities).select(
        _incident_key().alias("incident_id"), "city", "state",
        F.col("fetched_at").try_cast("timestamp_ntz").alias("timestamp"),
        latitude.alias("latitude"), longitude.alias("longitude"), described.alias("street"),
        F.coalesce(properties.iconCategory, F.lit("UNKNOWN")).alias("incident_type"),
        incident_severity(properties.magnitudeOfDelay).alias("severity"),
        F.coalesce(described, F.lit("No description")).alias("description"),
        F.round(delay_minutes(properties.delay), 0).cast("int").alias("delay_minutes"),
        F.lit(0).alias("length_meters"), F.lit(0).alias("affected_road_count"),
        parse_time(F.coalesce(properties.startTime, F.col("fetched_at"))).alias("start_time"),
        parse_time(properties.endTime).alias("end_time"), F.lit(True).alias("is_active"),
    )


def hourly_weather(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Hourly answers: parallel arrays become rows; short arrays and bad values give NULL."""
    answers = readable(at_city(landed, cities), schemas.HOURLY_PAYLOAD).withColumn("hourly", F.col("parsed.hourly"))
    hours = answers.select("*", F.posexplode("hourly.time").alias("position", "time")).drop("payload", "parsed")
    metrics = []
    for source, name in schemas.HOURLY_METRICS.items():
        value = F.get(F.col("hourly")[source], F.col("position")).try_cast("double")
        metrics.append((value.cast("int") if name == "weather_code" else value).alias(name))
    return hours.select(
        city_key(F.col("city"), F.translate("time", "T:-", "_")).alias("record_id"),
        "city", "state", "region", "county", "latitude", "longitude",
        parse_time(F.col("time")).alias("timestamp_utc"), *metrics,
    )


def current_weather(landed: DataFrame, cities: DataFrame) -> DataFrame:
    """Current answers.  The one temperature also stands for the day's minimum and maximum."""
    answers = readable(at_city(landed, cities), schemas.CURRENT_PAYLOAD).withColumn("current", F.col("parsed.current"))
    timed = answers.withColumn("moment", parse_time(F.coalesce(F.col("current.time"), F.col("fetched_at"))))
    moment, code = F.col("moment"), F.coalesce(F.col("current.weather_code"), F.lit(0.0)).cast("int")
    measured = {name: F.col("current")[source] for source, name in schemas.CURRENT_METRICS.items()}
    measured["temp_min_f"] = measured["temp_max_f"] = measured["temperature_f"]
    return timed.select(
        city_key(F.col("city"), F.date_format(moment, "yyyyMMdd_HHmm")).alias("record_id"),
        "city", "state", "region", "county", "latitude", "longitude",
        time_text(moment).alias("timestamp_str"), F.date_format(moment, "yyyy-MM-dd").alias("date"),
        F.hour(moment).alias("hour"), *[value.alias(name) for name, value in measured.items()],
        code.alias("weather_code"), *[label.alias(name) for name, label in current_labels(code).items()],
        F.col("payload").alias("raw_json"),
    )
