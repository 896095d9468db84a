"""Column layouts of the tables the jobs read and write.

Every identifier is a string: feeds mix numeric and text ids, and an implicit cast
would fail under ANSI mode on the first id that is not a number. Layouts are DDL text, so
this module needs no session.
"""

from __future__ import annotations

WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


# Static GTFS files, in file column order (fixed by the GTFS text format).
GTFS_FILES = {
    "calendar": (
        "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, "
        "saturday int, sunday int, start_date string, end_date string"
    ),
    "calendar_dates": "service_id string, date string, exception_type int",
    "trips": (
        "route_id string, service_id string, trip_id string, trip_headsign string, "
        "trip_short_name string, direction_id int, block_id string, shape_id string, "
        "wheelchair_accessible int, bikes_allowed int"
    ),
    "stop_times": (
        "trip_id string, arrival_time string, departure_time string, stop_id string, "
        "stop_sequence int, stop_headsign string, pickup_type int, drop_off_type int, "
        "shape_dist_traveled double"
    ),
    "stops": (
        "stop_id string, stop_code string, stop_name string, stop_desc string, stop_lat double, "
        "stop_lon double, zone_id string, stop_url string, location_type int, parent_station string"
    ),
    "routes": (
        "route_id string, agency_id string, route_short_name string, route_long_name string, "
        "route_desc string, route_type int, route_url string, route_color string, "
        "route_text_color string"
    ),
    "agency": (
        "agency_id string, agency_name string, agency_url string, agency_timezone string, "
        "agency_lang string, agency_fare_url string"
    ),
    "feed_info": (
        "feed_publisher_name string, feed_publisher_url string, feed_lang string, "
        "feed_start_date string, feed_end_date string, feed_version string"
    ),
    "directions": (
        "direction string, direction_id int, route_id string, route_short_name string"
    ),
    "direction_names_exceptions": (
        "route_name string, direction_id int, direction_name string, direction_do int"
    ),
    "stop_order_exceptions": (
        "route_name string, direction_name string, direction_do int, stop_id string, "
        "stop_name string, stop_do int"
    ),
    "signup_periods": "sign_id string, from_date string, to_date string",
}

# Realtime tables and the key each one is upserted by. The alerts key has no snapshot
# time, so a later snapshot of an alert replaces the earlier one.
REALTIME_TABLES = {
    "trips": (
        (
            "trip_id string, start_date string, route_id string, direction_id int, snapshot_ts long"
        ),
        ("trip_id", "snapshot_ts"),
    ),
    "stops": (
        (
            "stop_id string, trip_id string, stop_sequence int, arrival_delay int, "
            "arrival_time long, departure_delay int, departure_time long, snapshot_ts long"
        ),
        ("stop_id", "trip_id", "stop_sequence", "snapshot_ts"),
    ),
    "vehicles": (
        "vehicle_id string, trip_id string, vehicle_label string, snapshot_ts long",
        ("vehicle_id", "trip_id", "snapshot_ts"),
    ),
    "alerts": (
        (
            "alert_id string, route_id string, active_period_start long, active_period_end long, "
            "stop_id string, route_type int, snapshot_ts long, cause int, effect int, "
            "severity_level int"
        ),
        ("alert_id", "stop_id", "route_id"),
    ),
}

# Value stored for a missing time, delay, period end or stop.
MISSING = -1

TRIP_FEED = """
    header struct<timestamp: long>,
    entity array<struct<
        id: string,
        trip_update: struct<
            timestamp: long,
            trip: struct<trip_id: string, start_date: string, route_id: string, direction_id: int>,
            stop_time_update: array<struct<
                stop_sequence: int,
                stop_id: string,
                arrival: struct<delay: int, time: long>,
                departure: struct<delay: int, time: long>>>,
            vehicle: struct<id: string, label: string>>>>
"""

ALERT_FEED = """
    header struct<timestamp: long>,
    entity array<struct<
        id: string,
        alert: struct<
            active_period: array<struct<start: long, end: long>>,
            cause: int,
            effect: int,
            severity_level: int,
            informed_entity: array<struct<route_type: int, route_id: string, stop_id: string>>>>>
"""

# The same messages in the protobuf JSON mapping: lowerCamelCase names, 64-bit integers
# as strings, enum names instead of numbers.
TRIP_FEED_CAMEL = """
    header struct<timestamp: string>,
    entity array<struct<
        id: string,
        tripUpdate: struct<
            timestamp: string,
            trip: struct<tripId: string, startDate: string, routeId: string, directionId: int>,
            stopTimeUpdate: array<struct<
                stopSequence: int,
                stopId: string,
                arrival: struct<delay: int, time: string>,
                departure: struct<delay: int, time: string>>>,
            vehicle: struct<id: string, label: string>>>>
"""

ALERT_FEED_CAMEL = """
    header struct<timestamp: string>,
    entity array<struct<
        id: string,
        alert: struct<
            activePeriod: array<struct<start: string, end: string>>,
            cause: string,
            effect: string,
            severityLevel: string,
            informedEntity: array<struct<routeType: int, routeId: string, stopId: string>>>>>
"""

# Enum numbers of the public GTFS-realtime specification, in order from 1.
ALERT_CAUSES = (
    "UNKNOWN_CAUSE", "OTHER_CAUSE", "TECHNICAL_PROBLEM", "STRIKE", "DEMONSTRATION", "ACCIDENT",
    "HOLIDAY", "WEATHER", "MAINTENANCE", "CONSTRUCTION", "POLICE_ACTIVITY", "MEDICAL_EMERGENCY",
)
ALERT_EFFECTS = (
    "NO_SERVICE", "REDUCED_SERVICE", "SIGNIFICANT_DELAYS", "DETOUR", "ADDITIONAL_SERVICE",
    "MODIFIED_SERVICE", "OTHER_EFFECT", "UNKNOWN_EFFECT", "STOP_MOVED", "NO_EFFECT",
    "ACCESSIBILITY_ISSUE",
)
ALERT_SEVERITIES = ("UNKNOWN_SEVERITY", "INFO", "WARNING", "SEVERE")
