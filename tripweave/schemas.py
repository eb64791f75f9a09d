"""Declared schemas. Nothing in the engine infers a type from data."""

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LONG, INT, DBL, STR = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

PING = _s(
    ("seq", LONG), ("vehicle_id", LONG), ("service_date", T.DateType()),
    ("sec_of_day", LONG), ("lng", DBL), ("lat", DBL), ("open_status", INT), ("speed", DBL),
)
LIVE_PING = _s(
    ("seq", LONG), ("vehicle_id", LONG), ("ts", T.TimestampType()),
    ("lng", DBL), ("lat", DBL), ("open_status", INT), ("speed", DBL),
)
TRIP = _s(
    ("trip_id", LONG), ("vehicle_id", LONG), ("service_date", T.DateType()),
    ("s_sec", LONG), ("s_lng", DBL), ("s_lat", DBL),
    ("e_sec", LONG), ("e_lng", DBL), ("e_lat", DBL),
    ("duration_s", LONG), ("duration_min", DBL), ("distance_km", DBL),
    ("avg_speed", DBL), ("hour", INT),
)

# result tables, fixed values: name -> (schema, natural key)
RESULT_TABLES = {
    "od_trips": (
        _s(("VehicleNum", LONG), ("Stime", STR), ("SLng", DBL), ("SLat", DBL), ("ELng", DBL),
           ("ELat", DBL), ("Etime", STR), ("duration_min", DBL), ("distance_km", DBL),
           ("avg_speed", DBL), ("trip_id", LONG)),
        ("VehicleNum", "Stime", "trip_id"),
    ),
    "hourly_stats": (
        _s(("hour", INT), ("trip_count", LONG), ("avg_duration", DBL), ("median_duration", DBL),
           ("avg_distance", DBL), ("unique_vehicles", LONG)),
        ("hour",),
    ),
    "period_stats": (
        _s(("period_name", STR), ("time_range", STR), ("trip_count", LONG), ("ratio_pct", DBL),
           ("avg_duration", DBL), ("avg_distance", DBL), ("active_vehicles", LONG)),
        ("period_name",),
    ),
    "hotspots": (
        _s(("point_type", STR), ("cluster_id", INT), ("center_lng", DBL), ("center_lat", DBL),
           ("trip_count", LONG), ("radius_m", DBL), ("radius_true_m", DBL)),
        ("point_type", "cluster_id"),
    ),
    "vehicle_efficiency": (
        _s(("VehicleNum", LONG), ("trip_count", LONG), ("total_duration", DBL),
           ("total_distance", DBL), ("avg_duration", DBL), ("avg_distance", DBL),
           ("first_trip", STR), ("last_trip", STR)),
        ("VehicleNum",),
    ),
    "net_flow": (
        _s(("grid_id", LONG), ("lng", DBL), ("lat", DBL), ("outflow", LONG), ("inflow", LONG),
           ("net_flow", LONG)),
        ("grid_id",),
    ),
    "realtime_stats": (
        _s(("stat_type", STR), ("stat_key", STR), ("stat_value", DBL), ("extra_info", STR),
           ("updated_at", T.TimestampType())),
        ("stat_type", "stat_key"),
    ),
}
