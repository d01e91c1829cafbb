"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, INT, TIME = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STOP_EVENT = struct(delay=INT, time=STRING, uncertainty=INT)
TRIP = struct(trip_id=STRING, route_id=STRING, schedule_relationship=STRING)
VEHICLE_NAME = struct(id=STRING, label=STRING)
STOP_UPDATE = struct(stop_sequence=INT, stop_id=STRING, arrival=STOP_EVENT, departure=STOP_EVENT, schedule_relationship=STRING)
#: A decoded feed entity. What the wire leaves out is NULL, never a protocol default.
ENTITY = struct(
    id=STRING,
    vehicle=struct(
        trip=TRIP,
        vehicle=VEHICLE_NAME,
        position=struct(latitude=DOUBLE, longitude=DOUBLE, bearing=DOUBLE, speed=DOUBLE),
        current_stop_sequence=INT,
        stop_id=STRING,
        current_status=STRING,
        timestamp=STRING,
    ),
    trip_update=struct(trip=TRIP, vehicle=VEHICLE_NAME, stop_time_update=T.ArrayType(STOP_UPDATE), timestamp=STRING, delay=INT),
)
LOCATION = struct(type=STRING, coordinates=T.ArrayType(DOUBLE))
TELEMETRY = struct(
    vehicle_id=STRING, trip_id=STRING, route_id=STRING, location=LOCATION, timestamp=TIME, bearing=DOUBLE, speed=DOUBLE, current_stop_sequence=INT, stop_id=STRING, current_status=STRING
)
MESSAGE = struct(agency_id=STRING, **{f.name: f.dataType for f in TELEMETRY}, ingested_at=TIME)
PING = struct(
    vehicle_id=STRING, trip_id=STRING, route_id=STRING, timestamp=TIME, current_status=STRING, stop_id=STRING, current_stop_sequence=INT, bearing=DOUBLE, speed=DOUBLE, lat=DOUBLE, lon=DOUBLE, ingested_at=TIME
)
#: Static schedule tables: ids and times are text, as hours may pass 24 and ids look like numbers.
STOPS = ("stop_id", "stop_name", "stop_lat", "stop_lon")
TRIPS = ("trip_id", "route_id", "direction_id")
STOP_TIMES = ("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time")
