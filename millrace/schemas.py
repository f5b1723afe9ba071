"""Declared record schemas. Nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_str, _int, _long, _double = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

VEHICLE_EVENT = _struct(
    vin=_str, timestamp=_long, sensorData=T.MapType(_str, _long), warningLights=T.ArrayType(_str)
)
VEHICLE_AGG = _struct(
    vin=_str, timestamp=_long, averageSensorData=T.MapType(_str, _long), countDistinctWarnings=_int
)
USER_MESSAGE = _struct(user=_str, message=_str, ts=T.TimestampNTZType())

# The supplied event table, declared for streaming reads of its files.
EVENTS = _struct(event_id=_long, ts=T.TimestampNTZType(), user_id=_long, event_type=_str, value=_double, props=_str)
PROPS = _struct(k=_long)
