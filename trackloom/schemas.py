"""The fixed schemas of the data model.

Missing text is the empty string, never null; numbers are never null once a
row has been typed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the raw message, in message order.
RAW_FIELDS = [
    "lat",
    "lon",
    "ts",
    "dev_id",
    "speed",
    "alt",
    "signal",
    "sats",
    "status",
    "in_depot",
    "veh_id",
    "formatted_ts",
]

# Raw fields a row must carry, in the order they are checked.
REQUIRED_FIELDS = ["lat", "lon", "ts", "veh_id"]

# Engine column -> field name in the output message, in message order.
OUTPUT_NAMES = {
    "latitude": "Latitude",
    "longitude": "Longitude",
    "speed": "Speed",
    "altitude": "Altitude",
    "signal": "Signal",
    "satellites": "Satellites",
    "timestamp": "Timestamp",
    "device_id": "DeviceID",
    "vehicle_id": "VehicleID",
    "status": "Status",
    "in_depot": "InDepot",
    "formatted_ts": "FormattedTS",
}

# Exported CSV column -> field name in the output message, in CSV order.
EXPORT_COLUMNS = {
    "timestamp": "Timestamp",
    "formatted_timestamp": "FormattedTS",
    "latitude": "Latitude",
    "longitude": "Longitude",
    "speed": "Speed",
    "altitude": "Altitude",
    "signal": "Signal",
    "satellites": "Satellites",
    "device_id": "DeviceID",
    "vehicle_id": "VehicleID",
    "status": "Status",
    "in_depot": "InDepot",
}

FIX_COLUMNS = list(OUTPUT_NAMES)

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

PROCESSED = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("altitude", T.DoubleType()),
        T.StructField("signal", T.LongType()),
        T.StructField("satellites", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("in_depot", T.StringType()),
        T.StructField("formatted_ts", T.StringType()),
    ]
)

# One row per straight road segment; x is longitude, y is latitude.
ROADS = T.StructType(
    [
        T.StructField("seg_id", T.LongType()),
        T.StructField("x1", T.DoubleType()),
        T.StructField("y1", T.DoubleType()),
        T.StructField("x2", T.DoubleType()),
        T.StructField("y2", T.DoubleType()),
    ]
)

# Route geometry per start and end; the four keys are micro-degrees.
ROUTES = T.StructType(
    [
        T.StructField("o_lon", T.LongType()),
        T.StructField("o_lat", T.LongType()),
        T.StructField("d_lon", T.LongType()),
        T.StructField("d_lat", T.LongType()),
        T.StructField(
            "coordinates",
            T.ArrayType(
                T.StructType(
                    [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())]
                )
            ),
        ),
    ]
)

OFFSETS = T.StructType(
    [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]
)
