"""Schemas of the files and messages the jobs exchange."""

from pyspark.sql import types as T

# Fixed names and types: vehicle histories, one row per vehicle, its points nested.
HISTORIES = T.StructType([
    T.StructField("uuid", T.StringType(), False),
    T.StructField("capabilities", T.StructType([
        T.StructField("current_location", T.ArrayType(T.StructType([
            T.StructField("date", T.StringType(), False),
            T.StructField("nodeID", T.DoubleType(), False),
            T.StructField("tick", T.StringType(), False),
        ]))),
    ])),
])

# Thresholds, in file order.
MODEL = "mad double, upper_threshold double, lower_threshold double, edgeId bigint"
MODEL_HEADER = "mad,upper_threshold,lower_threshold,edgeId"

# One row per vehicle after expansion; the uuid comes last.
TRIPS_CSV = ("name string, origin string, destination string, link_origin string, "
             "count int, start int, mode string, uuid string")

TRIP_LOG = ("hour int, minute int, last_tick bigint, type string, car_id string, "
            "last_link bigint, duration double, distance double")

# Resource catalog.
CATALOG = ("uuid string, description string, capabilities array<string>, status string, "
           "lat double, lon double")
