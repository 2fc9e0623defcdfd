"""Fixed record schemas. Text is parsed by position; nothing is inferred."""

from pyspark.sql import types as T

RIDE = T.StructType(
    [
        T.StructField("ride_id", T.LongType()),
        T.StructField("is_start", T.BooleanType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("start_lon", T.FloatType()),
        T.StructField("start_lat", T.FloatType()),
        T.StructField("end_lon", T.FloatType()),
        T.StructField("end_lat", T.FloatType()),
        T.StructField("passenger_cnt", T.ShortType()),
        T.StructField("taxi_id", T.LongType()),
        T.StructField("driver_id", T.LongType()),
    ]
)

FARE = T.StructType(
    [
        T.StructField("ride_id", T.LongType()),
        T.StructField("taxi_id", T.LongType()),
        T.StructField("driver_id", T.LongType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("tip", T.FloatType()),
        T.StructField("tolls", T.FloatType()),
        T.StructField("total_fare", T.FloatType()),
    ]
)

CAR = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("car_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("consumption", T.FloatType()),
        T.StructField("speed", T.FloatType()),
        T.StructField("throttle", T.FloatType()),
        T.StructField("engineload", T.FloatType()),
    ]
)

MAIL = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("message_id", "time", "sender", "subject", "body", "reply_to")
    ]
)

KEYED_TUPLE = T.StructType(
    [
        T.StructField("source_id", T.StringType()),
        T.StructField("tuple_id", T.LongType()),
        T.StructField("value", T.LongType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)

#: columns of the window join's output, in order
JOINED_TUPLE = ("l_source_id", "l_tuple_id", "l_value", "r_source_id", "r_tuple_id", "r_value")
