"""Explicit schemas of the logical tables.

Parsing always uses one of these: no per-batch schema inference, so columns
and types do not drift between batches, and a missing field is a null that
the required-field filter (P1) removes.
"""

from pyspark.sql import types as T

CORRUPT = "_corrupt"

CLIENT_LOG = T.StructType([
    T.StructField("t", T.LongType()),
    T.StructField("_id", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("appId", T.LongType()),
    T.StructField("action_name", T.StringType()),
    T.StructField("e_a", T.StringType()),
    T.StructField("e_c", T.StringType()),
    T.StructField("e_n", T.StringType()),
    T.StructField("e_v", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("res", T.StringType()),
    T.StructField("u_a", T.StringType()),
    T.StructField("url", T.StringType()),
])

SERVER_LOG = T.StructType([
    T.StructField("actionType", T.StringType()),
    T.StructField("purchaseNumber", T.StringType()),
    T.StructField("purchaseId", T.LongType()),
    T.StructField("studentId", T.LongType()),
    T.StructField("studentName", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("mobile", T.StringType()),
    T.StructField("totalPrice", T.LongType()),
    T.StructField("payChannel", T.LongType()),
    T.StructField("payTime", T.LongType()),
    T.StructField("money", T.LongType()),
    T.StructField("purchaseMoney", T.LongType()),
    T.StructField("status", T.LongType()),
    T.StructField("verifyTime", T.LongType()),
    T.StructField("updateTime", T.LongType()),
    T.StructField("classId", T.LongType()),
    T.StructField("purchaseClassIds", T.ArrayType(T.LongType())),
    T.StructField("purchaseClassNames", T.ArrayType(T.StringType())),
])

GEO_RANGE = T.StructType([
    T.StructField("start_ip", T.LongType()),
    T.StructField("end_ip", T.LongType()),
    T.StructField("country", T.StringType()),
    T.StructField("local_city", T.StringType()),
])

# Sessions datapoint table written by the session job (A17 input, BI input).
SESSIONS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("combined_id", T.StringType()),
    T.StructField("earliest_date", T.DateType()),
    T.StructField("session_length", T.LongType()),
    T.StructField("session_count", T.LongType()),
])

# Dimensions of the active-user table (A2), in output order.
BASIC_DIMS = ("app_id", "is_wechat", "resolution", "loc", "device", "os",
              "os_version", "language", "network", "browser")


def with_corrupt(schema: T.StructType, name: str = CORRUPT) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(name, T.StringType())])
