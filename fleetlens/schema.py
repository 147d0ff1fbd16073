"""Declared schemas of the input tables.

Declaring them keeps partition values as strings (inference would turn
``hour=05`` into the number 5) and avoids a footer-reading job per read.
"""

from __future__ import annotations

from pyspark.sql import types as T

CONNECT_DATA = T.StructType(
    [
        T.StructField("station_mac", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("connect_type", T.StringType()),
        T.StructField("signal_strength", T.DoubleType()),
        T.StructField("snr", T.DoubleType()),
        T.StructField("link_rate", T.StringType()),
        T.StructField("tx_link_rate", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("bs", T.LongType()),
        T.StructField("br", T.LongType()),
    ]
)

STATION_HISTORY = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("Tplg_Data_model_name", T.StringType()),
        T.StructField("station_data_connect_data", CONNECT_DATA),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.StringType()),
    ]
)

RADIO = T.StructType(
    [
        T.StructField(
            "_2_4g",
            T.StructType(
                [
                    T.StructField("enable", T.StringType()),
                    T.StructField("airtime_util", T.StringType()),
                ]
            ),
        )
    ]
)

DEVICE_GROUPS = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("group_diag_history_radio_wifi_info", T.ArrayType(RADIO)),
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.StringType()),
    ]
)

DATASET_REGISTRY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("expect_delay", T.IntegerType()),
        T.StructField("calendar", T.StringType()),
    ]
)
