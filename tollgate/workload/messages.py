"""The driver tables as messages.

Payload texts are built by SQL both engines understand, so that a check can compute the same
bytes. ``{...}`` marks what the dialects spell differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import configure

SPARK = {
    "text": "STRING",
    "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
}
DUCKDB = {
    "text": "VARCHAR",
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
}

# Region by latitude, in hundredths of a degree above 40.
_REGION = (
    "CASE WHEN 70 + event_id % 15 > 80 THEN 'north' "
    "WHEN 70 + event_id % 15 > 75 THEN 'midtown' ELSE 'downtown' END"
)

# Faults by event_id % 97, first the ones that change a member and then the whole payload:
# 3 and 4 passenger_count absent and null, 5 point_idx is text, 6 and 11 timestamp is no time and
# empty, 7 timestamp is a number, 10 an unknown member, 12 region is a number,
# 1 cut short, 2 trailing text, 8 an array. 9 puts a byte that is not UTF-8 in front.
_POINT_IDX = "CASE WHEN {fault} = 5 THEN '\"NOT_AN_INT\"' ELSE CAST(event_id AS {text}) END"
_TIMESTAMP = (
    "CASE WHEN {fault} = 6 THEN '\"bad\"' WHEN {fault} = 7 THEN '5' WHEN {fault} = 11 THEN '\"\"' "
    "ELSE '\"' || {iso} || '-05:00\"' END"
)
_PASSENGERS = (
    "CASE WHEN {fault} = 3 THEN '' WHEN {fault} = 4 THEN ',\"passenger_count\":null' "
    "ELSE ',\"passenger_count\":' || CAST(user_id % 6 AS {text}) END"
)
_EXTRA = "CASE WHEN {fault} = 10 THEN ',\"unexpected_field\":{{\"a\":[1,2]}}' ELSE '' END"
_ENRICHMENT = (
    "CASE WHEN {enriched} THEN ',\"enrichment_timestamp\":\"' || {iso} || 'Z\"' ELSE '' END || "
    "CASE WHEN {fault} = 12 THEN ',\"region\":5' WHEN {enriched} THEN ',\"region\":\"' || " + _REGION + " || '\"' "
    "ELSE '' END"
)
_OBJECT = (
    "'{{\"ride_id\":\"ride-' || CAST(user_id AS {text}) || '\",\"point_idx\":' || " + _POINT_IDX + " || "
    "',\"latitude\":40.' || CAST(70 + event_id % 15 AS {text}) || "
    "',\"longitude\":-' || {longitude} || "
    "',\"timestamp\":' || " + _TIMESTAMP + " || "
    "',\"meter_reading\":' || CAST(CAST(value AS DECIMAL(18,4)) AS {text}) || "
    "',\"meter_increment\":0.' || lpad(CAST(event_id % 7 * 625 AS {text}), 4, '0') || "
    "',\"ride_status\":\"' || event_type || '\"' || " + _PASSENGERS + " || " + _EXTRA + " || " + _ENRICHMENT + " || '}}'"
)
_LONGITUDE = (
    "CASE WHEN event_id % 20 <= 5 THEN '74.0' || CAST(5 - event_id % 20 AS {text}) "
    "ELSE '73.' || CAST(105 - event_id % 20 AS {text}) END"
)
_PAYLOAD = (
    "CASE WHEN {fault} = 1 THEN substring({object}, 1, 20) WHEN {fault} = 2 THEN {object} || ' xyz' "
    "WHEN {fault} = 8 THEN '[1,2]' ELSE {object} END"
)

# Which events carry the second revision's members.
ODD, ALL, NONE = "event_id % 2 = 1", "TRUE", "FALSE"


def payload_sql(
    dialect: dict, faults: bool = True, enriched: str = ODD, column: str | None = None
) -> tuple[str, str]:
    """SQL texts of an event's JSON object, and of its payload before the byte of fault 9.

    The payload refers to the object by the name ``column``, or repeats its text.
    """
    names = {
        **dialect,
        "fault": "event_id % 97" if faults else "0",
        "enriched": enriched,
        "longitude": _LONGITUDE.format(**dialect),
    }
    json_object = _OBJECT.format(**names)
    return json_object, _PAYLOAD.format(object=column or json_object, **names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a table dealt to all cores by a key.

    Stored rows are a small part of the messages made of them, so a file of many has few splits, or a single row group.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, rows.rdd.getNumPartitions()), key)


def events_as_messages(
    spark: SparkSession, sf_dir: str, faults: bool = True, enriched: str = ODD
) -> DataFrame:
    """Every event as one ride message."""
    json_object, payload = payload_sql(SPARK, faults, enriched, "_object")
    data = F.expr(payload).cast("binary")
    if faults:
        bad_byte = F.concat(F.lit(bytearray(b"\xff")), data)
        data = F.when(F.expr("event_id % 97 = 9"), bad_byte).otherwise(data)
    attributes = F.when(
        F.expr("event_id % 10 = 0"), F.create_map().cast("map<string,string>")
    ).otherwise(F.create_map(F.lit("source"), F.col("event_type")))
    publish_time = F.when(F.expr("event_id % 101 <> 0"), F.col("ts").cast("timestamp"))
    events = spread(table(spark, sf_dir, "events"), "event_id")
    return events.selectExpr("*", f"{json_object} AS _object").select(
        data.alias("data"),
        attributes.alias("attributes"),
        F.col("event_id").cast("string").alias("message_id"),
        publish_time.alias("publish_time"),
    )


def as_messages(df: DataFrame, payload: Column, message_id: Column) -> DataFrame:
    """Rows of any table as messages without attributes."""
    return df.select(
        payload.cast("binary").alias("data"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        message_id.cast("string").alias("message_id"),
        F.lit(None).cast("timestamp").alias("publish_time"),
    )


def lineitem_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem as one ride message: the high-volume input of the bench."""
    iso = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    payload = F.to_json(
        F.struct(
            F.concat(F.lit("ride-"), F.col("l_orderkey").cast("string")).alias("ride_id"),
            F.col("l_partkey").alias("point_idx"),
            (40.7 + F.col("l_quantity") / 300).alias("latitude"),
            (F.col("l_discount") - 74).alias("longitude"),
            F.concat(iso, F.lit("-05:00")).alias("timestamp"),
            F.col("l_extendedprice").alias("meter_reading"),
            F.col("l_tax").alias("meter_increment"),
            F.col("l_returnflag").alias("ride_status"),
            F.col("l_linenumber").alias("passenger_count"),
        )
    )
    return table(spark, sf_dir, "lineitem").select(
        payload.cast("binary").alias("data"),
        F.create_map(F.lit("source"), F.col("l_linestatus")).alias("attributes"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("message_id"),
        F.col("l_shipdate").cast("timestamp").alias("publish_time"),
    )
