"""SQL over the ingested tables. Each report takes a DataFrame and returns one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import configure

# The payload is parsed once, by the one-element LATERAL VIEW; see ``jsonx.once``. A scalar
# member is taken as text, as JSON_VALUE does. ``{cast}`` is CAST, which fails at text that the raw
# path keeps but the column cannot hold, or TRY_CAST, which makes it NULL.
_TYPED_VIEW = """
SELECT
  subscription_name, message_id, publish_time, processing_time,{day}
  {ride_id} AS ride_id,
  {cast}({point_idx} AS BIGINT) AS point_idx,
  {cast}({latitude} AS DOUBLE) AS latitude,
  {cast}({longitude} AS DOUBLE) AS longitude,
  {cast}({timestamp} AS TIMESTAMP) AS timestamp,
  {cast}({meter_reading} AS DOUBLE) AS meter_reading,
  {cast}({meter_increment} AS DOUBLE) AS meter_increment,
  {ride_status} AS ride_status,
  {cast}({passenger_count} AS BIGINT) AS passenger_count
FROM {source}
LATERAL VIEW explode(array(try_cast(try_parse_json(payload) AS STRUCT<
  ride_id: VARIANT, point_idx: VARIANT, latitude: VARIANT, longitude: VARIANT,
  timestamp: VARIANT, meter_reading: VARIANT, meter_increment: VARIANT,
  ride_status: VARIANT, passenger_count: VARIANT>))) parsed AS cells
"""

_MEMBERS = (
    "ride_id point_idx latitude longitude timestamp meter_reading meter_increment ride_status passenger_count"
).split()


def json_value(variant: str) -> str:
    """SQL text of a variant as JSON_VALUE gives it: text of a scalar, NULL of anything else."""
    return (
        f"(CASE WHEN schema_of_variant({variant}) NOT LIKE 'OBJECT%' "
        f"AND schema_of_variant({variant}) NOT LIKE 'ARRAY%' THEN CAST({variant} AS STRING) END)"
    )


def typed_view_sql(source: str, safe: bool = False, day: bool = False) -> str:
    """The view's query; ``day`` adds ``publish_date``, by which a table's partitions are pruned."""
    values = {name: json_value(f"cells.{name}") for name in _MEMBERS}
    cast = "TRY_CAST" if safe else "CAST"
    return _TYPED_VIEW.format(source=source, cast=cast, day=" publish_date," if day else "", **values)


def typed_view(raw: DataFrame, safe: bool = False) -> DataFrame:
    """Typed columns over the raw table's payload. With ``safe`` an unreadable member is NULL, else an error."""
    day = "publish_date" in raw.columns
    return configure(raw.sparkSession).sql(typed_view_sql("{raw}", safe, day), raw=raw)


def create_typed_view(spark: SparkSession, view: str, raw_table: str, safe: bool = False) -> None:
    query = typed_view_sql(raw_table, safe, day=True)
    configure(spark).sql(f"CREATE OR REPLACE VIEW {view} AS {query}")


def materialize_typed_view(spark: SparkSession, table: str, raw_table: str, safe: bool = False) -> None:
    """A new table with the typed columns of the raw table as it is now, partitioned by day."""
    query = typed_view_sql(raw_table, safe, day=True)
    configure(spark).sql(f"CREATE TABLE {table} USING parquet PARTITIONED BY (publish_date) AS {query}")


def json_query(df: DataFrame, column: str, path: str, name: str) -> DataFrame:
    """Add the object or array at a path as JSON text; NULL if there is none.

    A scalar is no document, whatever its text looks like: the kind of the value decides.
    """
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(column), path, "variant"))
    is_document = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    return df.withColumn(name, F.when(is_document, F.get_json_object(column, path)))


def _report(sql: str, table: DataFrame) -> DataFrame:
    return table.sparkSession.sql(sql, t=table)


# Names of the two kinds of traffic, column names, and numbers of rows shown.
KINDS, SHORT_KINDS = ("v2 (enriched)", "v1 (plain)"), ("v2", "v1")
MINUTES, SAMPLE = 15, 20


def _is_enriched() -> Column:
    return F.col("enrichment_timestamp").isNotNull()


def _kind(names: tuple[str, str]) -> Column:
    return F.when(_is_enriched(), names[0]).otherwise(names[1])


def mixed_overview(table: DataFrame) -> DataFrame:
    """Messages, rides, and first and last message of enriched and plain traffic."""
    return table.groupBy(_kind(KINDS).alias("schema_version")).agg(
        F.count("*").alias("message_count"),
        F.count_distinct("ride_id").alias("unique_rides"),
        F.min("publish_time").alias("first_seen"),
        F.max("publish_time").alias("last_seen"),
    )


def mixed_overview_short(table: DataFrame) -> DataFrame:
    return mixed_overview(table).drop("first_seen", "last_seen")


def minute_counts() -> list[Column]:
    """Aggregates of a minute: enriched, plain and all messages."""
    return [
        F.count_if(_is_enriched()).alias("v2_count"),
        F.count_if(~_is_enriched()).alias("v1_count"),
        F.count("*").alias("total"),
    ]


def minute_timeline(table: DataFrame) -> DataFrame:
    """Enriched, plain and all messages of the latest minutes that have any."""
    minutes = table.groupBy(F.date_trunc("minute", "publish_time").alias("minute")).agg(*minute_counts())
    return minutes.orderBy(F.desc("minute")).limit(MINUTES)


def minute_timeline_short(table: DataFrame) -> DataFrame:
    return minute_timeline(table).drop("total")


def sample_v1_v2(table: DataFrame) -> DataFrame:
    """The latest rows; equal times are ordered by message id."""
    shown = "ride_id ride_status latitude enrichment_timestamp region publish_time message_id".split()
    latest = table.orderBy(F.desc("publish_time"), F.desc("message_id")).limit(SAMPLE)
    return latest.select(_kind(SHORT_KINDS).alias("version"), *shown)


def region_distribution(table: DataFrame) -> DataFrame:
    """Enriched messages per region, most frequent first."""
    regions = table.where(_is_enriched()).groupBy("region").agg(F.count("*").alias("count"))
    return regions.orderBy(F.desc("count"))


def pipeline_lag(table: DataFrame) -> DataFrame:
    """Seconds between publishing and processing, per minute of publishing."""
    return _report(
        """
        SELECT
          date_trunc('MINUTE', publish_time) AS minute,
          avg(lag_micros) / 1000000 AS avg_lag_seconds,
          max(lag_micros) / 1000000 AS max_lag_seconds,
          percentile_approx(lag_micros, 0.95) / 1000000 AS p95_lag_seconds
        FROM (
          SELECT publish_time, timestampdiff(MICROSECOND, publish_time, processing_time) AS lag_micros
          FROM {t}
        ) GROUP BY minute
        """,
        table,
    )


def throughput_per_second(table: DataFrame) -> DataFrame:
    """Messages published in each second."""
    return _report(
        "SELECT date_trunc('SECOND', publish_time) AS second, count(*) AS n FROM {t} GROUP BY second",
        table,
    )
