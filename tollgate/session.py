"""Session settings that the parse expressions and the tables depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Read when a plan is analysed, so they must be set before a DataFrame is built.
REQUIRED_CONF = {
    # Timestamps without an offset are UTC, and so is every formatted one.
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in a JSON object keeps its last value instead of failing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # An INSERT OVERWRITE that names no partition replaces those it has rows for, not the table. A writer's
    # option for this does not reach a table of the catalog.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the required settings on a session; safe to call repeatedly."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
