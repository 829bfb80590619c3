"""Table scans: Parquet folders and JDBC. Filters and column choice reach the source by themselves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentloom import fixed_values as fixed


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    options: Mapping[str, str] | None = None,
    split_on: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """Database table; `split_on` = (column, lowest, highest, parts) reads in parallel."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.options(**(options or {}))
    if split_on:
        column, low, high, parts = split_on
        reader = reader.options(
            partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=parts)
    return reader.load()


def jdbc_query(
    spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Result of a query that the database runs."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    return reader.options(**(options or {})).load()


def apartments_scan(geocoded: DataFrame) -> DataFrame:
    """Recent rows of one source in the metros; all three conditions can be pushed down."""
    return geocoded.where(
        (F.col("source") == fixed.SOURCE_APARTMENTS)
        & (F.col("listing_date") >= F.lit(fixed.FIRST_LISTING_DATE).cast("date"))
        & F.col("cbsafp").isin(*fixed.METROS)
    )


def site_scan(extra_markets: DataFrame, website: str) -> DataFrame:
    return extra_markets.where(F.col("website") == website)


def distinct_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows of some columns, such as metro codes and names."""
    return df.select(*columns).distinct()
