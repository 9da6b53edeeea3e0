"""Declared schemas.  Nothing in the engine infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Bronze review row: column names, order and types are fixed values that the
# written Parquet must carry.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("avatar", T.StringType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("id", T.StringType(), True),
        T.StructField("iso_date", T.StringType(), True),
        T.StructField("likes", T.LongType(), True),
        T.StructField("rating", T.DoubleType(), True),
        T.StructField("response", T.MapType(T.StringType(), T.StringType(), True), True),
        T.StructField("snippet", T.StringType(), True),
        T.StructField("title", T.StringType(), True),
    ]
)

REVIEW_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# Columns whose NULLs the null check reports, in report order.
CRITICAL_COLUMNS = ["id", "snippet", "rating", "date"]

# Columns that must be present for a row to be valid.
REQUIRED_COLUMNS = ["id", "snippet", "rating"]

# Default grouping of a multi-app batch.
GROUP_COLUMNS = ["app", "type_client"]

# A review as landed in a raw page: ``rating`` stays text so that a
# non-numeric value reaches the type check instead of turning into NULL at
# read time.
RAW_REVIEW_SCHEMA = T.StructType(
    [f if f.name != "rating" else T.StructField("rating", T.StringType(), True) for f in BRONZE_SCHEMA.fields]
)

# One page of a fetch.  ``fetch_id`` names the fetch run that landed it (NULL
# where a landing folder holds one fetch per product).
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("app", T.StringType(), True),
        T.StructField("type_client", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("page_no", T.IntegerType(), True),
        T.StructField("request_ok", T.BooleanType(), True),
        T.StructField("reviews", T.ArrayType(RAW_REVIEW_SCHEMA, True), True),
        T.StructField("next_page_token", T.StringType(), True),
        T.StructField("fetch_id", T.StringType(), True),
    ]
)

# One requested fetch, landed or not.
REQUEST_SCHEMA = T.StructType([f for f in PAGE_SCHEMA.fields if f.name in ("app", "type_client", "product_id")])

# A page as landed: the response's own paging object may hold the token, and a
# line that is not a page keeps its text.
CORRUPT_COLUMN = "corrupt_line"
LANDED_SCHEMA = T.StructType(
    [
        *PAGE_SCHEMA.fields,
        T.StructField("serpapi_pagination", T.StructType([T.StructField("next_page_token", T.StringType(), True)]), True),
        T.StructField(CORRUPT_COLUMN, T.StringType(), True),
    ]
)

# What the batch writes: the bronze columns and the rating as it came.
RAW_RATING = "rating_raw"
WRITTEN_SCHEMA = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(RAW_RATING, T.StringType(), True)])
