"""Review and page frames derived from the benchmark tables.

The benchmark tables hold no reviews, so two derived frames stand in for the
landed data:

* ``reviews_from_lineitem`` – one review per ``lineitem`` row with NULLs,
  repeated ids, replies and bad ratings placed by fixed arithmetic rules, the
  app taken from ``l_returnflag`` and the client segment from
  ``l_linestatus``;
* ``pages_from_conversations`` – one landed API page per conversation turn;
  each line of the turn's text is one review.

Both are plain projections (no shuffle) of whole tables; every row of the
source table yields output.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _mod(c: str, m: int) -> Column:
    return F.col(c) % m == 0


def reviews_from_lineitem(lineitem: DataFrame, hot_every: int | None = None) -> DataFrame:
    """``hot_every=k`` gives every row with ``l_orderkey % k == 0`` the same
    id (``r-hot``) — a hot key holding about 1/k of all rows — for skew runs;
    no row is dropped."""
    ship = F.col("l_shipdate").cast("date").cast("string")
    rating = (
        F.when(_mod("l_partkey", 53), F.lit(None).cast("string"))
        .when(_mod("l_partkey", 59), F.lit("bad"))
        .when(_mod("l_partkey", 61), F.lit("4.5"))
        .when(_mod("l_partkey", 67), F.lit("1e3"))
        .when(_mod("l_partkey", 71), F.lit("3000000000"))
        .otherwise((F.col("l_linenumber") % 5 + 1).cast("string"))
    )
    return lineitem.select(
        F.concat(F.lit("https://img.example/"), F.col("l_suppkey").cast("string")).alias("avatar"),
        F.when(_mod("l_partkey", 101), F.lit(None).cast("string")).otherwise(ship).alias("date"),
        _review_id(hot_every).alias("id"),
        F.concat(ship, F.lit("T00:00:00Z")).alias("iso_date"),
        F.col("l_quantity").cast("bigint").alias("likes"),
        rating.alias("rating"),
        F.when(
            _mod("l_suppkey", 3),
            F.create_map(F.lit("title"), F.col("l_returnflag"), F.lit("snippet"), F.col("l_linestatus")),
        ).alias("response"),
        F.when(_mod("l_partkey", 97), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("snippet "), F.col("l_partkey").cast("string")))
        .alias("snippet"),
        F.concat(F.lit("user "), F.col("l_suppkey").cast("string")).alias("title"),
        F.concat(F.lit("app_"), F.col("l_returnflag")).alias("app"),
        F.when(F.col("l_linestatus") == "O", F.lit("pf")).otherwise(F.lit("pj")).alias("type_client"),
    )


def _review_id(hot_every: int | None) -> Column:
    rid = F.when(_mod("l_orderkey", 89), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("r"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("string"))
    )
    if hot_every:
        rid = F.when(_mod("l_orderkey", hot_every), F.lit("r-hot")).otherwise(rid)
    return rid


def reviews(spark: SparkSession, sf_dir: str, hot_every: int | None = None) -> DataFrame:
    return reviews_from_lineitem(table(spark, sf_dir, "lineitem"), hot_every)


def raw_pages_from_conversations(conversations: DataFrame) -> DataFrame:
    """Flat landed pages: (product_id, page_no, request_ok, review_text,
    next_page_token).  ``review_text`` NULL means the page had no reviews."""
    key = F.col("conv_id")
    turn = F.col("turn")
    return conversations.select(
        key.alias("product_id"),
        turn.alias("page_no"),
        ((key * 7 + turn) % 23 != 0).alias("request_ok"),
        F.when((key * 5 + turn) % 29 != 0, F.col("text")).alias("review_text"),
        F.when((key + turn) % 6 != 5, F.concat(F.lit("tok"), turn.cast("string"))).alias("next_page_token"),
    )


def pages_from_conversations(conversations: DataFrame) -> DataFrame:
    """Landed pages in the page schema shape: ``reviews`` is an array of
    review structs, one per line of the turn's text, NULL when the page has
    no reviews.  Products are grouped into apps by ``conv_id % 4``."""
    flat = raw_pages_from_conversations(conversations)
    line_reviews = F.transform(
        F.split(F.col("review_text"), "\n"),
        lambda line, i: F.struct(
            F.lit(None).cast("string").alias("avatar"),
            F.lit(None).cast("string").alias("date"),
            F.concat_ws("-", F.col("product_id").cast("string"), F.col("page_no").cast("string"), i.cast("string")).alias("id"),
            F.lit(None).cast("string").alias("iso_date"),
            F.length(line).cast("bigint").alias("likes"),
            (F.length(line) % 5 + 1).cast("string").alias("rating"),
            F.lit(None).cast("map<string,string>").alias("response"),
            line.alias("snippet"),
            F.lit(None).cast("string").alias("title"),
        ),
    )
    return flat.select(
        F.concat(F.lit("app_"), (F.col("product_id") % 4).cast("string")).alias("app"),
        F.lit("pf").alias("type_client"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("page_no").cast("int").alias("page_no"),
        F.col("request_ok"),
        F.when(F.col("review_text").isNotNull(), line_reviews).alias("reviews"),
        F.col("next_page_token"),
    )


def requests_from_customers(customer: DataFrame) -> DataFrame:
    """Requested fetches: one for every customer, named as the pages are; a
    fiftieth names no app.  Apps ``app_4`` and ``app_5`` land no pages."""
    key = F.col("c_custkey")
    return customer.select(
        F.when(key % 50 != 0, F.concat(F.lit("app_"), (key % 6).cast("string"))).alias("app"),
        F.lit("pf").alias("type_client"),
        F.when(key % 6 < 4, key - key % 4 + key % 6).otherwise(key).cast("string").alias("product_id"),
    )
