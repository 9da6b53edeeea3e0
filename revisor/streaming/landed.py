"""Incremental ingestion of landed page files with Structured Streaming.

The original job is a scheduled batch; this driver runs the same batch plan
(``plans.job.run_pages``) once per micro-batch of newly landed files, so a
landing folder can be drained incrementally with exactly-once file tracking
kept in the stream's checkpoint.

* Source: the file source with the declared page schema (never inferred).
  The pages of one fetch must land in one file, so that a fetch never
  straddles two micro-batches.  A micro-batch that holds later pages of a
  fetch without its first page raises before anything is written.
* Trigger: ``availableNow`` by default — drain what is there, then stop —
  which is how a scheduled run uses it; a processing-time trigger works too.
* Sink: ``foreachBatch``.  Review rows of a micro-batch go to their own
  ``load_id=<stream id>-<epoch>`` partitions (below ``odate``) with dynamic
  overwrite.  The stream's id lives in its checkpoint, so a replayed epoch
  rewrites exactly its own partitions, and neither two epochs nor a second
  stream with a new checkpoint ever replace each other's; metrics go to a
  folder of the same name.
* Duplicates are looked for within a micro-batch, as the original job looks
  within one run.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revisor.schemas import CORRUPT_COLUMN, LANDED_SCHEMA, PAGE_SCHEMA
from revisor.sources.pages import fetch_keys


def _headless(pages: DataFrame) -> int:
    """Number of fetches in the batch that have pages but not their first one."""
    first = pages.where(F.col("page_no") >= 0).groupBy(*fetch_keys(pages)).agg(F.min("page_no").alias("first"))
    return first.where("first > 0").count()


def start_landed_stream(
    spark: SparkSession,
    landing_dir: str,
    out_base: str,
    checkpoint_location: str,
    *,
    odate: str,
    max_pages: int | None = None,
    fmt: str = "json",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    from revisor.plans.job import run_pages

    reader = spark.readStream.schema(LANDED_SCHEMA).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    token = F.coalesce("next_page_token", "serpapi_pagination.next_page_token")
    pages = reader.load(landing_dir).select(
        *[c for c in PAGE_SCHEMA.fieldNames() if c != "next_page_token"], token.alias("next_page_token"), CORRUPT_COLUMN)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        stream_id = session.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        load = f"{stream_id[:8]}-{epoch_id}"
        headless = _headless(batch)
        if headless:
            raise ValueError(f"{headless} fetches of this micro-batch lack their first page: land a fetch in one file")
        run_pages(session, batch, out_base, max_pages=max_pages, odate=odate,
                  metrics_base=os.path.join(out_base, "metrics", f"load={load}"), load_id=load)

    writer = pages.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    if processing_time and not available_now:
        writer = writer.trigger(processingTime=processing_time)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()
