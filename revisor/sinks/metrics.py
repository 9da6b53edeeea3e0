"""Metrics sink (H4): metrics documents and failure records as JSON lines, one
folder per outcome (``success`` / ``fail``), replacing the search index of the
original job.  Readers use the declared schema of the document.

A batch writes under its run key, the load date and the load id, as partitions:
a rerun replaces its own records (``save_run_metrics``), so a group has one
document a run key however often the run is repeated; records of the same key
about other groups stay.  ``save_metrics`` appends or overwrites plainly.

The writer applies the document rules (G9) to the rows themselves before it
writes: a failure needs an error text, a success needs data, and a document
given as text must be JSON.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisor.operators.metrics import check_metrics_arguments, document_check
from revisor.session import file_system, release, stage_dir

DEFAULT_LOAD = "batch"


def rejected_documents(frame: DataFrame, metrics_type: str) -> DataFrame:
    """Rows the writer refuses, with the ``reason``."""
    if metrics_type == "fail":
        error = F.col("error")
        return frame.where(error.isNull() | (F.trim(error) == "")).withColumn("reason", F.lit("empty error"))
    if "document" in frame.columns and not isinstance(frame.schema["document"].dataType, T.StringType):
        return frame.where(F.col("document").isNull()).withColumn("reason", F.lit("empty data"))
    if "document" in frame.columns:
        kept = [c for c in frame.columns if c != "status"]
        checked = document_check(frame, "document", keep=kept).where("status != 'ok'")
        reason = F.when(F.col("status") == "empty", F.lit("empty data")).otherwise(F.lit("invalid JSON"))
        return checked.withColumn("reason", reason).drop("status")
    return frame.limit(0).withColumn("reason", F.lit(""))


def _checked(frame: DataFrame, metrics_type: str) -> str:
    """The outcome's name; raises if a rule is broken."""
    t = check_metrics_arguments(metrics_type, error="error" in frame.columns, data=frame)
    bad = rejected_documents(frame, t).select("reason").head(1)
    if bad:
        raise ValueError(f"a {t!r} record breaks the document rules: {bad[0]['reason']}")
    return t


def save_metrics(frame: DataFrame, base: str, metrics_type: str, mode: str = "append") -> str:
    """Write ``frame`` under ``<base>/<metrics_type>``.  A ``success`` frame
    holds a ``document`` column (a struct, or JSON text) or plain fields; a
    ``fail`` frame holds failure records with their ``error``.  Raises before
    anything is written if a rule is broken."""
    t = _checked(frame, metrics_type)
    if t == "success" and frame.isEmpty():
        raise ValueError("a 'success' record needs data")
    target = os.path.join(base, t)
    if "document" not in frame.columns:
        frame.write.mode(mode).json(target)
    elif isinstance(frame.schema["document"].dataType, T.StringType):
        frame.select(F.col("document").alias("value")).write.mode(mode).text(target)
    else:
        frame.select("document.*").write.mode(mode).json(target)
    return target


def run_folder(base: str, kind: str, odate: str, load_id: str | None = None) -> str:
    """Where the records of one run key lie."""
    return os.path.join(base, kind, f"odate={odate}", f"load_id={load_id or DEFAULT_LOAD}")


def save_run_metrics(frame: DataFrame, base: str, kind: str, *, odate: str, load_id: str | None, covers: DataFrame,
                     about: dict[str, str], stays: Column | None = None) -> str:
    """Replace the records of a run key that are about what the run ``covers``; the folder they lie in.

    ``frame`` holds plain fields or a ``document`` struct.  ``covers`` has one row
    for each thing (an app and client) the run looked at, and ``about`` maps a
    record's field to its column there; a NULL is a value like any other.  Older
    records about other things stay, as do those that ``stays`` marks.  The
    union is staged before the folder is replaced, in one dynamic partition
    overwrite, so a retry of any step gives the same records.
    """
    spark = frame.sparkSession
    if kind in ("success", "fail"):
        _checked(frame, kind)
    rows = frame.select("document.*") if "document" in frame.columns else frame
    folder = run_folder(base, kind, odate, load_id)
    if file_system(spark, folder).exists(spark._jvm.org.apache.hadoop.fs.Path(folder)):
        old = spark.read.schema(rows.schema).json(folder)
        seen = covers.select(*[F.col(c).alias("_c_" + c) for c in about.values()]).distinct()
        same = F.lit(True)
        for record_field, c in about.items():
            same = same & F.col(record_field).eqNullSafe(F.col("_c_" + c))
        if stays is not None:
            same = same & ~stays
        rows = rows.unionByName(old.join(seen, same, "left_anti"))
    staged = stage_dir(spark, f"metrics-{kind}")
    rows.write.parquet(staged)
    whole = spark.read.schema(rows.schema).parquet(staged)
    if whole.isEmpty():
        release(spark, folder)
    else:
        keyed = whole.withColumn("odate", F.lit(odate)).withColumn("load_id", F.lit(load_id or DEFAULT_LOAD))
        (keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("odate", "load_id")
         .json(os.path.join(base, kind)))
    release(spark, staged)
    return folder


def read_metrics(spark: SparkSession, base: str, metrics_type: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(os.path.join(base, metrics_type.lower()))
