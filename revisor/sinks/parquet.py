"""Partitioned Parquet sink (H1-H3), emptiness test (F2) and preview.

``save_dataframe`` never raises for data problems: it returns a
``WriteOutcome`` that the caller must look at (and the job records in the
metrics document).  The row count comes from an ``Observation`` collected
during the write itself, so writing costs one job plus the emptiness probe.

Overwrite scope: ``static`` replaces the whole target folder (parity with a
single-app target path); ``dynamic`` replaces only the partitions present in
the new data — required when many apps share one tree, where a static
overwrite would delete the other apps.

A task keeps up to ``OPEN_FILES`` files open at once.  With one file at a time
(Spark's default) every task first sorts its rows by the partition columns, all
columns of all rows, even where a run has one load date; that sort spilled.  A task
that meets more partitions than files sorts what is left.
"""

from __future__ import annotations

import logging
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revisor.operators.columns import coerce, stamp

log = logging.getLogger(__name__)

OPEN_FILES = 32
_WRITERS_KEY = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession):
    """The session's number of open files a task, raised to ``OPEN_FILES`` during a write; a set one stays."""
    before = spark.conf.get(_WRITERS_KEY)
    if int(before) > 0:
        yield
        return
    spark.conf.set(_WRITERS_KEY, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS_KEY, before)


@dataclass(frozen=True)
class WriteOutcome:
    ok: bool
    rows: int = 0
    path: str = ""
    reason: str = ""


def save_dataframe(
    df: DataFrame,
    path: str,
    label: str,
    *,
    odate: str,
    schema: T.StructType | None = None,
    strict: bool = False,
    partition_cols: list[str] | tuple[str, ...] = ("odate",),
    compression: str = "snappy",
    overwrite: str = "static",
    max_records_per_file: int | None = None,
    fresh: bool = False,
) -> WriteOutcome:
    """H1: coerce (optional) -> stamp ``odate`` -> skip if empty -> write
    snappy Parquet partitioned by ``partition_cols``.  ``fresh`` says that
    nothing lies at ``path`` yet (a folder aside), so there is nothing to keep."""
    if not isinstance(df, DataFrame):
        return WriteOutcome(False, reason=f"not a DataFrame: {type(df).__name__}")
    if not path:
        return WriteOutcome(False, reason="empty target path")
    if overwrite not in ("static", "dynamic"):
        raise ValueError("overwrite must be 'static' or 'dynamic'")
    try:
        keep = [c for c in partition_cols if c != "odate" and c in df.columns]
        if schema is not None:
            df = coerce(df, schema, strict=strict, keep=keep)
        out = stamp(df, odate) if "odate" in partition_cols else df
        # F2.  A static overwrite of zero rows would empty the whole target,
        # so it is probed first, which runs every shuffle below the rows.  A
        # dynamic overwrite of zero rows replaces no partition and a fresh
        # folder holds nothing, so the count observed during the write answers it.
        if overwrite == "static" and not fresh and out.isEmpty():
            log.warning("no %s rows to write to %s", label, path)
            return WriteOutcome(False, 0, path, "no rows")
        obs = Observation(f"write_{label}")
        observed = out.observe(obs, F.count(F.lit(1)).alias("rows"))
        writer = (
            observed.write.option("compression", compression)
            .option("partitionOverwriteMode", overwrite)
            .mode("overwrite")
            .partitionBy(*partition_cols)
        )
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
        with _open_files(df.sparkSession):
            writer.parquet(path)
        rows = int(obs.get.get("rows", 0))
        if rows == 0:
            log.warning("no %s rows to write to %s", label, path)
            return WriteOutcome(False, 0, path, "no rows")
        return WriteOutcome(True, rows, path)
    except Exception as exc:  # noqa: BLE001 - reported through the outcome
        reason = f"{type(exc).__name__}: {str(exc).strip().splitlines()[0] if str(exc).strip() else ''}"
        log.error("writing %s rows to %s failed: %s", label, path, reason, exc_info=log.isEnabledFor(logging.DEBUG))
        return WriteOutcome(False, 0, path, reason)


def cluster_by_group(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """Lay rows out so a write task holds few groups and a large share of each,
    for inputs whose files mix many groups.

    Spark's ``rebalance`` hint by the group columns: partitions are sized at run
    time, small groups share one and a hot group is split over many, by the
    session's ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.  Nothing is
    counted and nothing but shuffle sizes reaches the driver.
    """
    return df.hint("rebalance", *group_cols)


def target_path(base: str, app: str, type_client: str) -> str:
    """Single-app target folder ``<base>/<app>_<client>/``."""
    return f"{base.rstrip('/')}/{app}_{type_client}/"


def read_written(spark, path: str, schema: T.StructType,
                 partition_cols: list[str] | tuple[str, ...] = ("odate",)) -> DataFrame:
    """Read a tree written by ``save_dataframe`` with the declared schema;
    the partition columns come back as strings (partition inference would
    turn ``odate=20240101`` into an int)."""
    fields = [f for f in schema.fields if f.name not in partition_cols]
    fields += [T.StructField(c, T.StringType(), True) for c in partition_cols]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """the first ``n`` rows (a peek; the limit is the feature)."""
    return df.limit(n)
